"""Helpers that several corpus operators share: tables, the shared folder, bytes in and out of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..storage import discard, saved, saved_at, scratch, shared_root

#: ASCII white space that separates words in every contract of this package.
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(df: DataFrame, most: int = 1000, most_bytes: int = 64 << 20) -> DataFrame:
    """``df``, whose session hands Python at most ``most`` rows and about ``most_bytes`` at a time from here on: whole texts are large rows."""
    for name, value in (("spark.sql.execution.arrow.maxRecordsPerBatch", most), ("spark.sql.execution.arrow.maxBytesPerBatch", most_bytes)):
        now = str(df.sparkSession.conf.get(name)).removesuffix("b")
        if not now.isdigit() or int(now) > value or int(now) <= 0:
            df.sparkSession.conf.set(name, value)
    return df


_slot: dict = {}


def in_worker(key, make):
    """What ``make`` makes, kept in this Python worker for later tasks until another key is asked for.

    One slot: a worker that runs one stage after another holds the tables of the stage at hand alone.
    """
    if key not in _slot:
        _slot.clear()
        _slot[key] = make()
    return _slot[key]


#: Hadoop's names of stores that pyarrow knows under another.
SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs", "wasbs": "abfs"}


def _store(path: str):
    from pyarrow import fs

    scheme, _, rest = path.partition(":")
    if not rest or "/" in scheme:
        return fs.LocalFileSystem(), path
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    if scheme == "dbfs":  # mounted on every node
        return fs.LocalFileSystem(), "/dbfs/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(SCHEMES.get(scheme, scheme) + ":" + rest)


def open_output(path: str):
    """A binary stream to ``path`` (local, or any store that pyarrow reaches); its folder is made."""
    store, where = _store(path)
    store.create_dir(where.rpartition("/")[0], recursive=True)
    return store.open_output_stream(where)


def open_input(path: str):
    """A seekable binary file at ``path``."""
    store, where = _store(path)
    return store.open_input_file(where)


__all__ = ["SPACES", "discard", "in_worker", "open_input", "open_output", "saved", "saved_at", "scratch", "shared_root", "small_batches", "table"]
