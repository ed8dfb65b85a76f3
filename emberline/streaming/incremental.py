"""Incremental mode: new observation files are read once, deduplicated and appended, each run to its end."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def new_observations(spark: SparkSession, path: str, schema: str, time: str, late: str = "30 days") -> DataFrame:
    """A stream of files under ``path``; an id that comes again within ``late`` of the newest time is dropped.

    Times without a zone are read as UTC, as a watermark needs an instant.
    """
    raw = spark.readStream.schema(schema).parquet(path).withColumn(time, F.col(time).cast("timestamp"))
    return raw.withWatermark(time, late).dropDuplicatesWithinWatermark(["id"])


def run_once(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Feeds what is there to ``sink`` in micro-batches and ends; the checkpoint keeps the place between runs."""
    stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def append_to(path: str) -> Callable[[DataFrame, int], None]:
    """A sink that writes each batch under its own number, so a repeated batch replaces itself."""
    return lambda df, n: df.write.mode("overwrite").parquet(f"{path}/batch={n}")


def daily_counts(stream: DataFrame, time: str, by: str) -> DataFrame:
    """(window, by, n): observations a day, for a stream that has a watermark."""
    return stream.groupBy(F.window(time, "1 day").alias("day"), by).agg(F.count("*").alias("n"))
