"""The folder that driver and executors share: written tables that cut lineage and outlive executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``.  Where it is unset, a temporary folder serves a local session; on a cluster it is an error."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="emberline-")
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again."""
    return saved_at(df, name)[0]


def saved_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``saved``, and the path, for a table that is discarded once nothing reads it."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Removes a scratch path that no later step reads."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
