"""Connected components of an edge table, by alternating large and small stars (Kiveris et al., 2014).

Every round works on whole tables with partial minima, so a vertex with very many edges is never gathered in one
task; each round's edges are written to the shared folder, which cuts lineage and survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import discard, scratch


def _large(e: DataFrame) -> DataFrame:
    both = e.union(e.select("b", "a"))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def _small(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = down.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.union(low.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(a, root) for every vertex of ``edges`` (columns a, b of one ordered type) but the roots: the least of its component."""
    spark, kind = edges.sparkSession, edges.schema
    written: list[str] = []

    def step(df: DataFrame) -> tuple[DataFrame, tuple]:
        path = scratch(spark, "component-edges")
        df.write.parquet(path)
        written.append(path)
        out = spark.read.schema(kind).parquet(path)
        return out, tuple(out.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now, sign = step(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while sign[0]:
        now, after = step(_small(_large(now)))
        for path in written[:-1]:
            discard(spark, path)
        del written[:-1]
        if after == sign:
            break
        sign = after
    return now.select("a", F.col("b").alias("root"))
