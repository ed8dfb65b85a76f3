"""The commands as plans over DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import cluster as C
from ..operators import review as R


def cluster_command(detections: DataFrame, clouds: DataFrame | None = None, options: C.ClusterOptions | None = None, order: tuple[str, ...] = ("id",)) -> tuple[DataFrame, DataFrame]:
    """Sites and members; with a cloud mask, sites are scored against their clear looks."""
    sites, members = C.cluster(detections, options or C.ClusterOptions.command(), order)
    return (C.rescore(sites, clouds, members) if clouds is not None else sites), members


def review_command(candidates: DataFrame, collinearity: DataFrame | None = None) -> DataFrame:
    """Ranked verdicts; ``collinearity`` (key, collinearity) comes from mask pixels where lines are at hand."""
    if collinearity is not None:
        candidates = candidates.drop("collinearity").join(collinearity, "key", "left")
    return R.ranked(R.triage(candidates))


def gaps(expected: DataFrame, scanned: DataFrame) -> DataFrame:
    """Areas that were asked for and never scanned."""
    return expected.join(scanned.select("area").distinct(), "area", "left_anti")


def verify(expected: DataFrame, scanned: DataFrame, errors: DataFrame) -> DataFrame:
    """One row: areas asked for, scanned, missing, and error rows."""
    e = expected.select("area").distinct().join(scanned.select("area", F.lit(1).alias("seen")).distinct(), "area", "left")
    rows = e.select(F.lit(1).alias("asked"), "seen", F.lit(None).cast("int").alias("error")).unionAll(errors.select(F.lit(None), F.lit(None), F.lit(1)))
    return rows.agg(F.count("asked").alias("expected"), F.count("seen").alias("scanned"), (F.count("asked") - F.count("seen")).alias("gaps"), F.count("error").alias("errors"))


def coverage(published: DataFrame, features: DataFrame, start: str, end: str, scanned: str) -> DataFrame:
    """The published overlay (position, id, name, geometry, start, end, scanned) with new features put in.

    An id that was there is replaced in place, new ones follow in their order; features without a geometry are left
    out; of several with one id the last counts.
    """
    new = features.filter("geometry is not null").groupBy("id").agg(F.max_by(F.struct("geometry", F.coalesce("name", F.lit("")).alias("name")), "position").alias("f"), F.min("position").alias("n"))
    new = new.select("id", F.col("f.geometry").alias("g"), F.col("f.name").alias("m"), "n")
    both = published.join(new, "id", "full_outer")
    pick = lambda fresh, old: F.when(F.col("g").isNotNull(), fresh).otherwise(F.col(old)).alias(old)
    return both.select("id", pick(F.col("m"), "name"), pick(F.col("g"), "geometry"), pick(F.lit(start), "start"), pick(F.lit(end), "end"), pick(F.lit(scanned), "scanned"), F.struct(F.col("position").isNull().alias("late"), F.coalesce("position", "n").alias("at")).alias("order"))


def run_totals(outcomes: DataFrame) -> DataFrame:
    """A row a status of what a run did."""
    return outcomes.groupBy("status").agg(F.count("*").alias("scenes"), F.sum("detections").alias("detections"))
