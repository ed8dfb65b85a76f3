"""Areas of interest and line features from GeoJSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Geometry stays text: its nesting depends on its type.
_FEATURE = "struct<id:string,geometry:string,properties:map<string,string>>"
_NUMBER = r"(-?[0-9]+(?:\.[0-9]+)?(?:[eE][-+]?[0-9]+)?)"


def coordinates(geometry: Column) -> Column:
    """All coordinate pairs of a geometry's text, whatever its nesting, as an array of structs x, y."""
    pair = rf"\[\s*{_NUMBER}\s*,\s*{_NUMBER}"
    xs, ys = F.regexp_extract_all(geometry, F.lit(pair), 1), F.regexp_extract_all(geometry, F.lit(pair), 2)
    return F.zip_with(xs, ys, lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")))


def box(geometry: Column) -> Column:
    """Struct west, south, east, north of a geometry's text."""
    c = coordinates(geometry)
    side = lambda f, n: f(F.transform(c, lambda p: p[n]))
    return F.struct(side(F.array_min, "x").alias("west"), side(F.array_min, "y").alias("south"), side(F.array_max, "x").alias("east"), side(F.array_max, "y").alias("north"))


def read_areas(spark: SparkSession, path: str) -> DataFrame:
    """position, area, name, geometry (text), properties and the box of each feature of a collection.

    The id is the feature's own, else its ProjectID, else its position; the name likewise from name or TerminalName.
    """
    docs = spark.read.text(path, wholetext=True).select(F.from_json("value", f"struct<features:array<{_FEATURE}>>").alias("d"))
    f = docs.select(F.posexplode("d.features").alias("position", "f"))
    p = lambda k: F.nullif(F.col("f.properties")[k], F.lit(""))
    area = F.coalesce(F.nullif(F.col("f.id"), F.lit("")), p("id"), p("ProjectID"), F.col("position").cast("string"))
    return f.select("position", area.alias("area"), F.coalesce(p("name"), p("TerminalName"), area).alias("name"), F.col("f.geometry").alias("geometry"), F.col("f.properties").alias("properties"), box(F.col("f.geometry")).alias("b")).select("position", "area", "name", "geometry", "properties", "b.*")


def line_segments(features: DataFrame, geometry: str = "geometry") -> DataFrame:
    """(feature columns, ax, ay, bx, by): consecutive points of every line or ring of a geometry's text.

    Innermost lists of pairs are found by their brackets, so lines, rings and their collections are read alike.
    """
    runs = F.regexp_extract_all(F.regexp_replace(geometry, r"\s+", ""), F.lit(r"(\[(?:\[[^\[\]]*\],?)+\])"), 1)
    points = features.withColumn("_run", F.explode(runs)).withColumn("_p", coordinates(F.col("_run")))
    n = F.size("_p")
    pairs = F.arrays_zip(F.slice("_p", F.lit(1), F.greatest(n - 1, F.lit(0))).alias("a"), F.slice("_p", F.lit(2), F.greatest(n - 1, F.lit(0))).alias("b"))
    out = points.withColumn("_s", F.explode(pairs))
    return out.select(*features.columns, F.col("_s.a.x").alias("ax"), F.col("_s.a.y").alias("ay"), F.col("_s.b.x").alias("bx"), F.col("_s.b.y").alias("by"))
