"""Adapter views: emission-shaped tables over the general test tables, in SQL that both engines read.

Braces mark tables.  ``over`` runs a view on Spark without registering anything; ``sql`` gives the text for DuckDB.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_DETECTIONS = """
SELECT concat('d', cast(event_id AS string)) AS id, event_id, user_id AS site_key, {place},
  cast(cast(ts AS date) AS string) AS date, 3e-1 + value/1e2 AS max_b12,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE 25e-2 + ((event_id*7) % 100)/1e2 END AS max_b11,
  CASE WHEN event_id % 13 = 0 OR event_id % 11 = 0 THEN NULL ELSE (3e-1 + value/1e2)/(25e-2 + ((event_id*7) % 100)/1e2) END AS b12_b11_ratio,
  value/1e1 AS radiance, CASE WHEN event_id % 17 = 0 THEN NULL ELSE 5e0 + (event_id % 80) END AS sun_elevation
FROM {events}"""

VIEWS = {
    "fx_detections": _DETECTIONS.replace("{place}", "51e0 + (user_id % 20)*3e-3 + (event_id % 3)*2e-4 AS lon, 25e0 + floor(user_id/2e1)*3e-3 + (floor(event_id/3e0) % 3)*2e-4 AS lat"),
    "fx_chained": _DETECTIONS.replace("{place}", "51e0 + (user_id % 20)*16e-4 + (event_id % 5)*2e-4 AS lon, 25e0 + floor(user_id/2e1)*16e-4 + (floor(event_id/5e0) % 5)*2e-4 AS lat"),
    "fx_clouds": """
SELECT cast(51000 + (l_partkey % 160 % 20)*3 + (l_linenumber % 3) - 1 AS bigint) AS i, cast(25000 + floor((l_partkey % 160)/2e1)*3 + (l_orderkey % 3) - 1 AS bigint) AS j,
  cast(date '2024-01-01' + cast(l_orderkey % 30 AS int) AS string) AS date, cast(l_quantity AS int) % 20 / 5e1 AS cloud
FROM {lineitem}""",
    "fx_scenes": """
SELECT concat('S2', CASE WHEN o_orderkey % 2 = 0 THEN 'A' ELSE 'B' END, '_MSIL1C_R', lpad(cast(o_custkey % 143 AS string),3,'0'), '_', cast(o_orderkey AS string)) AS id,
  o_orderkey, concat('T', cast(o_custkey % 40 AS string)) AS mgrs, cast(cast(o_orderdate AS date) AS string) AS date,
  CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE cast(floor(o_totalprice) AS bigint) % 101 END AS cloud_cover,
  -1e1 + (o_custkey % 40)*5e-1 AS west, 4e1 + (o_custkey % 7)*1e0 AS south
FROM {orders}""",
    "fx_candidates": """
SELECT concat('t', cast(c_nationkey as string), ':', cast(cast(o_orderdate as date) as string), ':plume-', cast(o_orderkey as string)) as key,
  concat('t', cast(c_nationkey as string)) as target, cast(cast(o_orderdate as date) as string) as date,
  -3e0 + c_nationkey*1e-1 + (o_custkey % 9)*4e-3 as centre_lon, 54e0 + (o_orderkey % 7)*4e-3 as centre_lat, -3e0 + c_nationkey*1e-1 as origin_lon, 54e0 as origin_lat,
  cast(o_custkey % 17 - 8 as double) as wu, cast(o_orderkey % 13 - 6 as double) as wv, (o_custkey % 12)*6e1 as anchor_m, ((o_custkey*37 + o_orderkey) % 100)/1e2 as max_p,
  case when o_orderkey % 23 = 0 then 0e0 else o_totalprice/2e1 end as flux_kg_h, cast(o_custkey % 101 as double) as clear_percent,
  case when o_orderkey % 29 = 0 then null else cast(5 + (o_orderkey*7 + o_custkey) % 60 as double) end as sun_elevation, o_custkey % 5 = 0 as cross_orbit_bg,
  case when o_orderkey % 3 = 0 then null else (o_custkey % 80)/1e2 end as collinearity
FROM {orders} join {customer} on o_custkey = c_custkey""",
}
#: Pixels of 8 x 8 rasters: the one view whose explode is spelled differently.
PIXELS_SPARK = "SELECT vec_id, cast(floor(pos/8e0) AS int) AS r, cast(pos % 8 AS int) AS c, cast(v AS double) AS v FROM (SELECT vec_id, posexplode(embedding) AS (pos, v) FROM {embeddings})"
PIXELS_DUCK = "SELECT vec_id, cast(floor((pos-1)/8e0) AS int) AS r, cast((pos-1) % 8 AS int) AS c, cast(v AS double) AS v FROM (SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding,1) AS pos FROM {embeddings})"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def over(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The view as a DataFrame over the tables of ``sf_dir``."""
    text = PIXELS_SPARK if name == "fx_pixels" else VIEWS[name]
    return spark.sql(text, **{t: table(spark, sf_dir, t) for t in set(re.findall(r"\{(\w+)\}", text))})


def sql(body: str) -> str:
    """``body`` with the views that it names before it, for DuckDB."""
    names = [n for n in (*VIEWS, "fx_pixels") if re.search(rf"\b{n}\b", body)]
    plain = lambda n: re.sub(r"\{(\w+)\}", r"\1", PIXELS_DUCK if n == "fx_pixels" else VIEWS[n])
    views = ", ".join(f"{n} AS ({plain(n)})" for n in names)
    body = body.strip()
    if body[:4].lower() == "with":
        rest = re.sub(r"(?is)^with\s+(recursive\s+)?", "", body)
        return f"WITH {'RECURSIVE ' if re.match(r'(?is)with\s+recursive', body) else ''}{views}, {rest}" if views else body
    return f"WITH {views} {body}" if views else body
