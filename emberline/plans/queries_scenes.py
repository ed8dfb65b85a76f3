"""Registered queries on the scene catalogue, areas, records and runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixtures import over, sql, table
from ..functions import text
from ..operators import scenes as S
from ..sources import areas, records, stac
from ..storage import scratch
from ..streaming import incremental
from . import commands

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if oracle:
            ORACLE_SQL[f.__name__] = sql(oracle)
        return f

    return add


_BEST = "SELECT id, mgrs, date, cloud_cover FROM (SELECT *, row_number() OVER (PARTITION BY mgrs, date ORDER BY coalesce(cloud_cover, 100), id) AS n FROM fx_scenes) WHERE n = 1"


@query(_BEST)
def scene_dedup_clearest(spark, sf):
    return S.clearest(over(spark, sf, "fx_scenes").select("id", "mgrs", "date", "cloud_cover"))


@query("""WITH m AS (SELECT mgrs, date, mask FROM (SELECT mgrs, date, concat('scl-', id) AS mask, row_number() OVER (PARTITION BY mgrs, date ORDER BY coalesce(cloud_cover, 100), concat('scl-', id)) AS n FROM fx_scenes WHERE o_orderkey % 2 = 1) WHERE n = 1)
SELECT s.id, s.mgrs, s.date, m.mask FROM fx_scenes s LEFT JOIN m USING (mgrs, date) WHERE o_orderkey % 2 = 0""")
def scl_twin_join(spark, sf):
    d = over(spark, sf, "fx_scenes")
    masks = d.filter("o_orderkey % 2 = 1").select("mgrs", "date", "cloud_cover", F.concat(F.lit("scl-"), "id").alias("mask"))
    return S.with_twins(d.filter("o_orderkey % 2 = 0").select("id", "mgrs", "date"), masks).select("id", "mgrs", "date", "mask")


@query("""WITH a AS (SELECT cast(n_nationkey AS bigint) AS area, -12e0 + n_nationkey*9e-1 AS west, 39e0 + (n_nationkey % 9)*9e-1 AS south FROM nation)
SELECT area, s.id FROM a JOIN fx_scenes s ON s.west <= a.west + 0.7e0 AND a.west <= s.west + 1e0 AND s.south <= a.south + 0.7e0 AND a.south <= s.south + 1e0 WHERE date BETWEEN '1995-01-01' AND '1996-12-31' AND coalesce(cloud_cover, 100) <= 60""")
def scenes_for_aoi(spark, sf):
    k = F.col("n_nationkey")
    a = table(spark, sf, "nation").select(k.cast("long").alias("area"), (-12.0 + k * 0.9).alias("west"), (39.0 + (k % 9) * 0.9).alias("south")).withColumns({"east": F.col("west") + 0.7, "north": F.col("south") + 0.7})
    s = over(spark, sf, "fx_scenes").withColumns({"east": F.col("west") + 1, "north": F.col("south") + 1})
    return S.scenes_of_areas(s, a, "1995-01-01", "1996-12-31", 60).select("area", "id")


@query("SELECT id FROM fx_scenes WHERE coalesce(cloud_cover, 100) <= 30 AND mgrs IN ('T3', 'T7', 'T11')")
def cloud_threshold(spark, sf):
    return S.tiles(S.cloud_at_most(over(spark, sf, "fx_scenes"), 30), ["T3", "T7", "T11"]).select("id")


@query("SELECT n_name AS name FROM nation WHERE n_nationkey % 4 = 1")
def shard(spark, sf):
    return S.shard(table(spark, sf, "nation").withColumn("position", F.col("n_nationkey")), 1, 4).select(F.col("n_name").alias("name"))


@query("""WITH w AS (SELECT cast(r_regionkey AS bigint) AS k, DATE '2018-01-01' + cast(r_regionkey*31 AS int) AS s, DATE '2018-06-30' + cast(r_regionkey*200 AS int) AS e FROM region), p AS (SELECT *, unnest(range(0, 5)) AS part, date_diff('day', s, e) AS days FROM w)
SELECT k, cast(part AS int) AS part, cast(s + cast(days*part//5 + CASE WHEN part > 0 THEN 1 ELSE 0 END AS int) AS string) AS "from", cast(s + cast(days*(part + 1)//5 AS int) AS string) AS "to" FROM p""")
def window_split(spark, sf):
    k = F.col("r_regionkey")
    w = table(spark, sf, "region").select(k.cast("long").alias("k"), F.date_add(F.lit("2018-01-01").cast("date"), (k * 31).cast("int")).alias("start"), F.date_add(F.lit("2018-06-30").cast("date"), (k * 200).cast("int")).alias("end"))
    return S.split_window_rows(w, 5).select("k", "part", F.col("from").cast("string").alias("from"), F.col("to").cast("string").alias("to"))


@query()
def envelope_merge(spark, sf):
    """Merged boxes of areas: a driver-side list, as it plans requests."""
    rows = table(spark, sf, "nation").select("n_nationkey").orderBy("n_nationkey").collect()
    boxes = [S.widen((k[0] % 7 * 2.0, k[0] % 5 * 2.0, k[0] % 7 * 2.0 + 0.5 + k[0] % 3, k[0] % 5 * 2.0 + 0.5)) for k in rows]
    return spark.createDataFrame(S.disjoint(boxes), "west double, south double, east double, north double")


@query("SELECT id, mgrs, batch FROM (SELECT id, mgrs, batch, row_number() OVER (PARTITION BY id ORDER BY batch) AS n FROM (SELECT id, mgrs, 0 AS batch FROM fx_scenes WHERE o_orderkey % 3 <> 0 UNION ALL SELECT id, mgrs, 1 FROM fx_scenes)) WHERE n = 1")
def manifest_merge(spark, sf):
    d = over(spark, sf, "fx_scenes")
    return S.merged([d.filter("o_orderkey % 3 <> 0").select("id", "mgrs", F.lit(0).alias("batch")), d.select("id", "mgrs", F.lit(1).alias("batch"))])


def _time():
    return F.timestamp_seconds(F.unix_date(F.col("date").cast("date")).cast("long") * 86400 + (F.col("o_orderkey") % 24) * 3600)


@query("""WITH s AS (SELECT id, mgrs, coalesce(cloud_cover, 100) AS cloud, date_diff('day', DATE '1970-01-01', cast(date AS date))*86400 + (o_orderkey % 24)*3600 AS t FROM fx_scenes),
p AS (SELECT a.id AS target_id, b.id AS background_id, abs(a.t - b.t) AS gap_s FROM s a JOIN s b USING (mgrs) WHERE b.cloud <= 95 AND abs(a.t - b.t) BETWEEN 300 AND 10368000)
SELECT * FROM p""")
def background_candidates(spark, sf):
    return S.background_candidates(over(spark, sf, "fx_scenes").select("id", "mgrs", "cloud_cover", _time().alias("time")))


@query("""WITH s AS (SELECT id, mgrs, o_orderkey AS k, coalesce(cloud_cover, 100) AS cloud, date_diff('day', DATE '1970-01-01', cast(date AS date))*86400 + (o_orderkey % 24)*3600 AS t FROM fx_scenes),
p AS (SELECT a.id AS target_id, b.id AS background_id, abs(a.t - b.t) AS gap_s, b.k % 101 AS clear, ((a.k + b.k)*7 % 1000)/1e3 AS d FROM s a JOIN s b USING (mgrs) WHERE b.cloud <= 95 AND abs(a.t - b.t) BETWEEN 300 AND 10368000),
l AS (SELECT *, max(CASE WHEN clear >= 95 THEN 1 ELSE 0 END) OVER (PARTITION BY target_id) AS strict FROM p),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY target_id ORDER BY gap_s, background_id) AS n FROM l WHERE clear >= CASE WHEN strict = 1 THEN 95 ELSE 65 END) WHERE n <= 20)
SELECT target_id, background_id FROM (SELECT *, row_number() OVER (PARTITION BY target_id ORDER BY d, gap_s, background_id) AS m FROM f) WHERE m = 1""")
def nearest_background(spark, sf):
    d, k = over(spark, sf, "fx_scenes"), F.col("o_orderkey")
    scenes = d.select("id", "mgrs", "cloud_cover", _time().alias("time"), (k % 101).alias("clear_percent"), k.alias("by"))
    return S.nearest_clear(scenes, lambda target, background: (target + background) * 7 % 1000 / 1000.0)


@query("""WITH g AS (SELECT cast(a.n_nationkey AS bigint) AS ix, cast(b.n_nationkey AS bigint) AS iy, a.n_nationkey*1e0 - b.n_nationkey AS u, a.n_nationkey*0.5e0 + b.n_nationkey*b.n_nationkey*0.1e0 AS v FROM nation a, nation b),
p AS (SELECT id, (lon - 50.9e0)/0.01e0 AS x, (lat - 24.95e0)/0.01e0 AS y FROM fx_detections),
q AS (SELECT *, greatest(0, least(23, floor(x))) AS x0, greatest(0, least(23, floor(y))) AS y0 FROM p),
w AS (SELECT *, greatest(0e0, least(1e0, x - x0)) AS fx, greatest(0e0, least(1e0, y - y0)) AS fy FROM q)
SELECT id, round(sum(u*(CASE WHEN ix = x0 THEN 1e0 - fx ELSE fx END)*(CASE WHEN iy = y0 THEN 1e0 - fy ELSE fy END)), 6) AS u, round(sum(v*(CASE WHEN ix = x0 THEN 1e0 - fx ELSE fx END)*(CASE WHEN iy = y0 THEN 1e0 - fy ELSE fy END)), 6) AS v
FROM w JOIN g ON ix BETWEEN x0 AND x0 + 1 AND iy BETWEEN y0 AND y0 + 1 GROUP BY id""")
def wind_bilinear(spark, sf):
    n = table(spark, sf, "nation").select("n_nationkey")
    ks = [r[0] for r in n.collect()]  # a grid axis of 25 cells
    grid = n.select(F.lit(0).alias("hour"), F.col("n_nationkey").cast("long").alias("ix"), F.explode(F.array(*(F.lit(k).cast("long") for k in ks))).alias("iy"))
    grid = grid.withColumns({"u": F.col("ix") * 1.0 - F.col("iy"), "v": F.col("ix") * 0.5 + F.col("iy") * F.col("iy") * 0.1})
    points = over(spark, sf, "fx_detections").select("id", F.lit(0).alias("hour"), "lon", "lat")
    out = S.wind_at(points, grid, (50.9, 24.95), (0.01, 0.01), (25, 25))
    return out.select("id", F.round("u", 6).alias("u"), F.round("v", 6).alias("v"))


@query("SELECT c_custkey AS area FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def verify_gaps(spark, sf):
    return commands.gaps(table(spark, sf, "customer").select(F.col("c_custkey").alias("area")), table(spark, sf, "orders").select(F.col("o_custkey").alias("area")))


@query("SELECT count(*) AS expected, count(CASE WHEN s THEN 1 END) AS scanned, count(CASE WHEN NOT s THEN 1 END) AS gaps, (SELECT count(*) FROM orders WHERE o_orderkey % 97 = 0) AS errors FROM (SELECT c_custkey IN (SELECT o_custkey FROM orders) AS s FROM customer)")
def verify_totals(spark, sf):
    orders = table(spark, sf, "orders")
    return commands.verify(table(spark, sf, "customer").select(F.col("c_custkey").alias("area")), orders.select(F.col("o_custkey").alias("area")), orders.filter("o_orderkey % 97 = 0").select(F.col("o_orderkey").alias("scene")))


@query("""SELECT coalesce(s.id, c.id) AS id, CASE WHEN c.id IS NULL THEN s.name ELSE c.name END AS name, CASE WHEN c.id IS NULL THEN '2023' ELSE '2024-01-01' END AS start FROM (SELECT cast(s_suppkey AS string) AS id, s_name AS name FROM supplier) s
FULL JOIN (SELECT cast(c_custkey AS string) AS id, c_name AS name FROM customer WHERE c_custkey % 3 <> 0) c ON s.id = c.id""")
def coverage_upsert(spark, sf):
    old = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("int").alias("position"), F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("name"), F.lit("{}").alias("geometry"), F.lit("2023").alias("start"), F.lit("2023").alias("end"), F.lit("2023").alias("scanned"))
    new = table(spark, sf, "customer").select(F.col("c_custkey").cast("int").alias("position"), F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"), F.when(F.col("c_custkey") % 3 != 0, "{}").alias("geometry"))
    return commands.coverage(old, new, "2024-01-01", "2024-02-01", "2024-02-02").select("id", "name", "start")


@query("SELECT id FROM fx_scenes WHERE NOT (o_orderkey % 3 = 0 AND o_orderkey % 2 = 0 AND o_orderkey % 5 <> 0)")
def resume_filter(spark, sf):
    d = over(spark, sf, "fx_scenes")
    k = F.col("o_orderkey")
    done = d.filter(k % 3 == 0).select(F.col("id").alias("scene"), F.lit("FeatureCollection").alias("type"), F.lit("own/v1").alias("schema_tag"), F.lit("flares").alias("detector"), F.when(k % 2 == 0, "f1").otherwise("f2").alias("fingerprint"), F.when(k % 5 != 0, "[]").alias("features"))
    return records.remaining(d.select("id"), done, "own/v1", "flares", "f1").select("id")


@query("""WITH x AS (SELECT id, date, CASE WHEN o_orderkey % 3 = 0 THEN concat('<A><RADIO_ADD_OFFSET id="11"> -', cast(o_orderkey % 2000 AS string), '</RADIO_ADD_OFFSET><QUANTIFICATION_VALUE unit="none">', cast(o_orderkey % 7 + 1 AS string), '000</QUANTIFICATION_VALUE></A>') END AS xml, o_orderkey AS k FROM fx_scenes)
SELECT id, CASE WHEN xml IS NOT NULL THEN cast(-(k % 2000) AS double) + 0e0 WHEN date >= '2022-01-25' THEN -1e3 ELSE 0e0 END AS "offset", CASE WHEN xml IS NOT NULL THEN (k % 7 + 1)*1e3 ELSE 1e4 END AS quantification FROM x""")
def xml_radiometry(spark, sf):
    k = F.col("o_orderkey")
    xml = F.when(k % 3 == 0, F.concat(F.lit('<A><RADIO_ADD_OFFSET id="11"> -'), (k % 2000).cast("string"), F.lit('</RADIO_ADD_OFFSET><QUANTIFICATION_VALUE unit="none">'), (k % 7 + 1).cast("string"), F.lit("000</QUANTIFICATION_VALUE></A>")))
    d = over(spark, sf, "fx_scenes").withColumn("xml", xml)
    offset, quantification = S.radiometry(F.col("date"), F.col("xml"))
    return d.select("id", (offset + 0.0).alias("offset"), quantification.alias("quantification"))


@query("SELECT id, concat('https://h/', id, '_B11.jp2') AS b11, concat('https://h/', id, '_B10.jp2') AS b10, mgrs, cast(cloud_cover AS double) AS cloud_cover, west FROM fx_scenes")
def stac_items(spark, sf):
    link = F.concat(F.lit("https://h/"), "id", F.lit("_B11.jp2"))
    item = F.to_json(F.struct("id", F.struct(F.concat("date", F.lit("T07:00:00Z")).alias("datetime"), F.col("cloud_cover").alias("eo:cloud_cover"), F.concat(F.lit("MGRS-"), "mgrs").alias("grid:code")).alias("properties"), F.array("west", "south", F.col("west") + 1, F.col("south") + 1).alias("bbox"), F.struct(F.struct(link.alias("href")).alias("B11")).alias("assets")))
    return S.resolve_bands(over(spark, sf, "fx_scenes").select(item.alias("item")), "l1c").select("id", F.col("bands.b11").alias("b11"), F.col("bands.b10").alias("b10"), "mgrs", "cloud_cover", "west")


@query("""SELECT cast(o_orderkey AS bigint) AS id, k AS segment, round(o_custkey/1e1 + k, 6) AS ax, round(o_orderkey % 50 + 0e0, 6) AS ay, round(o_custkey/1e1 + k + 1e0, 6) AS bx FROM fx_scenes JOIN orders USING (o_orderkey), (SELECT unnest(range(0, 2)) AS k)""")
def line_segments(spark, sf):
    o = table(spark, sf, "orders")
    x = F.col("o_custkey") / 10.0
    pair = lambda k: F.concat(F.lit("["), (x + k).cast("string"), F.lit(","), (F.col("o_orderkey") % 50).cast("string"), F.lit("]"))
    geometry = F.concat(F.lit('{"type":"MultiLineString","coordinates":[['), pair(0), F.lit(","), pair(1), F.lit("],["), pair(1), F.lit(", "), pair(2), F.lit("]]}"))
    d = areas.line_segments(o.select(F.col("o_orderkey").cast("long").alias("id"), x.alias("x"), geometry.alias("geometry")))
    return d.select("id", F.round(F.col("ax") - F.col("x")).cast("long").alias("segment"), F.round("ax", 6).alias("ax"), F.round("ay", 6).alias("ay"), F.round("bx", 6).alias("bx"))


@query("SELECT l.quality AS label, count(*) AS n, cast(sum(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bigint) AS toxic, max(d.n_chars) AS longest FROM labels l JOIN documents d USING (doc_id) GROUP BY l.quality")
def label_summary(spark, sf):
    d = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id")
    return d.groupBy(F.col("quality").alias("label")).agg(F.count("*").alias("n"), F.sum((F.col("toxic") == 1).cast("int")).alias("toxic"), F.max("n_chars").alias("longest")).orderBy(F.desc("label"), F.desc_nulls_last("longest"))


@query("SELECT event_type AS status, count(*) AS scenes, cast(sum(user_id) AS bigint) AS detections FROM events GROUP BY event_type")
def run_totals(spark, sf):
    return commands.run_totals(table(spark, sf, "events").select(F.col("event_type").alias("status"), F.col("user_id").alias("detections")))


@query("SELECT event_id AS id, user_id FROM events")
def stream_dedup_available_now(spark, sf):
    """Every event twice, through the incremental mode: each id once."""
    root = scratch(spark, "stream")
    once = table(spark, sf, "events").select(F.col("event_id").alias("id"), "user_id", F.col("ts").cast("timestamp").alias("ts"))
    once.write.parquet(f"{root}/in")
    once.write.mode("append").parquet(f"{root}/in")
    stream = incremental.new_observations(spark, f"{root}/in", "id long, user_id long, ts timestamp", "ts", "3650 days")
    incremental.run_once(stream, incremental.append_to(f"{root}/out"), f"{root}/place")
    return spark.read.parquet(f"{root}/out").select("id", "user_id")


@query("SELECT cast(cast(ts AS date) AS string) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_daily_counts(spark, sf):
    root = scratch(spark, "stream")
    table(spark, sf, "events").select("event_type", F.col("ts").cast("timestamp").alias("ts")).write.parquet(f"{root}/in")
    stream = spark.readStream.schema("event_type string, ts timestamp").parquet(f"{root}/in").withWatermark("ts", "3650 days")
    counts = incremental.daily_counts(stream, "ts", "event_type")
    name = "daily_" + root[-8:]
    counts.writeStream.outputMode("complete").format("memory").queryName(name).option("checkpointLocation", f"{root}/place").trigger(availableNow=True).start().awaitTermination()
    return spark.table(name).select(F.col("day.start").cast("date").cast("string").alias("day"), "event_type", "n")


@query("SELECT id, concat(regexp_replace(mgrs, '[^A-Za-z0-9_-]', '_', 'g'), '-', substr(sha256(date), 1, 8)) AS key FROM fx_scenes")
def area_keys(spark, sf):
    return over(spark, sf, "fx_scenes").select("id", text.area_key(F.col("mgrs"), F.col("date")).alias("key"))


def _items(spark, sf, assets: dict[str, str], more: dict[str, F.Column]) -> DataFrame:
    """Catalogue items of scenes with the assets that a profile lists."""
    link = {a: F.struct(F.concat(F.lit(head), "id", F.lit(f"_{a}.jp2")).alias("href")).alias(a) for a, head in assets.items()}
    item = F.to_json(F.struct("id", F.struct(F.concat("date", F.lit("T07:00:00Z")).alias("datetime"), *(c.alias(n) for n, c in more.items())).alias("properties"), F.struct(*link.values()).alias("assets")))
    return over(spark, sf, "fx_scenes").select(item.alias("item"))


@query("SELECT id, concat('https://sentinel-s2-l1c.s3.eu-central-1.amazonaws.com/', id, '_swir22.jp2') AS b12, concat('https://h/', id, '_cirrus.jp2') AS b10, concat('s3://other/', id, '_nir08.jp2') AS b8a, cast(NULL AS varchar) AS scl, cast(32600 + o_orderkey % 60 AS int) AS epsg FROM fx_scenes")
def stac_items_aws_l1c(spark, sf):
    d = _items(spark, sf, {"swir22": "s3://sentinel-s2-l1c/", "cirrus": "https://h/", "nir08": "s3://other/"}, {"proj:epsg": 32600 + F.col("o_orderkey") % 60})
    return S.resolve_bands(d, "aws-l1c").select("id", "bands.b12", "bands.b10", "bands.b8a", "bands.scl", "epsg")


@query("SELECT id, concat('https://h/', id, '_swir22.jp2') AS b12, concat('https://h/', id, '_nir08.jp2') AS b8a, cast(NULL AS varchar) AS b02, concat('https://h/', id, '_scl.jp2') AS scl FROM fx_scenes")
def stac_items_aws(spark, sf):
    d = _items(spark, sf, {a: "https://h/" for a in ("swir22", "nir08", "blue", "scl")}, {})
    return S.resolve_bands(d, "aws").select("id", "bands.b12", "bands.b8a", "bands.b02", "bands.scl")


@query("SELECT id, concat('https://h/', id, '_B12_20m.jp2') AS b12, concat('https://h/', id, '_SCL_20m.jp2') AS scl, concat('https://h/', id, '_SCL_20m.jp2') AS mask, cast(NULL AS varchar) AS b10, concat('https://h/', id, '_product_metadata.jp2') AS product_metadata FROM fx_scenes")
def stac_items_cdse(spark, sf):
    d = _items(spark, sf, {a: "https://h/" for a in ("B12_20m", "SCL_20m", "B12", "product_metadata")}, {})
    return S.resolve_bands(d, "cdse").select("id", "bands.b12", "bands.scl", "bands.b10", "bands.product_metadata").join(S.mask_links(d), "id")


@query("SELECT 'cdse-l1c' AS source, 'https://stac.dataspace.copernicus.eu/v1' AS api, 'l1c' AS level, 'cdse' AS twin UNION ALL SELECT 'cdse', 'https://stac.dataspace.copernicus.eu/v1', 'l2a', 'cdse' UNION ALL SELECT 'aws-l1c', 'https://earth-search.aws.element84.com/v1', 'l1c', 'aws' UNION ALL SELECT 'aws', 'https://earth-search.aws.element84.com/v1', 'l2a', 'aws'")
def source_profiles(spark, sf):
    return spark.createDataFrame([(x, stac.endpoint(x), stac.level_of(x), stac.mask_source(x)) for x in S.ASSETS], "source string, api string, level string, twin string")


@query("SELECT cast(row_number() OVER (ORDER BY date, id) AS int) AS place, id FROM fx_scenes")
def scenes_by_time(spark, sf):
    from ..operators.review import numbered

    d = over(spark, sf, "fx_scenes").select("id", F.col("date").alias("datetime"))
    return numbered(d, "datetime", "id").select("place", "id")


@query("""SELECT id FROM fx_detections JOIN (SELECT n_nationkey AS k, 50.99e0 + n_nationkey*1e-3 AS west, 24.99e0 + n_nationkey*1e-3 AS south, n_nationkey % 9 = 0 AS whole FROM nation) a ON user_id % 25 = k
WHERE whole OR (lon BETWEEN west AND west + 3e-2 AND lat BETWEEN south AND south + 2e-2)""".replace("user_id", "site_key"))
def clip_to_area(spark, sf):
    k = F.col("n_nationkey")
    areas = table(spark, sf, "nation").select(k.cast("long").alias("area"), (50.99 + k * 1e-3).alias("west"), (24.99 + k * 1e-3).alias("south"), (k % 9 == 0).alias("full_tile"))
    areas = areas.withColumns({"east": F.col("west") + 3e-2, "north": F.col("south") + 2e-2})
    d = over(spark, sf, "fx_detections").select("id", "lon", "lat", (F.col("site_key") % 25).cast("long").alias("area"))
    return S.within_area(d, areas).select("id")


@query("""SELECT id, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE (o_orderkey % 700)/1e1 END AS sun, CASE WHEN o_orderkey % 3 = 1 THEN NULL ELSE (o_orderkey % 130)/1e1 END AS view FROM fx_scenes""")
def zenith_angles(spark, sf):
    k = F.col("o_orderkey")
    number = lambda n: (k % n / 10.0).cast("string")
    sun = F.when(k % 3 == 0, "").otherwise(F.concat(F.lit('<Mean_Sun_Angle><ZENITH_ANGLE unit="deg"> '), number(700), F.lit(" </ZENITH_ANGLE></Mean_Sun_Angle>")))
    view = lambda band, n: F.concat(F.lit(f'<Mean_Viewing_Incidence_Angle bandId="{band}"><ZENITH_ANGLE>'), n, F.lit("</ZENITH_ANGLE></Mean_Viewing_Incidence_Angle>"))
    xml = F.concat(F.lit("<A>"), sun, view(1, F.lit("99")), F.when(k % 3 == 1, "").otherwise(view(12, number(130))), F.lit("</A>"))
    a, b = text.zenith_angles(xml)
    return over(spark, sf, "fx_scenes").select("id", a.alias("sun"), b.alias("view"))


@query("SELECT vec_id, cast(list_position(embedding[1:4], list_max(embedding[1:4])) - 1 AS int) AS class FROM embeddings")
def argmax_class(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", text.argmax(F.slice("embedding", 1, 4)).alias("class"))
