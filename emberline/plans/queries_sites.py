"""Registered queries on detections, sites, clouds and triage, each with the SQL that says what it returns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixtures import over, sql, table
from ..functions import geo, score, text
from ..operators import cluster as C
from ..operators import review as R
from ..sources import records
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


def r6(name: str) -> F.Column:
    return F.round(name, 6).alias(name)


@query("SELECT id, lon, lat, date, max_b12, max_b11, b12_b11_ratio, radiance, sun_elevation FROM fx_detections WHERE date BETWEEN '2024-01-05' AND '2024-01-20'")
def detections_window_scan(spark, sf):
    return over(spark, sf, "fx_detections").filter(F.col("date").between("2024-01-05", "2024-01-20")).select("id", "lon", "lat", "date", "max_b12", "max_b11", "b12_b11_ratio", "radiance", "sun_elevation")


_UTM = """
WITH p AS (SELECT id, radians(lat) AS phi, radians(lon) - radians(57e0) AS dl FROM fx_detections),
k AS (SELECT 1e0/298.257223563e0 AS f), e AS (SELECT 2e0*f - f*f AS e2 FROM k),
s AS (SELECT id, phi, e2, e2/(1e0-e2) AS ep2, 6378137e0/sqrt(1e0-e2*sin(phi)*sin(phi)) AS n, tan(phi)*tan(phi) AS t, e2/(1e0-e2)*cos(phi)*cos(phi) AS c, cos(phi)*dl AS a FROM p, e),
m AS (SELECT *, 6378137e0*((1e0-e2/4e0-3e0*e2*e2/64e0-5e0*e2*e2*e2/256e0)*phi-(3e0*e2/8e0+3e0*e2*e2/32e0+45e0*e2*e2*e2/1024e0)*sin(2e0*phi)+(15e0*e2*e2/256e0+45e0*e2*e2*e2/1024e0)*sin(4e0*phi)-(35e0*e2*e2*e2/3072e0)*sin(6e0*phi)) AS m FROM s)
SELECT id, round(0.9996e0*n*(a+(1e0-t+c)*a*a*a/6e0+(5e0-18e0*t+t*t+72e0*c-58e0*ep2)*pow(a,5)/120e0)+500000e0, 4) AS easting,
  round(0.9996e0*(m+n*tan(phi)*(a*a/2e0+(5e0-t+9e0*c+4e0*c*c)*pow(a,4)/24e0+(61e0-58e0*t+t*t+600e0*c-330e0*ep2)*pow(a,6)/720e0)), 4) AS northing FROM m"""


@query(_UTM)
def utm_forward(spark, sf):
    east, north = geo.to_utm(F.col("lon"), F.col("lat"), 40, True)
    return over(spark, sf, "fx_detections").select("id", F.round(east, 4).alias("easting"), F.round(north, 4).alias("northing"))


@query("SELECT id, round(lon, 7) AS lon, round(lat, 7) AS lat FROM fx_detections")
def utm_round_trip(spark, sf):
    d = over(spark, sf, "fx_detections")
    east, north = geo.to_utm(F.col("lon"), F.col("lat"), 39, True)
    lon, lat = geo.from_utm(F.col("east"), F.col("north"), 39, True)
    return d.select("id", east.alias("east"), north.alias("north")).select("id", F.round(lon, 7).alias("lon"), F.round(lat, 7).alias("lat"))


@query("SELECT id, cast(lpad(cast(o_orderkey % 60 + 1 AS string), 2, '0') AS string) || substr('CDMNPX', cast(o_orderkey % 6 + 1 AS int), 1) || 'AB' AS grid, cast(CASE WHEN o_orderkey % 6 >= 3 THEN 32600 ELSE 32700 END + o_orderkey % 60 + 1 AS int) AS epsg FROM fx_scenes")
def mgrs_epsg(spark, sf):
    k = F.col("o_orderkey")
    grid = F.concat(F.lpad((k % 60 + 1).cast("string"), 2, "0"), F.substring(F.lit("CDMNPX"), (k % 6 + 1).cast("int"), F.lit(1)), F.lit("AB"))
    return over(spark, sf, "fx_scenes").select("id", grid.alias("grid")).select("id", "grid", geo.epsg_of_tile(F.concat(F.lit("MGRS-"), F.col("grid"))).cast("int").alias("epsg"))


@query("""SELECT id, round(west - 2e0/(111e0*cos(radians((south + south + 1e0)/2e0))), 6) AS west, round(south - 2e0/111e0, 6) AS south, round(west + 1e0 + 2e0/(111e0*cos(radians((south + south + 1e0)/2e0))), 6) AS east,
  round(south + 1e0 + 2e0/111e0, 6) AS north, round(111e0*111e0*cos(radians(south + 5e-1)), 4) AS area_km2, round(150e0/110540e0, 9) AS lat_150m, round(150e0/(111320e0*cos(radians(south))), 9) AS lon_150m FROM fx_scenes""")
def box_metrics(spark, sf):
    d = over(spark, sf, "fx_scenes").withColumns({"east": F.col("west") + 1, "north": F.col("south") + 1})
    w, s, e, n = geo.pad_box(F.col("west"), F.col("south"), F.col("east"), F.col("north"), 2.0)
    area = geo.box_area_km2(F.col("west"), F.col("south"), F.col("east"), F.col("north"))
    return d.select("id", F.round(w, 6).alias("west"), F.round(s, 6).alias("south"), F.round(e, 6).alias("east"), F.round(n, 6).alias("north"), F.round(area, 4).alias("area_km2"), F.round(geo.lat_degrees(150), 9).alias("lat_150m"), F.round(geo.lon_degrees(150, F.col("south")), 9).alias("lon_150m"))


@query("SELECT id, cast(round(lon/1e-3) AS bigint) AS i, cast(round(lat/1e-3) AS bigint) AS j, printf('%.3f,%.3f', round(lon/1e-3)*1e-3, round(lat/1e-3)*1e-3) AS key FROM fx_detections")
def snap_cells(spark, sf):
    lon, lat = F.col("lon"), F.col("lat")
    return over(spark, sf, "fx_detections").select("id", geo.cell(lon).alias("i"), geo.cell(lat).alias("j"), geo.cell_key(lon, lat).alias("key"))


@query("SELECT id, CASE WHEN sun_elevation IS NULL THEN NULL ELSE 9e1 - sun_elevation END AS glint_angle, CASE WHEN sun_elevation IS NULL THEN NULL WHEN 9e1 - sun_elevation <= 25e0 THEN 1e0 WHEN 9e1 - sun_elevation >= 65e0 THEN 0e0 ELSE (65e0 - (9e1 - sun_elevation))/4e1 END AS glint FROM fx_detections")
def glint_scores(spark, sf):
    return over(spark, sf, "fx_detections").select("id", score.glint_angle(F.col("sun_elevation")).alias("glint_angle"), score.glint_of_elevation(F.col("sun_elevation")).alias("glint"))


_SITE = """
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY site_key, date ORDER BY max_b12 DESC, event_id) AS n FROM fx_detections) WHERE n = 1),
shaped AS (SELECT *, CASE WHEN max_b11 > 0 THEN max_b12/max_b11 END AS r, CASE WHEN sun_elevation IS NULL THEN NULL WHEN sun_elevation >= 65e0 THEN 1e0 WHEN sun_elevation <= 25e0 THEN 0e0 ELSE (sun_elevation - 25e0)/4e1 END AS g FROM best),
sites AS (SELECT site_key, max(max_b12) AS max_b12, avg(max_b12) AS avg_b12, median(radiance) AS radiance, count(*) AS date_count, bool_and(cast(substr(date,6,2) AS int) BETWEEN 4 AND 8) AS seasonal, median(r) AS median_ratio,
  min(sun_elevation) AS min_sun, max(coalesce(b12_b11_ratio, r)) AS max_ratio, min(g) AS min_glint FROM shaped GROUP BY site_key HAVING count(*) >= 2 AND avg(max_b12) >= 0.5e0),
anchors AS (SELECT site_key, id AS leader_id, lon, lat FROM (SELECT *, row_number() OVER (PARTITION BY site_key ORDER BY max_b12 DESC, event_id) AS n FROM fx_detections) WHERE n = 1),
scored AS (SELECT *, CASE WHEN max_ratio IS NULL THEN 0e0 ELSE greatest(0e0, least(1e0, (max_ratio - 1.1e0)/0.6e0)) END AS ratio_score, CASE WHEN min_glint IS NULL THEN 0e0 ELSE -0.4e0*min_glint + 0e0 END AS glint_penalty FROM sites)"""


@query("WITH" + _SITE + """
SELECT leader_id, lon, lat, max_b12, round(avg_b12*date_count, 4) AS sum_b12, round(radiance, 6) AS radiance, date_count, seasonal, round(median_ratio, 10) AS median_b12_b11_ratio, min_sun AS min_sun_elevation, round(max_ratio, 10) AS max_ratio, round(min_glint, 6) AS min_glint,
  median_ratio < 1.25e0 AS likely_glint, coalesce(min_glint >= 0.6e0 AND max_ratio < 1.3e0 AND date_count <= 1, false) AS glint_suspect, round(ratio_score, 6) AS ratio_score, round(glint_penalty, 6) AS glint_penalty, round(0.5e0*ratio_score + glint_penalty, 6) AS total_score
FROM scored JOIN anchors USING (site_key)""")
def cluster_sites(spark, sf):
    sites, _ = C.cluster(over(spark, sf, "fx_detections"), C.ClusterOptions.command(), ("event_id",))
    return sites.select("leader_id", "lon", "lat", "max_b12", F.round(F.col("avg_b12") * F.col("date_count"), 4).alias("sum_b12"), r6("radiance"), "date_count", "seasonal", F.round("median_b12_b11_ratio", 10).alias("median_b12_b11_ratio"), "min_sun_elevation", F.round("max_ratio", 10).alias("max_ratio"), r6("min_glint"), "likely_glint", "glint_suspect", r6("ratio_score"), r6("glint_penalty"), r6("total_score"))


@query("WITH" + _SITE + " SELECT d.id, leader_id, date FROM fx_detections d JOIN anchors USING (site_key) WHERE site_key IN (SELECT site_key FROM sites)")
def cluster_members(spark, sf):
    return C.cluster(over(spark, sf, "fx_detections"), C.ClusterOptions.command(), ("event_id",))[1].select("id", "leader_id", "date")


@query()
def cluster_sites_chained(spark, sf):
    """Fields where order decides who leads: beyond SQL, held against a sequential replay in tests."""
    sites, _ = C.cluster(over(spark, sf, "fx_chained"), C.ClusterOptions.command(), ("event_id",))
    return sites.select("id", "leader_id", "lon", "lat", "date_count", r6("avg_b12"), "flags")


@query("SELECT id, date, site_key, max_b12 FROM (SELECT *, row_number() OVER (PARTITION BY site_key, date ORDER BY max_b12 DESC, event_id) AS n FROM fx_detections) WHERE n = 1")
def best_detection_of_date(spark, sf):
    d = over(spark, sf, "fx_detections").withColumn("leader_id", F.col("site_key")).withColumn("rank", F.col("event_id"))
    return C.best_of_date(d).select("id", "date", "site_key", "max_b12")


@query("SELECT id, list_reduce(list_transform(string_split(printf('%.4f,%.4f', lat, lon), ''), lambda c: cast(ascii(c) AS bigint)), lambda h, b: (h*31 + b) & 4294967295) AS site_hash FROM fx_detections")
def cluster_hash(spark, sf):
    return over(spark, sf, "fx_detections").select("id", text.site_hash_number(F.col("lat"), F.col("lon")).alias("site_hash"))


@query("SELECT id, cast(substr(date, 6, 2) AS int) BETWEEN 4 AND 8 AS seasonal FROM fx_scenes")
def seasonal_flag(spark, sf):
    return over(spark, sf, "fx_scenes").select("id", C.in_season(F.col("date")).alias("seasonal"))


@query("""SELECT id, concat_ws(';', CASE WHEN event_id % 2 = 0 THEN 'seasonal' END, CASE WHEN b12_b11_ratio < 1.25e0 THEN 'likely_glint' END, CASE WHEN sun_elevation > 49e0 THEN 'glint_suspect' END) AS flags FROM fx_detections""")
def site_flags(spark, sf):
    c = F.col
    return over(spark, sf, "fx_detections").select("id", F.array_join(C.site_flags(c("event_id") % 2 == 0, c("b12_b11_ratio") < 1.25, c("sun_elevation") > 49), ";").alias("flags"))


@query("SELECT DISTINCT c.* FROM fx_clouds c WHERE EXISTS (SELECT 1 FROM fx_detections d WHERE cast(round(d.lon/1e-3) AS bigint) = c.i AND cast(round(d.lat/1e-3) AS bigint) = c.j)")
def cloud_semi_join(spark, sf):
    d = over(spark, sf, "fx_detections").select(geo.cell(F.col("lon")).alias("i"), geo.cell(F.col("lat")).alias("j"))
    return C.near_mask(over(spark, sf, "fx_clouds"), d)


_LOOKS = _SITE + """,
centres AS (SELECT site_key, leader_id, cast(round(lon/1e-3) AS bigint) AS i, cast(round(lat/1e-3) AS bigint) AS j FROM anchors WHERE site_key IN (SELECT site_key FROM sites)),
clear AS (SELECT DISTINCT i, j, date FROM fx_clouds WHERE coalesce(cloud, 1e0) <= 0.1e0),
near AS (SELECT s.site_key, k.date, k.i = s.i AND k.j = s.j AS own FROM centres s JOIN clear k ON k.i BETWEEN s.i - 1 AND s.i + 1 AND k.j BETWEEN s.j - 1 AND s.j + 1),
owns AS (SELECT DISTINCT site_key FROM near WHERE own),
looks AS (SELECT site_key, date FROM near WHERE own OR site_key NOT IN (SELECT site_key FROM owns) UNION SELECT site_key, date FROM fx_detections WHERE site_key IN (SELECT site_key FROM sites)),
counts AS (SELECT site_key, count(*) AS n_obs FROM looks GROUP BY site_key)"""


@query("WITH" + _LOOKS + " SELECT leader_id, n_obs FROM centres JOIN counts USING (site_key)")
def clear_obs_fallback(spark, sf):
    sites, members = C.cluster(over(spark, sf, "fx_detections"), C.ClusterOptions.command(), ("event_id",))
    return C.clear_looks(sites, over(spark, sf, "fx_clouds"), members).select("leader_id", F.col("n_obs").cast("long").alias("n_obs"))


_RESCORED = "WITH" + _LOOKS + """, re AS (SELECT *, least(1e0, date_count/cast(greatest(n_obs, date_count) AS double)) AS p FROM scored JOIN counts USING (site_key) JOIN anchors USING (site_key))"""


@query(_RESCORED + " SELECT leader_id, date_count, n_obs, round(p, 6) AS persistence_score, round(0.5e0*ratio_score + 0.4e0*p*(0.1e0 + 0.9e0*ratio_score) + glint_penalty, 6) AS total_score FROM re")
def clouds_rescore(spark, sf):
    sites, _ = commands.cluster_command(over(spark, sf, "fx_detections"), over(spark, sf, "fx_clouds"), order=("event_id",))
    return sites.select("leader_id", "date_count", F.col("n_obs").cast("long").alias("n_obs"), r6("persistence_score"), r6("total_score"))


@query(_RESCORED + " SELECT cast(row_number() OVER (ORDER BY round(0.5e0*ratio_score + 0.4e0*p*(0.1e0 + 0.9e0*ratio_score) + glint_penalty, 6) DESC, leader_id) AS int) AS place, leader_id, lon, lat, round(0.5e0*ratio_score + 0.4e0*p*(0.1e0 + 0.9e0*ratio_score) + glint_penalty, 6) AS score FROM re ORDER BY 5 DESC, leader_id LIMIT 100")
def sites_ranked(spark, sf):
    """The flagship: a report of the hundred sites that score highest."""
    sites, _ = commands.cluster_command(over(spark, sf, "fx_detections"), over(spark, sf, "fx_clouds"), order=("event_id",))
    top = sites.select("leader_id", "lon", "lat", F.round("total_score", 6).alias("score")).orderBy(F.desc("score"), "leader_id").limit(100)
    from pyspark.sql import Window

    return top.withColumn("place", F.row_number().over(Window.orderBy(F.desc("score"), "leader_id"))).select("place", "leader_id", "lon", "lat", "score")


@query("""WITH s AS (SELECT id, b12_b11_ratio AS r, event_id % 14 AS dates, event_id % 9 AS obs, CASE WHEN event_id % 5 = 0 THEN NULL ELSE (event_id % 7)/5e0 END AS g FROM fx_detections),
t AS (SELECT *, CASE WHEN r IS NULL THEN 0e0 ELSE greatest(0e0, least(1e0, (r - 1.1e0)/0.6e0)) END AS a, CASE WHEN obs <= 0 THEN 0e0 ELSE least(1e0, dates/cast(obs AS double)) END AS b, CASE WHEN g IS NULL THEN 0e0 ELSE -0.4e0*least(1e0, g) + 0e0 END AS c FROM s)
SELECT id, round(a, 6) AS ratio_score, round(b, 6) AS persistence_score, round(c, 6) AS glint_penalty, round(0.5e0*a + 0.4e0*b*(0.1e0 + 0.9e0*a) + c, 6) AS total_score, coalesce(g >= 0.6e0 AND r < 1.3e0 AND dates <= 1, false) AS suspect FROM t""")
def cluster_score(spark, sf):
    k = F.col("event_id")
    d = over(spark, sf, "fx_detections").select("id", F.col("b12_b11_ratio").alias("r"), (k % 14).cast("double").alias("dates"), (k % 9).cast("double").alias("obs"), F.when(k % 5 != 0, (k % 7) / 5.0).alias("g"))
    s = score.scores(F.col("r"), F.col("dates"), F.col("obs"), F.col("g"))
    return d.select("id", *(F.round(c, 6).alias(n) for n, c in s.items()), score.glint_suspect(F.col("g"), F.col("r"), F.col("dates")).alias("suspect"))


_TRIAGE = """
WITH c AS (SELECT * FROM fx_candidates),
pairs AS (SELECT DISTINCT a.key FROM c a JOIN c b ON a.target = b.target AND a.date <> b.date
  WHERE sqrt(pow((b.centre_lon - a.centre_lon)*111320e0*cos(radians((a.centre_lat + b.centre_lat)/2e0)), 2) + pow((b.centre_lat - a.centre_lat)*110540e0, 2)) < 250e0
  AND CASE WHEN sqrt(a.wu*a.wu + a.wv*a.wv) > 0 AND sqrt(b.wu*b.wu + b.wv*b.wv) > 0 THEN degrees(acos(greatest(-1e0, least(1e0, (a.wu*b.wu + a.wv*b.wv)/(sqrt(a.wu*a.wu + a.wv*a.wv)*sqrt(b.wu*b.wu + b.wv*b.wv)))))) > 45e0 ELSE false END),
days AS (SELECT date, count(DISTINCT target) AS targets FROM c GROUP BY date),
m AS (SELECT c.*, c.key IN (SELECT key FROM pairs) AS recurrent, targets, (centre_lon - origin_lon)*111320e0*cos(radians((origin_lat + centre_lat)/2e0)) AS dx, (centre_lat - origin_lat)*110540e0 AS dy FROM c JOIN days USING (date)),
g AS (SELECT *, sqrt(dx*dx + dy*dy) AS len, sqrt(wu*wu + wv*wv) AS speed FROM m),
t AS (SELECT *, CASE WHEN len >= 30e0 AND speed > 0 THEN degrees(acos(greatest(-1e0, least(1e0, (dx*wu + dy*wv)/(len*speed))))) END AS tail FROM g),
f AS (SELECT key, target, date,
  concat_ws(';', CASE WHEN max_p < 0.6e0 THEN 'p-floor' END, CASE WHEN flux_kg_h <= 1e0 THEN 'zero-flux' END, CASE WHEN recurrent THEN 'recurrent' END, CASE WHEN collinearity >= 0.5e0 THEN 'collinear' END) AS rejects,
  concat_ws(';', CASE WHEN collinearity >= 0.25e0 AND collinearity < 0.5e0 THEN 'boundary' END, CASE WHEN anchor_m > 500e0 THEN 'unanchored' END, CASE WHEN tail > 60e0 THEN 'crosswind' END, CASE WHEN len < 30e0 AND speed >= 5e0 THEN 'static' END,
    CASE WHEN targets >= 2 THEN 'scene-regime' END, CASE WHEN flux_kg_h > 20000e0 THEN 'magnitude' END, CASE WHEN sun_elevation < 20e0 THEN 'low-sun' END, CASE WHEN clear_percent < 40e0 THEN 'cloud-residue' END, CASE WHEN cross_orbit_bg THEN 'cross-orbit-bg' END) AS flags,
  (CASE WHEN collinearity >= 0.25e0 AND collinearity < 0.5e0 THEN 25 ELSE 0 END) + (CASE WHEN anchor_m > 500e0 THEN 25 ELSE 0 END) + (CASE WHEN tail > 60e0 THEN 25 ELSE 0 END) + (CASE WHEN len < 30e0 AND speed >= 5e0 THEN 20 ELSE 0 END) + (CASE WHEN targets >= 2 THEN 20 ELSE 0 END)
    + (CASE WHEN flux_kg_h > 20000e0 THEN 20 ELSE 0 END) + (CASE WHEN sun_elevation < 20e0 THEN 15 ELSE 0 END) + (CASE WHEN clear_percent < 40e0 THEN 10 ELSE 0 END) + (CASE WHEN cross_orbit_bg THEN 25 ELSE 0 END) AS lost FROM t),
v AS (SELECT key, rejects, flags, CASE WHEN rejects <> '' THEN 0e0 ELSE greatest(0, 100 - lost)/100e0 END AS score FROM f)"""


@query(_TRIAGE + " SELECT key, rejects FROM v")
def triage_rejects(spark, sf):
    return R.triage(over(spark, sf, "fx_candidates")).select("key", F.array_join("rejects", ";").alias("rejects"))


@query(_TRIAGE + " SELECT key, flags, round(score, 6) AS score FROM v")
def triage_flags(spark, sf):
    return R.triage(over(spark, sf, "fx_candidates")).select("key", F.array_join("flags", ";").alias("flags"), r6("score"))


@query(_TRIAGE + " SELECT cast(row_number() OVER (ORDER BY rejects <> '', score DESC, key) AS int) AS place, key, CASE WHEN rejects <> '' THEN 'reject' ELSE 'keep' END AS verdict FROM v")
def triage_rank(spark, sf):
    d = R.triage(over(spark, sf, "fx_candidates")).select("key", "verdict", "score", "rejects")
    return R.numbered(d, F.size("rejects") > 0, F.desc("score"), "key").select("place", "key", "verdict")


@query("SELECT key, date, targets FROM fx_candidates JOIN (SELECT date, count(DISTINCT target) AS targets FROM fx_candidates GROUP BY date) USING (date)")
def same_day_targets(spark, sf):
    return R.same_day_targets(over(spark, sf, "fx_candidates")).select("key", "date", F.col("targets").cast("long").alias("targets"))


@query("""WITH o AS (SELECT target AS site_id, date, min(clear_percent)/1e2 AS cloud FROM fx_candidates GROUP BY target, date)
SELECT concat(c.target, ':', c.date, ':', string_split(c.key, ':')[-1]) AS key, c.target, round(least(greatest(origin_lon, centre_lon - 1e-3), centre_lon + 1e-3), 6) AS origin_lon, round(least(greatest(origin_lat, centre_lat - 1e-3), centre_lat + 1e-3), 6) AS origin_lat,
  wu, wv, round((1e0 - cloud)*1e2, 6) AS clear_percent, cross_orbit_bg FROM fx_candidates c LEFT JOIN o ON c.target = o.site_id AND c.date = o.date WHERE flux_kg_h > 0""")
def review_join(spark, sf):
    c = over(spark, sf, "fx_candidates")
    found = c.select(
        F.col("key").alias("id"), F.col("target").alias("site_id"), "date", F.lit("plume").alias("kind"), F.lit("own").alias("provider"), F.when(F.col("flux_kg_h") > 0, "ok").otherwise("cloudy").alias("status"),
        "centre_lon", "centre_lat", F.col("origin_lon").alias("site_lon"), F.col("origin_lat").alias("site_lat"), (F.col("centre_lon") - 1e-3).alias("west"), (F.col("centre_lat") - 1e-3).alias("south"), (F.col("centre_lon") + 1e-3).alias("east"), (F.col("centre_lat") + 1e-3).alias("north"),
        F.array("wu", "wv").alias("wind"), "max_p", "flux_kg_h", "sun_elevation", F.lit("S2A_X_R037_T").alias("scene"), F.when(F.col("cross_orbit_bg"), "S2A_X_R080_T").otherwise("S2A_X_R037_T").alias("background_scene"),
    )
    looks = c.groupBy(F.col("target").alias("site_id"), "date").agg((F.min("clear_percent") / 100).alias("cloud")).withColumns({"kind": F.lit("plume"), "provider": F.lit("own")})
    return R.candidates_of(found, looks, "own").select("key", "target", r6("origin_lon"), r6("origin_lat"), "wu", "wv", r6("clear_percent"), "cross_orbit_bg")


@query("SELECT id, regexp_extract(id, '(R[0-9]{3})', 1) AS orbit, regexp_replace(replace(id, '_', '/'), '[^A-Za-z0-9_-]', '_', 'g') AS safe, concat(mgrs, ':', date, ':', cast(o_orderkey AS string)) AS key FROM fx_scenes")
def scene_tokens(spark, sf):
    d = over(spark, sf, "fx_scenes")
    return d.select("id", text.orbit_token(F.col("id")).alias("orbit"), text.safe_id(F.replace(F.col("id"), F.lit("_"), F.lit("/"))).alias("safe"), text.plume_key(F.col("mgrs"), F.col("date"), F.col("o_orderkey").cast("string")).alias("key"))


@query("SELECT key, string_split(key, ':')[-1] AS plume, cast(coalesce(nullif(regexp_extract(key, 'plume-([0-9]+)', 1), ''), '0') AS bigint) AS number, round((1e0 - clear_percent/1e2)*1e2, 6) AS cloud_percent FROM fx_candidates")
def key_parts(spark, sf):
    d = over(spark, sf, "fx_candidates")
    return d.select("key", F.element_at(F.split("key", ":"), -1).alias("plume"), F.regexp_extract("key", "plume-([0-9]+)", 1).cast("long").alias("number"), F.round((1 - F.col("clear_percent") / 100) * 100, 6).alias("cloud_percent"))


@query("WITH" + _SITE + " SELECT lon, lat, round(0.5e0*ratio_score + glint_penalty, 6) AS score, CASE WHEN seasonal THEN 1 ELSE 0 END + CASE WHEN median_ratio < 1.25e0 THEN 1 ELSE 0 END AS n_flags, max_b12 AS cluster_max_b12 FROM scored JOIN anchors USING (site_key)")
def cluster_table(spark, sf):
    sites, _ = C.cluster(over(spark, sf, "fx_detections"), C.ClusterOptions.command(), ("event_id",))
    return records.cluster_table(sites).select("lon", "lat", r6("score"), F.size("flags").alias("n_flags"), "cluster_max_b12")


@query(_TRIAGE + " SELECT v.key, CASE WHEN rejects <> '' THEN 'reject' ELSE 'keep' END AS verdict, printf('%.2f', score) AS score, rejects, flags, CASE WHEN cross_orbit_bg THEN 'cross' ELSE 'same' END AS orbit FROM v JOIN fx_candidates USING (key)")
def review_table(spark, sf):
    return records.review_table(R.triage(over(spark, sf, "fx_candidates"))).select("key", "verdict", "score", "rejects", "flags", "orbit")


@query("SELECT cast(event_id AS bigint) AS id, CASE WHEN json_valid(props) THEN json_extract_string(props, '$.k') END AS k FROM events")
def props_json(spark, sf):
    return table(spark, sf, "events").select(F.col("event_id").cast("long").alias("id"), F.get_json_object("props", "$.k").alias("k"))
