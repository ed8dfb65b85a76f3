"""Registered queries on pixels, components and plumes."""

from __future__ import annotations

import os
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixtures import over, sql, table
from ..operators import kernels as K
from ..operators import plume as P
from ..operators import raster as A
from ..operators import review as R

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if oracle:
            ORACLE_SQL[f.__name__] = sql(oracle)
        return f

    return add


def _pixels(spark, sf) -> DataFrame:
    return over(spark, sf, "fx_pixels")


@query("SELECT vec_id, r, c, CASE WHEN cast(floor(abs(v)*1e4) AS bigint) = 0 THEN 0e0 ELSE (cast(floor(abs(v)*1e4) AS bigint) - 1e3)/1e4 END AS reflectance FROM fx_pixels")
def calibrate_reflectance(spark, sf):
    return _pixels(spark, sf).select("vec_id", "r", "c", A.reflectance(F.floor(F.abs("v") * 1e4)).alias("reflectance"))


_BANDS = "SELECT vec_id, r, c, abs(v)*2e0 AS b12, 2e-1 + abs(v)*1.1e0 AS b11, CASE WHEN vec_id % 3 = 0 THEN NULL ELSE 3e-1 + v END AS b8a FROM fx_pixels"
_HOT = f"""WITH p AS ({_BANDS}), m AS (SELECT vec_id, percentile_disc(0.5) WITHIN GROUP (ORDER BY b12 DESC) AS bg FROM p WHERE b12 < 0.3e0 GROUP BY vec_id HAVING count(*) >= 10),
h AS (SELECT p.*, coalesce(b12 > 0.3e0 AND b11 > 0.2e0 AND b12 > greatest(bg, 0.15e0)*3e0 AND CASE WHEN b8a IS NULL THEN b11 > 1e0 ELSE (CASE WHEN b11 + b8a > 0.01e0 THEN (b11 - b8a)/(b11 + b8a) ELSE 0e0 END > 0 OR b11 > 1e0 OR b12 > 1e0) END, false) AS hot FROM p LEFT JOIN m USING (vec_id))"""


def _bands(spark, sf) -> DataFrame:
    v, k = F.col("v"), F.col("vec_id")
    return _pixels(spark, sf).select("vec_id", "r", "c", (F.abs(v) * 2.0).alias("b12"), (0.2 + F.abs(v) * 1.1).alias("b11"), F.when(k % 3 != 0, 0.3 + v).alias("b8a"))


@query(_HOT + " SELECT vec_id, r, c, hot FROM h")
def spectral_mask(spark, sf):
    return A.spectral_mask(_bands(spark, sf), "vec_id").select("vec_id", "r", "c", "hot")


@query("SELECT vec_id, percentile_disc(0.5) WITHIN GROUP (ORDER BY v DESC) AS upper, percentile_disc(0.5) WITHIN GROUP (ORDER BY v) AS lower, round(median(v), 10) AS middle FROM fx_pixels GROUP BY vec_id")
def medians(spark, sf):
    return _pixels(spark, sf).groupBy("vec_id").agg(A.upper_median("v").alias("upper"), A.lower_median("v").alias("lower"), F.round(F.median("v"), 10).alias("middle"))


_CLASS = "SELECT vec_id, r, c, cast(floor(abs(v)*4e1) AS int) % 12 AS scl FROM fx_pixels"


def _classes(spark, sf) -> DataFrame:
    return _pixels(spark, sf).select("vec_id", "r", "c", (F.floor(F.abs("v") * 40).cast("int") % 12).alias("scl"))


@query(f"WITH p AS ({_CLASS}), s AS (SELECT vec_id, avg(CASE WHEN scl IN (3, 8, 9, 10) THEN 1e0 ELSE 0e0 END) AS f FROM p GROUP BY vec_id) SELECT vec_id, f > 0.75e0 AS skip, f <= 0.3e0 AS cloud_free FROM s")
def cloud_screen_blocks(spark, sf):
    return A.screened(_classes(spark, sf), ["vec_id"])


@query("SELECT vec_id FROM (SELECT vec_id, max(cast(floor(abs(v)*2e4) AS bigint)) AS top FROM fx_pixels GROUP BY vec_id) WHERE top >= 4000")
def hot_prescreen(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda x: F.floor(F.abs(x.cast("double")) * 2e4).cast("int")).alias("b12"))
    return A.prescreen(e).select("vec_id")


def _components(corners: bool) -> str:
    step = "abs(a.r - b.r) <= 1 AND abs(a.c - b.c) <= 1" if corners else "abs(a.r - b.r) + abs(a.c - b.c) = 1"
    return f"""WITH RECURSIVE p AS (SELECT vec_id, r, c, abs(v)*2e0 AS b12 FROM fx_pixels WHERE v > 0.1e0),
t AS (SELECT vec_id, r, c, r*8 + c AS root FROM p UNION SELECT b.vec_id, b.r, b.c, a.root FROM t a JOIN p b ON a.vec_id = b.vec_id AND {step}),
l AS (SELECT vec_id, r, c, min(root) AS root FROM t GROUP BY vec_id, r, c)"""


def _above(spark, sf) -> DataFrame:
    return _pixels(spark, sf).filter("v > 0.1").select("vec_id", "r", "c", (F.abs("v") * 2.0).alias("b12"))


@query(_components(False) + " SELECT vec_id, r, c, cast(root AS int) AS root FROM l")
def connected_components4(spark, sf):
    return A.pixel_components(_above(spark, sf), "vec_id").select("vec_id", "r", "c", (F.col("component.r") * 8 + F.col("component.c")).alias("root"))


@query(_components(True) + " SELECT vec_id, r, c, cast(root AS int) AS root FROM l")
def connected_components8(spark, sf):
    return A.pixel_components(_above(spark, sf), "vec_id", True).select("vec_id", "r", "c", (F.col("component.r") * 8 + F.col("component.c")).alias("root"))


@query(_components(False) + " SELECT vec_id, r, c, cast(dense_rank() OVER (PARTITION BY vec_id ORDER BY root) AS int) AS label FROM l")
def component_labels(spark, sf):
    return A.component_rows(_above(spark, sf), "vec_id")


_TOTALS = _components(False) + """, g AS (SELECT vec_id, root, count(*) AS pixels, sum(b12) AS total, max(b12) AS peak, min(r) AS r0, max(r) AS r1, min(c) AS c0, max(c) AS c1 FROM l JOIN p USING (vec_id, r, c) GROUP BY vec_id, root),
a AS (SELECT vec_id, root, r AS peak_r, c AS peak_c FROM (SELECT vec_id, root, r, c, row_number() OVER (PARTITION BY vec_id, root ORDER BY b12 DESC, r, c) AS n FROM l JOIN p USING (vec_id, r, c)) WHERE n = 1)"""


def _totals(spark, sf) -> DataFrame:
    p = _above(spark, sf)
    return A.component_totals(p.join(A.pixel_components(p, "vec_id"), ["vec_id", "r", "c"]), "vec_id").withColumn("root", F.col("component.r") * 8 + F.col("component.c"))


@query(_TOTALS + " SELECT vec_id, cast(root AS int) AS root, pixels, round(total, 6) AS total, peak, peak_r, peak_c, r0, r1, c0, c1 FROM g JOIN a USING (vec_id, root)")
def component_aggregates(spark, sf):
    return _totals(spark, sf).select("vec_id", "root", "pixels", F.round("total", 6).alias("total"), "peak", F.col("at.r").alias("peak_r"), F.col("at.c").alias("peak_c"), "r0", "r1", "c0", "c1")


@query(_TOTALS + " SELECT vec_id, cast(root AS int) AS root FROM g WHERE pixels <= 80 AND peak >= 0.5e0 AND NOT (pixels > 30 AND peak < 0.7e0) AND NOT (pixels > 1 AND peak < 1.15e0*(total/pixels) AND total/pixels < 1e0) AND NOT (pixels = 1 AND peak < 0.65e0)")
def morphology_gates(spark, sf):
    return A.gates(_totals(spark, sf)).select("vec_id", "root")


@query("""WITH RECURSIVE p AS (SELECT vec_id, r, c, abs(v)*2e0 AS b12 FROM fx_pixels WHERE v > 0.1e0), x AS (SELECT vec_id, r, c, b12 FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY b12 DESC, r, c) AS n FROM p) WHERE n = 1),
k AS (SELECT vec_id, b12*0.5e0 AS cut FROM x), t AS (SELECT vec_id, r, c FROM x UNION SELECT b.vec_id, b.r, b.c FROM t a JOIN p b ON a.vec_id = b.vec_id AND abs(a.r - b.r) + abs(a.c - b.c) = 1 JOIN k ON b.vec_id = k.vec_id WHERE b.b12 > k.cut)
SELECT vec_id, count(*) AS pixels FROM t GROUP BY vec_id""")
def hot_core(spark, sf):
    """The core around each raster's peak: its component among pixels above half the peak."""
    p = _above(spark, sf)
    top = p.groupBy("vec_id").agg(F.min_by(F.struct("r", "c", "b12"), F.struct(-F.col("b12"), "r", "c")).alias("peak"))
    warm = p.join(top, "vec_id").filter("b12 > peak.b12 * 0.5D")
    core = A.pixel_components(warm, "vec_id")
    at = core.join(top, "vec_id").filter("r = peak.r and c = peak.c").select("vec_id", F.col("component").alias("own"))
    return core.join(at, "vec_id").filter("component = own").groupBy("vec_id").agg(F.count("*").alias("pixels"))


def _blocks(spark, sf) -> DataFrame:
    n = F.col("vec_id")
    dn = lambda f: F.transform("embedding", lambda x: (F.abs(x.cast("double")) * f + 1100).cast("int"))
    base = table(spark, sf, "embeddings").select("vec_id", "embedding").withColumns({"b12": dn(30000.0), "b11": dn(20000.0), "b8a": F.when(n % 3 != 0, dn(9000.0)), "scl": F.when(n % 5 != 0, F.transform("embedding", lambda x: (F.floor(F.abs(x.cast("double")) * 40).cast("int") % 12)))})
    return base.select(n.cast("string").alias("scene"), F.lit(0).alias("br"), F.lit(0).alias("bc"), F.lit(0).alias("x0"), F.lit(0).alias("y0"), F.lit(8).alias("width"), F.lit(8).alias("height"), "b12", "b11", "b8a", "scl")


@query()
def detect_block(spark, sf):
    """The whole detector on 8 x 8 blocks; its kernel is held against plain loops in tests."""
    return A.detect_blocks(_blocks(spark, sf))


@query("""WITH d AS (SELECT id, cast(o_orderkey * 37 % 900 AS bigint) AS img_row, cast(o_orderkey * 91 % 900 AS bigint) AS img_col, cast(o_orderkey * 37 % 900 // 256 AS bigint) AS r, cast(o_orderkey * 91 % 900 // 256 AS bigint) AS c, o_orderkey % 2 AS k FROM fx_scenes)
SELECT id, img_row, img_col FROM d WHERE k = 0""")
def canonical_block_dedup(spark, sf):
    k = F.col("o_orderkey")
    d = over(spark, sf, "fx_scenes").select("id", (k * 37 % 900).alias("img_row"), (k * 91 % 900).alias("img_col"), k)
    return A.owned(d.withColumns({"br": F.floor(F.col("img_row") / 256) + k % 2, "bc": F.floor(F.col("img_col") / 256)})).select("id", "img_row", "img_col")


@query("""WITH s AS (SELECT cast(n_nationkey AS bigint) AS scene, 600 + n_nationkey*31 AS w, 500 + n_nationkey*17 AS h FROM nation),
b AS (SELECT scene, w, h, br, bc FROM s, (SELECT unnest(range(0, 8)) AS br), (SELECT unnest(range(0, 8)) AS bc) WHERE br >= 300//256 AND br*256 < h AND bc >= 0 AND bc*256 < w - 50)
SELECT scene, cast(br AS int) AS br, cast(bc AS int) AS bc, cast(greatest(0, bc*256 - 10) AS int) AS x0, cast(greatest(0, br*256 - 10) AS int) AS y0, cast(least(w, (bc + 1)*256 + 10) AS int) AS x1, cast(least(h, (br + 1)*256 + 10) AS int) AS y1 FROM b""")
def enumerate_blocks(spark, sf):
    k = F.col("n_nationkey").cast("int")
    s = table(spark, sf, "nation").select(k.cast("long").alias("scene"), (600 + k * 31).alias("width"), (500 + k * 17).alias("height")).withColumns({"px0": F.lit(0), "py0": F.lit(300), "px1": F.col("width") - 50, "py1": F.col("height")})
    return A.block_lattice(s).select("scene", "br", "bc", *(F.col(n).cast("int").alias(n) for n in ("x0", "y0", "x1", "y1")))


@query("""WITH a AS (SELECT cast(n_nationkey AS bigint) AS area, cast(51000 + n_nationkey*10 AS bigint) AS w, cast(25000 + n_nationkey*7 AS bigint) AS s FROM nation)
SELECT area, w + di AS i, s + dj AS j, printf('%.3f,%.3f', (w + di)*1e-3, (s + dj)*1e-3) AS key FROM a, (SELECT unnest(range(0, 4)) AS di), (SELECT unnest(range(0, 3)) AS dj)""")
def grid_sites(spark, sf):
    k = F.col("n_nationkey")
    a = table(spark, sf, "nation").select(k.cast("long").alias("area"), ((51000 + k * 10) / 1000.0).alias("west"), ((25000 + k * 7) / 1000.0).alias("south"))
    return A.grid_cells(a.withColumns({"east": F.col("west") + 0.003, "north": F.col("south") + 0.002})).select("area", "i", "j", "key")


@query(f"WITH p AS ({_CLASS}) SELECT vec_id, sum(CASE WHEN scl <> 0 THEN 1 ELSE 0 END)::bigint AS valid, sum(CASE WHEN scl = 3 THEN 1 ELSE 0 END)::bigint AS n3, sum(CASE WHEN scl = 8 THEN 1 ELSE 0 END)::bigint AS n8, round(sum(CASE WHEN scl IN (3, 8, 9, 10) THEN 1e0 ELSE 0e0 END)/sum(CASE WHEN scl <> 0 THEN 1e0 ELSE 0e0 END), 6) AS cloud FROM p GROUP BY vec_id HAVING sum(CASE WHEN scl <> 0 THEN 1 ELSE 0 END) > 0")
def scl_histogram(spark, sf):
    h = A.class_histogram(_classes(spark, sf), ["vec_id"])
    return h.select("vec_id", "valid", F.col("hist")[3].alias("n3"), F.col("hist")[8].alias("n8"), F.round(A.cloud_fraction(F.col("hist"), F.col("valid")), 6).alias("cloud"))


@query(f"""WITH p AS ({_CLASS}), s AS (SELECT vec_id AS site, vec_id // 25 * 8 + vec_id % 8 AS sr, vec_id % 25 * 8 + vec_id % 5 AS sc FROM (SELECT DISTINCT vec_id FROM fx_pixels)), m AS (SELECT vec_id // 25 * 8 + r AS r, vec_id % 25 * 8 + c AS c, scl FROM p)
SELECT site, count(CASE WHEN scl <> 0 THEN 1 END) AS valid, count(CASE WHEN scl = 2 THEN 1 END) AS n2 FROM s JOIN m ON r BETWEEN sr - 2 AND sr + 2 AND c BETWEEN sc - 2 AND sc + 2 GROUP BY site HAVING count(CASE WHEN scl <> 0 THEN 1 END) > 0""")
def scl_window_sample(spark, sf):
    """Sites in a mosaic of all rasters, 25 to a row."""
    k = F.col("vec_id")
    top, left = F.floor(k / 25) * 8, k % 25 * 8
    mosaic = _classes(spark, sf).select((top + F.col("r")).alias("r"), (left + F.col("c")).alias("c"), "scl")
    sites = table(spark, sf, "embeddings").select(k.alias("site"), (top + k % 8).alias("r"), (left + k % 5).alias("c"))
    return A.sample_mask(sites, mosaic).select("site", "valid", F.col("hist")[2].alias("n2"))


@query("SELECT a.vec_id, a.r, a.c, round(avg(CASE WHEN b.v > 0.1e0 THEN 1e0 ELSE 0e0 END), 6) AS share FROM fx_pixels a JOIN fx_pixels b ON a.vec_id = b.vec_id AND b.r BETWEEN a.r - 2 AND a.r + 2 AND b.c BETWEEN a.c - 2 AND a.c + 2 GROUP BY a.vec_id, a.r, a.c")
def local_cloud_share(spark, sf):
    p = _pixels(spark, sf).withColumn("flag", F.col("v") > 0.1)
    return A.local_share(p, "vec_id", "flag", 2).select("vec_id", "r", "c", F.round("share", 6).alias("share"))


@query("SELECT a.vec_id, round(avg(abs(a.v - b.v*(ma/mb))), 6) AS difference, round(corr(a.v, b.v), 6) AS correlation FROM fx_pixels a JOIN fx_pixels b ON b.vec_id = a.vec_id + 1 AND a.r = b.r AND a.c = b.c JOIN (SELECT vec_id, avg(v) AS ma FROM fx_pixels GROUP BY vec_id) x ON x.vec_id = a.vec_id JOIN (SELECT vec_id, avg(v) AS mb FROM fx_pixels GROUP BY vec_id) y ON y.vec_id = b.vec_id GROUP BY a.vec_id HAVING abs(max(mb)) > 1e-3")
def image_similarity(spark, sf):
    """Brightness-normalised difference and correlation of neighbouring rasters, on arrays: no pixel is exploded."""
    e = table(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("a"))
    pairs = e.join(e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("a").alias("b")), "vec_id")
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda s, v: s + v)
    n = F.size("a")
    ma, mb = total(F.col("a")) / n, total(F.col("b")) / n
    pairs = pairs.withColumns({"ma": ma, "mb": mb}).filter("abs(mb) > 1e-3")
    difference = total(F.zip_with("a", "b", lambda x, y: F.abs(x - y * (F.col("ma") / F.col("mb"))))) / n
    dot = lambda p, q, mp, mq: total(F.zip_with(p, q, lambda x, y: (x - F.col(mp)) * (y - F.col(mq))))
    return pairs.select("vec_id", F.round(difference, 6).alias("difference"), F.round(dot("a", "b", "ma", "mb") / F.sqrt(dot("a", "a", "ma", "ma") * dot("b", "b", "mb", "mb")), 6).alias("correlation"))


@query("""WITH p AS (SELECT vec_id, r, c, (1e0 + abs(v*v)*3e0)/(1e0 + abs(v)) AS q FROM fx_pixels), k AS (SELECT vec_id, percentile_disc(0.5) WITHIN GROUP (ORDER BY q) AS m FROM p GROUP BY vec_id), n AS (SELECT vec_id, r, c, q/m AS q FROM p JOIN k USING (vec_id))
SELECT a.vec_id, a.r, a.c, round(least(1e1, a.q/b.q), 6) AS ratio FROM n a JOIN n b ON b.vec_id = a.vec_id + 1 AND a.r = b.r AND a.c = b.c""")
def mbmp_ratio(spark, sf):
    """Ratio of two rasters' median-normalised band ratios."""
    p = _pixels(spark, sf).withColumn("q", (1 + F.abs(F.col("v") * F.col("v")) * 3.0) / (1 + F.abs("v")))
    n = p.join(p.groupBy("vec_id").agg(A.lower_median("q").alias("m")), "vec_id").select("vec_id", "r", "c", (F.col("q") / F.col("m")).alias("q"))
    return n.join(n.select((F.col("vec_id") - 1).alias("vec_id"), "r", "c", F.col("q").alias("q2")), ["vec_id", "r", "c"]).select("vec_id", "r", "c", F.round(F.least(F.lit(10.0), F.col("q") / F.col("q2")), 6).alias("ratio"))


_FLUX = """WITH p AS (SELECT vec_id, sum(greatest(-6e2, least(1e5, v*4e4))*8e0) AS s, count(*) AS n, max(1e0 + vec_id % 9) AS w FROM fx_pixels WHERE v > -0.2e0 GROUP BY vec_id),
k AS (SELECT *, s*1e2*1e3*0.01604e0/(1e6*22.4e0) AS ime, sqrt(n*1e2) AS len, 0.33e0*w + 0.45e0 AS u, 205.64270005117675e0*8e0*sqrt(n)*1e2*1e3*0.01604e0/(1e6*22.4e0) AS z, (0.33e0*0.33e0 + 1e-4)*w*w*1.25e0 - (0.33e0*w)*(0.33e0*w) + 1e-4 AS vu FROM p)
SELECT vec_id, n AS pixels, round(CASE WHEN s > 0 THEN 3600e0*u*ime/len ELSE 0e0 END, 3) AS flux_kg_h, round(3600e0/len*sqrt(greatest(vu*z*z + vu*ime*ime + z*z*u*u, 0e0)), 3) AS flux_std FROM k"""


@query(_FLUX)
def flux_rate(spark, sf):
    p = _pixels(spark, sf).filter("v > -0.2").withColumns({"enhancement": F.col("v") * 4e4, "wind_speed": (1 + F.col("vec_id") % 9).cast("double")})
    return P.fluxes(p, ["vec_id"]).select("vec_id", "pixels", F.round("flux_kg_h", 3).alias("flux_kg_h"), F.round("flux_std", 3).alias("flux_std"))


@query("SELECT vec_id, round(sum((0.6e0 + abs(v) - 0.5e0)*(r + 0.5e0))/sum(0.6e0 + abs(v) - 0.5e0), 6) AS row, round(sum((0.6e0 + abs(v) - 0.5e0)*(c + 0.5e0))/sum(0.6e0 + abs(v) - 0.5e0), 6) AS col, round(max(0.6e0 + abs(v)), 6) AS max_p FROM fx_pixels GROUP BY vec_id")
def weighted_centroid(spark, sf):
    d = P.centroids(_pixels(spark, sf).withColumn("p", 0.6 + F.abs("v")), ["vec_id"])
    return d.select("vec_id", *(F.round(n, 6).alias(n) for n in ("row", "col", "max_p")))


@query("SELECT vec_id, CASE WHEN vec_id % 101 < 50 THEN 'cloudy' WHEN vec_id % 7 / 7e0 > 0.5e0 THEN 'out_of_swath' WHEN vec_id % 11 = 0 THEN 'no_background' ELSE 'ok' END AS status FROM (SELECT DISTINCT vec_id FROM fx_pixels)")
def plume_gate(spark, sf):
    k = F.col("vec_id")
    return table(spark, sf, "embeddings").select("vec_id", P.gate(k % 101, k % 7 / 7.0, F.when(k % 11 != 0, k)).alias("status"))


def demo_table() -> K.Transmittance:
    """A transmittance table of the usual shape from a rule (Beer's law); the real one is a file that the caller names."""
    amf, extra = np.linspace(2.0, 4.0, 8), np.array([-0.2, 0.0, 0.15, 0.3, 0.45, 0.6, 0.9, 2.0, 4.0])
    methane = np.tile(1800 * (1 + extra), (8, 1))
    fade = lambda k: 60 * np.exp(-k * amf[:, None] * methane / 1800)
    return K.Transmittance(amf, methane, fade(0.05), fade(0.01), 60 * np.exp(-0.05 * amf), 60 * np.exp(-0.01 * amf))


@query()
def methane_enhancement(spark, sf):
    """Ratios to ppb through the demonstration table; EMBERLINE_LUT names a real one."""
    path = os.environ.get("EMBERLINE_LUT")
    tables = {"S2A": demo_table()}
    if path:
        import json

        with open(path, encoding="utf-8") as f:
            tables["S2A"] = K.Transmittance.read(json.load(f), "S2A")
    p = _pixels(spark, sf).select("vec_id", "r", "c", F.lit("S2A").alias("satellite"), (1 + F.col("v") / 10).alias("ratio"), (30.0 + F.col("vec_id") % 5).alias("sun_zenith"), F.lit(5.0).alias("view_zenith"))
    return P.methane(p, tables).select("vec_id", "r", "c", F.round("enhancement", 3).alias("enhancement"))


@query()
def scene_score(spark, sf):
    """Highest cut that leaves a component of eight pixels, by bisection in the kernel."""
    e = table(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda x: F.abs(x).cast("float")).alias("p"))
    return A.over_rasters(e, lambda row: {"vec_id": row["vec_id"], "score": K.scene_score(np.asarray(row["p"], np.float32).reshape(8, 8), 8)}, "vec_id long, score double")


@query()
def registration(spark, sf):
    """Each raster moved by a known shift and found again."""

    def kernel(row) -> dict:
        image = np.kron(np.asarray(row["embedding"], np.float32).reshape(8, 8), np.ones((4, 4), np.float32))
        moved = np.stack([K.warp(image[None], 2.0, -1.0)[0]] * 3)
        _, shift = K.align(moved, np.stack([image] * 3), (0, 1, 2))
        return {"vec_id": row["vec_id"], "dx": float(shift[0]), "dy": float(shift[1])}

    return A.over_rasters(table(spark, sf, "embeddings").select("vec_id", "embedding"), kernel, "vec_id long, dx double, dy double")


@query()
def plume_detector(spark, sf):
    """The detector end to end on small chips with a stand-in network (a bright ratio is a plume)."""
    band = lambda k, scale: F.transform("embedding", lambda x: (2000 + 100 * k + x.cast("double") * scale).cast("float"))
    chip = lambda last: F.flatten(F.array(*(band(k, last if k == 12 else 10) for k in range(13))))
    e = table(spark, sf, "embeddings").select(F.col("vec_id").cast("string").alias("id"), "embedding", (F.col("vec_id") % 101).cast("double").alias("clear_percent"))
    pairs = e.select("id", F.lit("S2A").alias("satellite"), F.lit(8).alias("width"), F.lit(8).alias("height"), chip(6000).alias("target"), chip(10).alias("background"), F.transform("embedding", lambda x: F.lit(True)).alias("valid"), F.lit(3.0).alias("wind_u"), F.lit(1.0).alias("wind_v"), F.lit(35.0).alias("sun_zenith"), F.lit(5.0).alias("view_zenith"), "clear_percent")

    def network():
        return lambda x: (x[0] < 1.0).astype(np.float32) * 0.9

    return P.detect_plumes(pairs, network, {"S2A": demo_table()}, least=4)


_SEG = "SELECT k AS segment, k*7e0 AS ax, 0e0 AS ay, k*7e0 + 3e0 AS bx, 1.2e1 + k AS by_ FROM (SELECT unnest(range(0, 5)) AS k)"
_DIST = "sqrt(pow(x - ax - t*(bx - ax), 2) + pow(y - ay - t*(by_ - ay), 2))"


def _segments(spark) -> DataFrame:
    return spark.range(5).select(F.col("id").alias("segment"), (F.col("id") * 7.0).alias("ax"), F.lit(0.0).alias("ay"), (F.col("id") * 7.0 + 3).alias("bx"), (12.0 + F.col("id")).alias("by"))


@query(f"""WITH s AS ({_SEG}), p AS (SELECT vec_id, r, c, c*4e0 AS x, r*3e0 AS y FROM fx_pixels),
d AS (SELECT *, greatest(0e0, least(1e0, ((x - ax)*(bx - ax) + (y - ay)*(by_ - ay))/((bx - ax)*(bx - ax) + (by_ - ay)*(by_ - ay)))) AS t FROM p, s)
SELECT vec_id, r, c, round(min({_DIST}), 6) AS distance FROM d GROUP BY vec_id, r, c""")
def segment_distance(spark, sf):
    """Distance of each pixel to the nearest of a handful of lines, through the cells around its raster."""
    from ..functions import geo

    p = _pixels(spark, sf).select("vec_id", "r", "c", (F.col("c") * 4.0).alias("x"), (F.col("r") * 3.0).alias("y"))
    box = p.groupBy("vec_id").agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    near = R.near_segments(box, _segments(spark), "vec_id")
    d = geo.segment_distance(F.col("x"), F.col("y"), F.col("ax"), F.col("ay"), F.col("bx"), F.col("by"))
    return p.join(near, "vec_id").groupBy("vec_id", "r", "c").agg(F.round(F.min(d), 6).alias("distance"))


@query("SELECT vec_id, round(0.5e0*atan2(2e0*covar_pop(c, r), var_pop(c) - var_pop(r)), 6) AS axis FROM fx_pixels WHERE v > 0.1e0 GROUP BY vec_id HAVING count(*) > 3 AND abs(covar_pop(c, r)) > 1e-6")
def principal_axis(spark, sf):
    p = _pixels(spark, sf).filter("v > 0.1").select("vec_id", F.col("c").cast("double").alias("x"), F.col("r").cast("double").alias("y"))
    n = p.groupBy("vec_id").agg(F.count("*").alias("n"), F.covar_pop("x", "y").alias("k")).filter("n > 3 and abs(k) > 1e-6").select("vec_id")
    return R.principal_axis(p, "vec_id").join(n, "vec_id").select("vec_id", F.round("axis", 6).alias("axis"))


@query(f"""WITH s AS ({_SEG}), p AS (SELECT vec_id, r*8 + c AS id, c*1e1 AS x, r*1e1 AS y FROM fx_pixels WHERE v > 0.15e0),
d AS (SELECT vec_id, id, segment, greatest(0e0, least(1e0, ((x - ax)*(bx - ax) + (y - ay)*(by_ - ay))/((bx - ax)*(bx - ax) + (by_ - ay)*(by_ - ay)))) AS t, x, y, ax, ay, bx, by_ FROM p, s),
h AS (SELECT vec_id, count(DISTINCT id) AS hits FROM d WHERE {_DIST} <= 15e0 GROUP BY vec_id),
m AS (SELECT vec_id, count(*) AS n, avg(x) AS x, avg(y) AS y, 0.5e0*atan2(2e0*covar_pop(x, y), var_pop(x) - var_pop(y)) AS axis FROM p GROUP BY vec_id),
e AS (SELECT m.*, s.*, greatest(0e0, least(1e0, ((x - ax)*(bx - ax) + (y - ay)*(by_ - ay))/((bx - ax)*(bx - ax) + (by_ - ay)*(by_ - ay)))) AS t FROM m, s),
w AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY {_DIST}, segment) AS k FROM e)
SELECT w.vec_id AS mask, CASE WHEN n >= 3 THEN round(coalesce(hits, 0)/cast(n AS double)*abs(cos(axis)*(bx - ax) + sin(axis)*(by_ - ay))/sqrt((bx - ax)*(bx - ax) + (by_ - ay)*(by_ - ay)), 6) END AS collinearity FROM w LEFT JOIN h ON h.vec_id = w.vec_id WHERE k = 1""")
def collinearity(spark, sf):
    p = _pixels(spark, sf).filter("v > 0.15").select(F.col("vec_id").alias("mask"), (F.col("r") * 8 + F.col("c")).alias("id"), (F.col("c") * 10.0).alias("x"), (F.col("r") * 10.0).alias("y"))
    return R.collinearity(p, _segments(spark)).select("mask", F.round("collinearity", 6).alias("collinearity"))


@query("""WITH s AS (SELECT cast(n_nationkey AS bigint) AS scene, 600 + n_nationkey*31 AS w, 500 + n_nationkey*17 AS h FROM nation)
SELECT scene, 0 AS x0, 256 - 10 AS y0, cast(least(w, (ceil((w - 50)/256e0))*256 + 10) AS int) AS x1, h AS y1 FROM s""")
def block_footprint(spark, sf):
    k = F.col("n_nationkey").cast("int")
    s = table(spark, sf, "nation").select(k.cast("long").alias("scene"), (600 + k * 31).alias("width"), (500 + k * 17).alias("height")).withColumns({"px0": F.lit(0), "py0": F.lit(300), "px1": F.col("width") - 50, "py1": F.col("height")})
    return A.block_footprint(A.block_lattice(s)).select("scene", *(F.col(n).cast("int").alias(n) for n in ("x0", "y0", "x1", "y1")))
