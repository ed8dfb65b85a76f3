"""Raster operators: blocks as rows for the kernels, pixels as rows for relational plans."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo, score
from . import kernels
from .graph import components
from .kernels import BLOCK, CLOUD_CLASSES, OVERLAP, Thresholds


def reflectance(dn: Column, offset: Column | float = -1000.0, quantification: Column | float = 10000.0) -> Column:
    return F.when(dn == 0, 0.0).otherwise((dn + offset) / quantification)


def is_cloud(scl: Column) -> Column:
    return scl.isin(*CLOUD_CLASSES)


def upper_median(x: str) -> Column:
    """The upper of two middle values."""
    return F.expr(f"percentile_disc(0.5) within group (order by {x} desc)")


def lower_median(x: str) -> Column:
    """The lower of two middle values."""
    return F.expr(f"percentile_disc(0.5) within group (order by {x})")


def prescreen(blocks: DataFrame, t: Thresholds = Thresholds(), offset: float = -1000.0, quantification: float = 10000.0) -> DataFrame:
    """Blocks with a pixel that could be hot: a bound on raw numbers, so nothing the detector finds is lost."""
    floor = t.b12_min * quantification - offset
    return blocks.filter(F.exists("b12", lambda x: x >= floor))


def screened(pixels: DataFrame, by: list[str], t: Thresholds = Thresholds()) -> DataFrame:
    """(by, skip, cloud_free) of blocks of mask pixels ``scl``: all pixels count, no data too."""
    share = F.avg(F.when(is_cloud(F.col("scl")), 1.0).otherwise(0.0))
    return pixels.groupBy(*by).agg(share.alias("share")).select(*by, (F.col("share") > t.max_cloud_local).alias("skip"), (F.col("share") <= t.cloud_free_thresh).alias("cloud_free"))


def spectral_mask(pixels: DataFrame, by: str, t: Thresholds = Thresholds()) -> DataFrame:
    """Pixels (by, r, c, b12, b11, b8a) with ``hot``; b8a may be null.  Blocks of fewer than ten background pixels have none.

    The background is found with a partial aggregate and joined back, so that a block is not gathered for it.
    """
    low = F.col("b12") < t.b12_min
    median = pixels.filter(low).groupBy(by).agg(upper_median("b12").alias("background"), F.count("*").alias("n")).filter("n >= 10").drop("n")
    total = F.col("b11") + F.col("b8a")
    index = F.when(total > 0.01, (F.col("b11") - F.col("b8a")) / F.when(total > 0.01, total)).otherwise(0.0)
    bright = F.when(F.col("b8a").isNull(), F.col("b11") > t.saturation).otherwise((index > 0) | (F.col("b11") > t.saturation) | (F.col("b12") > t.saturation))
    over = F.col("b12") > F.greatest(F.col("background"), F.lit(t.background_floor)) * t.contrast_ratio
    d = pixels.join(median, by, "left")
    return d.withColumn("hot", F.coalesce((F.col("b12") > t.b12_min) & (F.col("b11") > t.b11_min) & over & bright, F.lit(False)))


def pixel_components(pixels: DataFrame, by: str, corners: bool = False) -> DataFrame:
    """(by, r, c, component): connected pixels, named by their first pixel in raster order (a struct r, c).

    The relational twin of the kernel: neighbours meet in an equi-join and components are found by stars, so a raster
    may be larger than a task.
    """
    ahead = ((0, 1), (1, 0), (1, -1), (1, 1)) if corners else ((0, 1), (1, 0))
    p = pixels.select(by, "r", "c", F.struct(F.col(by).alias("k"), F.col("r"), F.col("c")).alias("v"))
    near = p.withColumn("s", F.explode(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in ahead))))
    near = near.select(by, (F.col("r") + F.col("s.a")).alias("r"), (F.col("c") + F.col("s.b")).alias("c"), F.col("v").alias("a"))
    roots = components(near.join(p.select(by, "r", "c", F.col("v").alias("b")), [by, "r", "c"]).select("a", "b"))
    named = p.join(roots, p.v == roots.a, "left").select(by, "r", "c", F.coalesce("root", "v").alias("root"))
    return named.select(by, "r", "c", F.struct(F.col("root.r").alias("r"), F.col("root.c").alias("c")).alias("component"))


def component_rows(pixels: DataFrame, by: str, corners: bool = False) -> DataFrame:
    """The same through the kernel, a raster a task: (by, r, c, label)."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        r, c = part["r"].to_numpy(), part["c"].to_numpy()
        mask = np.zeros((r.max() + 1, c.max() + 1), bool)
        mask[r, c] = True
        return part.assign(label=kernels.components(mask, corners)[r, c])[[by, "r", "c", "label"]]

    kind = pixels.schema[by].dataType.simpleString()
    return pixels.select(by, F.col("r").cast("int").alias("r"), F.col("c").cast("int").alias("c")).groupBy(by).applyInPandas(run, f"{by} {kind}, r int, c int, label int")


def component_totals(labelled: DataFrame, by: str, value: str = "b12") -> DataFrame:
    """A row a component: pixels, sum, mean, peak, the peak's place (first in raster order among equals) and the box."""
    order = F.struct(-F.col(value), F.col("r"), F.col("c"))
    return labelled.groupBy(by, "component").agg(
        F.count("*").alias("pixels"), F.sum(value).alias("total"), F.avg(value).alias("mean"), F.max(value).alias("peak"), F.min_by(F.struct("r", "c"), order).alias("at"),
        F.min("r").alias("r0"), F.max("r").alias("r1"), F.min("c").alias("c0"), F.max("c").alias("c1"),
    )


def gates(parts: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Components (pixels, mean, peak) that pass the shape rules before the hot core."""
    c = F.col
    spot = (c("pixels") > 1) & (c("peak") < t.peakedness_min * c("mean")) & (c("mean") < t.saturation)
    return parts.filter((c("pixels") <= t.max_pixels) & (c("peak") >= t.peak_b12_min) & ~((c("pixels") > t.large_pixels) & (c("peak") < t.large_b12_min)) & ~spot & ~((c("pixels") == 1) & (c("peak") < t.single_pixel_min)))


def block_lattice(scenes: DataFrame) -> DataFrame:
    """Blocks (br, bc, x0, y0, x1, y1) of each scene (width, height) that the pixel window px0..py1 touches, with their halo."""
    n = lambda a: F.floor(F.col(a) / BLOCK).cast("int")
    last = lambda a: F.ceil(F.col(a) / BLOCK).cast("int") - 1
    rows = scenes.filter("px1 > px0 and py1 > py0").withColumn("br", F.explode(F.sequence(n("py0"), last("py1")))).withColumn("bc", F.explode(F.sequence(n("px0"), last("px1"))))
    edge = lambda k, size: (F.greatest(F.lit(0), F.col(k) * BLOCK - OVERLAP), F.least(F.col(size), (F.col(k) + 1) * BLOCK + OVERLAP))
    (x0, x1), (y0, y1) = edge("bc", "width"), edge("br", "height")
    return rows.withColumns({"x0": x0, "y0": y0, "x1": x1, "y1": y1})


def pixel_window(scenes: DataFrame) -> DataFrame:
    """Scenes (epsg, min_x, min_y, max_x, max_y, width, height) and an area west..north: the pixel window px0, py0, px1, py1."""
    zone, north_half = geo.utm_zone(F.col("epsg"))
    wx, sy = geo.to_utm(F.col("west"), F.col("south"), zone, north_half)
    ex, ny = geo.to_utm(F.col("east"), F.col("north"), zone, north_half)
    rx, ry = (F.col("max_x") - F.col("min_x")) / F.col("width"), (F.col("max_y") - F.col("min_y")) / F.col("height")
    return scenes.withColumns({
        "px0": F.greatest(F.lit(0), F.floor((F.greatest(wx, F.col("min_x")) - F.col("min_x")) / rx)).cast("int"), "py0": F.greatest(F.lit(0), F.floor((F.col("max_y") - F.least(ny, F.col("max_y"))) / ry)).cast("int"),
        "px1": F.least(F.col("width"), F.ceil((F.least(ex, F.col("max_x")) - F.col("min_x")) / rx)).cast("int"), "py1": F.least(F.col("height"), F.ceil((F.col("max_y") - F.greatest(sy, F.col("min_y"))) / ry)).cast("int"),
    })


def block_footprint(blocks: DataFrame, by: str = "scene") -> DataFrame:
    """(by, x0, y0, x1, y1): the pixel window that all blocks of a scene cover together."""
    return blocks.groupBy(by).agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))


def pixel_box(windows: DataFrame) -> DataFrame:
    """Windows (min_x, max_y, res_x, res_y, epsg; x0, y0, x1, y1) with the box in degrees of their four corners: the grid is turned."""
    zone, north = geo.utm_zone(F.col("epsg"))
    corners = [geo.from_utm(F.col("min_x") + F.col(x) * F.col("res_x"), F.col("max_y") - F.col(y) * F.col("res_y"), zone, north) for x in ("x0", "x1") for y in ("y0", "y1")]
    lon, lat = ([c[k] for c in corners] for k in (0, 1))
    return windows.withColumns({"west": F.least(*lon), "south": F.least(*lat), "east": F.greatest(*lon), "north": F.greatest(*lat)})


def pixel_polygon(min_x: Column, max_y: Column, epsg: Column, col0: Column, row0: Column, col1: Column, row1: Column, pixel: float = 10.0) -> Column:
    """GeoJSON polygon in degrees of a pixel window of a raster in metres, from its lower left corner round: a chip's footprint,
    or a component's envelope."""
    zone, north = geo.utm_zone(epsg)
    x0, x1, y0, y1 = min_x + col0 * pixel, min_x + col1 * pixel, max_y - row1 * pixel, max_y - row0 * pixel
    ring = F.array(*(F.array(*geo.from_utm(x, y, zone, north)) for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))))
    return F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates"))


def fits_chip(chips: DataFrame, pixel: float = 10.0) -> Column:
    """Whether an area's box (west, south, east, north, full_tile) lies within a chip (min_x, max_y, width, height, epsg)."""
    zone, north = geo.utm_zone(F.col("epsg"))
    inside = ~F.coalesce(F.col("full_tile"), F.lit(False))
    for lon in ("west", "east"):
        for lat in ("south", "north"):
            x, y = geo.to_utm(F.col(lon), F.col(lat), zone, north)
            inside &= x.between(F.col("min_x"), F.col("min_x") + F.col("width") * pixel) & y.between(F.col("max_y") - F.col("height") * pixel, F.col("max_y"))
    return inside


def cloud_cells(scenes: DataFrame, masks: DataFrame) -> DataFrame:
    """(scene, key, i, j, cloud): the cloud share of every sampling cell under the blocks that a scene's detector reads.

    ``scenes`` are blocks of scenes (``block_lattice``) with min_x, max_y, res_x, res_y and epsg; ``masks`` has scene, r, c, scl.
    Blocks reach beyond an area's box, so cells cover their union.  A cell without a valid mask pixel has no row.
    """
    place = scenes.select("scene", "min_x", "max_y", "res_x", "res_y", "epsg").distinct()
    cells = grid_cells(pixel_box(block_footprint(scenes).join(place, "scene")))
    zone, north = geo.utm_zone(F.col("epsg"))
    x, y = geo.to_utm(F.col("lon"), F.col("lat"), zone, north)
    c, r = F.floor((x - F.col("min_x")) / F.col("res_x")), F.floor((F.col("max_y") - y) / F.col("res_y"))
    steps = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in range(-2, 3) for b in range(-2, 3)))
    asked = cells.select("scene", "key", "i", "j", r.alias("r"), c.alias("c")).withColumn("s", F.explode(steps)).select("scene", "key", "i", "j", (F.col("r") + F.col("s.a")).alias("r"), (F.col("c") + F.col("s.b")).alias("c"))
    hist = class_histogram(asked.join(masks, ["scene", "r", "c"]), ["scene", "key", "i", "j"])
    return hist.select("scene", "key", "i", "j", cloud_fraction(F.col("hist"), F.col("valid")).alias("cloud"))


def owned(detections: DataFrame) -> DataFrame:
    """Detections whose peak lies in the inner part of their own block: halos overlap, each spot is kept once."""
    return detections.filter((F.floor(F.col("img_row") / BLOCK) == F.col("br")) & (F.floor(F.col("img_col") / BLOCK) == F.col("bc")))


DETECTION = "scene string, br int, bc int, img_row long, img_col long, max_b12 double, avg_b12 double, max_b11 double, b12_b11_ratio double, peakedness double, pixels int, radiance double, saturated int, cloud_free boolean"


def detect_blocks(blocks: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Hot spots of block rows: scene, br, bc, x0, y0, width, height, b12, b11, b8a, scl (row-major arrays; the last two may be null).

    ``offset`` and ``quantification`` are read where the rows have them.  Blocks without a possible pixel are left out
    before their arrays reach Python; a batch holds few blocks, as each is about a megabyte.
    """
    have = set(blocks.columns)
    one = lambda n, v: F.coalesce(F.col(n).cast("double"), F.lit(v)) if n in have else F.lit(v)
    slim = prescreen(blocks, t).select("scene", "br", "bc", "x0", "y0", "width", "height", "b12", "b11", "b8a", "scl", one("offset", -1000.0).alias("offset"), one("quantification", 10000.0).alias("quantification"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in DETECTION.split(", ")]
        for frame in frames:
            rows = []
            for b in frame.itertuples(index=False):
                shape = (b.height, b.width)
                band = lambda x: None if x is None else kernels.reflectance(np.asarray(x).reshape(shape), b.offset, b.quantification)  # noqa: E731, B023
                spots, clear = kernels.detect(band(b.b12), band(b.b11), band(b.b8a), None if b.scl is None else np.asarray(b.scl), t)
                rows += [(b.scene, b.br, b.bc, b.y0 + s.pop("row"), b.x0 + s.pop("col"), *s.values(), clear) for s in spots]
            yield pd.DataFrame(rows, columns=names)

    return slim.mapInPandas(run, DETECTION)


def located(detections: DataFrame, scenes: DataFrame) -> DataFrame:
    """Detections with lon, lat and the scene's date, sun and glint columns; scenes have min_x, max_y, res_x, res_y, epsg."""
    d = detections.join(scenes, "scene")
    zone, north = geo.utm_zone(F.col("epsg"))
    lon, lat = geo.from_utm(F.col("min_x") + (F.col("img_col") + 0.5) * F.col("res_x"), F.col("max_y") - (F.col("img_row") + 0.5) * F.col("res_y"), zone, north)
    return d.withColumns({"lon": lon, "lat": lat, "glint_angle": score.glint_angle(F.col("sun_elevation")), "glint_score": score.glint_of_elevation(F.col("sun_elevation"))})


def grid_cells(areas: DataFrame) -> DataFrame:
    """Cells (i, j, lon, lat, key) of the sampling grid over each area's box, edges included."""
    span = lambda a, b: F.explode(F.sequence(geo.cell(F.col(a)), geo.cell(F.col(b))))
    rows = areas.withColumn("j", span("south", "north")).withColumn("i", span("west", "east"))
    lon, lat = F.col("i") * geo.GRID_STEP, F.col("j") * geo.GRID_STEP
    return rows.withColumns({"lon": lon, "lat": lat, "key": F.format_string("%.3f,%.3f", lon, lat)})


def class_histogram(looks: DataFrame, by: list[str]) -> DataFrame:
    """(by, valid, hist): counts of the classes 0 to 11, class 0 not valid; sites without a valid pixel are left out."""
    counts = F.array(*(F.count_if(F.col("scl") == k) for k in range(12)))
    return looks.filter(F.col("scl").between(0, 11)).groupBy(*by).agg(F.count_if(F.col("scl") != 0).alias("valid"), counts.alias("hist")).filter("valid > 0")


def cloud_fraction(hist: Column, valid: Column) -> Column:
    cloudy = sum((hist[k] for k in CLOUD_CLASSES[1:]), hist[CLOUD_CLASSES[0]])
    return F.when(valid > 0, cloudy / F.when(valid > 0, valid)).otherwise(0.0)


def sample_mask(sites: DataFrame, pixels: DataFrame, half: int = 2) -> DataFrame:
    """(site, valid, hist): classes in the window around each site (site, r, c) of a mask (r, c, scl)."""
    steps = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in range(-half, half + 1) for b in range(-half, half + 1)))
    asked = sites.withColumn("s", F.explode(steps)).select("site", (F.col("r") + F.col("s.a")).alias("r"), (F.col("c") + F.col("s.b")).alias("c"))
    return class_histogram(asked.join(pixels, ["r", "c"]), ["site"])


def local_share(pixels: DataFrame, by: str, flag: str, half: int) -> DataFrame:
    """Each pixel with the share of flagged ones in its window, by running sums along rows, then columns."""
    rows = Window.partitionBy(by, "r").orderBy("c").rangeBetween(-half, half)
    cols = Window.partitionBy(by, "c").orderBy("r").rangeBetween(-half, half)
    d = pixels.withColumn("_f", F.sum(F.col(flag).cast("long")).over(rows)).withColumn("_n", F.count("*").over(rows))
    return d.withColumn("share", F.sum("_f").over(cols) / F.sum("_n").over(cols)).drop("_f", "_n")


def over_rasters(rasters: DataFrame, kernel: Callable[[pd.Series], dict], schema: str) -> DataFrame:
    """One output row a raster row, through a numpy kernel in Arrow batches."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame([kernel(row) for _, row in frame.iterrows()], columns=[x.strip().split()[0] for x in schema.split(", ")])

    return rasters.mapInPandas(run, schema)
