import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from emberline.operators import kernels as K
from emberline.operators import plume as P
from emberline.operators import raster as A
from emberline.plans.queries_rasters import demo_table
from emberline.sources import records


def flood(mask, corners):
    out, n = np.zeros(mask.shape, int), 0
    for i, j in np.argwhere(mask):
        if out[i, j]:
            continue
        n += 1
        stack, out[i, j] = [(i, j)], n
        while stack:
            a, b = stack.pop()
            for x, y in ((a + d, b + e) for d in (-1, 0, 1) for e in (-1, 0, 1) if (d or e) and (corners or not (d and e))):
                if 0 <= x < mask.shape[0] and 0 <= y < mask.shape[1] and mask[x, y] and not out[x, y]:
                    out[x, y] = n
                    stack.append((x, y))
    return out


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 12), st.integers(1, 12), st.integers(0, 2**31), st.booleans())
def test_components_equal_flood_fill(h, w, seed, corners):
    mask = np.random.default_rng(seed).random((h, w)) < 0.5
    assert (K.components(mask, corners) == flood(mask, corners)).all()


def test_relational_components_equal_the_kernel(spark):
    mask = np.random.default_rng(7).random((15, 15)) < 0.5
    d = spark.createDataFrame([(1, int(r), int(c)) for r, c in np.argwhere(mask)], "id int, r int, c int")
    for corners in (False, True):
        groups = lambda rows, f: sorted(sorted((x.r, x.c) for x in rows if f(x) == k) for k in {f(x) for x in rows})
        assert groups(A.pixel_components(d, "id", corners).collect(), lambda x: x.component) == groups(A.component_rows(d, "id", corners).collect(), lambda x: x.label)


def slow_detect(b12, b11, b8a, t):
    """The detector pixel by pixel."""
    h, w = b12.shape
    low = sorted(v for v in b12.ravel() if v < t.b12_min)
    if len(low) < 10:
        return []
    bg = low[len(low) // 2]
    hot = np.zeros((h, w), bool)
    for i in range(h):
        for j in range(w):
            x, y = b12[i, j], b11[i, j]
            if x <= t.b12_min or y <= t.b11_min or x <= max(bg, t.background_floor) * t.contrast_ratio:
                continue
            if b8a is None:
                hot[i, j] = y > t.saturation
            else:
                s = y + b8a[i, j]
                hot[i, j] = (s > 0.01 and (y - b8a[i, j]) / s > 0) or y > t.saturation or x > t.saturation
    labels, out = flood(hot, False), []
    for k in range(1, labels.max() + 1):
        at = [tuple(p) for p in np.argwhere(labels == k)]
        peak = max(b12[p] for p in at)
        place = next(p for p in at if b12[p] == peak)
        mean = sum(b12[p] for p in at) / len(at)
        if len(at) > t.max_pixels or peak < t.peak_b12_min or (len(at) > t.large_pixels and peak < t.large_b12_min) or (len(at) > 1 and peak < t.peakedness_min * mean and mean < t.saturation) or (len(at) == 1 and peak < t.single_pixel_min):
            continue
        core, stack = {place}, [place]
        while stack:
            a, b = stack.pop()
            for q in ((a + 1, b), (a - 1, b), (a, b + 1), (a, b - 1)):
                if q in at and q not in core and b12[q] > max(peak * t.warm_fraction, t.hot_floor):
                    core.add(q)
                    stack.append(q)
        if len(core) <= t.warm_max_pixels:
            out.append((place, peak, len(core), sum(max(b12[p] - bg, 0) for p in core)))
    return out


def test_detector_equals_plain_loops():
    rng, found = np.random.default_rng(11), 0
    for k in range(60):
        b12 = rng.random((12, 14)) ** 3 * 1.6
        b11, b8a = b12 * rng.random((12, 14)) + 0.15, rng.random((12, 14))
        b8a = None if k % 3 == 0 else b8a
        t = K.Thresholds(contrast_ratio=2.0, peakedness_min=1.05)
        want = slow_detect(b12, b11 * 3 if b8a is None else b11, b8a, t)
        got, clear = K.detect(b12, b11 * 3 if b8a is None else b11, b8a, None, t)
        assert clear and [((s["row"], s["col"]), s["max_b12"], s["pixels"]) for s in got] == [x[:3] for x in want]
        assert [s["radiance"] for s in got] == pytest.approx([x[3] for x in want])
        found += len(want)
    assert found > 30


def test_clouds_stop_or_mark_a_block():
    t = K.Thresholds()
    assert K.screen(np.array([], int), t) == (False, True) and K.screen(np.array([3, 8, 9, 10]), t) == (True, False)
    assert K.screen(np.array([3, 4, 4, 4]), t) == (False, True) and K.screen(np.array([3, 3, 4, 4]), t) == (False, False)
    hot = np.full((8, 8), 0.1)
    hot[4, 4] = 0.9
    assert K.detect(hot, hot * 0.6, hot * 0.1, np.full((8, 8), 9)) == ([], False)
    assert len(K.detect(hot, hot * 0.6, hot * 0.1, np.full((8, 8), 4))[0]) == 1
    assert K.detect(hot[:1, :5], hot[:1, :5], None, None) == ([], True)


def test_blocks_through_spark(spark):
    dn = np.full((16, 16), 2000)
    dn[5, 6], dn[5, 7] = 10500, 6200
    row = lambda k, b8a: (k, 1, 0, 0, 246, 16, 16, dn.ravel().tolist(), (dn * 3 // 4).ravel().tolist(), b8a, None)
    blocks = spark.createDataFrame([row("s", (dn // 4).ravel().tolist()), row("n", None)], "scene string, br int, bc int, x0 int, y0 int, width int, height int, b12 array<int>, b11 array<int>, b8a array<int>, scl array<int>")
    got = A.detect_blocks(blocks).collect()
    assert [(r.scene, r.img_row, r.img_col, r.pixels) for r in got] == [("s", 251, 6, 2)]
    assert A.owned(A.detect_blocks(blocks)).count() == 0
    scenes = spark.createDataFrame([("s", 500000.0, 3600000.0, 20.0, 20.0, 32613, 40.0)], "scene string, min_x double, max_y double, res_x double, res_y double, epsg int, sun_elevation double")
    r = A.located(A.detect_blocks(blocks), scenes).first()
    assert -105.1 < r.lon < -104.9 and 32.4 < r.lat < 32.6 and r.glint_angle == 50.0 and r.glint_score == pytest.approx(0.375)


def test_shift_is_found_and_undone():
    rng = np.random.default_rng(2)
    y, x = np.mgrid[0:32, 0:32]
    image = np.stack([np.sin(x / 3.1 + c) + np.cos(y / 2.3 - c) + rng.random((32, 32)) * 0.01 for c in range(3)]).astype(np.float32)
    moved = K.warp(image, 2.0, -1.0)
    back, shift = K.align(image, moved, (2, 1, 0))
    assert shift == pytest.approx((-2, 1), abs=0.3) and np.abs(back - image)[:, 4:-4, 4:-4].mean() < 0.05
    assert K.align(image, np.zeros_like(image), (0, 1, 2))[1] == (0.0, 0.0)


def test_network_input_contract():
    target, valid = np.full((6, 2, 2), 1000.0), np.array([[True, True], [True, False]])
    target[5, 0, 0] = 900
    out = K.network_input(target, np.full((6, 2, 2), 1000.0), valid, (8.0, -4.0))
    assert out.shape == (16, 2, 2) and out[0].ravel() == pytest.approx([0.9, 1, 1, 1]) and out[1, 0, 0] == pytest.approx(0.2)
    assert (out[13] == 1).all() and (out[14] == -0.5).all() and out[15].ravel().tolist() == [0, 0, 0, 1]


def test_cubic_is_exact_for_cubics_also_outside_and_backwards():
    x = np.array([0.0, 1.0, 2.5, 4.0, 7.0])
    f = lambda t: 2 * t**3 - t**2 + 5
    at = np.array([-1.0, 0.0, 0.3, 3.3, 7.0, 9.0])
    assert K.Cubic(x, f(x))(at) == pytest.approx(f(at)) and K.Cubic(x[::-1], f(x[::-1]))(at) == pytest.approx(f(at))
    for bad in (([0, 1, 2], [0, 1, 2]), ([0, 1, 1, 2], [0, 1, 2, 3])):
        with pytest.raises(ValueError):
            K.Cubic(*map(np.array, bad))


def test_enhancement_of_a_known_table():
    t = demo_table()
    gas = K.enhancement(np.array([0.9, 0.97, 1.0, np.nan, 1.02]), 35.0, 5.0, t)
    assert gas[0] > gas[1] > 0 and gas[2] == 0 == gas[3] and gas[4] < 0
    with pytest.raises(ValueError):
        K.Transmittance.read({}, "S3A")


def test_flux_by_the_closed_form(spark):
    x = np.array([521963.06, 224366.35, 70150.52, 10095.28, -2552.1, -3406.45])
    q, s = P.flux(x, 3.2)
    # independent arithmetic: clamp, mass, length, effective speed
    mass = sum(min(max(v, -600), 1e5) * 8 for v in x) * 100 * 1000 * 0.01604 / (1e6 * 22.4)
    assert q == pytest.approx(3600 * (0.33 * 3.2 + 0.45) * mass / (6 * 100) ** 0.5) and 0.3 * q < s < 0.4 * q
    d = spark.createDataFrame([("p", float(v), 3.2) for v in x], "id string, enhancement double, wind_speed double")
    r = P.fluxes(d, ["id"]).first()
    assert (r.flux_kg_h, r.flux_std) == pytest.approx((q, s)) and P.flux(np.array([-5.0]), 3.0)[0] == 0.0 == P.flux(np.array([]), 1.0)[1]


def test_plumes_and_scene_score():
    assert (K.components(np.array([[1, 0], [0, 1]]), True) > 0).sum() == 2 and K.components(np.array([[1, 0], [0, 1]]), True).max() == 1
    p = np.zeros((10, 10), np.float32)
    p.flat[:20] = 0.73
    assert K.scene_score(p, 20) == pytest.approx(0.73, abs=0.002) and K.scene_score(p[:0], 5) == 0
    assert K.plumes(p, 0.5, 20).max() == 1 and K.plumes(p, 0.5, 21).max() == 0 and K.plumes(p, np.float32(0.73), 1).max() == 0


def test_detector_statuses_and_a_plume(spark):
    chip = np.full((13, 12, 12), 2000.0)
    seen = chip.copy()
    seen[12, 3:7, 3:7] *= 0.9
    flat = lambda a: a.ravel().tolist()
    row = lambda k, target, back, clear: (k, "S2A", 12, 12, target, back, [True] * 144, 3.0, 4.0, 35.0, 5.0, clear)
    rows = [row("ok", flat(seen), flat(chip), 100.0), row("calm", flat(chip), flat(chip), 100.0), row("cloudy", flat(chip), flat(chip), 49.0), row("swath", [0.0] * 13 * 144, flat(chip), 90.0), row("alone", flat(chip), None, 90.0)]
    d = spark.createDataFrame(rows, "id string, satellite string, width int, height int, target array<double>, background array<double>, valid array<boolean>, wind_u double, wind_v double, sun_zenith double, view_zenith double, clear_percent double")
    table = demo_table()
    got = {r.id: r for r in P.detect_plumes(d, lambda: lambda x: np.where(x[0] < 0.95, 0.9, 0.1), {"S2A": table}, least=10).collect()}
    assert {k: r.status for k, r in got.items()} == {"ok": "ok", "calm": "ok", "cloudy": "cloudy", "swath": "out_of_swath", "alone": "no_background"}
    assert got["ok"].pixels == 16 and got["ok"].flux_kg_h > 0 and (got["ok"].row, got["ok"].col) == pytest.approx((5.0, 5.0)) and got["calm"].plume is None


def test_sampling_a_mask(spark):
    pixels = spark.createDataFrame([(r, c, 0 if (r, c) == (10, 10) else 6) for r in range(20) for c in range(20)], "r int, c int, scl int")
    sites = spark.createDataFrame([("mid", 10, 10), ("corner", 0, 0), ("out", 50, 50)], "site string, r int, c int")
    got = {r.site: r for r in A.sample_mask(sites, pixels).collect()}
    assert got["mid"].valid == 24 and got["mid"].hist[0] == 1 and got["corner"].valid == 9 and "out" not in got
    h = spark.range(1).select(A.cloud_fraction(F.array(*(F.lit(k) for k in (0, 0, 0, 1, 17, 0, 4, 0, 1, 1, 1, 0))), F.lit(25))).first()[0]
    assert h == pytest.approx(0.16)


def test_blocks_cover_the_window(spark):
    d = spark.createDataFrame([("s", 600, 500, 0, 300, 520, 500), ("none", 600, 500, 10, 10, 10, 20)], "scene string, width int, height int, px0 int, py0 int, px1 int, py1 int")
    got = sorted((r.br, r.bc, r.x0, r.y0, r.x1, r.y1) for r in A.block_lattice(d).collect())
    assert got == [(1, 0, 0, 246, 266, 500), (1, 1, 246, 246, 522, 500), (1, 2, 502, 246, 600, 500)]


def test_images_are_well_formed():
    p = np.linspace(0, 1, 12).reshape(3, 4)
    data = records.png(p)
    assert data.startswith(b"\x89PNG") and struct.unpack(">II", data[16:24]) == (4, 3)
    raw = zlib.decompress(data[data.index(b"IDAT") + 4 : data.index(b"IEND") - 8])
    assert raw[1:5] == bytes([68, 1, 84, 0]) and raw[-4:] == bytes([253, 231, 37, 255])
    t = records.tiff(p, 500000.0, 5000000.0, 10.0, 32630)
    assert t[:4] == b"II*\0" and np.frombuffer(t[-48:], "<f4") == pytest.approx(p.ravel())
    n = struct.unpack_from("<H", t, 8)[0]
    tags = {struct.unpack_from("<HHII", t, 10 + 12 * k)[0]: struct.unpack_from("<HHII", t, 10 + 12 * k)[3] for k in range(n)}
    assert tags[273] == len(t) - 48 and struct.unpack_from("<3d", t, tags[33550]) == (10.0, 10.0, 0.0)


def test_grids_of_20_metres_and_padding():
    a = np.arange(12.0).reshape(3, 4)
    fine = K.bilinear_20m(a, (6, 8))
    assert fine.shape == (6, 8) and fine[0, 0] == a[0, 0] and fine[-1, -1] == a[-1, -1] and fine.mean() == pytest.approx(a.mean())
    assert K.pad_to(np.ones((2, 20, 33))).shape == (2, 32, 64) and K.decimate(a).tolist() == [[0, 2], [8, 10]]


def test_cloud_cells_cover_the_blocks_of_a_scene(spark):
    """Cells under a window of a synthetic mask: cloud in its western half, as counted pixel by pixel."""
    place = spark.createDataFrame([("s", 500_000.0, 2_800_000.0, 20.0, 20.0, 32639, 0, 0, 60, 40)], "scene string, min_x double, max_y double, res_x double, res_y double, epsg int, x0 int, y0 int, x1 int, y1 int")
    mask = spark.range(60 * 40).selectExpr("'s' as scene", "cast(id div 60 as bigint) as r", "cast(id % 60 as bigint) as c").withColumn("scl", F.when(F.col("c") < 30, 9).otherwise(4))
    rows = {r.key: r for r in A.cloud_cells(place, mask).collect()}
    assert 90 <= len(rows) <= 140  # 1200 m x 800 m of cells of about 100 m x 111 m, edges included
    shares = [r.cloud for r in sorted(rows.values(), key=lambda r: r.i)]
    assert shares[0] == 1.0 and shares[-1] == 0.0 and {x for x in shares} != {0.0, 1.0}


def test_footprints_and_what_fits_a_chip(spark):
    chip = spark.createDataFrame([(500_000.0, 2_800_000.0, 200, 200, 32639)], "min_x double, max_y double, width int, height int, epsg int")
    ring = chip.select(A.pixel_polygon(F.col("min_x"), F.col("max_y"), F.col("epsg"), F.lit(0), F.lit(0), F.col("width"), F.col("height")).alias("g")).first().g.coordinates[0]
    assert len(ring) == 5 and ring[0] == ring[4] and ring[0][0] < ring[1][0] and ring[0][1] < ring[2][1]
    (w, s), (e, n) = (min(p[k] for p in ring) for k in (0, 1)), (max(p[k] for p in ring) for k in (0, 1))
    d = 1e-4
    boxes = [(w + d, s + d, e - d, n - d, False, True), (w + d, s + d, e + d, n - d, False, False), (w + d, s + d, e - d, n - d, True, False)]
    areas = spark.createDataFrame(boxes, "west double, south double, east double, north double, full_tile boolean, want boolean")
    assert all(r.got == r.want for r in areas.crossJoin(chip).select("want", A.fits_chip(areas).alias("got")).collect())
