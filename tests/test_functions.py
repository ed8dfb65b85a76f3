import math

import pytest
from pyspark.sql import functions as F

from emberline.functions import geo, score, text
from emberline.operators import cluster as C


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def lit(x):
    return F.lit(x).cast("double") if x is None else F.lit(float(x))


@pytest.mark.parametrize("ratio, want", [(1.1, 0), (1.4, 0.5), (1.7, 1), (3.0, 1), (None, 0), (math.nan, 0)])
def test_ratio_score(spark, ratio, want):
    assert one(spark, score.ratio_score(lit(ratio)))[0] == pytest.approx(want)


@pytest.mark.parametrize("dates, looks, want", [(5, 10, 0.5), (20, 10, 1), (3, 0, 0)])
def test_persistence(spark, dates, looks, want):
    assert one(spark, score.persistence_score(lit(dates), lit(looks)))[0] == want


@pytest.mark.parametrize("glint, want", [(1.0, -0.4), (0.0, 0.0), (0.5, -0.2), (None, 0.0), (7.0, -0.4)])
def test_glint_penalty(spark, glint, want):
    got = one(spark, score.glint_penalty(lit(glint)))[0]
    assert got == want and math.copysign(1, got) == (1 if want == 0 else -1)


@pytest.mark.parametrize("sun, want", [(65, 1), (90, 1), (25, 0), (45, 0.5), (None, None)])
def test_glint_of_elevation(spark, sun, want):
    assert one(spark, score.glint_of_elevation(lit(sun)))[0] == want


@pytest.mark.parametrize("args, want", [((0.6, 1.2, 1), True), ((0.59, 1.2, 1), False), ((0.6, 1.3, 1), False), ((0.6, 1.2, 2), False), ((None, 1.2, 1), False), ((0.6, None, 1), False)])
def test_glint_suspect(spark, args, want):
    assert one(spark, score.glint_suspect(*map(lit, args)))[0] is want


def test_total_score_of_a_lit_site(spark):
    s = score.scores(lit(2.25), lit(4), lit(12), lit(None))
    assert one(spark, s["total_score"])[0] == pytest.approx(0.5 + 0.4 * (4 / 12))


def test_projection_round_trips_on_both_halves(spark):
    for lon, lat, zone, north in ((-102.0208, 32.0071, 13, True), (147.3, -42.9, 55, False), (51.5, 25.3, 39, True)):
        x, y = one(spark, *geo.to_utm(lon, lat, zone, north))
        assert 100_000 < x < 900_000 and 0 < y < 10_000_000
        a, b = one(spark, *geo.from_utm(x, y, zone, north))
        assert abs(a - lon) < 1e-7 and abs(b - lat) < 1e-7


@pytest.mark.parametrize("grid, epsg", [("MGRS-39RWN", 32639), ("13SDV", 32613), ("39CWN", 32739), ("7", 32607), ("", 32600)])
def test_epsg_of_tile(spark, grid, epsg):
    assert one(spark, geo.epsg_of_tile(F.lit(grid)))[0] == epsg


def test_cells_and_keys(spark):
    assert one(spark, geo.cell_key(51.0013, 25.0004))[0] == "51.001,25.000"
    assert one(spark, geo.cell(0.0015), geo.cell(-0.0015), geo.cell(-0.0004)) == (2, -2, 0)


def test_boxes(spark):
    box = [F.lit(x) for x in (51.0, 25.0, 52.0, 26.0)]
    assert one(spark, *geo.pad_box(*box, 0)) == (51.0, 25.0, 52.0, 26.0)
    assert one(spark, geo.box_area_km2(*box))[0] == pytest.approx(111 * 111 * math.cos(math.radians(25.5)))


def test_angles_and_segments(spark):
    a = [lit(x) for x in (1, 0, 0, 2)]
    assert one(spark, geo.angle_between(*a))[0] == pytest.approx(90)
    assert one(spark, geo.angle_between(lit(0), lit(0), lit(1), lit(1)))[0] is None
    assert one(spark, geo.segment_distance(lit(0), lit(3), lit(-1), lit(0), lit(1), lit(0)))[0] == 3
    assert one(spark, geo.segment_distance(lit(3), lit(4), lit(0), lit(0), lit(0), lit(0)))[0] == 5


def test_site_hash_of_a_known_place(spark):
    assert one(spark, text.site_hash(lit(32.0), lit(-102.0)))[0] == "1rt0gzv"


def test_tokens(spark):
    token = lambda s: one(spark, text.orbit_token(F.lit(s)))[0]
    assert token("S2B_MSIL1C_20250413_R037_T30") == "R037" and token("S2B_R03_X") is None and token("R080") == "R080" and token("XR037_") is None
    assert one(spark, text.safe_id(F.lit("a b/ü-1")), text.safe_id(F.lit(""))) == ("a_b__-1", "area")
    assert text.fingerprint({"b": 1, "a": [0.3]}) == text.fingerprint({"a": [0.3], "b": 1}) and len(text.fingerprint({})) == 16
    assert one(spark, text.xml_number(F.lit('<X><Q u="none"> 10000</Q></X>'), "Q"))[0] == 10000.0


@pytest.mark.parametrize("date, want", [("2024-04-01", True), ("2024-08-31", True), ("2024-03-31", False), ("bad", False), (None, False)])
def test_season(spark, date, want):
    assert one(spark, C.in_season(F.lit(date).cast("string")))[0] is want
