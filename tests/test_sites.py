import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from emberline.fixtures import over
from emberline.operators import cluster as C
from emberline.operators import review as R
from emberline.plans import commands

DETECTION = "id string, lon double, lat double, date string, max_b12 double, max_b11 double, b12_b11_ratio double, radiance double, sun_elevation double"
DATES = [f"2024-{m:02}-{d:02}" for m in (5, 6, 7, 8) for d in (5, 15, 25)]
OPTIONS = C.ClusterOptions(min_dates=4, min_avg_b12=0.5)


def frame(spark, rows):
    return spark.createDataFrame([(f"d{k:03}", -102.0, 32.0, date, b12, b11, None, 1.0, sun) for k, (date, b12, b11, sun) in enumerate(rows)], DETECTION)


def sites(spark, rows, options=OPTIONS):
    return C.cluster(frame(spark, rows), options)[0].collect()


def test_glint_and_flares_are_told_apart(spark):
    glint = sites(spark, [(d, 1.41, 1.40, 65.0) for d in DATES])[0]
    flare = sites(spark, [(d, 0.9, 0.4, 65.0) for d in DATES])[0]
    assert glint.likely_glint and glint.median_b12_b11_ratio == pytest.approx(1.41 / 1.40) and "likely_glint" in glint.flags and glint.seasonal
    assert not flare.likely_glint and flare.median_b12_b11_ratio > 1.5 and flare.flags == ["seasonal"]


def test_unknown_bands_stay_unknown(spark):
    s = sites(spark, [(d, 0.9, None, None) for d in DATES[:4]])[0]
    assert (s.median_b12_b11_ratio, s.min_sun_elevation, s.likely_glint, s.max_ratio, s.min_glint) == (None,) * 5 and s.glint_suspect is False


def test_border_of_glint(spark):
    assert not sites(spark, [(d, 1.0, 0.78, None) for d in DATES])[0].likely_glint
    assert sites(spark, [(d, 1.0, 0.83, None) for d in DATES])[0].likely_glint


def test_repeated_dates_count_once_and_stay_members(spark):
    s, m = C.cluster(frame(spark, [("2024-05-05", 0.9, 0.4, None), ("2024-05-05", 0.8, 0.4, None), ("2024-06-05", 0.7, 0.4, None), ("2024-07-05", 0.6, 0.4, None)]), C.ClusterOptions(min_dates=3, min_avg_b12=0.5))
    assert s.first().date_count == 3 and m.count() == 4


def test_score_gate_comes_before_looks(spark):
    rows = [(d, 0.9, 0.9, None) for d in DATES]
    assert sites(spark, rows, C.ClusterOptions(min_dates=4, min_avg_b12=0.5, score_least=0.5)) == []
    assert len(sites(spark, rows)) == 1


def test_no_merging_makes_each_detection_a_site(spark):
    s, m = C.cluster(frame(spark, [(d, b, 0.4, None) for d, b in zip(DATES, (0.9, 0.4, 0.7))]), C.ClusterOptions(0.0, 4, 0.5))
    assert s.count() == 2 == m.count()


def test_rescore_counts_own_cell_else_neighbours(spark):
    s, m = C.cluster(frame(spark, [(d, 0.9, 0.4, None) for d in DATES[:4]]), OPTIONS)
    looks = lambda *rows: C.rescore(s, spark.createDataFrame(list(rows), "i long, j long, date string, cloud double"), m).first()
    own = looks((-102000, 32000, "2024-01-01", 0.1), (-102000, 32000, "2024-01-02", 0.2), (-101999, 32000, "2024-01-03", 0.0))
    assert own.n_obs == 5 and own.persistence_score == pytest.approx(4 / 5)
    near = looks((-102000, 32000, "2024-01-02", None), (-101999, 32001, "2024-01-03", 0.0), (-102001, 31999, "2024-05-05", 0.0))
    assert near.n_obs == 5
    assert looks((0, 0, "2024-01-01", 0.0)).persistence_score == 1


def slow_lead(lon, lat, metres):
    size, leaders, out = metres / 111320.0, [], []
    for n in range(len(lon)):
        best, near = n, math.inf
        cell = lambda k: (math.floor(lat[k] / size), math.floor(lon[k] / size))
        for k in sorted((k for k in leaders if abs(cell(k)[0] - cell(n)[0]) <= 1 and abs(cell(k)[1] - cell(n)[1]) <= 1), key=lambda k: (cell(k), leaders.index(k))):
            dy, dx = math.radians(lat[k] - lat[n]), math.radians(lon[k] - lon[n]) * math.cos(math.radians((lat[k] + lat[n]) / 2))
            d = 6371000.0 * math.sqrt(dx * dx + dy * dy)
            if d <= metres and d < near:
                best, near = k, d
        if best == n:
            leaders.append(n)
        out.append(best)
    return out


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 60)), min_size=1, max_size=60))
def test_leaders_equal_a_plain_replay(points):
    lon, lat = np.array([51 + x * 2e-4 for x, _ in points]), np.array([25 + y * 2e-4 for _, y in points])
    assert C.lead(lon, lat, 135.0).tolist() == slow_lead(lon.tolist(), lat.tolist(), 135.0)


def test_fields_in_parallel_equal_one_replay(spark, small):
    d = over(spark, small, "fx_chained").cache()
    rows = sorted(d.collect(), key=lambda r: (-r.max_b12, r.event_id))
    want = slow_lead([r.lon for r in rows], [r.lat for r in rows], 135.0)
    got = {r.id: r.leader_id for r in C.assign_leaders(d, 135.0, ("event_id",)).collect()}
    assert got == {r.id: rows[k].id for r, k in zip(rows, want)}


CANDIDATE = "key string, target string, date string, centre_lon double, centre_lat double, origin_lon double, origin_lat double, wu double, wv double, anchor_m double, max_p double, flux_kg_h double, clear_percent double, sun_elevation double, cross_orbit_bg boolean, collinearity double"
CLEAN = dict(key="t:2025-01-01:p", target="t", date="2025-01-01", centre_lon=-3.230, centre_lat=54.096, origin_lon=-3.235, origin_lat=54.096, wu=8.0, wv=0.0, anchor_m=40.0, max_p=0.97, flux_kg_h=4700.0, clear_percent=100.0, sun_elevation=35.0, cross_orbit_bg=False, collinearity=0.05)


def verdicts(spark, *changes):
    rows = [tuple((CLEAN | c).values()) for c in changes]
    return {r.key: r for r in R.triage(spark.createDataFrame(rows, CANDIDATE)).collect()}


@pytest.mark.parametrize(
    "change, rejects, flags, score",
    [
        ({}, [], [], 1.0), ({"max_p": 0.59}, ["p-floor"], [], 0.0), ({"flux_kg_h": 0.0}, ["zero-flux"], [], 0.0), ({"flux_kg_h": 54000.0}, [], ["magnitude"], 0.8), ({"wu": -8.0}, [], ["crosswind"], 0.75),
        ({"centre_lon": -3.235}, [], ["static"], 0.8), ({"anchor_m": 900.0}, [], ["unanchored"], 0.75), ({"cross_orbit_bg": True}, [], ["cross-orbit-bg"], 0.75), ({"collinearity": 0.8}, ["collinear"], [], 0.0),
        ({"collinearity": 0.3}, [], ["boundary"], 0.75), ({"sun_elevation": 12.0, "clear_percent": 30.0}, [], ["low-sun", "cloud-residue"], 0.75), ({"sun_elevation": None, "collinearity": None, "wu": 0.0}, [], [], 1.0),
    ],
)
def test_triage_of_one(spark, change, rejects, flags, score):
    v = verdicts(spark, change)["t:2025-01-01:p"]
    assert (v.rejects, v.flags, v.score) == (rejects, flags, pytest.approx(score))


def test_recurrence_needs_another_date_and_wind(spark):
    again = {"key": "b", "date": "2025-02-02", "wu": 0.0, "wv": 8.0, "centre_lon": -3.2301}
    v = verdicts(spark, {}, again)
    assert v["b"].rejects == ["recurrent"] == v["t:2025-01-01:p"].rejects
    assert verdicts(spark, {}, again | {"date": "2025-01-01"})["b"].rejects == []
    assert verdicts(spark, {}, again | {"wu": 8.0, "wv": 0.1})["b"].rejects == []
    assert verdicts(spark, {}, again | {"target": "u"})["b"].rejects == []


def test_recurrence_equals_all_pairs(spark):
    r = random.Random(8)
    rows = [{"key": f"k{k}", "target": r.choice("ab"), "date": f"2025-01-{r.randint(1, 9):02}", "centre_lon": -3 + r.random() * 0.02, "centre_lat": 54 + r.random() * 0.01, "wu": r.uniform(-5, 5), "wv": r.uniform(-5, 5)} for k in range(120)]
    want = set()
    for a in rows:
        for b in rows:
            lat = math.radians((a["centre_lat"] + b["centre_lat"]) / 2)
            d = math.hypot((b["centre_lon"] - a["centre_lon"]) * 111320 * math.cos(lat), (b["centre_lat"] - a["centre_lat"]) * 110540)
            cosine = (a["wu"] * b["wu"] + a["wv"] * b["wv"]) / (math.hypot(a["wu"], a["wv"]) * math.hypot(b["wu"], b["wv"]))
            if a["target"] == b["target"] and a["date"] != b["date"] and d < 250 and math.degrees(math.acos(max(-1, min(1, cosine)))) > 45:
                want.add(a["key"])
    d = spark.createDataFrame([tuple((CLEAN | x).values()) for x in rows], CANDIDATE)
    assert {x.key for x in R.recurrent_keys(d).collect()} == want and 0 < len(want) < 120


def test_same_day_regime_and_rank(spark):
    v = verdicts(spark, {}, {"key": "x", "target": "u"}, {"key": "y", "date": "2025-03-03", "max_p": 0.1})
    assert v["x"].flags == ["scene-regime"] and v["y"].flags == []
    rows = [tuple((CLEAN | c).values()) for c in ({"key": "r", "max_p": 0.1}, {"key": "b", "anchor_m": 900.0}, {"key": "a", "anchor_m": 900.0}, {"key": "z"})]
    assert [r.key for r in commands.review_command(spark.createDataFrame(rows, CANDIDATE)).collect()] == ["z", "a", "b", "r"]


def test_collinear_masks(spark):
    pixels = spark.createDataFrame([("on", k, float(k * 10), 0.5) for k in range(20)] + [("off", k, float(k * 10), 5000.0 + k) for k in range(20)] + [("two", k, float(k), 0.0) for k in range(2)], "mask string, id long, x double, y double")
    lines = spark.createDataFrame([(1, 0.0, 0.0, 200.0, 0.0)], "segment long, ax double, ay double, bx double, by double")
    got = {r["mask"]: r["collinearity"] for r in R.collinearity(pixels, lines).collect()}
    assert got["on"] == pytest.approx(1) and got["off"] == 0 and got["two"] is None


def test_ranked_report_is_not_empty(spark, small):
    from emberline.catalog import QUERIES

    assert QUERIES["sites_ranked"](spark, small).count() > 0


def test_masks_that_spread_alike_have_the_axis_of_the_sql(spark, tmp_path):
    import duckdb

    from emberline import catalog

    masks = [[9, 10, 17, 18], [4, 19, 20, 31, 40, 41, 45, 51, 62], [14, 18, 61, 51], [4, 10, 21, 27], [17, 26, 29, 50]]
    rows = [(k, [0.4 if n in on else 0.0 for n in range(64)]) for k, on in enumerate(masks)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    duckdb.sql(f"CREATE OR REPLACE TEMP VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    want = dict(duckdb.sql(catalog.ORACLE_SQL["collinearity"]).fetchall())
    assert {r[0]: r[1] for r in catalog.QUERIES["collinearity"](spark, str(tmp_path)).collect()} == want and len(want) == 5
