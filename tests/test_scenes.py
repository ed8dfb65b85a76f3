import json

import pytest
from pyspark.sql import functions as F

from emberline.operators import scenes as S
from emberline.plans import commands
from emberline.sources import areas, manifest, records, stac
from emberline.storage import scratch

SCENE = "id string, mgrs string, date string, cloud_cover double, west double, south double, east double, north double"


def scene(k, tile="30UXB", date="2026-01-01", cloud=10.0, west=0.0, south=50.0):
    return (k, tile, date, cloud, west, south, west + 1, south + 1)


def test_clearest_takes_unknown_cloud_last_and_breaks_ties(spark):
    d = spark.createDataFrame([scene("b", cloud=None), scene("a", cloud=100.0), scene("d", date="2026-01-02", cloud=5.0), scene("c", date="2026-01-02", cloud=5.0)], SCENE)
    assert sorted(r.id for r in S.clearest(d).collect()) == ["a", "c"]


def test_twins_stay_unknown(spark):
    d = spark.createDataFrame([scene("a"), scene("b", tile="31UXB")], SCENE)
    m = spark.createDataFrame([("30UXB", "2026-01-01", 50.0, "far"), ("30UXB", "2026-01-01", 2.0, "near")], "mgrs string, date string, cloud_cover double, mask string")
    assert {r.id: r["mask"] for r in S.with_twins(d, m).collect()} == {"a": "near", "b": None}


def test_areas_meet_scenes_once(spark):
    d = spark.createDataFrame([scene("big", west=-2.5)[:6] + (2.4, 54.2), scene("edge", west=3.0), scene("late", date="2027-01-01"), scene("cloudy", cloud=90.0), scene("round")[:4] + (-179.0, 0.0, 179.0, 60.0)], SCENE)
    a = spark.createDataFrame([("x", -1.2, 50.5, 3.0, 52.5), ("point", 3.5, 50.5, 3.5, 50.5)], "area string, west double, south double, east double, north double")
    got = sorted((r.area, r.id) for r in S.scenes_of_areas(d, a, "2026-01-01", "2026-12-31", 50).collect())
    assert got == [("point", "edge"), ("x", "big"), ("x", "edge")]


def test_boxes_merge_in_chains():
    assert S.disjoint([(0, 0, 1, 1), (5, 5, 6, 6), (0.5, 0.5, 2, 2), (1.9, 1.9, 5.5, 5.5)]) == [(0, 0, 6, 6)]
    assert S.disjoint([(0, 0, 1, 1), (2, 2, 3, 3)]) == [(0, 0, 1, 1), (2, 2, 3, 3)]
    assert S.widen((1, 1, 1, 2))[0] < 1 and S.widen((0, 0, 1, 1)) == (0, 0, 1, 1)


def test_windows_tile_without_gap():
    parts = S.split_window("2018-01-01", "2026-12-31", 5)
    import datetime as dt

    day = dt.date.fromisoformat
    assert len(parts) == 5 and parts[0][0] == "2018-01-01" and parts[-1][1] == "2026-12-31"
    assert all((day(b[0]) - day(a[1])).days == 1 for a, b in zip(parts, parts[1:]))
    assert S.split_window("2026-01-01", "2026-01-03", 5) == [("2026-01-01", "2026-01-03")] and S.split_window("x", "y", 3) == [("x", "y")]


def test_shards_part_the_features(spark):
    d = spark.range(10).withColumnRenamed("id", "position")
    assert sorted(r.position for k in range(3) for r in S.shard(d, k, 3).collect()) == list(range(10))


def test_strict_backgrounds_before_loose(spark):
    c = spark.createDataFrame([("t", "near", 10, 70.0, 0.1), ("t", "far", 900, 96.0, 0.9), ("u", "only", 5, 66.0, 0.4), ("u", "hazy", 4, 60.0, 0.0)], "target_id string, background_id string, gap_s long, clear_percent double, dissimilarity double")
    assert {r.target_id: r.background_id for r in S.choose_background(c).collect()} == {"t": "far", "u": "only"}


def test_items_resolve(spark):
    item = {"id": "S2B_X", "bbox": [1, 2, 3, 4], "properties": {"datetime": "2026-03-04T05:06:07Z", "eo:cloud_cover": 12.5, "grid:code": "MGRS-30UXB"}, "assets": {"B11": {"href": "s3://x/T_B11.jp2"}, "b12": {"href": "s3://x/T_B12.jp2"}}}
    r = S.resolve_bands(spark.createDataFrame([(json.dumps(item),)], "item string"), "l1c").first()
    assert (r.id, r.date, r.cloud_cover, r.mgrs, r.epsg, r.north) == ("S2B_X", "2026-03-04", 12.5, "30UXB", 32630, 4.0)
    assert r.bands.b10 == "s3://x/T_B10.jp2" and r.bands.b12.endswith("B12.jp2") and r.bands.b02 is None


def test_radiometry_by_metadata_else_date(spark):
    xml = '<M><RADIO_ADD_OFFSET band_id="0">-500</RADIO_ADD_OFFSET></M>'
    d = spark.createDataFrame([("2021-01-01", None), ("2022-01-25", None), ("2021-01-01", xml)], "date string, xml string")
    assert [tuple(r) for r in d.select(*S.radiometry(F.col("date"), F.col("xml"))).collect()] == [(0.0, 10000.0), (-1000.0, 10000.0), (-500.0, 10000.0)]


def test_requests_retry_and_page():
    waits, calls = [], []

    def post(payload):
        calls.append(payload)
        if len(calls) == 1:
            raise stac.Refused(429, 3.0)
        if len(calls) == 2:
            raise stac.Refused(503)
        return {"features": [{"id": len(calls)}], "links": [{"rel": "next", "body": {"token": 9}}] if len(calls) == 3 else []}

    got = list(stac.pages(post, {"limit": 1}, waits.append))
    assert len(got) == 2 and waits == [3.0, 2, stac.PAUSE] and calls[-1] == {"limit": 1, "token": 9}
    with pytest.raises(stac.Refused):
        stac.request(lambda p: (_ for _ in ()).throw(stac.Refused(404)), {}, waits.append)
    with pytest.raises(ValueError):
        stac.request(lambda p: "<html>", {}, waits.append)
    assert "bbox" in stac.body("c", [(0, 0, 1, 1)], "a", "b", 5) and stac.body("c", [(0, 0, 1, 1), (2, 2, 3, 3)], "a", "b", 5)["intersects"]["type"] == "MultiPolygon"


def test_catalogue_source(spark, tmp_path):
    for k in range(2):
        (tmp_path / f"{k}.json").write_text(json.dumps({"features": [{"id": f"s{k}{n}"} for n in range(3)]}))
    spark.dataSource.register(stac.StacSource)
    d = spark.read.format("stac_items").options(collection="c", boxes="[[0,0,1,1],[0.5,0.5,2,2]]", start="2026-01-01", end="2026-02-01", transport=f"folder:{tmp_path}").load()
    assert sorted(json.loads(r.item)["id"] for r in d.collect()) == ["s00", "s01", "s02", "s10", "s11", "s12"]


def test_manifest_round_trip_and_refusal(spark):
    d = spark.createDataFrame([("A", "2026-01-01", 5.0), ("B", "2026-01-02", None)], "id string, date string, cloud_cover double")
    head = manifest.Header("src", manifest.digest(b"areas"), "2026-01-01", "2026-12-31")
    path = scratch(spark, "manifest")
    manifest.write_manifest(d, head, path)
    got, scenes = manifest.read_manifest(spark, path)
    assert got == head and {r.id: r.cloud_cover for r in scenes.collect()} == {"A": 5.0, "B": None}
    got.check("src", head.areas_sha256, "2026-02-01", "2026-03-01")
    for bad in (("other", head.areas_sha256, "2026-02-01", "2026-03-01"), ("src", "x", "2026-02-01", "2026-03-01"), ("src", head.areas_sha256, "2025-12-31", "2026-03-01")):
        with pytest.raises(ValueError):
            got.check(*bad)


def test_areas_and_lines(spark, tmp_path):
    shapes = {"features": [
        {"id": "a", "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [2, 0], [2, 1.5], [0, 0]]]}, "properties": {"name": "A"}},
        {"geometry": {"type": "LineString", "coordinates": [[0, 0], [1, 1], [2, -1e0]]}, "properties": {"ProjectID": "P", "TerminalName": "T"}},
        {"geometry": {"type": "MultiLineString", "coordinates": [[[5, 5], [6, 6]]]}, "properties": {}},
        {"geometry": {"type": "Point", "coordinates": [7.5, 8.5]}, "properties": {"name": ""}},
    ]}
    (tmp_path / "x.geojson").write_text(json.dumps(shapes, indent=1))
    got = areas.read_areas(spark, str(tmp_path / "x.geojson")).orderBy("position").collect()
    assert [(r.area, r.name) for r in got] == [("a", "A"), ("P", "T"), ("2", "2"), ("3", "3")]
    assert (got[1].west, got[1].south, got[1].east, got[1].north) == (0, -1, 2, 1) and got[3].west == got[3].east == 7.5
    lines = areas.line_segments(areas.read_areas(spark, str(tmp_path / "x.geojson")).select("area", "geometry")).groupBy("area").count().collect()
    assert {r.area: r["count"] for r in lines} == {"a": 3, "P": 2, "2": 1}


def test_gaps_and_overlay(spark):
    e = spark.createDataFrame([("a",), ("b",), ("b",)], "area string")
    s = spark.createDataFrame([("a",), ("a",)], "area string")
    assert [r.area for r in commands.gaps(e.distinct(), s).collect()] == ["b"]
    assert tuple(commands.verify(e, s, s).first()) == (2, 1, 1, 2)
    old = spark.createDataFrame([(0, "alpha", "A", "{1}", "x", "x", "x"), (1, "beta", "B", "{2}", "x", "x", "x")], "position int, id string, name string, geometry string, start string, end string, scanned string")
    new = spark.createDataFrame([(0, "beta", "B2", "{3}"), (1, "gamma", None, "{4}"), (2, "delta", "D", None)], "position int, id string, name string, geometry string")
    got = commands.coverage(old, new, "s", "e", "n").orderBy("order").collect()
    assert [(r.id, r.name, r.geometry, r.start) for r in got] == [("alpha", "A", "{1}", "x"), ("beta", "B2", "{3}", "s"), ("gamma", "", "{4}", "s")]


def test_records_resume_and_publish(spark, tmp_path):
    d = spark.createDataFrame([("s1", 1.0, 2.0, 0.9, 3, True), ("s1", 1.0, 2.0, 1.9, 4, True), ("s2", 5.0, 6.0, 0.7, 1, False)], "scene string, lon double, lat double, max_b12 double, pixels int, cloud_free boolean")
    recs = records.analysis_records(records.flare_features(d), "own/v1", "flares", "f00")
    body = {r.scene: json.loads(r.record) for r in recs.collect()}
    assert [f["properties"]["max_b12"] for f in body["s1"]["features"]] == [1.9, 0.9] and "cloud_free" not in body["s1"]["features"][0]["properties"]
    path = scratch(spark, "records")
    records.write_records(recs, path)
    asked = spark.createDataFrame([("s1",), ("s2",), ("s3",)], "id string")
    done = records.read_records(spark, path)
    left = lambda method: sorted(r.id for r in records.remaining(asked, done, "own/v1", "flares", method).collect())
    assert left("f00") == ["s3"] and left("f01") == ["s1", "s2", "s3"]
    (tmp_path / "in" / "k").mkdir(parents=True)
    for name in ("a.json", "k/b.json", "c.err", "k/d.part"):
        (tmp_path / "in" / name).write_text("x")
    assert records.publish(spark, str(tmp_path / "in"), str(tmp_path / "out")) == 2 and (tmp_path / "out/k/b.json").exists() and not (tmp_path / "out/c.err").exists()


def test_tables_and_lists(spark, tmp_path):
    f = lambda s: spark.range(1).select(records.flag_list(F.lit(s).cast("string"))).first()[0]
    assert f("a;b") == ["a", "b"] and f("") == [] == f(None)
    (tmp_path / "a.csv").write_text("x,y\n1,\n")
    (tmp_path / "b.csv").write_text("y,z\n2,3\n")
    got = records.read_csvs(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]).collect()
    assert sorted((r.x, r.y, r.z) for r in got if r.x) == [("1", None, None)] and len(got) == 2
    spark.range(5).select(F.col("id").cast("string").alias("id"), F.lit(1.0).alias("lon"), F.concat(F.lit("2024-01-0"), (F.col("id") + 1).cast("string")).alias("date")).write.parquet(str(tmp_path / "d"))
    d = records.read_detections(spark, str(tmp_path / "d"), "2024-01-02", "2024-01-04")
    assert d.count() == 3 and "glint_score" in d.columns


def test_lost_connections_are_tried_again_and_requests_are_paced(monkeypatch):
    from emberline.sources import stac

    waits, answers = [], [ConnectionResetError(), TimeoutError(), stac.Refused(429, 2.0), {"features": []}]

    def post(payload):
        out = answers.pop(0)
        if isinstance(out, Exception):
            raise out
        return out

    monkeypatch.setattr(stac, "PACE", stac.Pace())
    assert stac.request(post, {}, waits.append) == {"features": []}
    assert waits == [1, 2, 2.0] and stac.PACE.requests == 4
    stac.request(lambda p: {}, {}, waits.append)
    assert waits == [1, 2, 2.0, stac.PAUSE]
    answers[:] = [ConnectionResetError()] * 7
    with pytest.raises(ConnectionResetError):
        stac.request(post, {}, waits.append)
    with pytest.raises(ValueError):
        stac.request(lambda p: "<html>", {}, waits.append)


def test_only_the_flat_axis_grows():
    assert S.widen((1.0, 2.0, 1.0, 3.0)) == (1.0 - 1e-6, 2.0, 1.0 + 1e-6, 3.0)
    assert S.widen((1.0, 2.0, 2.0, 3.0)) == (1.0, 2.0, 2.0, 3.0)


def test_a_clear_scene_behind_many_hazy_ones_is_chosen(spark):
    rows = [("t", f"hazy{k:02d}", 100 + k, 10.0, 0.0) for k in range(40)] + [("t", "clear", 900, 96.0, 0.5)]
    rows += [("u", f"c{k:02d}", 100 + k, 99.0, 1.0 - k / 100) for k in range(30)]
    c = spark.createDataFrame(rows, "target_id string, background_id string, gap_s long, clear_percent double, dissimilarity double")
    assert {r.target_id: r.background_id for r in S.choose_background(c).collect()} == {"t": "clear", "u": "c19"}


def test_area_keys_do_not_depend_on_how_the_json_is_written(spark):
    from emberline.functions import text

    d = spark.createDataFrame([('{"type":"Point","coordinates":[1.5,2]}',), ('{ "coordinates": [1.5, 2], "type": "Point" }',), ('{"coordinates":[1.5,3],"type":"Point"}',)], "g string")
    keys = [r[0] for r in d.select(text.area_key(F.lit("a b"), F.col("g"))).collect()]
    assert keys[0] == keys[1] != keys[2]
    import hashlib

    assert keys[0] == "a_b-" + hashlib.sha256(b'{"coordinates":[1.5,2],"type":"Point"}').hexdigest()[:8]


def test_methods_are_known_by_all_their_parameters():
    from emberline.functions import text

    a, b = text.method("swir", "e/1", {"peak": 0.5, "pixels": 3}), text.method("swir", "e/1", {"pixels": 3, "peak": 0.5})
    assert a["fingerprint"] == b["fingerprint"] != text.method("swir", "e/1", {"peak": 0.6, "pixels": 3})["fingerprint"]


def test_records_of_two_detectors_and_methods_stay(spark):
    d = spark.createDataFrame([("s1", 1.0, 2.0, 0.9)], "scene string, lon double, lat double, max_b12 double")
    path, rows = scratch(spark, "records"), records.flare_features(d)
    for detector, method in (("flares", "f0"), ("clouds", "c0"), ("flares", "f1"), ("flares", "f0")):
        records.write_records(records.analysis_records(rows, "own/v1", detector, method), path)
    got = sorted((r.detector, r.fingerprint) for r in records.read_records(spark, path).collect())
    assert got == [("clouds", "c0"), ("flares", "f0"), ("flares", "f1")]


def test_review_as_csv(spark, tmp_path):
    d = spark.createDataFrame([("k", ["a", "b"], 1.5), ("l", [], None)], "key string, flags array<string>, score double")
    records.write_csv(d, str(tmp_path / "review"))
    assert sorted((r.key, r.flags, r.score) for r in spark.read.option("header", True).csv(str(tmp_path / "review")).collect()) == [("k", "a;b", "1.5"), ("l", None, None)]


def test_nearest_background_is_looked_up_as_the_sql_says(spark, small, tmp_path):
    """Also where rows repeat, and as from the listed pairs."""
    import duckdb

    from emberline import catalog

    orders = spark.read.parquet(f"{small}/orders.parquet")
    orders.union(orders.filter("o_orderkey % 3 = 0")).union(orders.filter("o_orderkey % 15 = 0")).coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    duckdb.sql(f"CREATE OR REPLACE TEMP VIEW orders AS SELECT * FROM read_parquet('{tmp_path}/orders.parquet/*.parquet')")
    want = sorted(duckdb.sql(catalog.ORACLE_SQL["nearest_background"]).fetchall())
    assert sorted(map(tuple, catalog.QUERIES["nearest_background"](spark, str(tmp_path)).collect())) == want and len(want) > 1000

    scenes = orders.selectExpr("concat('s', o_orderkey) as id", "'T' as mgrs", "cast(o_orderkey % 99 as double) as cloud_cover", "timestamp_seconds(o_orderkey % 40 * 400000) as time", "o_orderkey % 97 as clear_percent", "o_orderkey as by").limit(300)
    d = lambda a, b: (a * 31 + b * 17) % 100 / 100.0
    side = lambda n: scenes.select(F.col("id").alias(f"{n}_id"), F.col("by").alias(n), F.col("clear_percent").alias(f"{n}_clear"))
    pairs = S.background_candidates(scenes).join(side("target"), "target_id").join(side("background"), "background_id").withColumns({"clear_percent": F.col("background_clear"), "dissimilarity": d(F.col("target"), F.col("background"))})
    for strict in (95.0, 96.0):
        got = {tuple(r) for r in S.nearest_clear(scenes, d, strict=strict).collect()}
        assert got == {tuple(r) for r in S.choose_background(pairs, strict=strict).collect()} and len(got) > 100


def test_background_pairs_are_whole_and_few_more_are_looked_at(spark):
    times = [k * 190_000 - 40 * 86400 for k in range(400)] + [-86400 * 120, 0, 300, 299, 86400 * 120, 86400 * 120 + 1]
    clouds = [None if k % 19 == 0 else float(k % 101) for k in range(len(times))]
    scenes = spark.createDataFrame([(f"s{k}", "T", c, t) for k, (t, c) in enumerate(zip(times, clouds))], "id string, mgrs string, cloud_cover double, t long").selectExpr("id", "mgrs", "cloud_cover", "timestamp_seconds(t) as time")
    got = sorted(map(tuple, S.background_candidates(scenes).collect()))
    reach = 120 * 86400
    want = sorted((f"s{a}", f"s{b}", abs(x - y)) for a, x in enumerate(times) for b, y in enumerate(times) if clouds[b] is not None and clouds[b] <= 95 and 300 <= abs(x - y) <= reach)
    assert got == want and len(got) > 10_000
    target, other = S.reach_sides(scenes, reach, 95.0)
    assert target.join(other, ["mgrs", "bucket"]).count() < 1.15 * len(got)


def test_background_pairs_move_scenes_not_buckets(spark):
    scenes = spark.range(3000).selectExpr("concat('s', id) as id", "concat('T', id % 3) as mgrs", "cast(id % 101 as double) as cloud_cover", "timestamp_seconds(id * 50000 - 40000000) as time")
    pairs = S.background_candidates(scenes)
    pairs.collect()
    moved, todo = [], [pairs._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            node = node.executedPlan()
        while node.nodeName().endswith("QueryStage"):
            node = node.plan()
        if node.nodeName() == "Exchange":
            moved.append(node.metrics().apply("shuffleRecordsWritten").value())
        todo += [node.children().apply(k) for k in range(node.children().size())]
    assert 3000 <= sum(moved) <= 3.01 * 3000


def test_background_pairs_equal_the_sql_on_odd_rows(spark, small, tmp_path):
    """Scenes that repeat, without a tile or a date, and of batches of a few rows."""
    import duckdb

    from emberline import catalog

    orders = spark.read.parquet(f"{small}/orders.parquet").filter("o_orderkey % 2 = 1")
    odd = orders.filter("o_orderkey % 3 = 0").selectExpr(*[f"cast(null as {t}) as {c}" if c in ("o_custkey", "o_orderdate") else c for c, t in orders.dtypes])
    orders.union(orders.filter("o_orderkey % 5 = 0")).union(odd).coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    duckdb.sql(f"CREATE OR REPLACE TEMP VIEW orders AS SELECT * FROM read_parquet('{tmp_path}/orders.parquet/*.parquet')")
    want = sorted(duckdb.sql(catalog.ORACLE_SQL["background_candidates"]).fetchall())
    assert sorted(map(tuple, catalog.QUERIES["background_candidates"](spark, str(tmp_path)).collect())) == want and len(want) > 1000
    scenes = spark.createDataFrame([(k, "T", None, k * 40_000) for k in range(500)], "id long, mgrs string, cloud_cover double, t long").selectExpr("id", "mgrs", "coalesce(cloud_cover, 1) as cloud_cover", "timestamp_seconds(t) as time")
    now = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
        got = sorted(map(tuple, S.background_candidates(scenes).collect()))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", now)
    assert got == [(a, b, abs(a - b) * 40_000) for a in range(500) for b in range(500) if 0 < abs(a - b) * 40_000 <= 120 * 86400]
