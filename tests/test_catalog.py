import json

import pytest
from pyspark.sql import functions as F

from stratiform.operators.catalog import Catalog, checked_name, run_id, status_matrix
from stratiform.plans.workflow import Step, Workflow, config_hash
from stratiform.sources import scenes


def test_catalog_life(spark, tmp_path):
    db = Catalog(spark, str(tmp_path))
    new = spark.createDataFrame([("A", "/a", None), ("B", "/b", "0,0,5,5"), ("A", "/a", None)], "scene_id string, scene_path string, crop_window string")
    assert (db.stage(new), db.stage(new)) == (2, 0)
    ids = {r.scene_id: r.run_id for r in db.runs.collect()}
    assert ids["A"] == spark.range(1).select(run_id(F.lit("A"), F.lit(None))).first()[0]
    db.set_status(ids["A"], "started")
    row = db.runs.where(F.col("run_id") == ids["A"]).first()
    assert row.started_at and not row.completed_at
    assert db.reset_stale() == 1 and db.reset_stale() == 0
    db.set_status(ids["A"], "failed", "h", "boom")
    row = db.runs.where(F.col("run_id") == ids["A"]).first()
    assert (row.status, row.error, row.config_hash, row.completed_at is not None) == ("failed", "boom", None, True)
    db.set_status(ids["A"], "done", "h")
    row = db.runs.where(F.col("run_id") == ids["A"]).first()
    assert (row.status, row.error, row.config_hash) == ("done", None, "h")
    assert {r.status: r["count"] for r in db.count_by_status().collect()} == {"done": 1, "staged": 1}
    assert db.reset_to_staged([ids["A"], "nobody"]) == 1
    db.set_footprint(ids["B"], b"\x00\x01")
    assert bytes(db.runs.where(F.col("run_id") == ids["B"]).first().footprint) == b"\x00\x01"
    db.upsert_metadata(spark.createDataFrame([("A", 3.0)], "scene_id string, sun_zenith double"))
    db.upsert_metadata(spark.createDataFrame([("A", "T1")], "scene_id string, tile_id string"))
    assert (db.scenes.first().sun_zenith, db.scenes.first().tile_id) == (3.0, "T1")
    assert not db.has_stats("mask", "x")
    db.write_stats("mask", spark.createDataFrame([("x",)], "run_id string"))
    assert not db.has_stats("mask", "x")
    db.write_stats("mask", spark.createDataFrame([("x", 0.5)], "run_id string, clear_frac double"))
    db.write_stats("mask", spark.createDataFrame([("x", 7), ("y", 1 << 40)], "run_id string, n_pixels long"))
    assert sorted(map(tuple, db.table("stats_mask").select("run_id", "clear_frac", "n_pixels").collect())) == [("x", 0.5, 7), ("y", None, 1 << 40)]
    assert db.has_stats("mask", "x")
    db.delete(ids["A"])
    assert db.runs.count() == 1
    for bad in ("A", "1a", "a-b", "a; drop table runs"):
        with pytest.raises(ValueError, match="valid name"):
            checked_name(bad)


def test_two_writers_lose_nothing_and_a_break_leaves_the_old_table(spark, tmp_path, monkeypatch):
    one, two = Catalog(spark, str(tmp_path)), Catalog(spark, str(tmp_path))
    scene = lambda *names: spark.createDataFrame([(n, f"/{n}", None) for n in names], "scene_id string, scene_path string, crop_window string")
    one.stage(scene("A"))
    ids = {r.scene_id: r.run_id for r in one.runs.collect()}
    claim, entered = one._claim, []

    def late(name, version, data):  # before the first writer claims its number, the second one commits
        if not entered:
            entered.append(two.stage(scene("B", "C")))
        return claim(name, version, data)

    monkeypatch.setattr(one, "_claim", late)
    one.set_status(ids["A"], "started")
    assert entered == [2] and sorted((r.scene_id, r.status) for r in two.runs.collect()) == [("A", "started"), ("B", "staged"), ("C", "staged")]

    def broken(name, version, data):
        raise OSError("lost")

    monkeypatch.setattr(one, "_claim", broken)
    with pytest.raises(OSError, match="lost"):
        one.reset_stale()
    assert two.runs.count() == 3 and two.runs.where("status = 'started'").count() == 1
    for _ in range(4):
        two.set_status(ids["A"], "done", "h")
    assert len(two._versions("runs")) == 3


def test_started_runs_are_staged_again_whatever_the_gate_says(spark, tmp_path):
    db = Catalog(spark, str(tmp_path))
    db.stage(spark.createDataFrame([("A", "/a", None), ("B", "/b", None)], "scene_id string, scene_path string, crop_window string"))
    ids = {r.scene_id: r.run_id for r in db.runs.collect()}
    db.set_status(ids["A"], "done", "old")
    db.set_status(ids["B"], "started")
    with pytest.raises(RuntimeError, match="another configuration"):
        db.to_run("new")
    assert {r.scene_id: r.status for r in db.runs.collect()} == {"A": "done", "B": "staged"}
    assert sorted(r.scene_id for r in db.to_run("new", "overwrite").collect()) == ["A", "B"]


def test_status_matrix(spark):
    rows = spark.createDataFrame([("x", "a", "completed"), ("x", "b", "failed"), ("y", "b", "running")], "run_id string, step string, status string")
    assert sorted(map(tuple, status_matrix(rows, ("a", "b")).collect())) == [("x", "done", "FAILED"), ("y", "--", "--")]


def test_workflow():
    flow = Workflow((Step("mask", ("scene",), "mask"), Step("height", ("scene", "mask"), "height"), Step("albedo", ("mask",), "albedo")))
    assert flow.lifetimes() == {"scene": "height", "mask": "albedo"}
    with pytest.raises(ValueError, match="no earlier step"):
        Workflow((Step("height", ("mask",)),))
    assert len(config_hash("a: 1\n")) == 16


def test_scene_sources(spark, tmp_path):
    product = tmp_path / "S2A_X.SAFE" / "GRANULE"
    product.mkdir(parents=True)
    (product / "MTD.xml").write_text("<m><RADIO_ADD_OFFSET band_id='0'>-1000</RADIO_ADD_OFFSET><RADIO_ADD_OFFSET band_id='3'>-5</RADIO_ADD_OFFSET></m>")
    files = scenes.metadata_files(spark, str(tmp_path))
    assert [r.scene for r in files.collect()] == ["S2A_X"]
    assert sorted((r.band_idx, r.offset) for r in scenes.radiometric_offsets(files).collect()) == [(0, -1000.0), (3, -5.0)]
    assert scenes.exactly_one(files, ["scene"]).count() == 1
    with pytest.raises(Exception, match="several files for S2A_X"):
        scenes.exactly_one(files.unionByName(files), ["scene"]).collect()
    pts = spark.createDataFrame([(1.0, 2.0)], "x double, y double")
    scenes.write_points(pts, f"{tmp_path}/points", {"crs": "EPSG:32632"})
    back, meta = scenes.read_points(spark, f"{tmp_path}/points")
    assert meta == {"crs": "EPSG:32632"} and back.count() == 1
    (tmp_path / "manifests").mkdir()
    (tmp_path / "manifests" / "a.json").write_text(json.dumps({"run_id": "r", "steps": [{"step": "mask", "status": "completed"}, {"step": "height", "status": "failed"}]}))
    assert sorted((r.step, r.status) for r in scenes.manifests(spark, f"{tmp_path}/manifests").collect()) == [("height", "failed"), ("mask", "completed")]
    px = spark.range(100).selectExpr("id div 10 AS r", "id % 10 AS c")
    assert scenes.cropped(px, (2, 4, 4, 6), 0.5).count() == 6


def test_arrivals(spark, tmp_path):
    from stratiform.streaming import arrivals

    land = tmp_path / "land"
    land.mkdir()
    row = {"run_id": "r1", "scene_id": "A", "scene_path": "/a", "tile_id": "T", "sensing_time": "2024-01-01T10:00:00Z", "cloud": 0.5}
    for i, r in enumerate([row, row, row | {"run_id": "r2", "scene_id": "B", "cloud": 0.1}]):
        (land / f"{i}.json").write_text(json.dumps(r))
    db = Catalog(spark, f"{tmp_path}/db")
    stream = arrivals.arrivals(spark, str(land)).writeStream.foreachBatch(arrivals.stage_into(db)).option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    stream.awaitTermination(60)
    assert db.runs.count() == 2
    rolled = arrivals.daily_cloud(spark.read.schema(arrivals.MANIFEST).json(str(land)).dropDuplicates(["run_id"])).first()
    assert (rolled.n, round(rolled.cloud, 6)) == (2, 0.3)


def test_metadata_of_a_document_are_read_at_once(spark):
    xml = "<n1:m xmlns:n1='u'><a><Mean_Sun_Angle><ZENITH_ANGLE> 31.5 </ZENITH_ANGLE></Mean_Sun_Angle><ZENITH_ANGLE>7</ZENITH_ANGLE></a><PRODUCT_URI>A&amp;B</PRODUCT_URI><PRODUCT_URI>C</PRODUCT_URI><SENSING_TIME>2020-01-01T10:00:00</SENSING_TIME><RADIO_ADD_OFFSET band_id='2'/><RADIO_ADD_OFFSET band_id='3'>-5</RADIO_ADD_OFFSET></n1:m>"
    rows = spark.createDataFrame([(1, xml), (2, None), (3, "<m/>")], "scene int, xml string")
    more = scenes.product_metadata(F.col("xml"))
    made = rows.select("scene", more["product_uri"].alias("uri"), more["sensing_time"].cast("string").alias("at"), more["quantification"].cast("string").alias("q"), scenes.sun_angles(F.col("xml"))["sun_zenith"].cast("string").alias("z"))
    assert sorted(map(tuple, made.collect())) == [(1, "A&B", "2020-01-01 10:00:00", "NaN", "31.5"), (2, None, None, None, None), (3, None, None, "NaN", "NaN")]
    assert sorted(map(tuple, scenes.radiometric_offsets(rows).collect()), key=str) == [(1, 2, None), (1, 3, -5.0)]
