"""Projects: life, resuming, gates, scenes that fail among others, manifests and statistics."""

import pytest
from pyspark.sql import functions as F

from stratiform.plans import project as projects
from stratiform.plans.project import Project, config_text, parsed_config
from stratiform.plans.workflow import Step, Workflow
from stratiform.sources import scenes as sources

CALLS: list[tuple[str, int]] = []


@projects.processor("mask")
def mask(tables, runs, config):
    CALLS.append(("mask", runs.count()))
    bad = F.raise_error(F.concat(F.lit("no band in "), F.col("scene_id")))
    px = tables["scene"].select("run_id", F.when(F.col("scene_id").startswith("bad"), bad).otherwise(F.length("scene_id") + config["add"]).cast("double").alias("value"))
    return px.select("run_id", F.lit("B02").alias("band"), F.lit(0).alias("band_idx"), "value")


@projects.processor("height")
def height(tables, runs, config):
    CALLS.append(("height", runs.count()))
    return tables["mask"].withColumn("value", F.col("value") * config["times"])


def flow(times=2, ephemeral=False):
    return Workflow((Step("mask", ("scene",), "mask", ephemeral, {"add": 1}), Step("height", ("mask",), "", False, {"times": times})))


def scene_table(spark, *names):
    return spark.createDataFrame([(n, f"/{n}", None) for n in names], "scene_id string, scene_path string, crop_window string")


def test_life_of_a_project(spark, tmp_path):
    p = Project.init(spark, f"{tmp_path}/p", "one", flow(), ("height::mean", "height::nothing", "height::median"))
    with pytest.raises(FileExistsError):
        Project.init(spark, f"{tmp_path}/p", "two", flow())
    assert Project.load(spark, f"{tmp_path}/p").config == p.config
    assert p.stage(scene_table(spark, "a", "bb", "bad1", "ccc", "bad2")) == 5 and p.output("height") is None
    CALLS.clear()
    state = {r.run_id: (r.status, r.error) for r in p.run().collect()}
    ids = {r.scene_id: r.run_id for r in p.catalog.runs.collect()}
    assert [state[ids[n]][0] for n in ("a", "bb", "ccc", "bad1", "bad2")] == ["done"] * 3 + ["failed"] * 2
    assert "no band in bad1" in state[ids["bad1"]][1] and state[ids["a"]][1] is None
    assert {r.run_id: r.value for r in p.output("height").collect()} == {ids["a"]: 4.0, ids["bb"]: 6.0, ids["ccc"]: 8.0}
    assert {r.run_id: (r["mask"], r["height"]) for r in p.status().collect()} == {ids[n]: ("FAILED", "--") if n.startswith("bad") else ("done", "done") for n in ids}
    read = {(r.run_id, r.step): r.status for r in sources.manifests(spark, f"{tmp_path}/p/manifests").collect()}
    assert len(read) == 8 and read[ids["bad2"], "mask"] == "failed" and read[ids["bb"], "height"] == "completed"
    assert list(p.statistics()) == ["height::nothing"]
    rows = {r.run_id: (r["mean"], r["median"], r.n_pixels) for r in p.catalog.table("stats_height").collect()}
    assert rows[ids["bb"]] == (6.0, 6.0, 1) and len(rows) == 3
    # what failed is tried again alone; what is done stays
    CALLS.clear()
    assert {r.status for r in p.run().collect()} == {"failed"} and ("mask", 3) not in CALLS and max(n for _, n in CALLS) == 2
    other = p.clone(f"{tmp_path}/q", "two")
    assert other.catalog.runs.where("status = 'staged'").count() == 5 and other.output("mask") is None
    other.delete()
    with pytest.raises(FileNotFoundError):
        Project.load(spark, f"{tmp_path}/q")


def test_changed_configuration_resumes_at_its_step(spark, tmp_path):
    p = Project.init(spark, f"{tmp_path}/p", "one", flow())
    p.stage(scene_table(spark, "a", "bb"))
    p.run()
    p.config["steps"][1]["config"]["times"] = 10
    with pytest.raises(RuntimeError, match="another configuration"):
        p.run()
    assert p.run("ignore").count() == 0 and p.output("height") is None
    CALLS.clear()
    assert {r.status for r in p.run("overwrite").collect()} == {"done"}
    assert CALLS == [("height", 2)] and sorted(r.value for r in p.output("height").collect()) == [20.0, 30.0]
    CALLS.clear()
    assert {r.status for r in p.run(force=True).collect()} == {"done"} and CALLS == [("mask", 2), ("height", 2)]
    assert p.output("height").count() == 2


def test_lost_inputs_are_made_again(spark, tmp_path):
    p = Project.init(spark, f"{tmp_path}/p", "one", flow(ephemeral=True))
    p.stage(scene_table(spark, "a"))
    p.run()
    p.config["steps"][1]["config"]["times"] = 3
    CALLS.clear()
    p.run("overwrite")
    assert CALLS == [("mask", 1), ("height", 1)]


def test_configuration_text():
    config = {"b": [1, "x"], "a": "word", "hash": "computed", "n": None}
    text = config_text(config, ("hash",))
    assert text == 'a: "word"\nb: [1, "x"]\nn: null\n' and parsed_config("# note\n\n" + text) == {"a": "word", "b": [1, "x"], "n": None}
    assert parsed_config("a: plain word\nb: 'quoted'\nc:\n") == {"a": "plain word", "b": "quoted", "c": None}
    with pytest.raises(ValueError, match="not a line"):
        parsed_config("  nested: 1\n")
