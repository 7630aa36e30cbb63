import numpy as np
from pyspark.sql import functions as F

from stratiform.functions import noise


def test_noise_has_the_stated_spread(spark):
    rows = spark.range(4000).withColumn("refl", F.array(F.lit(0.2), F.lit(0.5), F.lit(0.8)))
    spans = F.array(F.lit(1.0), F.lit(2.0), F.lit(0.0))
    out, target = noise.noisy(F.col("refl"), spans, 3, F.col("id"))
    got = rows.select("id", out.alias("x"), target.alias("t"))
    x = {r.id: r.x for r in got.collect()}
    assert x == {r.id: r.x for r in rows.repartition(5).select("id", out.alias("x")).collect()}
    assert x != {r.id: r.x for r in rows.select("id", noise.noisy(F.col("refl"), spans, 4, F.col("id"))[0].alias("x")).collect()}
    for r in got.collect():
        assert np.allclose(r.t, np.clip(2 * (np.array(r.x) - [0.2, 0.5, 0.8]) / [1, 2, 1], -1, 1))

    def values(**scales):
        none = {"gain": 0.0, "band_gain": 0.0, "offset": 0.0, "band_offset": (0.0, 0.0)}
        made = noise.noisy(F.col("refl"), spans, 3, F.col("id"), **none | scales)[0]
        return np.array([r.x for r in rows.select(made.alias("x")).collect()])

    clean = np.array([0.2, 0.5, 0.8])
    assert np.allclose(values(), clean)
    gain = values(gain=0.05) / clean
    assert np.allclose(gain, gain[:, :1]) and abs(gain.std() - 0.05) < 0.003 and abs(gain.mean() - 1) < 0.004
    band = values(band_gain=0.02) / clean
    assert abs(np.corrcoef(band.T)[0, 1]) < 0.06 and np.allclose(band.std(0), 0.02, atol=0.002)
    shift = values(offset=0.01) - clean
    assert np.allclose(shift, shift[:, :1]) and abs(shift[:, 0].std() - 0.01 * 0.5) < 0.0004
    own = (values(band_offset=(0.001, 0.01)) - clean) / [1, 2, 1]
    # scales between 0.001 and 0.01: the mean square is that of the uniform distribution
    assert np.allclose((own**2).mean(0), (0.01**3 - 0.001**3) / 3 / 0.009, rtol=0.15)


def test_shading_mixture(spark):
    rows = spark.range(20_000).select((F.col("id") % 400).alias("bag"), F.col("id").alias("sample"))
    tau = noise.mixed_shading(F.col("bag"), F.col("sample"), 50.0, 9)
    got = {r.sample: r.tau for r in rows.select("sample", tau.alias("tau")).collect()}
    assert got == {r.sample: r.tau for r in rows.repartition(7).select("sample", tau.alias("tau")).collect()}
    v = np.array(list(got.values()))
    assert v.min() == 0 and v.max() == 50 and 0.01 < (v == 0).mean() < 0.15 and 0.02 < (v == 50).mean() < 0.3
    spread = np.array([np.std(np.log(v[v > 0][:50]))])
    assert spread[0] > 0.2
    # three modes in ten lie below 1.4, and a logarithmic one with centre c does with the chance that its draws stay below
    assert 0.4 < (v < 1.4).mean() < 0.7


def test_integrity_gate(spark, tmp_path):
    import pytest

    from stratiform.operators.catalog import Catalog

    found = Catalog(spark, f"file://{tmp_path}/project")
    scenes = spark.createDataFrame([(s, f"/{s}", None) for s in "abcd"], "scene_id string, scene_path string, crop_window string")
    assert found.stage(scenes) == 4
    ids = {r.scene_id: r.run_id for r in found.runs.collect()}
    found.set_status(ids["a"], "done", "old")
    found.set_status(ids["b"], "done", "new")
    found.set_status(ids["c"], "started")
    with pytest.raises(RuntimeError, match="1 done run"):
        found.to_run("new")
    names = lambda rows: sorted(r.scene_id for r in rows.collect())
    assert names(found.to_run("new", gate="ignore")) == ["c", "d"]
    assert {r.scene_id: r.status for r in found.runs.collect()} == {"a": "done", "b": "done", "c": "staged", "d": "staged"}
    assert names(found.to_run("new", scenes=scenes.where("scene_id = 'a'"))) == ["a"]  # named scenes pass the gate, whatever their status
    assert names(found.to_run("new", force=True)) == ["a", "b", "c", "d"]
    assert names(found.to_run("new", gate="overwrite")) == ["a", "c", "d"]
    assert {r.scene_id: r.config_hash for r in found.runs.collect()}["a"] is None
    with pytest.raises(ValueError):
        found.to_run("new", gate="maybe")
