"""Clear-sky samples and the training of a model on them, against NumPy."""

import datetime
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratiform.functions import algebra as A
from stratiform.operators import sampling, training

H, W = 30, 36
RES = {"B02": 10.0, "B05": 20.0, "B01": 60.0}
SHAPES = {"B02": (30, 36), "B05": (15, 18), "B01": (5, 6)}


def test_least_by_hash_takes_the_least_of_every_key(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, None).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"), "id")
    rows = rows.union(rows.where("id = 3"))
    got = sampling.least_by_hash(rows, ["k"], ["id"], 40, 7).groupBy("k").agg(F.sort_array(F.collect_list("id")).alias("ids")).collect()
    hashed = rows.withColumn("h", F.xxhash64(F.lit(7), "id")).collect()
    want = {}
    for r in sorted(hashed, key=lambda r: (r.h, r.id)):
        want.setdefault(r.k, []).append(r.id)
    assert {r.k: r.ids for r in got} == {k: sorted(v[:40]) for k, v in want.items()}
    assert sampling.least_by_hash(rows.limit(0), ["k"], ["id"], 5, 1).count() == 0


@pytest.fixture(scope="module")
def world(spark):
    rng = np.random.default_rng(4)
    digital = {(s, b): rng.integers(0, 4, SHAPES[b]) * rng.integers(500, 3000, SHAPES[b]) for s in "abc" for b in RES}
    mask = {s: (rng.random((H, W)) < {"a": 0.004, "b": 0.95, "c": 0.01}[s]) * rng.integers(1, 3 if s == "b" else 4, (H, W)) for s in "abc"}
    frames = {
        "digital": spark.createDataFrame([(s, b, r, c, float(x[r, c])) for (s, b), x in digital.items() for r in range(x.shape[0]) for c in range(x.shape[1])], "scene string, band string, r int, c int, dn double"),
        "mask": spark.createDataFrame([(s, r, c, int(x[r, c])) for s, x in mask.items() for r in range(H) for c in range(W)], "scene string, r int, c int, v int"),
        "angles": spark.createDataFrame([(s, n, r, c, 10.0 * k + 3 * r + 2 * c) for s in "abc" for k, n in enumerate(sampling.ANGLES) for r in range(2) for c in range(2)], "scene string, name string, r int, c int, v double"),
        "scenes": spark.createDataFrame(
            [(s, [10.0, 0.0, 500_000.0, 0.0, -10.0, 5_000_000.0], 32, s == "c", None if s == "c" else datetime.datetime(2021, 3, 1, 10), None if s == "a" else 4.5, 30.0, 10_000.0) for s in "abc"],
            "scene string, transform array<double>, zone int, south boolean, sensing_time timestamp, wind_speed double, wind_direction double, quantification double",
        ),
    }
    return digital, mask, frames


def test_samples_are_as_the_rule_has_them(spark, world):
    digital, mask, frames = world
    offsets = spark.createDataFrame([("a", "B05", -1000.0)], "scene string, band string, offset double")
    feet = spark.range(H * W).select(F.lit("a").alias("scene"), F.floor(F.col("id") / W).cast("int").alias("r"), (F.col("id") % W).cast("int").alias("c"), F.lit(7).alias("v"))
    depth = lambda lat, lon: lat + lon
    got = sampling.clear_sky_samples(**frames, height=H, width=W, resolutions=RES, shapes=SHAPES, angle_shape=(2, 2), offsets=offsets, footprints=feet, bathymetry=depth, dilation=2, window_m=60.0).collect()
    assert {r.scene for r in got} == {"a", "c"}
    for s in "ac":
        rows = {(r.r, r.c): r for r in got if r.scene == s}
        cloud = np.isin(mask[s], (1, 2))
        want = set()
        for r in range(3, H - 3):
            for c in range(3, W - 3):
                if digital[s, "B02"][r, c] and not cloud[max(r - 2, 0) : r + 3, max(c - 2, 0) : c + 3].any():
                    want.add((r, c))
        assert rows.keys() == want and want
        for (r, c), row in rows.items():
            for b, (h, w) in SHAPES.items():
                scale, size = 10 / RES[b], int(60 / RES[b])
                y, x, a, z = min(int(r * scale), h - 1), min(int(c * scale), w - 1), size // 2, size - size // 2 - 1
                part = digital[s, b][max(y - a, 0) : y + z + 1, max(x - a, 0) : x + z + 1]
                part = part[part != 0] if size > 1 else part.ravel()
                mean = (part.mean() + (-1000 if (s, b) == ("a", "B05") else 0)) / 10_000
                assert math.isclose(row[b], mean, abs_tol=1e-12)
            assert math.isclose(row.view_zenith, 20 + 3 * r * 10 / 5000 + 2 * c * 10 / 5000, abs_tol=1e-9)
            assert (row.wind_speed, row.day_of_year, row.detector) == ((0.0, 60, 7) if s == "a" else (4.5, 0, 0))
            assert math.isclose(row.bathymetry, row.latitude + row.longitude)
            assert (45 < row.latitude < 45.2) if s == "a" else (-45.2 < row.latitude < -45)


def test_samples_are_bounded_and_repeat(spark, world):
    frames = world[2]
    one = lambda seed: sorted((r.scene, r.r, r.c) for r in sampling.clear_sky_samples(**frames, height=H, width=W, resolutions=RES, shapes=SHAPES, angle_shape=(2, 2), n_samples=25, window_m=0.0, dilation=0, seed=seed).collect())
    assert len(one(1)) == 50 and one(1) == one(1) != one(2)


def test_coarse_masks_and_shares(spark):
    ref = spark.createDataFrame([("s", r, c, 0.0 if r == 0 else 5.0) for r in range(4) for c in range(4)] + [("empty", 0, 0, 0.0)], "scene string, r int, c int, dn double")
    mask = spark.createDataFrame([("s", 0, 0, 1), ("s", 0, 1, 3), ("s", 1, 1, 2)], "scene string, r int, c int, v int")
    pixels = sampling.clear_pixels(ref, mask, 4, 4, mask_shape=(2, 2))
    assert {(r.r, r.c) for r in pixels.where("clear AND scene = 's'").collect()} == {(1, 2), (1, 3), (2, 0), (2, 1), (3, 0), (3, 1)}
    shares = {r.scene: (r.n_valid, r.clear_fraction, r.accepted) for r in sampling.clear_shares(pixels, 0.6).collect()}
    assert shares == {"s": (12, 0.5, False), "empty": (0, 0.0, False)}


def test_view_angles_over_detectors(spark):
    nan = float("nan")
    rows = [("s", d, r, c, v) for d, grid in enumerate([[[1.0, nan], [nan, nan]], [[3.0, 5.0], [nan, nan]]]) for r, line in enumerate(grid) for c, v in enumerate(line)]
    got = {(r.r, r.c): r.v for r in sampling.view_angle_grid(spark.createDataFrame(rows, "scene string, d int, r int, c int, v double"), ["scene"]).collect()}
    assert got == {(0, 0): 2.0, (0, 1): 5.0, (1, 0): 2.0, (1, 1): 5.0}


def test_gradient_is_the_slope_of_the_error():
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(20, 3)), rng.random((20, 2))
    model = training.Model(training.initial((3, 5, 4, 2), 1), (x.min(0), x.max(0)), (y.min(0), y.max(0)))
    found, total = training.gradient(model, x, y)
    start = training.flat(model.layers)
    for i in range(start.size):
        ends = []
        for step in (1e-5, -1e-5):
            moved = start.copy()
            moved[i] += step
            model.layers = training.shaped(moved, model.layers)
            ends.append(((model.predict(x) - y) ** 2).sum())
        assert abs(found[i] - (ends[0] - ends[1]) / 2e-5) < 1e-4
    assert total > 0 and training.widths(15, 13) == (15, 256, 256, 256, 128, 64, 32, 13)


def frame(spark, x, y):
    return spark.createDataFrame([(a.tolist(), b.tolist()) for a, b in zip(x, y, strict=True)], "f array<double>, t array<double>").repartition(5)


def test_training_equals_steps_over_whole_arrays(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 3))
    y = np.stack([x[:, 0] * 0.3 + 0.5, np.tanh(x[:, 1])], 1)
    odd = spark.createDataFrame([([1.0, None, 2.0], [1.0, 1.0]), ([1.0, 1.0, 1.0], [float("nan"), 0.0]), (None, [1.0, 1.0])], "f array<double>, t array<double>")
    fit = training.trained(frame(spark, x, y).unionByName(odd), frame(spark, x[:50], y[:50]), "f", "t", (3, 8, 2), epochs=4, batches=1, rate=0.02, halve_every=2, decay=0.01, seed=3)

    model = training.Model(training.initial((3, 8, 2), 3), (x.min(0), x.max(0)), (y.min(0), y.max(0)))
    w, m, v = training.flat(model.layers), 0.0, 0.0
    for k in range(4):
        rate = 0.02 / 2 ** (k // 2)
        g = training.gradient(model, x, y)[0] / y.size
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * 0.01 * w - rate * (m / (1 - 0.9 ** (k + 1))) / (np.sqrt(v / (1 - 0.999 ** (k + 1))) + 1e-8)
        model.layers = training.shaped(w, model.layers)
        assert abs(fit.history[k]["val_mae"] - np.abs(model.predict(x[:50]) - y[:50]).mean()) < 1e-9
    assert [h["rate"] for h in fit.history] == [0.02, 0.02, 0.01, 0.01]
    best = min(fit.history, key=lambda h: h["val_mae"])
    assert abs(np.abs(fit.predict(x[:50]) - y[:50]).mean() - best["val_mae"]) < 1e-9


def test_training_learns_and_stops(spark):
    rng = np.random.default_rng(5)
    x = rng.uniform(-1, 1, (2000, 2))
    y = (0.2 + 0.3 * x[:, :1] ** 2)
    fit = training.trained(frame(spark, x[:1600], y[:1600]), frame(spark, x[1600:], y[1600:]), "f", "t", (2, 16, 1), epochs=12, batches=3, rate=0.05)
    assert fit.history[-1]["val_mae"] < 0.5 * np.abs(y[1600:] - y[:1600].mean()).mean()
    still = training.trained(frame(spark, x, y), frame(spark, x[:9], y[:9]), "f", "t", (2, 4, 1), epochs=9, batches=1, rate=0.0, patience=2)
    assert len(still.history) == 3
    blind = training.trained(frame(spark, x, y), frame(spark, x, y).limit(0), "f", "t", (2, 4, 1), epochs=1, batches=1)
    assert math.isnan(blind.history[0]["val_mae"]) and not np.allclose(training.flat(blind.layers), training.flat(training.initial((2, 4, 1), 0)))
    with pytest.raises(ValueError):
        training.trained(frame(spark, x, y).limit(0), frame(spark, x, y), "f", "t", (2, 4, 1))


def test_features_of_samples_feed_training(spark, world):
    frames = world[2]
    rows = sampling.clear_sky_samples(**frames, height=H, width=W, resolutions=RES, shapes=SHAPES, angle_shape=(2, 2), n_samples=200, window_m=60.0, dilation=1)
    rows = rows.select(F.array(*A.features(*(F.col(n) for n in ("latitude", "longitude", "sun_zenith", "view_zenith", "sun_azimuth", "view_azimuth", "wind_speed", "wind_direction", "bathymetry", "day_of_year", "detector")))).alias("f"), F.array(*RES).alias("t"))
    fit = training.trained(rows, rows, "f", "t", training.widths(15, 3, 8, 2), epochs=1, batches=2)
    assert fit.predict(np.zeros((1, 15))).shape == (1, 3)
