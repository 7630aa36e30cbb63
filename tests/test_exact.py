"""Exact quantiles, nearest samples, fills and margins against NumPy on shapes that no window or bound would cover."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratiform.operators import grids, spatial, stats
from stratiform.operators.nearest import k_nearest


def test_quantiles_of_large_small_and_tied_groups(spark):
    rng = np.random.default_rng(5)
    groups = {"many": rng.normal(size=20_000), "ties": rng.integers(0, 3, 5000).astype(float), "one": np.array([4.0]), "two": np.array([1.0, 2.0])}
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs] + [("none", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(7)
    points = {f"p{p:03d}": p / 100 for p in (0, 1, 25, 50, 75, 99, 100)}
    got = {r.k: r for r in stats.quantiles(df, ["k"], "v", points).collect()}
    assert got.keys() == groups.keys()
    for k, vs in groups.items():
        assert np.allclose([got[k][n] for n in points], np.percentile(vs, [100 * p for p in points.values()]), atol=1e-12)
    assert stats.quantiles(df.limit(0), ["k"], "v", points).collect() == []


@pytest.mark.parametrize("a_task", [100, 1 << 18])
def test_quantiles_by_range_and_by_key_agree(spark, monkeypatch, a_task):
    """A key without a name, large and small keys, NaN and infinities; tasks follow the rows, not the session's partitions."""
    monkeypatch.setattr(stats, "ROWS", a_task)
    rng = np.random.default_rng(6)
    groups = {None: rng.normal(size=700), "hot": np.repeat([1.0, 2.0], [900, 3]), "odd": np.array([np.nan, np.inf, 1.0]), "ends": np.array([np.inf, np.inf]), "half": np.array([2.0, np.nan])}
    groups |= {f"s{i}": rng.normal(size=1 + i % 4) for i in range(300)}
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs] + [("s1", None), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    out = stats.summarised(df, ["k"], "v", [stats.Quantiles(low=0.1, median=0.5), F.count("v").alias("n"), F.count(F.lit(1)).alias("all")])
    got = {r.k: r for r in out.collect()}
    assert out.columns == ["k", "low", "median", "n", "all"] and got.keys() == groups.keys()
    for k, vs in groups.items():
        v = np.sort(vs)
        at = [0.1 * (len(v) - 1), 0.5 * (len(v) - 1)]
        want = [v[int(a)] if a == int(a) else (1 - a % 1) * v[int(a)] + a % 1 * v[int(a) + 1] for a in at]
        assert np.allclose([got[k].low, got[k].median], want, atol=1e-12, equal_nan=True) and (got[k].n, got[k].all) == (len(v), len(v) + (k == "s1"))
    if a_task > len(rows):
        assert out.rdd.getNumPartitions() == 1


def test_quantiles_of_one_constant_key_by_range(spark, monkeypatch):
    """The optimiser knows that such a key orders nothing; ranges keep their order all the same."""
    monkeypatch.setattr(stats, "ROWS", 100)
    v = np.random.default_rng(8).permutation(np.repeat(np.arange(500.0), 8))
    df = spark.createDataFrame([(i % 2, float(x)) for i, x in enumerate(v)], "b long, v double").repartition(6).withColumn("run", F.lit(1))
    got = {r.b: (r.low, r.median, r.high) for r in stats.quantiles(df, ["run", "b"], "v", {"low": 0.05, "median": 0.5, "high": 1.0}).collect()}
    assert got == {b: tuple(np.percentile(v[b::2], [5, 50, 100])) for b in (0, 1)}


def test_two_functions_of_one_step_and_one_that_fails(spark):
    px = spark.createDataFrame([(1, "B02", 0, 1.0), (1, "B02", 0, 3.0), (2, None, 4, 5.0)], "run_id long, band string, band_idx int, value double")
    runs = spark.createDataFrame([(1, "done"), (2, "done"), (3, "staged")], "run_id long, status string")
    failures = {}
    got = stats.run_stats(px, runs, ("step::mean", "step::nothing", "step::median"), failures=failures)["step"]
    assert list(failures) == ["step::nothing"] and got.columns.count("n_pixels") == 1
    rows = {(r.run_id, r.band): (r["mean"], r["median"], r.n_pixels) for r in got.collect()}
    assert rows == {(1, "b02"): (2.0, 2.0, 2), (2, "b04"): (5.0, 5.0, 1)}
    wide = stats.wide_stats(got, ("b02", "b04")).where("run_id = 1").first()
    assert (wide.b02__mean, wide.b02__median, wide.b02__n_pixels, wide.b04__mean) == (2.0, 2.0, 2, None)
    with pytest.raises(KeyError):
        stats.run_stats(px, runs, ("step::nothing",))
    assert stats.unprefixed(got).columns == ["run_id", "mean", "n_pixels", "median"]


@pytest.mark.parametrize("dims, n, k", [(2, 3000, 8), (4, 1500, 1), (1, 5, 9)])
def test_nearest_in_dense_and_empty_regions(spark, dims, n, k):
    rng = np.random.default_rng(dims)
    samples = np.concatenate([rng.normal(0, 1e-4, (n // 2, dims)), rng.uniform(-50, 50, (n - n // 2, dims))])
    samples[: n // 10] = samples[0]  # one place many times over
    queries = np.concatenate([rng.uniform(-60, 60, (80, dims)), rng.normal(0, 1e-4, (40, dims)), np.full((1, dims), 1e5)])
    names = [f"a{i}" for i in range(dims)]
    s = spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(samples)], ["sid", *names])
    q = spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(queries)] + [(999, *[float("nan")] * dims)], ["id", *names])
    got = {r.id: [x.sid for x in r.near] for r in k_nearest(q, s, names, names, k).collect()}
    d = np.sqrt(((queries[:, None] - samples[None]) ** 2).sum(2))
    assert got.keys() == set(range(len(queries)))
    for i in got:
        want = sorted(range(n), key=lambda j: (d[i, j], j))[:k]
        assert [round(d[i, j], 9) for j in got[i]] == [round(d[i, j], 9) for j in want]
    assert k_nearest(q, s.limit(0), names, names, k).collect() == []


def test_nearest_from_many_leaves_by_key(spark):
    """Queries far outside, ties, keys of which one fills few leaves and one has no sample."""
    rng = np.random.default_rng(7)
    samples = np.concatenate([rng.integers(0, 12, (900, 2)), rng.integers(0, 3, (7, 2))]).astype(float)
    queries = np.concatenate([rng.integers(-40, 50, (150, 2)), rng.uniform(0, 12, (50, 2))]).astype(float)
    s = spark.createDataFrame([(i, "a" if i < 900 else "b", *map(float, x)) for i, x in enumerate(samples)], "sid long, k string, sx double, sy double")
    q = spark.createDataFrame([(i, "abc"[i % 3], *map(float, x)) for i, x in enumerate(queries)], "id long, k string, x double, y double")
    got = {r.id: [(x.sid, x.row.sx) for x in r.near] for r in k_nearest(q, s, ["x", "y"], ["sx", "sy"], 8, keys=["k"], leaf=16).collect()}
    assert got.keys() == {i for i in range(200) if i % 3 < 2}
    d = np.sqrt(((queries[:, None] - samples[None]) ** 2).sum(2))
    for i, near in got.items():
        mine = range(900) if i % 3 == 0 else range(900, 907)
        assert near == [(j, samples[j, 0]) for j in sorted(mine, key=lambda j: (d[i, j], j))[:8]]


def test_table_entries_alike_give_the_least_value(spark):
    table = spark.createDataFrame([(a, 0.0, v) for v in (0.7, 0.2, 0.9) for a in (39.0, 41.0)] + [(2.0, 1.0, 0.5), (51.0, 1.0, 0.5)], "tau double, mu double, t double").repartition(5)
    q = spark.createDataFrame([(1, 40.0, 0.0), (2, 60.0, 3.0)], "id long, tau double, mu double")
    assert {(r.id, r.t) for r in spatial.lut_nearest(q, table, ["tau", "mu"], "id", "t").collect()} == {(1, 0.2), (2, 0.5)}


def test_more_samples_than_could_be_broadcast(spark):
    s = spark.range(1200).selectExpr("id AS sid", "cast(id % 40 AS double) AS sx", "cast(id div 40 AS double) AS sy", "cast(id AS double) AS value")
    cells = spark.createDataFrame([(1, 0.0, 0.0), (2, 39.0, 29.0)], "id long, x double, y double")
    got = {r.id: r.value for r in spatial.inverse_distance(cells, s, 1, 1.0).collect()}
    assert got == {1: 0.0, 2: 1199.0}


def test_fill_of_a_hole_larger_than_any_window(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(17, 23))
    x[2:16, 1:22] = np.nan
    x[rng.random(x.shape) < 0.2] = np.nan
    rows = [("a", r, c, float(x[r, c])) for r in range(17) for c in range(23)] + [("empty", 0, c, float("nan")) for c in range(3)]
    got = {(r.k, r.r, r.c): r.v for r in grids.nearest_filled(spark.createDataFrame(rows, "k string, r int, c int, v double"), ["k"]).collect()}
    have = np.argwhere(~np.isnan(x))
    for r in range(17):
        for c in range(23):
            near = min(have.tolist(), key=lambda p: ((p[0] - r) ** 2 + (p[1] - c) ** 2, p))
            assert got["a", r, c] == x[tuple(near)]
    assert got["empty", 0, 1] is None or got["empty", 0, 1] != got["empty", 0, 1]


def test_margins_wider_than_the_raster(spark):
    x = np.random.default_rng(1).integers(0, 4, (3, 4))
    grid = spark.createDataFrame([(0, r, c, int(x[r, c])) for r in range(3) for c in range(4)], "k int, r int, c int, v int")
    got = {(r.r, r.c): r.v for r in grids.shadow_reclassified(grid, ["k"], 3, 4, 9).collect()}
    wide = np.pad(x, 9, mode="symmetric")
    for r in range(3):
        for c in range(4):
            box = wide[r : r + 19, c : c + 19]
            cloud = x[r, c] == 3 and np.isin(box, (1, 2)).sum() > (box == 0).sum()
            assert got[r, c] == (1 if cloud else x[r, c])


def test_repeated_points_and_weights(spark):
    g = spark.createDataFrame([(0, r, c, float(10 * r + c)) for r in range(4) for c in range(4)], "k int, r int, c int, v double")
    p = spark.createDataFrame([(0, 1.5, 0.5), (0, 1.5, 0.5), (0, 9.0, 3.0)], "k int, y double, x double")
    got = grids.at_points(p, g, ["k"], F.col("y"), F.col("x"), 4, 4)
    assert sorted(r.v for r in got.collect()) == [15.5, 15.5, 33.0]
    line = grids.at_points(p.limit(1).select("k", F.lit(5.0).alias("y"), F.lit(-1.0).alias("x")), g, ["k"], F.col("y"), F.col("x"), 4, 4, extrapolate=True)
    assert line.first().v == 49.0
    h, w = 6, 5
    ys, xs = np.meshgrid(np.linspace(-h // 2, h // 2, h), np.linspace(-w // 2, w // 2, w), indexing="ij")
    kernel = np.exp(-(xs**2 / (2 * (w / 2) ** 2) + ys**2 / (2 * (h / 2) ** 2)))
    rows = spark.range(h * w).selectExpr(f"cast(id div {w} AS int) AS r", f"cast(id % {w} AS int) AS c").withColumn("k", grids.gaussian_weights(h, w, F.col("r"), F.col("c")))
    assert all(abs(r.k - (kernel / kernel.mean())[r.r, r.c]) < 1e-12 for r in rows.collect())


def test_points_of_which_the_grid_lacks_a_corner(spark):
    g = spark.createDataFrame([(1, r, c, None if (r, c) == (1, 2) else float(4 * r + c)) for r in range(2) for c in range(4)], "k int, r int, c int, v double")
    p = spark.createDataFrame([(1, 0.5, 0.25), (1, 0.5, 0.25), (1, 1.0, 0.0), (1, 0.0, 1.5)], "k int, y double, x double")
    got = grids.at_points(p, g, ["k"], F.col("y"), F.col("x"), 4, 4, whole=True)
    assert sorted((r.y, r.x, r.v is None, r.v or 0.0) for r in got.collect()) == [(0.0, 1.5, True, 0.0), (0.5, 0.25, False, 2.25), (0.5, 0.25, False, 2.25)]


def test_heights_over_dense_cells_make_no_row_a_pair(spark):
    rng = np.random.default_rng(4)
    xy, scores = rng.normal(0, 3, (700, 2)), rng.uniform(0, 1, (700, 5))
    r = spark.createDataFrame([(*map(float, p), list(map(float, s))) for p, s in zip(xy, scores, strict=True)], "rx double, ry double, scores array<double>")
    p = spark.createDataFrame([(i, *map(float, q)) for i, q in enumerate(xy[:300] + 0.1)] + [(300, 99.0, 99.0)], "id int, x double, y double")
    made = spatial.smoothed_heights(p, r, 1.0, [0.0, 1.0, 2.0, 3.0, 4.0])
    assert "MapInArrow" in made._jdf.queryExecution().executedPlan().toString()
    dx, dy = (xy[:300, None, k] + 0.1 - xy[None, :, k] for k in (0, 1))
    d = np.sqrt(dx**2 + dy**2)
    near = (abs(dx) <= 2) & (abs(dy) <= 2)
    w = np.where(near, np.exp(-0.5 * d**2) * scores.max(1) ** 2, 0)
    best = np.round(w @ scores / np.maximum(w.sum(1), 1e-300)[:, None], 9).argmax(1)
    seen = np.where(near, d, np.inf).min(1) < 1.5
    assert {x.id: x.height for x in made.collect()} == {i: float(best[i]) if seen[i] and best[i] > 0 else None for i in range(300)} | {300: None}
