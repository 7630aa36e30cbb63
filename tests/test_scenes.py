"""Cubic resizing, strips, heights, albedo and tables of several axes against NumPy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratiform.functions import algebra as A
from stratiform.operators import albedo, grids, resize, spatial, stereo
from stratiform.sources import scenes


def frame(spark, x: np.ndarray, scene=0):
    return spark.createDataFrame([(scene, r, c, float(x[r, c])) for r in range(x.shape[0]) for c in range(x.shape[1])], "scene int, r int, c int, v double")


def dense_axis(n: int, m: int) -> np.ndarray:
    """The same operator by solving the spline system of the mirrored line: (m, n)."""
    fold = lambda i: resize.mirror(np.atleast_1d(i), n)
    sigma = max(0.0, (n / m - 1) / 2)
    g = np.zeros((n, n))
    radius = int(4 * sigma + 0.5) if sigma else 0
    weights = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2) if radius else np.ones(1)
    for i in range(n):
        for k, w in zip(range(-radius, radius + 1), weights / weights.sum(), strict=True):
            g[i, fold(i + k)[0]] += w
    b = np.zeros((n, n))
    for i in range(n):
        for k, w in ((-1, 1 / 6), (0, 4 / 6), (1, 1 / 6)):
            b[i, fold(i + k)[0]] += w
    at = np.zeros((m, n))
    basis = lambda u: (2 / 3 - u**2 + abs(u) ** 3 / 2) if abs(u) < 1 else max(2 - abs(u), 0) ** 3 / 6
    for o in range(m):
        x = (o + 0.5) * n / m - 0.5
        for k in range(math.floor(x) - 1, math.floor(x) + 3):
            at[o, fold(k)[0]] += basis(x - k)
    return at @ np.linalg.inv(b) @ g


@pytest.mark.parametrize("shape, new", [((9, 70), (20, 31)), ((5, 6), (5, 6)), ((1, 8), (3, 2)), ((67, 3), (7, 9))])
def test_cubic_resize_against_a_dense_solve(spark, shape, new):
    x = np.random.default_rng(1).normal(size=shape) * 100
    got = {(r.r, r.c): r.v for r in resize.resized(frame(spark, x), ["scene"], *shape, *new).collect()}
    want = np.clip(dense_axis(shape[0], new[0]) @ x @ dense_axis(shape[1], new[1]).T, x.min(), x.max()) if min(shape) > 1 else None
    assert len(got) == new[0] * new[1]
    if want is not None:
        assert all(abs(got[k] - want[k]) < 1e-8 for k in got)
    whole = resize.to_resolution(frame(spark, np.round(x)), ["scene"], *shape, 20, 20)
    assert whole.count() == x.size


def test_resolution_and_whole_numbers(spark):
    x = np.arange(64.0).reshape(8, 8) - 30
    got = resize.to_resolution(frame(spark, x), ["scene"], 8, 8, 10, 20, whole_numbers=True).collect()
    assert {(r.r, r.c) for r in got} == {(r, c) for r in range(4) for c in range(4)} and all(r.v == int(r.v) for r in got)


def test_rotated_strips_and_planted_height(spark):
    """Bands that a cloud's height moves along a slanted track: every strip inside the scene finds it, whichever way it looks."""
    rng, names, res, angle, h = np.random.default_rng(4), ["B02", "B03", "B04"], 10.0, 0.3, 4300.0
    size = 130
    y, x = np.mgrid[0:size, 0:size].astype(float)
    waves = [(rng.normal(0, 0.35, 2), rng.uniform(0, 6)) for _ in range(40)]
    field = lambda yy, xx: sum(np.sin(k[0] * yy + k[1] * xx + p) for k, p in waves)
    along = np.array([math.cos(angle), math.sin(angle)])  # (y, x) of one step along a strip
    bands = None
    for b, off in zip(names, stereo.offsets(h, names, res), strict=True):
        one = frame(spark, field(y + off * along[0], x + off * along[1])).withColumn("band", F.lit(b))
        bands = one if bands is None else bands.unionByName(one)
    seen = lambda d: bands.select("scene", "band", "r", "c", F.lit(d).alias("detector"))
    points = stereo.strip_points(spark.createDataFrame([(0,)], "scene int"), size * res, size * res, angle, 100.0, 150.0, 10.0, 2.5)
    some = points.where("strip = 3 AND i % 7 = 0").collect()
    for p in some:  # the strip's points are those of an upright one, turned about the corner and moved along the edge
        u, v = p.j * 10.0, -100.0 + p.i * 2.5
        assert abs(p.x - (u * math.cos(angle) + v * math.sin(angle) + 450)) < 1e-9 and abs(p.y - (-u * math.sin(angle) + v * math.cos(angle))) < 1e-9
    sizes = dict.fromkeys(names, res)
    samples = stereo.sampled_bands(points, bands, sizes, dict.fromkeys(names, (size, size)))
    heights = [0.0, 2150.0, 4300.0, 6450.0, 8600.0]
    shape = stereo.strip_shape(size * res, angle, 100.0, 10.0, 2.5)
    owned = samples.join(stereo.strip_detectors(points, seen(7), sizes), ["scene", "strip"])
    found = stereo.matched(owned.where("v IS NOT NULL"), shape, heights, names, 60, 40, 2.5).collect()
    assert len(found) > 10 and all(int(np.argmax(r.scores)) == 2 for r in found)
    mixed = bands.select("scene", "band", "r", "c", F.when((F.col("band") == "B03") & (F.col("r") > 100), 8).otherwise(7).alias("detector"))
    assert {r.strip for r in stereo.strip_detectors(points, mixed, sizes).collect()} < {r.strip for r in found} | set(range(20))


def test_correlation_is_the_mean_over_pairs():
    rng = np.random.default_rng(2)
    patches, weights = [rng.normal(size=(6, 5)) for _ in range(4)] + [np.full((6, 5), 2.0)], stereo.kernel(6, 5)
    z = [(p - p.mean()) / (p.std() or 1) for p in patches]
    want = np.mean([(z[i] * z[j] * weights).mean() for i in range(5) for j in range(i + 1, 5)])
    assert abs(stereo.correlation(patches, weights) - want) < 1e-12 and stereo.correlation(patches[:1], weights) == 0
    assert abs(weights.mean() - 1) < 1e-12 and math.isnan(stereo.correlation([np.full((6, 5), np.nan), patches[0]], weights))


def test_grid_of_heights(spark):
    scenes = spark.createDataFrame([(0,), (1,)], "scene int")
    points = stereo.grid_points(scenes, 300.0, 200.0, 100.0)
    found = spark.createDataFrame([(0, 0.0, 0.0, [0.1, 0.9, 0.9]), (0, 100.0, 200.0, [0.9, 0.1, 0.1]), (1, 0.0, 0.0, [0.1, 0.2, 0.9])], "scene int, x double, y double, scores array<double>")
    got = {(r.scene, r.gr, r.gc): r.height for r in stereo.gridded(points, found, 40.0, [0.0, 500.0, 1000.0]).collect()}
    assert len(got) == 12 and got[0, 0, 0] == 500.0 and got[1, 0, 0] == 1000.0 and got[0, 2, 1] is None and got[0, 1, 0] is None
    mask = spark.createDataFrame([(0, 0, 0, False), (1, 0, 0, True)], "scene int, r int, c int, cloud boolean")
    got = {(r.scene, r.gr, r.gc): r.height for r in stereo.gridded(points, found, 40.0, [0.0, 500.0, 1000.0], mask, (3, 2), (300.0, 200.0)).collect()}
    assert got[0, 0, 0] is None and got[1, 0, 0] == 1000.0


def test_albedo_gates_and_values_below_zero(spark):
    v = np.full((12, 12), 3000.0)
    digital = frame(spark, v).select("scene", "r", "c", F.lit("B02").alias("band"), F.col("v").alias("dn"))
    digital = digital.unionByName(digital.withColumns({"band": F.lit("B03"), "dn": F.lit(50.0)}))
    mask = frame(spark, v * 0).select("scene", "r", "c", F.lit(False).alias("cloud"))
    run = lambda d, m, **o: albedo.estimated(d, m, 12, 12, 10.0, 60.0, {"B02": 0.05, "B03": 0.03}, {"B03": -100.0}, window_m=10.0, **o).collect()
    got = {(r.band, r.r, r.c): (round(r.albedo, 9), r.method, r.n_samples) for r in run(digital, mask)}
    assert got == {(b, r, c): (0.3 if b == "B02" else 0.0, "idw", 144) for b in ("B02", "B03") for r in (0, 1) for c in (0, 1)}
    nine = mask.withColumn("cloud", ~((F.col("r") < 3) & (F.col("c") < 3)))
    assert {(r.method, r.albedo) for r in run(digital, nine)} == {("constant", 0.05), ("constant", 0.03)}
    assert {r.method for r in run(digital, nine, min_clear=0.5)} == {"constant"}
    assert {(r.method, r.n_samples) for r in run(digital, mask.limit(0))} == {("constant", 0)}
    dark = digital.withColumn("dn", F.when(F.col("r") < 6, 0.0).otherwise(F.col("dn")))
    assert {r.r for r in run(dark, mask) if r.albedo is None} == {0}
    spread = {(r.method, r.n_samples) for r in run(digital, mask, max_samples=20)}
    assert spread == {("idw", 20)}


def test_several_axes_and_missing_corners(spark):
    xs, ys = [0.0, 1.0, 10.0], [0.0, 5.0]
    lut = spark.createDataFrame([(a, x, y, a * 100 + 2 * x + 3 * y + x * y) for a in (1.0, 2.0) for x in xs for y in ys], "a double, x double, y double, t double")
    q = spark.createDataFrame([(1, 1.0, 0.5, 2.0), (2, 2.0, 7.0, 5.0), (3, 1.0, -3.0, 9.0), (4, 3.0, 1.0, 1.0), (5, 1.0, None, 1.0), (1, 1.0, 0.5, 2.0)], "id int, a double, x double, y double")
    got = sorted((r.id, None if r.t is None else round(r.t, 9)) for r in spatial.lut_interpolated(q, lut, ["x", "y"], ["a"], "t").collect())
    assert got == [(1, 108.0), (1, 108.0), (2, 264.0), (3, 115.0), (4, None)]
    holed = lut.where("NOT (a = 1 AND x = 1 AND y = 5)")
    assert {r.id: r.t for r in spatial.lut_interpolated(q, holed, ["x", "y"], ["a"], "t").collect()}[1] is None


def test_features_in_the_order_of_the_model(spark):
    names = ["sin_lat", "cos_lat", "sin_lon", "cos_lon", "cos_sun_zenith", "cos_view_zenith", "sin_relative_azimuth", "cos_relative_azimuth", "wind_speed", "sin_wind_direction", "cos_wind_direction", "log_depth", "sin_day", "cos_day", "detector_parity"]
    cols = [F.lit(x) for x in (0.0, 90.0, 60.0, 0.0, 100.0, 10.0, 7.0, 90.0, -1000.0, 0, 3)]
    row = spark.range(1).select(*A.features(*cols)).first()
    assert row.__fields__ == names and np.allclose(list(row), [0, 1, 1, 0, 0.5, 1, 1, 0, 7, 1, 0, 3, 0, 1, 1], atol=1e-12)
    gone = [F.lit(float("nan")) if i % 2 else F.lit(None).cast("double") for i in range(10)]
    assert list(spark.range(1).select(*A.features(*gone)).first()) == [0.0] * 15


def test_angle_of_the_orbit(spark):
    v = np.zeros((30, 40), int)
    r, c = np.mgrid[0:30, 0:40]
    v[2:, 3:] = np.where(r * 2 > 20 + c, 6, 5)[2:, 3:]
    v[:, 30:] = 5
    got = grids.orbit_angles(frame(spark, v.astype(float)), ["scene"]).first().angle
    kept = v[2:, 3:]
    y0 = np.flatnonzero(np.diff(kept[:, 0]) == 1)[0]
    assert abs(got + np.arctan2(26, y0 - 0)) < 1e-12
    assert grids.orbit_angles(frame(spark, np.ones((4, 4))), ["scene"]).first().angle == 0.0


def test_rasters_are_not_broadcast(spark):
    """However small their files are: each row of a file may hold many cells."""
    g = spark.range(4).select(F.lit(1).alias("scene"), F.lit("B02").alias("band"), F.col("id").cast("int").alias("r"), F.explode(F.sequence(F.lit(0), F.lit(63))).alias("c"), F.rand(1).alias("v"))
    points = stereo.strip_points(g.select("scene").dropDuplicates(), 40.0, 640.0, 0.0, 80.0, 80.0, 10.0, 10.0)
    for made in (stereo.sampled_bands(points, g, {"B02": 10.0}, {"B02": (4, 64)}), stereo.strip_detectors(points, g.withColumn("detector", F.lit(1)), {"B02": 10.0}).select("scene")):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and plan.count("BroadcastHashJoin") == 0


def test_resizing_a_raster_that_ends_early(spark):
    """Rows that are not there count as 0; new rows that none of the others reaches are left out."""
    x = np.random.default_rng(2).normal(size=(80, 9))
    x[6:] = 0
    whole = {(r.r, r.c): r.v for r in resize.resized(frame(spark, x), ["scene"], 80, 9, 50, 12).collect()}
    got = {(r.r, r.c): r.v for r in resize.resized(frame(spark, x).where("r < 6"), ["scene"], 80, 9, 50, 12, absent_as_zero=True).collect()}
    assert max(r for r, _ in got) == 22 and len(got) == 23 * 12  # floor(22.5 * 1.6 - 0.5) less 1 of the spline, 28 and 1 is row 5
    assert all(abs(got[at] - whole[at]) < 1e-9 for at in got)


def test_cells_of_other_bands_only_are_stacked_too(spark):
    layers = spark.createDataFrame([(1, 0, 0, "B04", 0.5), (1, 0, 0, "B03", 0.25), (1, 0, 1, "B01", 0.1)], "scene int, r int, c int, band string, v double")
    assert sorted(map(tuple, grids.stacked(layers, ["scene"], ("B04", "B03")).collect())) == [(1, 0, 0, 0.5, 0.25), (1, 0, 1, None, None)]


def test_cells_whose_digital_number_is_zero_null_or_absent(spark):
    g = spark.createDataFrame([(1, 0, c, 1.0 + c) for c in range(4)], "scene int, r int, c int, v double")
    digital = spark.createDataFrame([(1, 1, 1, 7), (1, 1, 3, 0), (1, 1, 5, None)], "scene int, r int, c int, v int")
    assert sorted(map(tuple, grids.valid_where_seen(g, digital, ["scene"], 2, 8, 2.0).select("c", "v").collect()), key=str) == [(0, 1.0), (1, None), (2, None)]


def test_metadata_of_scenes_are_not_broadcast(spark):
    """Scenes may be millions, whatever size Spark guesses from their file."""
    xml = F.format_string("<m><QUANTIFICATION_VALUE>%d</QUANTIFICATION_VALUE><RADIO_ADD_OFFSET band_id='0'>-1000</RADIO_ADD_OFFSET><RADIO_ADD_OFFSET band_id='2'/></m>", F.when(F.col("id") == 0, 10000).otherwise(5000))
    docs = spark.range(3).select(F.col("id").alias("scene"), xml.alias("xml"))
    quantification, offsets = docs.select("scene", scenes.product_metadata(F.col("xml"))["quantification"].alias("quantification")), scenes.radiometric_offsets(docs)
    px = spark.createDataFrame([(0, 0, 3000), (0, 1, 3000), (1, 0, 3000), (1, 2, 500), (2, 0, 0), (9, 0, 1)], "scene long, band_idx int, dn int")
    for q, o in ((quantification, offsets), scenes.radiometry(docs)):
        made = scenes.reflectance(px, q, o)
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 2 and "Broadcast" not in plan
        assert sorted((r.scene, r.band_idx, r.reflectance) for r in made.collect()) == [(0, 0, 0.2), (0, 1, 0.3), (1, 0, 0.4), (1, 2, 0.1), (2, 0, None)]
    assert "Python" not in plan  # documents are read once, before
