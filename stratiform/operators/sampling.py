"""Training samples of surface reflectance at clear pixels, with the conditions under which they were seen: all scenes in one plan."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.algebra import map_x, map_y, utm_to_degrees
from .grids import at_points, dilated, mean_over_layers, nearest_filled

ANGLES = ("sun_zenith", "sun_azimuth", "view_zenith", "view_azimuth")
#: Hashes are counted in 2^BIN_BITS bins, so that only those of one bin a key have to be ranked.
BIN_BITS = 12


def _same(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join by keys of which null is one."""
    named = right.withColumnsRenamed({k: f"__on_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"__on_{k}")) for k in keys]
    return left.join(named, on, how).drop(*(f"__on_{k}" for k in keys))


def least_by_hash(rows: DataFrame, keys: list[str], columns: list[str], n: int, seed: int) -> DataFrame:
    """n rows of each key without replacement (all where there are fewer), the same ones on every run: those of which ``columns`` have
    the least hashes.

    Hashes are counted by bins, which says in which bin the n-th lies; rows beyond it are dropped before anything is sorted, and
    rows are ranked by key and bin, so that no task holds a key.
    """
    hashed = rows.withColumn("__h", F.xxhash64(F.lit(seed), *columns)).withColumn("__bin", F.shiftright("__h", 64 - BIN_BITS))
    counts = hashed.groupBy(*keys, "__bin").agg(F.count(F.lit(1)).alias("__n"))
    counts = counts.withColumn("__upto", F.sum("__n").over(W.partitionBy(*keys).orderBy("__bin")))
    ends = counts.where(F.col("__upto") >= n).groupBy(*keys).agg(F.min("__bin").alias("__last"), F.min_by(F.col("__upto") - F.col("__n"), "__bin").alias("__before"))
    near = _same(hashed, ends, keys, "left").where("__last IS NULL OR __bin <= __last")
    rank = F.row_number().over(W.partitionBy(*keys, "__bin").orderBy("__h", *columns))
    kept = near.withColumn("__rank", rank).where(F.col("__last").isNull() | (F.col("__bin") < F.col("__last")) | (F.col("__rank") <= n - F.col("__before")))
    return kept.select(*rows.columns)


def view_angle_grid(layers: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, r, c, v): the mean over the grids of all detectors and bands, cells that none of them covers as the nearest one that is."""
    return nearest_filled(mean_over_layers(layers, keys), keys)


def angles_at(points: DataFrame, angles: DataFrame, height: int, width: int, resolution: float, step: float = 5000.0) -> DataFrame:
    """Points (scene, r, c and more) with the columns of ANGLES, linear between the grids' nodes and beyond their ends.

    angles: scene, name (one of ANGLES), r, c, v: grids of height x width nodes, ``step`` metres apart from the first pixel on.
    """
    each = points.select("scene", "r", "c").dropDuplicates().withColumn("name", F.explode(F.array(*map(F.lit, ANGLES))))
    scale = F.lit(resolution / step)
    each = each.select("scene", "name", F.col("r").alias("pr"), F.col("c").alias("pc"))
    found = at_points(each, angles, ["scene", "name"], F.col("pr") * scale, F.col("pc") * scale, height, width, extrapolate=True)
    wide = found.groupBy("scene", F.col("pr").alias("r"), F.col("pc").alias("c")).agg(*(F.max(F.when(F.col("name") == a, F.col("v"))).alias(a) for a in ANGLES))
    return points.join(wide, ["scene", "r", "c"], "left")


def clear_pixels(reference: DataFrame, mask: DataFrame, height: int, width: int, cloudy: tuple[int, ...] = (1, 2), mask_shape: tuple[int, int] | None = None) -> DataFrame:
    """(scene, r, c, cloud, clear): pixels of the reference band (scene, r, c, dn), 0 being no data, under a mask of classes
    (scene, r, c, v), of its own shape if it has another; what the mask lacks is not cloud."""
    h, w = mask_shape or (height, width)
    where = lambda name, n, m: F.col(name) if n == m else F.floor((F.col(name) + 0.5) * F.lit(m / n)).cast("int")
    at = reference.select("scene", "r", "c", "dn", where("r", height, h).alias("__r"), where("c", width, w).alias("__c"))
    classes = mask.select("scene", F.col("r").alias("__r"), F.col("c").alias("__c"), F.col("v").isin(*cloudy).alias("cloud"))
    rows = at.join(classes, ["scene", "__r", "__c"], "left").withColumn("cloud", F.coalesce("cloud", F.lit(False)))
    return rows.select("scene", "r", "c", "cloud", F.coalesce(F.col("dn") != 0, F.lit(False)).alias("valid")).withColumn("clear", F.col("valid") & ~F.col("cloud"))


def clear_shares(pixels: DataFrame, least: float = 0.2) -> DataFrame:
    """(scene, n_valid, clear_fraction, accepted): the share of clear pixels among valid ones (0 without any), and whether it suffices."""
    share = F.coalesce(F.try_divide(F.count_if("clear").cast("double"), F.count_if("valid")), F.lit(0.0))
    return pixels.groupBy("scene").agg(F.count_if("valid").alias("n_valid"), share.alias("clear_fraction")).withColumn("accepted", F.col("clear_fraction") >= least)


def _windows(samples: DataFrame, resolutions: dict[str, float], shapes: dict[str, tuple[int, int]], reference: float, window_m: float) -> DataFrame:
    """Samples by band: the pixel of the band's own grid (br, bc) and the square around it (r0..r1, c0..c1)."""
    bands = []
    for b, res in resolutions.items():
        size = max(1, int(window_m / res) if window_m > 0 else 1)
        at = lambda name, n, res=res: F.least((F.col(name) * F.lit(reference / res)).cast("int"), F.lit(n - 1))
        br, bc, down, up = at("r", shapes[b][0]), at("c", shapes[b][1]), size // 2, size - size // 2 - 1
        bands.append(F.struct(F.lit(b).alias("band"), F.lit(size).alias("size"), (br - down).alias("r0"), (br + up).alias("r1"), (bc - down).alias("c0"), (bc + up).alias("c1")))
    return samples.select("scene", "r", "c", F.explode(F.array(*bands)).alias("w")).select("scene", "r", "c", "w.*")


def window_means(samples: DataFrame, digital: DataFrame, resolutions: dict[str, float], shapes: dict[str, tuple[int, int]], reference: float, window_m: float) -> DataFrame:
    """(scene, r, c, band, dn): the mean of the band's numbers other than 0 in a square of ``window_m`` around each sample, on the band's
    own grid; a square of one pixel takes it as it is, 0 included. Samples with nothing in their square have no row.

    A square is no larger than a block of its size, so it meets at most four blocks, and only samples are copied, not pixels.
    """
    side = F.create_map(*(x for b, res in resolutions.items() for x in (F.lit(b), F.lit(max(1, int(window_m / res) if window_m > 0 else 1)))))
    block = lambda c, size: F.floor(c / size).cast("int")
    asked = _windows(samples, resolutions, shapes, reference, window_m)
    for name in ("r", "c"):
        first, last = block(F.col(f"{name}0"), F.col("size")), block(F.col(f"{name}1"), F.col("size"))
        asked = asked.withColumn(f"b{name}", F.explode(F.sequence(first, last)))
    size = F.element_at(side, F.col("band"))
    pixels = digital.where(F.col("band").isin(*resolutions)).where((F.col("dn") != 0) | (size == 1))
    pixels = pixels.select("scene", "band", F.col("r").alias("pr"), F.col("c").alias("pc"), "dn", block(F.col("r"), size).alias("br"), block(F.col("c"), size).alias("bc"))
    met = asked.join(pixels, ["scene", "band", "br", "bc"]).where("pr BETWEEN r0 AND r1 AND pc BETWEEN c0 AND c1")
    return met.groupBy("scene", "r", "c", "band").agg(F.avg("dn").alias("dn"))


def clear_sky_samples(
    digital: DataFrame, mask: DataFrame, scenes: DataFrame, angles: DataFrame, height: int, width: int, resolutions: dict[str, float], shapes: dict[str, tuple[int, int]], angle_shape: tuple[int, int],
    offsets: DataFrame | None = None, footprints: DataFrame | None = None, bathymetry: Callable[[Column, Column], Column] | None = None, reference: str = "B02", n_samples: int = 10_000,
    dilation: int = 5, shadow: bool = False, least_clear: float = 0.2, window_m: float = 180.0, mask_shape: tuple[int, int] | None = None, seed: int = 42,
) -> DataFrame:
    """(scene, r, c, latitude, longitude, ANGLES, wind_speed, wind_direction, bathymetry, day_of_year, detector, one column a band).

    digital: scene, band, r, c, dn, each band on its own grid (``shapes``, ``resolutions`` in metres). mask: scene, r, c, v (classes).
    scenes: scene, transform (six numbers), zone, south, sensing_time, wind_speed, wind_direction, quantification. angles: as for
    ``angles_at``. offsets: scene, band, offset; footprints: scene, r, c, v of the reference band. ``bathymetry`` makes a depth of
    latitude and longitude; without it depths are -1. Missing wind, sensing times and footprints are 0.

    Up to n_samples clear pixels of each scene, farther than ``dilation`` pixels from cloud and than half a window from the edges; scenes
    with too small a share of clear pixels have none (``clear_shares`` says which). Reflectances without a pixel to average are null.
    """
    ref = digital.where(F.col("band") == reference)
    pixels = clear_pixels(ref, mask, height, width, (1, 2, 3) if shadow else (1, 2), mask_shape)
    open_scenes = clear_shares(pixels, least_clear).where("accepted").select("scene")
    able = pixels.join(open_scenes, "scene", "left_semi")
    near = dilated(able.select("scene", "r", "c", "clear", F.col("cloud").cast("int").alias("v")), ["scene"], dilation) if dilation else able.withColumn("v", F.col("cloud").cast("int"))
    margin = int(window_m / (2 * resolutions[reference]))
    inside = F.col("r").between(margin, height - 1 - margin) & F.col("c").between(margin, width - 1 - margin)
    chosen = least_by_hash(near.where(F.col("clear") & (F.col("v") == 0) & inside).select("scene", "r", "c"), ["scene"], ["scene", "r", "c"], n_samples, seed)

    means = window_means(chosen, digital, resolutions, shapes, resolutions[reference], window_m)
    if offsets is not None:
        means = means.join(offsets.select("scene", "band", "offset"), ["scene", "band"], "left").withColumn("dn", F.col("dn") + F.coalesce("offset", F.lit(0.0)))
    wide = means.groupBy("scene", "r", "c").agg(*(F.max(F.when(F.col("band") == b, F.col("dn"))).alias(b) for b in resolutions))
    rows = angles_at(chosen, angles, *angle_shape, resolutions[reference]).join(wide, ["scene", "r", "c"], "left")
    if footprints is not None:
        rows = rows.join(footprints.select("scene", "r", "c", F.col("v").alias("detector")), ["scene", "r", "c"], "left")
    else:
        rows = rows.withColumn("detector", F.lit(0))
    t = F.col("transform")
    east, north = (at(F.col("r"), F.col("c"), t) for at in (map_x, map_y))
    lat, lon = utm_to_degrees(east, north - F.when(F.col("south"), 1e7).otherwise(0.0), F.col("zone"))
    rows = rows.join(scenes.select("scene", "transform", "zone", "south", "sensing_time", "wind_speed", "wind_direction", "quantification"), "scene", "left")
    rows = rows.withColumns({"latitude": lat, "longitude": lon})
    depth = bathymetry(F.col("latitude"), F.col("longitude")) if bathymetry else F.lit(-1.0)
    zero = lambda name, kind: F.coalesce(F.col(name).cast(kind), F.lit(0).cast(kind)).alias(name)
    return rows.select(
        "scene", "r", "c", "latitude", "longitude", *ANGLES, zero("wind_speed", "double"), zero("wind_direction", "double"), depth.cast("double").alias("bathymetry"),
        F.coalesce(F.dayofyear("sensing_time"), F.lit(0)).alias("day_of_year"), zero("detector", "int"), *((F.col(b) / F.col("quantification")).alias(b) for b in resolutions),
    )
