"""Stereo heights: strips along the track, sampled across all bands, and how well they match at candidate heights.

A strip is a rotated lattice of points, made in Spark; each band is sampled at it by joins. The correlation of a strip's
patches is computed in one Arrow group a strip, whose size is that of a strip and not of a scene.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.algebra import finite
from ..schema import ALTITUDE, BANDS, ORBITAL_VELOCITY
from .grids import at_points, rotated

DELAYS = {name: delay for name, delay, *_ in BANDS}


def strip_shape(height_m: float, angle: float, strip_m: float, across_m: float, along_m: float) -> tuple[int, int]:
    """Points along and across a strip: as long as the scene is on the slant, and twice the strip's width more."""
    return math.ceil(round((height_m / abs(math.cos(angle)) + 2 * strip_m) / along_m, 9)), math.ceil(round(strip_m / across_m, 9))


def strip_points(scenes: DataFrame, height_m: float, width_m: float, angle: float, strip_m: float, stride_m: float, across_m: float, along_m: float) -> DataFrame:
    """scenes (scene) with (strip, i, j, x, y): the points of every strip in metres from the upper left pixel, i along, j across.

    Strips begin every stride along the upper edge and on to the side that the rotation brings in; they are longer than the scene
    by twice their width, so that turned ones reach its edges.
    """
    n_along, n_across = strip_shape(height_m, angle, strip_m, across_m, along_m)
    strips = int(width_m * (1 + abs(math.sin(angle))) / stride_m)
    count = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    rows = scenes if strips > 0 else scenes.limit(0)
    rows = rows.withColumn("strip", count(max(strips, 1))).withColumn("i", count(n_along)).withColumn("j", count(n_across))
    x, y = rotated(F.col("j") * F.lit(float(across_m)), F.lit(-float(strip_m)) + F.col("i") * F.lit(float(along_m)), angle)
    return rows.withColumns({"x": x + F.floor(F.col("strip") * F.lit(float(stride_m))), "y": y})


def sampled_bands(points: DataFrame, bands: DataFrame, resolutions: dict[str, float], shapes: dict[str, tuple[int, int]]) -> DataFrame:
    """points (scene, strip, i, j, x, y) with (band, v): each band (scene, band, r, c, v) at the points, bilinear; null outside it.

    Bands may have pixels of different sizes; a band's work is of its own size.
    """
    out = None
    for name, res in resolutions.items():
        h, w = shapes[name]
        y, x = F.col("y") / F.lit(float(res)), F.col("x") / F.lit(float(res))
        inside = (y >= 0) & (y <= h - 1) & (x >= 0) & (x <= w - 1)
        one = at_points(points.where(inside), bands.where(F.col("band") == name).select("scene", "r", "c", "v"), ["scene"], y, x, h, w)
        one = one.withColumn("band", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


def strip_detectors(points: DataFrame, footprints: DataFrame, resolutions: dict[str, float]) -> DataFrame:
    """(scene, strip, detector) of strips in which every band sees one detector and all bands the same one.

    footprints: scene, band, r, c, detector. A point takes the nearest pixel (the lower one half-way); outside there is none.
    """
    res = F.element_at(F.create_map(*(x for b, r in resolutions.items() for x in (F.lit(b), F.lit(float(r))))), F.col("band"))
    bands = points.sparkSession.createDataFrame([(b,) for b in resolutions], "band string")
    near = lambda v: F.ceil(v - 0.5).cast("int")
    asked = points.join(F.broadcast(bands)).withColumns({"r": near(F.col("y") / res), "c": near(F.col("x") / res)})  # a row a band
    asked = asked.select("scene", "strip", "band", "r", "c").dropDuplicates()
    seen = asked.join(footprints.hint("merge"), ["scene", "band", "r", "c"]).groupBy("scene", "strip", "band").agg(F.min("detector").alias("lo"), F.max("detector").alias("hi"))
    each = seen.groupBy("scene", "strip").agg(F.min("lo").alias("detector"), F.max("hi").alias("most"), F.count(F.lit(1)).alias("n"))
    return each.where((F.col("detector") == F.col("most")) & (F.col("n") == len(resolutions))).select("scene", "strip", "detector")


def offsets(height: float, names: list[str], pixel: float) -> np.ndarray:
    """Along-track offsets in pixels of something at a height, by band; NaN for bands without a delay."""
    return np.array([height * ORBITAL_VELOCITY * DELAYS.get(b, math.nan) / ALTITUDE / pixel for b in names])


def kernel(height: int, width: int) -> np.ndarray:
    y, x = np.linspace(-height // 2, height // 2, height)[:, None], np.linspace(-width // 2, width // 2, width)[None, :]
    k = np.exp(-(x**2 / (2 * (width / 2) ** 2) + y**2 / (2 * (height / 2) ** 2)))
    return k / k.mean()


def correlation(patches: list[np.ndarray], weights: np.ndarray) -> float:
    """The mean over all pairs of the weighted mean product of standardised patches; 0 with fewer than two."""
    z = []
    for p in patches:
        spread = p.std()
        z.append((p - p.mean()) / (spread if spread > 0 else 1.0))
    if len(z) < 2:
        return 0.0
    z = np.stack(z)
    # over all pairs, the products add up to half of what the square of the sum has more than the squares
    return float((((z.sum(0) ** 2 - (z**2).sum(0)) / 2) * weights).mean() / (len(z) * (len(z) - 1) / 2))


def centres(length: int, size: int, stride: int, most: int, up: bool) -> np.ndarray:
    """Middles of the patches, clear of the ends towards which patches of high clouds move."""
    return np.arange(size // 2, length - most - size // 2, stride) if up else np.arange(size // 2 + most, length - size // 2, stride)


def matched(samples: DataFrame, shape: tuple[int, int], heights: list[float], names: list[str], patch: int, stride: int, along_m: float, mask: DataFrame | None = None) -> DataFrame:
    """(scene, strip, x, y, scores): at the middles of patches of ``patch`` rows, every ``stride``, the correlation at each height.

    samples: scene, strip, detector, i, j, x, y, band, v of strips of ``shape``, points that no band sees left out. Even detectors look the other way than odd ones. A patch
    that leaves the strip at a height scores 0 there; a middle with a missing value at any other height is left out. mask (scene, strip, i, cloud) keeps only
    middles with a cloud.
    """
    most = int(np.ceil(np.nanmax(offsets(max(heights), names, along_m))))
    index = {b: k for k, b in enumerate(names)}

    def run(part: pd.DataFrame) -> pd.DataFrame:
        up = int(part["detector"].iloc[0]) % 2 == 0
        n_i, n_j = shape
        cube = np.full((len(names), n_i, n_j), np.nan)
        cube[part["band"].map(index).to_numpy(), part["i"].to_numpy(), part["j"].to_numpy()] = part["v"].to_numpy(float)
        weights, mid = kernel(patch, n_j), n_j // 2
        places = part[(part["j"] == mid)].drop_duplicates("i").set_index("i")[["x", "y"]]
        rows = []
        for centre in centres(n_i, patch, stride, most, up):
            scores = []
            for h in heights:
                shift, patches = offsets(h, names, along_m) * (-1 if up else 1), []
                for k in np.flatnonzero(~np.isnan(shift)):
                    start = int(centre - patch / 2 - shift[k])  # towards zero
                    if start < 0 or start + patch > n_i:
                        patches = None
                        break
                    patches.append(cube[k, start : start + patch])
                scores.append(0.0 if patches is None else correlation(patches, weights))
            if centre in places.index:
                rows.append([part["scene"].iloc[0], part["strip"].iloc[0], int(centre), *places.loc[centre], scores])
        return pd.DataFrame(rows, columns=["scene", "strip", "i", "x", "y", "scores"])

    schema = T.StructType([samples.schema["scene"], samples.schema["strip"], *T._parse_datatype_string("i int, x double, y double, scores array<double>").fields])
    out = samples.select("scene", "strip", "detector", "i", "j", "x", "y", "band", "v").groupBy("scene", "strip").applyInPandas(run, schema)
    if mask is not None:
        out = out.join(mask.where("cloud").select("scene", "strip", "i"), ["scene", "strip", "i"], "left_semi")
    return out.where(F.forall("scores", finite))


def grid_points(scenes: DataFrame, height_m: float, width_m: float, step: float) -> DataFrame:
    """(scene, gr, gc, x, y): a point every ``step`` metres of each scene."""
    count = lambda n: F.explode(F.sequence(F.lit(0), F.lit(max(math.ceil(n / step), 1) - 1)))
    rows = scenes.withColumn("gr", count(height_m)).withColumn("gc", count(width_m))
    return rows.withColumns({"x": F.col("gc") * F.lit(float(step)), "y": F.col("gr") * F.lit(float(step))})


def gridded(points: DataFrame, retrievals: DataFrame, sigma: float, heights: list[float], mask: DataFrame | None = None, mask_shape: tuple[int, int] | None = None, extent: tuple[float, float] | None = None) -> DataFrame:
    """(scene, gr, gc, height): the smoothed best height at every grid point; null in clear sky, far from any retrieval, and at 0.

    mask: scene, r, c, cloud, of mask_shape cells over the extent (height, width in metres). Scenes are smoothed side by side: each
    lies in a column of its own, farther from the next than any retrieval reaches.
    """
    from .spatial import smoothed_heights

    asked = points
    if mask is not None:
        (h, w), (hm, wm) = mask_shape, extent
        clip = lambda v, n: F.least(F.greatest(v.cast("int"), F.lit(0)), F.lit(n - 1))
        at = points.withColumns({"r": clip(F.col("y") / (hm / h), h), "c": clip(F.col("x") / (wm / w), w)})
        asked = at.join(mask.where("cloud").select("scene", "r", "c"), ["scene", "r", "c"], "left_semi")
    id_ = F.struct("scene", "gr", "gc")
    found = smoothed_heights(asked.select(id_.alias("id"), "scene", "x", "y"), retrievals.select("scene", F.col("x").alias("rx"), F.col("y").alias("ry"), "scores"), sigma, heights, keys=["scene"])
    return points.select("scene", "gr", "gc").join(found.select("id.*", "height"), ["scene", "gr", "gc"], "left")
