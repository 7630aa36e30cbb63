"""Surface albedo of scenes from their clear pixels, or a default where there are too few: all scenes in one plan.

Scenes are routed inside the plan: without a mask, with a clear share below ``min_clear``, or with fewer than LEAST samples before
or after means are taken, a scene gets default values; the others are interpolated from samples spread as evenly as possible.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import cut
from .grids import dilated
from .nearest import k_nearest
from .spatial import farthest_points

LEAST = 10


def estimated(
    digital: DataFrame, mask: DataFrame, height: int, width: int, res: float, out_res: float, defaults: dict[str, float], offsets: dict[str, float] | None = None, quantification: float = 10_000.0, reference: str = "B02",
    window_m: float = 500.0, dilation_m: float = 0.0, max_samples: int = 1000, min_clear: float = 0.05, k: int = 8, smoothing: float = 2000.0, seed: int = 42,
) -> DataFrame:
    """(scene, band, r, c, albedo, method, n_samples): of every cell of an output grid of ``out_res`` metres.

    digital: scene, band, r, c, dn, all bands on the reference band's pixels; 0 is no data. mask: scene, r, c, cloud; a scene
    without rows has none. Output cells without data are null; of equally near samples the one first by row and column counts.
    """
    ref = digital.where(F.col("band") == reference).select("scene", "r", "c", "dn")
    pixels = ref.join(mask.select("scene", "r", "c", F.col("cloud").cast("boolean").alias("cloud")), ["scene", "r", "c"])
    pixels = pixels.select("scene", "r", "c", (~F.col("cloud") & (F.col("dn") != 0)).alias("clear"))
    share = pixels.groupBy("scene").agg(F.avg(F.col("clear").cast("double")).alias("share")).where(F.col("share") >= min_clear)
    able = pixels.join(share.select("scene"), "scene", "left_semi")
    window, dilation = max(1, int(window_m / res)), max(0, int(dilation_m / res))
    half, margin = window // 2, window // 2
    far = dilated(able.select("scene", "r", "c", (~F.col("clear")).cast("int").alias("v")), ["scene"], dilation) if dilation else able.select("scene", "r", "c", (~F.col("clear")).cast("int").alias("v"))
    inside = F.col("r").between(margin, height - 1 - margin) & F.col("c").between(margin, width - 1 - margin) if margin else F.lit(True)
    # chosen samples and their means are written once, as all that follows reads them again and again; their small files must
    # not lead to a broadcast, which would grow with the scenes
    samples = cut(farthest_points(far.where((F.col("v") == 0) & inside).select("scene", "r", "c"), ["scene"], max_samples, seed))
    samples = samples.select("scene", (F.col("r").cast("long") * width + F.col("c")).alias("sid"), F.col("r").alias("sr"), F.col("c").alias("sc"))
    enough = samples.groupBy("scene").count().where(F.col("count") >= LEAST)
    samples = samples.join(enough.select("scene"), "scene", "left_semi")

    steps = lambda name: F.explode(F.sequence(F.col(name) - half, F.col(name) + half))
    around = samples.withColumn("r", steps("sr")).withColumn("c", steps("sc"))
    around = around.join(able.where("clear").select("scene", "r", "c").hint("merge"), ["scene", "r", "c"])
    lit = lambda values, default: F.coalesce(F.element_at(F.create_map(*(x for b, v in values.items() for x in (F.lit(b), F.lit(float(v))))), F.col("band")), F.lit(default)) if values else F.lit(default)
    means = around.join(digital.where("dn <> 0").hint("merge"), ["scene", "r", "c"]).groupBy("scene", "sid", "sr", "sc", "band").agg(F.avg("dn").alias("dn"))
    means = cut(means.withColumn("value", (F.col("dn") + lit(offsets, 0.0)) / quantification))
    whole = means.groupBy("scene", "sid", "sr", "sc").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(defaults)).drop("n")
    usable = whole.groupBy("scene").agg(F.count(F.lit(1)).alias("n_samples")).where(F.col("n_samples") >= LEAST)
    whole = whole.join(usable.select("scene"), "scene", "left_semi")

    out_h, out_w = max(1, int(height * res / out_res)), max(1, int(width * res / out_res))
    scenes = ref.select("scene").dropDuplicates()
    count = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    cells = scenes.withColumn("r", count(out_h)).withColumn("c", count(out_w))
    at = lambda name, n, size: F.col(name) * F.lit(size * res / max(n - 1, 1))
    asked = cells.join(usable.select("scene"), "scene", "left_semi").select("scene", F.struct("scene", "r", "c").alias("id"), at("c", out_w, width).alias("x"), at("r", out_h, height).alias("y"))
    where = whole.select("scene", "sid", (F.col("sc") * F.lit(float(res))).alias("sx"), (F.col("sr") * F.lit(float(res))).alias("sy"))
    near = k_nearest(asked, where, ["x", "y"], ["sx", "sy"], k, keys=["scene"])
    pairs = near.select("id.*", F.explode("near").alias("s")).select("scene", "r", "c", F.col("s.sid").alias("sid"), (1 / (F.col("s.d") + smoothing)).alias("w"))
    fitted = pairs.join(means.select("scene", "sid", "band", "value").hint("merge"), ["scene", "sid"]).groupBy("scene", "band", "r", "c").agg((F.sum(F.col("w") * F.col("value")) / F.sum("w")).alias("fitted"))

    bands = F.explode(F.array(*(F.lit(b) for b in sorted(defaults))))
    rows = cells.withColumn("band", bands).join(usable, "scene", "left").join(fitted, ["scene", "band", "r", "c"], "left")
    source = lambda name, n, size: F.least(F.floor((F.col(name) + 0.5) * F.lit(size / n)), F.lit(size - 1)).cast("int")
    empty = ref.where("dn = 0").select("scene", F.col("r").alias("__r"), F.col("c").alias("__c"), F.lit(True).alias("__empty"))
    rows = rows.withColumns({"__r": source("r", out_h, height), "__c": source("c", out_w, width)}).join(empty, ["scene", "__r", "__c"], "left")
    value = F.when(F.col("n_samples").isNull(), lit(defaults, 0.05)).otherwise(F.greatest("fitted", F.lit(0.0)))
    return rows.select(
        "scene", "band", "r", "c", F.when(F.col("__empty").isNull(), value).alias("albedo"), F.when(F.col("n_samples").isNull(), "constant").otherwise("idw").alias("method"), F.coalesce("n_samples", F.lit(0)).alias("n_samples")
    )
