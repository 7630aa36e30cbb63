"""Scenes as they arrive: an extension, as the reference has no streams.

Manifests of a landing folder are read as a stream, late and repeated ones dropped by watermark, rolled up by tile and day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.catalog import Catalog

MANIFEST = "run_id string, scene_id string, scene_path string, crop_window string, tile_id string, sensing_time timestamp, cloud double"


def arrivals(spark: SparkSession, folder: str, late: str = "2 days") -> DataFrame:
    """Each run once, unless it comes later than the watermark allows."""
    return spark.readStream.schema(MANIFEST).json(folder).withWatermark("sensing_time", late).dropDuplicatesWithinWatermark(["run_id"])


def daily_cloud(scenes: DataFrame) -> DataFrame:
    """Scenes and mean cloud by tile and day."""
    day = F.window("sensing_time", "1 day")
    return scenes.groupBy(day, "tile_id").agg(F.count(F.lit(1)).alias("n"), F.avg("cloud").alias("cloud")).select(F.col("window.start").alias("day"), "tile_id", "n", "cloud")


def stage_into(catalog: Catalog):
    """A foreachBatch function that stages what arrived; staging twice adds nothing, so a repeated batch does no harm."""
    return lambda batch, _: catalog.stage(batch.select("scene_id", "scene_path", "crop_window")) and None
