"""Fixed values of the Sentinel-2 instrument: bands with delay, resolution and default albedo, and the orbit."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession

# Band, time delay to the reference band in seconds, resolution in metres, default surface albedo.
BANDS = (
    ("B01", 2.314, 60, 0.03),
    ("B02", 0.0, 10, 0.05),
    ("B03", 0.527, 10, 0.03),
    ("B04", 1.005, 10, 0.03),
    ("B05", 1.269, 20, 0.02),
    ("B06", 1.525, 20, 0.02),
    ("B07", 1.790, 20, 0.02),
    ("B08", 0.263, 10, 0.02),
    ("B8A", 2.055, 20, 0.02),
    ("B09", 2.586, 60, 0.02),
    ("B10", 0.851, 60, 0.0),
    ("B11", 1.468, 20, 0.02),
    ("B12", 2.085, 20, 0.02),
)
ALTITUDE, EARTH_RADIUS, GRAVITATION, EARTH_MASS = 790_000.0, 6_371_000.0, 6.67430e-11, 5.972e24
ORBITAL_VELOCITY = math.sqrt(GRAVITATION * EARTH_MASS / (ALTITUDE + EARTH_RADIUS))


def bands(spark: SparkSession) -> DataFrame:
    """The band dimension: 13 rows."""
    return spark.createDataFrame([(i, *b) for i, b in enumerate(BANDS)], "band_idx int, band string, delay_s double, resolution_m int, default_albedo double")
