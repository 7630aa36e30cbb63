"""Training and evaluation errors as aggregates over rows of arrays; nothing leaves the JVM."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column
from pyspark.sql import functions as F

# A ratio of ice to liquid up to the first is pure liquid, from the second on pure ice; the places of the targets.
PURE_LIQUID, PURE_ICE = 0.01, 0.99
ICE_RATIO, RADIUS_LIQUID, RADIUS_ICE = 1, 2, 3


def _square(a: Column, b: Column, i: int) -> Column:
    d = F.get(a, F.lit(i)).cast("double") - F.get(b, F.lit(i)).cast("double")
    return d * d


def _mean(parts: list[Column]) -> Column:
    """The mean over all rows and elements."""
    return F.avg(functools.reduce(operator.add, parts) / len(parts))


def mse(predicted: Column, target: Column, n: int) -> Column:
    return _mean([_square(predicted, target, i) for i in range(n)])


def physics_masked(predicted: Column, target: Column, physical: Column, n: int = 4) -> Column:
    """Mean square error of normalised values; the radius of a phase that a cloud has none of counts as no error, and stays in the
    denominator. physical: the targets in their own units, which say what phase there is."""
    ratio = F.get(physical, F.lit(ICE_RATIO))
    parts = [_square(predicted, target, i) for i in range(n)]
    parts[RADIUS_LIQUID] = F.when(ratio >= PURE_ICE, 0.0).otherwise(parts[RADIUS_LIQUID])
    parts[RADIUS_ICE] = F.when(ratio <= PURE_LIQUID, 0.0).otherwise(parts[RADIUS_ICE])
    return _mean(parts)


def combined(physics: Column, noise: Column, physics_weight: float = 1.0, noise_weight: float = 1.0) -> Column:
    """Of two losses, aggregates both."""
    return physics_weight * physics + noise_weight * noise


def band_mae(predicted: Column, target: Column, bands: tuple[str, ...]) -> list[Column]:
    """The mean absolute error of each band."""
    return [F.avg(F.abs(F.get(predicted, F.lit(i)) - F.get(target, F.lit(i)))).alias(b) for i, b in enumerate(bands)]
