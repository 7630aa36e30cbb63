"""Seeded draws as column expressions. A draw is a hash of its keys, so partitioning, retries and reruns never change it."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .algebra import clip


def uniform(seed: int, *keys: Column) -> Column:
    """Between 0 and 1, 0 excluded."""
    return (F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(1 << 53)) + 0.5) / F.lit(float(1 << 53))


def normal(seed: int, *keys: Column) -> Column:
    """Standard normal, from two uniform draws."""
    return F.sqrt(-2 * F.ln(uniform(seed, F.lit("radius"), *keys))) * F.cos(2 * math.pi * uniform(seed, F.lit("angle"), *keys))


def noisy(refl: Column, spans: Column, seed: int, *keys: Column, gain: float = 0.05, band_gain: float = 0.02, offset: float = 0.01, band_offset: tuple[float, float] = (0.001, 0.01)) -> tuple[Column, Column]:
    """(perturbed reflectances, what was added by the span of each band, in -1..1) of one sample, named by its keys.

    Each value is multiplied by a gain of the sample and one of the band, and gets an offset of the sample, relative to its
    mean, and one of the band, whose scale is drawn from band_offset and relative to the band's span. A span of 0 counts as 1.
    """
    span = lambda i: F.when(F.get(spans, i) == 0, 1.0).otherwise(F.get(spans, i))
    typical = F.aggregate(refl, F.lit(0.0), lambda s, x: s + x) / F.size(refl)
    whole = 1 + gain * normal(seed, F.lit("gain"), *keys)
    shift = offset * normal(seed, F.lit("offset"), *keys) * typical

    def one(x: Column, i: Column) -> Column:
        scale = band_offset[0] + (band_offset[1] - band_offset[0]) * uniform(seed, F.lit("scale"), i, *keys)
        return x * whole * (1 + band_gain * normal(seed, F.lit("band gain"), i, *keys)) + shift + normal(seed, F.lit("band offset"), i, *keys) * scale * span(i)

    changed = F.transform(refl, one)
    return changed, F.transform(changed, lambda y, i: clip(2 * (y - F.get(refl, i)) / span(i), -1.0, 1.0))


def mixed_shading(bag: Column, sample: Column, most: float, seed: int) -> Column:
    """Optical depths of a bag's samples, from one to five normal modes a bag, within 0..most.

    Three modes in ten are linear, near 0, the others logarithmic; a sample takes one of its bag's modes.
    """
    modes = F.least(F.floor(5 * uniform(seed, F.lit("modes"), bag)), F.lit(4)) + 1
    mode = F.least(F.floor(modes * uniform(seed, F.lit("mode"), bag, sample)), modes - 1)
    between = lambda name, low, high: low + (high - low) * uniform(seed, F.lit(name), bag, mode)
    z = normal(seed, F.lit("value"), bag, sample)
    linear = between("linear centre", 0.0, 0.5) + z * between("linear spread", 0.05, 0.3)
    logarithmic = F.exp(between("log centre", -2.0, 4.0) + z * between("log spread", 0.2, 1.5))
    return clip(F.when(uniform(seed, F.lit("kind"), bag, mode) < 0.3, linear).otherwise(logarithmic), 0.0, most)
