"""Statistics of pixels by run and band: plug-ins by name, all runs in one job.

Quantiles are exact and found by rank, so that no task holds a large group's values: these are counted, counts are sorted by
ranges of (group, value), and of the ranges only those that hold a wanted rank are looked into. Small groups are moved and sorted once.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.algebra import band_name, finite, valid
from ..sources.tables import cut

# The percentiles that are reported, and the classes of a cloud mask.
PERCENTILES = (0, 5, 25, 50, 75, 95, 100)
CLASSES = {0: "Clear", 1: "Thick Cloud", 2: "Thin Cloud", 3: "Cloud Shadow"}

#: Rows that a task of quantiles sorts, places to which keys are dealt when their rows are counted, and tasks at the most.
ROWS, PLACES, TASKS = 1 << 18, 1 << 16, 1 << 14


class Quantiles(dict):
    """Names of wanted quantiles and their points within 0..1, which a statistics function may return among its aggregates."""


StatsFunction = Callable[..., list[Column | Quantiles]]
REGISTRY: dict[str, StatsFunction] = {}


def stats_function(name: str) -> Callable[[StatsFunction], StatsFunction]:
    """Registers ``step::function``, or a function of every step, that returns named aggregates over ``value``."""

    def add(f: StatsFunction) -> StatsFunction:
        REGISTRY[name] = f
        return f

    return add


def resolve(identifier: str) -> StatsFunction:
    """The step's own function first, then the general one of that name."""
    step, _, name = identifier.partition("::")
    found = REGISTRY.get(f"{step}::{name}") or REGISTRY.get(name)
    if found is None:
        raise KeyError(f"no statistics function {identifier!r}")
    return found


@stats_function("mean")
def mean(value: Column) -> list[Column]:
    return [F.avg(value).alias("mean"), F.count(value).alias("n_pixels")]


@stats_function("median")
def median(value: Column) -> list[Column]:
    return [Quantiles(median=0.5), F.count(value).alias("n_pixels")]


@stats_function("percentiles")
def percentiles(value: Column, points: tuple[int, ...] = PERCENTILES) -> list[Column]:
    return [Quantiles({f"p{p:03d}": p / 100 for p in points}), F.avg(value).alias("mean"), F.count(value).alias("n_pixels")]


@stats_function("cloud_mask::class_fractions")
def class_fractions(value: Column, classes: dict[int, str] | None = None) -> list[Column]:
    """Shares among pixels of declared classes; nodata and undeclared values do not count."""
    classes = classes or CLASSES
    declared = F.count_if(value.isin(*classes))
    return [(F.count_if(value == k) / F.nullif(declared, F.lit(0))).alias(name.lower().replace(" ", "_") + "_frac") for k, name in classes.items()]


def band_stats(pixels: DataFrame, identifier: str, nodata: float | None = None, **options) -> DataFrame:
    """One row a run and band; bands without a valid pixel give none. pixels: run_id, band, band_idx, value."""
    rows = pixels.where(valid(F.col("value"), nodata)).withColumn("band", band_name(F.col("band"), F.col("band_idx")))
    return summarised(rows, ["run_id", "band"], "value", resolve(identifier)(F.col("value"), **options))


def summarised(rows: DataFrame, keys: list[str], value: str, wanted: list[Column | Quantiles]) -> DataFrame:
    """The aggregates and quantiles of a value by keys, quantiles first; with quantiles, only of keys that have a value."""
    points = {name: p for w in wanted if isinstance(w, Quantiles) for name, p in w.items()}
    aggregates = [w for w in wanted if not isinstance(w, Quantiles)]
    return quantiles(rows, keys, value, points, aggregates) if points else rows.groupBy(*keys).agg(*aggregates)


def quantiles(rows: DataFrame, keys: list[str], value: str, points: dict[str, float], aggregates: list[Column] | None = None) -> DataFrame:
    """(keys, one column a point, the aggregates): exact quantiles, linear between the two values next to a rank; nulls do not count.

    Infinities are values like others, at either end, and NaN comes after all. Keys may be few and hold any number of values: rows
    are counted by places to which keys are dealt, and keys of places with many rows are ranked by ranges, all others each
    within a task. Tasks follow the number of rows, so that what one of them holds does not grow with the input.
    """
    aggregates, place = aggregates or [], F.pmod(F.xxhash64(*keys), F.lit(PLACES))
    sizes = rows.groupBy(place.alias("place")).agg(F.count(F.lit(1)).alias("n"))
    found = sizes.agg(F.sum("n").alias("all"), F.collect_list(F.when(F.col("n") > ROWS, F.col("place"))).alias("full")).first()
    full, tasks = found["full"], min(-(-(found["all"] or 1) // ROWS), TASKS)
    if not full:
        return _by_key(rows, keys, value, points, aggregates, tasks)
    large, small = rows.where(place.isin(full)), rows.where(~place.isin(full))
    ranked = _by_range(large, keys, value, points, tasks)
    if aggregates:
        ranked = _joined(ranked, large.groupBy(*keys).agg(*aggregates), keys)
    return ranked.unionByName(_by_key(small, keys, value, points, aggregates, tasks))


def _by_key(rows: DataFrame, keys: list[str], value: str, points: dict[str, float], aggregates: list[Column], tasks: int) -> DataFrame:
    """Ranks and aggregates of keys of which a task can sort many: rows are moved once."""
    ordered = W.partitionBy(*keys).orderBy(F.asc_nulls_last("__v"))
    values = rows.repartition(tasks, *keys).withColumn("__v", F.col(value).cast("double"))
    values = values.withColumns({"__rank": F.row_number().over(ordered) - 1, "__n": F.count("__v").over(ordered.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))}).where("__n > 0")

    def point(p: float) -> Column:
        at = F.lit(float(p)) * (F.col("__n") - 1)
        w = at - F.floor(at)
        return F.sum(F.when(F.col("__rank") == F.floor(at), (1 - w) * F.col("__v")).when((F.col("__rank") == F.floor(at) + 1) & (w > 0), w * F.col("__v")))

    return values.groupBy(*keys).agg(*(point(p).alias(name) for name, p in points.items()), *aggregates)


def _joined(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Joined by columns of which null equals null; the left side's are kept."""
    renamed = right.withColumnsRenamed({c: f"__on{i}" for i, c in enumerate(on)})
    same = functools.reduce(operator.and_, (F.col(c).eqNullSafe(F.col(f"__on{i}")) for i, c in enumerate(on)))
    return left.join(renamed, same, how).drop(*(f"__on{i}" for i in range(len(on))))


def _by_range(rows: DataFrame, keys: list[str], value: str, points: dict[str, float], tasks: int) -> DataFrame:
    """Ranks of keys of any size: of the ranges of (keys, value) only those that hold a wanted rank are looked into."""
    order = [*keys, "__v"]
    # values are counted by task of the scan, so that a frequent one is not moved to one task row by row; a value may have several counts
    counts = rows.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("__v"), F.spark_partition_id().alias("__scan"))
    counts = counts.repartition(tasks, *order, "__scan").groupBy(*order, "__scan").agg(F.count(F.lit(1)).alias("__n")).drop("__scan")
    placed = cut(counts.repartitionByRange(tasks, *order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id()))
    by_key = W.partitionBy(*keys)
    before = F.sum("__n").over(by_key.orderBy("__part").rowsBetween(W.unboundedPreceding, -1))
    spans = placed.groupBy(*keys, "__part").agg(F.sum("__n").alias("__n"))
    spans = spans.withColumns({"__from": F.coalesce(before, F.lit(0)), "__total": F.sum("__n").over(by_key)})
    asked = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), (F.lit(float(p)) * (F.col("__total") - 1)).alias("at")) for i, p in enumerate(points.values()))))
    ranks = spans.select(*keys, "__part", "__from", "__n", "__total", asked.alias("a")).select(*keys, "__part", "__from", "__n", "a.i", "a.at", F.explode(F.array(F.struct(F.floor("a.at").alias("rank"), (1 - (F.col("a.at") - F.floor("a.at"))).alias("w")), F.struct((F.floor("a.at") + 1).alias("rank"), (F.col("a.at") - F.floor("a.at")).alias("w")))).alias("s"))
    ranks = ranks.select(*keys, "__part", "__from", "i", F.col("s.rank").alias("rank"), F.col("s.w").alias("w"), "__n").where("w > 0 AND rank >= __from AND rank < __from + __n").drop("__n")
    within = W.partitionBy(*keys, "__part").orderBy("__v").rowsBetween(W.unboundedPreceding, 0)
    wanted = ranks.select(*keys, "__part").dropDuplicates()
    values = _joined(placed, wanted, [*keys, "__part"], "left_semi").withColumn("__to", F.sum("__n").over(within))
    hit = _joined(values, ranks, [*keys, "__part"]).where("rank - __from < __to AND rank - __from >= __to - __n")
    each = [F.sum(F.when(F.col("i") == i, F.col("w") * F.col("__v"))).alias(name) for i, name in enumerate(points)]
    return hit.groupBy(*keys).agg(*each)


def wide_stats(stats: DataFrame, bands: tuple[str, ...]) -> DataFrame:
    """Columns <band>__<statistic>, one row a run; bands that were not named are an error, not dropped."""
    measures = [c for c in stats.columns if c not in ("run_id", "band")]
    known = F.col("band").isin(*bands)
    checked = stats.withColumn("band", F.when(known, F.col("band")).otherwise(F.raise_error(F.concat(F.lit("undeclared band "), "band"))))
    each = [F.max(F.when(F.col("band") == b, F.col(m))).alias(f"{b}__{m}") for b in bands for m in measures]
    return checked.groupBy("run_id").agg(*each)


def merged_stats(first: DataFrame, second: DataFrame) -> DataFrame:
    """Two functions' statistics of one step side by side; of a statistic that both have, the second's, where it has one."""
    keys = ["run_id", "band"]
    both = [c for c in second.columns if c in first.columns and c not in keys]
    joined = first.join(second.withColumnsRenamed({c: f"__{c}" for c in both}), keys, "full")
    names = dict.fromkeys([*first.columns, *second.columns])
    return joined.select(*(F.coalesce(f"__{c}", c).alias(c) if c in both else c for c in names))


def run_stats(pixels: DataFrame, runs: DataFrame, identifiers: tuple[str, ...], have: dict[str, DataFrame] | None = None, force: bool = False, nodata: float | None = None, failures: dict[str, Exception] | None = None) -> dict[str, DataFrame]:
    """The statistics of done runs that have none yet (all of them with force), by step, every step in one job.

    Several functions of one step are merged. A function that cannot be resolved or planned stops the others only if no
    ``failures`` are collected.
    """
    have, out = have or {}, {}
    done = runs.where("status = 'done'").select("run_id")
    for identifier in identifiers:
        step = identifier.partition("::")[0]
        todo = done if force or step not in have else done.join(have[step].select("run_id"), "run_id", "left_anti")
        try:
            found = band_stats(pixels.join(todo, "run_id", "left_semi"), identifier, nodata)
        except Exception as e:
            if failures is None:
                raise
            failures[identifier] = e
            continue
        out[step] = found if step not in out else merged_stats(out[step], found)
    return out


def unprefixed(stats: DataFrame) -> DataFrame:
    """Statistics of rasters of a single band that has no name: one row a run, without a band."""
    return stats.drop("band")


def clear_fractions(mask: DataFrame, keys: list[str], nodata: float | None = None, clear: tuple[int, ...] = (0,)) -> DataFrame:
    """(keys, of_all, of_valid): the share of clear pixels among all, and among those that hold data; null where none does."""
    is_clear, ok = F.col("value").isin(*clear), valid(F.col("value"), nodata)
    counts = mask.groupBy(*keys).agg(F.count_if(is_clear & ok).alias("__c"), F.count(F.lit(1)).alias("__n"), F.count_if(ok).alias("__v"))
    return counts.select(*keys, (F.col("__c") / F.col("__n")).alias("of_all"), F.try_divide("__c", "__v").alias("of_valid"))


def mean_broadcast(pixels: DataFrame, keys: list[str]) -> DataFrame:
    """The pixels with their key's mean in place of every finite value; the others stay missing. Means are aggregated and joined
    back, so that no key is one task."""
    means = pixels.groupBy(*keys).agg(F.avg(F.when(finite(F.col("value")), F.col("value"))).alias("__mean"))
    return pixels.join(means, keys, "left").withColumn("value", F.when(finite(F.col("value")), F.col("__mean"))).drop("__mean")


def uncertainty_summary(value: Column) -> list[Column | Quantiles]:
    """For ``summarised``."""
    points = Quantiles(p25=0.25, median=0.5, p75=0.75, p90=0.9, p95=0.95, p99=0.99)
    return [F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), F.min(value).alias("min"), F.max(value).alias("max"), points]


def auto_stretch(pixels: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, gain, offset) that stretch the first to the 99th percentile of the values above zero to 0..1."""
    ends = quantiles(pixels.where(finite(F.col(value)) & (F.col(value) > 0)), keys, value, {"low": 0.01, "high": 0.99})
    gain = 1 / (F.col("high") - F.col("low"))
    return ends.select(*keys, gain.alias("gain"), (-F.col("low") * gain).alias("offset"))


def histogram_bin(value: Column, low: float, high: float, bins: int) -> Column:
    """The bin of a value, the last one closed; null outside."""
    inside = (value >= low) & (value <= high)
    return F.when(inside, F.least(F.floor((value - low) * bins / (high - low)), F.lit(bins - 1)).cast("int"))


def smoothed(histogram: DataFrame, keys: list[str], bins: int, sigma: float) -> DataFrame:
    """Gaussian smoothing of a normalised histogram (keys, bin, n), reflected at both ends, from its filled bins only."""
    radius = int(4 * sigma + 0.5)
    kernel = F.expr(f"exp(-0.5 * power(d / {sigma}, 2))")
    weights = histogram.sparkSession.range(-radius, radius + 1).select(F.col("id").cast("int").alias("d")).withColumn("w", kernel)
    share = weights.agg(F.sum("w")).first()[0]
    total = histogram.groupBy(*keys).agg(F.sum("n").alias("total"))
    every = F.explode(F.sequence(F.lit(0), F.lit(bins - 1)))
    source = F.pmod(F.col("bin") + F.col("d"), F.lit(2 * bins))
    source = F.when(source >= bins, 2 * bins - 1 - source).otherwise(source).cast("int")
    spread = total.withColumn("bin", every).withColumn("d", F.explode(F.sequence(F.lit(-radius), F.lit(radius))))
    spread = spread.withColumn("w", kernel / share).withColumn("source", source)
    n = histogram.select(*keys, F.col("bin").alias("source"), "n")
    return spread.join(n, [*keys, "source"], "left").groupBy(*keys, "bin").agg(F.sum(F.coalesce(F.col("n"), F.lit(0)) / F.col("total") * F.col("w")).alias("density"))
