"""Rows in order within keys of any size: numbering and rolling frames without a task that holds a key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..sources.tables import cut

CHUNK = 1 << 16


def numbered(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The rows with ``pos``, from 0, within their key: sorted by ranges of (key, order), numbered range by range, and moved on by
    what lies in earlier ranges. ``order`` tells the rows of a key apart."""
    by = [*keys, *order]
    local = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = cut(rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumns({"__part": F.spark_partition_id(), "__at": local}))
    spans = placed.groupBy(*keys, "__part").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(W.partitionBy(*keys).orderBy("__part").rowsBetween(W.unboundedPreceding, -1))
    spans = spans.select(*keys, "__part", (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__before"))
    return placed.join(spans, [*keys, "__part"]).withColumn("pos", F.col("__at") + F.col("__before")).drop("__part", "__at", "__before")


def rolling_mean(rows: DataFrame, keys: list[str], order: list[str], value: str, before: int, after: int, least: int, chunk: int = CHUNK) -> DataFrame:
    """The rows with ``rolling``, the mean over ``before`` rows to ``after`` rows, null with fewer than ``least`` values.

    A key's rows are dealt to chunks by position; each chunk also gets the rows just outside it that its frames reach.
    """
    n = numbered(rows, keys, order)
    chunks = F.sequence(F.floor(F.greatest(F.col("pos") - after, F.lit(0)) / chunk), F.floor((F.col("pos") + before) / chunk))
    n = n.withColumn("__chunk", F.explode(chunks))
    frame = W.partitionBy(*keys, "__chunk").orderBy("pos").rowsBetween(-before, after)
    rolled = n.withColumn("rolling", F.when(F.count(value).over(frame) >= least, F.avg(value).over(frame)))
    return rolled.where(F.col("__chunk") == F.floor(F.col("pos") / chunk)).drop("__chunk", "pos")
