"""A reproducible shuffle into shards: a Feistel permutation, with cycle walking, over global row numbers.

Rows are numbered by (id, checksum, size); a keyed permutation of 0..N-1 sends number r to place p; the shard is
p mod n and the slot p div n. So shard sizes differ by one row at most, slots have no gaps, and shard and slot of any
row, or the row of any slot, are computed from the number alone; how the table was split plays no part.

The permutation works on pairs (left, right) of digits in base a = ceil(sqrt(N)); the few places from N to a*a are
walked: permuted again until they fall below N. At most a*a - N + 1 steps are ever needed and all of them are allowed
while that is below MAX_WALK; beyond, MAX_WALK steps fail with a chance below (2/sqrt(N))**MAX_WALK, and then loudly.

Cases: null ids come first; a null text has no bytes (size 1, checksum 0); rows alike in id, checksum and size get
neighbouring numbers and are interchangeable; an empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import written

ROUNDS, MAX_WALK = 6, 64
PRIME = 2147483647


def round_keys(seed: int) -> list[int]:
    """ROUNDS keys below PRIME, by the minimal standard generator."""
    keys, x = [], seed % (PRIME - 1) + 1
    for _ in range(ROUNDS):
        for _ in range(4):
            x = x * 48271 % PRIME
        keys.append(x)
    return keys


def _mixed(x: Column, key: Column) -> Column:
    """The round function: below 2**31 throughout, so that products stay within 63 bits."""
    h = ((x % PRIME) * 69621 + key) % PRIME
    h = h.bitwiseXOR(F.shiftright(h, 15))
    h = (h * 39373 + key) % PRIME
    return h.bitwiseXOR(F.shiftright(h, 13))


def permuted(number: Column, n: int, seed: int = 0) -> Column:
    """The place of a row number below n."""
    base = math.isqrt(max(n, 1) - 1) + 1
    keys = F.array(*(F.lit(k).cast("long") for k in round_keys(seed)))

    def once(x: Column) -> Column:
        start = F.struct(((x - x % base) / F.lit(base)).cast("long").alias("l"), (x % base).cast("long").alias("r"))
        end = F.aggregate(keys, start, lambda s, k: F.struct(s["r"].alias("l"), ((s["l"] + _mixed(s["r"], k)) % base).cast("long").alias("r")))
        return end["l"] * base + end["r"]

    steps = min(base * base - n, MAX_WALK)
    first = once(number)
    if not steps:
        return first
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), first, lambda x, _: F.when(x >= n, once(x)).otherwise(x))
    return walked


def numbered(rows: DataFrame, *order: str) -> tuple[DataFrame, int]:
    """Rows with ``row_number`` from 0 in the given order, and their count.

    One range shuffle; the sorted table is written, so that numbers never change on a retry; offsets are one row a
    partition.
    """
    at = F.monotonically_increasing_id()
    ranged = rows.repartitionByRange(*(F.col(c).asc_nulls_first() for c in order)).sortWithinPartitions(*(F.col(c).asc_nulls_first() for c in order))
    ranged = written(ranged.withColumn("__at", at).withColumn("__part", F.shiftright("__at", 33)), "numbered")
    parts = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("n"), F.min("__at").alias("low"))
    before = F.coalesce(F.sum("n").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = parts.select("__part", (before - F.col("low")).alias("__shift"), "n")
    total = offsets.agg(F.sum("n")).first()[0] or 0
    # one row a partition of the table above: bounded by the number of partitions
    out = ranged.join(F.broadcast(offsets.drop("n")), "__part").withColumn("row_number", F.col("__at") + F.col("__shift"))
    return out.drop("__at", "__part", "__shift"), int(total)


def sharded(docs: DataFrame, shards: int = 16, seed: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: id, size, text_crc32, row_number, place, shard, slot."""
    text = F.encode(F.col(text_col).cast("string"), "UTF-8")
    narrow = docs.select(F.col(id_col), (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"), F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"))
    rows, n = numbered(narrow, id_col, "text_crc32", "size")
    rows = rows.withColumn("place", permuted(F.col("row_number"), n, seed))
    rows = rows.withColumn("place", F.when(F.col("place") < n, F.col("place")).otherwise(F.raise_error(F.lit("a cycle was longer than MAX_WALK")).cast("long")))
    return rows.withColumn("shard", (F.col("place") % shards).cast("int")).withColumn("slot", ((F.col("place") - F.col("place") % shards) / F.lit(shards)).cast("long"))
