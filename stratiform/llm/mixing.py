"""Mixing sources to target weights by entropy balancing.

Targets: sources in the order of their names (by code point, null last) take the weights in turn and share ``share``
times all words; no target exceeds ``cap`` times its source's words, and what is cut off is shared again by weight.

Rates: of all document rates that give each source its target, those nearest to one copy each in relative entropy, none
above ``cap``. The dual is convex with one multiplier a source: rate = min(cap, exp(multiplier * size / scale)), so
longer documents are tilted more. Its Newton iterations are distributed: each is one aggregation over the distinct
(source, size) pairs, guarded by a bracket. Sums are decimal, hence the same in whatever order they are added.

Copies: within a source, ordered by size, rates are accumulated and rounded where the running sum passes a half; so each
document gets the whole number below or above its rate, and a source's words miss its target by no more than about its
longest document. Which documents of one size get the copy is decided by the rank of the hashes of their ids and texts. A
rank is the number of rows in lower ranges of the hash plus the rank within the range; n rows alike in source and size
have about sqrt(n) ranges, so neither a range nor the list of ranges is long, and the rank is the same for any ranges.

Cases: null texts have no words; sources without words get the target 0; null sources are a source of their own; null
ids are hashed like others; rows alike in id and text are interchangeable; an empty table gives an empty result. Only the
named columns are read; further columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import WORD, as_struct, dropped, text_key, written

MAX_STEPS, TOLERANCE = 60, 1e-10


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).alias("id"), text_key(text).alias("text_key"), F.col(source_col).cast("string").alias("source"), n_words(text).alias("size"))


def targets(sizes: DataFrame, weights: tuple[int, ...], share: float, cap: float) -> DataFrame:
    """(sid, source, source_size, weight, target) from (source, source_size); one row a source."""
    order = W.orderBy(F.col("source").asc_nulls_last())
    each = F.array(*(F.lit(int(w)) for w in weights))
    ranked = sizes.withColumn("sid", F.row_number().over(order) - 1)
    ranked = written(ranked.withColumn("weight", F.element_at(each, (F.col("sid") % len(weights) + 1).cast("int"))), "sources")
    first = ranked.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weights")).first()
    total, level, capped = share * (first["words"] or 0), 0.0, -1
    most = F.col("source_size") * F.lit(float(cap))
    if first["words"]:
        level = total / first["weights"]
        while True:  # the level only rises, and with it the number of capped sources
            above = F.col("weight") * F.lit(level) >= most
            now = ranked.agg(
                F.sum(F.when(above, F.col("source_size")).otherwise(0)).alias("held"), F.sum(F.when(~above, F.col("weight")).otherwise(0)).alias("free"), F.count_if(above).alias("n")
            ).first()
            if now["n"] == capped or not now["free"]:
                break
            capped, level = now["n"], (total - cap * now["held"]) / now["free"]
    return ranked.withColumn("target", F.least(most, F.col("weight") * F.lit(level)))


def _rate(cap: float) -> Column:
    tilt = F.exp(F.least(F.col("multiplier") * F.col("size") / F.col("scale"), F.lit(50.0)))
    return F.when(F.col("multiplier").isNull(), F.lit(float(cap))).otherwise(F.least(F.lit(float(cap)), tilt))


def _exact(x: Column) -> Column:
    return F.sum(x.cast("decimal(38,9)")).cast("double")


def multipliers(pairs: DataFrame, goals: DataFrame, cap: float) -> DataFrame:
    """(sid, multiplier, scale): Newton on the dual, every source at once; null where every document is at the cap.

    pairs: (sid, size, n), goals: (sid, source_size, target).
    """
    words = F.col("n") * F.col("size")
    square = pairs.groupBy("sid").agg(F.sum((words * F.col("size")).cast("decimal(38,0)")).cast("double").alias("square"))
    full = F.col("target") >= F.col("source_size") * F.lit(float(cap) * (1 - 1e-12))
    start = F.when((F.col("source_size") > 0) & ~full, F.ln(F.col("target") / F.col("source_size")))
    state = goals.join(square, "sid").select(
        "sid", "target", F.when(F.col("source_size") > 0, F.col("square") / F.col("source_size")).otherwise(1.0).alias("scale"), start.alias("multiplier"),
        F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"), (F.col("source_size") == 0).alias("none"), start.isNull().alias("done"),
    )
    state = written(state, "dual")
    rate = _rate(cap)
    for _ in range(MAX_STEPS):
        open_ = state.where("NOT done")
        if open_.isEmpty():
            break
        slope = F.when(rate < cap, words * rate * F.col("size") / F.col("scale")).otherwise(0.0)
        sums = pairs.join(open_, "sid").groupBy("sid").agg(_exact(words * rate).alias("words"), _exact(slope).alias("slope"))
        gap = F.col("words") - F.col("target")
        low = F.when(gap < 0, F.col("multiplier")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("multiplier")).otherwise(F.col("high"))
        newton = F.when(F.col("slope") > 0, F.col("multiplier") - gap / F.col("slope"))
        inside = newton.isNotNull() & (F.col("lo").isNull() | (newton > F.col("lo"))) & (F.col("hi").isNull() | (newton < F.col("hi")))
        halved = F.when(F.col("lo").isNull(), F.col("hi") - 2.0).when(F.col("hi").isNull(), F.col("lo") + 2.0).otherwise((F.col("lo") + F.col("hi")) / 2)
        close = F.abs(gap) <= F.lit(TOLERANCE) * F.col("target")
        moved = state.join(sums, "sid", "left").withColumn("lo", low).withColumn("hi", high)
        step = F.when(F.col("done") | close, F.col("multiplier")).when(inside, newton).otherwise(halved)
        before, state = state, written(moved.select("sid", "target", "scale", step.alias("multiplier"), F.col("lo").alias("low"), F.col("hi").alias("high"), "none", (F.col("done") | close).alias("done")), "dual")
        dropped(before)
    return state.select("sid", "scale", F.when(F.col("none"), F.lit(0.0)).otherwise(F.round("multiplier", 12)).alias("multiplier"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row a document: id, text_key, source, size, source_size, target, rate, copies."""
    rows = written(sized(docs, id_col, text_col, source_col), "sizes")
    counts = rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    counts = written(counts, "source-sizes")
    goals = written(targets(counts.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size")), weights, share, cap), "targets")
    pairs = counts.join(goals.select("sid", F.col("source").alias("__source")), F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    pairs = written(pairs, "pairs")
    solved = multipliers(pairs.drop("source"), goals, cap)

    upto = W.partitionBy("sid").orderBy("size")
    cells = pairs.join(solved, "sid").withColumn("rate", _rate(cap)).withColumn("end", F.sum(F.col("n") * F.col("rate")).over(upto.rowsBetween(W.unboundedPreceding, 0)))
    passed = F.floor(F.col("end") + 0.5) - F.coalesce(F.floor(F.lag("end").over(upto) + 0.5), F.lit(0))
    whole = F.floor("rate")
    cells = cells.withColumn("passed", passed).withColumn("whole", whole)
    more = F.greatest(F.lit(0), F.least(F.col("n"), F.col("passed") - F.col("n") * F.col("whole")))
    cells = cells.select(
        "sid", F.col("source").alias("__source"), F.col("size").alias("__size"), "rate", "whole", more.alias("more"),
        F.ceil(F.sqrt("n")).cast("long").alias("ranges"),
    ).join(goals.select("sid", "source_size", "target"), "sid")

    ranked = rows.join(cells, F.col("source").eqNullSafe(F.col("__source")) & (F.col("size") == F.col("__size")))
    # the upper 32 bits of the hash, without sign, say in which of the equally wide ranges it lies
    ranked = ranked.withColumn("h", F.xxhash64("id", "text_key")).withColumn("upper", F.shiftrightunsigned("h", 32))
    ranked = ranked.withColumn("range", F.shiftright(F.col("upper") * F.col("ranges"), 32))
    lengths = ranked.groupBy("sid", "size", "range").agg(F.count(F.lit(1)).alias("m"))
    lower = W.partitionBy("sid", "size").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    below = written(lengths.select("sid", "size", "range", F.coalesce(F.sum("m").over(lower), F.lit(0)).alias("below")), "hash-ranges")
    within = W.partitionBy("sid", "size", "range").orderBy("upper", "h", "id", "text_key")
    rank = F.col("below") + F.row_number().over(within)
    copies = (F.col("whole") + F.when(rank <= F.col("more"), 1).otherwise(0)).cast("int")
    return ranked.join(below, ["sid", "size", "range"]).withColumn("copies", copies).select(F.col("id").alias(id_col), "text_key", "source", "size", "source_size", "target", "rate", "copies")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The mix itself: each document as often as it is taken, in its own columns."""
    taken = mixed(docs, id_col=id_col, text_col=text_col, source_col=source_col, **how)
    taken = taken.groupBy(F.col(id_col).alias("i"), F.col("text_key").alias("t"), F.col("source").alias("s")).agg(F.count(F.lit(1)).alias("n"), F.sum("copies").cast("long").alias("copies"))
    taken = written(taken.where("copies > 0"), "copies")
    rows = docs.select(as_struct(docs).alias("doc"), docs[id_col].alias("id"), text_key(docs[text_col].cast("string")).alias("text_key"), docs[source_col].cast("string").alias("source"))
    out = rows.join(taken, F.col("id").eqNullSafe(F.col("i")) & (F.col("text_key") == F.col("t")) & F.col("source").eqNullSafe(F.col("s")))
    copies = F.col("copies")
    if not taken.where("n > 1").isEmpty():  # rows alike in id, text and source share their copies, whose number changes by one at most
        k = F.row_number().over(W.partitionBy("id", "text_key", "source").orderBy(F.xxhash64("doc"))) - 1
        share = F.col("copies").cast("long")
        each = ((share - share % F.col("n")) / F.col("n")).cast("long")
        copies = each + F.when(k < share % F.col("n"), 1).otherwise(0)
    return out.withColumn("taken", copies).where("taken > 0").select("doc", F.explode(F.sequence(F.lit(1).cast("long"), F.col("taken")))).select("doc.*")
