"""The prefix trie of conversations by prefix doubling: blocks of turns are named, then prefixes, then nodes are grouped.

Turns are numbered within their conversation and named by content: equal (role, text) get one dense number (a row of a table
of distinct contents, counted on from partition to partition). Aligned blocks of 2, 4, 8... turns are named by the pair of
their halves' names, in as many rounds as the longest conversation's length has binary digits; the prefix of d turns is
composed of the blocks of d's binary digits, named in as many rounds again. Equal names at one depth are equal prefixes, so
nodes are groups of (depth, name). What a node's subtree holds is summed over its members instead of level by level: each
conversation owns the nodes whose smallest member it is, a subtree is what its members own less what its owner owns above.

Contents are told apart by SHA-256. No conversation, block, node or member list is gathered in one task: turns are numbered
by ranges of (conversation, turn), sums along a conversation run by stretches of STRETCH turns, and the ids that end at a
node are joined to strings range by range, which one task then digests as a stream, since SHA-256 can only be taken in order.

Cases: null role or text is read as empty; turns of one number are ordered by role, then text; a null turn comes first; rows
without a conversation id belong to no conversation; repeated rows are turns of their own; texts are used whole; further
columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import dropped, written

#: Conversations c take their first turns from c - c % EVERY, fewer than LEADS of them.
EVERY, LEADS = 100, 6
#: Turns of a conversation that are summed in one go, and ids that are joined to one string.
STRETCH, JOINED = 4096, 4096


def _place():
    """Which partition a row is in and how many rows it has there before it; to be written at once, never recomputed."""
    return {"part": F.spark_partition_id(), "at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}


def numbered(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(c, pos, key, chars): the turns of each conversation from 0, with the digest and length of what they say."""
    say = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    rows = turns.select(F.col(conv).cast("long").alias("c"), F.col(turn).alias("turn"), say(role).alias("role"), say(text).alias("text"), F.monotonically_increasing_id().alias("row")).where("c IS NOT NULL")
    order = ["c", "turn", "role", "text", "row"]
    key = F.unhex(F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(" "), "role", "text"), 256))
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumns(_place())
    placed = written(placed.select("c", "part", "at", key.alias("key"), F.char_length("text").cast("long").alias("chars")), "turns")
    spans = placed.groupBy("c", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(W.partitionBy("c").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    spans = written(spans.withColumn("before", F.coalesce(before, F.lit(0)) - F.col("first")).select("c", "part", "before"), "spans")
    out = written(placed.join(spans, ["c", "part"]).select("c", (F.col("at") + F.col("before")).alias("pos"), "key", "chars"), "numbered-turns")
    dropped(placed, spans)
    return out


def rebuilt(turns: DataFrame, every: int = EVERY, leads: int = LEADS) -> tuple[DataFrame, DataFrame]:
    """(conversations (c, length), turns): the first h turns of c - c % every, then c's own after its first h; h = crc32(c) % leads."""
    n = turns.groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    h = F.crc32(F.encode(F.col("c").cast("string"), "UTF-8")) % leads
    convs = n.select("c", "n", (F.col("c") - F.col("c") % every).alias("base"), h.alias("h"))
    convs = convs.join(n.select(F.col("c").alias("base"), F.col("n").alias("there")), "base", "left")
    convs = written(convs.select("c", "n", "base", "h", F.least("h", F.coalesce("there", F.lit(0))).alias("given")), "conversations")
    own = turns.join(convs.select("c", "h", "given"), "c").where("pos >= h").select("c", (F.col("pos") - F.col("h") + F.col("given")).alias("pos"), "key", "chars")
    heads = turns.where((F.col("c") % every == 0) & (F.col("pos") < leads)).withColumnRenamed("c", "base")
    lent = convs.select("c", "base", "h").join(heads, "base").where("pos < h").select("c", "pos", "key", "chars")
    out = written(own.unionByName(lent), "rebuilt-turns")
    return convs.select("c", (F.col("given") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")), out


def named(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The rows with a dense number in place of their keys: the same for equal keys, 0 to how many there are less one."""
    every = written(rows.select(*keys).dropDuplicates().withColumns(_place()), f"names-{name}")
    starts = every.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # a row a partition
    starts = starts.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("start"))
    names = every.join(F.broadcast(starts), "part").select(*keys, (F.col("start") + F.col("at")).alias(name))
    out = written(rows.join(names, keys).drop(*keys), name)
    dropped(every)
    return out


def block_names(turns: DataFrame, longest: int) -> list[DataFrame]:
    """For each power of two up to longest, (c, j, name): the names of the aligned blocks [j * 2^k, (j + 1) * 2^k)."""
    out = [named(turns.select("c", F.col("pos").alias("j"), "key"), ["key"], "name")]
    for _ in range(longest.bit_length() - 1):
        half = lambda odd: F.max(F.when(F.col("j") % 2 == odd, F.col("name")))
        pairs = out[-1].groupBy("c", F.floor(F.col("j") / 2).alias("j2")).agg(half(0).alias("a"), half(1).alias("b")).where("b IS NOT NULL")
        out.append(named(pairs.withColumnRenamed("j2", "j"), ["a", "b"], "name"))
    return out


def prefix_names(blocks: list[DataFrame]) -> DataFrame:
    """(c, d, name) of every prefix of at least one turn: from the highest digit of d down, the prefix so far and one block more."""
    found: DataFrame | None = None
    for k in reversed(range(len(blocks))):
        ends = blocks[k].where("j % 2 = 0").select("c", (F.col("j") * (1 << k)).alias("before"), ((F.col("j") + 1) * (1 << k)).alias("d"), "name")
        first = ends.where("before = 0").select("c", "d", "name")
        if found is None:
            found = first
            continue
        longer = ends.where("before > 0").withColumnRenamed("name", "block").join(found.select("c", F.col("d").alias("before"), F.col("name").alias("prefix")), ["c", "before"])
        longer = named(longer.select("c", F.col("d").alias("depth"), "d", "prefix", "block"), ["d", "prefix", "block"], "name").withColumnRenamed("depth", "d")
        found = found.unionByName(first).unionByName(longer)
    return found


def ends_digests(ends: DataFrame) -> DataFrame:
    """(d, name, digest): SHA-256 of the ascending, comma-joined ids c of each group of ends (d, name, c)."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids = None, []

        def chunk() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"d": node[0], "name": node[1], "first": ids[0], "ids": ",".join(map(str, ids))}], schema=chunks)

        for batch in batches:
            for *here, c in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if ids and (here != node or len(ids) >= JOINED):
                    yield chunk()
                    ids = []
                node = here
                ids.append(c)
        if ids:
            yield chunk()

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state, out = None, None, []
        for batch in batches:
            for *here, ids in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if here == node:
                    state.update(b",")
                else:
                    if node:
                        out.append((*node, state.hexdigest()))
                    node, state = here, hashlib.sha256()
                state.update(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(list(x)) for x in zip(*out, strict=True)], names=["d", "name", "digest"]) if out else empty
            out = []
        if node:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, state.hexdigest())], names=["d", "name", "digest"])

    chunks = pa.schema([("d", pa.int64()), ("name", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])
    empty = pa.RecordBatch.from_arrays([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.string())], names=["d", "name", "digest"])
    order = ["d", "name", "c"]
    strings = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(joined, "d long, name long, first long, ids string")
    sorted_ = strings.repartition("d", "name").sortWithinPartitions("d", "name", "first").select("d", "name", "ids")
    return sorted_.mapInArrow(digested, "d long, name long, digest string")


def trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """One row a node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    convs: c, length. turns: c, pos, key, chars.
    """
    convs = written(convs, "lengths")
    longest = convs.agg(F.max("length")).first()[0] or 0
    blocks = block_names(turns, longest) if longest else []
    root = convs.select("c", F.lit(0).cast("long").alias("d"), F.lit(0).cast("long").alias("name"))
    members = written(root.unionByName(prefix_names(blocks)) if blocks else root, "members")
    dropped(*blocks)
    nodes = written(members.groupBy("d", "name").agg(F.min("c").alias("owner"), F.count(F.lit(1)).alias("n")), "nodes")
    above = members.select(F.col("c").alias("owner"), (F.col("d") + 1).alias("d"), F.col("name").alias("parent"))
    last = turns.select(F.col("c").alias("owner"), (F.col("pos") + 1).alias("d"), "chars")
    placed = written(nodes.join(above, ["owner", "d"], "left").join(last, ["owner", "d"], "left"), "placed-nodes")
    kids = placed.where("d > 0").groupBy((F.col("d") - 1).alias("d"), F.col("parent").alias("name")).agg(F.count(F.lit(1)).alias("n_children"))
    saved = (F.col("n") - 1) * F.coalesce("chars", F.lit(0))
    worth = placed.join(kids, ["d", "name"], "left").select("d", "name", "owner", "parent", "n", F.coalesce("n_children", F.lit(0)).alias("n_children"), saved.alias("saved"))
    worth = written(worth, "valued-nodes")
    owned = written(worth.groupBy(F.col("owner").alias("c")).agg(F.sum("saved").alias("saved"), F.count_if(F.col("n_children") == 0).alias("leaves")), "owned")
    sums = members.join(owned, "c").groupBy("d", "name").agg(F.sum("saved").alias("all_saved"), F.sum("leaves").alias("n_leaves"))
    stretch = F.floor(F.col("d") / STRETCH)
    steps = worth.groupBy("owner", stretch.alias("stretch")).agg(F.sum("saved").alias("s"))
    up_to = lambda w: w.rowsBetween(W.unboundedPreceding, -1)
    steps = written(steps.select("owner", "stretch", F.coalesce(F.sum("s").over(up_to(W.partitionBy("owner").orderBy("stretch"))), F.lit(0)).alias("before")), "stretches")
    along = worth.withColumn("stretch", stretch).join(steps, ["owner", "stretch"])
    along = along.withColumn("above", F.col("before") + F.coalesce(F.sum("saved").over(up_to(W.partitionBy("owner", "stretch").orderBy("d"))), F.lit(0)))
    ends = ends_digests(convs.select("c", F.col("length").alias("d")).join(members, ["c", "d"]))
    parents = nodes.select((F.col("d") + 1).alias("d"), F.col("name").alias("parent"), F.col("owner").alias("parent_conv_id"))
    out = along.join(sums, ["d", "name"]).join(ends, ["d", "name"], "left").join(parents, ["d", "parent"], "left")
    return out.select(
        F.col("owner").alias("conv_id"), F.col("d").alias("depth"), "parent_conv_id", F.col("n").alias("n_convs"), "n_children", "n_leaves",
        (F.col("all_saved") - F.col("above")).alias("saved_tokens"), F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def conversation_trie(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The trie of the conversations as they are."""
    rows = numbered(turns, conv, turn, role, text)
    return trie(rows.groupBy("c").agg(F.count(F.lit(1)).alias("length")), rows)
