"""SimHash near-duplicates: fingerprints, and their pairs within a Hamming distance by a vantage-point tree.

A tree is fitted on a bounded sample of distinct fingerprints (SAMPLE, chosen by hash): a node splits by the distance to a
vantage point at its median. Every distinct fingerprint is then placed in its home leaf, the shard, and by the triangle
bound it also asks each leaf that its ball of radius ``reach`` may overlap; of two such leaves only one is asked, by turns.
Within a shard, homes are ordered by their distances to two more vantage points, so that queries meet only homes whose
distances differ by at most ``reach`` on both. Shards are cut into cells of bounded numbers of homes and of queries, each
query meeting every cell of homes. A cell reports a spanning forest of its links, never all pairs; the links are followed to
components. The tree only decides who meets whom: any tree, however fitted, gives the same links.

Cases: null and empty texts and texts without words have fingerprint zero and link like any other; with fewer words than
a shingle has, the whole sequence is one; repeated rows and ids each get a row; a component is named by its smallest id,
nulls aside; texts are read whole, in pieces; only the two named columns are read. Empty tables give an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import dropped, given_verdicts, written
from .neardup import components

SHINGLE, SEED, REACH = 4, 42, 4
#: The most fingerprints that a tree is fitted on and its most leaves. Of n fingerprints about the root of n / SPREAD leaves are
#: made: with more, less is compared but more is moved, since a ball of radius REACH overlaps most halves of a split.
SAMPLE, LEAVES, SPREAD = 1 << 15, 256, 64
#: The most homes and queries of a cell, about, and pairs that are compared at once.
HOMES, QUERIES, PAIRS = 1 << 16, 1 << 18, 1 << 21
PIECE = 1 << 20
_SPACE = re.compile(rb"[ \t-\r]")


def _word_lists(text: bytes) -> Iterator[list[bytes]]:
    """Words of the text in pieces of about PIECE bytes; each begins with the last words of the one before."""
    at, words = 0, []
    while at < len(text):
        cut = _SPACE.search(text, at + PIECE) if at + PIECE < len(text) else None
        end = cut.start() if cut else len(text)
        words = words[-(SHINGLE - 1) :] + text[at:end].split()
        yield words
        at = end


def fingerprint(text: bytes | None) -> int:
    """64 bits, each set where more than half of the shingles' hashes have it."""
    ones, n, words = np.zeros(64, np.int64), 0, []
    for words in _word_lists((text or b"").lower()):
        joined = map(b" ".join, zip(*(words[k:] for k in range(SHINGLE)), strict=False))
        h = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in joined), np.uint64)
        for k in range(0, len(h), 1 << 15):
            ones += np.unpackbits(h[k : k + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        n += len(h)
    if n == 0:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED) if words else 0
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp) of every row, fp as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(x.as_py()) for x in batch.column(1).cast(pa.binary())], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["id", "fp"])

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("fp", T.LongType())])
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int16)


class Tree(NamedTuple):
    """Nodes by number; a child below zero is the leaf ~child. A tree of one leaf has no nodes."""

    vantage: np.ndarray
    radius: np.ndarray
    inner: np.ndarray
    outer: np.ndarray
    leaves: int


def fit(sample: np.ndarray, levels: int, seed: int = 11) -> Tree:
    """A tree of at most ``levels`` levels. Of a few candidates the vantage point with the widest spread of distances is taken."""
    rng, nodes, leaves = np.random.default_rng(seed), [], [0]

    def grow(xs: np.ndarray, level: int) -> int:
        if level and len(xs) >= 16:
            tried = rng.choice(xs, 8)
            apart = [distance(xs, v) for v in tried]
            k = int(np.argmax([d.std() for d in apart]))
            d, r = apart[k], int(np.median(apart[k]))
            r = r if (d > r).any() else r - 1
            if (d <= r).any() and (d > r).any():
                at = len(nodes)
                nodes.append([tried[k], r, 0, 0])
                nodes[at][2], nodes[at][3] = grow(xs[d <= r], level - 1), grow(xs[d > r], level - 1)
                return at
        leaves[0] += 1
        return ~(leaves[0] - 1)

    grow(sample, levels)
    column = lambda k, kind: np.array([n[k] for n in nodes], kind)
    return Tree(column(0, np.uint64), column(1, np.int16), column(2, np.int32), column(3, np.int32), leaves[0])


def homes(tree: Tree, x: np.ndarray) -> np.ndarray:
    """The leaf in which each fingerprint lives."""
    at = np.full(len(x), 0 if len(tree.vantage) else ~0, np.int32)
    while (going := np.flatnonzero(at >= 0)).size:
        k = at[going]
        at[going] = np.where(distance(x[going], tree.vantage[k]) <= tree.radius[k], tree.inner[k], tree.outer[k])
    return ~at


def visits(tree: Tree, x: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """(index, leaf) of every leaf that may hold a fingerprint within reach of x[index]."""
    todo, found = [(0 if len(tree.vantage) else ~0, np.arange(len(x)))], []
    while todo:
        k, which = todo.pop()
        if k < 0:
            found.append((which, np.full(len(which), ~k)))
        elif len(which):
            d = distance(x[which], tree.vantage[k])
            todo += [(tree.inner[k], which[d - reach <= tree.radius[k]]), (tree.outer[k], which[d + reach > tree.radius[k]])]
    return np.concatenate([w for w, _ in found]), np.concatenate([k for _, k in found])


def links_within(home: np.ndarray, query: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest (a, b) of the links between queries and homes; equal ones are no link."""
    every, parent = np.unique(np.concatenate([home, query])), None
    parent = np.arange(len(every))
    known = lambda x: np.searchsorted(every, x)
    out: list[tuple[int, int]] = []

    def top(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return int(i)

    v, w = home[0], home[-1]  # two vantage points of the cell's own
    place = lambda x: distance(x, v).astype(np.int32) * 128 + distance(x, w)
    order = np.argsort(place(home), kind="stable")
    home = home[order]
    at, asks = place(home), place(query)
    turn = np.argsort(asks, kind="stable")
    keys, starts = np.unique(asks[turn], return_index=True)
    for key, which in zip(keys, np.split(turn, starts[1:]), strict=True):
        d, e = divmod(int(key), 128)
        rings = np.arange(max(d - reach, 0), d + reach + 1) * 128 + e
        spans = zip(np.searchsorted(at, rings - min(reach, e)), np.searchsorted(at, rings + reach, "right"), strict=True)
        near = np.concatenate([home[a:b] for a, b in spans])
        step = max(1, PAIRS // max(len(near), 1))
        for k in range(0, len(which) if len(near) else 0, step):
            q = query[which[k : k + step]]
            diff = q[:, None] ^ near[None, :]
            hit = (np.bitwise_count(diff) <= reach) & (diff != 0)
            for i in np.flatnonzero(hit.any(1)):
                mine = int(known(q[i]))
                for label in np.unique(parent[known(near[hit[i]])]):
                    a, b = top(mine), top(int(label))
                    if a != b:
                        parent[b] = a
                        out.append((a, b))
    ends = every[np.array(out, np.int64).reshape(-1, 2)]
    return ends[:, 0], ends[:, 1]


def links(fps: DataFrame, reach: int = REACH) -> DataFrame:
    """(a, b): links enough to connect all of fps (fp, distinct) that are connected within ``reach``."""
    n = fps.count()
    every = -(-n // SAMPLE) or 1
    sample = fps.where(F.pmod(F.xxhash64("fp"), F.lit(every)) == 0).limit(2 * SAMPLE).toPandas()["fp"].to_numpy(np.int64).view(np.uint64)
    tree = fit(np.sort(sample), max(0, (min(LEAVES, math.isqrt(n // SPREAD)) - 1).bit_length()))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(0).to_numpy().view(np.uint64)
            home = homes(tree, x)
            which, leaf = visits(tree, x, reach)
            mine = home[which]
            asks = (leaf != mine) & ((mine < leaf) ^ ((mine + leaf) % 2 == 1))
            rows = np.concatenate([np.arange(len(x)), which[asks]])
            columns = [np.concatenate([home, leaf[asks]]).astype(np.int32), x[rows].view(np.int64), np.arange(len(rows)) < len(x)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["leaf", "fp", "home"])

    placed = written(fps.select("fp").mapInArrow(place, "leaf int, fp long, home boolean"), "shards")
    up = lambda total, most: F.greatest(F.ceil(total / F.lit(most)), F.lit(1)).cast("int")
    sizes = placed.groupBy("leaf").agg(up(F.count_if("home"), HOMES).alias("blocks"), up(F.count(F.lit(1)), QUERIES).alias("parts"))
    rows = placed.join(F.broadcast(sizes), "leaf")  # a row a leaf, LEAVES at most
    h = F.xxhash64("fp", F.lit(1))
    all_of = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    asked = rows.select("leaf", F.explode(all_of("blocks")).alias("block"), F.pmod(h, F.col("parts")).cast("int").alias("part"), "fp", F.lit(False).alias("home"))
    held = rows.where("home").select("leaf", F.pmod(h, F.col("blocks")).cast("int").alias("block"), F.explode(all_of("parts")).alias("part"), "fp", "home")

    def linked(cell: pd.DataFrame) -> pd.DataFrame:
        x, home = cell["fp"].to_numpy(np.int64).view(np.uint64), cell["home"].to_numpy(bool)
        a, b = links_within(x[home], x[~home], reach) if home.any() and not home.all() else (x[:0], x[:0])
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    out = written(held.unionByName(asked).groupBy("leaf", "block", "part").applyInPandas(linked, "a long, b long"), "links")
    dropped(placed)
    return out


def near_groups(docs: DataFrame, reach: int = REACH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: id, fingerprint (16 hex digits), component_id, kept (it names its component)."""
    rows = written(fingerprints(docs, id_col, text_col), "fingerprints")
    fps = written(rows.groupBy("fp").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("m")), "distinct-fingerprints")
    labels = components(links(fps, reach)).withColumnRenamed("id", "fp")
    named = written(fps.join(labels, "fp", "left").select("fp", "m", "least", F.coalesce("component", "fp").alias("comp")), "named-fingerprints")
    tops = written(named.groupBy("comp").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("n")), "components")
    classed = written(given_verdicts(named.select("fp", "m", "comp"), tops, "comp", "n").select("fp", "m", "component_id"), "fingerprint-components")
    out = given_verdicts(rows, classed, "fp", "m")
    dropped(fps, named, tops)
    return out.select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", F.col("component_id").eqNullSafe(F.col("id")).alias("kept"))
