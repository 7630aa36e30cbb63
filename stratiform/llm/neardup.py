"""Near-duplicate groups by MinHash bands and sequential Bayesian verification.

Texts with the same words are one class first. The distinct five-word shingles of a class are sketched by BANDS * ROWS
minima; classes that agree on all rows of a band are candidates. In small buckets every pair is a candidate; in large
ones each member is paired with one centre (the member with the most bucket mates), and what that leaves apart is
compared in blocks within the bucket: signatures first, texts only of members that a signature left in doubt. A candidate
pair's signatures are compared batch by batch; as soon as the posterior chance that its similarity reaches the threshold
(uniform prior) falls below ``miss``, it is dropped. Survivors are verified on their full shingle sets (64-bit hashes of
the shingles), and links are followed to components. Classes are numbered within a run, so ids may be of any type that
can be ordered, and no group, class or component is ever gathered in one task.

Cases: texts without words have no shingles and link with nothing; with fewer than five words the whole sequence is one
shingle; a component is named by its smallest id, nulls aside, and by null if it has none; a row without an id is kept only
where its component has no id either; rows that repeat an id with the same words get the same verdict; where an id repeats
with other words, each text is judged for itself. ``distinct_documents`` leaves one row of each component and every row
without words. An empty table gives an empty result; texts of any length are used whole; only the named columns are
read, and further ones may have any name.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD, dropped, given_verdicts, picked, text_key, written

SHINGLE, BANDS, ROWS, SMALL = 5, 40, 8, 8
#: A pair at the threshold escapes all bands with a chance of at most this; rows_for() makes bands short enough.
ESCAPE = 1e-5
BATCH, MISS = 32, 1e-7
#: Members of a large bucket are compared in blocks: sketches in blocks of about so many, of a few hundred bytes each; full
#: texts in blocks of about so many, and of about so many bytes.
SKETCH_BLOCK, BLOCK, BLOCK_BYTES = 1024, 256, 4 << 20
#: Words whose hashes a worker remembers.
KNOWN_WORDS = 200_000
_FOLD = np.uint64(0x9E3779B97F4A7C15)
_RNG = np.random.default_rng(7)
_A = (_RNG.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1))[:, None]
_B = _RNG.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)[:, None]
_MIX = _RNG.integers(1, 1 << 63, ROWS, dtype=np.uint64) | np.uint64(1)


class _WordHashes(dict):
    """64-bit hashes of words, as asked for; forgets all beyond KNOWN_WORDS."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = h = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return h


_WORDS = _WordHashes()


def shingles(words: list[bytes]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles: the words' hashes are folded one after another, for all places at once."""
    if not words:
        return np.zeros(0, np.uint64)
    size = min(SHINGLE, len(words))
    n = len(words) - size + 1
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    acc = np.full(n, size, np.uint64)
    for k in range(size):
        acc = (acc ^ (acc >> np.uint64(32)) ^ h[k : k + n]) * _FOLD
    return np.unique(acc ^ (acc >> np.uint64(29)))


def rows_for(percent: int) -> int:
    """The most rows a band (ROWS at most) with which a pair at the threshold escapes all bands with chance ESCAPE or less."""
    return next((r for r in range(ROWS, 1, -1) if (1 - (percent / 100) ** r) ** BANDS <= ESCAPE), 1)


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def signature(hashes: np.ndarray, rows: int = ROWS) -> np.ndarray:
    out = np.full(BANDS * rows, 0xFFFFFFFF, np.uint32)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    with np.errstate(over="ignore"):
        for k in range(0, len(short), 1024):
            out = np.minimum(out, (_A[: BANDS * rows] * short[None, k : k + 1024] + _B[: BANDS * rows]).min(1))
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        grid = sig.reshape(BANDS, -1)
        h = (grid.astype(np.uint64) * _MIX[: grid.shape[1]]).sum(1) + np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(31)
        return (h * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64)


def least_matches(threshold: float, miss: float = MISS, rows: int = ROWS) -> list[int]:
    """For each number of compared hashes, the fewest matches with which the posterior still reaches ``miss``."""
    out = []
    for n in range(BATCH, BANDS * rows + 1, BATCH):
        total, m = 0.0, -1
        while total < miss and m < n:  # P(S >= t | m of n) = P(Bin(n + 1, t) <= m)
            m += 1
            total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return out


def likely(a: np.ndarray, b: np.ndarray, least: list[int]) -> np.ndarray:
    """Which pairs of signatures (rows of low bytes) survive all batches."""
    alive, hits = np.arange(len(a)), np.zeros(len(a), np.int64)
    for k, m in enumerate(least):
        at = slice(k * BATCH, (k + 1) * BATCH)
        hits = hits + (a[alive, at] == b[alive, at]).sum(1)
        alive, hits = alive[hits >= m], hits[hits >= m]
    out = np.zeros(len(a), bool)
    out[alive] = True
    return out


def _sketches(docs: DataFrame, id_col: str, text_col: str, rows: int) -> DataFrame:
    """(id, text_key, key, n, bytes, sig, bands, row): a sketch of every row; ``row`` numbers the rows of this run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, counts, sizes, sigs, bands = [], [], [], [], []
            for x in batch.column(2).cast(pa.binary()):
                words = words_of(x.as_py())
                h = shingles(words)
                sig = signature(h, rows)
                keys.append(hashlib.sha256(b" ".join(words)).digest())
                counts.append(len(h))
                sizes.append(len(x.as_py() or b""))
                sigs.append(sig.astype(np.uint8).tobytes() if len(h) else None)
                bands.append(band_keys(sig) if len(h) else [])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys, pa.binary()), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(sigs, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], names=names)

    names = ["id", "text_key", "key", "n", "bytes", "sig", "bands"]
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *T._parse_datatype_string("text_key binary, key binary, n long, bytes long, sig binary, bands array<long>").fields])
    return _texts(docs, id_col, text_col).select("id", "text_key", "text").mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id())


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).alias("id"), text_key(text).alias("text_key"), text.alias("text"))


def _texts_of(needed: DataFrame, rows: DataFrame, texts: DataFrame) -> DataFrame:
    """(c, text) of the classes that needed (c) names, one row each; texts of others stay where they are."""
    where = rows.join(needed.dropDuplicates(), F.col("row") == F.col("c")).select("c", F.col("id").alias("i"), F.col("text_key").alias("t"))
    found = texts.join(where, F.col("id").eqNullSafe(F.col("i")) & (F.col("text_key") == F.col("t")))
    return written(found.groupBy("c").agg(F.first("text").alias("text")), "candidate-texts")


def _grid(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(len(column), -1)


def _overlap(s: np.ndarray, t: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets of hashes are similar enough."""
    if 100 * min(len(s), len(t)) < percent * max(len(s), len(t)):
        return False
    both = int((t[np.searchsorted(t, s).clip(0, len(t) - 1)] == s).sum())
    return 100 * both >= percent * (len(s) + len(t) - both)


def _verified(pairs: DataFrame, sigs: DataFrame, rows: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are linked."""
    least = least_matches(percent / 100, rows=rows_for(percent))

    @F.pandas_udf("boolean")
    def may(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(likely(_grid(a), _grid(b), least) if len(a) else [], dtype=bool)

    @F.pandas_udf("boolean")
    def linked(a: pd.Series, b: pd.Series) -> pd.Series:
        known: dict[str, np.ndarray] = {}

        def sets(t: str) -> np.ndarray:
            if t not in known:
                if len(known) > 64:
                    known.clear()
                known[t] = shingles(words_of(t.encode()))
            return known[t]

        return pd.Series([_overlap(sets(x), sets(y), percent) for x, y in zip(a, b, strict=True)], dtype=bool)

    left, right = (sigs.select(F.col("c").alias(k), F.col("sig").alias(f"sig_{k}")) for k in "ab")
    kept = written(pairs.join(left, "a").join(right, "b").where(may("sig_a", "sig_b")).select("a", "b"), "candidates")
    wanted = _texts_of(kept.select(F.explode(F.array("a", "b")).alias("c")), rows, texts)
    left, right = (wanted.select(F.col("c").alias(k), F.col("text").alias(f"text_{k}")) for k in "ab")
    links = written(kept.join(left, "a").join(right, "b").where(linked("text_a", "text_b")).select("a", "b"), "links")
    dropped(kept, wanted)
    return links


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable, by label propagation with pointer jumping."""
    edges = written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).dropDuplicates(), "edges")
    labels = written(edges.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("component")), "labels")
    while True:
        near = edges.join(labels.select(F.col("id").alias("b"), "component"), "b").groupBy(F.col("a").alias("id")).agg(F.min("component").alias("low"))
        step = written(labels.join(near, "id").select("id", F.col("component").alias("was"), F.least("component", "low").alias("next")), "labels")
        jump = step.select(F.col("id").alias("next"), F.col("next").alias("far"))
        moved = written(step.join(jump, "next", "left").select("id", F.coalesce(F.least("next", "far"), F.col("next")).alias("component"), "was"), "labels")
        dropped(labels, step)
        labels = moved
        if moved.where("component <> was").isEmpty():
            dropped(edges)
            return labels.select("id", "component")


def _classed(docs: DataFrame, percent: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Every row with its class key, and for every class its component: (key, m, comp, component_id), m rows each."""
    rows = written(_sketches(docs, id_col, text_col, rows_for(percent)), "sketches")
    texts = _texts(docs, id_col, text_col)
    classes = written(rows.groupBy("key").agg(F.min("id").alias("least"), F.min("row").alias("c"), F.count(F.lit(1)).alias("m")), "classes")
    reps = written(rows.where("n > 0").join(classes.select(F.col("c").alias("row")), "row", "left_semi").select(F.col("row").alias("c"), "sig", "bands", "bytes"), "representatives")
    exploded = reps.select("c", "bytes", F.posexplode("bands").alias("band", "bucket"))
    # Counts are aggregated before the shuffle and written, so that the joins with them may be split at hot buckets.
    sizes = written(exploded.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "bucket-sizes")
    buckets = written(exploded.join(sizes, "bucket"), "buckets")
    small = buckets.where(F.col("m") <= SMALL).groupBy("bucket").agg(F.array_sort(F.collect_list("c")).alias("cs"))
    each = F.flatten(F.transform("cs", lambda x: F.transform(F.filter("cs", lambda y: y > x), lambda y: F.struct(x.alias("a"), y.alias("b")))))
    small = small.select(F.explode(each).alias("p")).select("p.a", "p.b")
    large = buckets.where(F.col("m") > SMALL)
    large = written(large.join(large.groupBy("c").agg(F.sum("m").alias("mates")), "c"), "large-buckets")
    centre = written(large.groupBy("bucket").agg(F.max_by("c", F.struct("mates", -F.col("c"))).alias("centre")), "centres")
    stars = large.join(centre, "bucket").where("c <> centre").select(F.least("c", "centre").alias("a"), F.greatest("c", "centre").alias("b"))
    pairs = small.unionByName(stars).dropDuplicates()
    links = _verified(pairs, reps.select("c", "sig"), rows, texts, percent)
    labels = components(links)
    labelled = large.join(labels.withColumnRenamed("id", "c"), "c", "left").select("bucket", "band", "c", "bytes", F.coalesce("component", "c").alias("component"))
    apart = written(labelled.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("bucket"), "apart")
    rest = written(labelled.join(apart, "bucket"), "unresolved")
    if not rest.isEmpty():
        links = links.unionByName(written(_within(rest, reps, rows, texts, percent), "links"))
        labels = components(links)
    named = classes.join(labels.withColumnRenamed("id", "c"), "c", "left").select("key", "m", "least", F.coalesce("component", "c").alias("comp"))
    named = written(named, "named-classes")
    tops = written(named.groupBy("comp").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("n_classes")), "components")
    classed = written(given_verdicts(named.select("key", "m", "comp"), tops, "comp", "n_classes").select("key", "m", "comp", "component_id"), "class-components")
    dropped(classes, reps, sizes, buckets, large, centre, apart, rest, named, tops)
    return rows.select("id", "text_key", "key", "n"), classed


def near_groups(docs: DataFrame, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: id, n_shingles, component_id, kept."""
    rows, classed = _classed(docs, percent, id_col, text_col)
    out = given_verdicts(rows.select("id", "key", "n"), classed, "key", "m")
    component = F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), component.eqNullSafe(F.col("id")).alias("kept"))


def _cells(members: DataFrame, most: int, most_bytes: int | None = None) -> DataFrame:
    """A bucket's members dealt by hash to blocks, each member once for every block that it must be compared with.

    Members of the bucket's largest component need no comparison with each other: they have blocks of their own, which meet
    the blocks of all others only. So a large group with few strangers is shipped about once.
    """
    parts = members.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("m"), F.sum("bytes" if most_bytes else F.lit(0)).alias("s"))
    first = F.struct("m", "component")
    sizes = parts.groupBy("bucket").agg(F.max_by("component", first).alias("main"), F.max("m").alias("mm"), F.max_by("s", first).alias("ms"), F.sum("m").alias("m"), F.sum("s").alias("s"))
    blocks = lambda m, s: F.ceil(F.greatest(m / most, s / (most_bytes or 1), F.lit(1.0))).cast("int")
    sizes = sizes.select("bucket", "main", blocks(F.col("m") - F.col("mm"), F.col("s") - F.col("ms")).alias("outer"), blocks(F.col("mm"), F.col("ms")).alias("inner"))
    rows = members.join(written(sizes, "block-sizes"), "bucket")
    stranger, h = F.col("component") != F.col("main"), F.xxhash64("c")
    rows = rows.withColumn("block", F.when(stranger, F.pmod(h, F.col("outer"))).otherwise(F.col("outer") + F.pmod(h, F.col("inner"))).cast("int"))
    last = F.col("outer") - 1 + F.when(stranger, F.col("inner")).otherwise(0)
    sides = F.transform(F.sequence(F.lit(0), last), lambda j: F.struct(F.least("block", j).alias("i"), F.greatest("block", j).alias("j")))
    return rows.withColumn("cell", F.explode(sides)).drop("outer", "inner", "main").withColumns({"i": F.col("cell.i"), "j": F.col("cell.j")}).drop("cell")


def _doubtful(cell: pd.DataFrame, least: list[int], comp: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(x, others) of a cell: members of other components whose signatures leave a link to x possible.

    Pairs that agree on an earlier band already are left to that band's bucket.
    """
    c, side, band = cell["c"].to_numpy(), cell["block"].to_numpy(), int(cell["band"].iloc[0])
    sig, bands = _grid(cell["sig"]), np.stack(cell["bands"].to_numpy())[:, :band]
    first, same = cell["i"].iloc[0], cell["i"].iloc[0] == cell["j"].iloc[0]
    for x in range(len(cell)):
        if not same and side[x] != first:
            continue
        other = np.flatnonzero((comp != comp[x]) & (c > c[x] if same else side != side[x]))
        if band and len(other):
            other = other[~(bands[other] == bands[x]).any(1)]
        if len(other):
            other = other[likely(np.broadcast_to(sig[x], (len(other), sig.shape[1])), sig[other], least)]
        if len(other):
            yield x, other


def _within(rest: DataFrame, reps: DataFrame, rows: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links between members of one bucket that are still in different components, block by block.

    No task sees more than two blocks at a time, whose bytes are bounded. Texts are fetched only for members that the signatures leave in doubt.
    """
    least = least_matches(percent / 100, rows=rows_for(percent))
    sketches = reps.select("c", "sig", "bands")

    def in_doubt(cell: pd.DataFrame) -> pd.DataFrame:
        hit = np.zeros(len(cell), bool)
        for x, other in _doubtful(cell, least, cell["component"].to_numpy()):
            hit[x] = True
            hit[other] = True
        return cell.loc[hit, ["bucket", "c"]]

    def linked(cell: pd.DataFrame) -> pd.DataFrame:
        c, comp, out, sets = cell["c"].to_numpy(), cell["component"].to_numpy().copy(), [], {}

        def of(k: int) -> np.ndarray:
            if k not in sets:
                sets[k] = shingles(words_of(cell["text"].iloc[k].encode()))
            return sets[k]

        for x, other in _doubtful(cell, least, comp):
            for y in other.tolist():
                if comp[x] != comp[y] and _overlap(of(x), of(y), percent):
                    out.append((int(c[x]), int(c[y])))
                    comp[comp == comp[y]] = comp[x]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    cells = _cells(rest, SKETCH_BLOCK).join(sketches, "c")
    doubt = written(cells.groupBy("bucket", "i", "j").applyInPandas(in_doubt, "bucket long, c long").dropDuplicates(), "in-doubt")
    members = written(rest.join(doubt, ["bucket", "c"], "left_semi"), "doubtful-members")
    wanted = _texts_of(doubt.select("c"), rows, texts)
    cells = _cells(members, BLOCK, BLOCK_BYTES).join(sketches, "c").join(wanted, "c")
    return cells.groupBy("bucket", "i", "j").applyInPandas(linked, "a long, b long")


def distinct_documents(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group (the one with the smallest id), in the documents' own columns."""
    rows, classed = _classed(docs, percent, id_col, text_col)
    out = given_verdicts(rows.where("n > 0"), classed.select("key", "m", "comp"), "key", "m")
    by_text = out.groupBy("comp", "id", "text_key").agg(F.count(F.lit(1)).alias("n"))
    first = F.min_by(F.struct("id", "text_key", "n"), F.struct(F.col("id").isNull(), "id", "text_key"))
    stay = written(by_text.groupBy("comp").agg(first.alias("s")).select("s.*"), "staying")
    wordless = ~F.coalesce(docs[text_col].cast("string").rlike(WORD), F.lit(False))
    return picked(docs, stay, id_col, text_col).unionByName(docs.where(wordless))
