"""Exact deduplication over content-defined chunk recipes.

Each normalised text (A-Z lower-cased) is cut where a rolling hash of its last 32 bytes says so, so equal passages give
equal chunks wherever they stand. A chunk's identifier is its fingerprint once it is verified: equal chunks are merged
by content, map-side first, and a fingerprint that stands for one content only is its identifier; one that stands for
several gets an identifier for each content. A document is then the ordered list of its identifiers (its recipe), and
documents are equal when their recipes are. Long texts move once, as distinct chunks; recipes, which are short, do the
comparing. Verdicts find their rows by the SHA-256 of the recipe, those of hot groups by broadcast (``given_verdicts``).

Cases: a null text counts as the empty one, whose recipe is the empty list; all of those are equal. Of equal texts the
row with the largest id stays; null ids come before all others. Rows that repeat the id and an equal text are one
document and share one verdict. ``distinct_documents`` leaves one row of each group, also of repeated rows and of a group
without any id (the one with the least key of its unchanged text). Empty tables give empty results. Only the named
columns are read; further columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from .common import dropped, given_verdicts, picked, text_key, written

WINDOW, MIN_CHUNK, MAX_CHUNK = 32, 512, 16384
#: A boundary where the low bits of the rolling hash are 0: chunks of about MIN_CHUNK + 1024 bytes.
BOUNDARY_MASK = np.uint32((1 << 10) - 1)
_RNG = np.random.default_rng(20240229)
_GEAR = _RNG.integers(0, 1 << 32, 256, dtype=np.uint32)
_FACTOR = np.uint32(0x9E3779B1)


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks of a text; they depend on the bytes nearby and on the last end only."""
    n = len(data)
    if n <= MIN_CHUNK:
        return [n] if n else []
    h = _GEAR[np.frombuffer(data, np.uint8)]
    factor, span = _FACTOR, 1
    with np.errstate(over="ignore"):
        while span < WINDOW:  # doubling: h[i] covers span bytes, then twice as many
            h[span:] += h[:-span] * factor
            factor, span = np.uint32(factor * factor), span * 2
    found = np.flatnonzero(((h >> np.uint32(11)) & BOUNDARY_MASK) == 0) + 1
    ends, start = [], 0
    for end in found.tolist():
        while end - start > MAX_CHUNK:
            start += MAX_CHUNK
            ends.append(start)
        if end - start >= MIN_CHUNK:
            ends.append(end)
            start = end
    while n - start > MAX_CHUNK:
        start += MAX_CHUNK
        ends.append(start)
    if start < n:
        ends.append(n)
    return ends


def fingerprint(chunk: bytes, bits: int) -> int:
    value = int.from_bytes(hashlib.blake2b(chunk, digest_size=8).digest(), "little")
    return (value & ((1 << bits) - 1)) - (1 << 63) if bits == 64 else value & ((1 << bits) - 1)


def _chunks(text: bytes | None) -> Iterator[bytes]:
    data = (text or b"").lower()  # bytes.lower() changes A-Z only
    start = 0
    for end in cuts(data):
        yield data[start:end]
        start = end


def _inputs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Id, text and a key of the unchanged text, by which verdicts find their rows again."""
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).alias("id"), text.alias("text"), text_key(text).alias("text_key"))


def _schema(docs: DataFrame, id_col: str, more: str) -> T.StructType:
    return T.StructType([T.StructField("id", docs.schema[id_col].dataType), *T._parse_datatype_string(f"text_key binary, text_sha256 string, {more}").fields])


def recipes(docs: DataFrame, id_col: str, text_col: str, bits: int = 64) -> DataFrame:
    """(id, text_key, text_sha256, recipe): the fingerprints of each text's chunks, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, fps = [], []
            for x in batch.column(1).cast(pa.binary()):
                text = x.as_py() or b""
                digests.append(hashlib.sha256(text.lower()).hexdigest())
                fps.append([fingerprint(c, bits) for c in _chunks(text)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(digests, pa.string()), pa.array(fps, pa.list_(pa.int64()))], names=names)

    names = ["id", "text_key", "text_sha256", "recipe"]
    return _inputs(docs, id_col, text_col).mapInArrow(run, _schema(docs, id_col, "recipe array<long>"))


def distinct_chunks(docs: DataFrame, text_col: str, bits: int = 64) -> DataFrame:
    """(fp, chunk), each pair once; equal chunks of one task are merged before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = {c: None for x in batch.column(0).cast(pa.binary()) for c in _chunks(x.as_py())}
            fps = pa.array([fingerprint(c, bits) for c in seen], pa.int64())
            yield pa.RecordBatch.from_arrays([fps, pa.array(list(seen), pa.binary())], names=["fp", "chunk"])

    chunks = docs.select(F.col(text_col).cast("string").alias("__text")).mapInArrow(run, "fp long, chunk binary")
    return chunks.groupBy("fp", "chunk").agg(F.count(F.lit(1)).alias("n")).select("fp", "chunk")


def ambiguous(chunks: DataFrame) -> DataFrame:
    """(fp) of the fingerprints that stand for several contents; distinct chunks meet by fp, and only numbers move."""
    return chunks.groupBy("fp").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("fp")


def variants(chunks: DataFrame, several: DataFrame) -> DataFrame:
    """(fp, chunk, variant) of ambiguous fingerprints."""
    found = chunks.join(several, "fp", "left_semi")
    return found.select("fp", "chunk", F.row_number().over(W.partitionBy("fp").orderBy("chunk")).cast("long").alias("variant"))


def _resolved(docs: DataFrame, found: DataFrame, id_col: str, text_col: str, bits: int) -> DataFrame:
    """Recipes of (fingerprint, variant) pairs, for tables in which some fingerprints are ambiguous."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                text = batch.column(1)[row].as_py() or ""
                cs = list(_chunks(text.encode())) or [None]  # the empty text: one part without a chunk
                n = len(cs)
                at = pa.array([row] * n)
                fps = pa.array([None if c is None else fingerprint(c, bits) for c in cs], pa.int64())
                sha = pa.array([hashlib.sha256(text.encode().lower()).hexdigest()] * n)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(2).take(at), sha, pa.array(range(n), pa.int64()), fps, pa.array(cs, pa.binary())], names=names)

    names = ["id", "text_key", "text_sha256", "i", "fp", "chunk"]
    parts = _inputs(docs, id_col, text_col).mapInArrow(run, _schema(docs, id_col, "i long, fp long, chunk binary"))
    # the rows of a document follow each other, so the number of its first one names it
    parts = written(parts.withColumn("doc_row", F.monotonically_increasing_id() - F.col("i")), "chunk-rows")
    chunk_id = F.struct("fp", F.coalesce("variant", F.lit(0).cast("long")).alias("variant"))
    named = parts.join(found, ["fp", "chunk"], "left").select("id", "text_key", "text_sha256", "doc_row", F.struct("i", chunk_id.alias("chunk_id")).alias("part"))
    recipe = F.transform(F.array_sort(F.collect_list("part")), lambda x: x["chunk_id"])
    return named.groupBy("doc_row", "id", "text_key", "text_sha256").agg(recipe.alias("recipe")).drop("doc_row")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 64) -> DataFrame:
    """One row a document: id, keep_id, group_size, kept, text_sha256, n_chunks.

    ``bits`` is the width of the fingerprints; results do not depend on it, since every fingerprint is verified.
    """
    rows, groups = _grouped(docs, id_col, text_col, bits)
    verdict = F.col("id").eqNullSafe(F.col("keep_id")).alias("kept")
    return given_verdicts(rows.drop("recipe"), groups, "recipe_key", "group_size").select(F.col("id").alias(id_col), "keep_id", "group_size", verdict, "text_sha256", "n_chunks")


def _grouped(docs: DataFrame, id_col: str, text_col: str, bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """Every row with its recipe, and one row a distinct recipe; both written."""
    chunks = distinct_chunks(docs, text_col, bits)
    several = written(ambiguous(chunks), "ambiguous-chunks")
    if several.isEmpty():
        rows = recipes(docs, id_col, text_col, bits)
    else:
        rows = _resolved(docs, written(variants(chunks, several), "chunk-variants"), id_col, text_col, bits)
    rows = rows.withColumns({"n_chunks": F.size("recipe"), "recipe_key": F.unhex(F.sha2(F.to_json(F.struct("recipe")), 256))})
    rows = written(rows, "recipes")
    if several.isEmpty():
        dropped(several)
    groups = rows.groupBy("recipe_key", "recipe").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")).drop("recipe")
    return rows, written(groups, "recipe-groups")


def distinct_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, one row of each group, in their own columns."""
    rows, groups = _grouped(docs, id_col, text_col)
    candidates = given_verdicts(rows.select("recipe_key", "id", "text_key"), groups, "recipe_key", "group_size").where(F.col("id").eqNullSafe(F.col("keep_id")))
    by_text = candidates.groupBy("recipe_key", "id", "text_key").agg(F.count(F.lit(1)).alias("n"))
    stay = by_text.groupBy("recipe_key").agg(F.min_by(F.struct("id", "text_key", "n"), "text_key").alias("s")).select("s.*")
    return picked(docs, written(stay, "staying"), id_col, text_col)
