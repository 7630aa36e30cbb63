"""Spelling variants by errata-trie merging: pairs of words one edit apart, found along a heavy-path decomposition.

Words are the terminals of a trie whose nodes are their prefixes. Each node's heavy child is the one with most words below
it (least code point on ties); a word leaves a heavy path at most log2(words) times, and only there, from the light side, is
it moved: its remainder below the node is merged into the node's other subtrees with one character replaced by the heavy one,
skipped, or the heavy one put before it. Where a moved terminal coincides with a word, the two are one edit apart; where
moved terminals of several light subtrees coincide, they differ in the replaced character. Each pair is found once, at the
node where its words part. Nodes and moved terminals are rows, so a merge is a join on the terminal, and none is larger than
the alphabet.

Cases: null and empty texts have no words; a null id is read as empty in the hash that plants the errors; repeated rows
count again; of near words with equal counts the first in code-point order is the form; words of one tree may be of any
length; texts are read whole, in pieces; only the two named columns are read. Empty tables give an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import dropped, written

#: Runs of A-Z, a-z and U+00C0 to U+00FF in lower-cased UTF-8, where the latter are 0xC3 and one further byte.
RUN = re.compile(rb"(?:[a-z]+|\xc3[\x80-\xbf])+")
BREAK = re.compile(rb"[\x00-\x40\x5b-\x60]")
ERROR_EVERY, LEAST_LENGTH, LEAST_COUNT, RATIO = 97, 5, 3, 2
#: Bytes of a text read at a time, and distinct words that a task counts before it hands them on.
PIECE, HELD = 1 << 20, 200_000


def pieces(text: bytes) -> Iterator[bytes]:
    """The text in pieces of about PIECE bytes, cut where no run can go on."""
    at = 0
    while at < len(text):
        cut = BREAK.search(text, at + PIECE) if at + PIECE < len(text) else None
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


def misspelt(doc_id: bytes, run: bytes, every: int = ERROR_EVERY) -> bytes:
    """The run as the document has it: where its hash says so, a character is missing."""
    h = zlib.crc32(run, zlib.crc32(doc_id + b":"))
    if h % every:
        return run
    letters = run.decode()
    at = h % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode()


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): the words of all texts with planted errors; counted in each task before the shuffle."""

    def handed_on(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                runs: Counter[bytes] = Counter()
                for piece in pieces((text.as_py() or b"").lower()):
                    runs.update(RUN.findall(piece))
                for r, n in runs.items():
                    word = misspelt(doc_id.encode(), r)
                    if len(word) >= least_length and len(word) - word.count(b"\xc3") >= least_length:
                        counts[word] += n
                if len(counts) >= HELD:
                    yield handed_on(counts)
                    counts.clear()
        if counts:
            yield handed_on(counts)

    texts = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _front(text: str | Column, length: int | Column) -> Column:
    return F.substring(text, F.lit(1), length)


def _from(text: str | Column, start: int | Column) -> Column:
    """What follows the first ``start`` characters."""
    return F.substring(text, start + 1, F.char_length(text))


def heavy_children(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, parent, heavy) of the light nodes, and (parent, heavy) of all nodes with children."""
    every = words.select("word", F.explode(F.sequence(F.lit(1), F.char_length("word"))).alias("d")).select(_front("word", F.col("d")).alias("node"), "d")
    nodes = every.groupBy("node", "d").agg(F.count(F.lit(1)).alias("m")).select("node", _front("node", F.col("d") - 1).alias("parent"), _from("node", F.col("d") - 1).alias("edge"), "m")
    nodes = written(nodes, "trie-nodes")
    heavy = written(nodes.groupBy("parent").agg(F.min_by("edge", F.struct(-F.col("m"), "edge")).alias("heavy")), "heavy-children")
    light = written(nodes.join(heavy, "parent").where("edge <> heavy").select("node", "parent", "heavy"), "light-nodes")
    dropped(nodes)
    return light, heavy


def moved_terminals(words: DataFrame) -> DataFrame:
    """(x, d, kind, word, n): each word's terminals after its light subtrees are merged; ``d`` is the node's depth."""
    light, heavy = heavy_children(words)
    prefixes = words.select("word", "n", F.explode(F.sequence(F.lit(1), F.char_length("word"))).alias("k")).withColumn("node", _front("word", F.col("k")))
    leaves = prefixes.join(light, "node").select("word", "n", (F.col("k") - 1).alias("d"), "parent", "heavy")
    own, after = _from(_front("word", F.col("d") + 1), F.col("d")), _from("word", F.col("d") + 1)
    skipped = F.when(_front(after, 1) != own, F.concat("parent", after))  # where the next character is the same, the words part later
    ways = F.array(
        F.struct(F.lit("replaced").alias("kind"), F.concat("parent", "heavy", after).alias("x")),
        F.struct(F.lit("skipped").alias("kind"), skipped.alias("x")),
        F.struct(F.lit("before").alias("kind"), F.concat("parent", "heavy", _from("word", F.col("d"))).alias("x")),
    )
    moved = leaves.select("word", "n", "d", F.explode(ways).alias("w")).select(F.col("w.x").alias("x"), "d", F.col("w.kind").alias("kind"), "word", "n").where("x IS NOT NULL")
    ends = words.join(heavy.withColumnRenamed("parent", "word"), "word")
    ends = ends.select(F.concat("word", "heavy").alias("x"), F.char_length("word").alias("d"), F.lit("before").alias("kind"), "word", "n")
    out = written(moved.unionByName(ends), "moved-terminals")
    dropped(light, heavy)
    return out


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best): how many words are one edit away, and the most frequent of them as struct(less, word)."""
    moved = moved_terminals(words)
    met = written(moved.join(words.select(F.col("word").alias("x"), F.col("n").alias("m")), "x").select("x", "m", "word", "n"), "coinciding-terminals")
    rank = lambda n, w: F.struct((-F.col(n)).alias("less"), F.col(w).alias("word"))
    one = F.lit(1).cast("long")
    there = met.select("word", one.alias("k"), rank("m", "x").alias("best"))
    back = met.select(F.col("x").alias("word"), one.alias("k"), rank("n", "word").alias("best"))
    # Light subtrees of one node: at most as many members as the alphabet has characters.
    light = moved.where("kind = 'replaced'").groupBy("x", "d").agg(F.array_sort(F.collect_list(rank("n", "word"))).alias("all")).where(F.size("all") > 1)
    mates = light.select((F.size("all") - 1).cast("long").alias("k"), F.get("all", F.lit(0)).alias("first"), F.get("all", F.lit(1)).alias("second"), F.explode("all").alias("one"))
    mates = mates.select("one.word", "k", F.when(F.col("one.word") == F.col("first.word"), F.col("second")).otherwise(F.col("first")).alias("best"))
    return there.unionByName(back).unionByName(mates).groupBy("word").agg(F.sum("k").alias("n_near"), F.min("best").alias("best"))


def rooted(links: DataFrame) -> DataFrame:
    """(word, root) of links (word, form) without cycles: pointers are doubled until none moves."""
    ways = written(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = written(ways.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        dropped(ways)
        ways = moved
        if ways.where("moved").isEmpty():
            return ways.select("word", "root")


def grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ratio: int = RATIO) -> DataFrame:
    """One row a word: word, form, root, n, n_near, form_n.

    A word's form is its most frequent near word if that has at least ``ratio`` times its count; counts rise along forms, so
    following them ends.
    """
    words = written(word_counts(docs, id_col, text_col), "words")
    near = near_words(words)
    form = (-F.col("best.less") >= ratio * F.col("n")) & F.col("best").isNotNull()
    rows = words.join(near, "word", "left").select("word", F.when(form, F.col("best.word")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(form, -F.col("best.less")).alias("form_n"))
    rows = written(rows, "word-forms")
    roots = rooted(rows.where("form IS NOT NULL"))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
