"""Quality rules as a ledger of bitmasks.

Every rule is evaluated once for each document; the ledger keeps the measurements and one bit for each failed rule.
Policies are versioned masks over those bits, so that another policy, or the ablation of a rule, costs a bitwise
operation over the ledger and never a second look at the texts.

Cases: a null text counts as no words (it fails ``few_words``); an empty text likewise; texts of any length are measured
whole; repeated rows give repeated rows; an empty table gives an empty ledger; only the named columns are read, so
further columns of any name do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SPACE, as_struct

SYMBOLS = b"#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letter_words")
_LETTERS = bytes(c for c in range(256) if chr(c).isascii() and chr(c).isalpha() or c >= 0x80)
_OTHERS = bytes(c for c in range(256) if c not in _LETTERS and c not in SPACE)


@dataclass(frozen=True)
class Rule:
    bit: int
    name: str
    fails: str  # a predicate over the measurements, valid as Spark SQL and as DuckDB SQL


#: A bit keeps its meaning for ever; new rules get new bits.
RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > n_words"),
    Rule(3, "short_words", "word_chars < 3 * n_words"),
    Rule(4, "long_words", "word_chars > 10 * n_words"),
    Rule(5, "many_words", "n_words > 100000"),
    Rule(6, "repeated_lines", "100 * n_dup_lines > 60 * n_lines"),
    Rule(7, "no_letters", "100 * n_letter_words < 70 * n_words"),
)


def mask(*names: str) -> int:
    return sum(1 << r.bit for r in RULES if r.name in names)


BASE = mask("few_words", "repeated_words")
#: Policies by version: the rules that reject.
#: web-1 rejects long texts for their length alone; web-2 keeps them, and many_words stays in the ledger as a measurement;
#: web-3 keeps short texts too, which are clean as often as others.
WEB_1 = mask(*(r.name for r in RULES))
POLICIES = {"base-1": BASE, "web-1": WEB_1, "web-1-lenient": BASE | mask("symbols"), "web-2": WEB_1 & ~mask("many_words"), "web-3": WEB_1 & ~mask("many_words", "few_words")}


def _repeat_words(words: list[bytes]) -> int:
    """Words within windows of three that occur twice or more."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    code = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    base = len(ids)
    if base < 2_000_000:
        key = (code[:-2] * base + code[1:-1]) * base + code[2:]
    else:  # two steps, so that the key stays within 64 bits
        pair = np.unique(code[:-1] * base + code[1:], return_inverse=True)[1]
        key = pair[:-1] * base + code[2:]
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    covered[:-2] |= twice
    covered[1:-1] |= twice
    covered[2:] |= twice
    return int(covered.sum())


def measured(text: bytes | None) -> tuple[int, ...]:
    """MEASURES of a UTF-8 text."""
    if not text:
        return (0,) * len(MEASURES)
    words = text.split()
    packed = text.translate(None, SPACE)
    chars = len(packed) if packed.isascii() else len(packed.decode("utf-8", "replace"))
    symbols = len(packed) - len(packed.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip(SPACE)]
    letters = len(text.translate(None, _OTHERS).split())
    return len(words), chars, symbols, len(lines) - len(set(lines)), _repeat_words(words), len(lines), letters


def _measure_batch(column: pa.Array) -> list[pa.Array]:
    rows = np.array([measured(x.as_py()) for x in column.cast(pa.binary())], np.int64).reshape(-1, len(MEASURES))
    return [pa.array(rows[:, i]) for i in range(len(MEASURES))]


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: the id, MEASURES, and ``fail_bits`` with the bit of each rule that it fails."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), *_measure_batch(batch.column(1))], names=names)

    names = [id_col, *MEASURES]
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), *(T.StructField(m, T.LongType()) for m in MEASURES)])
    measures = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text")).mapInArrow(run, schema)
    return measures.withColumn("fail_bits", fail_bits())


def fail_bits() -> Column:
    bits = [F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long") for r in RULES]
    return sum(bits[1:], bits[0])


def passes(policy: str | int, bits: str = "fail_bits") -> Column:
    """True where no rule of the policy failed."""
    return F.col(bits).bitwiseAND(F.lit(POLICIES.get(policy, policy)).cast("long")) == 0


def ablations(kept: DataFrame, policy: str) -> DataFrame:
    """For each rule of a policy: rows it rejects, rows that only it rejects, rows kept without it.

    The ledger is first reduced to its distinct bit patterns, 2 to the number of rules at most.
    """
    of = POLICIES[policy]
    rules = [r for r in RULES if of >> r.bit & 1]
    pattern = F.col("fail_bits").bitwiseAND(F.lit(of).cast("long"))
    patterns = kept.groupBy(pattern.alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    rule = F.explode(F.array(*(F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit")) for r in rules))).alias("r")
    hit = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    only = F.col("bits") == F.col("r.bit")
    total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).alias
    return (
        patterns.select("bits", "n", rule)
        .groupBy(F.lit(policy).alias("policy"), F.col("r.rule").alias("rule"))
        .agg(total(hit)("rejected"), total(only)("rejected_alone"), total((F.col("bits") == 0) | only)("kept_without"))
    )


def kept_documents(docs: DataFrame, policy: str = "web-3", text_col: str = "text") -> DataFrame:
    """The documents that a policy keeps, in their own columns, without a shuffle: measured, given their bits, filtered."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0)
            yield pa.RecordBatch.from_arrays([rows, *_measure_batch(rows.field(at))], names=["doc", *MEASURES])

    whole = docs.select(as_struct(docs).alias("doc"))
    schema = T.StructType([whole.schema["doc"], *(T.StructField(m, T.LongType()) for m in MEASURES)])
    measured_rows = whole.mapInArrow(run, schema).withColumn("fail_bits", fail_bits())
    return measured_rows.where(passes(policy)).select("doc.*")
