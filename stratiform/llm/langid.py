"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built over a bounded sample of labelled texts. A text is parsed greedily against
each automaton: the longest match that occurs in that language's sample is a phrase, and the next one starts where it
ends; a letter that the sample lacks is a phrase of its own and counts twice, once for being new. The language that needs the fewest phrases for a letter,
normalised by the logarithm of its sample's length (as in the estimate phrases * log(sample) / letters of the cross
entropy), wins.

Texts are case-folded, and all but letters and their marks become single spaces. Every letter of the samples is told apart,
whatever its script: transitions lie in two arrays (base and check, as in a double-array trie), whose size follows the
samples and not the alphabet.

Texts are parsed in blocks of BLOCK characters, all blocks of a slice at once. Each block is parsed as if a phrase began
with it; then each is entered again in the state that its predecessor left, until both parses begin a phrase at the same
place, from where on they agree. So the counts are those of one parse of the whole text, and memory stays bounded for texts
of any length.

Bounds, which are parameters: every label is learnt; a sample has at most DOCS_PER_LANGUAGE labelled rows a language, chosen
by hash, whole or, of rows longer than TRAIN_ROW_CHARS characters, a passage of that length at a hashed place; with so many
labels that this would exceed SAMPLE_CHARS in all, passages are shorter in proportion.

Cases: a null text, or one without a letter, is ``und`` with score 0; of languages whose parses are equally long the first by
name wins, with the score shared among them; without labelled rows every text is; labels of
null are not learnt from; rows alike in id, text and label are learnt once, and rows without an id are told apart by their
texts; repeated rows are treated alike; an empty table gives an empty result; only the named columns are read, further
ones may have any name, and nothing but the text enters a prediction.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

BLOCK = 512
DOCS_PER_LANGUAGE, TRAIN_ROW_CHARS, SAMPLE_CHARS = 20, 4000, 2_000_000
#: Parses (blocks times languages) that advance together.
PARSES_AT_ONCE = 1 << 14
_NOT_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")
_LETTER = regex.compile(r"\p{L}")


def folded(text: str | None) -> str:
    """Letters in lower case, words apart by single spaces; empty without a letter."""
    out = _NOT_LETTERS.sub(" ", (text or "").lower()).strip()
    return out if _LETTER.search(out) else ""


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """The transitions {code: state} of the automaton of all substrings; state 0 is the start and nothing leads to it."""
    nexts, link, length, last = [{}], [-1], [0], 0
    for c in codes:
        cur = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in nexts[p]:
            nexts[p][c] = cur
            p = link[p]
        if p != -1:
            q = nexts[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nexts)
                nexts.append(dict(nexts[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and nexts[p].get(c) == q:
                    nexts[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return nexts


def packed(moves: list[dict[int, int]], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(base, check, target): where base b stands for a state, its move by code c is to target[b + c] if check[b + c] == b.

    States are known by their bases, which are all different, and targets are bases too. States with several moves are
    placed first, wherever all of them find a free place; those with one fill the gaps.
    """
    n = len(moves)
    base, taken = [0] * n, set()
    used = bytearray(2 * (sum(map(len, moves)) + 2 * width + 64))
    hints: dict[int, int] = {}
    for s in sorted((s for s in range(n) if len(moves[s]) > 1), key=lambda s: -len(moves[s])):
        codes = sorted(moves[s])
        first, rest = codes[0], codes[1:]
        at, tries = hints.get(len(codes), width), 0
        while True:
            if at + width >= len(used):
                used.extend(bytes(len(used)))
            at = used.find(0, at)
            b = at - first
            if b not in taken and at + width < len(used) and not any(used[b + c] for c in rest):
                break
            at, tries = at + 1, tries + 1
        if tries > 16:  # gaps that many have tried are left to states with fewer moves
            hints[len(codes)] = at
        base[s] = b
        taken.add(b)
        for c in codes:
            used[b + c] = 1
    free = width
    for s in range(n):
        if len(moves[s]) == 1:
            (c,) = moves[s]
            at = free
            while used[at] or at - c in taken:
                at += 1
            free = at + 1
            base[s] = at - c
            taken.add(base[s])
            used[at] = 1
            if free + 64 * width > len(used):
                used.extend(bytes(len(used)))
    spare = max(taken, default=0) + 1
    for s in range(n):
        if not moves[s]:
            base[s], spare = spare, spare + 1
    check, target = np.full(max(base, default=0) + width + 1, -1, np.int64), np.zeros(max(base, default=0) + width + 1, np.int64)
    for s in range(n):
        for c, to in moves[s].items():
            check[base[s] + c], target[base[s] + c] = base[s], base[to]
    return np.array(base, np.int64), check, target


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    letters: np.ndarray  # code points in order; the one at i has the code i + 1, any other character the code 0
    check: np.ndarray  # the moves of all automata
    target: np.ndarray
    roots: np.ndarray
    first: np.ndarray  # [language, code]: the state after a phrase's first letter; the root where the sample lacks it
    logs: np.ndarray  # of the samples' lengths

    def encode(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
        at = np.searchsorted(self.letters, points).clip(0, len(self.letters) - 1)
        return np.where(self.letters[at] == points, at + 1, 0)

    def _step(self, state: np.ndarray, code: np.ndarray, lang: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next states, and where a phrase begins; flat arrays of one length."""
        at = state + code
        begins = self.check.take(at) != state
        to = self.target.take(at)
        new = np.flatnonzero(begins)
        to[new] = self.first.take(lang[new] * self.first.shape[1] + code[new])
        begins |= state == self.roots.take(lang)
        return to, begins

    def phrases(self, texts: list[str]) -> np.ndarray:
        """[text, language]: how many phrases each text needs."""
        total = np.zeros((len(texts), len(self.languages)), np.int64)
        room = max(1, PARSES_AT_ONCE // len(self.languages))
        blocks: list[tuple[int, np.ndarray]] = []
        carry = None  # the states in which the last block of a slice ends, where its text goes on
        lacking = (self.first == self.roots[:, None]).T.astype(np.int64)  # [code, language]
        for i, text in enumerate(texts):
            codes = self.encode(text)
            total[i] = np.bincount(codes, minlength=len(lacking)) @ lacking
            for k in range(0, len(codes), BLOCK):
                blocks.append((i, codes[k : k + BLOCK]))
                if len(blocks) == room:
                    ends = self._parsed(blocks, total, carry)
                    carry, blocks = (ends if k + BLOCK < len(codes) else None), []
        if blocks:
            self._parsed(blocks, total, carry)
        return total

    def _parsed(self, blocks: list[tuple[int, np.ndarray]], total: np.ndarray, carry: np.ndarray | None) -> np.ndarray:
        """Adds the phrases of a slice of blocks; returns the states after its last block."""
        owner, lengths = np.array([i for i, _ in blocks]), np.array([len(b) for _, b in blocks])
        order = np.argsort(-lengths, kind="stable")
        place = np.argsort(order)  # of each block in the grid, whose longest block is the first
        steps, n, langs = lengths.max(), len(blocks), len(self.languages)
        grid = np.zeros((steps, n), np.int64)
        for j, k in enumerate(order):
            grid[: lengths[k], j] = blocks[k][1]
        alive = np.searchsorted(-lengths[order], -np.arange(steps), side="left")  # blocks that reach each position
        lang = np.tile(np.arange(langs), n)
        state, begins = self.roots.take(lang), np.zeros((steps, n * langs), bool)
        for step in range(steps):
            m = alive[step] * langs
            state[:m], begins[step, :m] = self._step(state[:m], np.repeat(grid[step, : alive[step]], langs), lang[:m])
        ends, counts = state.reshape(n, langs)[place], begins.sum(0).reshape(n, langs)[place]
        begins = begins.reshape(steps, n, langs)
        follows = np.concatenate([[carry is not None], owner[1:] == owner[:-1]])
        entry = np.concatenate([self.roots[None, :] if carry is None else carry[None, :], ends[:-1]])
        dirty = np.repeat(follows[:, None], langs, 1)
        plain, true_ends = counts.copy(), ends.copy()
        while dirty.any():
            block, of = np.nonzero(dirty)
            found, last = self._entered(block, of, entry[block, of], grid, place, lengths, begins, plain, ends)
            counts[block, of] = found
            moved = true_ends[block, of] != last
            true_ends[block, of] = last
            dirty = np.zeros_like(dirty)
            block, of = block[moved] + 1, of[moved]
            block, of = block[block < n], of[block < n]
            dirty[block, of] = follows[block]
            entry[block, of] = true_ends[block - 1, of]
        np.add.at(total, owner, counts)
        return true_ends[-1]

    def _entered(self, block, lang, state, grid, place, lengths, begins, plain, ends) -> tuple[np.ndarray, np.ndarray]:
        """Phrases that begin in blocks entered in given states, and the states after them."""
        found, last, all_plain = np.zeros(len(lang), np.int64), ends[block, lang].copy(), plain[block, lang]
        before = np.zeros(len(lang), np.int64)  # phrases of the plain parse before both meet
        at = np.arange(len(lang))
        for step in range(grid.shape[0]):
            over = lengths[block[at]] <= step
            if over.any():  # never met: the block's end is this parse's
                last[at[over]], before[at[over]] = state[over], all_plain[at[over]]
                at, state = at[~over], state[~over]
            if not len(at):
                return found + all_plain - before, last
            to, start = self._step(state, grid[step, place[block[at]]], lang[at])
            theirs = begins[step, place[block[at]], lang[at]]
            going = ~(start & theirs)
            at, state = at[going], to[going]
            found[at] += start[going]
            before[at] += theirs[going]
        last[at], before[at] = state, all_plain[at]
        return found + all_plain - before, last

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        clean = [folded(t) for t in texts]
        if not self.languages:
            return [("und", 0.0)] * len(texts)
        needed = self.phrases(clean) * self.logs
        out = []
        for text, row in zip(clean, needed, strict=True):
            if not text:
                out.append(("und", 0.0))
                continue
            best = int(np.argmin(row))
            per_letter = (row - row[best]) / len(text)
            out.append((self.languages[best], float(1 / np.exp(-4.0 * per_letter).sum())))
        return out


def fit(rows: list[tuple[str, str]]) -> Model:
    """From (language, text); the texts of a language are joined by spaces in their order."""
    samples: dict[str, list[str]] = {}
    for lang, text in rows:
        samples.setdefault(lang, []).append(folded(text))
    joined = {lang: " ".join(filter(None, parts)) for lang, parts in sorted(samples.items())}
    joined = {lang: s for lang, s in joined.items() if s}
    letters = np.array(sorted({ord(c) for s in joined.values() for c in s}), np.uint32)
    code = {chr(c): i + 1 for i, c in enumerate(letters.tolist())}
    moves, roots = [], []
    for s in joined.values():
        root = len(moves)
        roots.append(root)
        moves += [{c: to + root for c, to in m.items()} for m in suffix_automaton([code[c] for c in s])]
    width = len(letters) + 1
    base, check, target = packed(moves, width)
    first = np.array([[base[moves[r].get(c, r)] for c in range(width)] for r in roots], np.int64).reshape(len(roots), width)
    return Model(tuple(joined), letters, check, target, base[roots] if roots else base[:0], first, np.array([np.log(max(len(s), 2)) for s in joined.values()]))


def training_rows(labelled: DataFrame, id_col: str, text_col: str, lang_col: str, docs_per_language: int = DOCS_PER_LANGUAGE, row_chars: int = TRAIN_ROW_CHARS) -> list[tuple[str, str]]:
    """(language, text) of at most docs_per_language rows of each language, chosen by hash; passages of longer texts."""
    have = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    have = have.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    have = have.withColumn("place", F.pmod(F.xxhash64("id", "text"), F.lit(1 << 40)))
    counts = have.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))
    labels = counts.count()
    if not labels:
        return []
    most = max(1, min(row_chars, SAMPLE_CHARS // (labels * docs_per_language)))
    # twice as many rows as asked for lie below each language's limit, so hardly ever too few do
    limit = (1 << 40) * F.least(F.lit(1.0), (2 * docs_per_language + 20) / F.col("rows"))
    start = F.pmod(F.xxhash64("place"), F.greatest(F.char_length("text") - most + 1, F.lit(1))).cast("int")
    picked = have.join(F.broadcast(counts), "lang").where(F.col("place") < limit)  # a row a label: the model holds one each as well
    picked = picked.dropDuplicates(["id", "text", "lang"]).select("lang", "place", F.substring("text", start + 1, F.lit(most)).alias("text"))
    ranked = picked.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy("place", "text"))).where(F.col("rank") <= docs_per_language)
    return [(r["lang"], r["text"]) for r in ranked.select("lang", "text", "rank").orderBy("lang", "rank").collect()]


def identified(docs: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, lang_pred and score of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.predict(batch.column(len(keep)).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array([x for x, _ in found], pa.string()), pa.array([y for _, y in found], pa.float64())], names=[*keep, "lang_pred", "score"])

    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.select(*keep, F.col(text_col).cast("string").alias("__text")).mapInArrow(run, schema)


def held_out(doc_id: object) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 4 == 2
