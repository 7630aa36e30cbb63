"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces with log scores.

Pieces come from a SentencePiece model file, whose protocol buffer is read here. Files of BPE models hold ranks instead
of log probabilities; for them a piece of rank r scores as Zipf's law has it, -log(r + ZIPF_SHIFT). A text is prefixed with
one marker and its spaces become markers; the segmentation with the greatest sum of scores wins (of equal sums the one whose last
piece is longest); characters that no piece covers fall back to their bytes, and so does a marker that stands in the text
itself. Decoding reverses all of it, so decode(encode(text)) is the text.

A text breaks wherever its two neighbouring characters stand side by side in no piece, as any segmentation does; so a best
segmentation is one of each run between such breaks. Characters that pieces join, directly or through others, are one class; a
run is one of a class with the markers before it. The runs that a slice of rows has and the cache of about CACHE runs lacks are
segmented together, all runs of a chunk one character further at each step; runs longer than LONG alone.

Cases: a null text gives null ids, an empty one no ids; texts of any length are encoded whole, run by run; a run
longer than LONG_WORD characters stays outside the cache; repeated rows are encoded alike; an empty table
gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import pickle
import re
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARKER = "▁"
#: Stands for a marker of the text itself while it is segmented; no text can hold it, and no piece does.
LITERAL = "\ud800"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
ZIPF_SHIFT = 2.7
BYTE_SCORE_GAP = 10.0
CACHE, LONG_WORD = 200_000, 4096
#: Runs up to so many characters are segmented together, in chunks of so many runs.
LONG, CHUNK = 64, 4096
SEARCH = 512
#: Rows, and bytes of text (but for a single longer text), that a worker holds as Python objects at a time.
SLICE, SLICE_BYTES = 256, 4 << 20
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of a protocol buffer message."""
    at, n = 0, len(data)

    def varint() -> int:
        nonlocal at
        value, shift = 0, 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            if b < 128:
                return value
            shift += 7

    while at < n:
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        elif kind == 2:
            size = varint()
            yield key >> 3, data[at : at + size]
            at += size
        else:
            size = 8 if kind == 1 else 4
            yield key >> 3, data[at : at + size]
            at += size


@dataclass(frozen=True)
class Vocabulary:
    pieces: tuple[str, ...]
    scores: tuple[float, ...]  # log scores
    kinds: tuple[int, ...]

    @classmethod
    def from_model(cls, data: bytes) -> Vocabulary:
        pieces, scores, kinds, model = [], [], [], UNIGRAM
        for number, value in _fields(data):
            if number == 1:
                piece, score, kind = "", 0.0, NORMAL
                for k, v in _fields(value):
                    if k == 1:
                        piece = v.decode()
                    elif k == 2:
                        score = struct.unpack("<f", v)[0]
                    elif k == 3:
                        kind = v
                pieces.append(piece)
                scores.append(score)
                kinds.append(kind)
            elif number == 2:
                model = next((v for k, v in _fields(value) if k == 3), UNIGRAM)
        if model == BPE:
            scores = [-math.log(-s + ZIPF_SHIFT) for s in scores]
        return cls(tuple(pieces), tuple(scores), tuple(kinds))

    @classmethod
    def load(cls, path: str = MODEL_PATH) -> Vocabulary:
        with open(path, "rb") as f:
            return cls.from_model(f.read())


class DoubleArray:
    """A trie of strings as two arrays: the child of node s by code c is t = base[s] + c where check[t] == s."""

    def __init__(self, entries: dict[str, int]):
        chars = sorted({c for key in entries for c in key})
        self.codes = {c: i + 1 for i, c in enumerate(chars)}
        width = len(chars) + 1
        children: list[dict[int, int]] = [{}]
        values = [-1]
        for key, value in sorted(entries.items()):
            node = 0
            for c in key:
                code = self.codes[c]
                if code not in children[node]:
                    children[node][code] = len(children)
                    children.append({})
                    values.append(-1)
                node = children[node][code]
            values[node] = value
        size = 1 << max(8, (2 * len(children) + width).bit_length())
        base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        place, used, hints = [0] * len(children), np.zeros(size, bool), {}
        used[0], value[0], low = True, values[0], 1
        queue = [0]
        while queue:
            node = queue.pop()
            kids = sorted(children[node])
            if not kids:
                continue
            while used[low]:
                low += 1
            offsets, at, start = np.array(kids), max(low, hints.get(min(len(kids), 8), 0)), -1
            while start < 0:  # the first free places at which all children fit
                if at + SEARCH + width >= len(used):
                    grow = len(used)
                    base, value = np.concatenate([base, np.zeros(grow, np.int32)]), np.concatenate([value, np.full(grow, -1, np.int32)])
                    check, used = np.concatenate([check, np.full(grow, -1, np.int32)]), np.concatenate([used, np.zeros(grow, bool)])
                tries = np.flatnonzero(~used[at : at + SEARCH]) + at - kids[0]
                fits = tries[(tries > 0) & ~used[np.maximum(tries, 0)[:, None] + offsets].any(1)]
                start = int(fits[0]) if len(fits) else -1
                hints[min(len(kids), 8)] = at
                at += SEARCH
            base[place[node]] = start
            for code in kids:
                t = start + code
                used[t], check[t] = True, place[node]
                place[children[node][code]] = t
                value[t] = values[children[node][code]]
                queue.append(children[node][code])
        end = int(np.flatnonzero(used)[-1]) + width + 1
        self.base, self.check, self.value = base[:end].copy(), check[:end].copy(), value[:end].copy()

    def prefixes(self, codes: list[int], start: int) -> Iterator[tuple[int, int]]:
        """(end, value) of every entry that begins at start, the shortest first."""
        base, check, value, s = self.base, self.check, self.value, 0
        for i in range(start, len(codes)):
            t = base[s] + codes[i]
            if codes[i] == 0 or t >= len(check) or check[t] != s:
                return
            s = t
            if value[s] >= 0:
                yield i + 1, value[s]


def classes_of(pieces: list[str]) -> list[str]:
    """Sets of characters that the pieces join, markers aside, each as one string."""
    up: dict[str, str] = {}

    def find(c: str) -> str:
        while up.setdefault(c, c) != c:
            c = up[c]
        return c

    for piece in pieces:
        if len(piece) > 1:
            inner = piece.lstrip(MARKER)
            for c in inner:
                up[find(c)] = find(inner[0])
    classes: dict[str, str] = {}
    for c in sorted(up):
        classes[find(c)] = classes.get(find(c), "") + c
    return sorted(classes.values())


@dataclass
class Tokenizer:
    vocabulary: Vocabulary
    trie: DoubleArray = field(init=False)
    cache: dict[str, tuple[int, ...]] = field(init=False, default_factory=dict)

    def __post_init__(self) -> None:
        v = self.vocabulary
        entries = {p: i for i, (p, k) in enumerate(zip(v.pieces, v.kinds, strict=True)) if k in (NORMAL, USER_DEFINED) and p}
        inner = [p for p in entries if MARKER in p.lstrip(MARKER)]
        if inner:
            raise ValueError(f"a piece goes on with a marker after another character: {inner[0]!r}")
        self.trie = DoubleArray(entries)
        self.bytes_ = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(v.pieces, v.kinds, strict=True)) if k == BYTE}
        self.unknown = next((i for i, k in enumerate(v.kinds) if k == UNKNOWN), 0)
        self.byte_score = min(v.scores[i] for i in entries.values()) - BYTE_SCORE_GAP
        self.raw = [bytes([int(p[3:5], 16)]) if k == BYTE else b"" if k in (CONTROL, UNKNOWN) else p.replace(MARKER, " ").encode() for p, k in zip(v.pieces, v.kinds, strict=True)]
        runs = "|".join(f"[{re.escape(c)}]+" for c in classes_of(list(entries)))
        self.run = re.compile(f"{MARKER}*(?:{runs})|{MARKER}+|[^{MARKER}]" if runs else f"{MARKER}+|[^{MARKER}]", re.DOTALL)
        self.code_of = np.zeros(0x110000, np.int16 if len(self.trie.codes) < 1 << 15 else np.int32)
        for c, code in self.trie.codes.items():
            self.code_of[ord(c)] = code
        self.scores = np.array(v.scores, np.float64)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"cache": {}}

    def _traced(self, run: str, back: list[int], piece: list[int]) -> tuple[int, ...]:
        out, n = [], len(run)
        while n:
            if piece[n] >= 0:
                out.append(piece[n])
            else:
                out += [self.bytes_.get(b, self.unknown) for b in reversed(run[back[n] : n].replace(LITERAL, MARKER).encode("utf-8", "surrogatepass"))]
            n = back[n]
        return tuple(reversed(out))

    def segment(self, run: str) -> tuple[int, ...]:
        """Viterbi over one run of characters."""
        find, codes_of, scores = self.trie, self.trie.codes, self.vocabulary.scores
        base, check, value, limit = find.base, find.check, find.value, len(find.check)
        codes = [codes_of.get(c, 0) for c in run]
        n = len(codes)
        best, back, piece = [-math.inf] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        for i in range(n):
            here = best[i]
            s, j, covered = 0, i, False
            while j < n:
                c = codes[j]
                t = base[s] + c
                if not c or t >= limit or check[t] != s:
                    break
                s = int(t)
                j += 1
                v = int(value[s])
                if v >= 0:
                    covered = covered or j == i + 1
                    score = here + scores[v]
                    if score > best[j]:
                        best[j], back[j], piece[j] = score, i, v
            if not covered:
                score = here + self.byte_score
                if score > best[i + 1]:
                    best[i + 1], back[i + 1], piece[i + 1] = score, i, -1
        return self._traced(run, back, piece)

    def segment_chunk(self, runs: list[str]) -> list[tuple[int, ...]]:
        """The same over many runs, sorted by length, in step."""
        base, check, value, limit = self.trie.base, self.trie.check, self.trie.value, len(self.trie.check)
        lengths = np.fromiter(map(len, runs), np.int64, len(runs))
        width = int(lengths[-1])
        codes = np.zeros((len(runs), width + 1), np.int32)
        codes[np.arange(width + 1) < lengths[:, None]] = self.code_of[np.frombuffer("".join(runs).encode("utf-32-le", "surrogatepass"), np.uint32)]
        best = np.full((len(runs), width + 1), -np.inf)
        back, piece = np.zeros(best.shape, np.int32), np.full(best.shape, -1, np.int32)
        best[:, 0] = 0.0

        def offer(rows: np.ndarray, i: int, j: int, score: np.ndarray, v: np.ndarray | int) -> None:
            better = score > best[rows, j]
            rows = rows[better]
            best[rows, j], back[rows, j] = score[better], i
            piece[rows, j] = v if isinstance(v, int) else v[better]

        for i in range(width):
            rows = np.arange(np.searchsorted(lengths, i, side="right"), len(runs))
            covered = np.zeros(len(runs), bool)
            at, s, j = rows, np.zeros(len(rows), np.int32), i
            while len(at):
                c = codes[at, j]
                t = base[s] + c
                t[(c == 0) | (t >= limit)] = 0
                ok = check[t] == s
                at, s, j = at[ok], t[ok], j + 1
                v = value[s]
                hit = v >= 0
                if hit.any():
                    found, v = at[hit], v[hit]
                    if j == i + 1:
                        covered[found] = True
                    offer(found, i, j, best[found, i] + self.scores[v], v)
            bare = rows[~covered[rows]]
            offer(bare, i, i + 1, best[bare, i] + self.byte_score, -1)
        return [self._traced(r, b, p) for r, b, p in zip(runs, back.tolist(), piece.tolist(), strict=True)]

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        split = [self.run.findall(MARKER + x.replace(MARKER, LITERAL).replace(" ", MARKER)) if x else [] for x in texts]
        seen = set().union(*split)
        if len(self.cache) > CACHE:  # what this slice uses stays
            self.cache = {r: self.cache[r] for r in seen & self.cache.keys()}
        cache, new = self.cache, sorted(seen - self.cache.keys(), key=len)
        short = [r for r in new if len(r) <= LONG]
        for k in range(0, len(short), CHUNK):
            chunk = short[k : k + CHUNK]
            cache.update(zip(chunk, self.segment_chunk(chunk), strict=True))
        for r in new[len(short) :]:
            cache[r] = self.segment(r)
        out = [np.fromiter(itertools.chain.from_iterable(map(cache.__getitem__, runs)), np.int32) for runs in split]
        for r in reversed(new):
            if len(r) <= LONG_WORD:
                break
            del cache[r]
        return out

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0].tolist()

    def decode(self, ids: list[int]) -> str:
        data = b"".join(map(self.raw.__getitem__, ids))
        return (data[1:] if data[:1] == b" " else data).decode("utf-8", "replace")


def _slices(batches: Iterator[pa.RecordBatch], size_of: Callable[[pa.RecordBatch], np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Slices of SLICE rows and SLICE_BYTES at most; size_of gives the bytes of each row."""
    for batch in batches:
        ends, k = np.cumsum(size_of(batch)), 0
        while k < batch.num_rows:
            before = ends[k - 1] if k else 0
            n = min(SLICE, max(1, int(np.searchsorted(ends, before + SLICE_BYTES, side="right")) - k))
            yield batch.slice(k, n)
            k += n


_TOKENIZERS: dict[str, Tokenizer] = {}


def tokenizer(model: bytes) -> Tokenizer:
    """One tokenizer a process and model file."""
    key = hashlib.sha256(model).hexdigest()
    if key not in _TOKENIZERS:
        _TOKENIZERS[key] = Tokenizer(Vocabulary.from_model(model))
    return _TOKENIZERS[key]


def _shipped(key: str, packed: bytes) -> Tokenizer:
    """One tokenizer a worker: it and its cache serve all tasks of the worker."""
    if key not in _TOKENIZERS:
        _TOKENIZERS[key] = pickle.loads(packed)
    return _TOKENIZERS[key]


def _packed(model_path: str) -> tuple[str, bytes]:
    """The driver reads the model file (bounded by its vocabulary) and builds the trie once; its bytes go out with the function."""
    with open(model_path, "rb") as f:
        model = f.read()
    t = tokenizer(model)
    return hashlib.sha256(model).hexdigest(), pickle.dumps(t)


def encoded(docs: DataFrame, model_path: str = MODEL_PATH, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), digest: bool = False) -> DataFrame:
    """The kept columns, ``ids`` and their number ``n_tokens``; with ``digest`` also ``decoded_sha256``, of what the ids decode to.

    The digest saves sending ids to and fro where only the round trip is to be confirmed.
    """
    key, packed = _packed(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _shipped(key, packed)
        for batch in _slices(batches, lambda b: pc.fill_null(pc.binary_length(b.column(len(keep))), 0).to_numpy(zero_copy_only=False)):
            texts = batch.column(len(keep)).to_pylist()
            parts = t.encode_all(texts)
            missing = np.array([x is None for x in texts], bool)
            lengths = np.fromiter(map(len, parts), np.int64, len(parts))
            ends = np.concatenate([np.zeros(1, np.int32), np.cumsum(lengths, dtype=np.int32)])
            ids = pa.ListArray.from_arrays(pa.array(ends, mask=np.append(missing, False)), pa.array(np.concatenate(parts)))
            columns, names = [*batch.columns[: len(keep)], ids, pa.array(lengths, mask=missing)], [*keep, "ids", "n_tokens"]
            if digest:
                sums = [None if x is None else hashlib.sha256(t.decode(p.tolist()).encode("utf-8")).hexdigest() for x, p in zip(texts, parts, strict=True)]
                columns, names = [*columns, pa.array(sums, pa.string())], [*names, "decoded_sha256"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    fields = [*(docs.schema[c] for c in keep), T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType())]
    schema = T.StructType([*fields, T.StructField("decoded_sha256", T.StringType())] if digest else fields)
    return docs.select(*keep, F.col(text_col).cast("string").alias("__text")).mapInArrow(run, schema)


def decoded(rows: DataFrame, model_path: str = MODEL_PATH, ids_col: str = "ids") -> DataFrame:
    """Adds ``text``, what the ids decode to."""
    key, packed = _packed(model_path)
    names = rows.columns
    at = names.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _shipped(key, packed)
        for batch in _slices(batches, lambda b: 4 * np.diff(b.column(at).offsets.to_numpy())):
            column = batch.column(at)
            flat, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
            texts = [t.decode(flat[a:b].tolist()) if ok else None for a, b, ok in zip(ends[:-1], ends[1:], column.is_valid().to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*names, "text"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("text", T.StringType())]))
