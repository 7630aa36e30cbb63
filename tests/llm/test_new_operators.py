"""Spelling variants, the prefix trie and SimHash groups against brute force, and their edge cases."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from stratiform.llm import prefix_trie, simhash, variants

# Spelling variants


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_words(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def brute_forms(words):
    near = {w: [v for v in words if v != w and one_edit(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 2 * words[w] else None
    out = {}
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None)
    return out


def forms_of(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string, word string")
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in variants.grouped(df).collect()}


def test_variants_equal_brute_force(spark):
    rng = random.Random(3)
    docs = []
    for k in range(40):
        text = []
        for _ in range(120):
            word = "".join(rng.choice("abé") for _ in range(rng.randint(4, 7)))
            text += [word] * rng.choice((1, 1, 1, 6))
        docs.append((k, rng.choice((" ", "\n", ", ", "あ")).join(text).title(), "x"))
    want = brute_forms(brute_words([d[:2] for d in docs]))
    assert len(want) > 500 and sum(x[3] for x in want.values()) > 500
    assert forms_of(spark, docs) == want


@pytest.mark.parametrize("words", [["aabbb", "aabb", "aaabbb", "aabbbb", "aabcb"], ["aaaaa", "aaaaaa", "aaaaaaa", "aaaaab"], ["abcde", "xbcde", "zbcde", "bcdef", "abcdef"]])
def test_runs_of_one_character_and_several_light_subtrees(spark, words):
    frame = spark.createDataFrame([(w, 10 * k + 3) for k, w in enumerate(words)], "word string, n long")
    got = {r.word: r.n_near for r in variants.near_words(frame).collect()}
    want = {w: sum(one_edit(w, v) for v in words if v != w) for w in words}
    assert got == {w: n for w, n in want.items() if n}


def test_variants_of_nothing(spark):
    assert forms_of(spark, []) == {}
    assert forms_of(spark, [(1, None, "a"), (None, "", "b"), (None, "hello hello hello", None)]).keys() == brute_words([(None, "hello hello hello")]).keys()


def test_pieces_of_a_long_text_cut_no_word(monkeypatch):
    monkeypatch.setattr(variants, "PIECE", 7)
    text = "abcdeféè xyzああabc " * 20
    found = [r for p in variants.pieces(text.encode()) for r in variants.RUN.findall(p)]
    assert found == variants.RUN.findall(text.encode())


# Prefix trie


def brute_trie(rows, lead=False):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append(((turn is not None, turn or 0), role or "", text or ""))
    order = {c: [x[1:] for x in sorted(ts)] for c, ts in turns.items()}
    if lead:
        h = {c: zlib.crc32(str(c).encode()) % 6 for c in order}
        order = {c: order.get(c - c % 100, [])[: h[c]] + ts[h[c] :] for c, ts in order.items()}
    members = defaultdict(list)
    for c, ts in order.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
    kids = Counter(p[:-1] for p in members if p)
    out = set()
    for p, cs in members.items():
        below = [q for q in members if q[: len(p)] == p]
        ends = ",".join(map(str, sorted(c for c in cs if len(order[c]) == len(p))))
        saved = sum((len(members[q]) - 1) * len(q[-1][1]) for q in below if q)
        out.add((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), kids[p], sum(not kids[q] for q in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


CONVERSATIONS = "conv_id long, turn long, role string, text string, name string"


def conversations(seed: int, n: int = 120) -> list:
    rng = random.Random(seed)
    rows = [(c, t, rng.choice(("user", None)), rng.choice(("", "a", "b", None)), "x") for c in range(n) for t in range(rng.choice((0, 1, 2, 3, 9)))]
    rows += [(7, None, "user", "first", "x"), (7, None, "user", "first", "x"), (8, 1, "a", "tie", "x"), (8, 1, "a", "tie", "x"), (8, 1, "b", "éé", "x"), (None, 1, "a", "lost", "x")]
    rows += [(500 + k, t, "u", "same", "x") for k in range(40) for t in range(5)] + [(900, t, "u", "same", "x") for t in range(70)]
    rng.shuffle(rows)
    return rows


def nodes(frame) -> set:
    return {tuple(r) for r in frame.collect()}


@pytest.mark.parametrize("lead", [False, True])
def test_trie_equals_brute_force(spark, lead, monkeypatch):
    monkeypatch.setattr(prefix_trie, "STRETCH", 8)
    monkeypatch.setattr(prefix_trie, "JOINED", 3)
    rows = conversations(5)
    df = spark.createDataFrame(rows, CONVERSATIONS).repartition(5)
    got = prefix_trie.trie(*prefix_trie.rebuilt(prefix_trie.numbered(df))) if lead else prefix_trie.conversation_trie(df)
    assert nodes(got) == brute_trie([r[:4] for r in rows], lead)


def test_empty_and_turnless_conversations(spark):
    assert nodes(prefix_trie.conversation_trie(spark.createDataFrame([], CONVERSATIONS))) == set()
    rows = [(101, 0, "u", "x", "n"), (-3, 0, "u", "y", "n")]
    got = prefix_trie.trie(*prefix_trie.rebuilt(prefix_trie.numbered(spark.createDataFrame(rows, CONVERSATIONS))))
    assert {x[1] for x in nodes(got)} >= {0}
    only = prefix_trie.trie(*prefix_trie.rebuilt(prefix_trie.numbered(spark.createDataFrame(rows[:1], CONVERSATIONS)), leads=10**9))
    assert nodes(only) == {(101, 0, None, 1, 0, 1, 0, hashlib.sha256(b"101").hexdigest())}


# SimHash


def brute_fingerprint(text: str) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps: list[int], reach: int = 4) -> list[int]:
    x = np.array(fps, np.uint64)
    near = np.bitwise_count(x[:, None] ^ x[None, :]) <= reach
    label = np.arange(len(x))
    while True:
        low = np.where(near, label[None, :], len(x)).min(1)
        if (low == label).all():
            return label.tolist()
        label = low


def test_fingerprints_and_groups(spark, monkeypatch):
    rng = random.Random(8)
    texts = [None, "", " \n", "one", "one two three", "One two THREE four Été", "a b c d e"]
    base = [" ".join(rng.choice(("alpha", "beta", "gamma", "delta", "x y")) for _ in range(rng.randint(3, 150))) for _ in range(40)]
    for t in base:
        words = t.split()
        texts += [t, t.upper(), " ".join([*words[:-1], "end"]), " ".join([*words, "more"])]
    df = spark.createDataFrame([(10 + k, t, "z") for k, t in enumerate(texts)], "doc_id long, text string, fp string")
    monkeypatch.setattr(simhash, "SPREAD", 1)
    got = {r.doc_id: r for r in simhash.near_groups(df).collect()}
    fps = [brute_fingerprint(t) for t in texts]
    assert [int(got[10 + k].fingerprint, 16) for k in range(len(texts))] == fps
    assert [got[10 + k].component_id - 10 for k in range(len(texts))] == brute_components(fps)
    assert all(r.kept == (r.component_id == k) for k, r in got.items())


def test_long_texts_in_pieces_have_the_same_fingerprint(monkeypatch):
    text = " ".join(f"w{k % 37} \tv{k % 11}" for k in range(300))
    monkeypatch.setattr(simhash, "PIECE", 10)
    assert simhash.fingerprint(text.encode()) == brute_fingerprint(text)
    assert simhash.fingerprint(b"a b") == brute_fingerprint("a b")


def clustered(rng: np.random.Generator, n: int) -> np.ndarray:
    """Random fingerprints, chains of near ones and one dense cluster."""
    x = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    out = [x]
    for flips in (1, 3, 4, 5):
        x = x[: n // 2].copy()
        for _ in range(flips):
            x ^= np.uint64(1) << rng.integers(0, 64, len(x)).astype(np.uint64)
        out.append(x)
    dense = np.full(n // 3, rng.integers(0, 1 << 63), np.uint64)
    for _ in range(2):
        dense ^= np.uint64(1) << rng.integers(0, 64, len(dense)).astype(np.uint64)
    return np.unique(np.concatenate([*out, dense]))


@pytest.mark.parametrize("capacity, homes, queries", [(1 << 20, 1 << 16, 1 << 18), (4, 1 << 16, 1 << 18), (4, 20, 50)])
def test_tree_finds_every_link(spark, monkeypatch, capacity, homes, queries):
    for name, value in (("SPREAD", capacity), ("HOMES", homes), ("QUERIES", queries)):
        monkeypatch.setattr(simhash, name, value)
    x = clustered(np.random.default_rng(4), 900)
    df = spark.createDataFrame([(int(v),) for v in x.view(np.int64)], "fp long")
    at, parent = {int(v): k for k, v in enumerate(x.view(np.int64))}, list(range(len(x)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    found = simhash.links(df).collect()
    for r in found:
        a, b = sorted((top(at[r.a]), top(at[r.b])))
        parent[b] = a
    assert [top(i) for i in range(len(x))] == brute_components(x.tolist())


def test_visits_hold_every_neighbour_and_prune():
    rng = np.random.default_rng(2)
    x = clustered(rng, 2000)
    tree = simhash.fit(x, 6)
    home = simhash.homes(tree, x)
    which, leaf = simhash.visits(tree, x, 4)
    asked = set(zip(which.tolist(), leaf.tolist(), strict=True))
    assert len(asked) == len(which) < 0.8 * len(x) * tree.leaves
    near = np.argwhere(np.bitwise_count(x[:, None] ^ x[None, :]) <= 4)
    assert all((int(a), int(home[b])) in asked for a, b in near)


def test_simhash_of_nothing_and_repeats(spark):
    schema = "doc_id long, text string"
    assert simhash.near_groups(spark.createDataFrame([], schema)).collect() == []
    rows = [(None, "a b c d e", ), (5, "A b c d e"), (5, "a b c d e"), (9, None), (3, "")]
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_groups(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert got == sorted([(None, 5), (5, 5), (5, 5), (9, 3), (3, 3)], key=str)


def test_dense_numbers(spark):
    rows = spark.createDataFrame([(i, i % 13) for i in range(200)], "i long, k long").repartition(7)
    got = prefix_trie.named(rows, ["k"], "name").collect()
    assert {r.name for r in got} == set(range(13)) and len(got) == 200
    assert all(len({r.name for r in g}) == 1 for _, g in itertools.groupby(sorted(got, key=lambda r: r.i % 13), key=lambda r: r.i % 13))
