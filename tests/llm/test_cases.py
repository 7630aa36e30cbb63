"""Edge cases and independent restatements of the corpus operators and of the pipeline's stages."""

import hashlib
import math
import os
import re
import subprocess
import sys
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stratiform.llm import exactdup, langid, mixing, neardup, quality, queries, sharding, unigram, url_filter, warc

CLASHING = ("id", "__id", "text_key", "n", "doc", "row", "key", "m", "copies", "taken", "__copies", "sid", "rank", "n_words", "fail_bits")


def table(spark, rows):
    """Documents (doc_id, text, source), a lang, and further columns whose names the operators use themselves."""
    names = [c for c in CLASHING if c not in ("doc_id", "text", "source")]
    schema = "doc_id long, text string, source string, lang string, " + ", ".join(f"`{c}` string" for c in names)
    return spark.createDataFrame([(*r, "en", *names) for r in rows], schema)


def words(n, seed, alphabet=400):
    rng = np.random.default_rng(seed)
    return [f"w{x}" for x in rng.integers(0, alphabet, n)]


# URL filters


def test_url_model_on_kinds_it_never_saw():
    rows = url_filter.seed_urls()
    recalls, false = [], []
    for out in (("casino", "poker", "river", "museum"), ("viagra", "pharmacy", "library", "engine"), ("porn", "dating", "hotel", "atlas"), ("loans", "spam", "village", "chess")):
        model = url_filter.fit(url_filter.seed_urls(out))
        held = [(url_filter.split_url(u), y) for u, y in rows if any(w in u for w in out)]
        flagged = model.scores([h for (h, _), _ in held], [p for (_, p), _ in held]) >= 0.5
        y = np.array([y for _, y in held])
        recalls.append(flagged[y == 1].mean())
        false.append(flagged[y == 0].mean())
    assert np.mean(recalls) > 0.75 and np.mean(false) < 0.02


def test_url_model_on_names_and_paths_it_never_saw():
    """A path says nothing by itself, long ones included, and drowns no host."""
    out = ("casino", "pills", "crypto", "river", "algebra", "bakery")
    model = url_filter.fit(url_filter.seed_urls(out))
    held = [(url_filter.split_url(u)[0], y) for u, y in url_filter.seed_urls() if any(w in u for w in out)]
    y = np.array([y for _, y in held])
    for path in ("/zz/9183/unseen", "/quarterly/" + "x1y2/" * 60, "/en/5462"):
        flagged = model.scores([h for h, _ in held], [path] * len(held)) >= 0.5
        assert flagged[y == 1].mean() > 0.7 and flagged[y == 0].mean() < 0.02
    whole = url_filter.fit(url_filter.seed_urls())
    assert (whole.scores(["www.casino.com"] * 3, ["/", "/en/5462", "/a" * 5000]) > 0.5).all()
    assert (whole.scores(["www.library.example.org"] * 3, ["/", "/en/5462", "/bonus"]) < 0.5).all()


def test_all_labelled_rows_given_to_fit_are_used():
    rows = [(f"https://a{k:05d}.org/", 0) for k in range(300)] + [(f"https://zzz{k:05d}.com/", 1) for k in range(300)]
    model = url_filter.fit(rows, steps=50)
    assert model.scores(["zzz99999.com"], ["/"])[0] > 0.5 > model.scores(["a99999.org"], ["/"])[0]


def test_url_columns_against_plain_python(spark):
    urls = [None, "", "x", "://", "http://", "http://A.Net", "http://b.ORG/fr/x?y#z", "https://example.net/en/1", "https://q.example.net/de/1", "http://xexample.com/de/", "http://a.example.com/de/?", "ftp://u@h:8/p", "http://é.com/ü", "http://net", "http://a/?://b", "http://n.net/" + "p" * 100_000]
    rows = [(i, u) for i, u in enumerate(urls)] * 2
    got = url_filter.judged(spark.createDataFrame(rows, "page_id long, url string").withColumn("score", F.lit("mine")).withColumn("__rule", F.lit(1)), queries.URL_RULES, url_filter.fit(url_filter.seed_urls()))
    seen = Counter()
    for r in got.collect():
        host, path = url_filter.split_url(urls[r.page_id])
        fits = [x for x in queries.URL_RULES if (host == x.host or host.endswith("." + x.host)) and path.startswith(x.path)]
        rule = max(fits, key=lambda x: len(x.text), default=None)
        assert (r.host, r.path, r.rule) == (host, path, rule and rule.text)
        assert not rule or r.verdict == rule.verdict
        seen[r.page_id] += 1
    assert set(seen.values()) == {2} and len(seen) == len(urls)
    assert url_filter.judged(spark.createDataFrame([], "page_id long, url string"), queries.URL_RULES, url_filter.fit([])).count() == 0
    labelled = spark.createDataFrame([("http://a.b/c", 1), (None, 1), ("http://d.e/f", 0), ("http://g.h", None)], "url string, label int")
    assert sorted(url_filter.training_rows(labelled)) == [("http://a.b/c", 1), ("http://d.e/f", 0)]


# Language identification


def plain_parse(model, text):
    """Phrases by substring search in nothing but the moves, letter by letter."""
    out = []
    for root in model.roots:
        state, n = root, 0
        for c in model.encode(text):
            if state != root and model.check[state + c] == state:
                state = model.target[state + c]
            else:
                known = model.check[root + c] == root
                n += 1 if known else 2
                state = model.target[root + c] if known else root
        out.append(n)
    return out


def longest_matches(sample, text):
    """Phrases by the definition: the longest substring of the sample, again and again."""
    at = n = 0
    while at < len(text):
        k = 1
        while at + k < len(text) and text[at : at + k + 1] in sample:
            k += 1
        at, n = at + k, n + (1 if text[at] in sample else 2)
    return n


def test_parse_is_that_of_the_whole_text(monkeypatch):
    samples = {"aa": "the cat sat on the mat and the dog ran", "bb": "der hund und die katze im haus", "cc": "кошка и собака дома"}
    model = langid.fit(list(samples.items()))
    texts = ["the cat and die katze", "собака", "", "zzz", " ".join(["the dog ran on", "die katze", "qq"] * 300), "the cat sat on the mat and the dog ran" * 40]
    want = [[longest_matches(langid.folded(samples[x]), t) for x in model.languages] for t in texts]
    monkeypatch.setattr(langid, "PARSES_AT_ONCE", 6)
    assert model.phrases(texts).tolist() == want == [plain_parse(model, t) for t in texts]


def test_large_scripts_together():
    rng = np.random.default_rng(3)
    make = {"zh": lambda: chr(0x4E00 + rng.integers(0, 1500)), "ja": lambda: chr(0x4E00 + 3000 + rng.integers(0, 1500)), "ru": lambda: chr(0x430 + rng.integers(0, 32)), "en": lambda: chr(97 + rng.integers(0, 26))}
    text = lambda lang, n: "".join(make[lang]() for _ in range(n))
    model = langid.fit([(lang, text(lang, 3000)) for lang in make])
    for lang in make:
        assert [x for x, _ in model.predict([text(lang, 60) for _ in range(20)])] == [lang] * 20
    assert langid.folded("नमस्ते दुनिया") == "नमस्ते दुनिया" and langid.folded("́ 12") == ""


def test_training_rows_of_null_and_repeated_ids(spark):
    rows = [(None, f"der hund nummer {i} " * 3, "de") for i in range(600)] + [(7, "the same dog", "en")] * 300 + [(i, f"the cat {chr(97 + i)}", "en") for i in range(20)] + [(1, "x" * 9000, "xx"), (2, None, "en"), (3, "no label", None)]
    got = Counter(lang for lang, _ in langid.training_rows(spark.createDataFrame(rows, "doc_id long, text string, lang string"), "doc_id", "text", "lang"))
    assert got["de"] == langid.DOCS_PER_LANGUAGE and got["xx"] == 1 and 1 <= got["en"] <= 20
    docs = spark.createDataFrame([*rows[:3], (1, None, None), (1, None, None), (2, "12", "en")], "doc_id long, text string, lang string").withColumn("score", F.lit("mine"))
    model = langid.fit([("de", "der hund und die katze"), ("en", "the dog and the cat")])
    found = langid.identified(docs, model).collect()
    assert len(found) == 6 and [r.lang_pred for r in found if r.score == 0] == ["und"] * 3
    assert langid.identified(docs.limit(0), model).count() == 0 and langid.training_rows(docs.limit(0), "doc_id", "text", "lang") == []


# Sharding


def plain_feistel(number, n, seed):
    base = math.isqrt(max(n, 1) - 1) + 1
    keys, x = [], seed % (2**31 - 2) + 1
    for _ in range(6):
        for _ in range(4):
            x = x * 48271 % (2**31 - 1)
        keys.append(x)

    def mixed(v, k):
        h = (v % (2**31 - 1) * 69621 + k) % (2**31 - 1)
        h ^= h >> 15
        h = (h * 39373 + k) % (2**31 - 1)
        return h ^ (h >> 13)

    while True:
        left, right = divmod(number, base)
        for k in keys:
            left, right = right, (left + mixed(right, k)) % base
        number = left * base + right
        if number < n:
            return number


def test_shards_against_plain_feistel_and_any_split(spark):
    rows = [(i if i % 9 else None, f"text {i % 40}", None) for i in range(301)]
    docs = table(spark, rows)
    one = sorted((r.row_number, r.place, r.shard, r.slot, str(r.doc_id), r.size) for r in sharding.sharded(docs, 16, 5).collect())
    two = sorted((r.row_number, r.place, r.shard, r.slot, str(r.doc_id), r.size) for r in sharding.sharded(docs.repartition(7), 16, 5).collect())
    assert one == two and [x[0] for x in one] == list(range(301))
    assert all(x[1] == plain_feistel(x[0], 301, 5) and (x[2], x[3]) == (x[1] % 16, x[1] // 16) for x in one)


# Mixing


def test_mixing_against_an_independent_solution(spark):
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(words(int(rng.integers(1, 60)), i)), ("a", "b", "c", None)[i % 4 if i % 3 else 0]) for i in range(240)] + [(500, None, "z"), (501, "", "z")]
    got = mixing.mixed(table(spark, rows), (5, 2, 1), 1.5, 2.0).collect()
    sizes, docs = defaultdict(int), defaultdict(list)
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
        docs[s].append(len((t or "").split()))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:  # excess over the caps is shared again by weight
        free = [s for s in order if s not in full]
        level = (total - sum(2 * sizes[s] for s in full)) / max(1, sum(weight[s] for s in free))
        over = {s for s in free if weight[s] * level > 2 * sizes[s]}
        if not over:
            break
        full |= over
    target = {s: 2.0 * sizes[s] if s in full else weight[s] * level for s in order}
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6 * max(1, target[r.source])
        assert r.copies in (math.floor(r.rate), math.ceil(r.rate)) and 0 <= r.copies <= 2
        taken[r.source] += r.size * r.copies
    for s in order:
        if sizes[s] and s not in full:  # rate = min(2, exp(x * size)) with the x that meets the target, by bisection
            lo, hi = -50.0, 50.0
            for _ in range(200):
                x = (lo + hi) / 2
                lo, hi = (x, hi) if sum(n * min(2.0, math.exp(min(50, x * n))) for n in docs[s]) < target[s] else (lo, x)
            assert all(abs(r.rate - min(2.0, math.exp(lo * r.size))) < 1e-6 for r in got if r.source == s)
        assert abs(taken[s] - target[s]) <= max(docs[s], default=0) + 1e-6


def test_many_rows_of_one_size_are_ranked_alike(spark):
    """Copies go to the least hashes, in whatever number of ranges they are ranked."""
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"), F.when(F.col("id") < 4000, "s").otherwise("t").alias("source"))
    rows = mixing.mixed(docs).select("source", "copies", F.shiftrightunsigned(F.xxhash64("doc_id", "text_key"), 32).alias("u")).collect()
    for s in "st":
        of = sorted((r.u, r.copies) for r in rows if r.source == s)
        more = [c for _, c in of]
        assert more == sorted(more, reverse=True)


def test_mixed_rows(spark):
    rows = [(1, "a b c", "s"), (1, "a b c", "s"), (None, "a b c", "s"), (None, None, None), (2, "x " * 50, "t"), (3, "y", "u")]
    docs = table(spark, rows)
    want = Counter()
    for r in mixing.mixed(docs).collect():
        want[(r.doc_id, r.size)] += r.copies
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    assert Counter((r.doc_id, len((r.text or "").split())) for r in out.collect()) == +want
    assert mixing.mixed_documents(docs.limit(0)).count() == 0


# Exact and near duplicates


def plain_exact(rows):
    """Of equal texts the largest id, nulls first; repeated rows once."""
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[(t or "").translate({c: c + 32 for c in range(65, 91)})].append(i)
    return Counter((max((i for i in ids if i is not None), default=None), t) for t, ids in groups.items())


def test_exact_stage_with_repeats_and_null_ids(spark):
    rows = [(1, "Abc", "s"), (1, "Abc", "t"), (1, "abc", "s"), (None, "Q", "s"), (None, "q", "s"), (None, "q", "s"), (2, None, "s"), (3, "", "s"), (4, "É", "s"), (5, "é", "s")]
    out = exactdup.distinct_documents(table(spark, rows))
    assert out.columns == table(spark, rows).columns
    assert Counter((r.doc_id, (r.text or "").lower() if r.text not in ("É",) else "É") for r in out.collect()) == plain_exact(rows)


def shingle_sets(rows):
    out = []
    for _, t, _ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        out.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    return out


def plain_near(rows, percent):
    """The component of each row, by all pairs."""
    sets, up = shingle_sets(rows), list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                up[find(a)] = find(b)
    return [find(i) for i in range(len(rows))], sets


def near_rows():
    base = words(80, 1)
    swap = lambda k: " ".join(base[:k] + ["swapped"] + base[k + 1 :])
    rows = [(10, " ".join(base), "s"), (4, " ".join(base).upper(), "s"), (7, swap(40), "s"), (7, swap(40), "t"), (7, "quite another text of seven words", "s"), (None, swap(20), "s")]
    return rows + [(None, "alone without an id at all", "s"), (None, "alone without an id at all", "s"), (1, None, "s"), (2, "", "s"), (2, "  ", "s"), (3, "one two", "s"), (6, "ONE two", "s"), (8, swap(0), "s"), (9, " ".join(words(80, 2)), "s")]


def test_near_groups_of_odd_rows(spark):
    rows = near_rows()
    comp, sets = plain_near(rows, 85)
    least = defaultdict(lambda: None)
    for c, (i, _, _) in zip(comp, rows, strict=True):
        if i is not None:
            least[c] = i if least[c] is None else min(least[c], i)
    want = Counter((i, len(s), i if not s else least[c], (i if not s else least[c]) == i) for c, s, (i, _, _) in zip(comp, sets, rows, strict=True))
    docs = table(spark, rows)
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in neardup.near_groups(docs, 85).collect()) == want
    texts = neardup.near_groups(docs.withColumn("doc_id", F.concat(F.lit("x"), F.col("doc_id").cast("string"))), 85).collect()
    assert sum(r.kept for r in texts) and len(texts) == len(rows)
    out = neardup.distinct_documents(docs, 85)
    assert out.columns == docs.columns
    kept = Counter(r.doc_id for r in out.collect())
    assert kept == Counter({4: 1, 7: 1, None: 1, 1: 1, 2: 2, 3: 1, 9: 1})


# WARC, tokens, quality


def test_one_large_page_makes_no_short_archives(spark, monkeypatch):
    monkeypatch.setattr(warc, "LARGE", 5000)
    monkeypatch.setattr(warc, "MOST_BYTES", 300_000)
    pages = [(k, f"http://h/{k}", f"{k} " * 400) for k in range(60)] + [(99, "http://h/big", "b" * 250_000), (100, "http://h/big2", "c" * 250_000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)
    path = warc.write_archives(df)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path").count()
    assert files <= 4
    got = {r.page_id: r.payload_bytes for r in warc.archived(df).collect()}
    assert len(got) == 62 and got[99] == 250_000


def test_warc_with_clashing_columns_and_hot_payload(spark):
    hot = "h" * 1200
    pages = [(i, f"http://a/{i}", hot) for i in range(40)] + [(100, "http://b", "c" * 1500), (101, "http://b", "c" * 1500), (102, None, None)]
    docs = spark.createDataFrame([(*p, "x", "y", "z") for p in pages], "page_id long, url string, html string, sha string, ref string, n string")
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc.archived(docs).collect()}
    assert got == {i: ("revisit", 39) if i < 39 else ("response", None) for i in range(40)} | {100: ("revisit", 101), 101: ("response", None), 102: ("response", None)}


@pytest.mark.parametrize("text", ["a▁b", "▁", " ▁ ", "▁▁x  y", "", " ", "▁"])
def test_markers_of_the_text_survive(text):
    t = unigram.Tokenizer(unigram.Vocabulary.load())
    assert t.decode(t.encode(text)) == text


def test_tokens_of_an_empty_table(spark):
    docs = table(spark, [(1, "a", "s")]).limit(0)
    assert unigram.encoded(docs).count() == 0 and unigram.decoded(unigram.encoded(docs)).count() == 0


def test_kept_documents_agree_with_the_ledger(spark):
    rows = [(i, t, "s") for i, t in enumerate([None, "", "one two three", "a " * 80, " ".join(words(90, 4)), "$$ ## " * 60, "x\n" * 60, "wort " + "ß" * 2000])]
    docs = table(spark, rows)
    for policy in quality.POLICIES:
        kept = sorted(r.doc_id for r in quality.kept_documents(docs, policy).collect())
        assert kept == sorted(r.doc_id for r in quality.ledger(docs).where(quality.passes(policy)).collect())
    assert quality.kept_documents(docs).columns == docs.columns and quality.kept_documents(docs.limit(0)).count() == 0


# The pipeline


def test_pipeline_against_plain_python(spark, tmp_path):
    rows = [(20 + i, " ".join(words(70, i)), "st"[i % 2]) for i in range(12)]
    rows += [(i, rows[i][1].upper(), "s") for i in range(3)] + [(50 + i, rows[i][1].replace(" ", "  ", 1) + " tail", "t") for i in range(4, 8)]
    rows += [(70, "$ # " * 100, "s"), (71, None, "t"), (72, "short but clean", None), (72, "short but clean", None), (73, "again and again " * 40, "s")]
    docs = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")

    passing = [r for r in rows if not quality.POLICIES["web-3"] & sum(1 << x.bit for x in quality.RULES if eval(x.fails, {}, dict(zip(quality.MEASURES, quality.measured((r[1] or "").encode()), strict=True))))]
    stage = docs
    stage = corpus_pipeline.quality_rules(spark, stage, "")
    assert Counter((r.doc_id, r.text) for r in stage.collect()) == Counter((i, t) for i, t, _ in passing)
    exact = plain_exact(passing)
    stage = corpus_pipeline.exact_dedup(spark, stage, "")
    left = [(r.doc_id, r.text, r.source) for r in stage.collect()]
    assert Counter((i, (t or "").lower()) for i, t, _ in left) == exact
    comp, sets = plain_near(left, 80)
    least = {}
    for c, (i, _, _) in zip(comp, left, strict=True):
        least[c] = min(least.get(c, i), i)
    stage = corpus_pipeline.near_dedup(spark, stage, "")
    near = [(r.doc_id, r.text, r.source) for r in stage.collect()]
    assert sorted(i for i, _, _ in near) == sorted(i for c, s, (i, _, _) in zip(comp, sets, left, strict=True) if not s or least[c] == i)
    copies = Counter()
    for r in mixing.mixed(stage).collect():
        copies[r.doc_id] += r.copies
    stage = corpus_pipeline.mix_sources(spark, stage, "")
    assert Counter(r.doc_id for r in stage.collect()) == +copies and stage.columns == docs.columns
    tokens = unigram.Tokenizer(unigram.Vocabulary.load())
    texts = {i: t for i, t, _ in near}
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter(r.doc_id for r in out) == +copies
    assert all((r.ids is None and texts[r.doc_id] is None) or (tokens.decode(r.ids) == texts[r.doc_id] and r.n_tokens == len(r.ids)) for r in out)
    assert all(hashlib.sha256(tokens.decode(r.ids or []).encode()).digest() for r in out)


def test_every_label_and_long_texts_are_learnt(spark):
    """250 labels, and a language that has only texts longer than a row of the sample."""
    word = lambda k, n: "".join(chr(97 + (k * 31 + n * 17 + i * (k + 3)) % 26) for i in range(6))
    rows = [(1000 * k + d, " ".join(word(k, (n + d) % 40) for n in range(60)), f"l{k:03d}") for k in range(250) for d in range(3)]
    rows += [(900_000 + d, " ".join(f"lang{n % 50}uage" for n in range(3000)), "long") for d in range(3)]
    picked = langid.training_rows(spark.createDataFrame(rows, "doc_id long, text string, lang string"), "doc_id", "text", "lang")
    assert {lang for lang, _ in picked} == {f"l{k:03d}" for k in range(250)} | {"long"}
    assert sum(len(t) for _, t in picked) <= langid.SAMPLE_CHARS
    few = [r for r in rows if r[2] in ("l001", "l002", "long")]
    picked = langid.training_rows(spark.createDataFrame(few, "doc_id long, text string, lang string"), "doc_id", "text", "lang")
    assert max(len(t) for lang, t in picked if lang == "long") == langid.TRAIN_ROW_CHARS


def test_without_a_checkpoint_folder(tmp_path):
    """In a session of one process that names no shared folder, corpus operators make their own."""
    code = (
        "from pyspark.sql import SparkSession\n"
        "from stratiform.llm import exactdup, common\n"
        "spark = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').config('spark.sql.shuffle.partitions', '1').getOrCreate()\n"
        "assert spark.sparkContext.getConf().get('spark.checkpoint.dir') is None\n"
        "print('ROWS', exactdup.exact_groups(spark.createDataFrame([(1, 'a')], 'doc_id long, text string')).count(), common.shared_folder(spark) == common.shared_folder(spark))\n"
    )
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path)}
    out = subprocess.run([sys.executable, "-c", code], env=env, cwd=os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), capture_output=True, text=True, timeout=300)
    assert "ROWS 1 True" in out.stdout, out.stderr[-2000:]
