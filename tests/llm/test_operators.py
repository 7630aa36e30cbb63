import hashlib
import zlib
from collections import defaultdict

import pytest

import corpus_pipeline
from stratiform.llm import exactdup, langid, mixing, quality, queries, sharding, unigram, url_filter, warc

SF = "/root/testdata/sf0.01"
DOCS = [(1, "a b c d", "s", "x"), (1, "a b c d", "s", "x"), (2, "A b c d", "s", "x"), (None, None, None, None), (3, "", "t", None), (4, "w " * 40000, "s", "x"), (5, "a\nb\nb\n", "t", "y")]
SCHEMA = "doc_id long, text string, source string, n_words string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, SCHEMA)


def test_quality_ledger(spark, docs):
    rows = {r.doc_id: r for r in quality.ledger(docs).collect()}
    assert (rows[4].n_words, rows[4].n_repeat_words, rows[4].word_chars) == (40000, 40000, 40000)
    assert (rows[5].n_lines, rows[5].n_dup_lines, rows[None].n_words) == (3, 1, 0)
    assert all(r.fail_bits & quality.BASE for r in rows.values())
    by_rule = {r.rule: r for r in quality.ablations(quality.ledger(docs), "base-1").collect()}
    assert by_rule["repeated_words"].rejected_alone == 1 and by_rule["few_words"].rejected == 6
    assert quality.kept_documents(docs).columns == docs.columns
    assert quality.ledger(docs.limit(0)).count() == 0


@pytest.mark.parametrize("bits", [64, 3])
def test_exact_groups_whatever_the_fingerprint(spark, bits):
    texts = ["x" * k + "y" * (3000 - k) for k in range(0, 3000, 500)]
    rows = [(i, t) for i, t in enumerate([*texts, texts[0].upper(), None, "", "abc", "abd"])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").lower()].append(i)
    want = {i: (max(groups[(t or "").lower()]), len(groups[(t or "").lower()]), hashlib.sha256((t or "").lower().encode()).hexdigest()) for i, t in rows}
    assert {r.doc_id: (r.keep_id, r.group_size, r.text_sha256) for r in exactdup.exact_groups(df, bits=bits).collect()} == want


def test_exact_stage(spark, docs):
    kept = sorted((r.doc_id or 0, r.text or "") for r in exactdup.distinct_documents(docs).collect())
    assert [i for i, _ in kept] == [2, 3, 4, 5]


def test_sharding(spark):
    rows = queries.op5_feistel_sharding(spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert sorted(r.place for r in rows) == list(range(len(rows)))
    assert all(r.shard == r.place % 16 and r.slot == r.place // 16 for r in rows)
    assert all(r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) and r.size == len(texts[r.doc_id].encode()) + 1 for r in rows)
    assert sharding.sharded(spark.createDataFrame([], SCHEMA)).count() == 0


def test_mixing(spark):
    rows = queries.op10_entropy_mixing(spark, SF).collect()
    taken, longest, by = defaultdict(int), defaultdict(int), {}
    for r in rows:
        taken[r.source] += r.taken
        longest[r.source] = max(longest[r.source], r.size)
        by[r.source] = (r.source_size, r.target)
        assert 0 <= r.taken <= 2 * r.size
    assert all(abs(taken[s] - by[s][1]) <= 2 * longest[s] for s in by)
    assert all(t <= 2 * n * (1 + 1e-9) for n, t in by.values())
    assert abs(sum(t for _, t in by.values()) - 1.5 * sum(n for n, _ in by.values())) < 1
    assert sorted(map(repr, rows)) == sorted(map(repr, queries.op10_entropy_mixing(spark, SF).collect()))


def test_mixing_edge_cases(spark, docs):
    assert mixing.mixed(docs).count() == len(DOCS)
    assert mixing.mixed_documents(docs).columns == docs.columns
    assert mixing.mixed(docs.limit(0)).count() == 0


def test_language_accuracy(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    held = [r for r in queries.op9_language_id(spark, SF).collect() if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) > 0.97 * len(held)
    model = langid.fit([("en", "the cat and the dog"), ("de", "der hund und die katze")])
    assert [x for x, _ in model.predict([None, "", "123 --", "the dog and", "und die katze"])] == ["und", "und", "und", "en", "de"]


def test_url_model(spark):
    rows = spark.createDataFrame([(1, None), (2, "x"), (3, "http://a.example.net/en/1"), (4, "http://b.net"), (5, "HTTP://C.NET/q?://"), (None, "https://www.best-casino-jackpot.com/en/5462#top")], "page_id long, url string")
    got = {r.page_id: r for r in url_filter.judged(rows, queries.URL_RULES, url_filter.fit(url_filter.seed_urls())).collect()}
    assert (got[1].host, got[1].path, got[2].host) == ("", "", "")
    assert (got[3].rule, got[3].verdict) == ("example.net/en/", "allow")
    assert got[4].rule is None and (got[5].rule, got[5].verdict) == ("net/", "block")
    assert got[None].verdict == "block"


def test_warc_round_trip(spark):
    big = "<p>é\r\n\r\nWARC/1.1\r\n" * 100
    pages = spark.createDataFrame([(1, "http://a/b c", big), (2, None, big), (3, "http://x", None), (3, "http://x", None), (4, "http://y", "small"), (5, "http://z", "small")], "page_id long, url string, html string")
    rows = sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.archived(pages).collect())
    digest = lambda x: hashlib.sha1(x.encode()).hexdigest()
    n = len(big.encode())
    assert rows == [(1, n, digest(big), "revisit", 2), (2, n, digest(big), "response", None), (3, 0, digest(""), "response", None), (3, 0, digest(""), "response", None), (4, 5, digest("small"), "response", None), (5, 5, digest("small"), "response", None)]
    assert warc.archived(pages.limit(0)).count() == 0


def test_tokens_round_trip(spark, docs):
    rows = unigram.decoded(unigram.encoded(docs, keep=("doc_id",))).collect()
    assert sorted(r.text or "" for r in rows) == sorted(t or "" for _, t, _, _ in DOCS)


def test_viterbi_against_every_segmentation():
    t = unigram.Tokenizer(unigram.Vocabulary.load())
    score = dict(zip(t.vocabulary.pieces, t.vocabulary.scores, strict=True))

    def best(word):
        if not word:
            return 0.0
        return max(score[word[:k]] + best(word[k:]) for k in range(1, len(word) + 1) if word[:k] in t.trie.codes or word[:k] in score)

    for word in ("▁hello", "▁tokens", "▁abcab"):
        assert abs(sum(t.vocabulary.scores[i] for i in t.segment(word)) - best(word)) < 1e-9


def test_runs_together_and_alone():
    t = unigram.Tokenizer(unigram.Vocabulary.load())
    texts = ["", "a", "  two  spaces ", "日本語 русский 12345\t\n x", "é" * 300, "(\"--…''", "z" * 5000, "reserved.\nErndstea $$$ &&& hello"]
    runs = sorted({r for x in texts for r in t.run.findall("▁" + x.replace(" ", "▁")) if len(r) <= unigram.LONG}, key=len)
    assert t.segment_chunk(runs) == [t.segment(r) for r in runs]
    assert [t.decode(t.encode(x)) for x in texts] == texts
    assert all(len(r) <= unigram.LONG_WORD for r in t.cache)


def test_long_texts_pass_the_pipeline(spark, tmp_path):
    long = " ".join(f"word{i}" for i in range(100_001))
    rows = [(i, f"{long} book{i}" if i < 2 else " ".join(f"text{i}w{k}" for k in range(60)), "en", "s") for i in range(4)]
    docs = spark.createDataFrame([(*r, len(r[1])) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.n_words, r.kept, r.fail_bits) for r in queries.op2_quality_rules(spark, str(tmp_path)).collect()}
    assert got[0] == (100_002, True, quality.mask("many_words")) and got[2] == (60, True, 0)
    out = corpus_pipeline.run(spark, str(tmp_path))
    texts = {r.text for r in unigram.decoded(out).collect()}
    assert len(texts & {f"{long} book0", f"{long} book1"}) == 1
