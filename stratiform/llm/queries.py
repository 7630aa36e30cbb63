"""The queries of the corpus operators: each derives the digest columns of its contract from its operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, UPPER
from . import exactdup, langid, licenses, mixing, neardup, prefix_trie, quality, sharding, simhash, unigram, url_filter, variants, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


URL_RULES = (
    url_filter.DomainRule("block", "net", "/"),
    url_filter.DomainRule("allow", "example.net", "/en/"),
    url_filter.DomainRule("block", "example.com", "/de/"),
    url_filter.DomainRule("allow", "org", "/fr/"),
)


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = spark.createDataFrame(url_filter.seed_urls(), "url string, label int")
    return url_filter.judged(table(spark, sf_dir, "pages"), URL_RULES, url_filter.fit(url_filter.training_rows(labelled)))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.ledger(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", *quality.MEASURES[:5], (~quality.passes("base-1")).alias("base_failed"), quality.passes("web-2").alias("kept"), *quality.MEASURES[5:], "fail_bits"
    )


OP2_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
words AS (SELECT r, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w FROM docs),
flat AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM words),
grams AS (SELECT r, i, word || ' ' || lead(word, 1) OVER p || ' ' || lead(word, 2) OVER p AS g FROM flat WINDOW p AS (PARTITION BY r ORDER BY i)),
twice AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams WHERE g IS NOT NULL),
covered AS (SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM (SELECT r, i, unnest([0, 1, 2]) AS k FROM twice WHERE n > 1) x GROUP BY r),
lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs),
per_line AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY r),
per_word AS (SELECT r, count(*) AS n_words, sum(length(word)) AS word_chars, sum(length(regexp_replace(word, '[^#*$%&|<>]', '', 'g'))) AS n_symbols,
  sum(CASE WHEN regexp_matches(word, '[A-Za-z]|[^\\x00-\\x7F]') THEN 1 ELSE 0 END) AS n_letter_words FROM flat GROUP BY r),
m AS (SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars, coalesce(n_symbols, 0)::BIGINT AS n_symbols,
  coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_letter_words, 0)::BIGINT AS n_letter_words
  FROM docs d LEFT JOIN per_word USING (r) LEFT JOIN per_line USING (r) LEFT JOIN covered USING (r)),
b AS (SELECT *, ({' + '.join(f'(CASE WHEN {r.fails} THEN {1 << r.bit} ELSE 0 END)' for r in quality.RULES)})::BIGINT AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & {quality.BASE}) <> 0 AS base_failed, (fail_bits & {quality.POLICIES['web-2']}) = 0 AS kept, n_lines, n_letter_words, fail_bits FROM b
"""


LICENSE_PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = licenses.with_phrases(licenses.scanned(table(spark, sf_dir, "documents")), LICENSE_PHRASES)
    both = F.array_sort(F.array_union("base_labels", licenses.labels_of(F.col("detections"))))
    score = F.greatest(licenses.score_of(F.col("detections")), F.when(F.col("n_base") > 0, licenses.PHRASE_WEIGHT).otherwise(0.0))
    return rows.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"), F.array_join(both, ",").alias("labels"), score.alias("score"), "detections"
    )


def op4_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_groups(table(spark, sf_dir, "documents"), percent=85)


def op5_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.sharded(table(spark, sf_dir, "documents"), shards=16, seed=5)
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row_number", "place")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdup.exact_groups(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP6_SQL = f"""
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents) d
WINDOW g AS (PARTITION BY t)
"""


def op7_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"))


OP7_SQL = """
SELECT page_id, n AS payload_bytes, sha1(h) AS payload_digest, CASE WHEN n >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id <> top THEN top END AS refers_to
FROM (SELECT page_id, h, strlen(h)::BIGINT AS n, max(page_id) OVER (PARTITION BY h) AS top FROM (SELECT page_id, coalesce(html, '') AS h FROM pages) p) q
"""


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return unigram.encoded(docs.select("doc_id", "text"), digest=True)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = F.coalesce(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 4 == 2, F.lit(False))
    model = langid.fit(langid.training_rows(docs.where(~out), "doc_id", "text", "lang"))
    return langid.identified(docs, model).select("doc_id", out.alias("held_out"), "lang_pred", "score")


def op10_entropy_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mixed(table(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.5, cap=2.0)
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"), "source", "rate", "copies")


# crc32 in DuckDB: the table of its 256 steps, then a fold over the bytes of a list.
CRC = "crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"


def _crc32(bytes_sql: str) -> str:
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bytes_sql}), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295)"


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.grouped(table(spark, sf_dir, "documents"))


_LETTERS = "list_transform(string_split(run, ''), lambda x: ord(x)::BIGINT)"
_BYTES = f"list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':', ''), lambda x: ord(x)::BIGINT) || flatten(list_transform({_LETTERS}, lambda x: CASE WHEN x < 128 THEN [x] ELSE [192 | (x >> 6), 128 | (x & 63)] END))"
# Pairs by every deletion of every word: equal after one deletion at the same place, or one a deletion of the other.
OP11_SQL = f"""
WITH RECURSIVE {CRC},
runs AS (SELECT doc_id, run, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents) r GROUP BY ALL),
hashed AS (SELECT run, n, {_crc32(_BYTES)} AS h FROM runs, crc),
w AS (SELECT word, sum(n)::BIGINT AS n FROM (SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM hashed) x
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cut AS (SELECT word, n, i, left(word, i::INT) || substr(word, i::INT + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM w) c),
pairs AS (SELECT a.word AS a, b.word AS b FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT cut.word, w.word FROM cut JOIN w ON w.word = cut.rest UNION SELECT w.word, cut.word FROM cut JOIN w ON w.word = cut.rest),
near AS (SELECT p.a AS word, count(*) AS n_near, max(w.n) AS m FROM pairs p JOIN w ON w.word = p.b GROUP BY p.a),
best AS (SELECT near.word, near.n_near, near.m, min(p.b) AS b FROM near JOIN pairs p ON p.a = near.word JOIN w ON w.word = p.b AND w.n = near.m GROUP BY ALL),
form AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * w.n THEN b END AS form, CASE WHEN m >= 2 * w.n THEN m END AS form_n FROM w LEFT JOIN best ON best.word = w.word),
up AS (SELECT word, word AS top, 0 AS step FROM form UNION ALL SELECT up.word, form.form, step + 1 FROM up JOIN form ON form.word = up.top WHERE form.form IS NOT NULL)
SELECT form.word, form.form, root, form.n, form.n_near, form.form_n FROM form JOIN (SELECT word, arg_max(top, step) AS root FROM up GROUP BY word) r ON r.word = form.word
"""


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(*prefix_trie.rebuilt(prefix_trie.numbered(table(spark, sf_dir, "conversations"))))


# Prefixes are told apart by chained digests; a subtree is every node whose owner's path runs through its top.
OP12_SQL = f"""
WITH RECURSIVE {CRC},
t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
k AS (SELECT c, c - c % 100 AS base, {_crc32("list_transform(string_split(c::VARCHAR, ''), lambda x: ord(x)::BIGINT)")} % 6 AS h FROM (SELECT DISTINCT c FROM t) d, crc),
r AS (SELECT k.c, 0 AS part, t.pos, role, text FROM k JOIN t ON t.c = k.base AND t.pos < h UNION ALL SELECT k.c, 1, t.pos, role, text FROM k JOIN t ON t.c = k.c AND t.pos >= h),
s AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, pos) AS d, sha256(length(role) || ' ' || role || text) AS key, length(text) AS chars FROM r),
m AS (SELECT c, 0::BIGINT AS d, '' AS name, 0::BIGINT AS chars FROM k UNION ALL SELECT s.c, s.d, sha256(m.name || s.key), s.chars FROM m JOIN s ON s.c = m.c AND s.d = m.d + 1),
lengths AS (SELECT c, max(d) AS d FROM m GROUP BY c),
n AS (SELECT m.d, m.name, min(m.c) AS owner, count(*) AS n, any_value(chars) AS chars, string_agg(m.c::VARCHAR, ',' ORDER BY m.c) FILTER (l.c IS NOT NULL) AS ends FROM m LEFT JOIN lengths l ON l.c = m.c AND l.d = m.d GROUP BY m.d, m.name),
p AS (SELECT n.*, q.name AS parent FROM n LEFT JOIN m q ON q.c = n.owner AND q.d = n.d - 1),
kids AS (SELECT d - 1 AS d, parent AS name, count(*) AS n_children FROM p WHERE d > 0 GROUP BY ALL),
v AS (SELECT p.*, coalesce(n_children, 0) AS n_children, (n - 1) * chars AS saved FROM p LEFT JOIN kids ON kids.d = p.d AND kids.name = p.name),
sums AS (SELECT m.d, m.name, sum(v.saved)::BIGINT AS saved_tokens, count(*) FILTER (v.n_children = 0) AS n_leaves FROM v JOIN m ON m.c = v.owner AND m.d <= v.d GROUP BY m.d, m.name)
SELECT v.owner AS conv_id, v.d AS depth, up.owner AS parent_conv_id, v.n AS n_convs, v.n_children, n_leaves, saved_tokens, sha256(coalesce(v.ends, '')) AS ends_sha256
FROM v JOIN sums ON sums.d = v.d AND sums.name = v.name LEFT JOIN n up ON up.d = v.d - 1 AND up.name = v.parent
"""


def op13_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id", "kept")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit() and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {"op2_quality_rules": OP2_SQL, "op6_exact_dedup": OP6_SQL, "op7_warc_archive": OP7_SQL, "op11_spelling_variants": OP11_SQL, "op12_conversation_trie": OP12_SQL}
