from stratiform.llm import neardup, queries


def brute(rows, percent):
    sets = {}
    for i, t in rows:
        w = neardup.words_of(None if t is None else t.encode())
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    ids, up = sorted(sets), {i: i for i in sets}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((find(a), find(b)))
                    up[y] = x
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def test_whole_table_against_brute_force(spark):
    d = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in queries.op4_minhash_neardup(spark, d).collect()}
    assert got == brute(rows, 85)


def test_large_bucket_of_variants(spark):
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(base[:k] + [f"x{i}"] + base[k + 1 :])) for i, k in enumerate(range(5, 65))]
    rows += [(100, None), (101, ""), (102, "one two"), (103, "ONE  two")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.near_groups(docs, 85).collect()}
    assert got == brute(rows, 85)


def test_empty_and_null_ids(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f")], "doc_id long, text string")
    assert [r.kept for r in neardup.near_groups(docs).collect()] == [True, True]
    assert neardup.near_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0
