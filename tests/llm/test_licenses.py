import re

import pytest
from pyspark.sql import functions as F

from stratiform.llm import licenses, queries

PHRASES = queries.LICENSE_PHRASES
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def base_of(text):
    words = WORD.findall(lowered(text))
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        p = phrase.split()
        at = [i for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def detections_of(text, rules):
    text = text or ""
    found = [(m.start(), m.end(), r.priority, i) for i, r in enumerate(rules) for m in re.finditer(r.pattern, text, re.ASCII)]
    found.sort(key=lambda x: (x[0], -x[1], x[2], x[3]))
    kept = []
    for k, (a, b, p, i) in enumerate(found):
        if not any(a2 <= a and b <= b2 and p2 <= p for a2, b2, p2, _ in found[:k]):
            kept.append((a, b, rules[i].label))
    return kept


TEXTS = [
    None, "", "   ", "Released under the MIT License.", "under the mit license under the MIT-license", "munder the mit license", "under the mit licenses", "éunder the mit license",
    "Licensed under CC BY-NC 4.0.", "cc by nc cc by nc", "Licensed under the Apache License, Version 2.0. Apache License version 2", "This work is licensed under the GNU General Public License, version 3.",
    "SPDX-License-Identifier: GPL-2.0-or-later", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "the wordpress licence of none", "x " * 30000 + "Released under the MIT License. " * 40,
    "The BSD 3-Clause License and bsd license; see https://opensource.org/licenses/MIT or CC0-1.0", "Creative Commons Attribution-ShareAlike, cc-by-sa 4.0",
]


def test_there_are_hundreds_of_rules():
    assert len(licenses.rules()) > 200
    assert all(r.keyword == r.keyword.lower() for r in licenses.rules())


def test_against_brute_force(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, "Released under the MIT License.", None), (3, TEXTS[3], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words string")
    scanned = licenses.with_phrases(licenses.scanned(docs), PHRASES)
    got = [(r.doc_id, r.text, r) for r in scanned.collect()]
    assert len(got) == len(rows)
    rules = licenses.rules()
    for _, text, r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, ",".join(r.base_labels)) == base_of(text)
        assert [(d.start, d.stop, d.label) for d in r.detections] == detections_of(text, rules), text[:80]


def test_whole_table(spark):
    d = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    rules = licenses.rules()
    gated = 0
    for r in queries.op3_license_scan(spark, d).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base_of(texts[r.doc_id])
        gated += bool(r.detections)
        if r.doc_id % 10 == 0 or r.detections:
            assert [(x.start, x.stop, x.label) for x in r.detections] == detections_of(texts[r.doc_id], rules)
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
    assert gated > 5


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert licenses.with_phrases(licenses.scanned(docs), PHRASES).count() == 0


def test_suppression_by_containment():
    rules = licenses.rules()
    labels = [x[2] for x in detections_of("Licensed under the Apache License, Version 2.0", rules)]
    assert labels == ["apache-2"]


@pytest.mark.parametrize("text", ["Released under the MIT License."])
def test_score(spark, text):
    row = licenses.scanned(spark.createDataFrame([(1, text)], "doc_id long, text string")).select(licenses.score_of(F.col("detections")).alias("s")).first()
    assert row.s == 0.9


SPACED = {
    "a Creative\nCommons Attribution-ShareAlike licence": "cc-by-sa", "All rights\nreserved.": "all-rights-reserved", "released into the public\n domain": "public-domain",
    "cc\nby-sa 4.0": "cc-by-sa", "cc  by  nc": "cc-by-nc", "the Open\tFont  License": "ofl-1.1", "bsd\n2-clause": "bsd-2", "mit\r\nno\r\nattribution": "mit-0",
    "Permission is hereby granted, free\nof\n  charge, to any person obtaining a copy of this software": "mit", "the software is provided as\x0bis, without warranty of any kind": "warranty-disclaimer",
    "the Expat License": "mit", "the PSF license": "python-2",
    "you may not use this file except in\ncompliance with the License. You may obtain a copy of the License at": "apache-2",
}


def test_words_apart_by_any_white_space(spark):
    rules = licenses.rules()
    docs = spark.createDataFrame(list(enumerate(SPACED)), "doc_id long, text string")
    for r in licenses.scanned(docs).collect():
        found = [(d.start, d.stop, d.label) for d in r.detections]
        assert found == detections_of(r.text, rules) and SPACED[r.text] in [x for _, _, x in found], r.text


@pytest.mark.parametrize(
    "text, label",
    [
        (" * Permission is hereby granted, free of charge, to any\n * person obtaining a copy\n * of this software", "mit"),
        ("# Redistributions of source code must retain the above\n# copyright notice, this list of conditions", "bsd-2"),
        ("// Neither the name of the\n// Example Institute of Things nor the names of its\n// contributors may be used to endorse or promote products", "bsd-3"),
        ("License: Apache-2.0", "apache-2"), ("license = \"MIT\"", "mit"), ("This file is licensed under MIT.", "mit"), ("licensed under the terms of the BSD-3-Clause", "bsd-3"),
        ("all rights\n;; reserved", "all-rights-reserved"), ("free of\n   charge; License:\n  MPL-2.0", "mpl-2"),
    ],
)
def test_headers_as_they_stand_in_files(spark, text, label):
    df = spark.createDataFrame([(1, text), (2, text.replace("MIT", "MITRE").replace("granted", "given"))], "doc_id long, text string")
    rows = {r.doc_id: r for r in licenses.scanned(df).select("doc_id", "detections").collect()}
    assert label in {d.label for d in rows[1].detections}
    assert [(d.start, d.stop, d.label) for d in rows[1].detections] == detections_of(text, licenses.rules())
