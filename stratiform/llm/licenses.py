"""License scans: ordered signature rules gated by keywords, overlaps resolved by priority and interval containment.

DataFrame expressions only. A document is first asked for a few stems (GATES); only where one stands are the rules'
keywords looked up, and only rules whose keyword stands are matched. Both are looked up in a copy in lower case whose
gaps are collapsed, as the rules take words apart by any gap: white space, with a comment's mark in it or without. A detection is suppressed if another one of the
same or a stronger priority contains its interval (of equal intervals the stronger, then the earlier rule stays).
Detections are resolved within the row, so nothing is shuffled and any text stays in its task.

Phrases are a plainer layer on top: fixed word sequences whose places are counted in words; no detection suppresses them.

Cases: a null text counts as empty (no words, no labels, score 0); texts of any length are scanned whole; repeated rows
are scanned alike; an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import functools
import operator
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Word characters are all but these; A-Z count as words here because texts are matched without regard to ASCII case.
_SEPARATORS = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
WORD_CHAR, SEPARATOR = f"[^{_SEPARATORS}]", f"[{_SEPARATORS}]"
FULL_TEXT, GRANT, MENTION = 1, 2, 3
WEIGHTS = {FULL_TEXT: 1.0, GRANT: 0.9, MENTION: 0.6}
PHRASE_WEIGHT = 0.95


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    keyword: str  # in lower case, words apart by one blank; a text without it cannot match, however its words are spaced
    pattern: str  # Java regex, ASCII case ignored


#: label, keyword, the names it goes by, SPDX identifiers
NAMES = (
    ("mit", "licen", r"(?:the )?mit(?:/x11| x11|/expat)? licen[cs]e|expat licen[cs]e", r"MIT"),
    ("mit-0", "mit", r"mit no attribution(?: licen[cs]e)?", r"MIT-0"),
    ("apache-2", "apache", r"apache(?: software)? licen[cs]e,?(?: version| v\.?)? ?2(?:\.0)?", r"Apache-2\.0"),
    ("apache-1.1", "apache", r"apache(?: software)? licen[cs]e,?(?: version| v\.?)? ?1\.1", r"Apache-1\.1"),
    ("gpl-1", "gnu", r"gnu general public licen[cs]e,?(?: version| v\.?)? ?1(?:\.0)?", r"GPL-1\.0(?:-only|-or-later|\+)?"),
    ("gpl-2", "gnu", r"gnu general public licen[cs]e,?(?: version| v\.?)? ?2(?:\.0)?", r"GPL-2\.0(?:-only|-or-later|\+)?"),
    ("gpl-3", "gnu", r"gnu general public licen[cs]e,?(?: version| v\.?)? ?3(?:\.0)?", r"GPL-3\.0(?:-only|-or-later|\+)?"),
    ("gpl", "gnu", r"gnu general public licen[cs]e", r"GPL"),
    ("gpl-2", "gpl", r"gpl[ -]?v?2(?:\.0)?", r"GPLv2\+?"),
    ("gpl-3", "gpl", r"gpl[ -]?v?3(?:\.0)?", r"GPLv3\+?"),
    ("lgpl-2.1", "lesser", r"gnu lesser general public licen[cs]e,?(?: version| v\.?)? ?2\.1", r"LGPL-2\.1(?:-only|-or-later|\+)?"),
    ("lgpl-3", "lesser", r"gnu lesser general public licen[cs]e,?(?: version| v\.?)? ?3(?:\.0)?", r"LGPL-3\.0(?:-only|-or-later|\+)?"),
    ("lgpl-2", "library", r"gnu library general public licen[cs]e,?(?: version| v\.?)? ?2(?:\.0)?", r"LGPL-2\.0(?:-only|-or-later|\+)?"),
    ("lgpl", "lgpl", r"lgpl(?:[ -]?v?[23](?:\.[01])?)?", r"LGPL"),
    ("agpl-3", "affero", r"gnu affero general public licen[cs]e,?(?: version| v\.?)? ?3(?:\.0)?", r"AGPL-3\.0(?:-only|-or-later|\+)?"),
    ("agpl", "agpl", r"agpl(?:[ -]?v?3)?", r"AGPL"),
    ("fdl", "free documentation", r"gnu free documentation licen[cs]e(?:,? version 1\.[0-3])?", r"GFDL-1\.[1-3](?:-only|-or-later)?"),
    ("bsd-2", "bsd", r"(?:simplified|freebsd|2[- ]clause) bsd licen[cs]e|bsd 2[- ]clause(?: licen[cs]e)?", r"BSD-2-Clause"),
    ("bsd-3", "bsd", r"(?:new|revised|modified|3[- ]clause) bsd licen[cs]e|bsd 3[- ]clause(?: licen[cs]e)?", r"BSD-3-Clause"),
    ("bsd-4", "bsd", r"(?:original|4[- ]clause) bsd licen[cs]e|bsd 4[- ]clause(?: licen[cs]e)?", r"BSD-4-Clause"),
    ("bsd", "bsd", r"bsd(?:-style)? licen[cs]e", r"BSD"),
    ("0bsd", "bsd", r"(?:zero[- ]clause|0[- ]clause) bsd|0bsd", r"0BSD"),
    ("isc", "isc", r"isc licen[cs]e", r"ISC"),
    ("mpl-1.1", "mozilla", r"mozilla public licen[cs]e,?(?: version| v\.?)? ?1\.1", r"MPL-1\.1"),
    ("mpl-2", "mozilla", r"mozilla public licen[cs]e,?(?: version| v\.?)? ?2(?:\.0)?", r"MPL-2\.0"),
    ("mpl", "mozilla", r"mozilla public licen[cs]e", r"MPL"),
    ("epl-1", "eclipse", r"eclipse public licen[cs]e,?(?: version| v\.?| -)? ?(?:v ?)?1(?:\.0)?", r"EPL-1\.0"),
    ("epl-2", "eclipse", r"eclipse public licen[cs]e,?(?: version| v\.?| -)? ?(?:v ?)?2(?:\.0)?", r"EPL-2\.0"),
    ("edl", "eclipse", r"eclipse distribution licen[cs]e(?: 1\.0)?", r"EDL-1\.0"),
    ("cddl-1", "cddl", r"cddl(?:[ -]?1\.[01])?", r"CDDL-1\.[01]"),
    ("cddl-1", "common development", r"common development and distribution licen[cs]e", r"CDDL"),
    ("cpl", "common public", r"common public licen[cs]e(?:,? version 1\.0)?", r"CPL-1\.0"),
    ("eupl", "eupl", r"eupl(?:[ -]?v?1\.[0-2])?", r"EUPL-1\.[0-2]"),
    ("eupl", "european union public", r"european union public licen[cs]e", r"EUPL"),
    ("artistic-1", "artistic", r"artistic licen[cs]e,?(?: version)? ?1(?:\.0)?", r"Artistic-1\.0"),
    ("artistic-2", "artistic", r"artistic licen[cs]e,?(?: version)? ?2(?:\.0)?", r"Artistic-2\.0"),
    ("artistic", "artistic", r"artistic licen[cs]e", r"Artistic"),
    ("boost-1", "boost", r"boost software licen[cs]e(?:,? (?:- )?version 1\.0)?", r"BSL-1\.0"),
    ("bsl-1.1", "business source", r"business source licen[cs]e(?: 1\.1)?", r"BUSL-1\.1"),
    ("zlib", "zlib", r"zlib(?:/libpng)? licen[cs]e", r"Zlib"),
    ("libpng", "libpng", r"libpng licen[cs]e", r"Libpng"),
    ("openssl", "openssl", r"openssl licen[cs]e", r"OpenSSL"),
    ("php-3", "php", r"php licen[cs]e,?(?: version)?(?: ?3\.0[01]?)?", r"PHP-3\.0[01]?"),
    ("python-2", "licen", r"python software foundation licen[cs]e|psf licen[cs]e", r"Python-2\.0|PSF-2\.0"),
    ("ruby", "ruby", r"ruby licen[cs]e", r"Ruby"),
    ("postgresql", "postgresql", r"postgresql licen[cs]e", r"PostgreSQL"),
    ("ms-pl", "microsoft", r"microsoft public licen[cs]e", r"MS-PL"),
    ("ms-rl", "microsoft", r"microsoft reciprocal licen[cs]e", r"MS-RL"),
    ("unlicense", "unlicense", r"the unlicense", r"Unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl", r"WTFPL"),
    ("sspl-1", "server side public", r"server side public licen[cs]e", r"SSPL-1\.0"),
    ("elastic-2", "elastic", r"elastic licen[cs]e(?: 2\.0)?", r"Elastic-2\.0"),
    ("osl-3", "open software", r"open software licen[cs]e(?: v?\.? ?3\.0)?", r"OSL-3\.0"),
    ("afl-3", "academic free", r"academic free licen[cs]e(?: v?\.? ?3\.0)?", r"AFL-3\.0"),
    ("ofl-1.1", "open font", r"(?:sil )?open font licen[cs]e(?:,? version 1\.1)?", r"OFL-1\.1"),
    ("w3c", "w3c", r"w3c software (?:notice and )?licen[cs]e", r"W3C"),
    ("ncsa", "ncsa", r"(?:university of illinois/)?ncsa open source licen[cs]e", r"NCSA"),
    ("upl-1", "universal permissive", r"universal permissive licen[cs]e", r"UPL-1\.0"),
    ("bluespec", "blue oak", r"blue oak model licen[cs]e", r"BlueOak-1\.0\.0"),
    ("odbl", "open database", r"open(?: data commons open)? database licen[cs]e", r"ODbL-1\.0"),
    ("odc-by", "open data commons", r"open data commons attribution licen[cs]e", r"ODC-By-1\.0"),
    ("pddl", "public domain dedication", r"(?:open data commons )?public domain dedication and licen[cs]e", r"PDDL-1\.0"),
    ("cc0", "cc0", r"cc0(?:[ -]1\.0)?", r"CC0-1\.0"),
    ("cc-by-nc-nd", "cc", r"cc[ -]by[ -]nc[ -]nd(?:[ -][1-4]\.[0-9])?", r"CC-BY-NC-ND-[1-4]\.[0-9]"),
    ("cc-by-nc-sa", "cc", r"cc[ -]by[ -]nc[ -]sa(?:[ -][1-4]\.[0-9])?", r"CC-BY-NC-SA-[1-4]\.[0-9]"),
    ("cc-by-nc", "cc", r"cc[ -]by[ -]nc(?:[ -][1-4]\.[0-9])?", r"CC-BY-NC-[1-4]\.[0-9]"),
    ("cc-by-nd", "cc", r"cc[ -]by[ -]nd(?:[ -][1-4]\.[0-9])?", r"CC-BY-ND-[1-4]\.[0-9]"),
    ("cc-by-sa", "cc", r"cc[ -]by[ -]sa(?:[ -][1-4]\.[0-9])?", r"CC-BY-SA-[1-4]\.[0-9]"),
    ("cc-by", "cc", r"cc[ -]by(?:[ -][1-4]\.[0-9])?", r"CC-BY-[1-4]\.[0-9]"),
    ("cc-by-nc-nd", "creative commons", r"creative commons attribution[ -]non[ -]?commercial[ -]no[ -]?deriv(?:ative)?s", r"CC-BY-NC-ND"),
    ("cc-by-nc-sa", "creative commons", r"creative commons attribution[ -]non[ -]?commercial[ -]share[ -]?alike", r"CC-BY-NC-SA"),
    ("cc-by-nc", "creative commons", r"creative commons attribution[ -]non[ -]?commercial", r"CC-BY-NC"),
    ("cc-by-nd", "creative commons", r"creative commons attribution[ -]no[ -]?deriv(?:ative)?s", r"CC-BY-ND"),
    ("cc-by-sa", "creative commons", r"creative commons attribution[ -]share[ -]?alike", r"CC-BY-SA"),
    ("cc-by", "creative commons", r"creative commons attribution", r"CC-BY"),
)

#: label, keyword, sentences of the license itself or of its usual header
SENTENCES = (
    ("mit", "free of charge", r"permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("mit", "substantial portions", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("isc", "permission to use", r"permission to use, copy, modify, and(?:/or)? distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd-2", "redistributions", r"redistributions of source code must retain the above copyright notice, this list of conditions"),
    ("bsd-3", "endorse or promote", r"neither the name of [\s\S]{1,80}? nor the names of its contributors may be used to endorse or promote products"),
    ("bsd-4", "advertising materials", r"all advertising materials mentioning features or use of this software must display"),
    ("apache-2", "apache", r"licensed under the apache licen[cs]e, version 2\.0 \(the .licen[cs]e.\)"),
    ("apache-2", "in compliance with", r"you may not use this file except in compliance with the licen[cs]e\. you may obtain a copy of the licen[cs]e at"),
    ("gpl", "free software", r"this program is free software[;:,] you can redistribute it and/or modify it under the terms of the gnu general public licen[cs]e"),
    ("gpl", "general public", r"you should have received a copy of the gnu general public licen[cs]e along with"),
    ("lgpl", "lesser", r"you should have received a copy of the gnu lesser general public licen[cs]e along with"),
    ("agpl", "affero", r"you should have received a copy of the gnu affero general public licen[cs]e along with"),
    ("mpl-2", "mozilla", r"this source code form is subject to the terms of the mozilla public licen[cs]e, v\. 2\.0"),
    ("epl-2", "eclipse", r"this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e"),
    ("boost-1", "boost", r"distributed under the boost software licen[cs]e, version 1\.0"),
    ("zlib", "origin of this software", r"the origin of this software must not be misrepresented; you must not claim that you wrote the original software"),
    ("unlicense", "public domain", r"this is free and unencumbered software released into the public domain"),
    ("public-domain", "public domain", r"(?:dedicated|released|placed) (?:in|to|into) the public domain"),
    ("cc0", "waive", r"to the extent possible under law, [\s\S]{1,80}? has waived all copyright"),
    ("ofl-1.1", "font", r"this font software is licensed under the sil open font licen[cs]e"),
    ("all-rights-reserved", "all rights reserved", r"all rights reserved"),
    ("proprietary", "proprietary", r"(?:confidential and proprietary|proprietary and confidential)"),
    ("proprietary", "unauthorized", r"unauthorized (?:copying|reproduction|use|distribution) of this (?:file|software|work)"),
    ("warranty-disclaimer", "warranty", r"(?:software|work) is provided .{0,4}as is.{0,4},? without warranty of any kind"),
)

#: label, keyword, addresses
ADDRESSES = (
    ("mit", "licenses/mit", r"opensource\.org/licenses/mit"),
    ("apache-2", "license-2.0", r"apache\.org/licenses/license-2\.0"),
    ("gpl", "gnu.org/licenses", r"gnu\.org/licenses/(?:old-licenses/)?gpl"),
    ("lgpl", "gnu.org/licenses", r"gnu\.org/licenses/(?:old-licenses/)?lgpl"),
    ("agpl", "gnu.org/licenses", r"gnu\.org/licenses/agpl"),
    ("mpl-2", "mozilla.org", r"mozilla\.org/(?:en-us/)?mpl/2\.0"),
    ("bsd-3", "bsd-3-clause", r"opensource\.org/licenses/bsd-3-clause"),
    ("bsd-2", "bsd-2-clause", r"opensource\.org/licenses/bsd-2-clause"),
    ("cc0", "publicdomain/zero", r"creativecommons\.org/publicdomain/zero/1\.0"),
    ("cc-by", "licenses/by/", r"creativecommons\.org/licenses/by/[1-4]\.[0-9]"),
    ("cc-by-sa", "licenses/by-sa/", r"creativecommons\.org/licenses/by-sa/[1-4]\.[0-9]"),
    ("cc-by-nc", "licenses/by-nc/", r"creativecommons\.org/licenses/by-nc/[1-4]\.[0-9]"),
    ("cc-by-nd", "licenses/by-nd/", r"creativecommons\.org/licenses/by-nd/[1-4]\.[0-9]"),
    ("cc-by-nc-sa", "licenses/by-nc-sa/", r"creativecommons\.org/licenses/by-nc-sa/[1-4]\.[0-9]"),
    ("cc-by-nc-nd", "licenses/by-nc-nd/", r"creativecommons\.org/licenses/by-nc-nd/[1-4]\.[0-9]"),
)

#: One of these stands in every text that a rule can match, once its white space is collapsed.
GATES = ("licen", "spdx", "copyright", "public domain", "gpl", "cc0", "cc by", "cc-by", "creative commons", "creativecommons", "cddl", "wtfpl", "eupl", "0bsd", "bsd 2", "bsd 3", "bsd 4", "clause bsd", "permission", "redistribut", "endorse", "advertising materials", "origin of this software", "mit no attribution", "mozilla.org", "rights reserved", "proprietary", "unauthorized", "as is", "publicdomain")
_GRANT = r"(?:licen[cs]ed|released|distributed|available|published|provided|offered|covered)(?: [a-z]+)? (?:under|by)(?: the)?(?: terms of(?: the)?)? "


#: Marks with which a comment's lines begin. White space with one of them between, and white space after it, is a gap as well, so
#: that headers match as they stand in source files.
MARKS = r"[*#/;!%>|]{1,3}"
GAP = rf"\s+(?:{MARKS}\s+)?"


def _spaced(pattern: str) -> str:
    """Every blank stands for a gap, also the one that a hyphen may replace."""
    for either in ("[ -]", "[- ]"):
        pattern = pattern.replace(either, r"(?: |-)")
    return pattern.replace(" ", GAP)


def _stem(ids: str) -> str:
    """The letters, digits and hyphens with which an identifier begins, in lower case."""
    return re.match(r"[A-Za-z0-9-]+", ids)[0].lower()


def rules() -> tuple[Rule, ...]:
    """All rules in their order, stronger ones first."""
    edge = lambda p: rf"(?i)(?<![0-9A-Za-z])(?:{p})(?![0-9A-Za-z])"
    found = [Rule(label, FULL_TEXT, kw, edge(_spaced(p))) for label, kw, p in SENTENCES]
    found += [Rule(label, FULL_TEXT, "spdx-license-identifier", edge(rf"spdx-license-identifier:\s*(?:{ids})")) for label, _, _, ids in NAMES]
    found += [Rule(label, GRANT, kw, edge(p)) for label, kw, p in ADDRESSES]
    named = lambda ids: rf"(?:licen[cs]e\s*[:=]\s*[\"']?|{_spaced('licen[cs]ed(?: [a-z]+)? under(?: the)?(?: terms of(?: the)?)? ')})(?:{ids})"
    found += [Rule(label, GRANT, _stem(ids), edge(named(ids))) for label, _, _, ids in NAMES]
    found += [Rule(label, GRANT, kw, edge(_spaced(f"{_GRANT}(?:{p})"))) for label, kw, p, _ in NAMES]
    found += [Rule(label, MENTION, kw, edge(_spaced(p))) for label, kw, p, _ in NAMES]
    return tuple(found)


def _rule_array(of: tuple[Rule, ...]) -> Column:
    field = lambda i, r: F.struct(F.lit(i).alias("rule"), F.lit(r.priority).alias("priority"), F.lit(r.keyword).alias("keyword"), F.lit(r.pattern).alias("pattern"), F.lit(r.label).alias("label"))
    return F.array(*(field(i, r) for i, r in enumerate(of)))


_FOUND = "struct<start:int,back:int,priority:int,rule:int,stop:int,label:string>"


def _matches(text: Column, rule: Column) -> Column:
    """Every match of one rule: what stands between matches and the matches themselves give their places."""
    hits = F.regexp_extract_all(text, rule["pattern"], F.lit(0))
    parts = F.filter(F.arrays_zip(F.split(text, rule["pattern"], -1), hits), lambda x: x["1"].isNotNull())

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["0"])
        stop = start + F.length(x["1"])
        one = F.struct(start.alias("start"), (-stop).alias("back"), rule["priority"].alias("priority"), rule["rule"].alias("rule"), stop.alias("stop"), rule["label"].alias("label"))
        return F.struct(stop.alias("at"), F.concat(state["found"], F.array(one.cast(_FOUND))).alias("found"))

    none = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_FOUND}>").alias("found"))
    return F.when(F.size(hits) > 0, F.aggregate(parts, none, step)["found"]).otherwise(F.array().cast(f"array<{_FOUND}>"))


def resolved(found: Column) -> Column:
    """Detections that no other one of the same or a stronger priority contains."""

    def step(state: Column, x: Column) -> Column:
        reach = F.when(x["priority"] == FULL_TEXT, state["m1"]).when(x["priority"] == GRANT, F.greatest(state["m1"], state["m2"])).otherwise(F.greatest(state["m1"], state["m2"], state["m3"]))
        up = lambda p, m: F.when(x["priority"] == p, F.greatest(state[m], x["stop"])).otherwise(state[m]).alias(m)
        kept = F.when(reach >= x["stop"], state["kept"]).otherwise(F.concat(state["kept"], F.array(x)))
        return F.struct(up(FULL_TEXT, "m1"), up(GRANT, "m2"), up(MENTION, "m3"), kept.alias("kept"))

    start = F.struct(F.lit(-1).alias("m1"), F.lit(-1).alias("m2"), F.lit(-1).alias("m3"), F.array().cast(f"array<{_FOUND}>").alias("kept"))
    return F.aggregate(F.array_sort(found), start, step)["kept"]


def collapsed(text: Column) -> Column:
    """Single blanks for gaps; single blanks are passed over, so that most texts are hardly rewritten."""
    return F.regexp_replace(text, rf"[\t-\r]\s*(?:{MARKS}\s+)?| \s+(?:{MARKS}\s+)?| {MARKS}\s+", " ")


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", of: tuple[Rule, ...] | None = None) -> DataFrame:
    """Id, text and ``detections``: start, stop, label, rule, priority of every detection that is not suppressed."""
    of = rules() if of is None else of
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias(id_col), text.alias("__text"), collapsed(F.lower(text)).alias("__low"))
    gate = F.lit(False)
    for g in GATES:
        gate = gate | F.contains("__low", F.lit(g))
    able = F.filter(_rule_array(of), lambda r: F.contains(F.col("__low"), r["keyword"]))
    found = F.when(gate, resolved(F.flatten(F.transform(able, lambda r: _matches(F.col("__text"), r)))))
    detections = F.transform(F.coalesce(found, F.array().cast(f"array<{_FOUND}>")), lambda x: F.struct(*(x[c].alias(c) for c in ("start", "stop", "label", "rule", "priority"))))
    return rows.select(id_col, F.col("__text").alias("text"), detections.alias("detections"))


def labels_of(detections: Column) -> Column:
    return F.array_distinct(F.transform(detections, lambda x: x["label"]))


def score_of(detections: Column) -> Column:
    weight = lambda x: F.when(x["priority"] == FULL_TEXT, WEIGHTS[FULL_TEXT]).when(x["priority"] == GRANT, WEIGHTS[GRANT]).otherwise(WEIGHTS[MENTION])
    return F.coalesce(F.array_max(F.transform(detections, weight)), F.lit(0.0))


def n_words(text: Column) -> Column:
    """What stands between separators, counted: far cheaper than finding runs of all other characters."""
    return F.coalesce(F.size(F.array_remove(F.split(text, f"{SEPARATOR}+"), "")), F.lit(0)).cast("long")


def phrase_places(text: Column, phrase: str, words: Column) -> Column:
    """struct(n, first, last): where a phrase's words stand consecutively; first and last are word numbers."""
    first, *rest = (re.escape(w) for w in phrase.split())
    after = "".join(f"{SEPARATOR}+{w}" for w in rest)
    pattern = f"(?i)(?<!{WORD_CHAR}){first}(?={after}(?!{WORD_CHAR}))"
    gaps = F.split(text, pattern, -1)
    n = (F.size(gaps) - 1).cast("long")
    last = words - n_words(F.element_at(gaps, -1)) - 1
    found = F.struct(n.alias("n"), n_words(F.element_at(gaps, 1)).alias("first"), last.alias("last"))
    none = F.lit(None).cast("long")
    low = F.lower(text)  # the pattern is tried only where all of the phrase's words stand somewhere
    able = F.exists(F.array(low), lambda x: functools.reduce(operator.and_, (F.contains(x, F.lit(w)) for w in sorted(phrase.split(), key=len, reverse=True))))
    return F.when(able & text.rlike(pattern), found).otherwise(F.struct(F.lit(0).cast("long").alias("n"), none.alias("first"), none.alias("last")))


def with_phrases(rows: DataFrame, phrases: dict[str, str], text_col: str = "text") -> DataFrame:
    """Adds n_words, n_base, first_word, last_word and base_labels (an array) for phrases {phrase: label}."""
    rows = rows.withColumn("n_words", n_words(F.col(text_col)))
    for i, p in enumerate(phrases):
        rows = rows.withColumn(f"__p{i}", phrase_places(F.col(text_col), p, F.col("n_words")))
    each = [f"__p{i}" for i in range(len(phrases))]
    pick = lambda f, end: f(*(F.col(f"{c}.{end}") for c in each)) if len(each) > 1 else F.col(f"{each[0]}.{end}")
    rows = rows.withColumns(
        {
            "n_base": sum((F.col(f"{c}.n") for c in each[1:]), F.col(f"{each[0]}.n")),
            "first_word": pick(F.least, "first"),
            "last_word": pick(F.greatest, "last"),
            "base_labels": F.array_sort(F.array_distinct(F.array_compact(F.array(*(F.when(F.col(f"{c}.n") > 0, label) for c, label in zip(each, phrases.values(), strict=True)))))),
        }
    )
    return rows.drop(*each)
