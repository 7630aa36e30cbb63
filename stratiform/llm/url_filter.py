"""URL filters: domain rules first, then logistic regression on hashed character n-grams of host and path, which have norms of their own.

The model is fitted on the driver from a small labelled table of urls, given as a DataFrame, of which at most
MAX_TRAIN_ROWS rows are used (the documented bound); its 2 * 2**HASH_BITS weights, 1 MB, go to the executors with the function
that scores. N-grams of 3 to 5 bytes are hashed for a whole Arrow batch at once. Classes are balanced while fitting and
the bias is then moved to ``PRIOR``, the share of unwanted urls expected, so that names of no known kind are allowed. Where
no labelled table is at hand, ``seed_urls`` makes one by rule from general vocabulary.

Cases: null urls and urls without ``://`` have an empty host and path, no n-grams and so the model's prior; urls of any
length are judged whole; repeated rows are judged alike; an empty table gives an empty result. Only the url column is
read, and the judgement's columns are added to the named ones. Of rules of equal length that fit, a blocking one wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii

HASH_BITS, SIZES = 16, (3, 4, 5)
MAX_TRAIN_ROWS, PRIOR, HOST_SHARE = 20_000, 0.35, 0.15


@dataclass(frozen=True)
class DomainRule:
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: Words that names of unwanted and of ordinary sites are made of.
UNWANTED_WORDS = (
    "casino", "poker", "roulette", "blackjack", "jackpot", "slots", "gambling", "betting", "wager", "lottery", "bingo", "viagra", "cialis", "pharmacy", "pharma", "pills", "steroids",
    "payday", "loans", "credit", "forex", "crypto", "giveaway", "prizes", "porn", "xxx", "adult", "sex", "escort", "webcam", "dating", "nude", "malware", "warez", "crack", "keygen",
    "torrent", "serials", "phishing", "spam", "popup", "clickbait", "adserver", "banner", "tracker", "affiliate", "replica", "knockoff", "followers", "backlinks", "seo", "slimming",
)
PITCHES = (
    "best", "best-", "my", "get-", "buy-", "online-", "-now", "4u", "-deals", "-bonus", "-vip", "zone", "-24", "hub", "hot-", "mega-", "royal-", "lucky-", "super-", "vip-", "-cash", "-365", "-offers",
    "-discount", "-jackpots", "-rewards", "top-", "-shop", "-club",
)
ORDINARY_WORDS = (
    "library", "university", "research", "news", "council", "museum", "cooking", "recipes", "garden", "wiki", "docs", "science", "history", "weather", "travel", "books", "journal",
    "school", "health", "music", "photo", "football", "architecture", "astronomy", "biology", "chess", "hiking", "railway", "theatre", "village", "workshop", "bakery", "river", "mountain",
    "forest", "harbour", "market", "bridge", "castle", "church", "island", "winter", "summer", "morning", "letters", "poetry", "painting", "pottery", "textile", "engine", "physics",
    "chemistry", "algebra", "geometry", "language", "grammar", "dictionary", "atlas", "archive", "gazette", "tribune", "herald", "observer", "institute", "academy", "college", "society",
    "foundation", "hospital", "clinic", "veterinary", "farming", "orchard", "vineyard", "brewery", "kitchen", "restaurant", "hotel", "station", "airport", "ferry", "bicycle", "carpentry",
    "hardware", "software", "network", "database", "compiler", "kernel", "browser", "terminal", "printer", "camera", "telescope", "microscope", "thermometer", "calendar", "almanac",
)
SETTINGS = ("the", "the-", "our", "old-", "new-", "city-", "-city", "-online", "-today", "s", "-guide", "-review", "-club", "-shop", "house", "-2020", "lab", "land")
#: Paths, drawn alike for both labels: what a path says of a site's kind is for the labelled table to tell, not for this rule.
PATHS = (
    "", "/", "/about", "/contact", "/blog/2019/05/walk", "/docs/index.html", "/article/12", "/page/3", "/item/7", "/index.html", "/en/home", "/de/artikel", "/fr/accueil", "/es/inicio", "/map",
    "/signup", "/join-now", "/buy/now", "/offer", "/promo", "/go/click", "/live", "/free", "/en/4711", "/de/815", "/fr/60", "/es/19", "/a/b/c", "/img/logo.png", "/user/profile", "/tag/new",
)
PREFIXES, SUFFIXES = ("", "www.", "m.", "blog."), (".com", ".net", ".org", ".info", ".co.uk", ".wordpress.com", ".github.io", ".blogspot.com", ".web.app", ".sites.org", ".hosting.net")


def _named(word: str, affix: str) -> str:
    """An affix that begins with a hyphen or is short ends the name, others begin it."""
    return word + affix if affix.startswith("-") or affix in ("s", "4u", "zone", "hub", "land", "house", "lab") else affix + word


def seed_urls(without: tuple[str, ...] = ()) -> list[tuple[str, int]]:
    """A labelled table by rule: each word alone and with each affix, in turn under prefixes, domains and two paths; 1 is unwanted.

    Words of ``without`` are left out, so that a model can be tried on kinds of names that it never saw.
    """
    rows = []
    for label, words, affixes in ((1, UNWANTED_WORDS, PITCHES), (0, ORDINARY_WORDS, SETTINGS)):
        for i, word in enumerate(words):
            if word not in without:
                for k, name in enumerate([word, *(_named(word, a) for a in affixes)]):
                    host = f"https://{PREFIXES[(i + k) % 4]}{name}{SUFFIXES[(i + 5 * k) % len(SUFFIXES)]}"
                    rows += [(host + PATHS[(7 * i + 3 * k + 11 * j) % len(PATHS)], label) for j in range(2)]
    return rows


def host_of(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    """After the first ``://``, else empty."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def split_url(url: str | None) -> tuple[str, str]:
    """Host and path of one url, as the columns give them."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = min((rest.find(c) % (len(rest) + 1) for c in "/?#"), default=len(rest))
    stop = min((rest.find(c, end) % (len(rest) + 1) for c in "?#"), default=len(rest))
    return rest[:end].translate({c: c + 32 for c in range(65, 91)}), rest[end:stop]


def matched_rule(host: Column, path: Column, rules: tuple[DomainRule, ...]) -> Column:
    """The longest rule that fits, as struct(rule, verdict), or null; a rule fits its host and all subdomains."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.text), r.verdict == "block", r.text)):
        fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def features(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of every n-gram; no n-gram spans two rows."""
    width = max(SIZES)
    data = np.frombuffer(b"".join(p + b"\x00" * width for p in parts), np.uint8).astype(np.uint64)
    owner = np.repeat(np.arange(len(parts)), [len(p) + width for p in parts])
    rows, cols = [], []
    with np.errstate(over="ignore"):
        for n in SIZES:
            if len(data) < n:
                continue
            h, whole = np.full(len(data) - n + 1, n, np.uint64), np.ones(len(data) - n + 1, bool)
            for k in range(n):
                piece = data[k : len(data) - n + 1 + k]
                h = (h ^ piece) * np.uint64(0x100000001B3)
                whole &= piece != 0
            h ^= h >> np.uint64(29)
            h *= np.uint64(0x9E3779B97F4A7C15)
            rows.append(owner[: len(h)][whole])
            cols.append((h >> np.uint64(64 - HASH_BITS))[whole].astype(np.int64))
    return np.concatenate(rows), np.concatenate(cols)


def _parts(hosts: list[str | None], paths: list[str | None]) -> tuple[list[bytes], list[bytes]]:
    """Hosts between marks, and paths; both empty where there is nothing."""
    clean = lambda x: (x or "").encode("utf-8", "replace").replace(b"\x00", b"\x01")
    return [b"^" + h + b"$" if h else b"" for h in map(clean, hosts)], list(map(clean, paths))


def _shares(row: np.ndarray, n: int, is_path: bool) -> np.ndarray:
    """What each n-gram counts. In a host all count alike, since a telling word tells as much in a long name; paths, which may
    be of any length, are normed by the root of their number of n-grams."""
    if not is_path:
        return np.full(len(row), HOST_SHARE)
    return (1 / np.sqrt(np.maximum(np.bincount(row, minlength=n), 1)))[row]


def _total(parts: list[bytes], weights: np.ndarray, is_path: bool) -> np.ndarray:
    row, col = features(parts)
    return np.bincount(row, weights[col] * _shares(row, len(parts), is_path), minlength=len(parts))


@dataclass(frozen=True)
class UrlModel:
    """Host and path have weights and norms of their own, so that a long path does not drown a telling host."""

    host: np.ndarray
    path: np.ndarray
    bias: float

    def scores(self, hosts: list[str | None], paths: list[str | None]) -> np.ndarray:
        """The probability that each url is unwanted."""
        if not len(hosts):
            return np.zeros(0)
        h, p = _parts(hosts, paths)
        return 1 / (1 + np.exp(-np.clip(self.bias + _total(h, self.host, False) + _total(p, self.path, True), -30, 30)))


def fit(rows: list[tuple[str, int]], steps: int = 600, rate: float = 8.0, penalty: float = 1e-5) -> UrlModel:
    """Logistic regression by gradient descent with momentum, over rows (url, 1 for unwanted) in a fixed order."""
    if len({label for _, label in rows}) < 2:  # nothing to tell apart: every score is the prior
        return UrlModel(np.zeros(1 << HASH_BITS), np.zeros(1 << HASH_BITS), float(np.log(PRIOR / (1 - PRIOR))))
    rows = sorted(rows)
    hosts, paths = zip(*(split_url(u) for u, _ in rows), strict=True)
    y = np.array([label for _, label in rows], float)
    sides = []
    for k, part in enumerate(_parts(list(hosts), list(paths))):
        row, col = features(part)
        sides.append((row, col + (k << HASH_BITS), _shares(row, len(rows), k == 1)))
    row, col, value = (np.concatenate(x) for x in zip(*sides, strict=True))
    balance = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    size = 2 << HASH_BITS
    w, b, v, vb = np.zeros(size), 0.0, np.zeros(size), 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(np.bincount(row, w[col] * value, minlength=len(y)) + b)))
        e = balance * (p - y) / len(y)
        v = 0.9 * v - rate * (np.bincount(col, e[row] * value, minlength=size) + penalty * w)
        vb = 0.9 * vb - rate * e.sum()
        w, b = w + v, b + vb
    return UrlModel(w[: 1 << HASH_BITS], w[1 << HASH_BITS :], b + float(np.log(PRIOR / (1 - PRIOR))))


def training_rows(labelled: DataFrame, url_col: str = "url", label_col: str = "label", seed: int = 1) -> list[tuple[str, int]]:
    """MAX_TRAIN_ROWS labelled urls at most, chosen by hash."""
    picked = labelled.where(F.col(url_col).isNotNull() & F.col(label_col).isNotNull()).select(F.col(url_col).alias("u"), F.col(label_col).cast("int").alias("y"))
    return [(r["u"], r["y"]) for r in picked.orderBy(F.xxhash64("u", F.lit(seed)), "u", "y").limit(MAX_TRAIN_ROWS).collect()]


def judged(pages: DataFrame, rules: tuple[DomainRule, ...], model: UrlModel, url_col: str = "url", keep: tuple[str, ...] = ("page_id",), threshold: float = 0.5) -> DataFrame:
    """The kept columns, host, path, rule, verdict and the model's score of every url."""
    url = F.col(url_col).cast("string")

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for hosts, paths in batches:
            yield pd.Series(model.scores(hosts.tolist(), paths.tolist()))

    rows = pages.select(*keep, host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.withColumn("__rule", matched_rule(F.col("host"), F.col("path"), rules)).withColumn("score", score("host", "path"))
    verdict = F.coalesce(F.col("__rule.verdict"), F.when(F.col("score") >= threshold, "block").otherwise("allow"))
    rows = rows.select(*keep, F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), F.col("__rule.rule").alias("rule"), verdict.alias("verdict"), "score")
    return rows

