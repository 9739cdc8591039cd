"""Similarity of names, confidence of matches, and search variants of a title."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from . import lanes
from .text import norm, once, py_norm

#: Thresholds and weights of matches.
ACCEPT, ACCEPT_LAX, VARIANT_WEIGHT = 0.82, 0.90, 0.8
SAME_YEAR, OTHER_YEAR = 0.04, -0.10
#: Leading articles; roman numerals from two to ten.
ARTICLES = ("the ", "a ", "an ", "el ", "la ", "los ", "las ", "un ", "una ")
ROMAN = {"II": "2", "III": "3", "IV": "4", "V": "5", "VI": "6", "VII": "7", "VIII": "8", "IX": "9", "X": "10"}
SEASON_TAIL = r"(?i)\s*(S\d{1,2}E\d{1,3}|\d{1,2}x\d{1,3}|season\s+\d+|temporada\s+\d+).*$"


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, by one machine-word-parallel row for each character (Hyyro 2004)."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & where.get(c, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    return 200.0 * common_length(a, b) / (len(a) + len(b)) if a or b else 100.0


def token_set_ratio(a: str, b: str) -> float:
    """Best ratio among the common words, and these with either side's other words."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    same, left, right = " ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if same and (not left or not right):
        return 100.0
    one, two = f"{same} {left}".strip(), f"{same} {right}".strip()
    found = [ratio(one, two)]
    if same:
        found += [ratio(same, one), ratio(same, two)]
    return max(found)


def partial_ratio(a: str, b: str) -> float:
    """Best ratio of the shorter text with a window of the longer one, windows cut off at its ends included."""
    short, long = sorted((a, b), key=len)
    n = len(short)
    if not n:
        return 100.0 if not long else 0.0
    best = max(ratio(short, long[max(0, i) : i + n]) for i in range(1 - n, len(long)))
    if len(long) == n:
        best = max(best, *(ratio(long, short[max(0, i) : i + n]) for i in range(1 - n, n)))
    return best


def similarity_of(a: str | None, b: str | None) -> float:
    x, y = py_norm(a), py_norm(b)
    if not x or not y:
        return 0.0
    return 1.0 if x == y else (token_set_ratio(x, y) + partial_ratio(x, y)) / 200.0


@F.pandas_udf(DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """0 to 1; different pairs of a batch are compared together, repeated ones once."""
    texts = [x if isinstance(x, str) else "" for x in a], [x if isinstance(x, str) else "" for x in b]
    normal = {t: py_norm(t) for t in {*texts[0], *texts[1]}}
    pairs = [(normal[x], normal[y]) for x, y in zip(*texts, strict=True)]
    distinct = list(dict.fromkeys(pairs))
    known = dict(zip(distinct, lanes.similarities([x for x, _ in distinct], [y for _, y in distinct]).tolist(), strict=True))
    return pd.Series([known[p] for p in pairs], dtype="float64")


def confidence(alike: Column, asked_year: Column, year: Column, variant: Column) -> Column:
    """Similarity, a little more for the same year and less for another, weighted down for a variant; 0 to 1, four digits."""
    both = (F.coalesce(asked_year, F.lit(0)) != 0) & (F.coalesce(year, F.lit(0)) != 0)
    shift = F.when(both & (asked_year == year), SAME_YEAR).when(both, OTHER_YEAR).otherwise(0.0)
    x = (alike + shift) * F.when(variant, VARIANT_WEIGHT).otherwise(1.0)
    return F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), x)), 4)


def accepted(conf: Column, lax: Column) -> Column:
    return conf >= F.when(lax, ACCEPT_LAX).otherwise(ACCEPT)


def _tidy(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"^[ :-]+|[ :-]+$", ""), r"\s+", " ")


def _leading(text: Column, n: int) -> Column:
    words = F.split(text, " ")
    return F.when(F.size(words) > n, F.array_join(F.slice(words, 1, n), " "))


def _unseen(items: Column) -> Column:
    """Structs (text, lax) in order, without nulls, blanks and repeats of a normalized text."""
    keyed = F.transform(items, lambda x: F.struct(x["text"].alias("text"), x["lax"].alias("lax"), norm(x["text"]).alias("n")))
    fits = F.filter(keyed, lambda x: x["n"] != "")
    kept = F.aggregate(fits, F.array().cast("array<struct<text:string,lax:boolean,n:string>>"), lambda acc, x: F.when(F.exists(acc, lambda y: y["n"] == x["n"]), acc).otherwise(F.array_append(acc, x)))
    return F.transform(kept, lambda x: F.struct(x["text"].alias("text"), x["lax"].alias("lax")))


def variants(title: Column) -> Column:
    """array<struct(text, lax)>: the title, before its colon, without its article, and (lax) its first four, three and two words."""
    return once(F.regexp_replace(F.trim(F.coalesce(title, F.lit(""))), r"\s+", " "), _variants)


def _variants(t: Column) -> Column:
    low = F.lower(t)
    bare = None
    for a in ARTICLES:
        test, rest = low.startswith(a), F.substring(t, F.lit(len(a) + 1), F.length(t))
        bare = F.when(test, rest) if bare is None else bare.when(test, rest)
    item = lambda x, lax: F.struct(x.alias("text"), F.lit(lax).alias("lax"))
    return _unseen(F.array(item(t, False), item(_tidy(F.when(t.contains(":"), F.substring_index(t, ":", 1))), False), item(_tidy(bare), False), *(item(_tidy(_leading(t, n)), True) for n in (4, 3, 2))))


def aggressive_variants(title: Column) -> Column:
    """array<string>: without its season tail, with arabic numerals, without its year, and its first five to two words."""
    return once(F.regexp_replace(F.trim(F.coalesce(title, F.lit(""))), r"\s+", " "), _aggressive_variants)


def _aggressive_variants(t: Column) -> Column:
    arabic = t
    for k, v in ROMAN.items():
        arabic = F.regexp_replace(arabic, rf"\b{k}\b", v)
    item = lambda x: F.struct(x.alias("text"), F.lit(True).alias("lax"))
    found = _unseen(F.array(item(t), *(item(_tidy(x)) for x in (F.regexp_replace(t, SEASON_TAIL, ""), arabic, F.regexp_replace(t, r"\b(19\d{2}|20\d{2})\b", ""), *(_leading(t, n) for n in (5, 4, 3, 2))))))
    # the title itself comes first, unless it is blank
    return F.transform(F.when(norm(t) == "", found).otherwise(F.slice(found, 2, 100)), lambda x: x["text"])
