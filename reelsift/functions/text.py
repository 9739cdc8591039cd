"""Text normalization as column expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Accented letters and what each becomes.
ACCENTED = "áéíóúýüñàèìòùâêîôûäëïöüçÿ"
PLAIN = "aeiouyunaeiouaeiouaeioucy"

#: Quality marks and their rank, best first.
QUALITY_RANKS = ((("2160", "4k", "uhd"), 60), (("1440",), 50), (("1080",), 40), (("720",), 30), (("480",), 20), (("360", "240"), 10))


def once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def norm(text: Column) -> Column:
    """Lower case, accents folded, everything but letters and digits to single spaces; "" for null."""
    folded = F.translate(F.lower(F.coalesce(text, F.lit(""))), ACCENTED, PLAIN)
    return F.trim(F.regexp_replace(folded, "[^a-z0-9]+", " "))


@F.pandas_udf(StringType())
def norm_unicode(text: pd.Series) -> pd.Series:
    """Like :func:`norm`, but folding every combining mark (NFKD) rather than the fixed accents."""
    plain = text.fillna("").map(lambda t: "".join(c for c in unicodedata.normalize("NFKD", t.lower()) if not unicodedata.combining(c)))
    return plain.str.replace(r"[^a-z0-9]+", " ", regex=True).str.strip()


def not_blank(text: Column) -> Column:
    """The trimmed text, null where nothing is left."""
    return F.nullif(F.trim(text), F.lit(""))


def effective_title(title: Column, title_text: Column) -> Column:
    """The first of both names that isn't blank, trimmed."""
    return F.coalesce(not_blank(title), not_blank(title_text))


def title_key(text: Column) -> Column:
    """The normalized name that rows are grouped by; null where nothing is left."""
    return F.nullif(norm(not_blank(text)), F.lit(""))


def has_token(normalized: Column, token: Column | str) -> Column:
    """Whether a normalized token or phrase stands in a normalized text, at word boundaries."""
    token = F.lit(token) if isinstance(token, str) else token
    pad = lambda x: F.concat(F.lit(" "), x, F.lit(" "))
    return (normalized != "") & (token != "") & pad(normalized).contains(pad(token))


def has_any_token(normalized: Column, tokens: list[str]) -> Column:
    """Whether one of the normalized tokens stands in the text: one alternation, scanned once."""
    tokens = [t for t in dict.fromkeys(tokens) if t]
    return normalized.rlike(f"(^| )({'|'.join(tokens)})( |$)") if tokens else F.lit(False)


def quality_rank(quality: Column) -> Column:
    low, found = F.lower(F.coalesce(quality, F.lit(""))), None
    for marks, rank in QUALITY_RANKS:
        test = low.contains(marks[0])
        for m in marks[1:]:
            test = test | low.contains(m)
        found = F.when(test, rank) if found is None else found.when(test, rank)
    return found.otherwise(0)


def py_norm(text: str | None) -> str:
    """:func:`norm` of a literal, for token lists."""
    folded = (text or "").lower().translate(str.maketrans(ACCENTED, PLAIN))
    return " ".join("".join(c if c.isascii() and c.isalnum() else " " for c in folded).split())
