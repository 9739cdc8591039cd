"""External identifiers: trust, work keys, cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import ID_FIELDS, NUMERIC_IDS
from .text import effective_title, norm, not_blank, title_key

#: Sources that are trusted whatever their confidence, and the confidence that is enough.
MANUAL_SOURCES = ("manual", "externo", "externa", "tabla", "preexistente")
TRUSTED = 0.92
#: Identifiers that a type should have.
EXPECTED = {"movie": ("tmdb_id", "imdb_id"), "series": ("tmdb_id", "imdb_id"), "anime": ("anilist_id", "kitsu_id", "mal_id", "imdb_id")}
#: Days after which a remembered miss is looked up again.
MISS_DAYS = 20
MAX_INT = 2147483647


def trusted(confidence: Column, source: Column) -> Column:
    return source.isNull() | F.lower(source).isin(*MANUAL_SOURCES) | (F.coalesce(confidence, F.lit(0.0)) >= TRUSTED)


def has_id(field: str) -> Column:
    return (not_blank(F.col(field)) if field == "imdb_id" else F.col(field)).isNotNull()


def any_id() -> Column:
    out = has_id(ID_FIELDS[0])
    for f in ID_FIELDS[1:]:
        out = out | has_id(f)
    return out


def missing_any_id() -> Column:
    out = ~has_id(ID_FIELDS[0])
    for f in ID_FIELDS[1:]:
        out = out | ~has_id(f)
    return out


def work_key() -> Column:
    """What a release is of: its best trusted identifier, else its title; null where it has neither."""
    tag = lambda name, value: F.concat(F.lit(f"{name}:"), value.cast("string"))
    by_id = F.coalesce(tag("imdb", not_blank(F.col("imdb_id"))), tag("tmdb", F.col("tmdb_id")), tag("anilist", F.col("anilist_id")), tag("kitsu", F.col("kitsu_id")), tag("mal", F.col("mal_id")))
    by_title = F.concat(F.lit("t:"), title_key(effective_title(F.col("title"), F.col("title_text"))))
    return F.when(trusted(F.col("ids_confidence"), F.col("ids_source")) & any_id(), by_id).otherwise(by_title)


def group_season() -> Column:
    return F.when(F.coalesce(F.col("type") == "movie", F.lit(False)), F.lit(None).cast("int")).otherwise(F.col("season"))


def group_episode() -> Column:
    return F.when(F.coalesce(F.col("type") == "movie", F.lit(False)), F.lit(None).cast("int")).otherwise(F.coalesce("episode", "absolute_episode"))


def is_pack() -> Column:
    """A whole season or series; null for a row without type, season and episodes, which isn't grouped either."""
    return F.col("type").isin("series", "anime") & F.col("season").isNull() & F.col("episode").isNull() & F.col("absolute_episode").isNull()


def type_wanted(only_types: str | None) -> Column:
    """Whether the type is in a comma-separated list; a null type counts as "". No list: all."""
    if not (only_types or "").strip():
        return F.lit(True)
    return F.coalesce(F.col("type"), F.lit("")).isin(*(x.strip() for x in only_types.split(",")))


def clean_int(value: Column) -> tuple[Column, Column]:
    """(the number from 1 to 2147483647 or null, whether there was something else) of a text."""
    text = not_blank(value)
    digits = F.regexp_replace(text, "^0+(?=.)", "")
    number = F.when(text.rlike("^[0-9]+$") & (F.length(digits) <= 10), digits.try_cast("bigint"))
    good = F.when((number >= 1) & (number <= MAX_INT), number.cast("int"))
    return good, text.isNotNull() & good.isNull()


def clean_imdb(value: Column) -> tuple[Column, Column]:
    text = F.lower(not_blank(value))
    good = F.when(text.rlike("^tt[0-9]{1,10}$"), text)
    return good, text.isNotNull() & good.isNull()


def clean_ids() -> dict[str, tuple[Column, Column]]:
    """(clean value, whether invalid) of each identifier column, given as text."""
    return {f: clean_imdb(F.col(f).cast("string")) if f not in NUMERIC_IDS else clean_int(F.col(f).cast("string")) for f in ID_FIELDS}


def clean_confidence(value: Column) -> Column:
    """0 to 1; 0.5 where it isn't a number."""
    x = value.try_cast("double")
    x = F.when(x.isNull() | F.isnan(x), F.lit(0.5)).otherwise(x)
    return F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))


def cache_key(title: Column, year: Column, kind: Column) -> Column:
    return F.concat(norm(title), F.lit("|"), F.coalesce(year.cast("string"), F.lit("")), F.lit("|"), F.coalesce(kind, F.lit("")))


def complete(kind: Column, fill_all: bool = True) -> Column:
    """Whether a row has the identifiers its type should have, of an unknown type two of any; one is enough without ``fill_all``."""
    if not fill_all:
        return any_id()
    count = lambda fields: sum((has_id(f).cast("int") for f in fields), F.lit(0))
    out = None
    for name, fields in EXPECTED.items():
        test = count(fields) >= len(fields)
        out = F.when(kind == name, test) if out is None else out.when(kind == name, test)
    return out.otherwise(count(ID_FIELDS) >= 2)


def miss_is_fresh(created_at: Column, as_of: Column) -> Column:
    """Whether a remembered miss is younger than MISS_DAYS whole days."""
    return F.coalesce(F.expr(f"interval {MISS_DAYS} days") + created_at > as_of, F.lit(False))
