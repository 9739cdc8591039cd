"""Work queues: rows whose identifiers are to be looked up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import any_id, missing_any_id, type_wanted
from ..functions.text import not_blank

QUEUE = ("id", "title", "title_text", "title_alt", "type", "season", "episode", "absolute_episode")
BATCH = 400


def stale(as_of: Column, days: int) -> Column:
    return F.col("ids_checked_at").isNull() | (F.col("ids_checked_at") < as_of - F.expr(f"interval {days} days"))


def rested(as_of: Column, minutes: int) -> Column:
    return F.col("ids_checked_at").isNull() | (F.col("ids_checked_at") < as_of - F.expr(f"interval {minutes} minutes"))


def main_and_other(column: str) -> tuple[Column, Column]:
    """(main name, other name): of ``title``, ``title_text``, or whichever isn't blank first ("auto")."""
    a, b = F.col("title"), F.col("title_text")
    if column == "title_text":
        return b, a
    if column == "title":
        return a, b
    return F.coalesce(not_blank(a), not_blank(b)), F.when(not_blank(a).isNotNull(), b)


def wanted(as_of: Column, recheck_days: int, only_types: str | None) -> Column:
    return missing_any_id() & stale(as_of, recheck_days) & type_wanted(only_types)


def _queue_columns(rows: DataFrame, column: str | None) -> DataFrame:
    main, other = (F.col("title"), F.col("title_text")) if column is None else main_and_other(column)
    return rows.select("id", main.alias("title"), "title_text", other.alias("title_alt"), *QUEUE[4:])


def enrich_queue(df: DataFrame, as_of: Column, *, batch: int | None = BATCH, recheck_days: int = 45, only_types: str | None = None, column: str | None = None) -> DataFrame:
    """Rows that lack an identifier and weren't checked for ``recheck_days``: never checked first, then the longest ago, then by id.

    column: None leaves both names as they are; "auto", "title" or "title_text" picks the main one.  A null batch is the default one."""
    rows = df.where(wanted(as_of, recheck_days, only_types))
    # order and limit are one top-k; names are made for the rows that are left
    first = rows.orderBy(F.col("ids_checked_at").asc_nulls_first(), "id").limit(BATCH if batch is None else batch)
    return _queue_columns(first, column)


def whole_enrich_queue(df: DataFrame, as_of: Column, *, recheck_days: int = 45, only_types: str | None = None, column: str | None = None) -> DataFrame:
    """All rows that :func:`enrich_queue` takes its batches from, in no order."""
    return _queue_columns(df.where(wanted(as_of, recheck_days, only_types)), column)


def missing_ids_queue(df: DataFrame, as_of: Column, *, batch: int | None = BATCH, min_age_minutes: int = 60, max_attempts: int = 4) -> DataFrame:
    """Rows without any identifier that have attempts left and rested: fewest attempts first."""
    rows = df.where(~any_id() & (F.coalesce("ids_attempts", F.lit(0)) < max_attempts) & rested(as_of, min_age_minutes))
    first = rows.orderBy(F.coalesce("ids_attempts", F.lit(0)), F.col("ids_checked_at").asc_nulls_first(), "id").limit(BATCH if batch is None else batch)
    return first.select("id", "title", "title_text", F.col("title_text").alias("title_alt"), *QUEUE[4:])


def reset_for_retry(df: DataFrame, as_of: Column, *, max_attempts: int = 4, min_age_minutes: int = 60, dry_run: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows with ``ids_checked_at`` cleared where they may be retried, one row: matched, queued, exhausted)."""
    none, tries = ~any_id(), F.coalesce("ids_attempts", F.lit(0))
    again = none & (tries < max_attempts) & rested(as_of, min_age_minutes)
    counts = df.agg(F.count_if(none).alias("matched"), F.count_if(again).alias("queued"), F.count_if(none & (tries >= max_attempts)).alias("exhausted"))
    if dry_run:
        return df, counts
    again = again & F.col("ids_checked_at").isNotNull()
    changed = df.withColumn("updated_at", F.when(again, as_of).otherwise(F.col("updated_at"))).withColumn("ids_checked_at", F.when(~again, F.col("ids_checked_at")))
    return changed.select(*df.columns), counts


def title_cache_lookup(cache: DataFrame, keys: DataFrame) -> DataFrame:
    """Cache rows of the given ``cache_key`` rows; null keys find nothing."""
    return cache.join(keys.select("cache_key").distinct(), "cache_key", "left_semi")


def title_column(df: DataFrame, rows: int = 5) -> DataFrame:
    """One row ``column``: "title_text" where, of the first rows, no title is filled and some text looks like a release name; else "title"."""
    from ..functions.titles import looks_like_release

    first = df.orderBy("id").limit(rows)
    test = first.agg(F.bool_and(not_blank(F.col("title")).isNull()).alias("blank"), F.bool_or(looks_like_release(F.coalesce("title_text", F.lit("")))).alias("text"))
    return test.select(F.when(F.col("blank") & F.col("text"), "title_text").otherwise("title").alias("column"))
