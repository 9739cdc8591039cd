"""Deleting rows: a candidate set, a cap, survivors and a row of metrics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lexicon import JUNK_NAMES, JUNK_TOKEN, blocked
from ..functions.text import effective_title, has_token, norm

SAMPLE = 5


@dataclass(frozen=True)
class Purged:
    """survivors: the next snapshot; victims: (id) deleted; changed: (id) nullified; metrics: one row."""

    survivors: DataFrame
    victims: DataFrame
    metrics: DataFrame
    changed: DataFrame | None = None


def titled() -> Column:
    return effective_title(F.col("title"), F.col("title_text"))


def purge(df: DataFrame, test: Column, *, limit: int | None = None, dry_run: bool = False, stage: str = "") -> Purged:
    """Delete the rows that ``test`` holds for, lowest ids first, ``limit`` at most (None or 0: all).

    Without a limit nothing is sorted: survivors are a filter.  With one, the victims are a top-k of ids.
    """
    hit = F.coalesce(test, F.lit(False))
    found = df.where(hit).select("id", titled().alias("titulo"))
    victims = found.select("id")
    if limit and limit > 0:
        victims = victims.orderBy("id").limit(limit)
        survivors = df.join(victims, "id", "left_anti")
    else:
        survivors = df.where(~hit)
    counts = found.agg(F.count("*").alias("matched"))
    capped = F.least(F.col("matched"), F.lit(limit).cast("long")) if limit and limit > 0 else F.col("matched")
    deleted = F.lit(0).cast("long") if dry_run else capped
    metrics = counts.select(F.lit(stage).alias("stage"), "matched", deleted.alias("deleted"), (F.col("matched") - deleted).alias("skipped"), (F.col("matched") - capped).alias("skipped_limit"))
    return Purged(df if dry_run else survivors, victims.limit(0) if dry_run else victims, metrics)


def sample(df: DataFrame, test: Column, rows: int = SAMPLE) -> DataFrame:
    """The first candidates by id, as the array of structs of a report."""
    first = df.where(F.coalesce(test, F.lit(False))).select("id", titled().alias("title")).orderBy("id").limit(rows)
    return first.agg(F.sort_array(F.collect_list(F.struct("id", "title"))).alias("sample"))


def is_junk(purge_empty: bool = False) -> Column:
    name = norm(titled())
    test = name.isin(*JUNK_NAMES) | has_token(name, JUNK_TOKEN)
    return test | titled().isNull() if purge_empty else test


def is_absolute_only(require_season_null: bool = True) -> Column:
    test = F.col("type").isin("series", "anime") & F.col("absolute_episode").isNotNull() & F.col("episode").isNull()
    return test & F.col("season").isNull() if require_season_null else test


def is_dead(as_of: Column, min_seeders: int = 1, older_days: int = 60) -> Column:
    return (F.coalesce("seeders", F.lit(0)) < min_seeders) & (F.col("created_at") < as_of - F.expr(f"interval {older_days} days"))


def purge_junk(df: DataFrame, *, purge_empty: bool = False, **how) -> Purged:
    return purge(df, is_junk(purge_empty), stage="junk", **how)


def purge_blocked(df: DataFrame, *, tokens=None, soft=(), allow=(), **how) -> Purged:
    return purge(df, blocked(tokens, soft, allow), stage="blocked", **how)


def purge_dead(df: DataFrame, as_of: Column, *, min_seeders: int = 1, older_days: int = 60, **how) -> Purged:
    return purge(df, is_dead(as_of, min_seeders, older_days), stage="dead", **how)


def purge_absolute_only(df: DataFrame, as_of: Column, *, action: str = "delete", require_season_null: bool = True, limit: int | None = None, dry_run: bool = False) -> Purged:
    """Delete rows known by absolute episode alone, or set that column to null and stamp ``updated_at`` (action "nullify").

    Nullified rows are no deletes: metrics count them as ``updated``."""
    test = is_absolute_only(require_season_null)
    if action == "delete":
        done = purge(df, test, limit=limit, dry_run=dry_run, stage="absolute")
        return Purged(done.survivors, done.victims, done.metrics.withColumn("updated", F.lit(0).cast("long")))
    picked = purge(df, test, limit=limit, stage="absolute")
    metrics = picked.metrics.select("stage", "matched", F.lit(0).cast("long").alias("deleted"), F.when(F.lit(dry_run), F.col("matched")).otherwise(F.col("skipped")).alias("skipped"), "skipped_limit", F.when(F.lit(dry_run), 0).otherwise(F.col("deleted")).cast("long").alias("updated"))
    if dry_run:
        return Purged(df, picked.victims.limit(0), metrics, picked.victims.limit(0))
    if limit and limit > 0:
        marked = df.join(picked.victims.withColumn("_hit", F.lit(True)), "id", "left")
    else:
        marked = df.withColumn("_hit", F.coalesce(test, F.lit(False)))
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    changed = marked.withColumn("absolute_episode", F.when(~hit, F.col("absolute_episode"))).withColumn("updated_at", F.when(hit, as_of).otherwise(F.col("updated_at")))
    return Purged(changed.select(*df.columns), picked.victims.limit(0), metrics, picked.victims)
