"""Keeping the best releases of each work, season and episode."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import group_episode, group_season, is_pack, type_wanted, work_key
from ..functions.lexicon import any_spanish, is_spanish
from ..functions.text import effective_title, quality_rank

GROUP = ("work", "gseason", "gep")


def scoped(df: DataFrame, only_types: str | None = None) -> DataFrame:
    """Rows that have a work key and aren't packs, with what ranking needs; a null pack flag is out too.  A column ``work`` is taken for the key."""
    key = F.col("work") if "work" in df.columns else work_key().alias("work")
    named = df.where(type_wanted(only_types)).select(
        "id", key, group_season().alias("gseason"), group_episode().alias("gep"), F.coalesce("seeders", F.lit(0)).alias("seeders"),
        quality_rank(F.col("quality")).alias("qrank"), "size_bytes", effective_title(F.col("title"), F.col("title_text")).alias("titulo"), is_pack().alias("pack"),
        "quality", "codec", "hdr", "release_group", "audio", "subtitles",
    )
    return named.where(F.col("work").isNotNull() & ~F.col("pack")).drop("pack")


def best_first(min_seeders: int = 0) -> list[Column]:
    return [(F.col("seeders") >= min_seeders).desc(), F.col("seeders").desc(), F.col("qrank").desc(), F.col("size_bytes").asc_nulls_last(), F.col("id").desc()]


def in_delete_order() -> list[Column]:
    return [F.col("work"), F.col("gseason").asc_nulls_first(), F.col("gep").asc_nulls_first(), F.col("rn")]


@dataclass(frozen=True)
class Ranked:
    ranked: DataFrame
    victims: DataFrame
    survivors: DataFrame
    metrics: DataFrame


def ranked(df: DataFrame, *, min_seeders: int = 0, only_types: str | None = None) -> DataFrame:
    window = Window.partitionBy(*GROUP).orderBy(*best_first(min_seeders))
    return scoped(df, only_types).select("id", *GROUP, "seeders", "qrank", "size_bytes", "titulo").withColumn("rn", F.row_number().over(window))


def keepers(df: DataFrame, *, limit: int = 3, min_seeders: int = 0, only_types: str | None = None) -> DataFrame:
    """The best ``limit`` (1 at least) of each group; Spark prunes each group before the shuffle (WindowGroupLimit)."""
    return ranked(df, min_seeders=min_seeders, only_types=only_types).where(F.col("rn") <= max(limit, 1))


def keep_best(df: DataFrame, *, limit: int = 3, min_seeders: int = 0, only_types: str | None = None, max_deletes: int | None = None, dry_run: bool = False) -> Ranked:
    """Delete all but the best ``limit`` of each group, ``max_deletes`` at most (None or 0: all)."""
    rows = ranked(df, min_seeders=min_seeders, only_types=only_types)
    over = rows.where(F.col("rn") > max(limit, 1))
    victims = over.orderBy(*in_delete_order()).limit(max_deletes) if max_deletes and max_deletes > 0 else over
    wanted = df.where(type_wanted(only_types)).agg(F.count("*").alias("wanted"))
    counts = rows.agg(F.count("*").alias("matched"), F.count_if(F.col("rn") == 1).alias("groups"), F.count_if(F.col("rn") <= max(limit, 1)).alias("kept"))
    cand = F.col("matched") - F.col("kept")
    cap = F.least(cand, F.lit(max_deletes).cast("long")) if max_deletes and max_deletes > 0 else cand
    # both sides have one row
    metrics = counts.crossJoin(wanted).select("groups", "matched", (F.lit(0).cast("long") if dry_run else cap).alias("deleted"), "kept", (F.col("wanted") - F.col("matched")).alias("skipped"), (cand - cap).alias("skipped_limit"))
    return Ranked(rows, victims.select("id"), df if dry_run else df.join(victims.select("id"), "id", "left_anti"), metrics)


def size_bucket(size: Column, tolerance: float | None = None) -> Column:
    """Sizes that count as equal: 0 for none, itself below 100, else one bucket; with a tolerance, steps of that share."""
    if tolerance:
        return F.when(size.isNull() | (size <= 0), 0).otherwise(F.floor(F.log(size.cast("double")) / F.log(F.lit(1.0 + tolerance)))).cast("long")
    return F.when(size.isNull() | (size <= 0), 0).when(size < 100, size).otherwise(100).cast("long")


def spanish_scoped(df: DataFrame, *, only_types: str | None = None, subs_fallback: bool = True, title_hint: bool = True, tokens: str | None = None) -> DataFrame:
    """Scoped rows with language flags and score: audio 3, subtitles 2, a hint in the title 1."""
    rows = scoped(df, only_types).withColumn("audio_es", any_spanish(F.col("audio"), tokens)).withColumn("subs_es", any_spanish(F.col("subtitles"), tokens)).withColumn("hint_es", F.coalesce(is_spanish(F.col("titulo"), tokens), F.lit(False)))
    score = F.when(F.col("audio_es"), 3).when(F.col("subs_es") & F.lit(subs_fallback), 2).when(F.col("hint_es") & F.lit(title_hint), 1).otherwise(0)
    return rows.withColumn("es_score", score)


def _copies(tolerance: float | None = None) -> Column:
    """A row's number among those of the same group, quality, codec, range, size bucket and release group, by id."""
    low = lambda c: F.lower(F.coalesce(F.col(c), F.lit("")))
    return F.row_number().over(Window.partitionBy(*GROUP, low("quality"), low("codec"), low("hdr"), size_bucket(F.col("size_bytes"), tolerance), low("release_group")).orderBy("id"))


def duplicates(rows: DataFrame, tolerance: float | None = None) -> DataFrame:
    """(id) of rows that repeat an earlier one."""
    return rows.withColumn("copy", _copies(tolerance)).where("copy > 1").select("id")


@dataclass(frozen=True)
class SpanishQuota:
    ranked: DataFrame
    duplicates: DataFrame
    candidates: DataFrame
    survivors: DataFrame
    metrics: DataFrame


def keep_best_spanish(df: DataFrame, *, limit: int = 3, min_spanish: int = 2, min_seeders: int = 0, only_types: str | None = None, dedupe: bool = True, strict: bool = False, title_hint: bool = True, subs_fallback: bool = True, tokens: str | None = None, size_tolerance: float | None = None, max_deletes: int | None = None, dry_run: bool = False, compat_season_bug: bool = False) -> SpanishQuota:
    """Deduplicate, rank releases of the wanted language first, keep ``limit`` of each group; ``strict`` also deletes whole groups with fewer than ``min_spanish``.

    The cap on deletes is spent on duplicates first, lowest ids first; only duplicates that it reaches leave the ranking."""
    limit, least = max(limit, 1), max(min_spanish, 0)
    capped = max_deletes if max_deletes and max_deletes > 0 else None
    rows = spanish_scoped(df, only_types=only_types, subs_fallback=subs_fallback, title_hint=title_hint, tokens=tokens)
    rows = rows.withColumn("dup", _copies(size_tolerance) > 1 if dedupe else F.lit(False))
    dupes = rows.where("dup").select("id")
    gone = dupes.orderBy("id").limit(capped) if capped else dupes
    if capped:
        rows = rows.join(gone.withColumn("gone", F.lit(True)), "id", "left").withColumn("gone", F.coalesce("gone", F.lit(False)))
    else:
        rows = rows.withColumn("gone", F.col("dup"))
    group = Window.partitionBy(*GROUP)
    # duplicates that go are ranked last, so they take nobody's place
    order = group.orderBy("gone", F.col("es_score").desc(), *best_first(min_seeders))
    left = ~F.col("gone")
    every = rows.withColumn("rn", F.row_number().over(order)).withColumn("n_es", F.count(F.when(left & (F.col("es_score") >= 1), 1)).over(group))
    low = F.lit(strict) & (F.col("n_es") < least)
    every = every.withColumn("reason", F.when(F.col("gone"), None).when(low, "strict").when(F.col("rn") > limit, "top"))
    placed = every.where(left).drop("gone", "dup")
    over = placed.where("reason is not null")
    if capped:
        over = over.orderBy((F.col("reason") == "strict").asc(), *in_delete_order()).limit(max(capped - gone.count(), 0))
    kept = left & F.col("reason").isNull()
    told = every.withColumns({"kept": kept, "a": F.count(F.when(kept & F.col("audio_es"), 1)).over(group), "e": F.count(F.when(kept & (F.col("es_score") >= 1), 1)).over(group)})
    head = F.col("rn") == 1
    if compat_season_bug:  # counts over all seasons of a work
        told = told.withColumn("e", F.sum(F.when(head, F.col("e"))).over(Window.partitionBy("work", "gep")))
    # a group without a kept row isn't counted as one with enough
    has_kept = F.count(F.when(kept, 1)).over(group) > 0
    counts = told.withColumn("has", has_kept).agg(
        F.count_if(head).alias("groups"), F.count("*").alias("matched"), F.count_if("dup").alias("duplicates"), F.count_if("kept").alias("kept"), F.count_if(F.col("reason").isNotNull()).alias("cand"),
        F.count_if(head & F.col("has") & (F.col("a") >= least)).alias("groups_ok_audio"), F.count_if(head & F.col("has") & (F.col("e") >= least)).alias("groups_ok_spanish"),
        F.count_if(F.lit(subs_fallback) & F.col("kept") & ~F.col("audio_es") & F.col("subs_es")).alias("kept_with_subs"),
    )
    wanted = df.where(type_wanted(only_types)).agg(F.count("*").alias("wanted"))
    first = F.least(F.col("duplicates"), F.lit(capped).cast("long")) if capped else F.col("duplicates")
    done = first + (F.least(F.col("cand"), F.lit(capped).cast("long") - first) if capped else F.col("cand"))
    # both sides have one row
    metrics = counts.crossJoin(wanted).select(
        "groups", "matched", (F.lit(0).cast("long") if dry_run else done).alias("deleted"), "kept", "groups_ok_audio", "groups_ok_spanish", (F.col("groups") - F.col("groups_ok_spanish")).alias("groups_low_spanish"),
        "kept_with_subs", "duplicates", (F.col("wanted") - F.col("matched")).alias("skipped"), (F.col("duplicates") + F.col("cand") - done).alias("skipped_limit"),
    )
    survivors = df if dry_run else df.join(gone.unionByName(over.select("id")), "id", "left_anti")
    return SpanishQuota(placed, dupes, over, survivors, metrics)


def spanish_gaps(df: DataFrame, *, limit: int | None = 15, tokens: str | None = None) -> DataFrame:
    """Groups with fewer than two releases in the wanted language, worst first; ties by group."""
    rows = spanish_scoped(df, tokens=tokens)
    either = F.col("audio_es") | F.col("subs_es")
    found = rows.groupBy(*GROUP).agg(F.min("titulo").alias("title"), F.count("*").alias("total"), F.count_if("audio_es").alias("with_audio"), F.count_if(F.col("subs_es") & ~F.col("audio_es")).alias("with_subs"), F.count_if(either).alias("n"))
    found = found.where("n < 2").orderBy("n", F.desc("total"), "work", F.col("gseason").asc_nulls_first(), F.col("gep").asc_nulls_first())
    return (found.limit(limit if limit > 0 else 15) if limit is not None else found).select("title", F.col("gseason").alias("season"), F.col("gep").alias("episode"), "total", "with_audio", "with_subs")
