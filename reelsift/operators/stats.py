"""Statistics: one aggregation each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ids import any_id, has_id
from ..functions.lexicon import any_spanish
from ..schema import ID_FIELDS


def ids_stats(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total"), F.count_if(~any_id()).alias("without_ids"), *(F.count_if(has_id(f)).alias(f"with_{f}") for f in ID_FIELDS))


def counts_by(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.groupBy(F.coalesce(F.col(column), F.lit("?")).alias(name)).agg(F.count("*").alias("n"))


def quality_totals(df: DataFrame) -> DataFrame:
    absolute = F.col("absolute_episode").isNotNull() & F.col("episode").isNull()
    no_season = F.col("type").isin("series", "anime") & F.col("season").isNull()
    return df.agg(F.count("*").alias("total"), F.count_if(F.coalesce("seeders", F.lit(0)) <= 0).alias("without_seeders"), F.count_if(absolute).alias("absolute_only"), F.count_if(no_season).alias("without_season"))


def quality_stats(df: DataFrame) -> DataFrame:
    """Totals with counts by type and by quality as maps."""
    as_map = lambda column, name: counts_by(df, column, "k").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("k", "n")))).alias(name))
    return quality_totals(df).crossJoin(as_map("type", "by_type")).crossJoin(as_map("quality", "by_quality"))  # one row each


def spanish_stats(df: DataFrame) -> DataFrame:
    audio, subs = any_spanish(F.col("audio")), any_spanish(F.col("subtitles"))
    return df.agg(F.count("*").alias("total"), F.count_if(audio).alias("audio_es"), F.count_if(subs).alias("subs_es"), F.count_if(subs & ~audio).alias("subs_only")).withColumn("none", F.col("total") - F.col("audio_es") - F.col("subs_only"))


def id_report(df: DataFrame, foreign_keys: int = 0) -> DataFrame:
    """Rows, least and greatest id, gaps, whether ids are dense from 1, the next id, and known foreign keys."""
    a = df.agg(F.count("*").alias("total"), F.min("id").alias("min_id"), F.max("id").alias("max_id"))
    gaps = F.when(F.col("total") == 0, 0).otherwise(F.col("max_id") - F.col("min_id") + 1 - F.col("total"))
    return a.select("total", "min_id", "max_id", gaps.cast("long").alias("gaps"), ((F.col("total") == 0) | ((gaps == 0) & (F.col("min_id") == 1))).alias("ready"), (F.coalesce("max_id", F.lit(0)) + 1).alias("next_id"), F.lit(foreign_keys).cast("long").alias("foreign_keys"))
