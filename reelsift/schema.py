"""The two relations of the engine: releases and the title cache."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType

TEXTS = ArrayType(StringType())
TIME = TimestampNTZType()

#: The five external identifiers, numeric ones first.
NUMERIC_IDS = ("tmdb_id", "anilist_id", "kitsu_id", "mal_id")
ID_FIELDS = ("tmdb_id", "imdb_id", "anilist_id", "kitsu_id", "mal_id")

RELEASES = StructType(
    [StructField("id", LongType(), False)]
    + [StructField(x, StringType()) for x in ("title", "title_text", "type")]
    + [StructField(x, IntegerType()) for x in ("season", "episode", "absolute_episode")]
    + [StructField(x, StringType()) for x in ("quality", "codec", "hdr")]
    + [StructField("size_bytes", LongType()), StructField("seeders", IntegerType()), StructField("audio", TEXTS), StructField("subtitles", TEXTS)]
    + [StructField(x, StringType()) for x in ("release_group", "source_tracker")]
    + [StructField("tmdb_id", IntegerType()), StructField("imdb_id", StringType())]
    + [StructField(x, IntegerType()) for x in ("anilist_id", "kitsu_id", "mal_id")]
    + [StructField("ids_checked_at", TIME), StructField("ids_source", StringType()), StructField("ids_confidence", DoubleType()), StructField("ids_attempts", IntegerType())]
    + [StructField("created_at", TIME), StructField("updated_at", TIME)]
)

TITLE_CACHE = StructType(
    [StructField("cache_key", StringType(), False), StructField("tmdb_id", IntegerType()), StructField("imdb_id", StringType())]
    + [StructField(x, IntegerType()) for x in ("anilist_id", "kitsu_id", "mal_id")]
    + [StructField("source", StringType()), StructField("confidence", DoubleType()), StructField("found", BooleanType()), StructField("created_at", TIME), StructField("updated_at", TIME)]
)


def ensure_columns(df: DataFrame, schema: StructType = RELEASES) -> DataFrame:
    """``df`` with the schema's columns in their types and order; missing ones are null, others are left out."""
    have = set(df.columns)
    return df.select(*((F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema))
