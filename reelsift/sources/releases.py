"""Releases: from Parquet, and derived from the driver's star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import RELEASES, ensure_columns

#: The clock of age rules over the driver's tables.
AS_OF = "2001-08-01 00:00:00"


def as_of(text: str = AS_OF):
    return F.lit(text).cast("timestamp_ntz")


def read_releases(spark: SparkSession, path: str) -> DataFrame:
    """Releases from Parquet; missing columns are null."""
    return ensure_columns(spark.read.parquet(path), RELEASES)


def derived_releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One release for each order: names from a document, everything else from key arithmetic."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    names = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id between 0 and 199").select("doc_id", F.substring("text", 1, 18).alias("head"))
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    either = lambda *pairs, last=None: _cases(pairs, last)
    title = either((k % 41 == 0, F.lit("")), (k % 43 == 0, F.lit("README")), last=F.concat("head", either((k % 5 == 0, F.lit(" 1080p Latino")), (k % 5 == 1, F.lit(" XXX 720p")), (k % 5 == 2, F.lit(" S01E02 SUBS ES")), last=F.lit(" 2160p"))))
    texts = lambda *x: F.array(*map(F.lit, x))
    columns = {
        "id": k,
        "title": title,
        "title_text": F.when(k % 3 == 0, F.concat(F.lit("Nombre interno "), c.cast("string"))),
        "type": either(((k % 7).isin(0, 1), F.lit("movie")), ((k % 7).isin(2, 3), F.lit("series")), ((k % 7).isin(4, 5), F.lit("anime"))),
        "season": F.when(k % 4 != 0, c % 3 + 1),
        "episode": F.when(k % 6 != 0, k % 2 + 1),
        "absolute_episode": F.when(k % 5 == 0, k % 24 + 1),
        "quality": either(*((k % 6 == i, F.lit(q)) for i, q in enumerate(("2160p", "1080p", "720p", "480p", "UHD")))),
        "codec": F.when(k % 2 == 0, "x264").otherwise("x265"),
        "hdr": F.when(k % 3 == 0, "HDR10"),
        "size_bytes": F.when(k % 9 != 0, F.floor(F.col("o_totalprice") * 100)),
        "seeders": k % 97,
        "audio": either((k % 4 == 0, texts("Latino")), (k % 4 == 1, texts("English", "Castellano")), (k % 4 == 2, texts("Japanese"))),
        "subtitles": either((k % 3 == 0, texts("SUBS [ES]")), (k % 3 == 1, texts("Estonian"))),
        "release_group": either((k % 8 == 0, F.lit("xXxTorrents")), (k % 8 == 1, F.lit("LAT")), last=F.lit("GRP")),
        "source_tracker": either((k % 11 == 0, F.lit("tracker 18+")), (k % 11 == 1, F.lit("pub"))),
        "tmdb_id": F.when(k % 3 == 1, c % 300 + 1),
        "imdb_id": either((k % 5 == 2, F.concat(F.lit("tt"), (1000000 + c % 200).cast("string"))), (k % 5 == 3, F.lit(" "))),
        "anilist_id": F.when(k % 7 == 4, c % 150 + 1),
        "kitsu_id": F.when(k % 7 == 5, c % 120 + 1),
        "mal_id": F.when(k % 14 == 4, c % 90 + 1),
        "ids_source": either((k % 4 == 0, F.lit("tmdb")), (k % 4 == 1, F.lit("manual")), (k % 4 == 2, F.lit("imdb:suggest+tvmaze"))),
        "ids_confidence": either(*((k % 5 == i, F.lit(x)) for i, x in enumerate((0.5, 0.91, 0.92, 0.95)))),
        "ids_attempts": k % 6,
        "ids_checked_at": F.when(k % 3 != 2, F.col("o_orderdate")),
        "created_at": F.col("o_orderdate"),
    }
    # 200 names of 18 characters: a fixed bound
    joined = orders.join(F.broadcast(names), k % 200 == F.col("doc_id"))
    return ensure_columns(joined.select(*(v.alias(n) for n, v in columns.items())), RELEASES)


def _cases(pairs, last):
    out = None
    for test, value in pairs:
        out = F.when(test, value) if out is None else out.when(test, value)
    return out if last is None else out.otherwise(last)
