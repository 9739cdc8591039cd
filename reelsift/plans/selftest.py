"""Offline checks of the expressions a run relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..functions import ids, lexicon, matching, text, titles


def checks() -> dict:
    """Name to a boolean column over one row (name: a release name, parsed as p)."""
    name = F.col("p")
    return {
        "accents fold": text.norm(F.lit("ÁÉÍ Ñ")) == "aei n",
        "tokens need word boundaries": ~text.has_token(text.norm(F.lit("Analytics")), "anal"),
        "names parse": (name["title"] == "The Matrix") & (name["year"] == 1999) & (name["codec"] == "x264"),
        "the wanted language is known": lexicon.is_spanish(F.lit("SUBS [ES]")) & ~lexicon.is_spanish(F.lit("Estonian")),
        "quality ranks": text.quality_rank(F.lit("2160p")) == 60,
        "sources are trusted": ids.trusted(F.lit(0.1), F.lit("manual")) & ~ids.trusted(F.lit(0.91), F.lit("tmdb")),
        "dirty ids are refused": ids.clean_int(F.lit("603.5"))[1] & ~ids.clean_int(F.lit(" 42 "))[1],
        "equal names match": matching.similarity(F.lit("The Matrix"), F.lit("the matrix")) == 1.0,
    }


def run(spark: SparkSession) -> list[str]:
    """Names of the checks that fail."""
    tests = checks()
    one = spark.createDataFrame([("The.Matrix.1999.1080p.BluRay.x264-AMIABLE",)], "name string").select(titles.parse_release(F.col("name")).alias("p"))
    row = one.select(*(c.alias(n) for n, c in tests.items())).first()
    return [n for n in tests if not row[n]]
