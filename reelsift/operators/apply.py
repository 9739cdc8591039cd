"""Applying a batch of looked-up identifiers to releases and the title cache, in batch order."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import clean_confidence, clean_ids
from ..functions.text import not_blank
from ..schema import ID_FIELDS

#: The source of identifiers that came without one.
NO_SOURCE = "sin-fuente"
PAYLOAD = "array<struct<id:string,tmdb_id:string,imdb_id:string,anilist_id:string,kitsu_id:string,mal_id:string,source:string,confidence:string,cache_key:string>>"


def read_batch(payload: DataFrame, column: str = "payload") -> DataFrame:
    """Rows (pos, id, identifiers, source, confidence, cache_key: all texts) of JSON arrays; text and number values alike."""
    return payload.select(F.posexplode(F.from_json(column, PAYLOAD)).alias("pos", "x")).select("pos", "x.*")


def cleaned(batch: DataFrame) -> DataFrame:
    """Batch rows with clean identifiers, confidence and source, and ``bad``: how many values were invalid."""
    clean = clean_ids()
    key = F.when(F.col("id").rlike(r"^\s*[+-]?[0-9]+\s*$"), F.trim("id").try_cast("bigint"))
    bad = sum((b.cast("int") for _, b in clean.values()), F.lit(0))
    return batch.select("pos", key.alias("id"), *(v.alias(f) for f, (v, _) in clean.items()), not_blank(F.col("source")).alias("source"), clean_confidence(F.col("confidence")).alias("confidence"), not_blank(F.col("cache_key")).alias("cache_key"), bad.alias("bad"))


@dataclass(frozen=True)
class Applied:
    rows: DataFrame
    cache: DataFrame
    metrics: DataFrame


def _fold(items: str, start: Column, step) -> Column:
    return F.aggregate(items, start, step)


def _in_order(batch: DataFrame, key: str) -> DataFrame:
    """One row for each key with its items in batch order; a batch is small, and so is what one key has of it."""
    return batch.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("pos", *ID_FIELDS, "source", "confidence"))).alias("items"))


def _has_any(x) -> Column:
    out = x[ID_FIELDS[0]].isNotNull()
    for f in ID_FIELDS[1:]:
        out = out | x[f].isNotNull()
    return out


def apply_ids(releases: DataFrame, cache: DataFrame, batch: DataFrame, as_of: Column, *, overwrite_miss: bool = True) -> Applied:
    """Fold a batch (pos, id, identifiers, source, confidence, cache_key: texts) into both tables.

    Releases: an identifier fills an empty place and never replaces one; source and confidence change only with it; attempts
    go back to 0 for a row that has any identifier, else up by one for each item.  Cache: a hit fills empty places, a miss is remembered where nothing is.
    ``overwrite_miss``: a hit over a remembered miss takes its own source and confidence.  Items of one row or key are folded in order.
    """
    items = cleaned(batch)
    known = items.join(releases.select("id"), "id", "left_semi")
    folded = _in_order(known, "id")
    seeded = releases.join(folded, "id", "left")
    own = {f: (not_blank(F.col(f)) if f == "imdb_id" else F.col(f)) for f in ID_FIELDS}
    start = F.struct(*(v.alias(f) for f, v in own.items()), F.col("ids_source").alias("source"), F.col("ids_confidence").alias("confidence"), F.coalesce("ids_attempts", F.lit(0)).alias("attempts"))

    def step(acc, x):
        wrote = F.lit(False)
        for f in ID_FIELDS:
            wrote = wrote | (acc[f].isNull() & x[f].isNotNull())
        merged = {f: F.coalesce(acc[f], x[f]) for f in ID_FIELDS}
        any_ = F.lit(False)
        for v in merged.values():
            any_ = any_ | v.isNotNull()
        return F.struct(*(v.alias(f) for f, v in merged.items()), F.when(wrote, F.coalesce(x["source"], F.lit(NO_SOURCE))).otherwise(acc["source"]).alias("source"), F.when(wrote, x["confidence"]).otherwise(acc["confidence"]).alias("confidence"), F.when(any_, F.lit(0)).otherwise(acc["attempts"] + 1).alias("attempts"))

    touched = F.col("items").isNotNull()
    done = seeded.withColumn("_new", F.when(touched, _fold("items", start, step)))
    new = {**{f: F.col(f"_new.{f}") for f in ID_FIELDS}, "ids_source": F.col("_new.source"), "ids_confidence": F.col("_new.confidence"), "ids_attempts": F.col("_new.attempts"), "ids_checked_at": as_of, "updated_at": as_of}
    rows = done.select(*((F.when(touched, new[c]).otherwise(F.col(c)) if c in new else F.col(c)).alias(c) for c in releases.columns))

    keyed = known.where("cache_key is not null")
    entries = _in_order(keyed, "cache_key")
    both = cache.withColumn("_old", F.lit(True)).join(entries, "cache_key", "full_outer")
    old = F.coalesce(F.col("_old"), F.lit(False))
    begin = F.struct(*(F.col(f).alias(f) for f in ID_FIELDS), F.col("source").alias("source"), F.col("confidence").alias("confidence"), F.when(old, F.coalesce("found", F.lit(True))).alias("found"))

    def remember(acc, x):
        hit = _has_any(x)
        fresh = F.coalesce(~acc["found"], F.lit(True)) if overwrite_miss else acc["found"].isNull()
        source = F.when(hit, F.when(fresh, F.coalesce(x["source"], F.lit(NO_SOURCE))).otherwise(F.coalesce(acc["source"], x["source"], F.lit(NO_SOURCE)))).otherwise(F.coalesce(acc["source"], F.lit("none")))
        conf = F.when(hit, F.when(fresh, x["confidence"]).otherwise(F.coalesce(acc["confidence"], x["confidence"]))).otherwise(F.coalesce(acc["confidence"], F.lit(0.0)))
        return F.struct(*(F.coalesce(acc[f], x[f]).alias(f) for f in ID_FIELDS), source.alias("source"), conf.alias("confidence"), F.when(hit, True).otherwise(F.coalesce(acc["found"], F.lit(False))).alias("found"))

    noted = both.withColumn("_new", F.when(F.col("items").isNotNull(), _fold("items", begin, remember)))
    touched = F.col("items").isNotNull()
    take = {**{f: F.col(f"_new.{f}") for f in ID_FIELDS}, "source": F.col("_new.source"), "confidence": F.col("_new.confidence"), "found": F.col("_new.found"), "updated_at": as_of}
    changed_cache = noted.select(*((F.when(touched, take[c]).otherwise(F.col(c)) if c in take else F.when(touched & ~old, as_of).otherwise(F.col(c)) if c == "created_at" else F.col(c)).alias(c) for c in cache.columns))

    seen = known.agg(F.count("*").alias("updated"), F.count("cache_key").alias("cached"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad_values"))
    # one row each
    metrics = items.agg(F.count("*").alias("n")).crossJoin(seen).select("updated", "cached", (F.col("n") - F.col("updated") + F.col("bad_values")).alias("invalid"))
    return Applied(rows, changed_cache, metrics)
