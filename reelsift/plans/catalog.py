"""Registered queries over the driver tables, each with its SQL where SQL can express it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ids, lexicon, matching, text, titles
from ..operators import apply, audit, fuzzy, identity, lexicon_join, policy, purge, queue, rank, renumber, resolve, stats
from ..schema import ID_FIELDS, TITLE_CACHE, ensure_columns
from ..sources import answers
from ..sources.releases import as_of, derived_releases
from ..sources.scratch import settled, shared_dir
from . import oracle as o

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def register(name: str, query: Callable[[DataFrame], DataFrame], sql: str | None = None) -> None:
    """A query over the derived releases."""
    register_raw(name, lambda spark, sf_dir: query(derived_releases(spark, sf_dir)), sql)


def register_raw(name: str, query: Query, sql: str | None = None) -> None:
    if name in _queries:
        raise ValueError(f"{name} is registered twice")
    _queries[name] = query
    if sql is not None:
        _sql[name] = sql


def read(name: str) -> Query:
    return lambda spark, sf_dir: spark.read.parquet(f"{sf_dir}/{name}.parquet")




def named() -> Column:
    return text.effective_title(F.col("title"), F.col("title_text"))


def _swapped(r: DataFrame) -> DataFrame:
    """Releases without an inner name, with the names in the wrong columns."""
    return r.where(F.col("title_text").isNull()).select("id", F.col("title_text").alias("title"), F.concat("title", F.lit(" x264")).alias("title_text"))


counted = ["matched", "deleted", "skipped", "skipped_limit"]

# Text
register_raw("norm_text", lambda s, d: read("documents")(s, d).select("doc_id", F.md5(text.norm(F.col("text"))).alias("norm_md5")), f"SELECT doc_id, md5({o.norm('text')}) AS norm_md5 FROM documents")
register("effective_title", lambda r: r.select("id", named().alias("name")), o.over() + f"SELECT id, {o.NAME} AS name FROM releases")
register("title_key", lambda r: r.select("id", text.title_key(named()).alias("title_key")), o.over() + f"SELECT id, nullif({o.norm(o.NAME)}, '') AS title_key FROM releases")
register("token_match", lambda r: r.select("id", text.has_token(text.norm(F.col("title")), "xxx").alias("has_token")), o.over() + f"SELECT id, {o.norm('title')} <> '' AND contains(' ' || {o.norm('title')} || ' ', ' xxx ') AS has_token FROM releases")
register("quality_rank", lambda r: r.select("id", text.quality_rank(F.col("quality")).cast("long").alias("qrank")), o.over() + f"SELECT id, CAST({o.RANK} AS BIGINT) AS qrank FROM (SELECT id, lower(coalesce(quality, '')) AS q FROM releases)")
register("id_trust", lambda r: r.select("id", ids.trusted(F.col("ids_confidence"), F.col("ids_source")).alias("trusted")), o.over() + f"SELECT id, {o.TRUST} AS trusted FROM releases")
register("work_key", lambda r: r.select("id", ids.work_key().alias("work")), o.over() + f"SELECT id, {o.WORK} AS work FROM releases")
register("spanish_flags", lambda r: r.select("id", lexicon.any_spanish(F.col("audio")).alias("audio_es"), lexicon.any_spanish(F.col("subtitles")).alias("subs_es"), lexicon.is_spanish(named()).alias("hint_es")), o.over() + f"SELECT id, {o.any_spanish('audio')} AS audio_es, {o.any_spanish('subtitles')} AS subs_es, {o.spanish(o.NAME)} AS hint_es FROM releases")
register("type_csv_filter", lambda r: r.where(ids.type_wanted("movie, ")).select("id", "type"), o.over() + "SELECT id, type FROM releases WHERE coalesce(type, '') IN ('movie', '')")

# Queues
QUEUE_SQL = {"": ("title", "title_text", None), "_auto": (f"coalesce({o.blankless('title')}, {o.blankless('title_text')})", f"CASE WHEN {o.blankless('title')} IS NOT NULL THEN title_text END", "auto"), "_title": ("title", "title_text", "title"), "_title_text": ("title_text", "title", "title_text")}
for suffix, (main, other, column) in QUEUE_SQL.items():
    register(f"enrich_queue{suffix}", lambda r, column=column: queue.enrich_queue(r, as_of(), column=column), o.queue(main, other))
register("enrich_queue_types", lambda r: queue.enrich_queue(r, as_of(), only_types="movie,anime"), o.queue("title", "title_text", "AND coalesce(type, '') IN ('movie', 'anime')"))
register("missing_ids_queue", lambda r: queue.missing_ids_queue(r, as_of()), o.over() + f"SELECT id, title, title_text, title_text AS title_alt, type, season, episode, absolute_episode FROM releases WHERE {o.RETRY} ORDER BY coalesce(ids_attempts, 0), ids_checked_at ASC NULLS FIRST, id LIMIT 400")
register("retry_reset_metrics", lambda r: queue.reset_for_retry(r, as_of())[1], o.over() + f"SELECT count(CASE WHEN NOT {o.HAS_ID} THEN 1 END) AS matched, count(CASE WHEN {o.RETRY} THEN 1 END) AS queued, count(CASE WHEN NOT {o.HAS_ID} AND coalesce(ids_attempts, 0) >= 4 THEN 1 END) AS exhausted FROM releases")
register("retry_reset_rows", lambda r: queue.reset_for_retry(r, as_of())[0].select("id", "ids_checked_at", "updated_at"), o.over() + f"SELECT id, CASE WHEN {o.RETRY} THEN NULL ELSE ids_checked_at END AS ids_checked_at, CASE WHEN {o.RETRY} AND ids_checked_at IS NOT NULL THEN {o.AT} END AS updated_at FROM releases")
DETECT = f"SELECT CASE WHEN bool_and({o.blankless('title')} IS NULL) AND bool_or({o.signals('title_text')} >= 2) THEN 'title_text' ELSE 'title' END AS \"column\" FROM (SELECT * FROM @ ORDER BY id LIMIT 5)"
register("detect_title_column", lambda r: queue.title_column(r), o.over() + DETECT.replace("@", "releases"))
register("detect_title_column_swapped", lambda r: queue.title_column(_swapped(r)), o.over("swapped AS (SELECT id, title_text AS title, title || ' x264' AS title_text FROM releases WHERE title_text IS NULL)") + DETECT.replace("@", "swapped"))

# Purges
register("purge_junk_candidates", lambda r: r.where(purge.is_junk()).select("id", named().alias("name")), o.over() + f"SELECT id, {o.NAME} AS name FROM releases WHERE {o.JUNK}")
register("purge_junk_metrics", lambda r: purge.purge_junk(r, limit=100).metrics.select(*counted), o.over() + o.purge_metrics(o.JUNK, 100))
register("purge_junk_survivors", lambda r: purge.purge_junk(r, purge_empty=True).survivors.select("id"), o.over() + f"SELECT id FROM releases WHERE NOT ({o.JUNK} OR {o.NAME} IS NULL)")
register("purge_junk_sample", lambda r: purge.sample(r, purge.is_junk()).select(F.to_json("sample").alias("sample_json")), o.over() + f"SELECT '[' || string_agg('{{\"id\":' || id || ',\"title\":\"' || name || '\"}}', ',' ORDER BY id) || ']' AS sample_json FROM (SELECT id, {o.NAME} AS name FROM releases WHERE {o.JUNK} ORDER BY id LIMIT 5)")
register("purge_blocked_candidates", lambda r: r.where(lexicon.blocked()).select("id"), o.over() + f"SELECT id FROM ({o.blocked_test()})")
register("purge_blocked_capped", lambda r: purge.purge_blocked(r, limit=500).survivors.select("id"), o.over(f"bad AS ({o.blocked_test()})") + "SELECT id FROM releases WHERE id NOT IN (SELECT id FROM bad ORDER BY id LIMIT 500)")
register("purge_blocked_metrics", lambda r: purge.purge_blocked(r, limit=500).metrics.select(*counted), o.over(f"bad AS ({o.blocked_test()})") + o.purge_metrics("true", 500, "bad"))
register("purge_blocked_reason", lambda r: r.select("id", lexicon.block_reason(soft=True).alias("reason")).where("reason <> ''"), o.over() + f"SELECT id, reason FROM ({o.block_reasons()}) WHERE reason IS NOT NULL")
register("purge_absolute_candidates", lambda r: r.where(purge.is_absolute_only()).select("id"), o.over() + f"SELECT id FROM releases WHERE {o.ABSOLUTE}")
register("purge_absolute_nullified", lambda r: purge.purge_absolute_only(r, as_of(), action="nullify", limit=50).survivors.select("id", "absolute_episode", "updated_at"), o.over(f"hit AS (SELECT id FROM releases WHERE {o.ABSOLUTE} ORDER BY id LIMIT 50)") + f"SELECT id, CASE WHEN id NOT IN (SELECT id FROM hit) THEN absolute_episode END AS absolute_episode, CASE WHEN id IN (SELECT id FROM hit) THEN {o.AT} END AS updated_at FROM releases")
register("purge_dead_metrics", lambda r: purge.purge_dead(r, as_of()).metrics.select(*counted), o.over() + o.purge_metrics(o.DEAD))
register("purge_dead_survivors", lambda r: purge.purge_dead(r, as_of()).survivors.select("id"), o.over() + f"SELECT id FROM releases WHERE NOT {o.DEAD}")

# Ranking
register("keep_best_keepers", lambda r: rank.keepers(r).select("id", *rank.GROUP, F.col("rn").cast("long").alias("rn")), o.over(o.SCOPED, o.RANKED) + "SELECT id, work, gseason, gep, rn FROM ranked WHERE rn <= 3")
register("keep_best_deleted", lambda r: rank.keep_best(r).victims, o.over(o.SCOPED, o.RANKED) + "SELECT id FROM ranked WHERE rn > 3")
register("keep_best_capped", lambda r: rank.keep_best(r, max_deletes=1000).survivors.select("id"), o.over(o.SCOPED, o.RANKED) + f"SELECT id FROM releases WHERE id NOT IN (SELECT id FROM ranked WHERE rn > 3 ORDER BY {o.IN_ORDER} LIMIT 1000)")
register("keep_best_metrics", lambda r: rank.keep_best(r, max_deletes=1000).metrics, o.over(o.SCOPED, o.RANKED) + "SELECT (SELECT count(*) FROM (SELECT DISTINCT work, gseason, gep FROM scoped)) AS groups, (SELECT count(*) FROM scoped) AS matched, least(1000, (SELECT count(*) FROM ranked WHERE rn > 3)) AS deleted, (SELECT count(*) FROM ranked WHERE rn <= 3) AS kept, (SELECT count(*) FROM releases) - (SELECT count(*) FROM scoped) AS skipped, greatest((SELECT count(*) FROM ranked WHERE rn > 3) - 1000, 0) AS skipped_limit")
register("dedupe_victims", lambda r: rank.duplicates(rank.spanish_scoped(r)), o.over(o.SCOPED, o.DUPES) + "SELECT id FROM dupes")
register("keep_best_es_rank", lambda r: rank.keep_best_spanish(r).ranked.select("id", *rank.GROUP, F.col("es_score").cast("long").alias("es_score"), F.col("rn").cast("long").alias("rn"), "n_es"), o.over(o.SCOPED, o.DUPES, o.ES_RANKED) + "SELECT id, work, gseason, gep, CAST(es_score AS BIGINT) AS es_score, rn, n_es FROM placed")
register("keep_best_es_deleted", lambda r: rank.keep_best_spanish(r).candidates.select("id", "reason"), o.over(o.SCOPED, o.DUPES, o.ES_RANKED) + "SELECT id, 'top' AS reason FROM placed WHERE rn > 3")
register("keep_best_es_strict", lambda r: rank.keep_best_spanish(r, strict=True).candidates.select("id", "reason"), o.over(o.SCOPED, o.DUPES, o.ES_RANKED) + "SELECT id, CASE WHEN n_es < 2 THEN 'strict' ELSE 'top' END AS reason FROM placed WHERE n_es < 2 OR rn > 3")
register("keep_best_es_capped", lambda r: rank.keep_best_spanish(r, max_deletes=700).survivors.select("id"), o.over(o.SCOPED, o.DUPES, *o.capped_es(700)) + "SELECT id FROM releases WHERE id NOT IN (SELECT id FROM gone) AND id NOT IN (SELECT id FROM over_ids)")
register("keep_best_es_capped_metrics", lambda r: rank.keep_best_spanish(r, max_deletes=700).metrics.select("groups", "matched", "deleted", "duplicates", "skipped_limit"), o.over(o.SCOPED, o.DUPES, *o.capped_es(700)) + "SELECT (SELECT count(*) FROM (SELECT DISTINCT work, gseason, gep FROM scoped)) AS groups, (SELECT count(*) FROM scoped) AS matched, d AS deleted, (SELECT count(*) FROM dupes) AS duplicates, (SELECT count(*) FROM dupes) + (SELECT count(*) FROM placed WHERE rn > 3) - d AS skipped_limit FROM (SELECT (SELECT count(*) FROM gone) + (SELECT count(*) FROM over_ids) AS d)")
register("keep_best_es_metrics", lambda r: rank.keep_best_spanish(r).metrics, o.es_metrics(False))
register("keep_best_es_strict_metrics", lambda r: rank.keep_best_spanish(r, strict=True).metrics, o.es_metrics(True))
register("spanish_gaps", lambda r: rank.spanish_gaps(r, limit=None), o.over(o.SCOPED) + "SELECT min(titulo) AS title, gseason AS season, gep AS episode, count(*) AS total, count(CASE WHEN audio_es THEN 1 END) AS with_audio, count(CASE WHEN subs_es AND NOT audio_es THEN 1 END) AS with_subs FROM scoped GROUP BY work, gseason, gep HAVING count(CASE WHEN audio_es OR subs_es THEN 1 END) < 2")
register("spanish_gaps_top", lambda r: rank.spanish_gaps(r), o.over(o.SCOPED) + "SELECT title, season, episode, total, with_audio, with_subs FROM (SELECT work, min(titulo) AS title, gseason AS season, gep AS episode, count(*) AS total, count(CASE WHEN audio_es THEN 1 END) AS with_audio, count(CASE WHEN subs_es AND NOT audio_es THEN 1 END) AS with_subs, count(CASE WHEN audio_es OR subs_es THEN 1 END) AS n FROM scoped GROUP BY work, gseason, gep) WHERE n < 2 ORDER BY n, total DESC, work, season NULLS FIRST, episode NULLS FIRST LIMIT 15")

# Statistics
register("ids_stats", stats.ids_stats, o.over() + f"SELECT count(*) AS total, count(CASE WHEN NOT {o.HAS_ID} THEN 1 END) AS without_ids, count(tmdb_id) AS with_tmdb_id, count({o.IMDB}) AS with_imdb_id, count(anilist_id) AS with_anilist_id, count(kitsu_id) AS with_kitsu_id, count(mal_id) AS with_mal_id FROM releases")
register("quality_stats_by_type", lambda r: stats.counts_by(r, "type", "kind"), o.over() + "SELECT coalesce(type, '?') AS kind, count(*) AS n FROM releases GROUP BY 1")
register("quality_stats_by_quality", lambda r: stats.counts_by(r, "quality", "quality"), o.over() + "SELECT coalesce(quality, '?') AS quality, count(*) AS n FROM releases GROUP BY 1")
register("quality_stats_totals", stats.quality_totals, o.over() + "SELECT count(*) AS total, count(CASE WHEN coalesce(seeders, 0) <= 0 THEN 1 END) AS without_seeders, count(CASE WHEN absolute_episode IS NOT NULL AND episode IS NULL THEN 1 END) AS absolute_only, count(CASE WHEN type IN ('series', 'anime') AND season IS NULL THEN 1 END) AS without_season FROM releases")
_told = lambda m: F.array_join(F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",").alias(m)
register("quality_stats_maps", lambda r: stats.quality_stats(r).select("total", _told("by_type"), _told("by_quality")), o.over() + "SELECT (SELECT count(*) FROM releases) AS total, (SELECT string_agg(k || '=' || n, ',' ORDER BY k) FROM (SELECT coalesce(type, '?') AS k, count(*) AS n FROM releases GROUP BY 1)) AS by_type, (SELECT string_agg(k || '=' || n, ',' ORDER BY k) FROM (SELECT coalesce(quality, '?') AS k, count(*) AS n FROM releases GROUP BY 1)) AS by_quality")
register("spanish_stats", stats.spanish_stats, o.over() + "SELECT *, total - audio_es - subs_only AS none FROM (SELECT count(*) AS total, count(CASE WHEN a THEN 1 END) AS audio_es, count(CASE WHEN b THEN 1 END) AS subs_es, count(CASE WHEN b AND NOT a THEN 1 END) AS subs_only FROM (SELECT " + o.any_spanish("audio") + " AS a, " + o.any_spanish("subtitles") + " AS b FROM releases))")
#: All releases under ids with gaps.
_gapped = lambda r: r.withColumn("id", F.expr("id + id div 2 + 3"))
GAPPED = "gapped AS (SELECT id + id // 2 + 3 AS id FROM releases)"
register("id_report", lambda r: stats.id_report(_gapped(r)), o.over(GAPPED) + "SELECT count(*) AS total, min(id) AS min_id, max(id) AS max_id, max(id) - min(id) + 1 - count(*) AS gaps, max(id) = count(*) AND min(id) = 1 AS ready, max(id) + 1 AS next_id, CAST(0 AS BIGINT) AS foreign_keys FROM gapped")
register("renumber_map", lambda r: renumber.renumber_map(_gapped(r)), o.over(GAPPED) + "SELECT id, row_number() OVER (ORDER BY id) AS new_id FROM gapped")
register("renumber_rows", lambda r: renumber.renumber(_gapped(r), force=True).rows.select("id", "title", "size_bytes"), o.over() + "SELECT row_number() OVER (ORDER BY id) AS id, title, size_bytes FROM releases")


def _renumber_note(r: DataFrame) -> DataFrame:
    done = renumber.renumber(_gapped(r), dry_run=True, force=True)
    return r.sparkSession.createDataFrame([(done.status, done.note)], "status string, note string")


register("renumber_preview", _renumber_note, o.over(GAPPED) + "SELECT 'preview' AS status, min(id) || '..' || max(id) || ' -> 1..' || count(*) AS note FROM gapped")


# Identifiers from a batch
def _batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch derived from events, with clean, dirty, blank and unknown values."""
    e, u = F.col("event_id"), F.col("user_id")
    text_of = lambda c: c.cast("string")
    return read("events")(spark, sf_dir).select(
        e.alias("pos"), text_of(u * 7 % 16000).alias("id"),
        F.when(e % 5 == 0, text_of(e % 900)).when(e % 5 == 1, " 42 ").when(e % 5 == 2, "12 34").when(e % 5 == 3, "").alias("tmdb_id"),
        F.when(e % 4 == 0, F.concat(F.lit("TT"), text_of(e % 1000))).when(e % 4 == 1, "ttx").alias("imdb_id"),
        F.when(e % 3 == 0, "99999999999").when(e % 3 == 1, text_of(e)).alias("anilist_id"), F.when(e % 6 == 0, "0").alias("kitsu_id"), F.when(e % 9 == 0, "mal!").alias("mal_id"),
        F.when(e % 2 == 0, F.col("event_type")).alias("source"), F.when(e % 3 == 0, text_of(e % 7)).when(e % 3 == 1, "high").alias("confidence"), F.when(e % 4 != 3, F.concat(F.lit("key|"), text_of(u % 50))).alias("cache_key"),
    )


def _applied(spark: SparkSession, sf_dir: str) -> apply.Applied:
    i = F.col("id")
    hit = i % 3 == 0
    cache = spark.range(30, 70).select(F.concat(F.lit("key|"), i.cast("string")).alias("cache_key"), F.when(hit, i + 1).cast("int").alias("tmdb_id"), hit.alias("found"), F.when(hit, "old").otherwise("none").alias("source"), F.when(hit, 0.3).otherwise(0.0).alias("confidence"))
    return apply.apply_ids(derived_releases(spark, sf_dir), ensure_columns(cache, TITLE_CACHE), _batch(spark, sf_dir), as_of())


register_raw("sanitize_ids", lambda s, d: apply.cleaned(_batch(s, d)).select("pos", *ID_FIELDS, F.col("bad").cast("long").alias("bad"), "confidence"), o.over(o.apply_ctes()) + f"SELECT pos, {', '.join(ID_FIELDS)}, CAST(bad AS BIGINT) AS bad, CAST(confidence AS DOUBLE) AS confidence FROM clean")
register_raw("apply_ids_rows", lambda s, d: _applied(s, d).rows.where(F.col("updated_at").isNotNull()).select("id", *ID_FIELDS, "ids_source", "ids_confidence", "ids_attempts", "ids_checked_at"), o.over(o.apply_ctes()) + o.apply_rows())
register_raw("apply_ids_metrics", lambda s, d: _applied(s, d).metrics, o.over(o.apply_ctes()) + "SELECT (SELECT count(*) FROM known) AS updated, (SELECT count(cache_key) FROM known) AS cached, (SELECT count(*) FROM clean) - (SELECT count(*) FROM known) + (SELECT CAST(coalesce(sum(bad), 0) AS BIGINT) FROM known) AS invalid")
NOTED = o.over(o.apply_ctes(), o.noted_cache())
register_raw("apply_ids_cache", lambda s, d: _applied(s, d).cache.select("cache_key", *ID_FIELDS, "found", "source", "confidence"), NOTED + f"SELECT cache_key, {', '.join(ID_FIELDS)}, found, source, confidence FROM noted")
register_raw("title_cache_lookup", lambda s, d: queue.title_cache_lookup(_applied(s, d).cache, s.range(20, 60).select(F.concat(F.lit("key|"), F.col("id").cast("string")).alias("cache_key"))).select("cache_key", "found", "source"), NOTED + "SELECT cache_key, found, source FROM noted WHERE cache_key IN (SELECT 'key|' || i FROM range(20, 60) t(i))")


def _json_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived batch as JSON arrays of a hundred items, read back."""
    rows = _batch(spark, sf_dir)
    items = F.to_json(F.transform(F.array_sort(F.collect_list(F.struct(*rows.columns))), lambda x: F.struct(*(x[c].alias(c) for c in rows.columns if c != "pos"))))
    packed = rows.groupBy(F.floor(F.col("pos") / 100).alias("part")).agg(F.min("pos").alias("first"), items.alias("payload"))
    read_back = packed.select("first", F.posexplode(F.from_json("payload", apply.PAYLOAD)).alias("k", "x")).select((F.col("first") + F.col("k")).alias("pos"), "x.*")
    return apply.cleaned(read_back).select("pos", "id", *ID_FIELDS, "source", "confidence", "cache_key")


register_raw("json_batch", _json_batch, o.over(o.apply_ctes()) + f"SELECT pos, id, {', '.join(ID_FIELDS)}, source, CAST(confidence AS DOUBLE) AS confidence, cache_key FROM clean")
register("cache_key", lambda r: r.select("id", ids.cache_key(named(), F.col("season"), F.col("type")).alias("cache_key")), o.over() + f"SELECT id, {o.norm(o.NAME)} || '|' || coalesce(CAST(season AS VARCHAR), '') || '|' || coalesce(type, '') AS cache_key FROM releases")
register("miss_freshness", lambda r: r.select("id", ids.miss_is_fresh(F.col("created_at"), as_of()).alias("fresh")), o.over() + f"SELECT id, coalesce(created_at + INTERVAL 20 DAY > {o.AT}, false) AS fresh FROM releases")
register("id_completeness", lambda r: r.select("id", ids.complete(F.col("type")).alias("complete")), o.over() + f"SELECT id, CASE WHEN type IN ('movie', 'series') THEN tmdb_id IS NOT NULL AND {o.IMDB} IS NOT NULL WHEN type = 'anime' THEN anilist_id IS NOT NULL AND kitsu_id IS NOT NULL AND mal_id IS NOT NULL AND {o.IMDB} IS NOT NULL ELSE CAST(tmdb_id IS NOT NULL AS INT) + CAST({o.IMDB} IS NOT NULL AS INT) + CAST(anilist_id IS NOT NULL AS INT) + CAST(kitsu_id IS NOT NULL AS INT) + CAST(mal_id IS NOT NULL AS INT) >= 2 END AS complete FROM releases")

# Names
_word = lambda c: F.concat(F.translate(text.norm(F.col(c)), " ", "."), F.lit(".S0"), (F.col("id") % 9 + 1).cast("string"), F.lit("E"), (F.col("id") % 50 + 1).cast("string"), F.lit("."), F.coalesce("quality", F.lit("none")), F.lit("."), F.col("codec"), F.lit("-"), F.col("release_group"))
MADE = "translate(" + o.norm("title") + ", ' ', '.') || '.S0' || (id % 9 + 1) || 'E' || (id % 50 + 1) || '.' || coalesce(quality, 'none') || '.' || codec || '-' || release_group"
register(
    "parse_release_numbers",
    lambda r: r.select("id", titles.parse_release(_word("title")).alias("p")).select("id", "p.season", "p.episode", "p.codec", "p.release_group"),
    o.over(f"made AS (SELECT id, codec, release_group, {MADE} AS n FROM releases)") + r"SELECT id, CAST(regexp_extract(n, '\b[Ss](\d{1,2})[ ._-]*[Ee](\d{1,3})\b', 1) AS INT) AS season, CAST(regexp_extract(n, '\b[Ss](\d{1,2})[ ._-]*[Ee](\d{1,3})\b', 2) AS INT) AS episode, codec, release_group FROM made",
)
#: Names of all the forms that are told apart: SxxEyy, NxM, words, a dash and a bracket, a year, leading groups, extensions, and none of these.
_forms = lambda: F.when(F.col("id") % 7 == 0, F.concat(F.lit("[Grp] "), F.col("title"), F.lit(" - "), (F.col("id") % 400).cast("string"), F.lit(" (1080p).mkv"))).when(F.col("id") % 7 == 1, F.concat(F.col("title"), F.lit("."), (F.col("id") % 70).cast("string"), F.lit("x0"), (F.col("id") % 9).cast("string"), F.lit(".WEB-DL.x265"))).when(F.col("id") % 7 == 2, F.concat(F.col("title"), F.lit(" Season "), (F.col("id") % 9 + 1).cast("string"), F.lit(" Episode "), (F.col("id") % 30).cast("string"), F.lit(" hdr10"))).when(F.col("id") % 7 == 3, F.concat(F.col("title"), F.lit(" Capitulo "), (F.col("id") % 500).cast("string"))).when(F.col("id") % 7 == 4, F.concat(F.col("title"), F.lit(" ("), (F.col("id") % 60 + 1960).cast("string"), F.lit(") BluRay Latino"))).when(F.col("id") % 7 == 5, _word("title")).otherwise(F.col("title"))
FORMS = f"CASE id % 7 WHEN 0 THEN '[Grp] ' || title || ' - ' || (id % 400) || ' (1080p).mkv' WHEN 1 THEN title || '.' || (id % 70) || 'x0' || (id % 9) || '.WEB-DL.x265' WHEN 2 THEN title || ' Season ' || (id % 9 + 1) || ' Episode ' || (id % 30) || ' hdr10' WHEN 3 THEN title || ' Capitulo ' || (id % 500) WHEN 4 THEN title || ' (' || (id % 60 + 1960) || ') BluRay Latino' WHEN 5 THEN {MADE} ELSE title END"
register("parse_release", lambda r: r.select("id", titles.parse_release(_forms()).alias("p")).select("id", "p.*"), o.over(o.parsed(FORMS)) + "SELECT * FROM parsed")
register("release_signals", lambda r: r.select("id", titles.release_signals(_forms()).cast("long").alias("signals")), o.over() + f"SELECT id, {o.signals(FORMS)} AS signals FROM releases")
_PICKED = f"SELECT id, CASE WHEN s THEN b ELSE a END AS main, CASE WHEN s THEN a ELSE b END AS other FROM (SELECT *, coalesce(a IS NOT NULL AND b IS NOT NULL AND {o.signals('b')} > {o.signals('a')}, false) AS s FROM (SELECT id, {o.blankless('title_text')} AS a, {o.blankless('title')} AS b FROM releases))"
register("pick_name", lambda r: r.select("id", titles.pick_name(F.col("title_text"), F.col("title")).alias("p")).select("id", "p.*"), o.over() + _PICKED)
register("title_variants", lambda r: r.select("id", F.explode(matching.variants(F.col("title"))).alias("v")).select("id", "v.*"), o.over(o.variant_names()) + "SELECT id, text, lax FROM tried")
register("aggressive_variants", lambda r: r.select("id", F.explode(matching.aggressive_variants(F.col("title"))).alias("variant")), o.over(o.aggressive_names()) + f"SELECT id, text AS variant FROM tried WHERE n <> {o.norm('t')}")


#: Words of a phrase.
PHRASE = 8


def _phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many phrases of PHRASE normalized words of each benchmark item occur in which documents.

    All phrases of all items are looked for by an equi-join; the items' phrases are broadcast where they are counted to be few, so that documents' phrases are met where they are made."""
    words = lambda df: df.withColumn("w", F.split(text.norm(F.col("text")), " "))
    of = lambda df, key: words(df).where(F.size("w") >= PHRASE).select(key, F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.size("w") - (PHRASE - 1)), lambda i: F.array_join(F.slice("w", i, PHRASE), " ")))).alias("phrase"))
    items = of(read("benchmark")(spark, sf_dir), "item_id")
    items = F.broadcast(items) if items.count() <= 100_000 else items
    return of(read("documents")(spark, sf_dir), "doc_id").join(items, "phrase").groupBy("doc_id", "item_id").agg(F.count("*").alias("phrases"))


def _phrase_sql(table: str, key: str) -> str:
    return f"SELECT DISTINCT {key}, array_to_string(w[i:i+{PHRASE - 1}], ' ') AS phrase FROM (SELECT {key}, w, unnest(range(1, len(w) - {PHRASE - 2})) AS i FROM (SELECT {key}, string_split({o.norm('text')}, ' ') AS w FROM {table}) WHERE len(w) >= {PHRASE})"


register_raw("benchmark_phrase_containment", _phrases, f"SELECT doc_id, item_id, count(*) AS phrases FROM ({_phrase_sql('documents', 'doc_id')}) JOIN ({_phrase_sql('benchmark', 'item_id')}) USING (phrase) GROUP BY ALL")


def _similar_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names against that of the next id."""
    names = derived_releases(spark, sf_dir).select("id", named().alias("name"))
    return names.join(names.select((F.col("id") - 1).alias("id"), F.col("name").alias("other")), "id").select("id", F.round(matching.similarity("name", "other"), 6).alias("alike"))


register_raw("similarity_pairs", _similar_names)


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    least = [F.min(f).alias(f) for f in ID_FIELDS]
    # equal titles are parsed once
    r = derived_releases(spark, sf_dir).where("title <> ''").groupBy(F.when(F.col("id") % 2 == 0, "tmdb").otherwise("imdb").alias("provider"), F.col("title").alias("whole")).agg(*least)
    return r.withColumn("p", titles.parse_release(F.col("whole"))).groupBy("provider", F.col("p.title").alias("title"), F.col("p.year").alias("year")).agg(*least)


register_raw("resolve_outcome", lambda s, d: resolve.resolve(queue.whole_enrich_queue(derived_releases(s, d), as_of(), column="auto"), _candidates(s, d)).select("id", "source", "confidence", "outcome"))

def _alike(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of different names of releases that are alike enough to be a match, whatever the years."""
    names = derived_releases(spark, sf_dir).select(titles.parse_release(F.col("title"))["title"].alias("title"))
    found = fuzzy.alike_names(names.withColumnRenamed("title", "query"), names, matching.ACCEPT - 0.05)
    return found.where("search < name").select("search", "name", F.round("alike", 6).alias("alike"))


register_raw("fuzzy_candidates", _alike)


# Works: identifiers that customers' keys stand for, side by side in rows and in mapping answers; some lead from one work to the next, which is a conflict
def _sighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey").cast("int")
    return read("customer")(spark, sf_dir).select(
        F.col("c_custkey").alias("id"), F.when(c % 2 == 0, c).alias("tmdb_id"), F.when(c % 3 < 2, F.concat(F.lit("tt"), (c + 1000000).cast("string"))).alias("imdb_id"),
        F.when(c % 11 < 6, F.when(c % 40 == 0, c + 1).otherwise(c)).alias("anilist_id"), F.when(c % 5 < 3, c).alias("kitsu_id"), F.when(c % 7 < 5, c).alias("mal_id"),
    )


def _works(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    item = lambda site, id: F.struct(F.struct(F.lit(site).alias("externalSite"), id.cast("string").alias("externalId")).alias("attributes"))
    key = F.col("c_custkey")
    answers = read("customer")(spark, sf_dir).where(key % 4 == 0).select(key.cast("string").alias("key"), F.to_json(F.struct(F.array(item("myanimelist/anime", key), item("anilist", key), item("thetvdb", key)).alias("data"))).alias("payload"))
    return identity.edges_of(_sighted(spark, sf_dir)), identity.edges_of(identity.mapping_ids(answers))


def _members(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, more = _works(spark, sf_dir)
    return identity.classes(first.unionByName(more))


register_raw("identity_classes", _members, o.WORKS + "SELECT node, root FROM classes")
register_raw("identity_conflicts", lambda s, d: identity.conflicts(_members(s, d)), o.WORKS + "SELECT root, site, n, low, high FROM sites WHERE n > 1")
register_raw(
    "identity_fill",
    lambda s, d: identity.fill(_sighted(s, d).select("id", "tmdb_id", F.when(F.col("tmdb_id").isNull(), F.col("imdb_id")).alias("imdb_id"), *(F.lit(None).cast("int").alias(f) for f in ("anilist_id", "kitsu_id", "mal_id"))), identity.closure(*_works(s, d))),
    o.WORKS + o.FILLED,
)


def _lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lexicon that grows with the documents: beginnings of their texts of one to three words, raw pieces of them, and allowed beginnings."""
    k, w = F.col("doc_id"), F.col("w")
    # texts are normalized once
    docs = settled(read("documents")(spark, sf_dir).select("doc_id", F.slice(F.split(text.norm(F.col("text")), " "), 1, 3).alias("w"), F.substring("text", 2, 6).alias("piece")))
    token = F.when(k % 4 < 3, F.array_join(F.slice(w, F.lit(1), (k % 4 + 1).cast("int")), " ")).otherwise(F.col("piece"))
    allow = docs.where(k % 9 == 0).select(k.alias("ord"), F.lit("allow").alias("kind"), F.array_join(F.slice(w, 1, 2), " ").alias("token"))
    return lexicon_join.lexicon_of(docs.select(k.alias("ord"), F.lit("blocked").alias("kind"), token.alias("token")).unionByName(allow))


register_raw("purge_blocked_by_table", lambda s, d: lexicon_join.blocked_by(derived_releases(s, d), _lexicon(s, d)), o.over(o.LEXICON) + o.BLOCKED_BY)

# Answers as the providers store them: written for each release's provider, read back through the source, shredded into candidates
def _turn() -> Column:
    return F.element_at(F.array(*(F.lit(p) for p in resolve.PROVIDERS)), (F.col("id") % len(resolve.PROVIDERS) + 1).cast("int"))


def _payload() -> Column:
    n, year, title = F.col("id").cast("int"), (F.col("id") % 70 + 1950).cast("int"), F.col("title")
    day, tt = F.concat(year.cast("string"), F.lit("-02-03")), F.concat(F.lit("tt"), (n + 1000000).cast("string"))
    one = lambda **fields: F.struct(*(v.alias(k) for k, v in fields.items()))
    shapes = {
        "anilist": lambda: one(data=one(Page=one(media=F.array(one(id=n, idMal=n + 1, seasonYear=year, title=one(romaji=title, english=F.col("title_text"))))))),
        "kitsu": lambda: one(data=F.array(one(id=n.cast("string"), attributes=one(canonicalTitle=title, startDate=day)))),
        "jikan": lambda: one(data=F.array(one(mal_id=n, title=title, title_english=title, year=year))),
        "imdb": lambda: one(d=F.array(one(id=tt, l=title, y=year), one(id=F.lit("nm0000001"), l=title, y=year))),
        "tvmaze": lambda: F.array(one(show=one(name=title, premiered=day, externals=one(imdb=tt)))),
        "tmdb": lambda: one(results=F.array(one(id=n, name=title, first_air_date=day))),
        "omdb": lambda: one(Title=title, Year=F.concat(year.cast("string"), F.lit("\u20132020")), imdbID=tt, Response=F.when(n % 2 == 0, "True").otherwise("False")),
    }
    out = F.when(F.lit(False), "")
    for p, shape in shapes.items():
        out = out.when(_turn() == p, F.to_json(shape()))
    return out


def _answers(spark: SparkSession, sf_dir: str) -> Callable[[str], DataFrame]:
    path = f"{shared_dir(spark).rstrip('/')}/answers-{uuid.uuid4().hex}"
    answers.write_answers(derived_releases(spark, sf_dir).select(_turn().alias("provider"), F.col("id").cast("string").alias("key"), _payload().alias("payload")), path)
    return lambda provider: answers.read_answers(spark, path, provider=provider)


register_raw("lookup_candidates", lambda s, d: resolve.candidates_of(_answers(s, d)).select("key", "provider", "title", "year", *ID_FIELDS), o.over() + o.CANDIDATES)
register_raw("resolve_from_answers", lambda s, d: resolve.resolve(queue.whole_enrich_queue(derived_releases(s, d), as_of(), column="auto"), settled(resolve.candidates_of(_answers(s, d)).drop("key"))).select("id", "source", "confidence", "outcome"))


def _audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    policy = read("nation")(spark, sf_dir).select(F.when(F.col("n_nationkey") % 2 == 0, "table").otherwise("function").alias("kind"), F.col("n_name").alias("object"), F.when(F.col("n_nationkey") % 3 == 0, "anon").otherwise("service").alias("role"), F.when(F.col("n_nationkey") % 2 == 0, "delete").otherwise("execute").alias("privilege"), (F.col("n_nationkey") % 4 == 0).alias("row_security"))
    return audit.security_audit(policy)


register_raw("security_audit", _audit, "SELECT 'CRITICAL' AS level, 'anon may execute ' || n_name AS finding FROM nation WHERE n_nationkey % 2 = 1 AND n_nationkey % 3 = 0 UNION SELECT 'CRITICAL', 'anon may delete ' || n_name FROM nation WHERE n_nationkey % 2 = 0 AND n_nationkey % 3 = 0 UNION SELECT 'WARNING', 'no row security on ' || n_name FROM nation WHERE n_nationkey % 2 = 0 AND n_nationkey % 4 <> 0")


#: Rules over the releases: guests see seeded movies and all of one tracker, with hashed names and no identifiers of one site; members see what isn't blocked by its name.
_RULES = [
    ("a", "releases", "guest", "select", "type = 'movie' and seeders > 10", None, None), ("b", "releases", "guest", "select", "source_tracker = 'pub'", None, None),
    ("c", "releases", "guest", "select", None, "title", "substring(sha2(title, 256), 1, 8)"), ("c", "releases", "public", "select", None, "imdb_id", None),
    ("d", "releases", "member", "all", "title not like '%XXX%'", None, None), ("e", "others", "guest", "all", None, None, None),
]


def _seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each role sees of the releases."""
    rules = policy.rules_of(spark.createDataFrame(_RULES, policy.RULES), "releases")
    seen = [policy.visible(derived_releases(spark, sf_dir), rules, role).select(F.lit(role).alias("role"), "id", "title", "imdb_id", "tmdb_id") for role in ("guest", "member", "nobody", "service_role")]
    return seen[0].unionByName(seen[1]).unionByName(seen[2]).unionByName(seen[3])


register_raw(
    "row_policies",
    _seen,
    o.over() + "SELECT 'guest' AS role, id, substring(sha256(title), 1, 8) AS title, CAST(NULL AS VARCHAR) AS imdb_id, tmdb_id FROM releases WHERE type = 'movie' AND seeders > 10 OR source_tracker = 'pub' UNION ALL SELECT 'member', id, title, NULL, tmdb_id FROM releases WHERE title NOT LIKE '%XXX%' UNION ALL SELECT 'service_role', id, title, imdb_id, tmdb_id FROM releases",
)


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)
