"""Resolving identifiers from offline candidate tables: all names that are alike enough, and rounds of searches whose first finds stay."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import any_id, cache_key, complete, miss_is_fresh
from ..functions.matching import ACCEPT, ACCEPT_LAX, OTHER_YEAR, SAME_YEAR, VARIANT_WEIGHT, accepted, aggressive_variants, confidence, variants
from ..functions.text import norm
from ..functions.titles import parse_release, pick_name
from ..schema import ID_FIELDS
from ..sources.scratch import settled
from . import identity
from .fuzzy import best_names

#: The providers in the order that they are asked in (what an earlier one finds stays), the types that each is asked for
#: (null: rows of no known type), and those that are asked for aggressive variants.
PROVIDERS = {
    "anilist": ("anime", None), "kitsu": ("anime", None), "jikan": ("anime", None), "imdb": ("movie", "series", "anime", None),
    "tvmaze": ("series", None), "tmdb": ("movie", "series", None), "omdb": ("movie", "series", "anime", None),
}
LIGHT = ("imdb", "anilist", "kitsu")
#: Name and confidence of an identifier found by an exact pair.
BRIDGE, BRIDGE_CONFIDENCE = "tmdb:find", 0.95

#: JSON answers of the providers, as far as they are read.
PAYLOADS = {
    "tmdb": "struct<results:array<struct<id:bigint,title:string,name:string,release_date:string,first_air_date:string>>>",
    "omdb": "struct<Title:string,Year:string,imdbID:string,Response:string>",
    "imdb": "struct<d:array<struct<id:string,l:string,y:int>>>",
    "anilist": "struct<data:struct<Page:struct<media:array<struct<id:bigint,idMal:bigint,seasonYear:int,title:struct<romaji:string,english:string>>>>>>",
    "jikan": "struct<data:array<struct<mal_id:bigint,title:string,title_english:string,year:int>>>",
    "kitsu": "struct<data:array<struct<id:string,attributes:struct<canonicalTitle:string,startDate:string>>>>",
    "tvmaze": "array<struct<show:struct<name:string,premiered:string,externals:struct<imdb:string>>>>",
}


def _year(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, r"^(\d{4})", 1), F.lit("")).try_cast("int")


def parse_payload(rows: DataFrame, provider: str, column: str = "payload") -> DataFrame:
    """(key, provider, title, year, identifiers) candidates of JSON answers given as rows (key, payload)."""
    x = F.from_json(column, PAYLOADS[provider])
    one = rows.withColumn("x", x)
    if provider == "omdb":
        found = one.where("x.Response is null or x.Response <> 'False'").select("key", F.col("x.Title").alias("title"), _year(F.col("x.Year")).alias("year"), F.col("x.imdbID").alias("imdb_id"))
    else:
        items = {"tmdb": "x.results", "imdb": "x.d", "anilist": "x.data.Page.media", "jikan": "x.data", "kitsu": "x.data", "tvmaze": "x"}[provider]
        one = one.select("key", F.explode(items).alias("i"))
        # a row for each different name, so that the one nearest to a search counts
        names = lambda *of: one.select("*", F.explode(F.array_distinct(F.array_compact(F.array(*of)))).alias("title"))
        found = {
            "tmdb": lambda: one.select("key", F.coalesce("i.title", "i.name").alias("title"), _year(F.coalesce("i.release_date", "i.first_air_date")).alias("year"), F.col("i.id").alias("tmdb_id")),
            "imdb": lambda: one.select("key", F.col("i.l").alias("title"), F.col("i.y").alias("year"), F.when(F.col("i.id").rlike("^tt[0-9]+$"), F.col("i.id")).alias("imdb_id")).where("imdb_id is not null"),
            "anilist": lambda: names("i.title.romaji", "i.title.english").select("key", "title", F.col("i.seasonYear").alias("year"), F.col("i.id").alias("anilist_id"), F.col("i.idMal").alias("mal_id")),
            "jikan": lambda: names("i.title", "i.title_english").select("key", "title", F.col("i.year").alias("year"), F.col("i.mal_id").alias("mal_id")),
            "kitsu": lambda: one.select("key", F.col("i.attributes.canonicalTitle").alias("title"), _year(F.col("i.attributes.startDate")).alias("year"), F.col("i.id").try_cast("bigint").alias("kitsu_id")),
            "tvmaze": lambda: one.select("key", F.col("i.show.name").alias("title"), _year(F.col("i.show.premiered")).alias("year"), F.col("i.show.externals.imdb").alias("imdb_id")),
        }[provider]()
    have = set(found.columns)
    kinds = {f: "string" if f == "imdb_id" else "int" for f in ID_FIELDS}
    return found.select("key", F.lit(provider).alias("provider"), "title", "year", *((F.col(f) if f in have else F.lit(None)).try_cast(kinds[f]).alias(f) for f in ID_FIELDS))


def candidates_of(answers: Callable[[str], DataFrame]) -> DataFrame:
    """(key, provider, title, year, identifiers): the candidates of stored answers; ``answers`` gives a provider's rows (key, payload), so each is a scan of its own that leaves out the others' folders."""
    found = None
    for provider in PROVIDERS:
        more = parse_payload(answers(provider).select("key", "payload"), provider)
        found = more if found is None else found.unionByName(more)
    return found


def _named(queue: DataFrame) -> DataFrame:
    """A queue's rows with n (its names, the more telling one first), p (that one parsed) and cache_key; equal names are parsed once."""
    picked = settled(queue.withColumn("n", pick_name(F.col("title"), F.col("title_alt"))))
    parsed = picked.select(F.col("n.main").alias("_main")).distinct().withColumn("p", parse_release(F.col("_main")))
    named = picked.join(parsed, F.col("n.main").eqNullSafe(F.col("_main"))).drop("_main")
    return named.withColumn("cache_key", cache_key(F.col("p.title"), F.col("p.year"), F.col("type")))


def _asked(named: DataFrame, items: Column, stage: int, variant: bool, light: bool = False) -> DataFrame:
    """(id, type, stage, nth, query, year, lax, variant, light): searches of a round, from structs (text, lax) in order."""
    return named.select("id", "type", F.lit(stage).alias("stage"), F.col("p.year").alias("year"), F.posexplode(items).alias("nth", "v")).select("id", "type", "stage", "nth", F.col("v.text").alias("query"), "year", F.col("v.lax").alias("lax"), F.lit(variant).alias("variant"), F.lit(light).alias("light")).where(norm(F.col("query")) != "")


def _questions(named: DataFrame) -> DataFrame:
    """The first round: each row's name, parsed from the more telling of both."""
    return _asked(named, F.array(F.struct(F.col("p.title").alias("text"), F.lit(False).alias("lax"))), 0, False)


def _later_questions(named: DataFrame, aggressive: bool, variant_weight: float) -> DataFrame:
    """The other rounds: the name's variants, then the other name, then the aggressive variants.

    A variant's confidence is at most ``variant_weight``; where that can't be accepted, they aren't asked."""
    plain, lax = variant_weight >= ACCEPT, variant_weight >= ACCEPT_LAX
    tried = F.filter(variants(F.col("p.title")), lambda x: F.when(x["lax"], lax).otherwise(plain))
    first = _asked(named, tried, 1, True).where("nth > 0 or lax") if plain else _asked(named.limit(0), tried, 1, True)
    if not aggressive:
        return first
    other = F.array(F.struct(F.col("n.other").alias("text"), F.lit(False).alias("lax")))
    found = first.unionByName(_asked(named.where("n.other is not null and n.other <> p.title"), other, 2, False))
    if lax:
        found = found.unionByName(_asked(named, F.transform(aggressive_variants(F.col("p.title")), lambda x: F.struct(x.alias("text"), F.lit(True).alias("lax"))), 3, True, True))
    return found


def _offers(candidates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(provider, t, c_year, title, identifiers) of the candidates, the first of those of one normalized name t, provider and year; and (x, kinds) of the names, with a bit for each provider."""
    first = candidates.groupBy("provider", norm(F.col("title")).alias("t"), F.col("year").alias("c_year")).agg(F.min(F.struct("title", *ID_FIELDS)).alias("o"))
    offered = settled(first.where(F.col("provider").isin(*PROVIDERS) & (F.col("t") != "")).select("provider", "t", "c_year", "o.*"))
    bits = sum((F.when(F.col("provider") == p, 1 << k).otherwise(0) for k, p in enumerate(PROVIDERS)), F.lit(0))
    return offered, settled(offered.groupBy(F.col("t").alias("x")).agg(F.bit_or(bits).alias("kinds")))


def _search(asked: DataFrame, offers: tuple[DataFrame, DataFrame], variant_weight: float) -> DataFrame:
    """(id, at, provider, confidence, identifiers): each search's best candidate of each provider that is asked for the row's type, if accepted.

    Different searches are answered once, however many rows ask them, and the best answer is kept by partial aggregation, so a name that
    many rows or candidates have gathers in no task."""
    order = F.create_map(*(F.lit(x) for p in enumerate(PROVIDERS) for x in reversed(p)))
    kind = F.coalesce(F.when(F.lower("type").isin("movie", "series", "anime"), F.lower("type")), F.lit(""))
    # without a year, and with 0, nothing is added or taken off
    asked = asked.select("*", norm(F.col("query")).alias("q"), kind.alias("kind"), F.coalesce("year", F.lit(0)).alias("y"))
    key = ["q", "y", "kind", "lax", "variant", "light"]
    offered, names = offers
    may = F.create_map(*(x for p, kinds in PROVIDERS.items() for x in (F.lit(p), F.array(*(F.lit(k or "") for k in kinds)))))
    # with a year, a better name may lose by its year and a worse one gain; digits beyond the fourth are rounded away
    dated = F.max(F.col("y") != 0)
    wanted = lambda provider: F.array_contains(may[provider], F.col("kind")) & (~F.col("light") | provider.isin(*LIGHT))
    bits = sum((F.when(wanted(F.lit(p)), 1 << k).otherwise(0) for k, p in enumerate(PROVIDERS)), F.lit(0))
    searches = asked.groupBy(F.col("q").alias("x")).agg(F.bit_or(bits).alias("kinds"), F.when(dated, ACCEPT - SAME_YEAR - 0.001).otherwise(ACCEPT - 0.001).alias("least"), F.when(dated, SAME_YEAR - OTHER_YEAR + 0.0003).otherwise(0.0003).alias("slack"))
    searches = settled(searches.where("kinds <> 0").join(names.select("x", F.col("kinds").alias("known")), "x", "left").select("x", "kinds", F.coalesce("known", F.lit(0)).alias("known"), "least", "slack"))
    near = best_names(searches, names).select(F.col("search").alias("q"), F.col("name").alias("t"), "alike")
    met = asked.select(*key).distinct().join(near, "q").join(offered, "t")
    met = met.where(wanted(F.col("provider")))
    sure = F.round(confidence(F.col("alike"), F.col("y"), F.col("c_year"), F.lit(False)) * F.when(F.col("variant"), variant_weight).otherwise(1.0), 4)
    fit = met.withColumn("confidence", sure).where(accepted(F.col("confidence"), F.col("lax")))
    best = fit.groupBy(*key, "provider").agg(F.min(F.struct((-F.col("confidence")).alias("c"), "title", *ID_FIELDS)).alias("b"))
    told = asked.select("id", "stage", "nth", *key).join(best, key)
    return told.select("id", F.struct("stage", "nth", order[F.col("provider")].alias("of")).alias("at"), "provider", (-F.col("b.c")).alias("confidence"), *(f"b.{f}" for f in ID_FIELDS))


def _merge(finds: DataFrame) -> DataFrame:
    """(id, identifiers, sources, confidence) of finds, folded in their order: an identifier stays with its first finder, and a find without a new one adds nothing."""
    kinds = {f: "string" if f == "imdb_id" else "int" for f in ID_FIELDS}
    start = F.struct(*(F.lit(None).cast(kinds[f]).alias(f) for f in ID_FIELDS), F.array().cast("array<string>").alias("sources"), F.lit(1.0).alias("confidence"))

    def add(acc: Column, x: Column) -> Column:
        new = F.lit(False)
        for f in ID_FIELDS:
            new = new | (acc[f].isNull() & x[f].isNotNull())
        known = F.array_contains(acc["sources"], x["provider"])
        return F.struct(
            *(F.coalesce(acc[f], x[f]).alias(f) for f in ID_FIELDS),
            F.when(new & ~known, F.array_append(acc["sources"], x["provider"])).otherwise(acc["sources"]).alias("sources"),
            F.when(new, F.least(acc["confidence"], x["confidence"])).otherwise(acc["confidence"]).alias("confidence"),
        )

    # a find for each search and provider: a few dozen a row
    rows = finds.select("id", F.struct("at", "provider", F.col("confidence").cast("double").alias("confidence"), *(F.col(f).cast(kinds[f]).alias(f) for f in ID_FIELDS)).alias("x"))
    return rows.groupBy("id").agg(F.aggregate(F.array_sort(F.collect_list("x")), start, add).alias("m")).select("id", "m.*").where(F.size("sources") > 0)


def resolve(queue: DataFrame, candidates: DataFrame, *, fill_all: bool = True, aggressive: bool = True, variant_weight: float = VARIANT_WEIGHT, known: DataFrame | None = None) -> DataFrame:
    """(id, cache_key, identifiers, source, confidence, outcome) of each row of a queue.

    candidates: (provider, title, year, identifiers).  Rounds: the name; for rows that are not complete then, its variants and, if ``aggressive``, the other name,
    further variants.  At last identifiers that such a row still lacks come from the works of those that it has: ``known``, from :func:`identity.closure`, by default over the
    candidates' own identifiers (a tmdb one only if ``aggressive``, noted as found by exact pair); works with a conflict give nothing.  A search meets every candidate that is
    alike enough; of each provider asked the one with the best confidence counts, if accepted, and what was found first stays.
    source: providers that added an identifier, in the order of finding; confidence: their least.  outcome: "resolved" with all that the type should have, else "partial", else "no match"."""
    # what a row gets depends on its names and type alone
    asks = settled(queue.select("title", "title_alt", "type").distinct().withColumn("id", F.monotonically_increasing_id()))
    told = _resolve(settled(_named(asks)), candidates, fill_all, aggressive, variant_weight, known)
    told = told.join(asks.select("id", *(F.col(c).alias(f"_{c}") for c in ("title", "title_alt", "type"))), "id").drop("id")
    same = F.col("title").eqNullSafe(F.col("_title")) & F.col("title_alt").eqNullSafe(F.col("_title_alt")) & F.col("type").eqNullSafe(F.col("_type"))
    return queue.select("id", "title", "title_alt", "type").join(told, same).select("id", "cache_key", *ID_FIELDS, "source", "confidence", "outcome")


def _resolve(named: DataFrame, candidates: DataFrame, fill_all: bool, aggressive: bool, variant_weight: float, known: DataFrame | None) -> DataFrame:
    candidates = settled(candidates)
    known = identity.closure(identity.edges_of(candidates)) if known is None else known
    offers = _offers(candidates)
    # rows of one name and type are told as one until they differ by their other names
    first = named.groupBy(F.col("n.main").alias("_main"), F.col("type").alias("_type")).agg(F.min("id").alias("first"))
    named = settled(named.join(first, F.col("n.main").eqNullSafe(F.col("_main")) & F.col("type").eqNullSafe(F.col("_type"))).select("id", "type", "n", "p", "cache_key", "first"))
    firsts = named.where("id = first")
    early = settled(_search(_questions(firsts), offers, variant_weight))
    done = settled(_merge(early).join(firsts.select("id", "type"), "id").where(complete(F.col("type"), fill_all)).select("id"))
    open_ = named.join(done.withColumnRenamed("id", "first"), "first", "left_anti")
    found = early.join(done, "id", "left_semi").unionByName(early.withColumnRenamed("id", "first").join(open_.select("id", "first"), "first").drop("first"))
    merged = _merge(found.unionByName(_search(_later_questions(open_, aggressive, variant_weight), offers, variant_weight)))
    told = named.join(done.select(F.col("id").alias("first"), F.lit(True).alias("done")), "first", "left").select("id", F.when(F.col("done"), F.col("first")).otherwise(F.col("id")).alias("as"))
    rows = firsts.join(done, "id", "left_semi").select("id", "type", "cache_key").unionByName(open_.select("id", "type", "cache_key"))
    before = F.struct(*ID_FIELDS, complete(F.col("type"), fill_all).alias("done"))
    every = identity.fill(rows.join(merged, "id", "left").withColumn("before", before), known)
    # what a complete row lacks stays open; so does a tmdb identifier where no further search is wanted
    kept = {f: F.when(F.col("before.done"), F.col(f"before.{f}")).otherwise(F.col(f)) for f in ID_FIELDS}
    met = F.lit(aggressive) & F.col("before.tmdb_id").isNull() & F.col("tmdb_id").isNotNull() & ~F.col("before.done")
    if not aggressive:
        kept["tmdb_id"] = F.col("before.tmdb_id")
    # all read the row as it was before
    every = every.withColumns(kept | {"sources": F.when(met, F.array_append("sources", F.lit(BRIDGE))).otherwise(F.col("sources")), "confidence": F.when(met, F.least("confidence", F.lit(BRIDGE_CONFIDENCE))).otherwise(F.col("confidence"))})
    outcome = F.when(any_id() & complete(F.col("type"), fill_all), "resolved").when(any_id(), "partial").otherwise("no match")
    every = every.select(F.col("id").alias("as"), "cache_key", *ID_FIELDS, F.coalesce(F.array_join("sources", "+"), F.lit("none")).alias("source"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"), outcome.alias("outcome"))
    return told.join(every, "as").drop("as")


def parse_mappings(rows: DataFrame, column: str = "payload") -> DataFrame:
    """(key, site, external_id) of mapping answers given as rows (key, payload)."""
    kind = "struct<data:array<struct<attributes:struct<externalSite:string,externalId:string>>>>"
    return rows.select("key", F.explode(F.from_json(column, kind)["data"]).alias("d")).select("key", F.col("d.attributes.externalSite").alias("site"), F.col("d.attributes.externalId").alias("external_id"))


def cache_keys(named: DataFrame) -> DataFrame:
    """(id, nth, cache_key): the keys of a row's parsed name, whole name and other name, without repeats."""
    key = lambda c: cache_key(F.col(c), F.col("p.year"), F.col("type"))
    keys = F.array_distinct(F.array_compact(F.array(*(F.when(norm(F.col(c)) != "", key(c)) for c in ("p.title", "n.main", "n.other")))))
    return named.select("id", F.posexplode(keys).alias("nth", "cache_key"))


def resolve_with_cache(queue: DataFrame, cache: DataFrame, candidates: DataFrame, as_of: Column, *, fill_all: bool = True, aggressive: bool = True, known: DataFrame | None = None) -> DataFrame:
    """:func:`resolve`, but remembered answers come first: hits under any of a row's keys are merged in the keys' order; a row that they make
    complete, or that has no hit and whose first key is a miss that is still fresh, is not searched."""
    named = settled(_named(queue))
    entries = cache.select("cache_key", "found", F.coalesce("updated_at", "created_at").alias("noted_at"), F.col("source").alias("c_source"), F.col("confidence").alias("c_confidence"), *(F.col(f).alias(f"c_{f}") for f in ID_FIELDS))
    looked = cache_keys(named).join(entries, "cache_key")
    hits = looked.where("found").select("id", F.struct(F.col("nth").alias("stage"), F.lit(0).alias("nth"), F.lit(0).alias("of")).alias("at"), F.coalesce("c_source", F.lit("cache")).alias("provider"), F.coalesce("c_confidence", F.lit(0.5)).alias("confidence"), *(F.col(f"c_{f}").alias(f) for f in ID_FIELDS))
    held = settled(named.select("id", "type", "cache_key").join(_merge(hits), "id"))
    missed = looked.where((F.col("nth") == 0) & ~F.col("found") & miss_is_fresh(F.col("noted_at"), as_of)).select("id").join(held.select("id"), "id", "left_anti")
    outcome = F.when(any_id() & complete(F.col("type"), fill_all), "resolved").when(any_id(), "partial").otherwise("no match")
    told = lambda df: df.select("id", "cache_key", *ID_FIELDS, "source", "confidence", outcome.alias("outcome"))
    full = held.where(complete(F.col("type"), fill_all)).withColumn("source", F.array_join("sources", "+"))
    none = named.select("id", "type", "cache_key").join(missed, "id", "left_semi").select("*", *(F.lit(None).cast("string" if f == "imdb_id" else "int").alias(f) for f in ID_FIELDS), F.lit("none").alias("source"), F.lit(0.0).alias("confidence"))
    searched = _resolve(named.join(full.select("id").unionByName(missed), "id", "left_anti"), candidates, fill_all, aggressive, VARIANT_WEIGHT, known)
    partly = held.select("id", "type", "sources", F.col("confidence").alias("h_confidence"), *(F.col(f).alias(f"h_{f}") for f in ID_FIELDS))
    both = searched.drop("outcome").join(partly, "id", "left")
    more = F.filter(F.split("source", r"\+"), lambda x: (x != "none") & ~F.array_contains(F.coalesce("sources", F.array().cast("array<string>")), x))
    joined = F.concat(F.coalesce("sources", F.array().cast("array<string>")), more)
    filled = both.withColumns({f: F.coalesce(f"h_{f}", f) for f in ID_FIELDS} | {"source": F.when(F.size(joined) > 0, F.array_join(joined, "+")).otherwise("none"), "confidence": F.when(F.col("source") == "none", F.coalesce("h_confidence", F.lit(0.0))).otherwise(F.least("confidence", F.coalesce("h_confidence", "confidence")))})
    types = named.select("id", "type")
    return told(full).unionByName(told(none)).unionByName(told(filled.drop("type").join(types, "id")))
