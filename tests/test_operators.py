import pytest
from pyspark.sql import functions as F

from reelsift.operators import apply, audit, policy, purge, queue, rank, renumber, resolve, stats
from reelsift.plans import stages
from reelsift.plans.budget import Budget, of_setting
from reelsift.plans.report import Report
from reelsift.plans.settings import Settings, load
from reelsift.schema import TITLE_CACHE, ensure_columns
from reelsift.sources.snapshot import Snapshots
from tests.test_functions import releases


def AS_OF():
    """The fixed clock, made when it is used: columns need a session."""
    return F.lit("2024-06-01 00:00:00").cast("timestamp_ntz")


def ids_of(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_purge_protocol(spark):
    rows = releases(spark, *({"id": i, "title": "README" if i % 2 else "film"} for i in range(1, 8)), {"id": 9})
    done = purge.purge_junk(rows, limit=2)
    assert ids_of(done.victims) == [1, 3] and ids_of(done.survivors) == [2, 4, 5, 6, 7, 9]
    assert done.metrics.first().asDict() == {"stage": "junk", "matched": 4, "deleted": 2, "skipped": 2, "skipped_limit": 2}
    dry = purge.purge_junk(rows, dry_run=True)
    assert dry.survivors.count() == 8 and dry.metrics.first()["deleted"] == 0
    assert ids_of(purge.purge_junk(rows, purge_empty=True).survivors) == [2, 4, 6]
    assert [x["id"] for x in purge.sample(rows, purge.is_junk()).first()["sample"]] == [1, 3, 5, 7]
    assert purge.purge_junk(rows.limit(0)).metrics.first()["matched"] == 0


def test_absolute_only(spark):
    rows = releases(spark, {"id": 1, "type": "anime", "absolute_episode": 5}, {"id": 2, "type": "anime", "season": 1, "absolute_episode": 5}, {"id": 3, "type": "movie", "absolute_episode": 5})
    assert ids_of(purge.purge_absolute_only(rows, AS_OF()).survivors) == [2, 3]
    done = purge.purge_absolute_only(rows, AS_OF(), action="nullify", require_season_null=False)
    assert {r["id"]: r["absolute_episode"] for r in done.survivors.collect()} == {1: None, 2: None, 3: 5}
    assert done.metrics.first()["updated"] == 2 and done.metrics.first()["deleted"] == 0


def test_dead(spark):
    old, new = (spark.sql(f"select timestamp_ntz'{t}' as t").first()["t"] for t in ("2024-01-01", "2024-05-30"))
    rows = releases(spark, {"id": 1, "created_at": old}, {"id": 2, "created_at": new}, {"id": 3, "created_at": old, "seeders": 1}, {"id": 4})
    assert ids_of(purge.purge_dead(rows, AS_OF()).survivors) == [2, 3, 4]


def test_keep_best(spark):
    rows = releases(spark, *({"id": i, "title": "A", "type": "movie", "seeders": i, "quality": "720p"} for i in range(1, 6)), {"id": 9}, {"id": 10, "title": "B", "type": "series"})
    done = rank.keep_best(rows)
    assert ids_of(done.victims) == [1, 2] and ids_of(done.survivors) == [3, 4, 5, 9, 10]
    assert done.metrics.first().asDict() == {"groups": 1, "matched": 5, "deleted": 2, "kept": 3, "skipped": 2, "skipped_limit": 0}
    assert ids_of(rank.keep_best(rows, max_deletes=1).victims) == [2]
    assert ids_of(rank.keep_best(rows, limit=0).survivors) == [5, 9, 10]


def test_keep_best_nulls_form_one_group_and_typeless_rows_without_numbers_are_left(spark):
    rows = releases(spark, *({"id": i, "title": "A", "type": "series", "season": 1} for i in range(1, 6)), {"id": 7, "title": "A"})
    assert ids_of(rank.keep_best(rows).victims) == [1, 2]


def test_spanish_quota(spark):
    base = {"title": "A", "type": "movie"}
    rows = releases(spark, {"id": 1, **base, "audio": ["Latino"], "seeders": 1}, {"id": 2, **base, "subtitles": ["es"], "seeders": 2}, {"id": 3, **base, "seeders": 99}, {"id": 4, **base, "seeders": 50}, {"id": 5, **base, "seeders": 99, "codec": "x"}, {"id": 6, "title": "B", "type": "movie"})
    done = rank.keep_best_spanish(rows, dedupe=False)
    assert [r["id"] for r in done.ranked.where("work = 't:a'").orderBy("rn").collect()] == [1, 2, 5, 3, 4]
    assert ids_of(done.survivors) == [1, 2, 5, 6]
    m = done.metrics.first()
    assert (m["groups"], m["groups_ok_spanish"], m["groups_low_spanish"], m["kept_with_subs"]) == (2, 1, 1, 1)
    assert ids_of(rank.keep_best_spanish(rows, dedupe=False, strict=True).survivors) == [1, 2, 5]
    capped = rank.keep_best_spanish(rows, max_deletes=2)
    assert ids_of(capped.duplicates) == [2, 3, 4] and ids_of(capped.survivors) == [1, 4, 5, 6]


def test_gaps(spark):
    rows = releases(spark, {"id": 1, "title": "A", "type": "movie"}, {"id": 2, "title": "B", "type": "movie", "audio": ["es"]}, {"id": 3, "title": "B", "type": "movie", "subtitles": ["es"]})
    assert [tuple(r) for r in rank.spanish_gaps(rows).collect()] == [("A", None, None, 1, 0, 0)]


def test_queues(spark):
    rows = releases(spark, {"id": 1, "title": "a"}, {"id": 2, "title": "b", "tmdb_id": 1, "imdb_id": "tt1", "anilist_id": 1, "kitsu_id": 1, "mal_id": 1}, {"id": 3, "title": " ", "title_text": "x", "tmdb_id": 1}, {"id": 4, "ids_attempts": 4})
    assert ids_of(queue.enrich_queue(rows, AS_OF())) == [1, 3, 4]
    assert queue.enrich_queue(rows, AS_OF(), column="auto").where("id = 3").first()["title"] == "x"
    assert queue.enrich_queue(rows, AS_OF(), batch=1).count() == 1
    assert ids_of(queue.missing_ids_queue(rows, AS_OF())) == [1]
    changed, counts = queue.reset_for_retry(rows, AS_OF())
    assert counts.first().asDict() == {"matched": 2, "queued": 1, "exhausted": 1} and changed.columns == rows.columns


def batch_of(spark, *rows):
    names = ("id", "tmdb_id", "imdb_id", "anilist_id", "kitsu_id", "mal_id", "source", "confidence", "cache_key")
    return spark.createDataFrame([(n, *(r.get(x) for x in names)) for n, r in enumerate(rows)], "pos long, " + ", ".join(f"{x} string" for x in names))


def test_apply_ids(spark):
    rows = releases(spark, {"id": 1, "tmdb_id": 5}, {"id": 2, "ids_attempts": 1})
    cache = ensure_columns(spark.createDataFrame([("k2", False, "none", 0.0)], "cache_key string, found boolean, source string, confidence double"), TITLE_CACHE)
    batch = batch_of(
        spark, {"id": "1", "tmdb_id": "9", "imdb_id": "TT7", "source": "tmdb", "confidence": "2", "cache_key": "k1"}, {"id": "1", "imdb_id": "tt8", "mal_id": "mal!", "source": "other", "cache_key": "k1"},
        {"id": "2", "cache_key": "k3"}, {"id": "2", "anilist_id": " 42 ", "confidence": "x", "cache_key": "k2"}, {"id": "77"}, {"id": "x"},
    )
    done = apply.apply_ids(rows, cache, batch, AS_OF())
    got = {r["id"]: r.asDict() for r in done.rows.collect()}
    assert (got[1]["tmdb_id"], got[1]["imdb_id"], got[1]["ids_source"], got[1]["ids_confidence"], got[1]["ids_attempts"]) == (5, "tt7", "tmdb", 1.0, 0)
    assert (got[2]["anilist_id"], got[2]["ids_source"], got[2]["ids_confidence"], got[2]["ids_attempts"]) == (42, apply.NO_SOURCE, 0.5, 0)
    known = {r["cache_key"]: r.asDict() for r in done.cache.collect()}
    assert known["k1"]["tmdb_id"] == 9 and known["k1"]["imdb_id"] == "tt7" and known["k1"]["found"]
    assert (known["k2"]["found"], known["k2"]["source"], known["k2"]["anilist_id"]) == (True, apply.NO_SOURCE, 42)
    assert (known["k3"]["found"], known["k3"]["source"]) == (False, "none")
    assert done.metrics.first().asDict() == {"updated": 4, "cached": 4, "invalid": 3}


def test_read_batch(spark):
    rows = apply.read_batch(spark.createDataFrame([('[{"id": 5, "tmdb_id": "7"}, {"id": "6"}]',)], "payload string"))
    assert [(r["pos"], r["id"], r["tmdb_id"]) for r in rows.orderBy("pos").collect()] == [(0, "5", "7"), (1, "6", None)]


def test_renumber(spark):
    rows = releases(spark, *({"id": i} for i in (2, 3, 7, 100)))
    done = renumber.renumber(rows)
    assert done.status == "done" and done.note == "2..100 -> 1..4" and ids_of(done.rows) == [1, 2, 3, 4] and done.next_id == 5
    assert renumber.renumber(done.rows).note == "already dense"
    assert renumber.renumber(rows, max_rows=2).status == "skipped" and renumber.renumber(rows, foreign_keys=1).status == "skipped"
    assert renumber.renumber(rows, dry_run=True).status == "preview" and renumber.renumber(rows.limit(0)).note == "empty"


def test_stats(spark):
    rows = releases(spark, {"id": 1, "type": "movie", "imdb_id": " "}, {"id": 3, "audio": ["lat"], "tmdb_id": 1})
    assert stats.ids_stats(rows).first()["without_ids"] == 1
    assert stats.quality_stats(rows).first()["by_type"] == {"movie": 1, "?": 1}
    assert stats.spanish_stats(rows).first()["none"] == 1
    assert stats.id_report(rows).first()["gaps"] == 1 and stats.id_report(rows.limit(0)).first()["ready"]


def test_audit(spark):
    policy = spark.createDataFrame([("function", "f", "anon", "execute", None), ("table", "t", "service", "insert", True)], "kind string, object string, role string, privilege string, row_security boolean")
    assert [r["level"] for r in audit.security_audit(policy).collect()] == ["CRITICAL"]
    assert [r["level"] for r in audit.security_audit(policy.where("object = 't'")).collect()] == ["OK"]


def test_audit_of_rules_and_missing_tables(spark):
    access = spark.createDataFrame([("table", "t", "service_role", "insert", True)], "kind string, object string, role string, privilege string, row_security boolean")
    rules = spark.createDataFrame([("p1", "t", "anon", "update", None, None, None), ("p2", "t", "anon", "select", None, None, None), ("p3", "t", "service_role", "all", None, None, None), ("p4", "t", "public", "all", None, None, None)], policy.RULES)
    got = {tuple(r) for r in audit.security_audit(access, rules, ("t", "gone")).collect()}
    assert got == {("CRITICAL", "policy p1 lets anon update t"), ("CRITICAL", "policy p4 lets public all t"), ("WARNING", "there is no table gone")}
    assert audit.security_audit(access, rules.where("policy = 'p2'"), ("t",)).first()["level"] == "OK"


def test_snapshots_by_role(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path / "s"))
    store.publish(releases(spark, {"id": 1, "title": "a", "seeders": 5}, {"id": 2, "title": "b", "seeders": None}, {"id": 3, "title": "c", "seeders": 1}))
    rules = spark.createDataFrame([
        ("p", "releases", "guest", "select", "seeders > 2", None, None), ("q", "releases", "guest", "select", None, "Title", "upper(title)"), ("q", "releases", "public", "select", None, "seeders", None),
        ("r", "releases", "editor", "all", None, None, None), ("s", "releases", "reader", "delete", None, None, None),
    ], policy.RULES)
    seen = lambda role: [(r["id"], r["title"], r["seeders"]) for r in store.read_as(role, rules).orderBy("id").collect()]
    assert seen("guest") == [(1, "A", None)] and seen("nobody") == [] and seen("editor") == [(1, "a", None), (2, "b", None), (3, "c", None)]
    assert seen("service_role") == [(1, "a", 5), (2, "b", None), (3, "c", 1)]
    fewer = store.read().where("id < 3")
    with pytest.raises(PermissionError, match="guest may not delete"):
        store.publish_as("guest", fewer, rules)
    with pytest.raises(PermissionError, match="insert, update"):
        store.publish_as("reader", fewer.withColumn("title", F.lit("z")).unionByName(fewer.where("id = 1").withColumn("id", F.lit(9).cast("long"))), rules)
    assert store.publish_as("reader", fewer, rules) == 2 and store.publish_as("editor", fewer.where("id = 1"), rules) == 3


PAYLOADS = {
    "tmdb": ('{"results":[{"id":7103,"title":"Pale Orchard","release_date":"1987-05-06"}]}', ("Pale Orchard", 1987, "tmdb_id", 7103)),
    "omdb": ('{"Title":"Pale Orchard","Year":"1987","imdbID":"tt7103310","Response":"True"}', ("Pale Orchard", 1987, "imdb_id", "tt7103310")),
    "imdb": ('{"d":[{"id":"tt7103310","l":"Pale Orchard","y":1987}]}', ("Pale Orchard", 1987, "imdb_id", "tt7103310")),
    "anilist": ('{"data":{"Page":{"media":[{"id":1,"idMal":2,"seasonYear":1991,"title":{"romaji":"Varn Odori"}}]}}}', ("Varn Odori", 1991, "mal_id", 2)),
    "jikan": ('{"data":[{"mal_id":2,"title":"Varn Odori","year":1991}]}', ("Varn Odori", 1991, "mal_id", 2)),
    "kitsu": ('{"data":[{"id":"9","attributes":{"canonicalTitle":"Varn Odori","startDate":"1991-04-03"}}]}', ("Varn Odori", 1991, "kitsu_id", 9)),
    "tvmaze": ('[{"show":{"name":"Nettle Row","premiered":"2009-09-22","externals":{"imdb":"tt7103311"}}}]', ("Nettle Row", 2009, "imdb_id", "tt7103311")),
}


@pytest.mark.parametrize("provider", PAYLOADS)
def test_payloads(spark, provider):
    text, (title, year, field, value) = PAYLOADS[provider]
    row = resolve.parse_payload(spark.createDataFrame([("k", text), ("j", "{}" if provider != "tvmaze" else "[]")], "key string, payload string"), provider).where("key = 'k'").first()
    assert (row["title"], row["year"], row[field]) == (title, year, value)


def test_resolve(spark):
    queue_rows = spark.createDataFrame([(1, "The.Matrix.1999.1080p.x264-GRP", None, None, "movie"), (2, "Nothing like it", None, None, "movie")], "id long, title string, title_text string, title_alt string, type string")
    offered = spark.createDataFrame([("tmdb", "The Matrix", 1999, 603, None, None, None, None), ("imdb", "The Matrix", 1999, None, "tt0133093", None, None, None), ("tmdb", "The Other", 1999, 1, None, None, None, None)], "provider string, title string, year int, tmdb_id int, imdb_id string, anilist_id int, kitsu_id int, mal_id int")
    got = {r["id"]: r.asDict() for r in resolve.resolve(queue_rows, offered).collect()}
    assert (got[1]["tmdb_id"], got[1]["imdb_id"], got[1]["source"], got[1]["outcome"]) == (603, "tt0133093", "imdb+tmdb", "resolved")
    assert got[2]["outcome"] == "no match"


CANDIDATE = "provider string, title string, year int, tmdb_id int, imdb_id string, anilist_id int, kitsu_id int, mal_id int"
QUEUED = "id long, title string, title_text string, title_alt string, type string"


def test_resolver_rounds(spark):
    queue_rows = spark.createDataFrame([
        (1, "Matrix", None, None, "movie"),  # a candidate with another first word
        (2, "Zzz qqq", None, "Right name", "movie"),  # the other name, then the exact pair
        (3, "Bebop", None, None, "movie"),  # a provider that isn't asked for the type
        (4, "Bebop", None, None, None),  # a type that isn't known: all are asked, the first find stays
        (5, "", None, None, "movie"), (6, None, None, None, "anime"),
    ], QUEUED)
    offered = spark.createDataFrame([
        ("tmdb", "The Matrix", None, 603, None, None, None, None), ("imdb", "Right name", None, None, "tt1", None, None, None), ("tmdb", "Yet another film", None, 77, "tt1", None, None, None),
        ("anilist", "Bebop", None, None, None, 5, None, 6), ("kitsu", "Bebop", None, None, None, None, 9, 8), ("nobody", "Bebop", None, 4, None, None, None, None),
    ], CANDIDATE)
    got = {r["id"]: r.asDict() for r in resolve.resolve(queue_rows, offered).collect()}
    assert len(got) == 6 and got[1]["tmdb_id"] == 603
    assert (got[2]["imdb_id"], got[2]["tmdb_id"], got[2]["source"], got[2]["confidence"], got[2]["outcome"]) == ("tt1", 77, "imdb+tmdb:find", 0.95, "resolved")
    assert [got[i]["outcome"] for i in (3, 5, 6)] == ["no match"] * 3
    assert (got[4]["anilist_id"], got[4]["kitsu_id"], got[4]["mal_id"], got[4]["tmdb_id"], got[4]["source"]) == (5, 9, 6, None, "anilist+kitsu")
    mild = {r["id"]: r["outcome"] for r in resolve.resolve(queue_rows, offered, aggressive=False).collect()}
    assert mild[2] == "no match" and mild[1] == "partial"
    # variants count at most four fifths, below what is accepted, unless their weight says otherwise
    roman = spark.createDataFrame([(1, "Saw II", None, None, "movie")], QUEUED), spark.createDataFrame([("imdb", "Saw 2", None, None, "tt7", None, None, None)], CANDIDATE)
    assert resolve.resolve(*roman).first()["outcome"] == "no match" and resolve.resolve(*roman, variant_weight=1.0).first()["imdb_id"] == "tt7"


def test_names_of_a_payload(spark):
    two = spark.createDataFrame([("k", '{"data":{"Page":{"media":[{"id":71201,"idMal":71202,"seasonYear":1993,"title":{"romaji":"Kaze no Odori","english":"Odori of the Wind"}}]}}}')], "key string, payload string")
    assert sorted(r["title"] for r in resolve.parse_payload(two, "anilist").collect()) == ["Kaze no Odori", "Odori of the Wind"]
    person = spark.createDataFrame([("k", '{"d":[{"id":"tt7103310","l":"Pale Orchard","y":1987},{"id":"nm77","l":"Nope"}]}')], "key string, payload string")
    assert [r["imdb_id"] for r in resolve.parse_payload(person, "imdb").collect()] == ["tt7103310"]


def test_cache_keys_of_all_names(spark):
    rows = spark.createDataFrame([(1, "Film.A.1999.1080p.x264-GRP", None, "Other", "movie"), (2, "Quartz.1999.1080p.x264-GRP", None, None, "movie")], QUEUED)
    cache = spark.createDataFrame([("other|1999|movie", True, 77, None, "tmdb", 0.9), ("quartz|1999|movie", True, 8, None, "tmdb", 0.9)], "cache_key string, found boolean, tmdb_id int, imdb_id string, source string, confidence double")
    offered = spark.createDataFrame([("imdb", "Film A", 1999, None, "tt5", None, None, None)], CANDIDATE)
    got = {r["id"]: r.asDict() for r in resolve.resolve_with_cache(rows, ensure_columns(cache, TITLE_CACHE), offered, AS_OF()).collect()}
    assert (got[1]["tmdb_id"], got[1]["imdb_id"], got[1]["source"], got[1]["outcome"]) == (77, "tt5", "tmdb+imdb", "resolved")
    assert (got[2]["tmdb_id"], got[2]["outcome"]) == (8, "partial")


def test_mappings(spark):
    found = resolve.parse_mappings(spark.createDataFrame([("k", '{"data":[{"attributes":{"externalSite":"myanimelist/anime","externalId":"7"}}]}')], "key string, payload string"))
    assert tuple(found.first()) == ("k", "myanimelist/anime", "7")


def test_cache_answers_before_a_search(spark):
    queue_rows = spark.createDataFrame([(1, "Film A", None, None, "movie"), (2, "Film B", None, None, "movie"), (3, "Film C", None, None, "movie")], "id long, title string, title_text string, title_alt string, type string")
    offered = spark.createDataFrame([("tmdb", f"Film {x}", None, i, None, None, None, None) for i, x in enumerate("ABC", 1)], "provider string, title string, year int, tmdb_id int, imdb_id string, anilist_id int, kitsu_id int, mal_id int")
    cache = spark.createDataFrame([("film a||movie", True, 77, "2024-05-01 00:00:00"), ("film b||movie", False, None, "2024-05-25 00:00:00"), ("film c||movie", False, None, "2024-01-01 00:00:00")], "cache_key string, found boolean, tmdb_id int, t string").withColumn("updated_at", F.col("t").cast("timestamp_ntz"))
    got = {r["id"]: (r["tmdb_id"], r["outcome"]) for r in resolve.resolve_with_cache(queue_rows, ensure_columns(cache, TITLE_CACHE), offered, AS_OF()).collect()}
    assert got == {1: (77, "partial"), 2: (None, "no match"), 3: (3, "partial")}


def test_selftest_and_registry(spark):
    from reelsift.plans import catalog, selftest

    assert selftest.run(spark) == []
    with pytest.raises(ValueError):
        catalog.register_raw("norm_text", None)


def test_budget():
    b = Budget(3).spend(2)
    assert b.remaining == 1 and not b.exhausted and b.spend(5).exhausted and of_setting(0).remaining is None


def test_settings():
    s = load({"DRY_RUN": "true", "BATCH_SIZE": "x", "MAX_DELETES_PER_RUN": "7"})
    assert s.dry_run and s.batch_size == 400 and s.max_deletes_per_run == 7


def test_all_stages_share_one_budget(spark):
    rows = releases(spark, *({"id": i, "title": "README", "type": "movie"} for i in (1, 2)), {"id": 3, "title": "porn film", "type": "movie"}, *({"id": 10 + i, "title": "Good Film", "type": "movie", "seeders": i} for i in range(5)))
    cache = ensure_columns(spark.range(0).select(F.lit("").alias("cache_key")), TITLE_CACHE)
    offered = spark.createDataFrame([("tmdb", "Good Film", None, 11, None, None, None, None)], "provider string, title string, year int, tmdb_id int, imdb_id string, anilist_id int, kitsu_id int, mal_id int")
    s = Settings(max_deletes_per_run=3, renumber_ids=True, enrich_rounds=1, retry_missing=False)
    state, report = stages.run_all(rows, cache, offered, s, AS_OF())
    assert state.budget.used == 3 and ids_of(state.releases) == [1, 2, 3, 4, 5]
    assert report.data["purge junk"]["deleted"] == 2 and "partial" in report.data["enrich"] and "| metric | value |" in report.markdown()
    dry, _ = stages.run_all(rows, cache, offered, Settings(dry_run=True, retry_missing=False), AS_OF())
    assert dry.releases.count() == rows.count()


def test_snapshots_and_stream(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path / "s"))
    assert store.read().count() == 0
    rows = releases(spark, {"id": 1, "title": "a"}, {"id": 2, "title": "b"})
    assert store.publish(rows, next_id=3) == 1 and store.publish(rows.where("id = 1")) == 2
    assert ids_of(store.read()) == [1] and ids_of(store.read(1)) == [1, 2] and store.next_id() == 3

    from reelsift.streaming.queue import stream_queue

    seen = []
    stream_queue(spark, str(tmp_path / "s/v1"), str(tmp_path / "c"), lambda df, n: seen.extend(ids_of(df)), AS_OF()).awaitTermination()
    assert seen == [1, 2]


def test_command_line(spark, tmp_path, monkeypatch):
    from reelsift.plans import cli

    monkeypatch.chdir(tmp_path)
    assert cli.main(["doctor", "--snapshots", str(tmp_path / "s")]) == 1
    Snapshots(spark, str(tmp_path / "s")).publish(releases(spark, {"id": 1, "title": "README"}, {"id": 2, "title": "film"}))
    assert cli.main(["purge", "--snapshots", str(tmp_path / "s"), "--as-of", "2024-06-01 00:00:00"]) == 0
    assert ids_of(Snapshots(spark, str(tmp_path / "s")).read()) == [2] and (tmp_path / "summary.md").exists()


def test_command_line_exits_and_logs(spark, tmp_path, monkeypatch, caplog, capsys):
    from reelsift.plans import cli, stages

    monkeypatch.chdir(tmp_path)
    at = str(tmp_path / "s")
    Snapshots(spark, at).publish(releases(spark, {"id": 1, "title": "README"}, {"id": 2, "title": "film"}))
    run = lambda *more: cli.main([*more, "--snapshots", at, "--as-of", "2024-06-01 00:00:00"])
    assert run("stats", "-q") == 0 and not [r for r in caplog.records if r.name.startswith("reelsift")]
    assert run("stats", "-v") == 0 and any(r.levelname == "DEBUG" and "ids" in r.message for r in caplog.records)
    # candidates that aren't there, and others without a column
    assert run("doctor") == 0 and run("doctor", "--candidates", f"{at}/none") == 1 and run("enrich", "--candidates", f"{at}/none") == 2
    spark.range(1).write.parquet(f"{at}/odd")
    assert run("doctor", "--candidates", f"{at}/odd") == 1 and "no column provider" in capsys.readouterr().out

    def stop(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(stages, "run_purge", stop)
    assert run("purge") == 130 and Snapshots(spark, at).version() == 1


def test_report(tmp_path):
    r = Report("x")
    r.metrics("a", {"n": 1})
    r.write(str(tmp_path / "a.md"), str(tmp_path / "a.json"), str(tmp_path / "step.md"))
    assert (tmp_path / "step.md").read_text().startswith("# x")


def test_resolve_outcome_takes_the_whole_queue(spark):
    from reelsift.plans import catalog
    from reelsift.sources.releases import as_of, derived_releases

    folder = "/root/testdata/sf0.001"
    waiting = derived_releases(spark, folder).where(queue.wanted(as_of(), 45, None))
    got = catalog.queries()["resolve_outcome"](spark, folder).select("id")
    assert waiting.count() > queue.BATCH
    assert got.count() == got.distinct().count() == waiting.count() and got.join(waiting, "id", "left_anti").count() == 0
