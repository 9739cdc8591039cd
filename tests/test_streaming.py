"""Streamed rounds and re-queueing: crashes, repeated batches, and the batch queues at several clocks."""

import pytest
from pyspark.sql import functions as F

from reelsift.operators import queue
from reelsift.schema import RELEASES, TITLE_CACHE, ensure_columns
from reelsift.sources.snapshot import Snapshots
from reelsift.streaming import requeue, rounds

CANDIDATE = "provider string, title string, year int, tmdb_id int, imdb_id string, anilist_id int, kitsu_id int, mal_id int"


def arriving(spark, folder, lots):
    """One file of releases for each lot of (id, title)."""
    for rows in lots:
        ensure_columns(spark.createDataFrame([(i, t, "movie") for i, t in rows], "id long, title string, type string")).coalesce(1).write.mode("append").parquet(folder)


def rounds_of(spark, tmp_path, offered, monkeypatch=None):
    store = Snapshots(spark, str(tmp_path / "store"))
    step = rounds.lookup_step(offered, F.lit("2024-06-01 00:00:00").cast("timestamp_ntz"))
    return store, lambda: rounds.run_rounds(spark, str(tmp_path / "in"), str(tmp_path / "check"), store, TITLE_CACHE, step).awaitTermination()


@pytest.fixture
def offered(spark):
    return spark.createDataFrame([("tmdb", f"Pale Orchard {x}", None, n, f"tt{n}", None, None, None) for n, x in enumerate("abcdef", 1)], CANDIDATE)


LOTS = [[(1, "Pale Orchard a"), (2, "Pale Orchard b")], [(2, "Pale Orchard f"), (3, "Pale Orchard c"), (3, "Pale Orchard c")]]
WANT = {1: ("tt1", 1, 0), 2: ("tt2", 2, 0), 3: ("tt3", 3, 0)}


def told(store):
    return {r["id"]: (r["imdb_id"], r["tmdb_id"], r["ids_attempts"]) for r in store.read().collect()}, store.read().count()


def test_rounds_publish_one_snapshot_a_batch(spark, tmp_path, offered):
    arriving(spark, str(tmp_path / "in"), LOTS)
    store, run = rounds_of(spark, tmp_path, offered)
    run()
    assert told(store) == (WANT, 3) and store.version() == 2 and store.batch_of("rounds") == 1 and store.batch_of("others") == -1
    assert store.read_beside("cache", TITLE_CACHE).where("found").count() == 3
    run()
    assert store.version() == 2
    arriving(spark, str(tmp_path / "in"), [[(9, "Quite another name")]])
    run()
    rows, n = told(store)
    assert n == 4 and rows[9] == (None, None, 1) and store.version() == 3
    # a later snapshot without a batch keeps what was noted
    store.publish(store.read().where("id <> 9"))
    assert store.batch_of("rounds") == 2 and store.read_beside("cache", TITLE_CACHE).count() >= 3


@pytest.mark.parametrize("when", ["before the pointer", "after the pointer"])
def test_a_killed_batch_is_neither_lost_nor_doubled(spark, tmp_path, offered, monkeypatch, when):
    arriving(spark, str(tmp_path / "in"), LOTS)
    store, run = rounds_of(spark, tmp_path, offered)
    point, calls = store._point, []

    def dying(state):
        calls.append(state["version"])
        if len(calls) != 2:
            return point(state)
        if when == "after the pointer":
            point(state)
        raise RuntimeError("killed")

    monkeypatch.setattr(store, "_point", dying)
    with pytest.raises(Exception, match="killed"):
        run()
    assert store.version() == (2 if when == "after the pointer" else 1)
    run()
    assert told(store) == (WANT, 3) and store.version() == 2 and store.batch_of("rounds") == 1
    assert calls == ([1, 2] if when == "after the pointer" else [1, 2, 2])


ROWS = [
    # id, imdb, tmdb, checked, attempts
    (1, None, None, None, 0), (2, None, None, "2024-01-01 00:00:00", 1), (3, None, None, "2024-01-01 00:00:00", 4), (4, "tt4", None, "2024-01-10 12:00:00", 0),
    (5, "tt5", 5, "2024-01-01 00:00:00", 0), (6, None, None, "2024-03-01 00:00:00", None), (7, " ", None, "2024-02-15 11:30:00", 2),
]


def test_timers_wake_what_the_batch_queues_find(spark, tmp_path):
    rows = ensure_columns(spark.createDataFrame(ROWS, "id long, imdb_id string, tmdb_id int, c string, ids_attempts int").withColumn("ids_checked_at", F.col("c").cast("timestamp_ntz")))
    full = rows.where("id = 5").select(*(F.lit(1).cast(f.dataType).alias(f.name) if f.name in ("anilist_id", "kitsu_id", "mal_id") else F.col(f.name) for f in RELEASES))
    rows = rows.where("id <> 5").unionByName(full)
    folder, out = str(tmp_path / "in"), []

    def feed(frame):
        frame.coalesce(1).write.mode("append").parquet(folder)
        stream = requeue.requeued(spark.readStream.schema("id long, at timestamp, checked long, attempts int, lacks boolean, none boolean, missed long").option("maxFilesPerTrigger", 1).parquet(folder))
        stream.writeStream.option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).outputMode("append").foreachBatch(lambda df, n: out.extend(df.collect()) and None).start().awaitTermination()

    clock = lambda t: requeue.events(rows.where("id = 5").withColumn("id", F.lit(-1).cast("long")), F.lit(t))
    missed = F.when(F.col("id") == 6, F.lit("2024-03-01 00:00:00").cast("timestamp_ntz"))
    feed(requeue.events(rows, F.lit("2024-01-01 00:00:00"), missed_at=missed))
    for t in ("2024-02-15 00:00:00", "2024-02-24 12:00:01", "2024-04-20 00:00:00"):
        feed(clock(t))
        now = F.lit(t).cast("timestamp_ntz")
        got = lambda q: {r["id"] for r in out if r["queue"] == q}
        assert got("enrich") == {r["id"] for r in queue.whole_enrich_queue(rows, now).collect()}, t
        assert got("retry") == {r["id"] for r in queue.missing_ids_queue(rows, now).collect()}, t
        assert got("miss") == ({6} if t >= "2024-03-21" else set())
    assert len(out) == len({(r["id"], r["queue"]) for r in out})
    # an event replaces what was waited for
    again = rows.where("id = 4").withColumn("ids_checked_at", F.lit("2024-04-20 00:00:00").cast("timestamp_ntz"))
    feed(requeue.events(again, F.lit("2024-04-20 00:00:01")))
    n = len(out)
    feed(clock("2024-06-04 00:00:00"))
    assert len(out) == n
    feed(clock("2024-06-04 00:00:01"))
    assert [(r["id"], r["queue"]) for r in out[n:]] == [(4, "enrich")]
