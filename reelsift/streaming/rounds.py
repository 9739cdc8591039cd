"""Pull rounds as a stream: each micro-batch of arriving releases is added, looked up and applied, and published as one snapshot.

A batch's releases and title cache become current together, by one pointer that also says which batch of which stream it holds.  A batch that is handed out again (its stream stopped
before noting it as done) is skipped if its snapshot is current or older, and else made anew from the same snapshot as before: what a killed attempt
has written lies in a folder that no pointer names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import apply, queue, resolve
from ..schema import RELEASES, ensure_columns
from ..sources.scratch import settled
from ..sources.snapshot import Snapshots

#: (releases, cache, batch) to (releases, cache).
Step = Callable[[DataFrame, DataFrame, DataFrame], tuple[DataFrame, DataFrame]]


def newcomers(releases: DataFrame, batch: DataFrame) -> DataFrame:
    """Rows of ``batch`` whose id isn't there yet; of several with one id the latest by updated_at, then created_at, title and seeders."""
    last = Window.partitionBy("id").orderBy(*(F.desc_nulls_last(c) for c in ("updated_at", "created_at", "title", "seeders")))
    one = ensure_columns(batch).where("id is not null").withColumn("_k", F.row_number().over(last)).where("_k = 1").drop("_k")
    return one.join(releases.select("id"), "id", "left_anti").select(*RELEASES.fieldNames())


def lookup_step(candidates: DataFrame, as_of: Column, *, recheck_days: int = 45, only_types: str | None = None, known: DataFrame | None = None) -> Step:
    """The step of a round: new releases are added, those of the batch that lack identifiers are resolved over ``candidates``, and what was found is applied."""

    def step(releases: DataFrame, cache: DataFrame, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
        every = settled(releases.unionByName(newcomers(releases, batch)))
        asked = every.join(batch.select("id").distinct(), "id", "left_semi")
        waiting = queue.whole_enrich_queue(asked, as_of, recheck_days=recheck_days, only_types=only_types, column="auto")
        found = settled(resolve.resolve_with_cache(waiting, cache, candidates, as_of, known=known))
        items = found.select(F.monotonically_increasing_id().alias("pos"), *(F.col(c).cast("string").alias(c) for c in ("id", "tmdb_id", "imdb_id", "anilist_id", "kitsu_id", "mal_id", "source", "confidence", "cache_key")))
        done = apply.apply_ids(every, cache, items, as_of)
        return done.rows, done.cache

    return step


def publish_batch(store: Snapshots, cache_schema, step: Step, batch: DataFrame, number: int, stream: str) -> int | None:
    """Apply ``step`` to the current snapshot and publish it as batch ``number`` of ``stream``; None where that is published already."""
    if store.batch_of(stream) >= number:
        return None
    releases, cache = step(store.read(), store.read_beside("cache", cache_schema), batch)
    return store.publish(releases, beside={"cache": ensure_columns(cache, cache_schema)}, batch=(stream, number))


def run_rounds(spark: SparkSession, folder: str, checkpoint: str, store: Snapshots, cache_schema, step: Step, *, stream: str = "rounds", files_per_round: int = 1) -> StreamingQuery:
    """Starts the rounds over the Parquet files of ``folder``; ends when all files present have been taken, and goes on from there when started again."""
    rows = spark.readStream.schema(RELEASES).option("maxFilesPerTrigger", files_per_round).parquet(folder)
    return rows.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(lambda df, n: publish_batch(store, cache_schema, step, df, n, stream) and None).start()
