"""The lookup queue over a growing folder of releases.  An addition: the batch queue is the operator itself."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.queue import enrich_queue
from ..schema import RELEASES


def stream_queue(spark: SparkSession, folder: str, checkpoint: str, sink: Callable[[DataFrame, int], None], as_of: Column, **how) -> StreamingQuery:
    """Feed each micro-batch's queue to ``sink``; ends when all files present have been read, and goes on from there when started again."""
    rows = spark.readStream.schema(RELEASES).parquet(folder)
    return rows.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(lambda df, n: sink(enrich_queue(df, as_of, **how), n)).start()
