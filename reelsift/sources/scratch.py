"""Scratch tables in the folder that the cluster shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Used only by sessions on one machine that name no folder, such as tests.
LOCAL_CHECKPOINTS = "/tmp/checkpoints"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session, or else the checkpoint folder that its context was given.  Without either, a session on one machine gets a local one, and a cluster an error."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir names no folder that the driver and the executors share")
        named = LOCAL_CHECKPOINTS
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
    return named


def settled(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder: computed once, it outlives lost executors, and what is built on it has a short plan."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
