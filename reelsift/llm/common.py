"""Shared helpers of the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import settled, shared_dir

checkpoint = settled


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back: lineage ends here."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of a few numbers (some 16 MB) that are broadcast at most; more are joined by shuffle.
MOST_BROADCAST = 1_000_000


def are_few(df: DataFrame) -> bool:
    """Whether rows of a few numbers in a checkpointed table may be broadcast."""
    return df.count() <= MOST_BROADCAST


def few(df: DataFrame) -> DataFrame:
    """``df``, rows of a few numbers in a checkpointed table, to be broadcast where they are counted to be few."""
    return F.broadcast(df) if are_few(df) else df


#: Rows of a few numbers that a task takes: fewer of them aren't dealt to as many tasks as large tables are.
TASK_ROWS = 1 << 16


def gathered(df: DataFrame, at_most: int | None = None) -> DataFrame:
    """``df``, a checkpointed table of small rows, in no more partitions than they need; ``at_most``: a bound on its rows, which are counted without one.

    What one task can hold is then joined and grouped without a shuffle, so steps that have little left to do leave hardly any shuffle files, checkpoint files and tasks."""
    n = df.count() if at_most is None else at_most
    return df.coalesce(max(1, -(-n // TASK_ROWS)))


#: Keys with more rows than the greater of this and a 100,000th of all rows are joined by broadcast: there are at most 100,000 of them.
HOT_ROWS = 1000


def joined_by(rows: DataFrame, told: DataFrame, key: str) -> DataFrame:
    """``rows`` joined with ``told``, which has a row for each of their keys and its count of rows, ``n_rows`` (dropped); no key's rows meet in one task but for a bounded number of them."""
    limit = max(HOT_ROWS, (told.agg(F.sum("n_rows")).first()[0] or 0) // 100_000)
    hot, others = told.where(F.col("n_rows") > limit).drop("n_rows"), told.where(F.col("n_rows") <= limit).drop("n_rows")
    cold = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return rows.join(F.broadcast(hot), key).unionByName(cold.join(others, key))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Vocabularies and models that a Python worker keeps: workers outlive stages, so what another operator left goes first.
_residents: dict = {}


def resident(key, build, group=None):
    """``build()``, kept in this Python process for the next call with ``key``; those of other groups (of other keys, without one) go."""
    group = key if group is None else group
    if key not in _residents:
        for k in [k for k, (g, _) in _residents.items() if g != group]:
            del _residents[k]
        _residents[key] = (group, build())
    return _residents[key][1]


def forget() -> None:
    """Frees what :func:`resident` keeps, and gives its memory back to the system; for stages that need memory and no model."""
    if _residents:
        _residents.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
            libc.malloc_trim(0)


#: Texts that are turned into Python's strings at a time.
TEXTS = 500


def texts_of(column: pa.Array) -> Iterator[str | None]:
    """The texts of a batch's column, few of them at a time as Python's strings."""
    for at in range(0, len(column), TEXTS):
        yield from column.slice(at, TEXTS).to_pylist()


def crc32_of(column) -> F.Column:
    """crc32 of a value's decimal text; a null counts as the empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary"))


def scan_bytes(df: DataFrame) -> int:
    """Estimated bytes of a relation, as the optimizer knows them from file sizes."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
