"""Dense ids in the old order, without sorting in one task."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MAX_ROWS = 200_000
#: Rows of a range of ids, and ranges at most.
RANGE_ROWS, MOST_RANGES = 100_000, 1000


def _with_range(ids: DataFrame, borders: list[float]) -> DataFrame:
    """``ids`` with r: the range between ascending borders that an id lies in, by binary search."""
    from pyspark.ml.feature import Bucketizer

    if not borders:
        return ids.withColumn("r", F.lit(0.0))
    edges = [float("-inf"), *borders, float("inf")]
    return Bucketizer(splits=edges, inputCol="_id", outputCol="r").transform(ids.withColumn("_id", F.col("id").cast("double"))).drop("_id")


@dataclass(frozen=True)
class Renumbered:
    rows: DataFrame
    status: str
    note: str
    next_id: int


def renumber_map(df: DataFrame, start: int = 1) -> DataFrame:
    """(id, new_id): ids from ``start`` up in the old order.

    Ids are dealt by ranges of about equal counts, whose borders are sampled quantiles; a row's number is its place in its range plus the rows of the
    ranges below, of which there are ``MOST_RANGES`` at most.  So one far id makes no range larger, and no task sorts the table."""
    ranges = max(1, min(MOST_RANGES, df.count() // RANGE_ROWS))
    # only which rows share a range depends on the sample
    borders = sorted({float(x) for x in df.approxQuantile("id", [k / ranges for k in range(1, ranges)], 1 / (4 * ranges))}) if ranges > 1 else []
    ids = _with_range(df.select("id"), borders)
    sizes = ids.groupBy("r").agg(F.count("*").alias("n"))
    below = sizes.withColumn("below", F.coalesce(F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inner = ids.withColumn("k", F.row_number().over(Window.partitionBy("r").orderBy("id")))
    return inner.join(F.broadcast(below.select("r", "below")), "r").select("id", (F.col("below") + F.col("k") + (start - 1)).cast("long").alias("new_id"))


def renumber(df: DataFrame, *, dry_run: bool = False, max_rows: int = MAX_ROWS, force: bool = False, start: int = 1, foreign_keys: int = 0) -> Renumbered:
    """Close the gaps of the id column; guards in this order: empty, too many rows, foreign keys, already dense, dry run."""
    total, low, high = df.agg(F.count("*"), F.min("id"), F.max("id")).first()
    if not total:
        return Renumbered(df, "ready", "empty", start)
    if total > max_rows and not force:
        return Renumbered(df, "skipped", f"{total} rows are over the guard of {max_rows}", high + 1)
    if foreign_keys and not force:
        return Renumbered(df, "skipped", f"{foreign_keys} foreign keys point here", high + 1)
    if low == start and high == start + total - 1:
        return Renumbered(df, "ready", "already dense", high + 1)
    note = f"{low}..{high} -> {start}..{start + total - 1}"
    if dry_run:
        return Renumbered(df, "preview", note, high + 1)
    rows = df.join(renumber_map(df, start), "id").withColumn("id", F.col("new_id")).select(*df.columns)
    return Renumbered(rows, "done", note, start + total)
