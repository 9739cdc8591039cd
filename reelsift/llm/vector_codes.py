"""Vector code compression: a vector becomes one byte for each of its parts.

Blocks are columnar: a part's distances to all its entries accumulate dimension by dimension, in the narrowest integers that hold every
sum.  A round gathers int64 tensors of sums and counts, (parts, entries, width), with ``np.add.at``, and merges them through the
tree of ``treeAggregate``; the driver sees tensors of the codebooks' size alone.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import MOST_BROADCAST, joined_by, written
from .vectors import add_rows, column_rdd, columns_of, common_size, exact_kind, integer_blocks, kept_vectors, largest, longs, whole

#: Vectors whose distances to all entries are held at once.
ROWS = 512


def part_distances(columns: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of the nearest entry of each column (ties: the lower index).

    columns: (width, vectors), a part's components; entries: (number, width)."""
    kind = exact_kind(len(columns) * (largest(columns) + largest(entries)) ** 2, ((31, np.int32), (63, np.int64)))
    columns, entries = columns.astype(kind), entries.astype(kind)
    index, distance = [], []
    for at in range(0, columns.shape[1], ROWS):
        rows = columns[:, at : at + ROWS]
        total = np.zeros((rows.shape[1], len(entries)), dtype=kind)
        step = np.empty_like(total)
        for component, entry in zip(rows, entries.T, strict=True):
            np.subtract(component[:, None], entry[None, :], out=step)
            np.multiply(step, step, out=step)
            total += step
        best = total.argmin(1)
        index.append(best)
        distance.append(total[np.arange(len(best)), best])
    return np.concatenate(index), np.concatenate(distance) if kind is object else np.concatenate(distance).astype(np.int64)


def parts_of(columns: np.ndarray, parts: int) -> list[np.ndarray]:
    return np.split(columns, parts)


def improved(rdd, books: np.ndarray) -> np.ndarray:
    """The codebooks after a round: the floor of the mean of each used entry's parts.  books: (parts, entries, width)."""

    def gather(total, columns):
        sums, counts, bound = total or (np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64), 0)
        bound += largest(columns) * columns.shape[1]
        for p, part in enumerate(parts_of(columns, len(books))):
            index, _ = part_distances(part, books[p])
            places = np.full(len(index), p), index
            sums = add_rows(sums, places, part.T, bound)
            np.add.at(counts, places, 1)
        return sums, counts, bound

    def merge(a, b):
        if not a or not b:
            return a or b
        bound = a[2] + b[2]
        return (a[0].astype(object) if bound >= 2**63 else a[0]) + b[0], a[1] + b[1], bound

    total = rdd.treeAggregate(None, gather, merge)
    if not total:
        return books
    sums, counts, _ = total
    return np.where(counts[..., None] > 0, sums // np.maximum(counts, 1)[..., None], books)


def first_books(kept: DataFrame, parts: int, entries: int, *, scale: int, id_col: str, vector_col: str) -> np.ndarray:
    """Each part's entries: that part of the vectors with the smallest ids (nulls last), repeated ids by their vectors."""
    rows = kept.select(F.col(id_col).alias("i"), F.col(vector_col).cast("array<double>").alias("v")).orderBy(F.col("i").asc_nulls_last(), "v").limit(entries).collect()
    ints = whole(np.array([r["v"] for r in rows], dtype=np.float64), scale)
    return np.stack(np.split(ints, parts, axis=1)) if rows else np.zeros((parts, 0, 0), np.int64)


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(x)) for x in books.ravel()).encode()).hexdigest()


def decoded(codes: DataFrame, books: np.ndarray, *, scale: int, code_col: str = "code", vector_col: str = "decoded") -> DataFrame:
    """``codes`` with the vector that each code stands for: its entries over ``scale``."""
    literal = F.array(*(F.array(*(F.array(*(F.lit(float(x) / scale) for x in entry)) for entry in book)) for book in books.tolist()))
    at = [F.conv(F.substring(code_col, 2 * p + 1, 2), 16, 10).cast("int") for p in range(len(books))]
    return codes.withColumn(vector_col, F.concat(*(F.get(F.get(literal, F.lit(p)), at[p]) for p in range(len(books)))))


def compress(vectors: DataFrame, *, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024, size: int | None = None, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(``id_col``, code, error, label_error, codebooks_sha256) of each kept vector.

    Vectors that are null or hold a null or non-finite component are left out; so are those of another length than ``size`` (by default the commonest that
    ``parts`` divides).  Fewer kept vectors than ``entries`` (256 at most) give as many entries.  Ties go to the lower index; an unused entry stays.  Repeated rows
    count each, null ids come last, null labels are one group, and sums that don't fit a bigint are null.  Other columns are ignored, so
    clashing names don't matter.  An empty table gives an empty one.
    """
    if not 0 < entries <= 256:
        raise ValueError("an index has two hex digits: from 1 to 256 entries")
    label = F.col(label_col).cast("string")
    given = vectors.select(F.col(id_col).alias("id"), F.when(label.isNull(), "").otherwise(F.concat(F.lit("="), label)).alias("label"), F.col(vector_col).alias("v"))
    schema = StructType([StructField("id", given.schema["id"].dataType), StructField("label", StringType()), StructField("code", StringType()), StructField("error", LongType())])
    size = size or common_size(kept_vectors(given, None, vector_col="v"), parts, vector_col="v")
    if size and size % parts:
        raise ValueError(f"{parts} equal parts don't make {size} components")
    spark = vectors.sparkSession
    kept = kept_vectors(given, size or parts, vector_col="v")
    books = first_books(kept, parts, entries, scale=scale, id_col="id", vector_col="v")
    if not books.shape[1]:
        return spark.createDataFrame([], schema).select(F.col("id").alias(id_col), "code", "error", F.col("error").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    blocks = integer_blocks(kept, ["id", "label"], size=size, scale=scale, vector_col="v")
    rdd = column_rdd(blocks, size)
    for _ in range(rounds):
        books = improved(rdd, books)

    def encode(batches):
        digits = np.array([f"{i:02x}" for i in range(256)])
        for batch in batches:
            for i in range(batch.num_rows):
                columns = columns_of(batch.column(2)[i].as_py(), batch.column(3)[i].as_py(), size)
                found = [part_distances(p, books[k]) for k, p in enumerate(parts_of(columns, parts))]
                code = digits[found[0][0]]
                for index, _ in found[1:]:
                    code = np.char.add(code, digits[index])
                wide = sum(largest(d) for _, d in found) >= 2**63
                error = sum(d.astype(object) if wide else d for _, d in found)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1).flatten(), batch.column(1).slice(i, 1).flatten(), pa.array(code.tolist(), pa.string()), longs(error)], names=schema.names)

    coded = written(blocks.mapInArrow(encode, schema), "codes")
    labels = written(coded.groupBy("label").agg(F.try_sum("error").alias("label_error"), F.count("*").alias("n_rows")), "label-errors")
    # a row of each label; only where they are too many to broadcast does a hot label need care
    told = coded.join(F.broadcast(labels.drop("n_rows")), "label") if labels.count() <= MOST_BROADCAST else joined_by(coded, labels, "label")
    return told.select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))
