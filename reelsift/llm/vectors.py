"""Vectors as blocks of whole numbers, for operators that count exactly.

Kept vectors (right length, every component there and finite) become ``floor(scale * x)`` and are written
once, as columnar blocks of at most :data:`BLOCK` vectors in a Parquet table of the shared folder.  Every pass reads that
table, so a lost executor costs its own blocks alone.  Numbers that 32 bits don't hold are kept as decimal text and
come back as Python's integers, so nothing overflows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StringType, StructField, StructType

from .common import written

#: Vectors of a block.
BLOCK = 2048


def kept_vectors(vectors: DataFrame, size: int | None, *, vector_col: str) -> DataFrame:
    """Rows whose vector is there, has ``size`` components (None: any number but zero) and holds neither nulls nor non-finite numbers."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return vectors.where(v.isNotNull() & (F.size(v) == size if size else F.size(v) > 0) & finite)


def common_size(vectors: DataFrame, multiple: int, *, vector_col: str) -> int | None:
    """The commonest length among those that ``multiple`` divides (ties: the longer); None without one."""
    lengths = vectors.groupBy(F.size(vector_col).alias("size")).count().where(F.col("size") % multiple == 0)
    first = lengths.orderBy(F.desc("count"), F.desc("size")).first()
    return first and first["size"]


def whole(values: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` of doubles, exactly: int64, or Python's integers where a number needs 32 bits or more."""
    if not values.size or np.abs(values).max() < 2**31 / scale - 1:
        return np.floor(values * scale).astype(np.int64)
    return np.array([int(x) * scale if abs(x) > 2**53 else math.floor(x * scale) for x in values.ravel().tolist()], dtype=object).reshape(values.shape)


def largest(x: np.ndarray) -> int:
    """The greatest magnitude in ``x``."""
    return max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0


def exact_kind(bound: int, kinds) -> type:
    """The first of ``kinds``, pairs of a power of two and a type, whose power ``bound`` stays below; else Python's integers."""
    return next((kind for bits, kind in kinds if bound < 2**bits), object)


def integer_blocks(vectors: DataFrame, keys: list[str], *, size: int, scale: int, vector_col: str) -> DataFrame:
    """The written table of blocks: each of ``keys`` as a list, and the numbers, component by component, as ``data`` (little-endian 32 bits) or ``wide`` (decimal text)."""

    def pack(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                ints = whole(part.column(len(keys)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size), scale).T
                lists = [pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(i)) for i in range(len(keys))]
                narrow = ints.dtype != object
                data = [ints.astype("<i4").tobytes() if narrow else None], [None if narrow else ",".join(map(str, ints.ravel().tolist()))]
                yield pa.RecordBatch.from_arrays([*lists, pa.array(data[0], pa.binary()), pa.array(data[1], pa.string())], names=[*names, "data", "wide"])

    names = [f"key{i}" for i in range(len(keys))]
    given = vectors.select(*(F.col(k).alias(n) for k, n in zip(keys, names, strict=True)), F.col(vector_col).alias("v"))
    kinds = [StructField(n, ArrayType(given.schema[n].dataType)) for n in names]
    return written(given.mapInArrow(pack, StructType([*kinds, StructField("data", BinaryType()), StructField("wide", StringType())])), "vectors")


def columns_of(data: bytes | None, wide: str | None, size: int) -> np.ndarray:
    """A block's numbers as (size, vectors): 32 bits, or Python's integers."""
    if wide is None:
        return np.frombuffer(data, dtype="<i4").reshape(size, -1)
    return np.array([int(x) for x in wide.split(",")], dtype=object).reshape(size, -1)


def column_rdd(blocks: DataFrame, size: int):
    """The blocks' numbers as an RDD of arrays."""
    return blocks.select("data", "wide").rdd.map(lambda r: columns_of(r[0], r[1], size))


def longs(values) -> pa.Array:
    """Whole numbers as bigints; null where one doesn't fit."""
    if getattr(values, "dtype", object) != object:
        return pa.array(values.astype(np.int64))
    return pa.array([int(x) if -(2**63) <= x < 2**63 else None for x in values], pa.int64())


def add_rows(sums: np.ndarray, at: np.ndarray, rows: np.ndarray, bound: int) -> np.ndarray:
    """``sums`` with each of ``rows`` added at its place, in 64 bits while ``bound``, what all magnitudes add up to at most, is below 2^63; else in Python's integers."""
    if bound >= 2**63 or rows.dtype == object:
        sums = sums.astype(object)
    np.add.at(sums, at, rows.astype(sums.dtype))
    return sums
