"""Centroid clustering in whole numbers, by blocked matrix products.

|x|^2 - 2 x.c + |c|^2 is one matrix product a block in double-precision BLAS.  A block whose magnitudes could give any sum of
2^53 or more is worked out in 64-bit integers, or in Python's beyond those, so distances are exact always and neither
the order of sums nor the split into blocks matters.  Sums and counts of the clusters merge by ``treeAggregate``: what
comes to the driver is a few tensors of the codebook's size, however many vectors there are.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from .vectors import add_rows, column_rdd, columns_of, exact_kind, integer_blocks, kept_vectors, largest, longs, whole

#: Centroids that a matrix product takes at once.
CENTROID_BLOCK = 1024


def nearest(columns: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of the nearest centroid of each vector (ties: the smaller number).

    columns: (size, vectors); centroids: (number, size); both whole numbers."""
    kind = exact_kind(len(columns) * (largest(columns) + largest(centroids)) ** 2, ((53, np.float64), (63, np.int64)))
    x = columns.T.astype(kind)
    squares, best = (x * x).sum(1), None
    for at in range(0, len(centroids), CENTROID_BLOCK):
        c = centroids[at : at + CENTROID_BLOCK].astype(kind)
        distances = squares[:, None] - 2 * (x @ c.T) + (c * c).sum(1)
        number = distances.argmin(1)
        found = number + at, distances[np.arange(len(x)), number]
        if best is not None:
            closer = found[1] < best[1]
            found = tuple(np.where(closer, new, old) for new, old in zip(found, best, strict=True))
        best = found
    return best[0], best[1] if kind is object else best[1].astype(np.int64)


def first_centroids(kept: DataFrame, number: int, *, scale: int, seed: str, id_col: str, vector_col: str) -> np.ndarray:
    """The vectors whose sha256 of ``seed`` and decimal id is smallest, in its order; repeated ids by their vectors."""
    order = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    rows = kept.select(order.alias("h"), F.col(vector_col).cast("array<double>").alias("v")).orderBy("h", "v").limit(number).collect()
    return whole(np.array([r["v"] for r in rows], dtype=np.float64), scale)


def moved(rdd, centroids: np.ndarray) -> np.ndarray:
    """The centroids after a round: the floor of each non-empty cluster's mean."""

    def gather(total, columns):
        sums, counts, bound = total or (np.zeros(centroids.shape, np.int64), np.zeros(len(centroids), np.int64), 0)
        number, _ = nearest(columns, centroids)
        bound += largest(columns) * columns.shape[1]
        return add_rows(sums, number, columns.T, bound), counts + np.bincount(number, minlength=len(centroids)), bound

    def merge(a, b):
        if not a or not b:
            return a or b
        bound = a[2] + b[2]
        return (a[0].astype(object) if bound >= 2**63 else a[0]) + b[0], a[1] + b[1], bound

    total = rdd.treeAggregate(None, gather, merge)
    if not total:
        return centroids
    sums, counts, _ = total
    return np.where(counts[:, None] > 0, sums // np.maximum(counts, 1)[:, None], centroids)


def inertias(rdd, centroids: np.ndarray) -> list[int]:
    """The squared distances summed over each cluster."""

    def gather(total, columns):
        number, distance = nearest(columns, centroids)
        sums = add_rows(np.zeros(len(centroids), np.int64), number, distance, largest(distance) * len(distance))
        return [a + int(b) for a, b in zip(total or [0] * len(centroids), sums, strict=True)]

    return rdd.treeAggregate(None, gather, lambda a, b: [x + y for x, y in zip(a, b, strict=True)] if a and b else a or b) or [0] * len(centroids)


def cluster(vectors: DataFrame, *, number: int = 40, rounds: int = 5, scale: int = 256, size: int = 64, seed: str = "2:", id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(``id_col``, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each kept vector.

    Vectors that are null, hold a null or non-finite component or haven't ``size`` of them are left out.  Fewer kept vectors than ``number`` give
    as many centroids as there are.  Ties go to the smaller number; an empty cluster's centroid stays.  Repeated rows count each; a null id has the empty text as its
    decimal one; sums that don't fit a bigint are null.  Other columns are ignored, so clashing names don't matter.  An empty table gives an empty one.
    """
    kept = kept_vectors(vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")), size, vector_col="v")
    centroids = first_centroids(kept, number, scale=scale, seed=seed, id_col="id", vector_col="v")
    blocks = integer_blocks(kept, ["id"], size=size, scale=scale, vector_col="v")
    kinds = [StructField("cluster", IntegerType()), StructField("distance", LongType()), StructField("cluster_inertia", LongType()), StructField("inertia", LongType()), StructField("centroid_sha256", StringType())]
    schema = StructType([StructField(id_col, vectors.schema[id_col].dataType), *kinds])
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], schema)
    rdd = column_rdd(blocks, size)
    for _ in range(rounds):
        centroids = moved(rdd, centroids)
    summed = inertias(rdd, centroids)
    digests = [hashlib.sha256(",".join(str(int(x)) for x in c).encode()).hexdigest() for c in centroids]

    def label(batches):
        by_cluster, by_digest = longs(np.array(summed, dtype=object)), pa.array(digests)
        (total,) = longs(np.array([sum(summed)], dtype=object)).to_pylist()
        for batch in batches:
            for i in range(batch.num_rows):
                keys = batch.column(0).slice(i, 1).flatten()
                at, distance = nearest(columns_of(batch.column(1)[i].as_py(), batch.column(2)[i].as_py(), size), centroids)
                at = pa.array(at.astype(np.int32))
                yield pa.RecordBatch.from_arrays([keys, at, longs(distance), by_cluster.take(at), pa.array([total] * len(keys), pa.int64()), by_digest.take(at)], names=schema.names)

    return blocks.mapInArrow(label, schema)
