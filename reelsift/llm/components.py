"""Connected components of a link table, by alternating large and small stars.

Each round joins links with the least neighbour of their ends; nothing but two sums comes to the driver.
Every round is checkpointed, so lineage stays short and lost executors cost one round.  A table of at most ``FEW_LINKS`` links, 16 MB, is
solved in one task instead: the same answer without the rounds' shuffles.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint

#: Different links that one task solves.
FEW_LINKS = 1_000_000


def roots_of(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, the least node that each reaches) of links."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[u], root[v])
        least = root.copy()
        # a link tells its ends' roots of the lesser one, and each node takes the root of its root
        for ends in (root[u], root[v]):
            np.minimum.at(least, ends, low)
        least = least[least]
        if (least == root).all():
            return nodes, nodes[root]
        root = least


def _solve(batches):
    held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    if held:
        nodes, roots = roots_of(*(np.concatenate(x) for x in zip(*held, strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(roots)], names=["node", "root"])


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for each node of ``links`` (a long, b long): root is the least node it reaches.

    Null ends and links from a node to itself are ignored; repeated links count once.
    """
    at = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    at, state = checkpoint(at), None
    if at.count() <= FEW_LINKS:
        return checkpoint(at.coalesce(1).mapInArrow(_solve, "node long, root long"))
    for _ in range(max_rounds):
        both = at.unionByName(at.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        floor = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(floor, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(floor.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        at = checkpoint(small)
        now = at.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    # at the fixed point each node has one link, to its root
    return at.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(at.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
