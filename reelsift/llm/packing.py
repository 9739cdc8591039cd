"""Packing of documents into training windows by Karmarkar-Karp multiway differencing.

A document's ids (with the end id) are cut into whole windows and one rest shorter than a window.
Whole windows are sequences of their own.  Rests go, in groups of bounded size, through multiway
differencing: each partial partition holds one sum for each window; the two with the
largest spread are merged, the fullest window of one with the emptiest of the other, until
one partition is left whose windows are nearly equal.  If its fullest window is over capacity, the
window count rises and the group is partitioned anew.

Only (id, start, length, crc32) of a piece travels, not its ids, unless ``with_ids`` asks for them.
Groups are dealt by the number of a row in the written table of pieces, so no
key, source or group of copies decides a group's size.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, texts_of, written
from .pieces import encoder

#: Rests that are partitioned together; bounds a task's memory and time.
GROUP_PIECES = 2048
#: Most windows of one group; a group's sequence ids lie in a range of this size.
GROUP_WINDOWS = 1 << 14


def difference(sizes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Karmarkar-Karp: the window (0..k-1) of each size, and the windows' sums."""
    n = len(sizes)
    left, right = [-1] * n, [-1] * n
    empty = np.zeros(k, dtype=np.int64)
    parts, heap = {}, []
    for i, x in enumerate(sizes.tolist()):
        sums, nodes = empty.copy(), empty - 1
        sums[0], nodes[0] = x, i
        parts[i] = (sums, nodes)
        heap.append((-x if k > 1 else 0, i))
    heapq.heapify(heap)
    tick = n
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        (sums, nodes), (other, more) = parts.pop(a), parts.pop(b)
        other, more = other[::-1], more[::-1]
        both = np.flatnonzero((nodes >= 0) & (more >= 0))
        met = np.maximum(nodes, more)
        if len(both):
            left += nodes[both].tolist()
            right += more[both].tolist()
            met[both] = np.arange(len(left) - len(both), len(left))
        sums = sums + other
        order = np.argsort(-sums, kind="stable")
        sums, met = sums[order], met[order]
        parts[tick] = (sums, met)
        heapq.heappush(heap, (int(sums[-1] - sums[0]), tick))
        tick += 1
    sums, nodes = parts[heap[0][1]]
    window = np.empty(n, dtype=np.int64)
    for w, root in enumerate(nodes.tolist()):
        stack = [root] if root >= 0 else []
        while stack:
            x = stack.pop()
            if x < n:
                window[x] = w
            else:
                stack += (left[x], right[x])
    return window, sums


def partition(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The window of each size (all at most ``capacity``); the window count rises until the fullest one fits.

    It begins at the least count possible, as no two sizes above half a window share one.  Steps double while windows are too full, and the counts between the last
    that didn't fit and the first that did are halved, so the rounds grow with the logarithm of the count."""
    k = max(1, -(-int(sizes.sum()) // capacity), int((sizes * 2 > capacity).sum()))
    window, sums = difference(sizes, k)
    step = max(1, int(np.maximum(sums - capacity, 0).sum() // capacity))
    failed = k - 1
    while sums.max() > capacity:
        failed, k, step = k, min(k + step, len(sizes)), 2 * step
        window, sums = difference(sizes, k)
    while k - failed > 1:
        middle = (failed + k) // 2
        other, sums = difference(sizes, middle)
        if sums.max() > capacity:
            failed = middle
        else:
            k, window = middle, other
    return window


def pack(docs: DataFrame, tokenizer: str, *, capacity: int = 4096, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids).

    start: ids of the row's document before the piece; offset: ids of the sequence before it.
    ids_crc32: unsigned crc32 of the piece's ids as little-endian unsigned 32-bit integers.
    sequence_id: unique, not gapless.  Null texts count as empty: one piece with the end id alone.
    Repeated rows are packed as often as they come; null ids stay null; other columns are left
    out, so clashing names don't matter.  An empty table gives an empty one.
    Ties in size are broken by row number, so a written table always packs alike.
    """

    def cut(batches):
        enc, end = encoder(tokenizer), np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            out: dict[str, list] = {x: [] for x in ("row", "start", "length", "crc", "total", "ids")}
            for i, ids in enumerate(enc.encode(texts_of(batch.column(1)))):
                ids += end
                for at in range(0, len(ids), 4 * capacity):
                    piece = ids[at : at + 4 * capacity]
                    out["row"].append(i)
                    out["start"].append(at // 4)
                    out["length"].append(len(piece) // 4)
                    out["crc"].append(zlib.crc32(piece))
                    out["total"].append(len(ids) // 4)
                    out["ids"].append(piece if with_ids else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(out["row"], pa.int64())), *(pa.array(out[x], pa.int64()) for x in ("start", "length", "crc", "total")), pa.array(out["ids"], pa.binary())],
                names=["k", "start", "length", "ids_crc32", "doc_tokens", "ids"],
            )

    given = docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("t"))
    kind = given.schema["k"].dataType.simpleString()
    schema = f"k {kind}, start long, length long, ids_crc32 long, doc_tokens long, ids binary"
    cuts = given.mapInArrow(cut, schema)
    pieces = written((cuts if with_ids else cuts.drop("ids")).withColumn("row", F.monotonically_increasing_id()), "pieces")

    rests = pieces.where(F.col("length") < capacity)
    groups = max(1, round(rests.count() / GROUP_PIECES))

    def assign(pdf):
        forget()
        pdf = pdf.sort_values("row", kind="stable")
        window = partition(pdf["length"].to_numpy(dtype=np.int64), capacity)
        pdf["sequence_id"] = (pdf["g"].iloc[0] * GROUP_WINDOWS + window) * 2 + 1
        pdf["offset"] = pdf.groupby("sequence_id")["length"].cumsum() - pdf["length"]
        return pdf[["row", "sequence_id", "offset"]]

    # hash of the row number, so that neighbours, which may be alike, are spread
    dealt = rests.select("row", "length", F.pmod(F.xxhash64("row"), F.lit(groups)).alias("g"))
    placed = dealt.groupBy("g").applyInPandas(assign, "row long, sequence_id long, offset long")
    full = pieces.where(F.col("length") == capacity).withColumn("sequence_id", F.col("row") * 2).withColumn("offset", F.lit(0).cast("long"))
    found = rests.join(placed, "row").unionByName(full)
    names = [F.col("k").alias(id_col), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] if with_ids else [])]
    return found.select(*names)
