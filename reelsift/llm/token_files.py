"""Token-id files with keyed access.

Format, all in one folder of Parquet tables (so that writes commit atomically, survive lost
executors, and work on any store Spark can reach):

``shards``  shard long, n_records, n_tokens long, payload binary: raw little-endian ids, two bytes
            each where the vocabulary allows it and four otherwise.  Shards follow each other
            in ascending document order: by the upper 31 bits (range) and the lower 32 (order).
``ranges``  range int, first_token, first_key, before long: ids before the range; its first key, and the rows of that key in ranges before it.
``index``   part int, n_keys long, levels/bits/prints/shards/at/n/start binary: a minimal perfect
            hash over the document keys of that part.

Keys are (document id, occurrence): the k-th repeated row of an id has occurrence k.  A key's
part is a hash of it; in a part, each level hashes the keys still left into a bit array of
twice their number, keeps bits hit once, and hands the others to the next level.  A key's slot is the
count of kept bits before its own: minimal, perfect, about two probes.  Slots hold
a 32-bit fingerprint, shard, offset and length; a key whose fingerprint differs isn't in the files.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import checkpoint, few, forget, scan_bytes, shared_dir, texts_of, written
from .pieces import encoder

#: Payload bytes of a shard; a shard ends with the document that reaches them.
SHARD_BYTES = 4 << 20
#: Keys of one part of the index, on average.
PART_KEYS = 1 << 16
#: Bytes of ids that a range of documents should have, as long as they compress to half.
RANGE_BYTES = 32 << 20
#: Index parts and shards that are asked for by name at most, so that no other is read; more are met by a join.
NAMED = 200
#: Rows that a repeated id is asked for at a time.
ASKED = 1 << 16
#: The key of null ids.
LOWEST = -(1 << 63)
_SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def mix(keys: np.ndarray, occurrence: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of (key, occurrence); one-to-one in the key."""
    with np.errstate(over="ignore"):
        x = keys.view(np.uint64) + np.uint64((_SEEDS[0] * (seed + 1)) & (2**64 - 1))
        x = x ^ (occurrence.astype(np.uint64) * np.uint64(_SEEDS[1]))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash over distinct (key, occurrence) pairs."""

    def __init__(self, sizes: list[int], bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.rank = np.concatenate([[0], np.cumsum(bits, dtype=np.int64)])

    @classmethod
    def build(cls, keys: np.ndarray, occurrence: np.ndarray) -> PerfectHash:
        sizes, arrays = [], []
        while len(keys):
            size = max(8, 2 * len(keys))
            place = (mix(keys, occurrence, len(sizes)) % np.uint64(size)).astype(np.int64)
            hits = np.bincount(place, minlength=size)
            sizes.append(size)
            arrays.append(hits == 1)
            left = hits[place] > 1
            keys, occurrence = keys[left], occurrence[left]
        return cls(sizes, np.concatenate(arrays) if arrays else np.zeros(0, dtype=bool))

    def slots(self, keys: np.ndarray, occurrence: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 where no level holds it; a stranger may get a slot."""
        slot, base = np.full(len(keys), -1, dtype=np.int64), 0
        open_ = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            if not len(open_):
                break
            place = base + (mix(keys[open_], occurrence[open_], level) % np.uint64(size)).astype(np.int64)
            hit = self.bits[place]
            slot[open_[hit]] = self.rank[place[hit]]
            open_ = open_[~hit]
            base += size
        return slot

    def dump(self) -> tuple[bytes, bytes]:
        return np.array(self.sizes, dtype="<i8").tobytes(), np.packbits(self.bits).tobytes()

    @classmethod
    def load(cls, levels: bytes, bits: bytes) -> PerfectHash:
        sizes = np.frombuffer(levels, dtype="<i8").tolist()
        return cls(sizes, np.unpackbits(np.frombuffer(bits, dtype=np.uint8), count=sum(sizes)).astype(bool))


_PRINT = 61  # seed of fingerprints, above any level


def fingerprint(keys: np.ndarray, occurrence: np.ndarray) -> np.ndarray:
    return (mix(keys, occurrence, _PRINT) >> np.uint64(32)).astype(np.uint32)


def _part(parts: int):
    """The index part of a key: by the same columns in writing and reading."""
    return F.pmod(F.xxhash64("key", "occurrence"), F.lit(parts)).cast("int")


def write_token_files(docs: DataFrame, tokenizer: str, path: str, *, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the ids of ``docs`` and the index under ``path``.

    Ids are bigint or narrower.  Null ids are filed first, under the smallest bigint; null texts count
    as empty and give the end id alone.  Rows of one id are filed in the order of their texts' hashes, and may spread over ranges.
    Other columns are ignored.  An empty table gives empty tables.
    """
    spark = docs.sparkSession
    given = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LOWEST)).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("t")).select("key", F.xxhash64("t").alias("h"), "t")

    def encode(batches):
        enc, end = encoder(tokenizer), np.array([end_id], dtype="<u4").tobytes()
        width = 2 if max(enc.n_ids, end_id + 1) <= 1 << 16 else 4
        for batch in batches:
            ids = [np.frombuffer(x + end, dtype="<u4").astype(f"<u{width}").tobytes() for x in enc.encode(texts_of(batch.column(2)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([width] * len(ids), pa.int32()), pa.array(ids, pa.binary())], names=["key", "h", "width", "ids"])

    # encoded where texts are read, and written: what is dealt by ranges (sampled, then shuffled and sorted) are short ids, not texts
    encoded = written(given.mapInArrow(encode, "key long, h long, width int, ids binary"), "encoded")
    n_ranges = max(1, -(-2 * scan_bytes(encoded) // RANGE_BYTES))
    by = ("key", "h", "ids")
    # rows of one id and text are spread by a number of their own
    ordered = encoded.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(n_ranges, "key", "h", "row").sortWithinPartitions(*by).select(F.spark_partition_id().alias("range"), "key", "width", "ids")

    def shards(batches):
        # ids are made by now: what the encoder remembers goes before the sorted rows come
        forget()
        made, size, keys, seen, counts, payload, last, nth = 0, 0, [], [], [], [], None, 0
        row = lambda: pa.RecordBatch.from_pydict(
            {"shard": [(where << 32) | made], "range": [where], "n_tokens": [sum(counts)], "width": [width], "first_key": [keys[0]], "last_key": [keys[-1]], "last_seen": [seen[-1] + 1], "keys": [np.array(keys, dtype="<i8").tobytes()], "occurrences": [np.array(seen, dtype="<i8").tobytes()], "counts": [np.array(counts, dtype="<i8").tobytes()], "payload": [b"".join(payload)]},
            schema=pa.schema([("shard", pa.int64()), ("range", pa.int32()), ("n_tokens", pa.int64()), ("width", pa.int32()), ("first_key", pa.int64()), ("last_key", pa.int64()), ("last_seen", pa.int64()), ("keys", pa.binary()), ("occurrences", pa.binary()), ("counts", pa.binary()), ("payload", pa.binary())]),
        )
        where = width = 0
        for batch in batches:
            where, width = (batch.column(0)[0].as_py(), batch.column(2)[0].as_py()) if len(batch) else (where, width)
            for key, raw in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist(), strict=True):
                nth = nth + 1 if key == last else 0
                last = key
                keys.append(key)
                seen.append(nth)
                counts.append(len(raw) // width)
                payload.append(raw)
                size += len(raw)
                if size >= SHARD_BYTES:
                    yield row()
                    made, size, keys, seen, counts, payload = made + 1, 0, [], [], [], []
        if keys:
            yield row()

    made = ordered.mapInArrow(shards, "shard long, range int, n_tokens long, width int, first_key long, last_key long, last_seen long, keys binary, occurrences binary, counts binary, payload binary")
    made.write.option("compression", "zstd").parquet(f"{path}/shards")

    stored = spark.read.parquet(f"{path}/shards")
    # one row per range: bounded by the number of tasks, not by rows
    sums = stored.groupBy("range").agg(F.sum("n_tokens").alias("n"), F.min_by("first_key", "shard").alias("low"), F.max_by("last_key", "shard").alias("high"), F.max_by("last_seen", "shard").alias("rows")).collect()
    firsts, at, last, rows = [], 0, None, 0
    for r in sorted(sums, key=lambda r: r["range"]):
        firsts.append((r["range"], at, r["low"], rows if r["low"] == last else 0))
        at += r["n"]
        rows = r["rows"] + (rows if r["high"] == last else 0)
        last = r["high"]
    spark.createDataFrame(firsts, "range int, first_token long, first_key long, before long").coalesce(1).write.parquet(f"{path}/ranges")

    def records(batches):
        for batch in batches:
            for r in batch.to_pylist():
                keys, seen, counts = (np.frombuffer(r[x], dtype="<i8") for x in ("keys", "occurrences", "counts"))
                seen = seen + np.where(keys == r["first_key"], r["before"], 0)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(seen), pa.array(np.full(len(keys), r["shard"])), pa.array(np.cumsum(counts) - counts), pa.array(counts), pa.array(np.full(len(keys), r["start"]) + np.cumsum(counts) - counts)], names=["key", "occurrence", "shard", "at", "n", "start"])

    # ids before each shard: a running sum in a range of shards
    heads = stored.select("shard", "range", "n_tokens").withColumn("ids_before", F.sum("n_tokens").over(Window.partitionBy("range").orderBy("shard")) - F.col("n_tokens"))
    starts = heads.join(spark.read.parquet(f"{path}/ranges"), "range").select("shard", (F.col("first_token") + F.col("ids_before")).alias("start"), "first_key", "before")
    filed = stored.select("shard", "keys", "occurrences", "counts").join(starts, "shard").mapInArrow(records, "key long, occurrence long, shard long, at long, n long, start long")
    n_keys = stored.select(F.sum(F.octet_length("counts") / 8)).first()[0] or 0
    parts = max(1, round(n_keys / PART_KEYS))

    def index(pdf: pd.DataFrame) -> pd.DataFrame:
        keys, seen = pdf["key"].to_numpy(np.int64), pdf["occurrence"].to_numpy(np.int64)
        table = PerfectHash.build(keys, seen)
        order = np.empty(len(keys), dtype=np.int64)
        order[table.slots(keys, seen)] = np.arange(len(keys))
        levels, bits = table.dump()
        put = lambda x: pdf[x].to_numpy(np.int64)[order].astype("<i8").tobytes()
        return pd.DataFrame({"part": [pdf["part"].iloc[0]], "n_keys": [len(keys)], "levels": [levels], "bits": [bits], "prints": [fingerprint(keys, seen)[order].astype("<u4").tobytes()], "shards": [put("shard")], "at": [put("at")], "n": [put("n")], "start": [put("start")]})

    filed.withColumn("part", _part(parts)).groupBy("part").applyInPandas(index, "part int, n_keys long, levels binary, bits binary, prints binary, shards binary, at binary, n binary, start binary").write.option("compression", "zstd").parquet(f"{path}/index")
    spark.createDataFrame([(parts,)], "parts int").coalesce(1).write.parquet(f"{path}/about")


def _asked_for(table: DataFrame, column: str, asked: DataFrame) -> DataFrame:
    """The rows of ``table`` whose ``column`` is in ``asked`` (that column, different values, checkpointed); of few values by name, so that the scan reads no others."""
    named = [r[0] for r in asked.limit(NAMED + 1).collect()]
    return table.where(F.col(column).isin(named)) if len(named) <= NAMED else table.join(few(asked), column, "left_semi")


def look_up(keys: DataFrame, path: str) -> DataFrame:
    """(key, occurrence, shard, at, n, start) of those (key, occurrence) rows of ``keys`` that are in the files.

    A stranger passes with chance 2**-32.
    """
    spark = keys.sparkSession
    parts = spark.read.parquet(f"{path}/about").first()[0]

    def find(_, asked, held):
        if not len(asked) or not len(held):
            return pd.DataFrame({x: np.zeros(0, dtype=np.int64) for x in ("key", "occurrence", "shard", "at", "n", "start")})
        entry = held.iloc[0]
        k, seen = asked["key"].to_numpy(np.int64), asked["occurrence"].to_numpy(np.int64)
        slot = PerfectHash.load(entry["levels"], entry["bits"]).slots(k, seen)
        known = slot >= 0
        known[known] = np.frombuffer(entry["prints"], dtype="<u4")[slot[known]] == fingerprint(k[known], seen[known])
        slot = slot[known]
        return pd.DataFrame({"key": k[known], "occurrence": seen[known]} | {to: np.frombuffer(entry[x], dtype="<i8")[slot] for to, x in (("shard", "shards"), ("at", "at"), ("n", "n"), ("start", "start"))})

    asked = keys.select("key", "occurrence").withColumn("part", _part(parts))
    held = _asked_for(spark.read.parquet(f"{path}/index"), "part", checkpoint(asked.select("part").distinct()))
    return asked.groupBy("part").cogroup(held.groupBy("part")).applyInPandas(find, "key long, occurrence long, shard long, at long, n long, start long")


def read_documents(keys: DataFrame, path: str, *, with_ids: bool = False) -> DataFrame:
    """(key, occurrence, start, n_tokens, ids_crc32[, ids]) of the asked documents, read from their shards by offset.

    start: ids of all documents before it; ids_crc32: of its ids as little-endian unsigned 32-bit
    integers; ids: those bytes.  Only shards and index parts with an asked key are read.
    """
    spark = keys.sparkSession
    names = ["key", "occurrence", "start", "n_tokens", "ids_crc32", "ids"]

    def fetch(_, asked, held):
        if not len(asked) or not len(held):
            return pd.DataFrame({x: np.zeros(0, dtype=object if x == "ids" else np.int64) for x in names})
        payload, width = held["payload"].iloc[0], int(held["width"].iloc[0])
        raw = [np.frombuffer(payload, dtype=f"<u{width}", count=n, offset=at * width).astype("<u4").tobytes() for at, n in zip(asked["at"], asked["n"], strict=True)]
        return pd.DataFrame({"key": asked["key"], "occurrence": asked["occurrence"], "start": asked["start"], "n_tokens": asked["n"], "ids_crc32": [zlib.crc32(x) for x in raw], "ids": raw if with_ids else None})

    placed = written(look_up(keys, path), "asked")
    held = _asked_for(spark.read.parquet(f"{path}/shards").select("shard", "width", "payload"), "shard", checkpoint(placed.select("shard").distinct()))
    found = placed.groupBy("shard").cogroup(held.groupBy("shard")).applyInPandas(fetch, "key long, occurrence long, start long, n_tokens long, ids_crc32 long, ids binary")
    return found if with_ids else found.drop("ids")


def keys_of(docs: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """(key, occurrence) of each row of ``docs``; an id of many rows is counted out ASKED at a time, so no array holds them all."""
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(LOWEST)).alias("key")
    begin = F.sequence(F.lit(0).cast("long"), F.col("c") - 1, F.lit(ASKED).cast("long"))
    blocks = docs.groupBy(key).agg(F.count("*").alias("c")).select("key", "c", F.explode(begin).alias("a"))
    return blocks.select("key", F.explode(F.sequence("a", F.least(F.col("a") + ASKED, F.col("c")) - 1)).alias("occurrence"))


def scratch_path(spark: SparkSession) -> str:
    """A new folder for token files in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/token-files-{uuid.uuid4().hex}"
