"""Stored answers of the lookup providers, as a Spark data source.

Answers lie in ``<path>/provider=<name>/bucket=<n>/`` as gzipped JSON lines (key, payload), a key in the bucket of its crc32.  Filters on
provider and key are pushed into the source: only the folders of the providers and buckets that are asked for are listed and read, a file a task, and lines of
other keys are dropped where they are read.  ``path`` is any folder that Arrow's file systems reach: a local or mounted one, hdfs, s3, gs.
"""

from __future__ import annotations

import gzip
import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

NAME = "stored_answers"
SCHEMA = "provider string, key string, payload string"
#: Buckets that keys are dealt to; part of the layout.
BUCKETS = 64
#: Lines of a batch.
LINES = 2000


def bucket_of(key: str) -> int:
    return zlib.crc32(key.encode()) % BUCKETS


def write_answers(rows: DataFrame, path: str) -> None:
    """Stores rows (provider, key, payload) under ``path``, which must be new; rows without a provider or key are no answers and are left out.

    A bucket with many rows is written by several tasks, each a file: rows are dealt by provider, bucket and a few digits of a hash."""
    bucket = (F.crc32(F.col("key").cast("binary")) % BUCKETS).cast("int")
    dealt = rows.where("provider is not null and key is not null").select("provider", "key", "payload", bucket.alias("bucket"))
    dealt.repartition("provider", "bucket", F.pmod(F.xxhash64("key", "payload"), F.lit(4))).write.partitionBy("provider", "bucket").option("compression", "gzip").json(path)


@dataclass
class AnswerFile(InputPartition):
    provider: str
    file: str

    def __init__(self, provider: str, file: str):
        super().__init__(file)
        self.provider, self.file = provider, file


class AnswerReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path
        self.providers: set[str] | None = None
        self.keys: set[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes equality and lists on provider and key; hands the others back."""
        for f in filters:
            name = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            if name not in ("provider", "key"):
                yield f
                continue
            values = {str(v) for v in (f.value if isinstance(f, In) else (f.value,)) if v is not None}
            field = "providers" if name == "provider" else "keys"
            before = getattr(self, field)
            setattr(self, field, values if before is None else before & values)

    def _root(self):
        if "://" in self.path or self.path.startswith("file:"):
            return fs.FileSystem.from_uri(self.path)
        return fs.LocalFileSystem(), self.path

    def partitions(self) -> list[InputPartition]:
        store, root = self._root()
        listed = lambda at, name: [(x.path, x.base_name.removeprefix(f"{name}=")) for x in store.get_file_info(fs.FileSelector(at)) if x.base_name.startswith(f"{name}=")]
        buckets = None if self.keys is None else {str(bucket_of(k)) for k in self.keys}
        found: list[InputPartition] = []
        for folder, provider in sorted(listed(root, "provider")):
            if self.providers is not None and provider not in self.providers:
                continue
            for inner, bucket in sorted(listed(folder, "bucket")):
                if buckets is None or bucket in buckets:
                    found += [AnswerFile(provider, x.path) for x in store.get_file_info(fs.FileSelector(inner)) if x.is_file and x.base_name.endswith(".json.gz")]
        return found

    def read(self, partition: AnswerFile) -> Iterator[pa.RecordBatch]:
        if partition is None or partition.value is None:
            return
        store, _ = self._root()
        keys, payloads = [], []

        def batch():
            return pa.RecordBatch.from_pydict({"provider": pa.array([partition.provider] * len(keys), pa.string()), "key": pa.array(keys, pa.string()), "payload": pa.array(payloads, pa.string())})

        with gzip.open(store.open_input_stream(partition.file, compression=None), "rt", encoding="utf-8") as lines:
            for line in lines:
                item = json.loads(line)
                if self.keys is None or item["key"] in self.keys:
                    keys.append(item["key"])
                    payloads.append(item.get("payload"))
                    if len(keys) >= LINES:
                        yield batch()
                        keys, payloads = [], []
        if keys:
            yield batch()


class StoredAnswers(DataSource):
    """``spark.read.format("stored_answers").load(path)``: (provider, key, payload)."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> AnswerReader:
        return AnswerReader(self.options["path"])


def read_answers(spark: SparkSession, path: str, *, provider: str | None = None, keys: list[str] | None = None) -> DataFrame:
    """The answers under ``path``, of one provider and of some keys if these are given; switches on filter push-down for Python sources in this session.

    Each call loads the source anew: Spark keeps what it has pushed with the loaded source, so one loaded table must not be filtered by provider or key in two ways."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(StoredAnswers)
    rows = spark.read.format(NAME).load(path)
    rows = rows if provider is None else rows.where(F.col("provider") == provider)
    return rows if keys is None else rows.where(F.col("key").isin(keys))
