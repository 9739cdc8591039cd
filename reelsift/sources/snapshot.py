"""Versioned snapshots: each version is a Parquet folder; the newest of the numbered pointer files names the current one."""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..functions.ids import work_key
from ..operators import policy
from ..schema import RELEASES, ensure_columns


class Snapshots:
    """Snapshots below ``root``, on any file system Spark can reach.  A version is published by renaming its pointer into place beside the earlier ones, so readers
    see the old or the new one at any time; a dry run publishes nothing."""

    def __init__(self, spark: SparkSession, root: str, schema=RELEASES):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _state(self) -> dict:
        """What the newest pointer says; pointers are numbered and never replaced, so one is always whole."""
        at = self._path(f"{self.root}/pointers")
        names = [f.getPath().getName() for f in self._fs.listStatus(at)] if self._fs.exists(at) else []
        newest = max((int(n) for n in names if n.isdigit()), default=0)
        if not newest:
            return {"version": 0, "next_id": 1}
        return json.loads(self.spark.read.text(f"{self.root}/pointers/{newest}").first()[0])

    def version(self) -> int:
        return self._state()["version"]

    def next_id(self) -> int:
        return self._state()["next_id"]

    def batch_of(self, stream: str) -> int:
        """The last batch of ``stream`` that was published, -1 for none."""
        return self._state().get("batches", {}).get(stream, -1)

    def _pointer(self, version: int) -> dict:
        return json.loads(self.spark.read.text(f"{self.root}/pointers/{version}").first()[0])

    def _folder(self, version: int) -> str:
        return f"{self.root}/{self._pointer(version).get('folder', f'v{version}')}"

    def _write_by_work(self, df: DataFrame, folder: str, buckets: int) -> None:
        """Rows dealt by work key to ``buckets`` files, each sorted by it; the table that Spark writes them through is forgotten, the files stay."""
        name = f"writing_{uuid.uuid4().hex}"
        dealt = df.withColumn("work", work_key()).repartition(buckets, "work")
        dealt.write.format("parquet").bucketBy(buckets, "work").sortBy("work").option("path", folder).saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")

    def read(self, version: int | None = None) -> DataFrame:
        version = self.version() if version is None else version
        if not version:
            return ensure_columns(self.spark.createDataFrame([], "id long"), self.schema)
        return self.spark.read.schema(self.schema).parquet(self._folder(version))

    def read_by_work(self, version: int | None = None) -> DataFrame:
        """A version that was published ``by_work``, with its rows' keys as the column ``work``: ranking by work shuffles nothing, and a key's rows are looked for in one bucket's file.  Any other version as it is read else, with the key worked out."""
        version = self.version() if version is None else version
        buckets = self._pointer(version).get("by_work") if version else None
        if not buckets:
            return self.read(version).withColumn("work", work_key())
        folder = self._folder(version)
        name = f"snapshot_{hashlib.md5(folder.encode()).hexdigest()}"
        columns = self.spark.read.parquet(folder).schema
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({fields}) USING parquet CLUSTERED BY (work) SORTED BY (work) INTO {int(buckets)} BUCKETS LOCATION '{folder}'")
        return self.spark.table(name)

    def read_as(self, role: str, policies: DataFrame, name: str = "releases", version: int | None = None) -> DataFrame:
        """What ``role`` sees of a version, by the rules (:mod:`operators.policy`) for the table ``name``."""
        return policy.visible(self.read(version), policy.rules_of(policies, name), role)

    def publish_as(self, role: str, df: DataFrame, policies: DataFrame, name: str = "releases", **how) -> int:
        """:meth:`publish`, if the rules let ``role`` make each kind of change between the current version and ``df``; else PermissionError."""
        policy.checked_change(self.read(), ensure_columns(df, self.schema), policy.rules_of(policies, name), role)
        return self.publish(df, **how)

    def read_beside(self, name: str, schema) -> DataFrame:
        """The table ``name`` that was published beside the current version, empty where there was none."""
        folder = self._state().get("beside", {}).get(name)
        if folder is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{folder}")

    def publish(self, df: DataFrame, next_id: int | None = None, *, beside: dict[str, DataFrame] | None = None, batch: tuple[str, int] | None = None, by_work: int | None = None) -> int:
        """Write ``df``, and the tables ``beside`` it, as the next version and make them current together; ``batch``: the stream and batch that they hold.  by_work: of releases, the
        number of files that rows are dealt to by work key, for :meth:`read_by_work`; a work with very many rows makes its file so much longer.

        Tables that aren't given stay as they are.  An attempt that dies before its pointer leaves folders of its own, which nothing names."""
        state = self._state()
        version = state["version"] + 1
        folder = f"v{version}" if batch is None and not self._fs.exists(self._path(f"{self.root}/v{version}")) else f"v{version}-{uuid.uuid4().hex}"
        if by_work:
            self._write_by_work(ensure_columns(df, self.schema), f"{self.root}/{folder}", by_work)
        else:
            ensure_columns(df, self.schema).write.parquet(f"{self.root}/{folder}")
        written = {}
        for name, table in (beside or {}).items():
            written[name] = f"{folder}-{name}"
            table.write.parquet(f"{self.root}/{written[name]}")
        batches = state.get("batches", {}) | ({batch[0]: batch[1]} if batch else {})
        self._point({"version": version, "next_id": next_id or state["next_id"], "folder": folder, "beside": state.get("beside", {}) | written, "batches": batches, "by_work": by_work})
        return version

    def _point(self, state: dict) -> None:
        version = state["version"]
        new, at = self._path(f"{self.root}/pointers/.{version}-{uuid.uuid4().hex}"), self._path(f"{self.root}/pointers/{version}")
        out = self._fs.create(new, True)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        # no reader is ever without a pointer: the one before stays
        if self._fs.exists(at) or not self._fs.rename(new, at):
            raise OSError(f"{self.root}: version {version} is written but could not be made current")
