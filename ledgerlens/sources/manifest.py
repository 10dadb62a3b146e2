"""Small state files on shared storage, and versions of a folder behind them.

A ``Manifest`` is a numbered series of JSON files in one folder.  Each state
is written under a temporary name and then renamed to the next number;
readers take the highest.  A state is therefore seen whole or not at all,
and a writer that dies leaves the last one in force.  One writer at a time
is assumed; a second one that would take the same number fails.

``Versions`` keeps every published version of a folder under its own name
and moves the pointer only after the write has ended: a reader during a
failing write sees the old version whole.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

KEPT_STATES = 10


def hadoop_fs(spark: SparkSession, path: str):
    """The store of ``path`` and the path as Hadoop's."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


class Manifest:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def numbers(self) -> list[int]:
        fs, root = hadoop_fs(self.spark, self.root)
        if not fs.exists(root):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        return sorted(int(n[9:-5]) for n in names if n.startswith("manifest-") and n.endswith(".json"))

    def load(self) -> dict | None:
        """The state in force; None if there is none yet."""
        numbers = self.numbers()
        if not numbers:
            return None
        fs, _ = hadoop_fs(self.spark, self.root)
        stream = fs.open(self._path(f"manifest-{numbers[-1]:010d}.json"))
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def commit(self, state: dict) -> None:
        fs, root = hadoop_fs(self.spark, self.root)
        fs.mkdirs(root)
        numbers = self.numbers()
        after = self._path(f"manifest-{(numbers[-1] + 1 if numbers else 1):010d}.json")
        mine = self._path(f"_writing-{uuid.uuid4().hex}")
        out = fs.create(mine, False)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        if fs.exists(after) or not fs.rename(mine, after):
            fs.delete(mine, False)
            raise RuntimeError(f"another writer has published to {self.root}")
        for n in numbers[: -KEPT_STATES + 1]:
            fs.delete(self._path(f"manifest-{n:010d}.json"), False)


class GateFailed(RuntimeError):
    """A check stopped a publish; the version in force stays."""


class Versions:
    """Published versions of one table."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.manifest = spark, Manifest(spark, root)
        self.root = self.manifest.root

    def _state(self) -> dict:
        return self.manifest.load() or {"current": None, "versions": []}

    def list(self) -> list[dict]:
        """name, at (ISO), schema of every version, the oldest first."""
        return sorted(self._state()["versions"], key=lambda v: (v["at"], v["name"]))

    def folder(self, name: str) -> str:
        return f"{self.root}/versions/{name}"

    def publish(
        self,
        df: DataFrame,
        at: dt.datetime,
        partition_by: str | None = None,
        metrics: dict | None = None,
        gate: Callable[[dict], list[str]] | None = None,
    ) -> dict:
        """Write ``df`` as the version of the instant ``at`` and point readers to it; returns the observed metrics.

        ``metrics`` (name -> aggregate column) are measured by the write
        itself, without another scan.  ``gate`` names what is wrong with
        them: if anything is, the new folder is removed, the old version
        stays in force and GateFailed is raised.  A table without rows
        gives an empty version.
        """
        name = f"{at:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
        schema = df.schema.json()
        seen = Observation(name)
        if metrics:
            df = df.observe(seen, *[m.alias(k) for k, m in metrics.items()])
        if partition_by:
            df = df.hint("rebalance", partition_by)
        writer = df.write.partitionBy(partition_by) if partition_by else df.write
        writer.parquet(self.folder(name))
        found = dict(seen.get) if metrics else {}
        if gate and (wrong := gate(found)):
            self._delete(name)
            raise GateFailed("; ".join(wrong))
        state = self._state()
        state["versions"].append({"name": name, "at": at.isoformat(), "schema": schema})
        state["current"] = name
        self.manifest.commit(state)
        return found

    def read(self, name: str | None = None) -> DataFrame:
        """A version, the one in force by default, with the schema it was written with."""
        state = self._state()
        name = name or state["current"]
        schema = next(v["schema"] for v in state["versions"] if v["name"] == name)
        return self.spark.read.schema(StructType.fromJson(json.loads(schema))).parquet(self.folder(name))

    def _delete(self, name: str) -> None:
        fs, where = hadoop_fs(self.spark, self.folder(name))
        fs.delete(where, True)

    def expire(self, as_of: dt.datetime, keep_days: int = 7) -> list[str]:
        """Take versions older than ``as_of - keep_days`` off the list, then delete them; the one in force stays."""
        state = self._state()
        cutoff = (as_of - dt.timedelta(days=keep_days)).isoformat()
        old = [v["name"] for v in state["versions"] if v["at"] < cutoff and v["name"] != state["current"]]
        if old:
            state["versions"] = [v for v in state["versions"] if v["name"] not in old]
            self.manifest.commit(state)
        for name in old:
            self._delete(name)
        return old

    def summary(self, amount_col: str = "total_amount") -> DataFrame:
        """snapshot_at, row_count, total_amount of every version, empty ones too, in one scan."""
        versions = self.list()
        names = self.spark.createDataFrame([(v["name"], dt.datetime.fromisoformat(v["at"])) for v in versions], "name STRING, snapshot_at TIMESTAMP_NTZ")
        if not versions:
            return names.select("snapshot_at", F.lit(0).cast("long").alias("row_count"), F.lit(None).cast("double").alias("total_amount"))
        schema = StructType.fromJson(json.loads(versions[-1]["schema"]))
        rows = self.spark.read.schema(schema).option("basePath", f"{self.root}/versions").parquet(*[self.folder(v["name"]) for v in versions])
        found = rows.groupBy(F.regexp_extract("_metadata.file_path", "/versions/([^/]+)/", 1).alias("name"))
        found = found.agg(F.count(F.lit(1)).alias("n"), F.sum(amount_col).cast("double").alias("total_amount"))
        return names.join(found, "name", "left").select("snapshot_at", F.coalesce("n", F.lit(0)).alias("row_count"), "total_amount").orderBy("snapshot_at")
