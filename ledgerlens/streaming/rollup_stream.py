"""Incremental refresh of the daily rollup with Structured Streaming.

New line-item files landing in a folder are aggregated as they arrive; the
dashboards read the rollup, never the facts.  Each micro-batch writes its
own contribution (exact revenue and counts plus HLL customer sketches per
(date, region)) to ``<rollup>/batch_id=<n>`` with overwrite, so a batch that
is re-run after a failure replaces exactly what it wrote before: the refresh
is exactly-once without a transactional table format.  Batch numbers belong to
one checkpoint: the rollup's manifest names it, and a refresh with another
checkpoint (a lost one, say) is refused rather than counted twice.
``read_rollup``
merges the contributions (sums add, sketches union), which is cheap because
the rollup has days x regions x batches rows.  ``availableNow`` processes
what has landed and stops, matching a scheduled refresh.

Batches are compacted once ``compact_after`` of them lie beside the merged
folder: they and the old merged folder are written as a new one, and the
manifest then says which folder holds the batches up to which number.
Readers take that folder and the later batches, so each batch counts once at
any time.  Folders that a compaction replaced stay until the next one, for
readers that started before it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlens.operators.rollups import HLL_LG_K, daily_rollup
from ledgerlens.sources.manifest import Manifest, hadoop_fs

ROLLUP_SCHEMA = (
    "transaction_date DATE, region STRING, revenue DECIMAL(38,12), "
    "transaction_count BIGINT, paid_count BIGINT, customers_sketch BINARY"
)
COMPACT_AFTER = 100  # batch folders


def _owner(spark: SparkSession, root: str) -> Manifest:
    return Manifest(spark, f"{root}/_owner")  # a name with _ is not read as data


def refresh_daily_rollup(
    spark: SparkSession,
    landing_path: str,
    schema: StructType | str,
    rollup_path: str,
    checkpoint_path: str,
    fmt: str = "parquet",
    lg_k: int = HLL_LG_K,
    max_files_per_trigger: int = 1000,
    compact_after: int = COMPACT_AFTER,
) -> None:
    """Fold every not-yet-seen landing file into the rollup, compact it if it is due, then stop."""
    root = rollup_path.rstrip("/")
    owner = _owner(spark, root)
    state = owner.load()
    if state is None:
        owner.commit({"checkpoint": checkpoint_path.rstrip("/")})
    elif state["checkpoint"] != checkpoint_path.rstrip("/"):
        raise ValueError(f"the rollup was built with the checkpoint {state['checkpoint']}; start a new rollup or use that one")

    def write_contribution(batch: DataFrame, batch_id: int) -> None:
        (
            daily_rollup(batch, lg_k)  # AQE coalesces its few rows after the reduce side has run
            .write.mode("overwrite")
            .parquet(f"{root}/batch_id={batch_id}")
        )

    query = (
        spark.readStream.schema(schema)
        .format(fmt)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(landing_path)
        .writeStream.foreachBatch(write_contribution)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    if len(_batches(spark, root, _through(owner.load()))) >= compact_after:
        compact_rollup(spark, root)


def _through(state: dict | None) -> int:
    """The last batch in the merged folder; -1 if there is none."""
    return state["merged"]["through"] if state and state.get("merged") else -1


def _batches(spark: SparkSession, root: str, after: int) -> list[int]:
    """Numbers of the batch folders later than ``after``."""
    fs, where = hadoop_fs(spark, root)
    if not fs.exists(where):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(where)]
    numbers = [int(n.removeprefix("batch_id=")) for n in names if n.startswith("batch_id=")]
    return sorted(n for n in numbers if n > after)


def _folders(spark: SparkSession, root: str, state: dict | None, batches: list[int]) -> list[str]:
    merged = [f"{root}/{state['merged']['folder']}"] if _through(state) >= 0 else []
    return merged + [f"{root}/batch_id={n}" for n in batches]


def _merge(spark: SparkSession, folders: list[str]) -> DataFrame:
    reader = spark.read.schema(ROLLUP_SCHEMA)
    parts = reader.parquet(*folders) if folders else spark.createDataFrame([], ROLLUP_SCHEMA)
    return parts.groupBy("transaction_date", "region").agg(
        F.sum("revenue").cast("decimal(38,12)").alias("revenue"),
        F.sum("transaction_count").alias("transaction_count"),
        F.sum("paid_count").alias("paid_count"),
        F.hll_union_agg("customers_sketch").alias("customers_sketch"),
    )


def compact_rollup(spark: SparkSession, rollup_path: str) -> int:
    """Merge all finished batches into one folder; returns the last batch it holds (-1: none).

    A folder without its success mark, and those after it, wait: the stream will write that batch again.
    """
    root = rollup_path.rstrip("/")
    owner = _owner(spark, root)
    state = owner.load() or {}
    fs, _ = hadoop_fs(spark, root)
    ready: list[int] = []
    for n in _batches(spark, root, _through(state)):
        if not fs.exists(hadoop_fs(spark, f"{root}/batch_id={n}/_SUCCESS")[1]):
            break
        ready.append(n)
    if not ready:
        return _through(state)
    folder = f"merged/{ready[-1]}-{uuid.uuid4().hex[:8]}"
    _merge(spark, _folders(spark, root, state, ready)).write.parquet(f"{root}/{folder}")
    before = _through(state)
    replaced = state.get("merged")
    owner.commit({**state, "merged": {"through": ready[-1], "folder": folder, "replaced": replaced["folder"] if replaced else None}})
    gone = [f"batch_id={n}" for n in _batches(spark, root, -1) if n <= before]
    if replaced and replaced["replaced"]:
        gone.append(replaced["replaced"])
    for name in gone:
        fs.delete(hadoop_fs(spark, f"{root}/{name}")[1], True)
    return ready[-1]


def read_rollup(spark: SparkSession, rollup_path: str) -> DataFrame:
    """The merged daily rollup: same columns as ``rollups.daily_rollup``; without batches it has no rows."""
    root = rollup_path.rstrip("/")
    state = _owner(spark, root).load()
    return _merge(spark, _folders(spark, root, state, _batches(spark, root, _through(state))))
