"""Per-customer state that a day's orders are merged into.

The state has a row per customer and order instant: how many orders, how many
with an amount, and their exact sum.  It lies in buckets by customer.
``merge`` aggregates a delta, reads the buckets that it touches, writes them
anew and points the manifest (``sources.manifest``) to the new ones: other
buckets are neither read nor written, and readers see a merge whole or not
at all.  A delta has a name and counts once, however often it is merged.

``read`` can stand wherever orders do in churn, RFM, the KPI cards and the
reporting ranges, for any ``as_of``: these count a row as its ``n_orders``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import shared_dir
from ledgerlens.sources.manifest import Manifest

SCHEMA = "customer_id BIGINT, transaction_date TIMESTAMP_NTZ, n_orders BIGINT, n_paid BIGINT, total_amount DECIMAL(38,6)"
BUCKETS = 64


def by_instant(orders: DataFrame) -> DataFrame:
    """Orders as rows of the state: one per customer and instant."""
    return orders.groupBy("customer_id", "transaction_date").agg(
        F.count(F.lit(1)).alias("n_orders"), F.count("total_amount").alias("n_paid"), F.sum("total_amount").cast("decimal(38,6)").alias("total_amount")
    )


class CustomerState:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.root = spark, root.rstrip("/")
        self.manifest = Manifest(spark, self.root)
        self.state = self.manifest.load() or {"buckets": buckets, "folders": {}, "deltas": []}

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """All rows, or those of some buckets."""
        of: dict[str, list[int]] = {}
        for b, name in self.state["folders"].items():
            if buckets is None or int(b) in buckets:
                of.setdefault(name, []).append(int(b))
        out = self.spark.createDataFrame([], SCHEMA)
        for name, some in sorted(of.items()):  # at most as many folders as buckets
            part = self.spark.read.schema(f"{SCHEMA}, _bucket INT").parquet(f"{self.root}/parts/{name}")
            out = out.unionByName(part.filter(F.col("_bucket").isin(some)).drop("_bucket"))
        return out

    def merge(self, orders: DataFrame, name: str) -> list[int]:
        """Add the orders of the delta ``name``; returns the buckets that were read and written."""
        if name in self.state["deltas"]:
            return []
        bucket = F.pmod(F.xxhash64("customer_id"), F.lit(self.state["buckets"])).cast("int").alias("_bucket")
        path = shared_dir(self.spark, "customer-delta")
        by_instant(orders).select("*", bucket).write.parquet(path)
        fresh = self.spark.read.schema(f"{SCHEMA}, _bucket INT").parquet(path)
        touched = sorted(r["_bucket"] for r in fresh.select("_bucket").distinct().collect())  # at most the buckets
        state = {**self.state, "deltas": [*self.state["deltas"], name], "folders": dict(self.state["folders"])}
        if touched:
            both = fresh.unionByName(self.read(touched).select("*", bucket))
            merged = both.groupBy("_bucket", "customer_id", "transaction_date").agg(
                *[F.sum(c).alias(c) for c in ("n_orders", "n_paid")], F.sum("total_amount").cast("decimal(38,6)").alias("total_amount")
            )
            folder = f"merge-{len(state['deltas']):08d}-{uuid.uuid4().hex[:8]}"
            merged.hint("rebalance", "_bucket").write.partitionBy("_bucket").parquet(f"{self.root}/parts/{folder}")
            state["folders"].update({str(b): folder for b in touched})
        self.manifest.commit(state)
        self.state = state
        return touched
