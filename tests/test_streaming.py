"""Incremental rollup refresh: exactly-once, equal to the batch answer."""
import datetime as dt

from pyspark.sql import functions as F

from ledgerlens.operators import dashboard as DB
from ledgerlens.operators import rollups as R
from ledgerlens.session import shared_dir
from ledgerlens.sources.retail import RetailSource
from ledgerlens.streaming.rollup_stream import compact_rollup, read_rollup, refresh_daily_rollup

SALES_SCHEMA = (
    "customer_id BIGINT, product_id BIGINT, transaction_date DATE, quantity DOUBLE, "
    "total_amount DECIMAL(29,12), region STRING"
)


def test_incremental_refresh_matches_batch(spark, sf_dir):
    sales = RetailSource(spark, sf_dir).sales(region=True)
    landing, rollup, ckpt = (shared_dir(spark, p) for p in ("t-sales-land", "t-rollup", "t-rollup-ckpt"))
    cut = F.col("transaction_date") < F.lit(dt.date(1998, 1, 1))
    sales.filter(cut).write.mode("append").parquet(landing)
    refresh_daily_rollup(spark, landing, SALES_SCHEMA, rollup, ckpt)
    first = read_rollup(spark, rollup).agg(F.sum("transaction_count")).first()[0]
    assert first == sales.filter(cut).count()
    sales.filter(~cut).write.mode("append").parquet(landing)
    refresh_daily_rollup(spark, landing, SALES_SCHEMA, rollup, ckpt)
    refresh_daily_rollup(spark, landing, SALES_SCHEMA, rollup, ckpt)  # nothing new: no change
    merged = read_rollup(spark, rollup)
    assert sorted(R.daily_revenue_from_rollup(merged).collect()) == sorted(DB.daily_revenue(sales).collect())
    assert sorted(R.regional_share_from_rollup(merged).collect()) == sorted(DB.regional_share(sales, RetailSource(spark, sf_dir).regions()).collect())


def test_rollup_refuses_another_checkpoint(spark):
    import pytest

    landing, rollup = shared_dir(spark, "t-own-land"), shared_dir(spark, "t-own-rollup")
    rows = [(1, 1, dt.date(2024, 1, 1), 1.0, None, "EU")]
    spark.createDataFrame(rows, SALES_SCHEMA).write.parquet(landing)
    first = shared_dir(spark, "t-own-ckpt")
    refresh_daily_rollup(spark, landing, SALES_SCHEMA, rollup, first)
    with pytest.raises(ValueError):
        refresh_daily_rollup(spark, landing, SALES_SCHEMA, rollup, shared_dir(spark, "t-own-other"))
    refresh_daily_rollup(spark, landing, SALES_SCHEMA, rollup, first)
    assert read_rollup(spark, rollup).agg(F.sum("transaction_count")).first()[0] == 1


def test_compaction_keeps_every_batch_once(spark, sf_dir):
    from ledgerlens.sources.manifest import hadoop_fs

    sales = RetailSource(spark, sf_dir).sales(region=True)
    landing, rollup, ckpt = (shared_dir(spark, p) for p in ("t-c-land", "t-c-rollup", "t-c-ckpt"))
    fs, where = hadoop_fs(spark, rollup)
    folders = lambda: sorted(s.getPath().getName() for s in fs.listStatus(where))
    assert read_rollup(spark, rollup).count() == 0 and compact_rollup(spark, rollup) == -1
    year = F.year("transaction_date")
    before = None
    for years in ((1995, 1996, 1997), (1998, 1999), (2000, 2001)):
        for y in years:
            sales.filter(year == y).coalesce(1).write.mode("append").parquet(landing)
        refresh_daily_rollup(spark, landing, SALES_SCHEMA, rollup, ckpt, max_files_per_trigger=1, compact_after=2)
        if before is not None:  # a reader from before this compaction still has its files
            assert before.agg(F.sum("transaction_count")).first()[0] == n
        before, n = read_rollup(spark, rollup), sales.filter(year <= years[-1]).count()
        assert before.agg(F.sum("transaction_count")).first()[0] == n
    assert len([f for f in folders() if f.startswith("batch_id=")]) == 2  # those that the last compaction replaced
    assert sorted(R.daily_revenue_from_rollup(before).collect()) == sorted(DB.daily_revenue(sales).collect())
    whole = {(r["transaction_date"], r["region"]): r for r in R.daily_rollup(sales).collect()}
    for r in before.select("*", F.hll_sketch_estimate("customers_sketch").alias("k")).collect():
        same = whole[r["transaction_date"], r["region"]]
        assert (r["revenue"], r["paid_count"]) == (same["revenue"], same["paid_count"]) and r["k"] > 0


def test_compaction_leaves_an_unfinished_batch(spark):
    from ledgerlens.sources.manifest import hadoop_fs

    landing, rollup, ckpt = (shared_dir(spark, p) for p in ("t-u-land", "t-u-rollup", "t-u-ckpt"))
    for k in range(3):
        spark.createDataFrame([(k, 1, dt.date(2024, 1, 1 + k), 1.0, None, "EU")], SALES_SCHEMA).coalesce(1).write.mode("append").parquet(landing)
    refresh_daily_rollup(spark, landing, SALES_SCHEMA, rollup, ckpt, max_files_per_trigger=1)
    fs, mark = hadoop_fs(spark, f"{rollup}/batch_id=1/_SUCCESS")
    fs.delete(mark, False)
    assert compact_rollup(spark, rollup) == 0
    assert read_rollup(spark, rollup).agg(F.sum("transaction_count")).first()[0] == 3
