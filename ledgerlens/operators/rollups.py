"""Daily rollup: one pass over the facts serves several dashboards.

``daily_rollup`` aggregates line items to one row per (date, region) with
exact revenue and counts, plus a HyperLogLog sketch of the customers
(``hll_sketch_agg``).  At any scale the rollup has days x regions rows, so
the panels below are served from it without touching the facts again:

* daily revenue (D1), regional share (D4) and the seasonal split (Q8) are
  exact, because weekday, month and quarter are functions of the date;
* unique customers per month come from merging the daily sketches
  (``hll_union_agg``) - an estimate, since distinct counts cannot be added.

``daily_bitmaps`` keeps who bought on a day exactly, as bitmaps of customer
numbers (4 kB for 32,768 consecutive numbers, where any of them bought);
months, regions or any union of days then count distinct customers exactly,
by OR.  Theta sketches estimate what bitmaps of sparse numbers would be too
large for: who came back, who was lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import dates as D
from ledgerlens.functions import numeric as N
from ledgerlens.operators.analytics import seasonal_from_days
from ledgerlens.operators.bases import orders_where, paid_where
from ledgerlens.operators.dashboard import share_of_regions

HLL_LG_K = 12  # sketch size 2^12 registers: ~1.6% standard error


def daily_rollup(sales: DataFrame, lg_k: int = HLL_LG_K) -> DataFrame:
    """transaction_date, region, revenue (exact DECIMAL), transaction_count,
    paid_count (rows with an amount), customers_sketch (HLL, binary)."""
    return sales.groupBy("transaction_date", "region").agg(
        F.sum("total_amount").alias("revenue"),
        orders_where(sales).alias("transaction_count"),
        paid_where(sales).alias("paid_count"),
        F.hll_sketch_agg("customer_id", lg_k).alias("customers_sketch"),
    )


def daily_revenue_from_rollup(rollup: DataFrame) -> DataFrame:
    return (
        rollup.groupBy("transaction_date")
        .agg(F.sum("revenue").alias("_rev"), F.sum("transaction_count").alias("transaction_count"))
        .select("transaction_date", N.as_double("_rev").alias("revenue"), "transaction_count")
        .orderBy("transaction_date")
    )


def regional_share_from_rollup(rollup: DataFrame) -> DataFrame:
    return share_of_regions(rollup.groupBy("region").agg(F.sum("revenue").alias("_rev")))


def seasonal_from_rollup(rollup: DataFrame) -> DataFrame:
    return seasonal_from_days(
        rollup.groupBy("transaction_date").agg(
            F.sum("revenue").alias("_revenue"),
            F.sum("transaction_count").alias("_n"),
            F.sum("paid_count").alias("_paid"),
        )
    )


def monthly_from_rollup(rollup: DataFrame) -> DataFrame:
    """Monthly revenue and counts (exact) with estimated unique customers."""
    return (
        rollup.groupBy(D.month_start("transaction_date").alias("_month"))
        .agg(
            F.sum("revenue").alias("_rev"),
            F.sum("transaction_count").alias("transaction_count"),
            F.hll_union_agg("customers_sketch").alias("_sketch"),
        )
        .select(
            D.year_month("_month").alias("year_month"),
            N.as_double("_rev").alias("revenue"),
            "transaction_count",
            F.hll_sketch_estimate("_sketch").alias("unique_customers_estimate"),
        )
        .orderBy("year_month")
    )


def daily_bitmaps(sales: DataFrame, *groups: str) -> DataFrame:
    """transaction_date, ``groups``, range_number, customers (bitmap): who bought on each day."""
    rows = sales.filter(F.col("customer_id").isNotNull())
    number = F.bitmap_bucket_number("customer_id").alias("range_number")
    return rows.groupBy("transaction_date", *groups, number).agg(F.bitmap_construct_agg(F.bitmap_bit_position("customer_id")).alias("customers"))


def distinct_customers(bitmaps: DataFrame, **groups: Column) -> DataFrame:
    """COUNT(DISTINCT customer_id) of any grouping of ``daily_bitmaps``, exactly."""
    merged = bitmaps.groupBy(*[c.alias(name) for name, c in groups.items()], "range_number").agg(F.bitmap_or_agg("customers").alias("customers"))
    return merged.groupBy(*groups).agg(F.sum(F.bitmap_count("customers")).alias("unique_customers"))


def monthly_customers(bitmaps: DataFrame) -> DataFrame:
    """Distinct customers per month, from the daily bitmaps."""
    return distinct_customers(bitmaps, year_month=D.year_month("transaction_date")).orderBy("year_month")


def daily_thetas(sales: DataFrame, lg_k: int = 14) -> DataFrame:
    """transaction_date, customers (theta sketch)."""
    return sales.filter(F.col("customer_id").isNotNull()).groupBy("transaction_date").agg(F.theta_sketch_agg("customer_id", lg_k).alias("customers"))


def returning_customers(thetas: DataFrame, previous: Column, current: Column, lg_k: int = 14) -> DataFrame:
    """One row of estimates from ``daily_thetas``: previous, current, returning (bought in both), lost (in the previous only), new (in the current only)."""
    empty = F.lit(None).cast("long")
    before = F.coalesce(F.theta_union_agg(F.when(previous, F.col("customers")), lg_k), F.theta_sketch_agg(empty, lg_k))
    now = F.coalesce(F.theta_union_agg(F.when(current, F.col("customers")), lg_k), F.theta_sketch_agg(empty, lg_k))
    k = thetas.agg(before.alias("before"), now.alias("now"))
    parts = {"previous": F.col("before"), "current": F.col("now"), "returning": F.theta_intersection("before", "now"), "lost": F.theta_difference("before", "now"), "new": F.theta_difference("now", "before")}
    return k.select(*[F.theta_sketch_estimate(x).alias(name) for name, x in parts.items()])
