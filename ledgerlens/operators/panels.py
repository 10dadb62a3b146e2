"""Base tables that the panels of a day are served from.

``write_bases`` reads the sales once, and the orders once:

* ``customer_days``: sums of the sales by customer and day;
* ``product_days``: sums of the sales by product and day;
* ``customer_orders``: the orders by customer and instant (the rows of a
  customer state).

The first two come from one pass (GROUPING SETS, combined map-side).  A base
row stands for ``n_orders`` sales or orders, ``n_paid`` of them with an amount
and ``n_measured`` with a quantity; the operators count rows by these, so each
takes a base in place of the rows it was summed from and gives the same
result.  Distinct customers are exact, as a base keeps its customers.  What
needs customers by product (distinct customers of a category, buyers of the
top products) or sales reps still reads the sales.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators import analytics as A
from ledgerlens.operators import dashboard as DB
from ledgerlens.operators import rollups as R
from ledgerlens.operators.bases import measured_where, orders_where, paid_where
from ledgerlens.sources.customer_state import by_instant

CUSTOMER_DAYS, PRODUCT_DAYS, CUSTOMER_ORDERS = "customer_days", "product_days", "customer_orders"
_KEYS = {CUSTOMER_DAYS: ["customer_id", "transaction_date"], PRODUCT_DAYS: ["product_id", "transaction_date"]}


@dataclass
class Bases:
    customer_days: DataFrame
    product_days: DataFrame
    customer_orders: DataFrame


def sales_bases(sales: DataFrame) -> DataFrame:
    """Both bases of the sales, told apart by ``base``; a product day has no customer and the other way round."""
    keys = ["customer_id", "product_id", "transaction_date"]
    summed = sales.groupingSets([*_KEYS.values()], *keys).agg(
        F.grouping("product_id").alias("_no_product"),
        F.sum("total_amount").alias("total_amount"),
        F.sum("quantity").alias("quantity"),
        orders_where(sales).alias("n_orders"),
        paid_where(sales).alias("n_paid"),
        measured_where(sales).alias("n_measured"),
    )
    return summed.withColumn("base", F.when(F.col("_no_product") == 1, CUSTOMER_DAYS).otherwise(PRODUCT_DAYS)).drop("_no_product")


def write_bases(sales: DataFrame, orders: DataFrame, path: str) -> Bases:
    """Write the base tables under ``path``; returns them as read from there."""
    root, spark = path.rstrip("/"), sales.sparkSession
    both, instants = sales_bases(sales), by_instant(orders)
    both.hint("rebalance", "base").write.mode("overwrite").partitionBy("base").parquet(f"{root}/sales")
    instants.write.mode("overwrite").parquet(f"{root}/{CUSTOMER_ORDERS}")
    stored = spark.read.schema(both.schema).parquet(f"{root}/sales")
    of = {name: stored.filter(F.col("base") == name).select(*keys, "total_amount", "quantity", "n_orders", "n_paid", "n_measured") for name, keys in _KEYS.items()}
    return Bases(**of, customer_orders=spark.read.schema(instants.schema).parquet(f"{root}/{CUSTOMER_ORDERS}"))


def base_panels(bases: Bases, sales: DataFrame, products: DataFrame, regions: DataFrame, as_of: dt.datetime) -> dict[str, DataFrame]:
    """The panels that the bases answer; ``sales`` serves the buyers of the top products only."""
    days, sold, orders = bases.customer_days, bases.product_days, bases.customer_orders
    return {
        "revenue_growth": A.revenue_growth(days),
        "regional_growth": A.regional_growth(days, regions),
        "executive_summary": A.executive_summary(days, products, as_of, sold=sold),
        "monthly_revenue_12m": DB.monthly_revenue_12m(days, as_of),
        "product_performance": A.product_performance(sales, products, totals=sold),
        "inventory_insights": A.inventory_insights(sold, products, as_of),
        "customer_churn": A.customer_churn(orders, as_of),
        "rfm_segments": A.rfm_segments(orders, as_of),
        "kpi_cards": DB.kpi_cards(orders, as_of),
        "kpi_by_range": DB.kpi_by_range(orders, as_of),
    }


def rollup_of(bases: Bases, regions: DataFrame) -> DataFrame:
    """The daily rollup, from the customers' days."""
    return R.daily_rollup(bases.customer_days.join(regions, "customer_id", "left"))


def bitmaps_of(bases: Bases) -> DataFrame:
    """The daily bitmaps of the customers who ordered."""
    return R.daily_bitmaps(bases.customer_orders.withColumn("transaction_date", F.col("transaction_date").cast("date")))


def base_report(bases: Bases, products: DataFrame, as_of: dt.datetime) -> dict[str, DataFrame]:
    """The KPI report from the bases."""
    return DB.kpi_report(bases.product_days, bases.customer_orders, products, as_of)
