"""The ten named analytics (revenue growth ... executive summary).

Inputs: ``sales`` at line-item grain, ``orders`` at order grain, ``products``
(see ``ledgerlens.sources.retail``).  Every function returns a lazy
DataFrame; nothing is collected.

Scale notes, applied throughout:
* facts are aggregated before they meet a dimension wherever the grouping
  key determines the dimension row (Q3, Q9), so joins see one row per key;
* windows without PARTITION BY only ever run on already-aggregated rows
  (one row per month or per status), never on facts;
* facts are reduced to distinct (group, value) rows before several distinct
  counts are taken, so no aggregate expands the raw facts;
* averages divide by the number of non-NULL measures, as SQL AVG does.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions import dates as D
from ledgerlens.functions import numeric as N
from ledgerlens.operators.bases import (
    FREQUENCY_LIMITS,
    MONETARY_LIMITS,
    RECENCY_LIMITS,
    customer_base,
    measured_where,
    orders_where,
    paid_where,
    rfm_scored,
)

# Fixed values of the reference analytics (thresholds and labels).
CHURN_ACTIVE_DAYS = 30
CHURN_AT_RISK_DAYS = 90
CHURN_LABELS = ("Active", "At Risk", "Churned")
TOP_PRODUCTS = 50
RECENT_DAYS = 30
REORDER_COVER_DAYS = 14
STOCK_BANDS = (10, 50, 100)  # Critical <= 10 < Low <= 50 < Medium <= 100 < High
STOCK_LABELS = ("Critical", "Low", "Medium", "High")
REORDER_LABELS = ("Reorder Required", "OK")
NO_SALES_COVER = 999
PERIOD_TYPES = ("Day of Week", "Month", "Quarter")
SUMMARY_METRICS = ("Total Revenue", "Total Customers", "Average Order Value", "Active Products")


def distinct_count(col: str, exact: bool = True, rsd: float = 0.01):
    """COUNT(DISTINCT col); with ``exact=False`` a HyperLogLog++ estimate
    (``approx_count_distinct``, relative error ``rsd``) that needs no
    (group, value) shuffle - an opt-in for very high-cardinality columns."""
    return F.countDistinct(col) if exact else F.approx_count_distinct(col, rsd)


def _money_aggs(sales: DataFrame):
    """Sum, rows, and rows with an amount (the divisor of an average); ``sales``
    may be a base table (``operators.panels``)."""
    return [
        F.sum("total_amount").alias("_revenue"),
        orders_where(sales).alias("_n"),
        paid_where(sales).alias("_paid"),
    ]


# ----------------------------------------------------------------------- Q1
def revenue_growth(sales: DataFrame, exact_distinct: bool = True) -> DataFrame:
    """Monthly revenue, month-on-month and year-on-year growth.

    LAG counts rows, not calendar months (a missing month shifts LAG 12);
    growth is 0 with no previous row and NULL when the previous revenue is 0.
    """
    monthly = sales.groupBy(D.month_start("transaction_date").alias("_month")).agg(
        *_money_aggs(sales), distinct_count("customer_id", exact_distinct).alias("unique_customers")
    )
    w = Window.orderBy("year_month")
    revenue = N.as_double("_revenue")
    return (
        monthly.select(
            D.year_text("_month").alias("year"),
            D.month_text("_month").alias("month"),
            D.year_month("_month").alias("year_month"),
            revenue.alias("revenue"),
            F.col("_n").alias("transaction_count"),
            "unique_customers",
            N.mean("_revenue", "_paid").alias("avg_transaction_value"),
        )
        .withColumns(
            {
                "prev_month_revenue": F.lag("revenue", 1).over(w),
                "prev_year_revenue": F.lag("revenue", 12).over(w),
            }
        )
        .withColumns(
            {
                "mom_growth_rate": N.pct_change("revenue", "prev_month_revenue"),
                "yoy_growth_rate": N.pct_change("revenue", "prev_year_revenue"),
            }
        )
        .orderBy("year_month")
    )


def revenue_growth_calendar(sales: DataFrame) -> DataFrame:
    """Variant of ``revenue_growth`` that compares with the calendar month one
    and twelve months earlier instead of the previous rows.

    A RANGE frame on a month index (year * 12 + month) picks exactly the
    month ``k`` back, or nothing when that month had no sales (growth is then
    0, the parity rule for "no previous value").  Same columns as the parity
    query; it runs on the aggregated months only.
    """
    parity = revenue_growth(sales).drop(
        "prev_month_revenue", "prev_year_revenue", "mom_growth_rate", "yoy_growth_rate"
    )
    idx = F.col("year").cast("int") * 12 + F.col("month").cast("int")
    w = Window.orderBy(idx)
    # a NULL month has no calendar neighbour (its frame would be its peers)
    prev = lambda k: F.when(idx.isNotNull(), F.max("revenue").over(w.rangeBetween(-k, -k)))
    return (
        parity.withColumns({"prev_month_revenue": prev(1), "prev_year_revenue": prev(12)})
        .withColumns(
            {
                "mom_growth_rate": N.pct_change("revenue", "prev_month_revenue"),
                "yoy_growth_rate": N.pct_change("revenue", "prev_year_revenue"),
            }
        )
        .orderBy("year_month")
    )


# ----------------------------------------------------------------------- Q2
def customer_churn(
    orders: DataFrame,
    as_of: dt.datetime,
    active_days: int = CHURN_ACTIVE_DAYS,
    at_risk_days: int = CHURN_AT_RISK_DAYS,
) -> DataFrame:
    """Customers split into Active / At Risk / Churned by days since last buy."""
    base = customer_base(orders, as_of)
    active, at_risk, churned = CHURN_LABELS
    status = (
        F.when(F.col("days_since") <= active_days, F.lit(active))
        .when(F.col("days_since") <= at_risk_days, F.lit(at_risk))
        .otherwise(F.lit(churned))
    )
    per_status = base.groupBy(status.alias("customer_status")).agg(
        F.count(F.lit(1)).alias("customer_count"),
        F.sum("total_spent").alias("_spent"),
        F.count("total_spent").alias("_spenders"),
        F.sum("total_transactions").alias("_txns"),
    )
    # at most three rows: the empty OVER() is a trivially small window
    total = F.sum("customer_count").over(Window.partitionBy())
    return per_status.select(
        "customer_status",
        "customer_count",
        N.share_pct("customer_count", total).alias("percentage"),
        N.mean("_spent", "_spenders").alias("avg_customer_value"),
        N.mean("_txns", "customer_count").alias("avg_transactions_per_customer"),
    )


# ----------------------------------------------------------------------- Q3
def product_performance(
    sales: DataFrame, products: DataFrame, k: int = TOP_PRODUCTS, totals: DataFrame | None = None
) -> DataFrame:
    """Top-k products by revenue with estimated profit.

    The facts are aggregated per product first (partial aggregation makes a
    hot product harmless) and cut to the top k; distinct buyers are counted
    for those k products only, found by a semi join with k ids (a broadcast
    bounded by ``k``).  Ties at rank k are broken by product_id.  ``totals``:
    a base table of the same sales by product, which the sums come from.
    """
    totals = sales if totals is None else totals
    per_product = totals.groupBy("product_id").agg(
        F.sum("quantity").alias("units_sold"), *_money_aggs(totals)
    )
    dims = products.select("product_id", "category", "product_name", "brand", "profit_margin")
    top = (
        per_product.join(dims, "product_id")
        .withColumn("total_revenue", N.as_double("_revenue"))
        .orderBy(F.col("total_revenue").desc(), F.col("product_id").asc())
        .limit(k)
    )
    buyers = (
        sales.join(F.broadcast(top.select("product_id")), "product_id", "left_semi")
        .groupBy("product_id")
        .agg(F.countDistinct("customer_id").alias("unique_buyers"))
    )
    return (
        top.join(F.broadcast(buyers), "product_id", "left")
        .select(
            "product_id",
            "category",
            "product_name",
            "brand",
            "units_sold",
            "total_revenue",
            "unique_buyers",
            F.col("_n").alias("transaction_count"),
            N.mean("_revenue", "_paid").alias("avg_order_value"),
            F.round("profit_margin", 2).alias("profit_margin"),
            N.percent_of("_revenue", "profit_margin").cast("double").alias("estimated_profit"),
        )
        .orderBy(F.col("total_revenue").desc(), F.col("product_id").asc())
        .drop("product_id")
    )


# ----------------------------------------------------------------------- Q4
def category_trends(
    sales: DataFrame,
    products: DataFrame,
    exact_distinct: bool = True,
) -> DataFrame:
    """Category x month revenue, units, distinct customers, average."""
    cats = products.select("product_id", "category")
    joined = sales.join(cats, "product_id")
    return (
        joined.groupBy("category", D.month_start("transaction_date").alias("_month"))
        .agg(
            F.sum("total_amount").alias("_revenue"),
            F.sum("quantity").alias("units_sold"),
            distinct_count("customer_id", exact_distinct).alias("unique_customers"),
            F.count("total_amount").alias("_paid"),
        )
        .select(
            "category",
            D.year_month("_month").alias("month"),
            N.as_double("_revenue").alias("monthly_revenue"),
            "units_sold",
            "unique_customers",
            N.mean("_revenue", "_paid").alias("avg_transaction_value"),
        )
        .orderBy("category", "month")
    )


# ----------------------------------------------------------------------- Q5
def rfm_segments(
    orders: DataFrame,
    as_of: dt.datetime,
    recency=RECENCY_LIMITS,
    frequency=FREQUENCY_LIMITS,
    monetary=MONETARY_LIMITS,
) -> DataFrame:
    """RFM scores -> six segments, with share and rounded averages."""
    scored = rfm_scored(customer_base(orders, as_of), recency, frequency, monetary)
    per_segment = scored.groupBy("customer_segment").agg(
        F.count(F.lit(1)).alias("customer_count"),
        F.sum("total_spent").alias("_spent"),
        F.count("total_spent").alias("_spenders"),
        F.sum("total_transactions").alias("_freq"),
        F.sum("_micros_since").alias("_micros"),
        F.count("_micros_since").alias("_dated"),
    )
    total = F.sum("customer_count").over(Window.partitionBy())  # <= 6 rows
    return per_segment.select(
        "customer_segment",
        "customer_count",
        N.share_pct("customer_count", total).alias("percentage"),
        N.round_ratio("_spent", "_spenders", 2, N.ORDER_SCALE).cast("double").alias("avg_customer_value"),
        N.round_ratio("_freq", "customer_count", 1).cast("double").alias("avg_purchase_frequency"),
        N.round_ratio(
            "_micros", F.col("_dated").cast("decimal(38,0)") * F.lit(D.MICROS_PER_DAY), 0
        )
        .cast("double")
        .alias("avg_days_since_last_purchase"),
    ).orderBy(F.col("customer_count").desc(), "customer_segment")


# ----------------------------------------------------------------------- Q6
def regional_growth(sales: DataFrame, regions: DataFrame) -> DataFrame:
    """Region x month revenue with month-on-month growth per region.

    The facts are reduced to (customer, month) before the customer's region
    (``regions``: customer_id, region) is attached, so the dimension meets
    no raw fact and distinct customers are plain counts.
    """
    per_customer = sales.groupBy("customer_id", D.month_start("transaction_date").alias("_month")).agg(
        F.sum("total_amount").alias("_revenue"), orders_where(sales).alias("_n")
    )
    monthly = per_customer.join(regions, "customer_id", "left").groupBy("region", "_month").agg(
        F.sum("_revenue").alias("_revenue"),
        F.sum("_n").alias("transactions"),
        F.count("customer_id").alias("unique_customers"),
    )
    w = Window.partitionBy("region").orderBy("month")
    return (
        monthly.select(
            "region",
            D.year_month("_month").alias("month"),
            N.as_double("_revenue").alias("revenue"),
            "transactions",
            "unique_customers",
        )
        .withColumn("prev_month_revenue", F.lag("revenue", 1).over(w))
        .withColumn("growth_rate", N.pct_change("revenue", "prev_month_revenue"))
        .orderBy("region", "month")
    )


# ----------------------------------------------------------------------- Q7
def sales_rep_performance(sales: DataFrame) -> DataFrame:
    """Per sales rep: volume, revenue, reach, revenue per customer, active span.

    Both distinct counts are taken over reduced rows: one per (rep, customer),
    which also carries the sums, and one per (rep, product).
    """
    per_customer = sales.groupBy("sales_rep", "customer_id").agg(
        *_money_aggs(sales),
        F.min("transaction_date").alias("_first"),
        F.max("transaction_date").alias("_last"),
    )
    agg = per_customer.groupBy("sales_rep").agg(
        F.sum("_n").alias("total_transactions"),
        F.sum("_revenue").alias("_revenue"),
        F.sum("_paid").alias("_paid"),
        F.count("customer_id").alias("unique_customers"),
        F.min("_first").alias("_first"),
        F.max("_last").alias("_last"),
    )
    reach = (
        sales.select("sales_rep", "product_id").distinct()
        .groupBy(F.col("sales_rep").alias("_rep")).agg(F.count("product_id").alias("products_sold"))
    )
    return agg.join(reach, F.col("sales_rep").eqNullSafe(F.col("_rep"))).select(
        "sales_rep",
        "total_transactions",
        N.as_double("_revenue").alias("total_revenue"),
        N.mean("_revenue", "_paid").alias("avg_transaction_value"),
        "unique_customers",
        "products_sold",
        N.round_ratio("_revenue", "unique_customers", 2, N.LINE_SCALE).cast("double").alias("revenue_per_customer"),
        D.year_month("_first").alias("first_sale_month"),
        D.year_month("_last").alias("latest_sale_month"),
    ).orderBy(F.col("total_revenue").desc(), "sales_rep")


# ----------------------------------------------------------------------- Q8
def seasonal_analysis(sales: DataFrame) -> DataFrame:
    """Revenue by weekday, month and quarter in one scan.

    The facts are summed per day first; weekday, month and quarter are
    functions of the day.
    """
    return seasonal_from_days(sales.groupBy("transaction_date").agg(*_money_aggs(sales)))


def seasonal_from_days(days: DataFrame) -> DataFrame:
    """GROUPING SETS over daily sums (``_revenue``, ``_n``, ``_paid``).

    grouping_id() tells a NULL weekday/month (NULL date) apart from the
    sets a row does not belong to; a NULL date lands in 'Q4'.
    """
    keyed = days.select(
        D.weekday_name("transaction_date").alias("_dow"),
        D.month_name("transaction_date").alias("_mon"),
        D.quarter_label("transaction_date").alias("_qtr"),
        "_revenue",
        "_n",
        "_paid",
    )
    agg = keyed.groupingSets([["_dow"], ["_mon"], ["_qtr"]], "_dow", "_mon", "_qtr").agg(
        F.grouping_id().alias("_gid"),
        F.sum("_revenue").alias("_total"),
        F.sum("_n").alias("transaction_count"),
        F.sum("_paid").alias("_all_paid"),
    )
    # grouping_id bits: _dow=4, _mon=2, _qtr=1 (1 = not grouped by that column)
    by_weekday, by_month, by_quarter = PERIOD_TYPES
    gid = F.col("_gid")
    return agg.select(
        F.when(gid == 3, F.lit(by_weekday)).when(gid == 5, F.lit(by_month))
        .otherwise(F.lit(by_quarter)).alias("period_type"),
        F.when(gid == 3, F.col("_dow")).when(gid == 5, F.col("_mon"))
        .otherwise(F.col("_qtr")).alias("period_value"),
        N.as_double("_total").alias("total_revenue"),
        "transaction_count",
        N.mean("_total", "_all_paid").alias("avg_transaction_value"),
    ).orderBy("period_type", "period_value")


# ----------------------------------------------------------------------- Q9
def inventory_insights(
    sales: DataFrame,
    products: DataFrame,
    as_of: dt.datetime,
    days: int = RECENT_DAYS,
    cover_days: int = REORDER_COVER_DAYS,
    bands=STOCK_BANDS,
) -> DataFrame:
    """Stock cover and reorder advice for active products.

    ``avg_daily_sales`` is the average quantity per recent transaction (the
    reference formula and name).  Cover is compared unrounded.
    """
    start = D.window_start(as_of, days)
    recent = (
        sales.filter(D.on_or_after("transaction_date", start))
        .groupBy("product_id")
        .agg(
            F.sum("quantity").alias("units_sold_30_days"),
            F.sum(F.col("quantity").cast("double")).alias("_qsum"),
            measured_where(sales).alias("_qn"),
        )
        .select(
            "product_id",
            "units_sold_30_days",
            N.mean("_qsum", "_qn").alias("avg_daily_sales"),
        )
    )
    active = products.filter(F.col("is_active") == 1).select(
        "product_id", "product_name", "category", "stock_quantity"
    )
    joined = active.join(recent, "product_id", "left")
    avg = F.coalesce(F.col("avg_daily_sales"), F.lit(0.0))
    cover = F.try_divide(F.col("stock_quantity").cast("double"), F.col("avg_daily_sales"))
    low, mid, high = bands
    critical_l, low_l, medium_l, high_l = STOCK_LABELS
    reorder_l, ok_l = REORDER_LABELS
    stock = F.col("stock_quantity")
    return joined.select(
        "product_id",
        "product_name",
        "category",
        "stock_quantity",
        F.coalesce(F.col("units_sold_30_days"), F.lit(0.0)).alias("units_sold_last_30_days"),
        avg.alias("avg_daily_sales"),
        F.when(avg > 0, F.round(cover, 0))
        .otherwise(F.lit(float(NO_SALES_COVER)))
        .alias("days_of_inventory"),
        F.when(stock <= low, F.lit(critical_l))
        .when(stock <= mid, F.lit(low_l))
        .when(stock <= high, F.lit(medium_l))
        .otherwise(F.lit(high_l))
        .alias("stock_status"),
        F.when((avg > 0) & (cover < cover_days), F.lit(reorder_l))
        .otherwise(F.lit(ok_l))
        .alias("reorder_recommendation"),
    ).orderBy("days_of_inventory", "product_id")


# ---------------------------------------------------------------------- Q10
def executive_summary(
    sales: DataFrame, products: DataFrame, as_of: dt.datetime, days: int = RECENT_DAYS, sold: DataFrame | None = None
) -> DataFrame:
    """Four KPI rows, all-time vs. the last ``days`` days, values as text.

    The facts are reduced to one row per customer with conditional sums, then
    to one row; distinct products are counted over the recent facts only, and
    the active-product count is a scalar subquery on the catalogue.  ``sold``:
    a base table of the same sales by product, which the products come from.
    """
    recent = D.on_or_after("transaction_date", D.window_start(as_of, days))
    per_customer = sales.groupBy("customer_id").agg(
        *_money_aggs(sales),
        F.sum(F.when(recent, F.col("total_amount"))).alias("_revenue_r"),
        paid_where(sales, recent).alias("_paid_r"),
        orders_where(sales, recent).alias("_n_r"),
    )
    kpis = per_customer.agg(
        F.sum("_revenue").alias("rev"),
        F.sum("_paid").alias("n"),
        F.count("customer_id").alias("cust"),
        F.sum("_revenue_r").alias("rev_r"),
        F.sum("_paid_r").alias("n_r"),
        F.count(F.when(F.col("_n_r") > 0, F.col("customer_id"))).alias("cust_r"),
    )
    recent_products = (sales if sold is None else sold).filter(recent).agg(F.countDistinct("product_id")).scalar()
    active_products = (
        products.filter(F.col("is_active") == 1).agg(F.count(F.lit(1))).scalar()
    )
    aov = lambda s, n: N.money_text(N.round_ratio(s, n, 2, N.LINE_SCALE))
    revenue_m, customers_m, aov_m, products_m = SUMMARY_METRICS
    rows = kpis.select(
        F.stack(
            F.lit(4),
            F.lit(revenue_m), N.money_text("rev"), N.money_text("rev_r"),
            F.lit(customers_m), F.col("cust").cast("string"), F.col("cust_r").cast("string"),
            F.lit(aov_m), aov("rev", "n"), aov("rev_r", "n_r"),
            F.lit(products_m), active_products.cast("string"), recent_products.cast("string"),
        ).alias("metric", "current_value", "last_30_days")
    )
    return rows.withColumn("growth_rate", F.lit(None).cast("double"))
