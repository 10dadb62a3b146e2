"""Dashboard aggregates and the KPI report frames.

The original dashboard drew simulated numbers; here each panel is computed
from the sales facts.  Windowed KPIs read the facts once: per-customer
conditional aggregates (one shuffle on customer_id, combined map-side), then
one global aggregate, then ``stack`` into rows.  No range table is crossed
with the facts and no distinct count is needed for customer counts: a
customer is in a window exactly when its latest purchase is.
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
    orders_where,
    paid_where,
    rfm_scored,
    segment_of,
)

# Reporting ranges of the dashboard filter buttons and the
# KPI card titles.
REPORTING_RANGES = (("7d", 7), ("30d", 30), ("90d", 90), ("1y", 365))
CARD_METRICS = ("Total Revenue", "Active Customers", "Avg Order Value", "Churn Rate")
TOP_REPORT_PRODUCTS = 10
CHURN_SEGMENTS = ("At Risk", "Lost Customers")
EVENT_VALUE = f"decimal(24,{N.ORDER_SCALE})"


# ---------------------------------------------------------------- D1 / R1
def daily_revenue(
    sales: DataFrame, as_of: dt.datetime | None = None, days: int | None = None
) -> DataFrame:
    """Revenue and transactions per day; with ``as_of`` and ``days`` only the
    days on or after ``as_of - days`` (the dashboard's 30-day series)."""
    if as_of is not None and days is not None:
        sales = sales.filter(D.on_or_after("transaction_date", D.window_start(as_of, days)))
    return (
        sales.groupBy("transaction_date")
        .agg(F.sum("total_amount").alias("_rev"), orders_where(sales).alias("transaction_count"))
        .select(
            "transaction_date",
            N.as_double("_rev").alias("revenue"),
            "transaction_count",
        )
        .orderBy("transaction_date")
    )


def daily_revenue_calendar(sales: DataFrame, as_of: dt.datetime, days: int = 30) -> DataFrame:
    """The last ``days`` days up to ``as_of``, every one of them: days without sales have no revenue and no transactions."""
    first = as_of.date() - dt.timedelta(days=days - 1)
    axis = sales.sparkSession.range(days).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("transaction_date"))
    found = daily_revenue(sales.filter((F.col("transaction_date") >= F.lit(first)) & (F.col("transaction_date") <= F.lit(as_of.date()))))
    return (
        axis.join(found, "transaction_date", "left")
        .select("transaction_date", F.coalesce("revenue", F.lit(0.0)).alias("revenue"), F.coalesce("transaction_count", F.lit(0)).alias("transaction_count"))
        .orderBy("transaction_date")
    )


def kpi_revenue_trends(orders: DataFrame) -> DataFrame:
    """Monthly sales, order volume and average order value (order grain)."""
    return (
        orders.groupBy(D.month_start("transaction_date").alias("_month"))
        .agg(
            F.sum("total_amount").alias("_rev"),
            orders_where(orders).alias("order_count"),
            paid_where(orders).alias("_paid"),
            F.countDistinct("customer_id").alias("unique_customers"),
        )
        .select(
            D.year_month("_month").alias("year_month"),
            N.as_double("_rev").alias("revenue"),
            "order_count",
            "unique_customers",
            N.round_ratio("_rev", "_paid", 2, N.ORDER_SCALE).cast("double").alias("avg_order_value"),
        )
        .orderBy("year_month")
    )


# ---------------------------------------------------------------- R2 / D3
def kpi_top_products(
    sales: DataFrame,
    products: DataFrame,
    k: int = TOP_REPORT_PRODUCTS,
) -> DataFrame:
    """Top-k products by revenue, with units sold (ties by product_id)."""
    per_product = sales.groupBy("product_id").agg(
        F.sum("total_amount").alias("_rev"), F.sum("quantity").alias("units_sold")
    )
    names = products.select("product_id", "product_name", "category")
    return (
        per_product.join(names, "product_id")
        .select(
            "product_id",
            "product_name",
            "category",
            N.as_double("_rev").alias("total_revenue"),
            "units_sold",
        )
        .orderBy(F.col("total_revenue").desc(), "product_id")
        .limit(k)
    )


# ---------------------------------------------------------------- R3
def kpi_customer_segments(orders: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Per RFM segment: customers, total and average purchase value."""
    scored = rfm_scored(customer_base(orders, as_of))
    return (
        scored.groupBy("customer_segment")
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            F.sum("total_spent").alias("_spent"),
            F.count("total_spent").alias("_spenders"),
        )
        .select(
            "customer_segment",
            "customer_count",
            N.as_double("_spent").alias("total_purchase_value"),
            N.round_ratio("_spent", "_spenders", 2, N.ORDER_SCALE).cast("double").alias("avg_purchase_value"),
        )
        .orderBy(F.col("customer_count").desc(), "customer_segment")
    )


# ---------------------------------------------------------------- D4
def regional_share(sales: DataFrame, regions: DataFrame) -> DataFrame:
    """Revenue per region, its share of the total and the grand total; the
    region (``regions``: customer_id, region) joins per-customer sums."""
    per_customer = sales.groupBy("customer_id").agg(F.sum("total_amount").alias("_rev"))
    per_region = per_customer.join(regions, "customer_id", "left").groupBy("region").agg(F.sum("_rev").alias("_rev"))
    return share_of_regions(per_region)


def share_of_regions(per_region: DataFrame) -> DataFrame:
    """region, ``_rev`` with shares of the total."""
    total = F.sum("_rev").over(Window.partitionBy())  # one row per region
    return per_region.select(
        "region",
        N.as_double("_rev").alias("revenue"),
        N.share_pct("_rev", total, 2, N.LINE_SCALE).alias("share_pct"),
        total.cast("double").alias("grand_total"),
    ).orderBy(F.col("revenue").desc(), "region")


# ---------------------------------------------------------------- D5
def day_hour_heatmap(events: DataFrame, event_type: str = "purchase") -> DataFrame:
    """Weekday (Monday first) x hour grid of activity, all 7 x 24 cells, with
    intensity in percent of the busiest cell (empty cells show 0).

    The 168 grid cells (``spark.range``) are unioned into the event rows as
    zero-weight rows before the one aggregation, so every cell exists after
    it - no join and no second pass over the events.
    """
    keyed = events.filter(F.col("event_type") == event_type).select(
        D.weekday_index_monday_first("ts").alias("day_index"),
        F.hour("ts").alias("hour"),
        F.col("value").cast(EVENT_VALUE).alias("value"),
        F.lit(1).alias("_event"),
    )
    spine = events.sparkSession.range(7 * 24).select(
        (F.col("id") / 24).cast("int").alias("day_index"),
        (F.col("id") % 24).cast("int").alias("hour"),
        F.lit(None).cast(EVENT_VALUE).alias("value"),
        F.lit(None).cast("int").alias("_event"),
    )
    cells = keyed.unionByName(spine).groupBy("day_index", "hour").agg(
        F.count("_event").alias("events"),
        F.coalesce(F.sum("value"), F.lit(0).cast(EVENT_VALUE)).alias("_value"),
    )
    peak = F.max("_value").over(Window.partitionBy())  # 168 rows
    monday = F.lit(dt.date(2024, 1, 1))  # a Monday: names the weekday index
    return cells.select(
        "day_index",
        F.date_format(F.date_add(monday, F.col("day_index")), "EEEE").alias("day_name"),
        "hour",
        "events",
        N.as_double("_value").alias("activity"),
        F.coalesce(N.round_ratio(F.col("_value") * F.lit(100), peak, 1, N.ORDER_SCALE), F.lit(0).cast("decimal(38,1)"))
        .cast("double")
        .alias("intensity_pct"),
    ).orderBy("day_index", "hour")


# ---------------------------------------------------------------- D6 / D7
def kpi_cards(orders: DataFrame, as_of: dt.datetime, days: int = 30) -> DataFrame:
    """Revenue, active customers, average order value and churn rate for the
    last ``days`` days, with the previous period and the change in percent.

    Current period: transaction_date >= as_of - days (no upper bound);
    previous period: [as_of - 2*days, as_of - days).  Churn rate = share of
    customers in the 'At Risk' and 'Lost Customers' RFM segments, scored at
    ``as_of`` (current) and at ``as_of - days`` on the orders up to then
    (previous).
    """
    cur_start = D.window_start(as_of, days)
    prev_start = D.window_start(as_of, 2 * days)
    prev_as_of = as_of - dt.timedelta(days=days)
    date = F.col("transaction_date")
    in_cur = D.on_or_after(date, cur_start)
    in_prev = D.on_or_after(date, prev_start) & ~in_cur
    upto_prev = date <= D.ts_literal(prev_as_of)
    amt = F.col("total_amount")
    per_customer = orders.groupBy("customer_id").agg(
        F.sum(F.when(in_cur, amt)).alias("cur_rev"),
        paid_where(orders, in_cur).alias("cur_paid"),
        orders_where(orders, in_cur).alias("cur_n"),
        F.sum(F.when(in_prev, amt)).alias("prev_rev"),
        paid_where(orders, in_prev).alias("prev_paid"),
        orders_where(orders, in_prev).alias("prev_n"),
        F.max(date).alias("last_purchase_date"),
        orders_where(orders).alias("total_transactions"),
        F.sum(amt).alias("total_spent"),
        F.max(F.when(upto_prev, date)).alias("prev_last"),
        orders_where(orders, upto_prev).alias("prev_total_transactions"),
        F.sum(F.when(upto_prev, amt)).alias("prev_total_spent"),
    )

    # Both scorings are column expressions over the same per-customer rows.
    cur_seg = _segment_expr("last_purchase_date", "total_transactions", "total_spent", as_of)
    prev_seg = _segment_expr("prev_last", "prev_total_transactions", "prev_total_spent", prev_as_of)
    churned = lambda seg: F.when(seg.isin(*CHURN_SEGMENTS), F.lit(1)).otherwise(F.lit(0))
    # A NULL customer keeps its revenue but is no customer.
    known = F.col("customer_id").isNotNull()
    had_prev = known & (F.col("prev_total_transactions") > 0)
    g = per_customer.agg(
        F.sum("cur_rev").alias("cur_rev"),
        F.sum("cur_paid").alias("cur_n"),
        F.count(F.when(known & (F.col("cur_n") > 0), F.lit(1))).alias("cur_cust"),
        F.sum("prev_rev").alias("prev_rev"),
        F.sum("prev_paid").alias("prev_n"),
        F.count(F.when(known & (F.col("prev_n") > 0), F.lit(1))).alias("prev_cust"),
        F.sum(F.when(known, churned(cur_seg))).alias("cur_churn"),
        F.count("customer_id").alias("cur_all"),
        F.sum(F.when(had_prev, churned(prev_seg))).alias("prev_churn"),
        F.count(F.when(had_prev, F.lit(1))).alias("prev_all"),
    )
    aov = lambda r, n: N.round_ratio(r, n, 2, N.ORDER_SCALE).cast("double")
    revenue_m, customers_m, aov_m, churn_m = CARD_METRICS
    cards = g.select(
        F.stack(
            F.lit(4),
            F.lit(revenue_m), N.as_double("cur_rev"), N.as_double("prev_rev"),
            F.lit(customers_m), F.col("cur_cust").cast("double"), F.col("prev_cust").cast("double"),
            F.lit(aov_m), aov("cur_rev", "cur_n"), aov("prev_rev", "prev_n"),
            F.lit(churn_m), N.share_pct("cur_churn", "cur_all"), N.share_pct("prev_churn", "prev_all"),
        ).alias("metric", "current_value", "previous_value")
    )
    change = F.try_divide(
        F.col("current_value") - F.col("previous_value"), F.col("previous_value")
    ) * F.lit(100.0)
    return cards.withColumn("change_pct", change)


def _segment_expr(last: str, n: str, spent: str, at: dt.datetime):
    """The RFM segment of a per-customer row as a single column expression."""
    micros = D.micros_between(last, D.ts_literal(at))
    days_since = micros / F.lit(float(D.MICROS_PER_DAY))
    return segment_of(days_since, F.col(n), F.col(spent), RECENCY_LIMITS, FREQUENCY_LIMITS, MONETARY_LIMITS)


# ---------------------------------------------------------------- D8
def kpi_by_range(
    orders: DataFrame, as_of: dt.datetime, ranges=REPORTING_RANGES
) -> DataFrame:
    """Revenue, orders, customers and average order value per reporting range
    (last 7 / 30 / 90 / 365 days, no upper bound), from one scan."""
    date = F.col("transaction_date")
    aggs = [F.max(date).alias("_last")]
    for i, (_, days) in enumerate(ranges):
        inside = D.on_or_after(date, D.window_start(as_of, days))
        aggs += [
            F.sum(F.when(inside, F.col("total_amount"))).alias(f"_rev{i}"),
            orders_where(orders, inside).alias(f"_n{i}"),
            paid_where(orders, inside).alias(f"_paid{i}"),
        ]
    per_customer = orders.groupBy("customer_id").agg(*aggs)
    totals = []
    for i, (_, days) in enumerate(ranges):
        active = F.col("customer_id").isNotNull() & D.on_or_after("_last", D.window_start(as_of, days))
        totals += [
            F.sum(f"_rev{i}").alias(f"rev{i}"),
            F.sum(f"_n{i}").alias(f"n{i}"),
            F.sum(f"_paid{i}").alias(f"paid{i}"),
            F.count(F.when(active, F.lit(1))).alias(f"c{i}"),
        ]
    g = per_customer.agg(*totals)
    stacked = []
    for i, (label, days) in enumerate(ranges):
        stacked += [
            F.lit(label),
            F.lit(days),
            F.coalesce(N.as_double(f"rev{i}"), F.lit(0.0)),
            F.coalesce(F.col(f"n{i}"), F.lit(0).cast("bigint")),
            F.col(f"c{i}"),
            N.round_ratio(f"rev{i}", f"paid{i}", 2, N.ORDER_SCALE).cast("double"),
        ]
    return g.select(
        F.stack(F.lit(len(ranges)), *stacked).alias(
            "range_label", "days", "revenue", "order_count", "customer_count", "avg_order_value"
        )
    )


# ---------------------------------------------------------------- D9
def first_of_12_months(as_of: dt.datetime) -> dt.date:
    months = as_of.year * 12 + as_of.month - 1 - 11
    return dt.date(months // 12, months % 12 + 1, 1)


def monthly_revenue_12m(sales: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Revenue per month for the 12 calendar months ending with ``as_of``'s;
    a month without sales has 0 (its empty row joins the sales before the
    one aggregation, so the axis is complete without a join)."""
    start = first_of_12_months(as_of)
    rows = sales.filter(D.on_or_after("transaction_date", start)).select(
        D.month_start("transaction_date").alias("_month"), "total_amount", "customer_id", *(["n_orders"] if "n_orders" in sales.columns else []), F.lit(1).alias("_sale")
    )
    spine = sales.sparkSession.range(12).select(
        F.add_months(F.lit(start), F.col("id").cast("int")).cast(rows.schema["_month"].dataType).alias("_month"),
        *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in rows.columns[1:]],
    )
    return (
        rows.unionByName(spine)
        .groupBy("_month")
        .agg(
            F.sum("total_amount").alias("_rev"),
            orders_where(rows, F.col("_sale").isNotNull()).alias("transaction_count"),
            F.countDistinct("customer_id").alias("unique_customers"),
        )
        .select(
            D.year_month("_month").alias("year_month"),
            F.coalesce(N.as_double("_rev"), F.lit(0.0)).alias("revenue"),
            "transaction_count",
            "unique_customers",
        )
        .orderBy("year_month")
    )


__all__ = [
    "daily_revenue",
    "day_hour_heatmap",
    "kpi_by_range",
    "kpi_cards",
    "kpi_customer_segments",
    "kpi_revenue_trends",
    "kpi_top_products",
    "monthly_revenue_12m",
    "regional_share",
]


# ---------------------------------------------------------------- S7 report
def kpi_report(
    sales: DataFrame, orders: DataFrame, products: DataFrame, as_of: dt.datetime
) -> dict[str, DataFrame]:
    """The three report frames (revenue trends, top products, segments)."""
    return {
        "revenue_trends": kpi_revenue_trends(orders),
        "top_products": kpi_top_products(sales, products),
        "customer_segments": kpi_customer_segments(orders, as_of),
    }


def write_report(report: dict[str, DataFrame], path: str, fmt: str = "parquet") -> dict[str, str]:
    """Write each report frame to ``path/<name>``; returns the written paths.

    No frame is funnelled into one task: some panels have a row per product
    or per day.  AQE already coalesces a small frame's final partitions, so
    small frames still land in a few files.
    """
    written = {}
    for name, df in report.items():
        target = f"{path.rstrip('/')}/{name}"
        df.write.mode("overwrite").format(fmt).save(target)
        written[name] = target
    return written
