"""Shared per-customer base and RFM scoring.

``customer_base`` is one aggregation of the order facts by customer.  Partial
(map-side) aggregation means a customer holding a third of all orders still
costs one row per map task before the shuffle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import dates as D

# RFM score thresholds and segment labels of the reference.
RECENCY_LIMITS = (30, 60, 90, 180)  # days, <=, scores 5..2 (else 1)
FREQUENCY_LIMITS = (20, 15, 10, 5)  # transactions, >=, scores 5..2 (else 1)
MONETARY_LIMITS = (5000, 2000, 1000, 500)  # spend, >=, scores 5..2 (else 1)
SEGMENTS = (
    "Champions",
    "Loyal Customers",
    "New Customers",
    "At Risk",
    "Lost Customers",
    "Potential Loyalists",
)


def _total(held: str, single: Column, rows: DataFrame, condition: Column | None) -> Column:
    """The sum of the counts ``held`` where a condition holds; rows without that column count as one if ``single`` is not null."""
    if held not in rows.columns:
        return F.count(single if condition is None else F.when(condition, single))
    n = F.col(held)
    return F.coalesce(F.sum(n if condition is None else F.when(condition, n)), F.lit(0))


def orders_where(orders: DataFrame, condition: Column | None = None) -> Column:
    """How many orders (or sales) meet a condition.  ``orders`` has a row per
    order, or is a customer state (``sources.customer_state``) or base table
    (``operators.panels``), whose rows stand for ``n_orders`` each."""
    return _total("n_orders", F.lit(1), orders, condition)


def paid_where(orders: DataFrame, condition: Column | None = None) -> Column:
    """How many of them have an amount."""
    return _total("n_paid", F.col("total_amount"), orders, condition)


def measured_where(sales: DataFrame, condition: Column | None = None) -> Column:
    """How many sales have a quantity."""
    return _total("n_measured", F.col("quantity"), sales, condition)


def customer_base(orders: DataFrame, as_of: dt.datetime) -> DataFrame:
    """customer_id, last_purchase_date, total_transactions, total_spent,
    days_since (fractional) and the exact microsecond gap ``_micros_since``."""
    base = orders.groupBy("customer_id").agg(
        F.max("transaction_date").alias("last_purchase_date"),
        orders_where(orders).alias("total_transactions"),
        F.sum("total_amount").alias("total_spent"),
    )
    micros = D.micros_between("last_purchase_date", D.ts_literal(as_of))
    return base.withColumns(
        {
            "days_since": micros / F.lit(float(D.MICROS_PER_DAY)),
            "_micros_since": micros.cast("decimal(38,0)"),
        }
    )


def _ladder(value, limits, at_most: bool):
    expr = None
    for score, limit in zip((5, 4, 3, 2), limits):
        cond = value <= limit if at_most else value >= limit
        expr = F.when(cond, F.lit(score)) if expr is None else expr.when(cond, F.lit(score))
    return expr.otherwise(F.lit(1))


def segment_label(r, f, m):
    """Segment rules, first match wins: all >= 4 Champions; all >= 3 Loyal;
    R >= 4 and F <= 2 New; R <= 2, F >= 3, M >= 3 At Risk; R <= 2 and
    F <= 2 Lost; everything else Potential Loyalists."""
    champions, loyal, new, at_risk, lost, potential = SEGMENTS
    return (
        F.when((r >= 4) & (f >= 4) & (m >= 4), F.lit(champions))
        .when((r >= 3) & (f >= 3) & (m >= 3), F.lit(loyal))
        .when((r >= 4) & (f <= 2), F.lit(new))
        .when((r <= 2) & (f >= 3) & (m >= 3), F.lit(at_risk))
        .when((r <= 2) & (f <= 2), F.lit(lost))
        .otherwise(F.lit(potential))
    )


def scores(days_since, n, spent, recency=RECENCY_LIMITS, frequency=FREQUENCY_LIMITS,
           monetary=MONETARY_LIMITS):
    """(recency_score, frequency_score, monetary_score) expressions, 1-5."""
    return (
        _ladder(days_since, recency, at_most=True),
        _ladder(n, frequency, at_most=False),
        _ladder(spent, monetary, at_most=False),
    )


def segment_of(days_since, n, spent, recency=RECENCY_LIMITS, frequency=FREQUENCY_LIMITS,
               monetary=MONETARY_LIMITS):
    return segment_label(*scores(days_since, n, spent, recency, frequency, monetary))


def rfm_scored(
    base: DataFrame,
    recency=RECENCY_LIMITS,
    frequency=FREQUENCY_LIMITS,
    monetary=MONETARY_LIMITS,
) -> DataFrame:
    """Adds recency/frequency/monetary scores (1-5) and the segment label."""
    r, f, m = scores(
        F.col("days_since"), F.col("total_transactions"), F.col("total_spent"),
        recency, frequency, monetary,
    )
    scored = base.withColumns({"recency_score": r, "frequency_score": f, "monetary_score": m})
    return scored.withColumn(
        "customer_segment",
        segment_label(F.col("recency_score"), F.col("frequency_score"), F.col("monetary_score")),
    )
