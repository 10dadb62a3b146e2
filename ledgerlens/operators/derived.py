"""Row-level date and format derivations (the scalar function surface).

These are projections only: no shuffle, one whole-stage-codegen stage.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import dates as D
from ledgerlens.functions import numeric as N


def date_fields(orders: DataFrame, as_of: dt.datetime, window_days: int = 30) -> DataFrame:
    """Every date helper applied to each order row."""
    d = F.col("transaction_date")
    return orders.select(
        "customer_id",
        d.alias("transaction_ts"),
        D.year_text(d).alias("year"),
        D.month_text(d).alias("month"),
        D.year_month(d).alias("year_month"),
        D.weekday_index(d).alias("weekday_index"),
        D.weekday_name(d).alias("weekday_name"),
        D.month_number(d).alias("month_number"),
        D.month_name(d).alias("month_name"),
        D.quarter_label(d).alias("quarter"),
        F.to_date(d).alias("day"),
        D.days_since(d, as_of).alias("days_since"),
        D.hours_since(d, as_of).alias("hours_since"),
        F.lit(D.window_start(as_of, window_days)).alias("window_start"),
        D.on_or_after(d, D.window_start(as_of, window_days)).alias("in_window"),
        D.parse_iso_date(F.date_format(d, "yyyy-MM-dd")).alias("parsed_day"),
        D.parse_iso_date(F.date_format(d, "yyyy-MM-dd HH:mm:ss")).alias("parsed_with_time"),
    )


def format_fields(orders: DataFrame) -> DataFrame:
    """Rounding, money text, thousands separators and casts per order row."""
    amt = F.col("total_amount")
    return orders.select(
        "customer_id",
        "transaction_date",
        N.as_double(amt).alias("total_amount"),
        N.round_money(amt, 0).cast("double").alias("amount_round0"),
        N.round_money(amt, 1).cast("double").alias("amount_round1"),
        N.round_money(amt, 2).cast("double").alias("amount_round2"),
        N.money_text(amt).alias("money_text"),
        N.thousands_text(amt, 2).alias("thousands_text"),
        F.col("customer_id").cast("string").alias("customer_text"),
        F.concat(F.lit("C-"), F.col("customer_id").cast("string"), F.lit("/"),
                 D.year_month("transaction_date")).alias("label"),
    )
