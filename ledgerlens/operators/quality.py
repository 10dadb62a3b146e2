"""Data-quality checks, returned as rows instead of a list of strings.

Output schema of every check:
``check_name string, observed double, threshold double, passed boolean,
message string``.  Each check is one global aggregate over the input (one
partial aggregate per task, one tiny final shuffle), then ``stack`` turns the
single row into check rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import dates as D
from ledgerlens.sources.manifest import Versions

# The reference quality thresholds.
MIN_DAILY_TRANSACTIONS = 100
MAX_TRANSACTION_AMOUNT = 10000
DATA_FRESHNESS_HOURS = 24
DUPLICATE_THRESHOLD = 0.05
MISSING_DATA_THRESHOLD = 0.1

# The reference's issue messages (printf templates).
LOW_VOLUME_MESSAGE = "Low transaction count today: %d (expected: >%d)"
HIGH_AMOUNT_MESSAGE = "Unusually high transaction detected: $%s"
STALE_MESSAGE = "Data is stale: %.1f hours old (threshold: %dh)"

CHECK_COLUMNS = ("check_name", "observed", "threshold", "passed", "message")


def _check(name: str, observed: Column, threshold: float, passed: Column, message: Column):
    return [
        F.lit(name),
        observed.cast("double"),
        F.lit(float(threshold)),
        passed,
        F.when(passed, F.lit("OK")).otherwise(message),
    ]


def quality_checks(
    orders: DataFrame,
    as_of: dt.datetime,
    min_daily: int = MIN_DAILY_TRANSACTIONS,
    max_amount: int = MAX_TRANSACTION_AMOUNT,
    fresh_hours: int = DATA_FRESHNESS_HOURS,
) -> DataFrame:
    """Daily volume, amount outlier and freshness checks for the ``as_of`` day.

    * daily_volume fails when the day's count is below ``min_daily``;
    * amount_outlier fails when the day's largest amount exceeds
      ``max_amount`` (an empty day counts as 0);
    * freshness fails when more than ``fresh_hours`` passed between midnight
      of the latest transaction date and ``as_of``; no rows means no failure.
    """
    k = orders.agg(*[m.alias(name) for name, m in check_metrics(as_of).items()])
    return check_rows(k, as_of, min_daily, max_amount, fresh_hours)


def check_metrics(as_of: dt.datetime) -> dict[str, Column]:
    """What the checks measure, as aggregates of orders."""
    today = D.on_day("transaction_date", as_of.date())
    return {
        "daily_count": F.count(F.when(today, F.lit(1))),
        "max_amount": F.max(F.when(today, F.col("total_amount"))),
        "latest": F.max("transaction_date"),
    }


def check_rows(
    k: DataFrame,
    as_of: dt.datetime,
    min_daily: int = MIN_DAILY_TRANSACTIONS,
    max_amount: int = MAX_TRANSACTION_AMOUNT,
    fresh_hours: int = DATA_FRESHNESS_HOURS,
) -> DataFrame:
    """The check rows of one row of metrics."""
    biggest = F.coalesce(F.col("max_amount"), F.lit(0))
    hours = D.hours_since(F.to_date("latest"), as_of)
    checks = (
        _check(
            "daily_volume",
            F.col("daily_count"),
            min_daily,
            F.col("daily_count") >= min_daily,
            F.format_string(LOW_VOLUME_MESSAGE, F.col("daily_count"), F.lit(min_daily)),
        )
        + _check(
            "amount_outlier",
            biggest,
            max_amount,
            biggest <= max_amount,
            F.format_string(HIGH_AMOUNT_MESSAGE, F.format_number(biggest, 2)),
        )
        + _check(
            "freshness",
            hours,
            fresh_hours,
            hours.isNull() | (hours <= fresh_hours),
            F.format_string(STALE_MESSAGE, hours, F.lit(fresh_hours)),
        )
    )
    return k.select(F.stack(F.lit(3), *checks).alias(*CHECK_COLUMNS))


def duplicate_ratio(
    df: DataFrame,
    keys: list[str],
    threshold: float = DUPLICATE_THRESHOLD,
    exact: bool = True,
    rsd: float = 0.01,
) -> DataFrame:
    """Share of rows that repeat an earlier key: (rows - distinct keys) / rows.

    Exact: two-stage aggregation (per key, then global) instead of a distinct
    count over a struct, so a key holding a third of the rows collapses
    map-side.  ``exact=False`` estimates the distinct keys with HyperLogLog++
    in a single pass with no key shuffle (relative error ``rsd``).
    """
    if exact:
        per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        totals = per_key.agg(F.sum("_n").alias("_rows"), F.count(F.lit(1)).alias("_keys"))
    else:
        totals = df.agg(
            F.count(F.lit(1)).alias("_rows"),
            F.approx_count_distinct(F.struct(*keys), rsd).alias("_keys"),
        )
    ratio = F.try_divide(
        (F.col("_rows") - F.col("_keys")).cast("double"), F.col("_rows").cast("double")
    )
    passed = F.coalesce(ratio <= threshold, F.lit(True))
    return totals.select(
        F.lit("duplicate_ratio").alias("check_name"),
        ratio.alias("observed"),
        F.lit(float(threshold)).alias("threshold"),
        passed.alias("passed"),
        F.when(passed, F.lit("OK"))
        .otherwise(F.lit("duplicate ratio above threshold on " + ", ".join(keys)))
        .alias("message"),
    )


def missing_ratio(
    df: DataFrame, columns: list[str] | None = None, threshold: float = MISSING_DATA_THRESHOLD
) -> DataFrame:
    """Per column: share of NULL values, one check row per column."""
    columns = list(columns or df.columns)
    k = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.col(c)).alias(f"_nn_{i}") for i, c in enumerate(columns)],
    )
    rows = []
    for i, c in enumerate(columns):
        ratio = F.try_divide(
            (F.col("_rows") - F.col(f"_nn_{i}")).cast("double"), F.col("_rows").cast("double")
        )
        passed = F.coalesce(ratio <= threshold, F.lit(True))
        rows += _check(
            f"missing_ratio:{c}", ratio, threshold, passed, F.lit(f"too many missing values in {c}")
        )
    return k.select(F.stack(F.lit(len(columns)), *rows).alias(*CHECK_COLUMNS))


def daily_volume_sql(spark, orders: DataFrame, day: dt.date) -> DataFrame:
    """The daily count and largest amount through ``spark.sql`` with bound
    parameters (no string pasting); same numbers as ``quality_checks``."""
    return spark.sql(
        "SELECT COUNT(*) AS daily_count, MAX(total_amount) AS max_amount "
        "FROM {orders} WHERE transaction_date >= :day_start AND transaction_date < :day_end",
        args={
            "day_start": dt.datetime.combine(day, dt.time()).isoformat(sep=" "),
            "day_end": dt.datetime.combine(day + dt.timedelta(days=1), dt.time()).isoformat(sep=" "),
        },
        orders=orders,
    )


METRICS_SCHEMA = "daily_count BIGINT, max_amount DECIMAL(20,6), latest TIMESTAMP_NTZ"


def publish_checked(
    versions: Versions,
    orders: DataFrame,
    as_of: dt.datetime,
    required: tuple[str, ...] = (),
    **limits: int,
) -> DataFrame:
    """Publish ``orders`` as a version; the checks are measured by the write.

    No scan besides the write reads the table.  If a check named in
    ``required`` fails, the version in force stays and GateFailed is raised.
    Returns the check rows.
    """
    spark = orders.sparkSession

    def rows(found: dict) -> DataFrame:
        return check_rows(spark.createDataFrame([tuple(found[k] for k in ("daily_count", "max_amount", "latest"))], METRICS_SCHEMA), as_of, **limits)

    def gate(found: dict) -> list[str]:
        return [r["message"] for r in rows(found).collect() if not r["passed"] and r["check_name"] in required]

    return rows(versions.publish(orders, as_of, metrics=check_metrics(as_of), gate=gate if required else None))
