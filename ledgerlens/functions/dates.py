"""Date expressions (all Catalyst built-ins, all inside whole-stage codegen).

The SQLite-style date helpers of the original queries map onto Spark as
follows; ``as_of`` replaces the wall clock everywhere.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000
MICROS_PER_HOUR = 3_600_000_000


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def year_text(d) -> Column:
    return F.date_format(_c(d), "yyyy")


def month_text(d) -> Column:
    return F.date_format(_c(d), "MM")


def year_month(d) -> Column:
    return F.date_format(_c(d), "yyyy-MM")


def month_start(d) -> Column:
    """First day of the month: a cheap DATE grouping key; format it with
    ``year_month`` after aggregation instead of formatting every fact row."""
    return F.trunc(_c(d).cast("date"), "month")


def weekday_index(d) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(_c(d)) - 1


def weekday_index_monday_first(d) -> Column:
    """0 = Monday ... 6 = Sunday."""
    return F.weekday(_c(d))


def weekday_name(d) -> Column:
    return F.date_format(_c(d), "EEEE")


def month_number(d) -> Column:
    return F.month(_c(d))


def month_name(d) -> Column:
    return F.date_format(_c(d), "MMMM")


def quarter_label(d) -> Column:
    """'Q1'..'Q4' from the month; a NULL date falls through to 'Q4'."""
    m = F.month(_c(d))
    return F.concat(
        F.lit("Q"),
        F.when(m.isin(1, 2, 3), F.lit("1"))
        .when(m.isin(4, 5, 6), F.lit("2"))
        .when(m.isin(7, 8, 9), F.lit("3"))
        .otherwise(F.lit("4")),
    )


def ts_literal(value: dt.datetime | dt.date) -> Column:
    """A TIMESTAMP_NTZ literal (a Python datetime would become a zoned TIMESTAMP)."""
    if not isinstance(value, dt.datetime):
        value = dt.datetime.combine(value, dt.time())
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def micros_between(start, end) -> Column:
    """Microseconds from ``start`` to ``end``; DATE and TIMESTAMP_NTZ inputs
    are compared as wall-clock times (no session time zone involved)."""
    return F.timestamp_diff(
        "MICROSECOND", _c(start).cast("timestamp_ntz"), _c(end).cast("timestamp_ntz")
    )


def days_since(d, as_of: dt.datetime) -> Column:
    """Fractional days from ``d`` to ``as_of`` (30.5, not 30)."""
    return micros_between(d, ts_literal(as_of)) / F.lit(float(MICROS_PER_DAY))


def hours_since(d, as_of: dt.datetime) -> Column:
    return micros_between(d, ts_literal(as_of)) / F.lit(float(MICROS_PER_HOUR))


def window_start(as_of: dt.datetime, days: int) -> dt.date:
    """Calendar date ``days`` before ``as_of`` (SQLite ``date(now, -N days)``)."""
    return as_of.date() - dt.timedelta(days=days)


def on_or_after(d, start: dt.date) -> Column:
    """``d >= start`` with ``d`` a DATE or TIMESTAMP_NTZ column (no upper bound)."""
    return _c(d) >= F.lit(start)


def on_day(d, day: dt.date) -> Column:
    """``DATE(d) = day`` written as a half-open range so it pushes down."""
    return (_c(d) >= ts_literal(day)) & (_c(d) < ts_literal(day + dt.timedelta(days=1)))


def parse_iso_date(text) -> Column:
    """'%Y-%m-%d' parse; anything else (e.g. a trailing time) gives NULL."""
    return F.try_to_date(_c(text), "yyyy-MM-dd")
