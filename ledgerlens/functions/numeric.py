"""Exact arithmetic and text formatting helpers.

Money is summed as DECIMAL and only turned into DOUBLE at the output
boundary.  Rounded ratios (averages, shares) use exact half-up integer
division, so they do not depend on floating-point summation order or on how
an engine rounds a binary double.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# Decimals of exact amounts: an order total, and a line's price times (1 -
# discount) with both factors at six decimals.
ORDER_SCALE = 6
LINE_SCALE = 12


def as_double(col) -> Column:
    return _c(col).cast("double")


def mean(total, count) -> Column:
    """sum / count as DOUBLE (NULL for an empty group, never an error)."""
    return F.try_divide(as_double(total), _c(count).cast("double"))


def pct_change(current, previous) -> Column:
    """(current - previous) / previous * 100; 0 when there is no previous
    value, NULL when the previous value is 0."""
    cur, prev = _c(current), _c(previous)
    return (
        F.when(prev.isNotNull(), F.try_divide(cur - prev, prev) * F.lit(100.0))
        .otherwise(F.lit(0.0))
    )


def int_div(a: Column, b: Column) -> Column:
    """Exact integral division of DECIMAL(38,0) operands; a quotient of more
    than 32 digits is an error in ANSI mode, never a wrapped number."""
    return ((a - a % b) / b).cast("decimal(38,0)")


def round_ratio(numerator, denominator, digits: int, numerator_scale: int = 0) -> Column:
    """round(numerator / denominator, digits), half away from zero, exactly.

    ``numerator`` is an exact number with at most ``numerator_scale``
    decimals (an integer count or a DECIMAL sum); ``denominator`` is a
    positive exact number with the same bound on its decimals.  Returns
    DECIMAL(38, digits); NULL when the denominator is 0 or NULL.
    """
    wide = f"decimal(38,{numerator_scale})"  # exact for both operands, no integer overflow
    num = (_c(numerator).cast(wide) * F.lit(10 ** (numerator_scale + digits))).cast("decimal(38,0)")
    den = (_c(denominator).cast(wide) * F.lit(10**numerator_scale)).cast("decimal(38,0)")
    den = F.when(den > 0, den)
    magnitude = int_div(F.abs(num) * 2 + den, den * 2)
    whole = F.when(num < 0, -magnitude).otherwise(magnitude)
    return scale_down(whole, digits)


def scale_down(whole: Column, digits: int) -> Column:
    """An integer count of 10^-digits units as DECIMAL(38, digits)."""
    if digits == 0:
        return whole.cast("decimal(38,0)")
    return (whole.cast("decimal(32,0)") * F.lit(Decimal(1).scaleb(-digits))).cast(
        f"decimal(38,{digits})"
    )


def share_pct(part, total, digits: int = 2, scale: int = 0) -> Column:
    """round_half_up(part * 100 / total, digits) as DOUBLE, exact."""
    return round_ratio(_c(part) * F.lit(100), total, digits, scale).cast("double")


def round_money(col, digits: int = 2) -> Column:
    """HALF_UP rounding of an exact DECIMAL (identical in Spark and DuckDB)."""
    return F.round(_c(col), digits)


def percent_of(amount, percent, digits: int = 2) -> Column:
    """round(amount * percent / 100, digits) of a line-scale amount and a
    percentage with at most four decimals, exactly."""
    units = (_c(amount).cast(f"decimal(38,{LINE_SCALE})") * F.lit(10**LINE_SCALE)).cast("decimal(38,0)")
    rate = (_c(percent).cast("decimal(9,4)") * F.lit(10**4)).cast("decimal(38,0)")
    return round_ratio(units * rate, F.lit(10 ** (LINE_SCALE + 6)), digits)


def percent_of_line(amount, percent) -> Column:
    """round(amount * percent / 100, 2) of one line's amount (fourteen digits
    before the point, else an overflow error) and a percentage with at most
    four decimals, exactly: the product fits 36 digits, so no division is
    needed."""
    cents = F.round(_c(amount).cast(f"decimal(26,{LINE_SCALE})") * _c(percent).cast("decimal(9,4)"), 0)
    return cents.cast("decimal(21,0)") * F.lit(Decimal("0.01"))


def money_text(col) -> Column:
    """'$' + amount with two decimals; NULL reads as $0.00 (printf semantics)."""
    return F.concat(
        F.lit("$"),
        F.coalesce(_c(col), F.lit(0)).cast("decimal(38,2)").cast("string"),
    )


def thousands_text(col, digits: int = 2) -> Column:
    """1234567.5 -> '1,234,567.50'."""
    return F.format_number(F.round(_c(col), digits), digits)
