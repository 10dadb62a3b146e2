"""DuckDB twins of the registered queries (the differential-test oracle).

Each statement runs on the raw tables (``orders``, ``lineitem`` ... as
views) and rebuilds the retail views with CTEs identical in meaning to
``ledgerlens.sources.retail``.  ``as_of`` is the latest order timestamp on
both sides.  Rounded ratios use the same exact half-up integer division as
``ledgerlens.functions.numeric.round_ratio``.
"""

from __future__ import annotations

VIEWS = """
products AS (
    SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
           p_brand AS brand, CAST(10 + p_partkey % 31 AS DOUBLE) AS profit_margin,
           (p_partkey * 37) % 601 AS stock_quantity,
           CASE WHEN p_partkey % 10 = 0 THEN 0 ELSE 1 END AS is_active
    FROM part
),
cust_region AS (
    SELECT c.c_custkey, r.r_name AS region
    FROM customer c
    LEFT JOIN (SELECT n.n_nationkey, r.r_name FROM nation n
               JOIN region r ON n.n_regionkey = r.r_regionkey) r
      ON c.c_nationkey = r.n_nationkey
),
sales_transactions AS (
    SELECT o.o_custkey AS customer_id, l.l_partkey AS product_id,
           CAST(o.o_orderdate AS DATE) AS transaction_date,
           l.l_quantity AS quantity,
           CAST(l.l_extendedprice AS DECIMAL(18,6))
             * (1 - CAST(l.l_discount AS DECIMAL(9,6))) AS total_amount,
           cr.region, s.s_name AS sales_rep
    FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    LEFT JOIN cust_region cr ON o.o_custkey = cr.c_custkey
    LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
),
order_transactions AS (
    SELECT o_custkey AS customer_id, o_orderdate AS transaction_date,
           CAST(o_totalprice AS DECIMAL(20,6)) AS total_amount
    FROM orders
),
as_of AS (SELECT MAX(o_orderdate) AS ts, CAST(MAX(o_orderdate) AS DATE) AS d FROM orders)
"""


def with_views(body: str) -> str:
    return "WITH " + VIEWS.strip() + ",\n" + body.strip()


def round_ratio(num: str, den: str, digits: int, num_scale: int = 0) -> str:
    """SQL twin of numeric.round_ratio -> DECIMAL(38, digits)."""
    n = f"(CAST(CAST(({num}) AS DECIMAL(38,{num_scale})) * {10 ** num_scale} AS HUGEINT) * {10 ** digits})"
    d = f"NULLIF(CAST(CAST(({den}) AS DECIMAL(38,{num_scale})) * {10 ** num_scale} AS HUGEINT), 0)"
    whole = f"(sign({n}) * ((abs({n}) * 2 + {d}) // ({d} * 2)))"
    if digits == 0:
        return f"CAST({whole} AS DECIMAL(38,0))"
    return f"CAST(CAST({whole} AS DECIMAL(32,0)) * CAST(1e-{digits} AS DECIMAL({digits + 1},{digits})) AS DECIMAL(38,{digits}))"


def share_pct(part: str, total: str, digits: int = 2) -> str:
    return f"CAST({round_ratio(f'({part}) * 100', total, digits)} AS DOUBLE)"


def mean(total: str, count: str) -> str:
    return f"(CAST({total} AS DOUBLE) / NULLIF(CAST({count} AS DOUBLE), 0))"


def percent_of(amount: str, percent: str, digits: int = 2) -> str:
    units = f"CAST(({amount}) * 1000000000000 AS HUGEINT)"
    return round_ratio(f"{units} * CAST(({percent}) * 10000 AS HUGEINT)", str(10**18), digits)


def pct_change(cur: str, prev: str) -> str:
    return f"CASE WHEN {prev} IS NOT NULL THEN ({cur} - {prev}) / NULLIF({prev}, 0) * 100.0 ELSE 0.0 END"


def money_text(x: str) -> str:
    return f"'$' || CAST(CAST(COALESCE({x}, 0) AS DECIMAL(38,2)) AS VARCHAR)"


DAYS_SINCE = "(date_diff('microsecond', {col}, (SELECT ts FROM as_of)) / 86400000000.0)"
MICROS_SINCE = "date_diff('microsecond', {col}, (SELECT ts FROM as_of))"
