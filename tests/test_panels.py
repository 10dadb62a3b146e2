"""Panels from base tables equal those from the rows, and read no fact."""
import datetime as dt
import random
from decimal import Decimal

import pytest

from ledgerlens.jobs import dashboard_frames, write_rollup
from ledgerlens.operators import analytics as A
from ledgerlens.operators import dashboard as DB
from ledgerlens.operators import panels as P
from ledgerlens.session import shared_dir
from ledgerlens.sources.retail import RetailSource
from ledgerlens.sources.warehouse import materialize

SALES = "customer_id BIGINT, product_id BIGINT, transaction_date DATE, quantity DOUBLE, total_amount DECIMAL(29,12)"
ORDERS = "customer_id BIGINT, transaction_date TIMESTAMP_NTZ, total_amount DECIMAL(20,6)"
PRODUCTS = "product_id BIGINT, product_name STRING, category STRING, brand STRING, profit_margin DOUBLE, stock_quantity BIGINT, is_active INT"
AS_OF = dt.datetime(2024, 12, 1, 13)


def rows_with_gaps(n, seed):
    """Sales with nulls in every column; a third of all belongs to one customer and one product."""
    r = random.Random(seed)
    gap = lambda v: None if r.random() < 0.08 else v
    hot = lambda top: 1 if r.random() < 1 / 3 else r.randrange(top)
    day = lambda: dt.date(2024, 1, 1) + dt.timedelta(r.randrange(366))
    sales = [(gap(hot(25)), gap(hot(12)), gap(day()), gap(float(r.randrange(1, 9))), gap(Decimal(r.randrange(10**15)).scaleb(-12))) for _ in range(n)]
    orders = [(c, d and dt.datetime.combine(d, dt.time(r.randrange(24))), m and m.quantize(Decimal("0.000001"))) for c, _, d, _, m in sales[: n // 2]]
    return sales, orders


def as_rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("n", [0, 600])
def test_every_operator_takes_a_base_for_the_rows(spark, n):
    lines, heads = rows_with_gaps(n, 11)
    sales, orders = spark.createDataFrame(lines, SALES), spark.createDataFrame(heads, ORDERS)
    products = spark.createDataFrame([(i, f"p{i}", f"c{i % 3}", "b", 10.0 + i, 40 * i, i % 4 and 1) for i in range(10)], PRODUCTS)
    regions = spark.createDataFrame([(i, f"r{i % 3}") for i in range(20)], "customer_id BIGINT, region STRING")
    bases = P.write_bases(sales, orders, shared_dir(spark, "t-bases"))
    want = {
        "revenue_growth": A.revenue_growth(sales),
        "regional_growth": A.regional_growth(sales, regions),
        "executive_summary": A.executive_summary(sales, products, AS_OF),
        "monthly_revenue_12m": DB.monthly_revenue_12m(sales, AS_OF),
        "product_performance": A.product_performance(sales, products),
        "inventory_insights": A.inventory_insights(sales, products, AS_OF),
        "customer_churn": A.customer_churn(orders, AS_OF),
        "rfm_segments": A.rfm_segments(orders, AS_OF),
        "kpi_cards": DB.kpi_cards(orders, AS_OF),
        "kpi_by_range": DB.kpi_by_range(orders, AS_OF),
    }
    got = P.base_panels(bases, sales, products, regions, AS_OF)
    assert got.keys() == want.keys()
    for name, df in want.items():
        assert as_rows(got[name]) == as_rows(df), name
        assert got[name].dtypes == df.dtypes, name
    report = P.base_report(bases, products, AS_OF)
    for name, df in DB.kpi_report(sales, orders, products, AS_OF).items():
        assert as_rows(report[name]) == as_rows(df), name
    assert as_rows(DB.daily_revenue(bases.customer_days)) == as_rows(DB.daily_revenue(sales))


def test_the_sales_are_read_once_for_the_bases(spark, sf_dir):
    src = RetailSource(spark, sf_dir)
    assert P.sales_bases(src.sales())._jdf.queryExecution().optimizedPlan().toString().count("Relation [l_orderkey") == 1


def test_panels_of_the_job_read_bases(spark, sf_dir):
    out = shared_dir(spark, "t-job-bases")
    src = materialize(RetailSource(spark, sf_dir), f"{out}/warehouse")
    bases = P.write_bases(src.sales(), src.orders(), f"{out}/daily")
    frames = {**dashboard_frames(src, bases), **write_rollup(src, bases, f"{out}/daily"), **P.base_report(bases, src.products(), src.as_of())}
    facts = {name for name, df in frames.items() if any("/warehouse/sales" in f or "/warehouse/orders" in f for f in df.inputFiles())}
    assert facts == {"product_performance", "category_trends", "sales_rep_performance"}
