"""Micro-fixtures for the semantic hazards and boundaries (FIXTURES.md section 4)."""
import datetime as dt
from decimal import Decimal

import pytest

from fixtures import order, orders_df, product, products_df, sale, sales_df
from ledgerlens.functions import numeric as N
from ledgerlens.operators import analytics as A
from ledgerlens.operators import quality as K

AS_OF = dt.datetime(2024, 6, 30)


def rows(df):
    return [r.asDict() for r in df.collect()]


# ------------------------------------------------------------------ Q1 growth
def test_gap_month_lag_is_previous_row(spark):
    s = sales_df(spark, [sale(1, 1, "2024-01-10", amount="100"), sale(1, 1, "2024-03-10", amount="150")])
    out = {r["year_month"]: r for r in rows(A.revenue_growth(s))}
    assert out["2024-03"]["prev_month_revenue"] == 100.0
    assert out["2024-03"]["mom_growth_rate"] == 50.0
    assert out["2024-01"]["mom_growth_rate"] == 0.0


def test_zero_previous_revenue_gives_null_growth(spark):
    s = sales_df(spark, [sale(1, 1, "2024-01-10", amount="0"), sale(1, 1, "2024-02-10", amount="100")])
    out = {r["year_month"]: r for r in rows(A.revenue_growth(s))}
    assert out["2024-02"]["mom_growth_rate"] is None


def test_single_month_growth_zero(spark):
    out = rows(A.revenue_growth(sales_df(spark, [sale(1, 1, "2024-01-10")])))
    assert len(out) == 1
    assert out[0]["mom_growth_rate"] == 0.0 and out[0]["yoy_growth_rate"] == 0.0
    assert out[0]["year"] == "2024" and out[0]["month"] == "01"


def test_lag_twelve_counts_rows(spark):
    s = sales_df(spark, [sale(1, 1, dt.date(2023, m, 1), amount=str(m)) for m in range(1, 13)]
                 + [sale(1, 1, "2024-02-01", amount="26")])  # January 2024 missing
    out = {r["year_month"]: r for r in rows(A.revenue_growth(s))}
    assert out["2024-02"]["prev_year_revenue"] == 1.0  # 12 rows back is 2023-01
    assert out["2024-02"]["yoy_growth_rate"] == 2500.0


def test_calendar_variant_uses_calendar_months(spark):
    s = sales_df(spark, [sale(1, 1, dt.date(2023, m, 1), amount=str(m)) for m in range(1, 13)]
                 + [sale(1, 1, "2024-02-01", amount="26")])  # January 2024 missing
    out = {r["year_month"]: r for r in rows(A.revenue_growth_calendar(s))}
    assert out["2024-02"]["prev_year_revenue"] == 2.0  # 2023-02
    assert out["2024-02"]["prev_month_revenue"] is None  # 2024-01 had no sales
    assert out["2024-02"]["mom_growth_rate"] == 0.0
    assert out["2023-05"]["prev_month_revenue"] == 4.0


# ------------------------------------------------------------------ Q8 seasonal
def test_null_date_lands_in_q4_and_null_rows(spark):
    s = sales_df(spark, [sale(1, 1, None, amount="5"), sale(1, 1, "2024-03-05", amount="7")])
    out = rows(A.seasonal_analysis(s))
    q = {r["period_value"]: r["total_revenue"] for r in out if r["period_type"] == "Quarter"}
    assert q == {"Q4": 5.0, "Q1": 7.0}
    dow = {r["period_value"]: r["total_revenue"] for r in out if r["period_type"] == "Day of Week"}
    assert dow == {None: 5.0, "Tuesday": 7.0}
    mon = {r["period_value"]: r["total_revenue"] for r in out if r["period_type"] == "Month"}
    assert mon == {None: 5.0, "March": 7.0}


def test_seasonal_sets_each_sum_to_total(spark, sf_dir):
    import __spark_entry__ as E

    out = rows(E.queries()["seasonal_analysis"](spark, sf_dir))
    totals = {}
    for r in out:
        totals[r["period_type"]] = totals.get(r["period_type"], 0) + r["transaction_count"]
    assert len(set(totals.values())) == 1 and len(totals) == 3


# ------------------------------------------------------------------ Q3 / Q4 joins
def test_orphan_product_is_absent(spark):
    s = sales_df(spark, [sale(1, 1, "2024-01-01", amount="10"), sale(1, 99, "2024-01-01", amount="1000")])
    p = products_df(spark, [product(1)])
    top = rows(A.product_performance(s, p))
    assert [r["product_name"] for r in top] == ["p1"]
    assert all(r["category"] == "cat" for r in rows(A.category_trends(s, p)))


def test_top_k_ties_broken_by_product_id(spark):
    s = sales_df(spark, [sale(1, pid, "2024-01-01", amount="10") for pid in (5, 3, 4)])
    p = products_df(spark, [product(pid) for pid in (3, 4, 5)])
    top = rows(A.product_performance(s, p, k=2))
    assert [r["product_name"] for r in top] == ["p3", "p4"]


def test_estimated_profit_rounds_half_up_exactly(spark):
    # 10.0050 * 50 / 100 = 5.0025 -> 5.00 ; 0.0150 * 10 / 100 = 0.0015 -> 0.00
    s = sales_df(spark, [sale(1, 1, "2024-01-01", amount="10.0050")])
    p = products_df(spark, [product(1, margin=50.0)])
    assert rows(A.product_performance(s, p))[0]["estimated_profit"] == 5.0
    s = sales_df(spark, [sale(1, 1, "2024-01-01", amount="0.0100")])
    p = products_df(spark, [product(1, margin=50.0)])  # 0.005 -> 0.01
    assert rows(A.product_performance(s, p))[0]["estimated_profit"] == 0.01


# ------------------------------------------------------------------ Q2 / Q5 customers
def test_half_days_are_kept(spark):
    o = orders_df(spark, [order(1, AS_OF - dt.timedelta(days=30, hours=12))])
    churn = rows(A.customer_churn(o, AS_OF))
    assert churn[0]["customer_status"] == "At Risk"
    rfm = rows(A.rfm_segments(o, AS_OF))
    assert rfm[0]["avg_days_since_last_purchase"] == 31.0  # 30.5 rounds half up


@pytest.mark.parametrize(
    "days,status", [(30, "Active"), (31, "At Risk"), (90, "At Risk"), (91, "Churned")]
)
def test_churn_boundaries(spark, days, status):
    o = orders_df(spark, [order(1, AS_OF - dt.timedelta(days=days))])
    assert rows(A.customer_churn(o, AS_OF))[0]["customer_status"] == status


def test_churn_share_sums_to_100(spark, sf_dir):
    import __spark_entry__ as E

    out = rows(E.queries()["customer_churn"](spark, sf_dir))
    assert abs(sum(r["percentage"] for r in out) - 100) < 0.02


def _segment(r, f, m):
    if r >= 4 and f >= 4 and m >= 4:
        return "Champions"
    if r >= 3 and f >= 3 and m >= 3:
        return "Loyal Customers"
    if r >= 4 and f <= 2:
        return "New Customers"
    if r <= 2 and f >= 3 and m >= 3:
        return "At Risk"
    if r <= 2 and f <= 2:
        return "Lost Customers"
    return "Potential Loyalists"


def test_rfm_all_125_score_combinations(spark):
    from ledgerlens.operators.bases import rfm_scored

    days = {5: 10.0, 4: 45.0, 3: 75.0, 2: 120.0, 1: 400.0}
    freq = {5: 25, 4: 17, 3: 12, 2: 7, 1: 1}
    money = {5: "6000", 4: "3000", 3: "1500", 2: "700", 1: "100"}
    data, expected = [], {}
    i = 0
    for r in range(1, 6):
        for f in range(1, 6):
            for m in range(1, 6):
                data.append((i, days[r], freq[f], Decimal(money[m])))
                expected[i] = (r, f, m, _segment(r, f, m))
                i += 1
    base = spark.createDataFrame(
        data, "customer_id BIGINT, days_since DOUBLE, total_transactions BIGINT, total_spent DECIMAL(18,2)"
    )
    got = {
        x["customer_id"]: (x["recency_score"], x["frequency_score"], x["monetary_score"], x["customer_segment"])
        for x in rfm_scored(base).collect()
    }
    assert got == expected


@pytest.mark.parametrize(
    "value,score_col,expected",
    [(30.0, "recency_score", 5), (30.5, "recency_score", 4), (180.0, "recency_score", 2),
     (180.1, "recency_score", 1)],
)
def test_recency_boundaries(spark, value, score_col, expected):
    from ledgerlens.operators.bases import rfm_scored

    base = spark.createDataFrame([(1, value, 1, Decimal("1"))],
                                 "customer_id BIGINT, days_since DOUBLE, total_transactions BIGINT, total_spent DECIMAL(18,2)")
    assert rfm_scored(base).collect()[0][score_col] == expected


@pytest.mark.parametrize("n,score", [(4, 1), (5, 2), (9, 2), (10, 3), (15, 4), (19, 4), (20, 5)])
def test_frequency_boundaries(spark, n, score):
    from ledgerlens.operators.bases import rfm_scored

    base = spark.createDataFrame([(1, 1.0, n, Decimal("1"))],
                                 "customer_id BIGINT, days_since DOUBLE, total_transactions BIGINT, total_spent DECIMAL(18,2)")
    assert rfm_scored(base).collect()[0]["frequency_score"] == score


@pytest.mark.parametrize("amt,score", [("499.99", 1), ("500", 2), ("999.99", 2), ("1000", 3),
                                       ("2000", 4), ("4999.99", 4), ("5000", 5)])
def test_monetary_boundaries(spark, amt, score):
    from ledgerlens.operators.bases import rfm_scored

    base = spark.createDataFrame([(1, 1.0, 1, Decimal(amt))],
                                 "customer_id BIGINT, days_since DOUBLE, total_transactions BIGINT, total_spent DECIMAL(18,2)")
    assert rfm_scored(base).collect()[0]["monetary_score"] == score


# ------------------------------------------------------------------ Q9 inventory
def test_inventory_cases(spark):
    recent = "2024-06-20"
    s = sales_df(spark, [
        sale(1, 1, recent, qty=5), sale(1, 1, recent, qty=5),      # avg 5, stock 68 -> 13.6
        sale(1, 3, recent, qty=1),                                   # avg 1, stock NULL
        sale(1, 4, "2023-01-01", qty=9),                             # old sale only
        sale(1, 5, recent, qty=2),                                   # avg 2, stock 28 -> 14.0
    ])
    p = products_df(spark, [product(1, stock=68), product(2, stock=5), product(3, stock=None),
                            product(4, stock=50), product(5, stock=28), product(6, stock=7, active=0)])
    out = {r["product_id"]: r for r in rows(A.inventory_insights(s, p, AS_OF))}
    assert 6 not in out  # inactive
    assert out[1]["days_of_inventory"] == 14.0
    assert out[1]["reorder_recommendation"] == "Reorder Required"  # unrounded 13.6 < 14
    assert out[5]["days_of_inventory"] == 14.0 and out[5]["reorder_recommendation"] == "OK"
    assert out[2]["days_of_inventory"] == 999.0 and out[2]["reorder_recommendation"] == "OK"
    assert out[2]["stock_status"] == "Critical"
    assert out[4]["units_sold_last_30_days"] == 0.0 and out[4]["stock_status"] == "Low"
    assert out[3]["stock_status"] == "High"  # NULL stock falls through


@pytest.mark.parametrize("stock,status", [(10, "Critical"), (11, "Low"), (50, "Low"), (51, "Medium"),
                                          (100, "Medium"), (101, "High")])
def test_stock_bands(spark, stock, status):
    s = sales_df(spark, [sale(1, 1, "2024-06-29")])
    p = products_df(spark, [product(1, stock=stock)])
    assert rows(A.inventory_insights(s, p, AS_OF))[0]["stock_status"] == status


# ------------------------------------------------------------------ Q10 summary
def test_empty_recent_window(spark):
    s = sales_df(spark, [sale(1, 1, "2020-01-01", amount="12.5")])
    p = products_df(spark, [product(1)])
    out = {r["metric"]: r for r in rows(A.executive_summary(s, p, AS_OF))}
    assert out["Total Revenue"]["current_value"] == "$12.50"
    assert out["Total Revenue"]["last_30_days"] == "$0.00"
    assert out["Total Customers"]["last_30_days"] == "0"
    assert out["Average Order Value"]["last_30_days"] == "$0.00"
    assert out["Total Revenue"]["growth_rate"] is None


def test_future_dated_sale_counts_as_recent(spark):
    s = sales_df(spark, [sale(1, 1, "2024-08-01", amount="3")])
    p = products_df(spark, [product(1)])
    out = {r["metric"]: r for r in rows(A.executive_summary(s, p, AS_OF))}
    assert out["Total Revenue"]["last_30_days"] == "$3.00"


def test_empty_tables(spark):
    s = sales_df(spark, [])
    p = products_df(spark, [])
    assert len(rows(A.executive_summary(s, p, AS_OF))) == 4
    checks = {r["check_name"]: r for r in rows(K.quality_checks(orders_df(spark, []), AS_OF))}
    assert checks["daily_volume"]["passed"] is False
    assert checks["amount_outlier"]["passed"] is True
    assert checks["freshness"]["passed"] is True and checks["freshness"]["observed"] is None


def test_average_order_value_text_rounds_half_up(spark):
    s = sales_df(spark, [sale(1, 1, "2024-06-29", amount="0.0100"), sale(2, 1, "2024-06-29", amount="0.0000")])
    p = products_df(spark, [product(1)])
    out = {r["metric"]: r for r in rows(A.executive_summary(s, p, AS_OF))}
    assert out["Average Order Value"]["current_value"] == "$0.01"  # 0.005 -> 0.01


# ------------------------------------------------------------------ numeric helpers
def test_round_ratio_half_up_and_zero_denominator(spark):
    df = spark.createDataFrame([(1, 8), (1, 0), (5, 2), (1, 3)], "n BIGINT, d BIGINT")
    got = [r[0] for r in df.select(N.round_ratio("n", "d", 2).cast("double")).collect()]
    assert got == [0.13, None, 2.5, 0.33]


def test_round_ratio_negative_rounds_half_away_from_zero(spark, duck_con):
    from ledgerlens.plans import oracle as O

    df = spark.createDataFrame([(-1, 8), (-5, 2), (-1, 3), (0, 7)], "n BIGINT, d BIGINT")
    got = [r[0] for r in df.select(N.round_ratio("n", "d", 2).cast("double")).collect()]
    assert got == [-0.13, -2.5, -0.33, 0.0]
    sql = "SELECT CAST(" + O.round_ratio("n", "d", 2) + " AS DOUBLE) FROM (VALUES (-1, 8), (-5, 2), (-1, 3), (0, 7)) t(n, d)"
    assert [r[0] for r in duck_con.execute(sql).fetchall()] == got


def test_money_text_and_division_by_zero(spark):
    df = spark.createDataFrame([(None,), (Decimal("0.125"),)], "x DECIMAL(10,3)")
    assert [r[0] for r in df.select(N.money_text("x")).collect()] == ["$0.00", "$0.13"]
    df = spark.createDataFrame([(1.0, 0.0)], "a DOUBLE, b DOUBLE")
    assert df.select(N.pct_change("a", "b")).collect()[0][0] is None


# ------------------------------------------------------------------ quality checks
@pytest.mark.parametrize("n,passed", [(99, False), (100, True), (101, True)])
def test_daily_volume_threshold(spark, n, passed):
    o = orders_df(spark, [order(i, AS_OF, "1") for i in range(n)])
    checks = {r["check_name"]: r for r in rows(K.quality_checks(o, AS_OF))}
    assert checks["daily_volume"]["passed"] is passed
    if not passed:
        assert checks["daily_volume"]["message"] == f"Low transaction count today: {n} (expected: >100)"


@pytest.mark.parametrize("amt,passed", [("9999.99", True), ("10000", True), ("10000.01", False)])
def test_amount_outlier_threshold(spark, amt, passed):
    o = orders_df(spark, [order(1, AS_OF, amt), order(2, AS_OF - dt.timedelta(days=3), "99999")])
    checks = {r["check_name"]: r for r in rows(K.quality_checks(o, AS_OF))}
    assert checks["amount_outlier"]["passed"] is passed
    if not passed:
        assert checks["amount_outlier"]["message"] == "Unusually high transaction detected: $10,000.01"


@pytest.mark.parametrize("hours,passed", [(24, True), (25, False)])
def test_freshness_threshold(spark, hours, passed):
    o = orders_df(spark, [order(1, dt.datetime(2024, 6, 29, 18))])
    checks = {r["check_name"]: r for r in rows(K.quality_checks(o, dt.datetime(2024, 6, 29) + dt.timedelta(hours=hours)))}
    assert checks["freshness"]["observed"] == float(hours)  # from midnight of the latest date
    assert checks["freshness"]["passed"] is passed
    if not passed:
        assert checks["freshness"]["message"] == "Data is stale: 25.0 hours old (threshold: 24h)"


# ------------------------------------------------------------------ cross-query properties
def test_category_and_region_rollups_sum_to_monthly(spark, sf_dir):
    import __spark_entry__ as E

    q = E.queries()
    monthly = {r["year_month"]: (r["transaction_count"], r["revenue"]) for r in rows(q["revenue_growth"](spark, sf_dir))}
    for key, month_col, rev_col, n_col in (
        ("category_trends", "month", "monthly_revenue", None),
        ("regional_growth", "month", "revenue", "transactions"),
    ):
        sums = {}
        for r in rows(q[key](spark, sf_dir)):
            n, rev = sums.get(r[month_col], (0, 0.0))
            sums[r[month_col]] = (n + (r[n_col] if n_col else 0), rev + r[rev_col])
        assert sums.keys() == monthly.keys()
        for m, (n, rev) in sums.items():
            assert abs(rev - monthly[m][1]) < 1e-6 * max(1.0, monthly[m][1])
            if n_col:
                assert n == monthly[m][0]


def test_regional_shares_sum_to_100(spark, sf_dir):
    import __spark_entry__ as E

    out = rows(E.queries()["regional_share"](spark, sf_dir))
    assert abs(sum(r["share_pct"] for r in out) - 100) < 0.05
    assert len({r["grand_total"] for r in out}) == 1


def test_heatmap_is_a_full_grid(spark):
    from ledgerlens.operators import dashboard as DB

    ev = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 3, 14, 5), 1, "purchase", 2.5, "{}"),
         (2, dt.datetime(2024, 1, 3, 14, 50), 1, "purchase", 2.5, "{}"),
         (3, dt.datetime(2024, 1, 7, 9, 0), 1, "purchase", 1.0, "{}"),
         (4, dt.datetime(2024, 1, 7, 9, 0), 1, "view", 99.0, "{}")],
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    )
    out = rows(DB.day_hour_heatmap(ev))
    assert len(out) == 168
    busy = {(r["day_name"], r["hour"]): (r["events"], r["intensity_pct"]) for r in out if r["events"]}
    assert busy == {("Wednesday", 14): (2, 100.0), ("Sunday", 9): (1, 20.0)}
    assert out[0]["day_name"] == "Monday" and out[0]["intensity_pct"] == 0.0


def test_daily_revenue_window(spark):
    from ledgerlens.operators import dashboard as DB

    s = sales_df(spark, [sale(1, 1, "2024-05-30", amount="1"), sale(1, 1, "2024-05-31", amount="2"),
                         sale(1, 1, "2024-06-30", amount="3")])
    assert len(rows(DB.daily_revenue(s))) == 3
    assert [r["revenue"] for r in rows(DB.daily_revenue(s, AS_OF, 30))] == [2.0, 3.0]


def test_days_since_is_time_zone_free_for_dates(spark):
    from ledgerlens.functions import dates as Dt

    df = spark.createDataFrame([(dt.date(2024, 6, 20),)], "d DATE")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "Asia/Tokyo", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            assert df.select(Dt.days_since("d", AS_OF)).first()[0] == 10.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
