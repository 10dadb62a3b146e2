"""The daily rollup serves D1, D4 and Q8 exactly and monthly uniques closely."""
from ledgerlens.operators import analytics as A
from ledgerlens.operators import dashboard as DB
from ledgerlens.operators import rollups as R
from ledgerlens.sources.retail import RetailSource


def test_rollup_serves_panels(spark, sf_dir):
    src = RetailSource(spark, sf_dir)
    sales = src.sales(region=True)
    rollup = R.daily_rollup(sales).cache()
    try:
        assert sorted(R.daily_revenue_from_rollup(rollup).collect()) == sorted(
            DB.daily_revenue(sales).collect())
        assert sorted(R.regional_share_from_rollup(rollup).collect()) == sorted(
            DB.regional_share(sales, src.regions()).collect())
        assert sorted(R.seasonal_from_rollup(rollup).collect(), key=str) == sorted(
            A.seasonal_analysis(sales).collect(), key=str)
        exact = {r["year_month"]: r for r in A.revenue_growth(sales).collect()}
        est = {r["year_month"]: r for r in R.monthly_from_rollup(rollup).collect()}
        assert exact.keys() == est.keys()
        for m, r in est.items():
            assert r["revenue"] == exact[m]["revenue"]
            assert r["transaction_count"] == exact[m]["transaction_count"]
            u = exact[m]["unique_customers"]
            assert abs(r["unique_customers_estimate"] - u) <= max(2, 0.06 * u)
    finally:
        rollup.unpersist()
