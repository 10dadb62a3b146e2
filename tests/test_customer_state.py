"""Customer state merged delta by delta, exact distinct counts, theta estimates."""
import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerlens.functions import dates as D
from ledgerlens.operators import analytics as A
from ledgerlens.operators import dashboard as DB
from ledgerlens.operators import rollups as R
from ledgerlens.session import shared_dir
from ledgerlens.sources.customer_state import CustomerState

SCHEMA = "customer_id BIGINT, transaction_date TIMESTAMP_NTZ, total_amount DECIMAL(20,6)"


def random_orders(n, seed):
    r = random.Random(seed)
    day = lambda: dt.datetime(2024, 1, 1) + dt.timedelta(hours=12 * r.randint(0, 400))
    return [(r.choice([None, 7, 7, 7, *range(30)]), r.choice([None, day(), day(), day()]), r.choice([None, Decimal(r.randint(1, 10**9)).scaleb(-6), Decimal(r.randint(1, 900))])) for _ in range(n)]


def test_state_after_deltas_equals_the_batch_for_any_instant(spark):
    state, rows = CustomerState(spark, shared_dir(spark, "t-state"), buckets=8), []
    for number in range(3):
        delta = random_orders(150, number)
        rows += delta
        assert state.merge(spark.createDataFrame(delta, SCHEMA), f"day-{number}")
        assert state.merge(spark.createDataFrame(delta, SCHEMA), f"day-{number}") == []  # counts once
    again = CustomerState(spark, state.root)
    orders, held = spark.createDataFrame(rows, SCHEMA).cache(), again.read().cache()
    for as_of in (dt.datetime(2024, 3, 1, 7), dt.datetime(2024, 7, 20)):
        for op in (A.customer_churn, A.rfm_segments, DB.kpi_customer_segments, DB.kpi_cards, DB.kpi_by_range):
            assert sorted(map(str, op(held, as_of).collect())) == sorted(map(str, op(orders, as_of).collect())), op.__name__


def test_a_merge_touches_its_buckets_only(spark):
    state = CustomerState(spark, shared_dir(spark, "t-state-b"), buckets=16)
    day = dt.datetime(2024, 1, 1)
    state.merge(spark.createDataFrame([(i, day, Decimal(1)) for i in range(200)], SCHEMA), "a")
    before = dict(state.state["folders"])
    [bucket] = state.merge(spark.createDataFrame([(5, day, Decimal(2))], SCHEMA), "b")
    assert {b for b, f in state.state["folders"].items() if f != before[b]} == {str(bucket)}
    assert state.read().filter("customer_id = 5").first()["total_amount"] == 3 and state.read().count() == 200
    assert state.merge(spark.createDataFrame([], SCHEMA), "c") == []


def test_bitmaps_count_as_distinct_does(spark):
    r = random.Random(6)
    rows = [(r.choice([None, 1, r.randint(0, 90_000), -r.randint(0, 50)]), dt.date(2024, 1, 1) + dt.timedelta(days=r.randint(0, 90)), r.choice("ab")) for _ in range(3000)]
    sales = spark.createDataFrame(rows, "customer_id BIGINT, transaction_date DATE, region STRING")
    exact = sales.groupBy(D.year_month("transaction_date").alias("year_month")).agg(F.countDistinct("customer_id").alias("n"))
    got = {x["year_month"]: x["unique_customers"] for x in R.monthly_customers(R.daily_bitmaps(sales)).collect()}
    assert got == {x["year_month"]: x["n"] for x in exact.collect()}
    by_region = R.distinct_customers(R.daily_bitmaps(sales, "region"), region=F.col("region"))
    assert {tuple(x) for x in by_region.collect()} == {tuple(x) for x in sales.groupBy("region").agg(F.countDistinct("customer_id")).collect()}
    assert R.monthly_customers(R.daily_bitmaps(sales.limit(0))).count() == 0


def test_theta_estimates_are_close(spark):
    early, late = dt.date(2024, 1, 5), dt.date(2024, 2, 5)
    sales = spark.range(60_000).select(F.col("id").alias("customer_id"), F.lit(early).alias("transaction_date"))
    sales = sales.union(spark.range(40_000, 90_000).select("id", F.lit(late)))
    thetas = R.daily_thetas(sales)
    got = R.returning_customers(thetas, F.col("transaction_date") == early, F.col("transaction_date") == late).first()
    for name, want in {"previous": 60_000, "current": 50_000, "returning": 20_000, "lost": 40_000, "new": 30_000}.items():
        assert abs(got[name] - want) < 0.04 * 90_000 ** 0.5 * want ** 0.5, name  # four standard errors of a 2^14 sketch, by the set it is cut from
    none = R.returning_customers(thetas, F.lit(False), F.lit(False)).first()
    assert set(none) == {0}
