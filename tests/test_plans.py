"""Plan-shape checks: one fact scan, pushdown, joins left to AQE."""
import __spark_entry__ as E
from ledgerlens.operators import analytics as A
from ledgerlens.sources.retail import RetailSource


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_seasonal_reads_facts_once(spark, sf_dir):
    df = E.queries()["seasonal_analysis"](spark, sf_dir)
    text = optimized(df)
    assert text.count("Relation [l_orderkey") == 1
    assert "Expand" in text


def test_recent_window_is_pushed_to_the_scan(spark, sf_dir):
    df = E.queries()["inventory_insights"](spark, sf_dir)
    df.explain("formatted")
    plan = plan_of(df)
    assert "GreaterThanOrEqual(o_orderdate" in plan


def test_projection_is_pruned(spark, sf_dir):
    plan = plan_of(E.queries()["revenue_growth"](spark, sf_dir))
    assert "l_tax" not in plan and "l_comment" not in plan and "o_orderpriority" not in plan


def _without_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    return old


def test_without_broadcasts_the_facts_join_by_sort_merge(spark, sf_dir):
    old = _without_broadcast(spark)
    try:
        src = RetailSource(spark, sf_dir)
        df = A.category_trends(src.sales(region=True), src.products())
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "SortMergeJoin [l_orderkey" in final  # fact x fact on the order key
        assert "SortMergeJoin [product_id" in final  # fact x products
        # the only broadcasts left are the fixed-size nation / region tables
        assert final.count("BroadcastHashJoin") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_builders_start_no_job_but_the_as_of_scalar(spark, sf_dir):
    tracker = spark.sparkContext.statusTracker()
    for key, jobs in (("revenue_growth", 0), ("category_trends", 0), ("product_performance", 0), ("regional_growth", 0)):
        before = set(tracker.getJobIdsForGroup(None))
        E.queries()[key](spark, sf_dir)
        assert len(set(tracker.getJobIdsForGroup(None)) - before) == jobs, key


def test_a_grown_dimension_is_not_broadcast(spark, tmp_path):
    path = str(tmp_path / "dim")
    facts = spark.range(1000).selectExpr("id % 50 AS k")

    def final_plan():
        df = facts.join(spark.read.parquet(path), "k").groupBy("k").count()
        df.collect()
        return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "50k")
    try:
        spark.range(50).selectExpr("id AS k", "uuid() AS pad").write.parquet(path)
        assert "BuildRight" in final_plan()
        spark.range(100_000).selectExpr("id AS k", "uuid() AS pad").write.mode("overwrite").parquet(path)
        assert "BuildRight" not in final_plan()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_no_expand_on_raw_facts(spark, sf_dir):
    for key in ("executive_summary", "sales_rep_performance", "product_performance", "regional_growth"):
        assert "Expand" not in plan_of(E.queries()[key](spark, sf_dir)), key


def test_warehouse_reads_only_the_months_of_the_window(spark, sf_dir):
    import datetime as dt

    from ledgerlens.session import shared_dir
    from ledgerlens.sources.warehouse import materialize

    wh = materialize(RetailSource(spark, sf_dir), shared_dir(spark, "t-pruned"))
    plan = plan_of(wh.sales(since=dt.date(2001, 6, 1)))
    assert "PartitionFilters: [isnotnull(year_month" in plan and ">= 2001-06" in plan


def test_global_windows_only_after_aggregation(spark, sf_dir):
    # the un-partitioned LAG window sits above the monthly aggregate
    text = optimized(E.queries()["revenue_growth"](spark, sf_dir))
    window_at = text.index("Window")
    agg_at = text.index("Aggregate")
    assert window_at < agg_at  # printed top-down: window is above the aggregate


def test_bucketed_facts_join_without_shuffle(spark, sf_dir):
    from ledgerlens.session import shared_dir
    from ledgerlens.sources.bucketed import BucketedSource, write_bucketed

    root = shared_dir(spark, "t-bucketed")
    write_bucketed(RetailSource(spark, sf_dir), root, buckets=8, prefix="t_bk")
    old = _without_broadcast(spark)
    raw = RetailSource(spark, sf_dir)
    bucketed = BucketedSource(spark, sf_dir, prefix="t_bk")
    a, b = A.revenue_growth(raw.sales()), A.revenue_growth(bucketed.sales())
    assert sorted(a.collect()) == sorted(b.collect())
    plan = b._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    join_at = plan.index("SortMergeJoin")
    below = plan[join_at:]
    assert "SortMergeJoin [l_orderkey" in plan
    # no hash exchange on the order key under the join: both sides are bucketed
    assert "hashpartitioning(l_orderkey" not in below and "hashpartitioning(o_orderkey" not in below
    # a new session re-registers the same folders and keeps the bucket layout
    from ledgerlens.sources.bucketed import register_bucketed

    register_bucketed(spark, root.replace("file:", ""), buckets=8, prefix="t_bk2")
    again = A.revenue_growth(BucketedSource(spark, sf_dir, prefix="t_bk2").sales())
    assert sorted(again.collect()) == sorted(a.collect())
    plan2 = again._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "hashpartitioning(l_orderkey" not in plan2
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
