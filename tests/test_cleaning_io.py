"""Cleaning steps, ratio checks and the landing / load / snapshot sinks."""
import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fixtures import order, orders_df, sale, sales_df
from ledgerlens.operators import analytics as A
from ledgerlens.operators import cleaning as E
from ledgerlens.operators import dashboard as DB
from ledgerlens.operators import quality as K
from ledgerlens.session import shared_dir
from ledgerlens.sources import landing as L
from ledgerlens.sources.retail import RetailSource
from ledgerlens.streaming.landing_stream import ingest_available


def test_dedupe_keeps_first_by_order_deterministically(spark):
    df = spark.createDataFrame(
        [(1, 1, "2024-01-02", "b"), (1, 1, "2024-01-01", "z"), (1, 1, "2024-01-01", "a"), (2, 1, "2024-01-05", "c")],
        "k BIGINT, line INT, d STRING, v STRING",
    )
    out = sorted(tuple(r) for r in E.dedupe_transactions(df, ["k", "line"], ["d"]).collect())
    assert out == [(1, 1, "2024-01-01", "a"), (2, 1, "2024-01-05", "c")]


def test_dedupe_hot_key_stays_correct(spark):
    # one key holds most rows: the per-key min is combined map-side
    rows = [(7, i % 5, f"v{i:05d}") for i in range(5000)] + [(8, 0, "x")]
    df = spark.createDataFrame(rows, "k BIGINT, o INT, v STRING").repartition(8)
    out = {r["k"]: (r["o"], r["v"]) for r in E.dedupe_transactions(df, ["k"], ["o"]).collect()}
    assert out == {7: (0, "v00000"), 8: (0, "x")}


def test_fill_missing_drops_and_fills(spark):
    df = spark.createDataFrame(
        [(1, "a", None), (None, "b", 2.0), (3, None, None)], "id BIGINT, kind STRING, value DOUBLE"
    )
    out = sorted(tuple(r) for r in E.fill_missing(df, {"value": 0.0, "kind": "unknown"}, ["id"]).collect())
    assert out == [(1, "a", 0.0), (3, "unknown", 0.0)]


def test_validate_split_reasons(spark):
    as_of = dt.datetime(2024, 6, 30)
    s = sales_df(spark, [
        sale(1, 1, "2024-06-01", qty=1, amount="10"),
        sale(1, 1, "2024-07-01", qty=0, amount="20000"),
        sale(None, 1, None, qty=1, amount="5"),
    ])
    tagged = E.validate_split(s, E.sales_rules(as_of))
    reasons = sorted(r["reject_reason"] for r in tagged.collect())
    assert reasons == ["", "future_date;non_positive_quantity;amount_over_limit",
                       "missing_customer;missing_date;future_date"]
    assert E.valid_rows(tagged).count() == 1 and E.rejected_rows(tagged).count() == 2


def test_duplicate_ratio(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 1)], "a BIGINT, b BIGINT")
    r = K.duplicate_ratio(df, ["a", "b"], threshold=0.2).collect()[0]
    assert r["observed"] == 0.25 and r["passed"] is False
    assert K.duplicate_ratio(df, ["a", "b"], threshold=0.25).collect()[0]["passed"] is True


def test_missing_ratio_with_injected_nulls(spark):
    df = spark.createDataFrame(
        [(1, None), (2, None), (3, 1.0), (None, 2.0)] + [(i, 1.0) for i in range(4, 10)],
        "id BIGINT, value DOUBLE",
    )
    out = {r["check_name"]: r for r in K.missing_ratio(df, ["id", "value"]).collect()}
    assert out["missing_ratio:id"]["observed"] == 0.1 and out["missing_ratio:id"]["passed"] is True
    assert out["missing_ratio:value"]["observed"] == 0.2 and out["missing_ratio:value"]["passed"] is False


def test_landing_roundtrip_csv_json(spark):
    o = orders_df(spark, [order(1, "2024-01-01 10:00:00", "12.50"), order(2, "2024-01-02", "7")])
    o = o.withColumn("total_amount", F.col("total_amount").cast("double"))
    schema = "customer_id BIGINT, transaction_date TIMESTAMP_NTZ, total_amount DOUBLE"
    for fmt in ("csv", "json", "parquet"):
        path = shared_dir(spark, f"t-landing-{fmt}")
        L.write_landing(o, path, fmt)
        back = L.landing_ingest(spark, path, fmt, schema)
        assert sorted(back.collect()) == sorted(o.collect())


def test_stream_ingest_is_incremental(spark):
    schema = "customer_id BIGINT, transaction_date TIMESTAMP_NTZ, total_amount DOUBLE"
    landing, out, ckpt = (shared_dir(spark, p) for p in ("t-land", "t-out", "t-ckpt"))
    first = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), 1.0)], schema)
    first.write.mode("append").json(landing)
    assert ingest_available(spark, landing, "json", schema, out, ckpt).count() == 1
    second = spark.createDataFrame([(2, dt.datetime(2024, 1, 2), 2.0)], schema)
    second.write.mode("append").json(landing)
    # a second run only picks up the new file: no duplicates
    assert ingest_available(spark, landing, "json", schema, out, ckpt).count() == 2


def test_clean_load_partitions_and_prunes(spark):
    s = sales_df(spark, [sale(1, 1, "2024-01-05"), sale(2, 2, "2024-02-05"), sale(3, 3, "2024-02-06")])
    s = s.withColumn("year_month", F.date_format("transaction_date", "yyyy-MM"))
    path = shared_dir(spark, "t-load")
    L.clean_load(s, path, "year_month")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in s.schema.fields)
    back = L.read_loaded(spark, path, schema)
    feb = back.filter(F.col("year_month") == "2024-02")
    assert feb.count() == 2
    plan = feb._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year_month" in plan


def test_snapshots_copy_every_row_and_keep_other_days(spark):
    as_of = dt.datetime(2024, 6, 30)
    o = orders_df(spark, [order(1, "2024-06-01"), order(2, None), order(3, "2030-01-01")])
    path = shared_dir(spark, "t-snap")
    days = [as_of.date() - dt.timedelta(days=k) for k in (12, 9, 6, 3, 0)]
    for day in days:
        L.write_snapshot(o, path, day)
    L.write_snapshot(o, path, days[-1])  # a second run of a day replaces that day only
    assert L.list_snapshots(spark, path) == days
    expired = L.expire_snapshots(spark, path, as_of, keep_days=7)
    assert expired == days[:2]
    summary = {r["snapshot_date"]: r["row_count"] for r in L.snapshot_summary(
        spark, path, "customer_id BIGINT, transaction_date TIMESTAMP_NTZ, total_amount DECIMAL(18,2)",
        "total_amount").collect()}
    assert summary == {d: 3 for d in days[2:]}


def test_kpi_report_written_and_read_back(spark, sf_dir):
    from ledgerlens.operators import dashboard as DB
    from ledgerlens.sources.retail import RetailSource

    src = RetailSource(spark, sf_dir)
    report = DB.kpi_report(src.sales(), src.orders(), src.products(), src.as_of())
    written = DB.write_report(report, shared_dir(spark, "t-report"))
    assert set(written) == {"revenue_trends", "top_products", "customer_segments"}
    assert spark.read.parquet(written["top_products"]).count() == 10
    assert spark.read.parquet(written["customer_segments"]).count() == 6


def test_approximate_distinct_is_close(spark, sf_dir):
    from ledgerlens.operators import analytics as A
    from ledgerlens.sources.retail import RetailSource

    s = RetailSource(spark, sf_dir).sales()
    exact = {r["year_month"]: r["unique_customers"] for r in A.revenue_growth(s).collect()}
    approx = {r["year_month"]: r["unique_customers"]
              for r in A.revenue_growth(s, exact_distinct=False).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(approx[k] - exact[k]) <= max(3, 0.05 * exact[k]) for k in exact)


def test_snapshot_retention_daily_runs(spark):
    o = orders_df(spark, [order(1, "2024-06-01"), order(2, "2024-06-25"), order(3, "2024-06-29")])
    path = shared_dir(spark, "t-snap-daily")
    for day in (1, 5, 9, 12):  # four daily runs; the first ones age out
        as_of = dt.datetime(2024, 6, 20 + day) if day < 11 else dt.datetime(2024, 7, day - 10)
        out = L.snapshot_retention(o, path, as_of, keep_days=7)
    kept = [r["snapshot_date"] for r in out.collect()]
    assert kept == [dt.date(2024, 6, 25), dt.date(2024, 6, 29), dt.date(2024, 7, 2)]
    assert [r["row_count"] for r in out.collect()] == [3, 3, 3]


def test_stream_flag_on_landing_ingest(spark):
    schema = "customer_id BIGINT, transaction_date TIMESTAMP_NTZ, total_amount DOUBLE"
    landing = shared_dir(spark, "t-land-flag")
    spark.createDataFrame([(1, dt.datetime(2024, 1, 1), 1.0)], schema).write.json(landing)
    assert L.landing_ingest(spark, landing, "json", schema, stream=True).count() == 1


def test_parameterised_sql_matches_dataframe_checks(spark):
    as_of = dt.datetime(2024, 6, 30)
    o = orders_df(spark, [order(1, "2024-06-30 10:00:00", "50"), order(2, "2024-06-30", "70"),
                          order(3, "2024-06-29 23:59:59", "900")])
    r = K.daily_volume_sql(spark, o, as_of.date()).collect()[0]
    assert r["daily_count"] == 2 and r["max_amount"] == Decimal("70.00")
    checks = {c["check_name"]: c for c in K.quality_checks(o, as_of).collect()}
    assert checks["daily_volume"]["observed"] == 2.0
    assert checks["amount_outlier"]["observed"] == 70.0


def test_warehouse_source_gives_the_same_answers(spark, sf_dir):
    from ledgerlens.operators import analytics as A
    from ledgerlens.operators import dashboard as DB
    from ledgerlens.sources.retail import RetailSource
    from ledgerlens.sources.warehouse import materialize

    raw = RetailSource(spark, sf_dir)
    wh = materialize(raw, shared_dir(spark, "t-warehouse"))
    assert wh.as_of() == raw.as_of()
    pairs = [
        (A.regional_growth(raw.sales(), raw.regions()), A.regional_growth(wh.sales(), wh.regions())),
        (A.sales_rep_performance(raw.sales(sales_rep=True)), A.sales_rep_performance(wh.sales(sales_rep=True))),
        (A.inventory_insights(raw.sales(), raw.products(), raw.as_of()),
         A.inventory_insights(wh.sales(), wh.products(), wh.as_of())),
        (A.rfm_segments(raw.orders(), raw.as_of()), A.rfm_segments(wh.orders(), wh.as_of())),
        (DB.kpi_cards(raw.orders(), raw.as_of()), DB.kpi_cards(wh.orders(), wh.as_of())),
    ]
    for a, b in pairs:
        assert sorted(a.collect()) == sorted(b.collect())
    # the warehouse plan has no join for a line-grain query
    plan = A.revenue_growth(wh.sales())._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_daily_job_writes_every_output(spark, sf_dir):
    from ledgerlens.jobs import daily_job

    out = shared_dir(spark, "t-daily-job")
    result = daily_job(spark, sf_dir, out)
    assert {c["check_name"] for c in result["quality_checks"]} == {
        "daily_volume", "amount_outlier", "freshness", "duplicate_ratio",
        "missing_ratio:customer_id", "missing_ratio:transaction_date", "missing_ratio:total_amount"}
    from ledgerlens.sources.manifest import Versions

    at = [[v["at"] for v in Versions(spark, f"{out}/snapshots/{name}").list()] for name in ("orders", "sales", "products")]
    assert at[0] == at[1] == at[2] and len(at[0]) == 1
    assert spark.read.parquet(result["dashboard"]["day_hour_heatmap"]).count() == 168
    assert spark.read.parquet(result["dashboard"]["kpi_cards"]).count() == 4
    assert spark.read.parquet(result["dashboard"]["revenue_growth"]).count() == 80
    assert len(result["snapshots"]) == 1
    src = RetailSource(spark, sf_dir)
    served = {"daily_revenue": DB.daily_revenue(src.sales()), "regional_share": DB.regional_share(src.sales(), src.regions()), "seasonal_analysis": A.seasonal_analysis(src.sales())}
    for name, want in served.items():
        assert sorted(spark.read.parquet(result["dashboard"][name]).collect(), key=str) == sorted(want.collect(), key=str), name
    month = F.date_format("transaction_date", "yyyy-MM").alias("year_month")
    want = src.orders().groupBy(month).agg(F.countDistinct("customer_id").alias("unique_customers"))
    assert sorted(spark.read.parquet(result["dashboard"]["monthly_customers"]).collect()) == sorted(want.collect())


def test_duplicate_ratio_estimate_is_close(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    exact = K.duplicate_ratio(li, ["l_orderkey", "l_linenumber"]).collect()[0]["observed"]
    est = K.duplicate_ratio(li, ["l_orderkey", "l_linenumber"], exact=False).collect()[0]["observed"]
    assert abs(est - exact) < 0.03


def test_daily_job_command_line(spark, tmp_path):
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = shared_dir(spark, "t-daily-cli").replace("file:", "")
    proc = subprocess.run(
        [sys.executable, "-m", "ledgerlens.jobs", "--input", "/root/testdata/sf0.001", "--output", out],
        cwd=root, capture_output=True, text=True, timeout=600,
    )
    assert proc.returncode == 0, proc.stderr[-2000:]
    assert "failed_checks" in proc.stdout
    assert os.path.isdir(os.path.join(out, "dashboard", "kpi_cards"))


def test_three_landing_sources(spark, sf_dir):
    from ledgerlens.sources.tables import TABLE_SCHEMAS

    root = shared_dir(spark, "t-landing-root")
    tables = {"sales": "orders", "customers": "customer", "products": "part"}
    for source, table in tables.items():
        L.write_landing(spark.read.parquet(f"{sf_dir}/{table}.parquet"), f"{root}/{source}", "csv")
    frames = L.ingest_landing_sources(spark, root, {s: TABLE_SCHEMAS[t] for s, t in tables.items()})
    assert set(frames) == set(L.LANDING_SOURCES)
    for source, table in tables.items():
        assert frames[source].count() == spark.read.parquet(f"{sf_dir}/{table}.parquet").count()


def test_warehouse_as_of_skips_the_folder_of_missing_dates(spark):
    from ledgerlens.sources.warehouse import WarehouseSource, _write_partitioned

    root = shared_dir(spark, "t-wh-null")
    rows = [(1, dt.datetime(2024, 5, 1), Decimal("1")), (2, None, Decimal("2"))]
    _write_partitioned(spark.createDataFrame(rows, "customer_id BIGINT, transaction_date TIMESTAMP_NTZ, total_amount DECIMAL(20,6)"), f"{root}/orders")
    assert WarehouseSource(spark, root).as_of() == dt.datetime(2024, 5, 1)


def test_empty_orders_have_an_answer(spark):
    from ledgerlens.operators import analytics as A
    from ledgerlens.sources.retail import NO_ORDERS, RetailSource
    from ledgerlens.sources.tables import TABLE_SCHEMAS

    base = shared_dir(spark, "t-empty").replace("file:", "")
    spark.createDataFrame([], TABLE_SCHEMAS["orders"]).write.parquet(f"{base}/orders.parquet")
    src = RetailSource(spark, base)
    assert src.as_of() == NO_ORDERS
    assert A.customer_churn(src.orders(), src.as_of()).collect() == []


def test_as_of_follows_new_orders(spark):
    from ledgerlens.sources.retail import RetailSource
    from ledgerlens.sources.tables import TABLE_SCHEMAS

    base = shared_dir(spark, "t-as-of").replace("file:", "")
    for day in (dt.datetime(2024, 1, 1), dt.datetime(2030, 1, 1)):
        spark.createDataFrame([(1, 1, "O", 1.0, day, "x")], TABLE_SCHEMAS["orders"]).write.mode("append").parquet(f"{base}/orders.parquet")
        assert RetailSource(spark, base).as_of() == day


def test_line_amounts_keep_all_decimals(spark):
    from ledgerlens.sources.retail import line_amount

    df = spark.createDataFrame([(100.005, 0.075)], "p DOUBLE, d DOUBLE")
    assert df.select(line_amount(F.col("p"), F.col("d")).alias("a")).first()["a"] == Decimal("92.504625")


def test_round_ratio_of_twenty_digits(spark):
    from ledgerlens.functions import numeric as N

    df = spark.createDataFrame([(Decimal("12345678901234567890.12"),)], "x DECIMAL(38,2)")
    assert df.select(N.round_ratio("x", F.lit(1), 2, 2).alias("r")).first()["r"] == Decimal("12345678901234567890.12")


def test_averages_skip_missing_measures(spark):
    from ledgerlens.operators import analytics as A
    from ledgerlens.operators import dashboard as DB

    day = dt.date(2024, 6, 30)
    sales = spark.createDataFrame(
        [(1, 1, day, 2.0, Decimal("10")), (None, 1, day, None, None)],
        "customer_id BIGINT, product_id BIGINT, transaction_date DATE, quantity DOUBLE, total_amount DECIMAL(29,12)",
    )
    assert A.revenue_growth(sales).first()["avg_transaction_value"] == 10.0
    products = spark.createDataFrame(
        [(1, "p", "c", "b", 10.0, 20, 1)],
        "product_id BIGINT, product_name STRING, category STRING, brand STRING, profit_margin DOUBLE, stock_quantity BIGINT, is_active INT",
    )
    stock = A.inventory_insights(sales, products, dt.datetime(2024, 6, 30)).first()
    assert stock["days_of_inventory"] == 10.0 and stock["reorder_recommendation"] == "Reorder Required"
    orders = spark.createDataFrame(
        [(1, dt.datetime(2024, 6, 30), Decimal("10")), (None, dt.datetime(2024, 6, 30), None)],
        "customer_id BIGINT, transaction_date TIMESTAMP_NTZ, total_amount DECIMAL(20,6)",
    )
    for row in DB.kpi_by_range(orders, dt.datetime(2024, 6, 30)).collect():
        assert (row["customer_count"], row["order_count"], row["avg_order_value"]) == (1, 2, 10.0)


def test_broken_landing_rows_fail_both_ways(spark):
    schema = "customer_id BIGINT, note STRING"
    landing = shared_dir(spark, "t-land-bad").replace("file:", "")
    spark.createDataFrame([("1", "a"), ("x", "b")], "customer_id STRING, note STRING").write.csv(landing, header=True)
    for stream in (False, True):
        with pytest.raises(Exception):
            L.landing_ingest(spark, landing, "csv", schema, stream=stream).collect()


def test_csv_landing_keeps_line_breaks_and_empty_text(spark):
    schema = "k BIGINT, note STRING"
    rows = [(1, "two\nlines, \"quoted\""), (2, ""), (3, None)]
    rows += [(4, "back\\slash \\n \\\\n \\"), (5, "\r\n\\\n"), (6, "\\N"), (7, "\\\\N")]
    for breaks in ("escaped", "quoted"):
        landing = shared_dir(spark, "t-land-csv")
        kept = [r for r in rows if breaks == "escaped" or r[0] not in (5, 6)]  # quoted text has one kind of line end, and no text that means NULL
        L.write_landing(spark.createDataFrame(kept, schema), landing, "csv", breaks)
        assert sorted(tuple(r) for r in L.landing_ingest(spark, landing, "csv", schema, breaks=breaks).collect()) == kept
    landing, out, ckpt = (shared_dir(spark, p) for p in ("t-land-csv", "t-out-csv", "t-ckpt-csv"))
    L.write_landing(spark.createDataFrame(rows, schema), landing, "csv")
    assert sorted(tuple(r) for r in ingest_available(spark, landing, "csv", schema, out, ckpt).collect()) == rows


def test_timed_out_ingest_is_an_error(spark):
    schema = "k BIGINT"
    landing = shared_dir(spark, "t-land-slow")
    spark.range(200, numPartitions=40).selectExpr("id AS k").write.json(landing)
    from ledgerlens.streaming.landing_stream import ingest_available

    with pytest.raises(TimeoutError):
        ingest_available(spark, landing, "json", schema, shared_dir(spark, "t-slow-out"), shared_dir(spark, "t-slow-cp"), max_files_per_trigger=1, timeout_s=0.5)
