"""Interleaved layout: nothing lost, row groups skipped on every clustering column."""
import datetime as dt
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import analytics as A
from ledgerlens.functions import dates as D
from ledgerlens.sources import clustered as C
from ledgerlens.sources.retail import RetailSource
from ledgerlens.sources.warehouse import materialize


def scanned(df) -> int:
    """Rows that the scan hands on after skipping row groups."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


@pytest.fixture(scope="module")
def sources(spark, sf_dir, tmp_path_factory):
    root = tmp_path_factory.mktemp("clustered")
    raw = RetailSource(spark, sf_dir)
    warehouse = materialize(raw, str(root / "warehouse"))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several files of a small table
    try:
        source = C.cluster_sales(warehouse, str(root / "curve"), row_group_bytes=16 << 10)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    return raw, warehouse, source, root / "curve"


def test_the_layout_holds_the_same_rows(sources):
    _, warehouse, source, _ = sources
    a, b = warehouse.sales(region=True, sales_rep=True), source.sales(region=True, sales_rep=True)
    assert a.schema.names == b.schema.names
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_every_clustering_column_skips_rows(sources):
    _, _, source, _ = sources
    everything = source.sales().count()
    since = D.window_start(source.as_of(), A.RECENT_DAYS)
    key = source.sales().groupBy("product_id").count().orderBy("product_id").collect()[40]["product_id"]
    buyer = source.sales().groupBy("customer_id").count().orderBy("customer_id").collect()[40]["customer_id"]
    assert scanned(source.sales(since=since)) < everything * 0.4
    for filtered, exact in ((source.sales(products=[key]), F.col("product_id") == key), (source.sales(customers=[buyer]), F.col("customer_id") == buyer)):
        assert scanned(filtered) < everything * 0.5
        assert filtered.count() == source.sales().filter(exact).count() > 0


def test_filters_reach_the_scan(sources):
    _, _, source, _ = sources
    by_day, by_product = (df._jdf.queryExecution().executedPlan().toString() for df in (source.sales(since=dt.date(1998, 1, 1)), source.sales(products=[3, 5])))
    assert "GreaterThanOrEqual(transaction_date" in by_day and "In(product_id, [3,5])" in by_product
    assert "region" not in by_day and "sales_rep" not in by_day


def test_every_row_group_has_bounds_of_the_clustering_columns(sources):
    *_, folder = sources
    footers = [pq.ParquetFile(p).metadata for p in sorted(folder.glob("*.parquet"))]
    assert len(footers) > 1
    for footer in footers:
        held = [footer.row_group(i).column(j) for i in range(footer.num_row_groups) for j in range(footer.num_columns)]
        assert {c.path_in_schema for c in held if c.statistics is not None and c.statistics.has_min_max} >= set(C.CLUSTER_BY)


def test_a_bloom_filter_answers_where_bounds_do_not(spark, tmp_path):
    rows = spark.range(200_000, numPartitions=1).select((F.col("id") * 2).alias("k"))
    for name, bloom in (("with", ["k"]), ("without", [])):
        C.write_clustered(rows.withColumn("day", F.lit(dt.date(2020, 1, 1))), str(tmp_path / name), by=["day"], bloom=bloom)
    absent = [7, 39_999, 123_457]
    with_filter = [scanned(spark.read.parquet(str(tmp_path / "with")).filter(F.col("k") == k)) for k in absent]
    assert with_filter == [0, 0, 0]
    assert scanned(spark.read.parquet(str(tmp_path / "with")).filter("k = 39998")) > 0


def test_inventory_equals_the_raw_path(sources):
    raw, _, source, _ = sources
    since = D.window_start(source.as_of(), A.RECENT_DAYS)
    got = A.inventory_insights(source.sales(since=since), source.products(), source.as_of()).collect()
    assert got == A.inventory_insights(raw.sales(since=since), raw.products(), raw.as_of()).collect()


def test_nulls_hot_values_and_empty_tables(spark, tmp_path):
    draw = random.Random(5)
    rows = [(None if draw.random() < 0.1 else 7 if draw.random() < 0.4 else draw.randrange(1000), None if draw.random() < 0.1 else dt.date(2020, 1, 1) + dt.timedelta(draw.randrange(300)), i // 3) for i in range(3000)]
    df = spark.createDataFrame(rows, "k bigint, day date, v int")
    for name, table in (("some", df), ("none", df.limit(0)), ("nulls", df.select(F.lit(None).cast("bigint").alias("k"), F.lit(None).cast("date").alias("day"), "v"))):
        C.write_clustered(table, str(tmp_path / name), by=["k", "day"], bloom=["k"])
        back = spark.read.schema(df.schema).parquet(str(tmp_path / name))
        assert sorted(map(str, back.collect())) == sorted(map(str, table.collect()))
    with pytest.raises(ValueError):
        C.range_borders(spark.createDataFrame([("a",)], "s string"), ["s"])


def test_codes_interleave_ranks(spark):
    df = spark.createDataFrame([(x, y) for x in range(8) for y in range(8)], "x int, y int")
    code = C.curve_code(df, {"x": list(range(1, 8)), "y": list(range(1, 8))}, bits=3)
    for r in df.withColumn("code", code).collect():
        assert r["code"] == sum((r["x"] >> b & 1) << 2 * b | (r["y"] >> b & 1) << 2 * b + 1 for b in range(3))
