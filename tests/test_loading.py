"""Incremental loads, quarantine and published versions."""
import datetime as dt
import glob
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fixtures import order, orders_df
from ledgerlens.functions import numeric as N
from ledgerlens.operators import cleaning as E
from ledgerlens.operators import dashboard as DB
from ledgerlens.operators import quality as K
from ledgerlens.session import shared_dir
from ledgerlens.sources import landing as L
from ledgerlens.sources.incremental import IncrementalTable
from ledgerlens.sources.manifest import GateFailed, Manifest, Versions
from ledgerlens.streaming.landing_stream import ingest_available_with_quarantine

SCHEMA = "k BIGINT, line INT, d STRING, v STRING"


def _table(spark, **sizes):
    schema = spark.createDataFrame([], SCHEMA).schema
    return IncrementalTable(spark, shared_dir(spark, "t-incremental"), schema, ["k", "line"], **sizes)


def test_overlapping_landings_load_each_key_once(spark):
    r = random.Random(4)
    table, seen = _table(spark, buckets=8, parts=2), {}
    for number in range(4):
        rows = [(r.choice([None, *range(60)]), r.randint(0, 2), f"2024-01-{r.randint(1, 9):02d}", f"{number}-{r.randint(0, 5)}") for _ in range(120)]
        before = dict(seen)
        for row in sorted(rows, key=lambda x: (x[2], x[3])):
            seen.setdefault((row[0], row[1]), row)
        got = table.load(spark.createDataFrame(rows, SCHEMA), ["d"])
        assert got["loaded"] == len(seen) - len(before)
        assert got["repeated"] == len({x[:2] for x in rows}) - got["loaded"]
        if number == 1:
            table.compact()
        again = IncrementalTable(spark, table.root, table.schema, table.keys)  # as another run finds it
        assert sorted(map(str, (tuple(x) for x in again.read().collect()))) == sorted(map(str, seen.values()))
    assert table.load(spark.createDataFrame([], SCHEMA), ["d"])["loaded"] == 0


def test_only_touched_buckets_are_read(spark):
    table = _table(spark, buckets=16, parts=4)
    rows = lambda a, b: spark.range(a, b).selectExpr("id AS k", "1 AS line", "'d' AS d", "'v' AS v")
    assert table.load(rows(0, 4000), ["d"]) == {"loaded": 4000, "repeated": 0, "buckets_read": []}
    fresh = table.load(rows(4000, 4200), ["d"])  # all new: the filter says so but for few
    assert fresh["loaded"] == 200 and len(fresh["buckets_read"]) <= 4
    place = rows(7, 8).select(table._hash(0, 16)).first()[0]
    old = table.load(rows(7, 8), ["d"])
    assert old == {"loaded": 0, "repeated": 1, "buckets_read": [place]}
    files = table.known_keys([place]).select(F.input_file_name().alias("f")).distinct().collect()
    assert files and all(f"_bucket={place}/" in x["f"] for x in files)
    plan = table.known_keys([place])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_bucket" in plan or "PartitionFilters: [_bucket" in plan


def test_a_failed_load_leaves_the_table(spark, monkeypatch):
    table = _table(spark, buckets=4, parts=1)
    table.load(spark.createDataFrame([(1, 1, "a", "x")], SCHEMA), ["d"])
    monkeypatch.setattr(Manifest, "commit", lambda self, state: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        table.load(spark.createDataFrame([(2, 1, "a", "x")], SCHEMA), ["d"])
    monkeypatch.undo()
    again = IncrementalTable(spark, table.root, table.schema, table.keys)
    assert [x["k"] for x in again.read().collect()] == [1]
    assert again.load(spark.createDataFrame([(2, 1, "a", "y")], SCHEMA), ["d"])["loaded"] == 1


LINES = ["1,a,2.5,2024-01-01", "2,b,x,2024-01-02", "3,c", "4,d,4.5,2024-01-04,more", '5,"e, e",5.5,2024-01-05', "", "6,\\N,6.5,2024-01-06", "7,two\\nlines,7.5,not a day"]
LINE_SCHEMA = "k BIGINT, note STRING, price DOUBLE, day DATE"


def test_broken_lines_are_kept_apart_both_ways(spark):
    landing = shared_dir(spark, "t-broken")
    spark.createDataFrame([(x,) for x in LINES], "value STRING").coalesce(1).write.text(landing)
    batch = L.ingest_with_quarantine(spark, landing, "csv", LINE_SCHEMA, shared_dir(spark, "t-kept"), header=False)
    stream = ingest_available_with_quarantine(spark, landing, "csv", LINE_SCHEMA, shared_dir(spark, "t-kept"), shared_dir(spark, "t-kept-ckpt"), header=False)
    for rows, broken in (batch, stream):
        assert sorted(tuple(x) for x in rows.collect()) == [(1, "a", 2.5, dt.date(2024, 1, 1)), (5, "e, e", 5.5, dt.date(2024, 1, 5)), (6, None, 6.5, dt.date(2024, 1, 6))]
        assert sorted(x["line"] for x in broken.collect()) == sorted(LINES[i] for i in (1, 2, 3, 7))
        assert all(x["file"].startswith("part-") for x in broken.collect())


def test_quarantine_stream_goes_on(spark):
    landing, out, ckpt = (shared_dir(spark, p) for p in ("t-qs", "t-qs-out", "t-qs-ckpt"))
    for number in range(2):
        spark.createDataFrame([(f'{{"k": {number}}}',), (f"{{broken {number}",)], "value STRING").write.mode("append").text(landing)
        rows, broken = ingest_available_with_quarantine(spark, landing, "json", "k BIGINT", out, ckpt)
        assert sorted(x["k"] for x in rows.collect()) == list(range(number + 1))
        assert sorted(x["line"] for x in broken.collect()) == [f"{{broken {i}" for i in range(number + 1)]


def test_one_csv_file_is_read_by_many_tasks(spark):
    landing = shared_dir(spark, "t-one-file")
    L.write_landing(spark.range(60_000).selectExpr("id AS k", "repeat('x', 60) AS note").coalesce(1), landing, "csv")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "400k")
    try:
        split = L.landing_ingest(spark, landing, "csv", "k BIGINT, note STRING")
        whole = L.landing_ingest(spark, landing, "csv", "k BIGINT, note STRING", breaks="quoted")
        assert split.rdd.getNumPartitions() >= 8 and whole.rdd.getNumPartitions() == 1
        assert split.agg(F.sum("k")).first()[0] == 60_000 * 59_999 // 2
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_readers_see_whole_versions(spark):
    versions = Versions(spark, shared_dir(spark, "t-versions"))
    at = dt.datetime(2024, 6, 30, 10, 0, 1)
    versions.publish(spark.range(5), at)
    failing = spark.range(100).select(F.when(F.col("id") < 99, F.col("id")).otherwise(F.raise_error(F.lit("disk lost")).cast("long")).alias("id"))
    with pytest.raises(Exception, match="disk lost"):
        versions.publish(failing, at + dt.timedelta(seconds=1))
    assert versions.read().count() == 5 and len(versions.list()) == 1
    held = versions.read()
    versions.publish(spark.range(7), at + dt.timedelta(seconds=2))
    assert held.count() == 5 and versions.read().count() == 7  # a reader keeps what it opened
    assert versions.read(versions.list()[0]["name"]).count() == 5


def test_two_runs_on_a_day_and_empty_tables(spark):
    path, at = shared_dir(spark, "t-runs"), dt.datetime(2024, 6, 30, 8)
    o = orders_df(spark, [order(1, "2024-06-01"), order(2, None)])
    L.take_snapshot(o, path, at - dt.timedelta(days=8))
    L.take_snapshot(o, path, at)
    L.take_snapshot(o.limit(0), path, at + dt.timedelta(hours=1))
    versions = L.take_snapshot(o.limit(1), path, at + dt.timedelta(hours=2, seconds=5))
    assert [(x["snapshot_at"], x["row_count"]) for x in versions.summary().collect()] == [(at, 2), (at + dt.timedelta(hours=1), 0), (at + dt.timedelta(hours=2, seconds=5), 1)]
    folders = {os.path.basename(x) for x in glob.glob(f"{path.replace('file:', '')}/versions/*")}
    assert folders == {v["name"] for v in versions.list()}  # the old copy's folder is gone
    empty = versions.read(versions.list()[1]["name"])
    assert empty.columns == o.columns and empty.count() == 0
    assert versions.expire(at + dt.timedelta(days=99)) and len(versions.list()) == 1  # the one in force stays
    assert Versions(spark, shared_dir(spark, "t-none")).summary().count() == 0


def test_a_second_writer_fails(spark):
    manifest = Manifest(spark, shared_dir(spark, "t-manifest"))
    assert manifest.load() is None
    for n in range(15):
        manifest.commit({"n": n})
    assert manifest.load() == {"n": 14} and len(manifest.numbers()) <= 11
    late = Manifest(spark, manifest.root)
    late.numbers = lambda: manifest.__class__.numbers(manifest)[:-1]
    with pytest.raises(RuntimeError):
        late.commit({"n": "late"})
    assert manifest.load() == {"n": 14}


def test_a_failing_check_keeps_the_old_version(spark):
    as_of = dt.datetime(2024, 6, 30)
    versions = Versions(spark, shared_dir(spark, "t-gate"))
    schema = "customer_id BIGINT, transaction_date TIMESTAMP_NTZ, total_amount DECIMAL(20,6)"
    good = spark.createDataFrame([(i, as_of, Decimal(5)) for i in range(120)], schema)
    few = good.limit(3)
    rows = K.publish_checked(versions, good, as_of, required=("daily_volume",))
    assert sorted(rows.collect()) == sorted(K.quality_checks(good, as_of).collect())
    with pytest.raises(GateFailed, match="Low transaction count"):
        K.publish_checked(versions, few, as_of, required=("daily_volume",))
    assert versions.read().count() == 120
    assert not all(x["passed"] for x in K.publish_checked(versions, few, as_of).collect())
    assert versions.read().count() == 3


def test_every_day_has_a_row(spark):
    as_of = dt.datetime(2024, 3, 2, 12)
    sales = spark.createDataFrame([(dt.date(2024, 2, 29), Decimal("2.5")), (dt.date(2024, 2, 29), None), (dt.date(2024, 2, 1), Decimal(9)), (None, Decimal(1)), (dt.date(2024, 3, 3), Decimal(7))], "transaction_date DATE, total_amount DECIMAL(29,12)")
    got = [tuple(x) for x in DB.daily_revenue_calendar(sales, as_of, 4).collect()]
    assert got == [(dt.date(2024, 2, 28), 0.0, 0), (dt.date(2024, 2, 29), 2.5, 2), (dt.date(2024, 3, 1), 0.0, 0), (dt.date(2024, 3, 2), 0.0, 0)]


def test_percent_of_line_is_exact(spark):
    r = random.Random(3)
    rows = [(Decimal(r.randint(-(10**20), 10**20)).scaleb(-12), r.randint(0, 10**6) / 10**4) for _ in range(300)]
    rows += [(Decimal("0.5"), 1.0), (Decimal("-0.5"), 1.0), (Decimal("1.25"), 2.0), (None, 3.0), (Decimal(1), None)]
    got = spark.createDataFrame(rows, "a DECIMAL(29,12), p DOUBLE").select(N.percent_of_line("a", "p").alias("x"), N.percent_of("a", "p").alias("y"))
    for x in got.collect():
        assert x["x"] == x["y"]


def test_outcomes_are_written_once(spark):
    tagged = spark.createDataFrame([(1, 1, dt.date(2024, 1, 1), 1.0, Decimal(10), "", True)], "customer_id BIGINT, product_id BIGINT, transaction_date DATE, quantity DOUBLE, total_amount DECIMAL(29,12), reject_reason STRING, is_valid BOOLEAN")
    products = spark.createDataFrame([(1, 10.0)], "product_id BIGINT, profit_margin DOUBLE")
    loaded, rejected = E.load_sales(tagged, products, shared_dir(spark, "t-outcomes"))
    schema = "estimated_profit DOUBLE, reject_reason STRING, year_month STRING"
    assert [tuple(x) for x in spark.read.schema(schema).parquet(loaded).collect()] == [(1.0, "", "2024-01")]
    assert spark.read.schema(schema).parquet(rejected).count() == 0
