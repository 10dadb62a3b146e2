"""The daily batch job: quality checks, KPI report, dashboard panels, snapshot.

This is the scheduled run of the original automation (quality checks ->
report -> backup with retention), expressed as one Spark application.
The raw tables are joined once: the denormalised sales, orders and products
are written to ``output_dir/warehouse`` first (a written table on shared
storage cuts the lineage), and every panel then reads those files instead of
re-joining the facts.  One pass over the sales and one over the orders make
base tables (``operators.panels``); most panels, the report, the daily rollup
and the days' bitmaps of customers come from these.  Sales reps, categories
and the buyers of the top products read the sales again.  Every output is
written under ``output_dir``; each write is its own job, so a failure re-runs
only the write that failed.

Usage::

    spark-submit ledgerlens/jobs.py --input /data/raw --output /data/reports [--cluster-defaults]
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.operators import analytics as A
from ledgerlens.operators import dashboard as DB
from ledgerlens.operators import panels as P
from ledgerlens.operators import quality as K
from ledgerlens.operators import rollups as R
from ledgerlens.sources import landing as L
from ledgerlens.sources.retail import RetailSource
from ledgerlens.sources.warehouse import materialize


def rollup_frames(rollup: DataFrame, bitmaps: DataFrame) -> dict[str, DataFrame]:
    """The panels that the daily rollup and the bitmaps of customers answer exactly."""
    return {
        "regional_share": R.regional_share_from_rollup(rollup),
        "daily_revenue": R.daily_revenue_from_rollup(rollup),
        "seasonal_analysis": R.seasonal_from_rollup(rollup),
        "monthly_customers": R.monthly_customers(bitmaps),
    }


def write_rollup(src, bases: P.Bases, out: str) -> dict[str, DataFrame]:
    """Write rollup and bitmaps of the bases to ``out``; returns the panels over these tables."""
    tables = {"rollup": P.rollup_of(bases, src.regions()), "bitmaps": P.bitmaps_of(bases)}
    written = {}
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{out}/{name}")
        written[name] = src.spark.read.schema(df.schema).parquet(f"{out}/{name}")
    return rollup_frames(written["rollup"], written["bitmaps"])


def dashboard_frames(src, bases: P.Bases) -> dict[str, DataFrame]:
    """The other dashboard panels: those of the bases, and those that need every sale."""
    sales = src.sales()
    return {
        **P.base_panels(bases, sales, src.products(), src.regions(), src.as_of()),
        "category_trends": A.category_trends(sales, src.products()),
        "sales_rep_performance": A.sales_rep_performance(src.sales(sales_rep=True)),
    }


def activity_frames(raw: RetailSource) -> dict[str, DataFrame]:
    """The panel that reads events, which are not part of the warehouse."""
    return {"day_hour_heatmap": DB.day_hour_heatmap(raw.events())}


def daily_job(
    spark: SparkSession,
    input_dir: str,
    output_dir: str,
    keep_days: int = 7,
    as_of: dt.datetime | None = None,
) -> dict:
    """Run the daily job; returns the quality check rows (small) and paths.

    ``as_of`` is the run's reporting instant (default: latest order time).
    """
    out = output_dir.rstrip("/")
    raw = RetailSource(spark, input_dir, as_of_value=as_of)
    src = materialize(raw, f"{out}/warehouse")
    checks = (
        K.quality_checks(src.orders(), src.as_of())
        .unionByName(K.duplicate_ratio(raw.table("lineitem"), ["l_orderkey", "l_linenumber"]))
        .unionByName(K.missing_ratio(src.orders()))
    )
    checks.write.mode("overwrite").json(f"{out}/quality_checks")  # a row per check
    bases = P.write_bases(src.sales(), src.orders(), f"{out}/daily")
    report = DB.write_report(P.base_report(bases, src.products(), src.as_of()), f"{out}/kpi_report")
    panels = DB.write_report({**dashboard_frames(src, bases), **write_rollup(src, bases, f"{out}/daily"), **activity_frames(raw)}, f"{out}/dashboard")
    tables = {"orders": src.orders(), "sales": src.sales(), "products": src.products()}
    kept = {name: L.take_snapshot(table, f"{out}/snapshots/{name}", src.as_of(), keep_days) for name, table in tables.items()}
    snapshots = kept["orders"].summary()
    return {
        "quality_checks": [r.asDict() for r in spark.read.json(f"{out}/quality_checks").collect()],
        "kpi_report": report,
        "dashboard": panels,
        "snapshots": [r.asDict() for r in snapshots.collect()],
    }


def main(argv: list[str] | None = None) -> None:
    from ledgerlens.session import CLUSTER_CONF, SESSION_CONF

    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--keep-days", type=int, default=7)
    parser.add_argument("--as-of", type=dt.datetime.fromisoformat, default=None)
    parser.add_argument(
        "--cluster-defaults",
        action="store_true",
        help="apply ledgerlens.session.CLUSTER_CONF (large-cluster starting points)",
    )
    args = parser.parse_args(argv)
    builder = SparkSession.builder.appName("ledgerlens-daily")
    conf = {**SESSION_CONF, **(CLUSTER_CONF if args.cluster_defaults else {})}
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    result = daily_job(spark, args.input, args.output, args.keep_days, args.as_of)
    failed = [c["check_name"] for c in result["quality_checks"] if not c["passed"]]
    print({"failed_checks": failed, "snapshots": len(result["snapshots"])})
    spark.stop()


if __name__ == "__main__":
    main()
