"""The retail data model over the raw tables.

Three logical tables feed every operator:

* ``sales``    - one row per line item: customer_id, product_id,
  transaction_date (DATE), quantity, total_amount (exact DECIMAL) and, only
  when asked for, region and sales_rep.
* ``orders``   - one row per order: customer_id, transaction_date
  (TIMESTAMP_NTZ), total_amount DECIMAL(20,6).
* ``products`` - the catalogue with profit margin, stock and active flag
  derived deterministically from the part key.

Dimension joins are added only for the columns a query needs, because
Catalyst cannot drop an inner join it has no constraint information about.
Join order is fixed by hand: customer attributes are attached to ``orders``
(4x smaller than ``lineitem``) before the order -> line-item join, so the
line items are shuffled once, on the order key.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions import numeric as N
from ledgerlens.sources.tables import read_table

PRICE = "decimal(18,6)"
RATE = "decimal(9,6)"
LINE_MONEY = f"decimal(29,{N.LINE_SCALE})"
ORDER_MONEY = f"decimal(20,{N.ORDER_SCALE})"
NO_ORDERS = dt.datetime(1970, 1, 1)  # the reporting instant of an empty order table


def line_amount(price: Column, discount: Column) -> Column:
    """Exact net line amount: price * (1 - discount), each at six decimals;
    amounts are rounded once, after they are summed."""
    return (price.cast(PRICE) * (F.lit(1).cast(RATE) - discount.cast(RATE))).cast(LINE_MONEY)


def products_from_part(part: DataFrame) -> DataFrame:
    key = F.col("p_partkey")
    return part.select(
        key.alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        (F.lit(10) + key % 31).cast("double").alias("profit_margin"),
        ((key * 37) % 601).alias("stock_quantity"),
        F.when(key % 10 == 0, F.lit(0)).otherwise(F.lit(1)).alias("is_active"),
    )


@dataclass
class RetailSource:
    """The retail views over the raw tables under ``base``.

    ``as_of`` may be given (the run's reporting instant); otherwise it is the
    latest order timestamp, one scalar computed once per source object (the
    epoch when there are no orders).

    Joins carry no hints: AQE broadcasts a side it has measured to be below
    ``spark.sql.autoBroadcastJoinThreshold`` and splits skewed partitions of
    the others.
    """

    spark: SparkSession
    base: str
    as_of_value: dt.datetime | None = None
    _as_of: dt.datetime | None = field(default=None, repr=False)

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.base, name)

    # ------------------------------------------------------------------ as_of
    def as_of(self) -> dt.datetime:
        """The reporting instant."""
        if self._as_of is None:
            self._as_of = self.as_of_value or (
                self.table("orders").agg(F.max("o_orderdate").alias("m")).first()["m"] or NO_ORDERS
            )
        return self._as_of

    # ------------------------------------------------------------ dimensions
    def regions(self) -> DataFrame:
        """customer_id, region of every customer."""
        return self.customer_region().withColumnRenamed("c_custkey", "customer_id")

    def customer_region(self) -> DataFrame:
        geo = self.table("nation").join(
            F.broadcast(self.table("region")),  # 5 rows by definition
            F.col("n_regionkey") == F.col("r_regionkey"),
        ).select("n_nationkey", "r_name")
        return (
            self.table("customer")
            .select("c_custkey", "c_nationkey")
            # nation x region is a fixed-size table (25 rows): always broadcast
            .join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select(F.col("c_custkey"), F.col("r_name").alias("region"))
        )

    def sales_reps(self) -> DataFrame:
        return self.table("supplier").select(
            F.col("s_suppkey"), F.col("s_name").alias("sales_rep")
        )

    def products(self) -> DataFrame:
        return products_from_part(self.table("part"))

    # ------------------------------------------------------------------ facts
    def orders(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("transaction_date"),
            F.col("o_totalprice").cast(ORDER_MONEY).alias("total_amount"),
        )

    def sales(
        self,
        region: bool = False,
        sales_rep: bool = False,
        since: dt.date | None = None,
        lines: DataFrame | None = None,
    ) -> DataFrame:
        """The line-item facts, of ``lines`` if given; with ``since`` only those
        of orders on or after that day, filtered before the join so that few
        orders join as such."""
        orders = self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        if since is not None:
            orders = orders.filter(F.col("o_orderdate") >= F.lit(since).cast("timestamp_ntz"))
        if region:
            orders = orders.join(
                self.customer_region(), F.col("o_custkey") == F.col("c_custkey"), "left"
            )
        lines = (self.table("lineitem") if lines is None else lines).select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_quantity",
            "l_extendedprice", "l_discount",
        )
        if sales_rep:
            lines = lines.join(self.sales_reps(), F.col("l_suppkey") == F.col("s_suppkey"), "left")
        joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        cols = [
            F.col("o_custkey").alias("customer_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("o_orderdate").cast("date").alias("transaction_date"),
            F.col("l_quantity").alias("quantity"),
            line_amount(F.col("l_extendedprice"), F.col("l_discount")).alias("total_amount"),
        ]
        if region:
            cols.append(F.col("region"))
        if sales_rep:
            cols.append(F.col("sales_rep"))
        return joined.select(*cols)

    def events(self) -> DataFrame:
        return self.table("events")
