"""Facts laid out along an interleaved-bit curve, with parquet Bloom filters.

A table sorted by date skips row groups for date windows only.  Here each
clustering column is cut into ranges of about equal numbers of rows, the bits
of the range numbers are interleaved into one code, and the rows are range
partitioned and sorted by it.  A row group then covers a small box of dates,
products and customers, so a filter on any of them skips row groups by
their minimum and maximum.  Where a box still spans a wanted key, the row
group's Bloom filter tells whether the key is there.

``write_clustered`` reads its input three times (range borders, the sample of
the range partitioning, the rows), so give it a written table.
``ClusteredSource`` is a ``WarehouseSource`` whose sales come from that layout.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions import dates as D
from ledgerlens.sources.warehouse import PARTITION, SALES_SCHEMA, WarehouseSource

CLUSTER_BY = ("transaction_date", "product_id", "customer_id")
BLOOM = ("product_id", "customer_id")
BITS = 6  # 64 ranges a column
ROW_GROUP_BYTES = 32 << 20  # smaller groups skip more and cost more footers
ACCURACY = 10_000  # of the borders: ranks are off by at most rows / ACCURACY
_CODE, _SPREAD = "_code", "_spread"


def _ordered(df: DataFrame, name: str) -> Column:
    """The column as a number in its own order."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(name)
    if isinstance(kind, T.TimestampNTZType | T.TimestampType):
        return F.unix_micros(F.col(name).cast("timestamp"))
    if isinstance(kind, T.NumericType):
        return F.col(name)
    raise ValueError(f"{name}: clustering columns are numbers, dates or timestamps, not {kind.simpleString()}")


def range_borders(df: DataFrame, by: Sequence[str], bits: int = BITS) -> dict[str, list]:
    """Per column the distinct lower borders of all ranges but the first: at
    most 2^bits - 1 values, from one aggregation.  A value that holds many
    rows takes one border; an empty or all-null column has none."""
    parts = 1 << bits
    shares = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    row = df.agg(*[F.percentile_approx(_ordered(df, c), shares, ACCURACY).alias(f"b{i}") for i, c in enumerate(by)]).first()
    return {c: sorted(set(row[f"b{i}"] or ())) for i, c in enumerate(by)}


def _spaced(number: int, bits: int, stride: int, offset: int) -> int:
    """The bits of ``number``, ``stride`` places apart."""
    return sum((number >> b & 1) << (b * stride + offset) for b in range(bits))


def curve_code(df: DataFrame, borders: dict[str, list], bits: int = BITS) -> Column:
    """The interleaved code of a row.  Per column a balanced tree of
    comparisons finds the range; its leaves already hold the spaced bits.
    Nulls lie in the first range."""
    stride = len(borders)
    if stride * bits > 62:
        raise ValueError("the interleaved code has at most 62 bits")

    def tree(value: Column, cuts: list, low: int, high: int, offset: int) -> Column:
        if low == high:  # few ranges are drawn apart over all bits
            return F.lit(_spaced((low << bits) // (len(cuts) + 1), bits, stride, offset)).cast("long")
        mid = (low + high) // 2
        return F.when(value >= F.lit(cuts[mid]), tree(value, cuts, mid + 1, high, offset)).otherwise(tree(value, cuts, low, mid, offset))

    def column(offset: int, name: str) -> Column:
        cuts = borders[name]
        numbered = F.coalesce(_ordered(df, name), F.lit(cuts[0] - 1)) if cuts else F.lit(0)
        return tree(numbered, cuts, 0, len(cuts), offset)

    codes = [column(i, name) for i, name in enumerate(borders)]
    return reduce(Column.bitwiseOR, codes)


def write_clustered(
    df: DataFrame,
    path: str,
    by: Sequence[str] = CLUSTER_BY,
    bloom: Sequence[str] = BLOOM,
    bits: int = BITS,
    row_group_bytes: int = ROW_GROUP_BYTES,
) -> None:
    """Write ``df`` along the curve over ``by``, with Bloom filters on ``bloom``.

    The number of files follows the size (AQE joins small range partitions).
    Rows of one box are told apart by a hash of the whole row, so a box with a
    third of the rows goes to several files, and a repeated task deals its
    rows alike."""
    code = curve_code(df, range_borders(df, by, bits), bits)
    keyed = df.withColumns({_CODE: code, _SPREAD: F.xxhash64(*df.columns)})
    placed = keyed.repartitionByRange(_CODE, _SPREAD).sortWithinPartitions(_CODE, *by).drop(_CODE, _SPREAD)
    writer = placed.write.mode("overwrite").option("parquet.block.size", row_group_bytes)
    for name in bloom:  # sized by the values that a row group really has
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
    if bloom:
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    writer.parquet(path)


def cluster_sales(warehouse: WarehouseSource, path: str, **layout) -> "ClusteredSource":
    """Lay the warehouse's sales out under ``path``; returns a source over them."""
    sales = warehouse.sales(region=True, sales_rep=True)
    write_clustered(sales, path, **layout)
    return ClusteredSource(warehouse.spark, warehouse.root, as_of_value=warehouse.as_of_value, clustered=path)


@dataclass
class ClusteredSource(WarehouseSource):
    """A warehouse whose sales lie along the curve."""

    clustered: str = ""

    def sales(
        self,
        region: bool = False,
        sales_rep: bool = False,
        since: dt.date | None = None,
        products: Sequence[int] | None = None,
        customers: Sequence[int] | None = None,
    ) -> DataFrame:
        """The sales; ``since``, ``products`` and ``customers`` reach the scan
        as pushed filters (key lists of moderate length: they are literals)."""
        stored = [f for f in T._parse_datatype_string(SALES_SCHEMA).fields if f.name != PARTITION]
        sales = self.spark.read.schema(T.StructType(stored)).parquet(self.clustered)
        if since is not None:
            sales = sales.filter(D.on_or_after("transaction_date", since))
        for name, wanted in (("product_id", products), ("customer_id", customers)):
            if wanted is not None:
                sales = sales.filter(F.col(name).isin(*wanted))
        cols = ["customer_id", "product_id", "transaction_date", "quantity", "total_amount"]
        return sales.select(*cols, *["region"] * region, *["sales_rep"] * sales_rep)


__all__ = ["ClusteredSource", "cluster_sales", "curve_code", "range_borders", "write_clustered"]
