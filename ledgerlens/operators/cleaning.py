"""ETL cleaning steps: de-duplication, missing values, validation, enrichment.

The original pipeline only describes these in prose; the definitions here
are ours and documented per function.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import dates as D
from ledgerlens.functions import numeric as N
from ledgerlens.sources.manifest import hadoop_fs


def dedupe_transactions(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep one row per key: the first by ``order``, then by every other column.

    Written as ``min(struct(order..., rest...))`` per key rather than a
    ``row_number`` window: the aggregate is combined map-side, so a key that
    holds a third of all rows never lands whole in one task, and the choice
    is deterministic (unlike ``dropDuplicates``).
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    picked = df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_first"))
    return picked.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in order + rest]).select(
        *df.columns
    )


def fill_missing(df: DataFrame, fills: dict, required: list[str]) -> DataFrame:
    """Drop rows missing a required column, then fill defaults for measures."""
    out = df.na.drop(how="any", subset=required) if required else df
    return out.na.fill(fills) if fills else out


def validate_split(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Tag each row with ``is_valid`` and ``reject_reason``.

    ``rules`` maps a rule name to a condition valid rows satisfy; a NULL
    condition counts as a failure.  ``reject_reason`` lists the failed rule
    names joined by ';' (empty for valid rows).  Use ``valid_rows`` /
    ``rejected_rows`` to split.
    """
    failed = [F.when(~F.coalesce(cond, F.lit(False)), F.lit(name)) for name, cond in rules.items()]
    reason = F.concat_ws(";", *failed)
    return df.withColumns({"reject_reason": reason}).withColumn(
        "is_valid", F.col("reject_reason") == F.lit("")
    )


def valid_rows(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col("is_valid")).drop("is_valid", "reject_reason")


def rejected_rows(tagged: DataFrame) -> DataFrame:
    return tagged.filter(~F.col("is_valid"))


MAX_AMOUNT = 10000  # fixed value: largest plausible sale


def sales_rules(as_of, max_amount: int = MAX_AMOUNT) -> dict[str, Column]:
    """Default validation rules for line-item sales."""
    return {
        "missing_customer": F.col("customer_id").isNotNull(),
        "missing_product": F.col("product_id").isNotNull(),
        "missing_date": F.col("transaction_date").isNotNull(),
        "future_date": F.col("transaction_date") <= F.lit(as_of.date()),
        "non_positive_quantity": F.col("quantity") > 0,
        "negative_amount": F.col("total_amount") >= 0,
        "amount_over_limit": F.col("total_amount") <= max_amount,
    }


def load_sales(tagged: DataFrame, products: DataFrame, path: str) -> tuple[str, str]:
    """Load a validated table: its rows, enriched, are written once under
    ``path`` by outcome and month, rejected ones with their reasons.  Returns
    the folders of loaded and rejected rows."""
    root = path.rstrip("/")
    outcome = F.when(F.col("is_valid"), F.lit("loaded")).otherwise(F.lit("rejected")).alias("outcome")
    rows = enrich_metrics(tagged, products, (outcome, F.col("reject_reason")))
    rows = rows.hint("rebalance", "outcome", "year_month").sortWithinPartitions("outcome", "year_month")
    rows.write.mode("overwrite").partitionBy("outcome", "year_month").parquet(root)
    fs, _ = hadoop_fs(tagged.sparkSession, root)
    folders = (f"{root}/outcome=loaded", f"{root}/outcome=rejected")
    for folder in folders:  # there even if no row has that outcome
        fs.mkdirs(hadoop_fs(tagged.sparkSession, folder)[1])
    return folders


def enrich_metrics(sales: DataFrame, products: DataFrame, more: tuple[Column, ...] = ()) -> DataFrame:
    """Line-level derived metrics: month, unit price, margin and profit.

    ``estimated_profit`` = round(amount * margin / 100, 2) in exact decimal;
    sales without a catalogue row keep NULL margin and profit.  ``more``
    are columns of ``sales`` that come along.
    """
    margins = products.select("product_id", "profit_margin")
    joined = sales.join(margins, "product_id", "left")
    return joined.select(
        "customer_id",
        "product_id",
        "transaction_date",
        D.year_month("transaction_date").alias("year_month"),
        "quantity",
        N.as_double("total_amount").alias("total_amount"),
        F.try_divide(N.as_double("total_amount"), F.col("quantity")).alias("unit_price"),
        "profit_margin",
        N.percent_of_line("total_amount", "profit_margin").cast("double").alias("estimated_profit"),
        *more,
    )
