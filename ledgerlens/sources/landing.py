"""Landing-file ingest, partitioned load and snapshots with retention.

All paths are expected on shared storage (``ledgerlens.session.shared_dir``
hands out sub-folders of ``spark.checkpoint.dir``).  Writes are whole-job
commits through Spark's file committer, so a lost executor only re-runs its
tasks.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerlens.sources.manifest import Versions, hadoop_fs

# An empty string and a missing value are told apart; a row that does not fit
# the schema is an error.  Backslashes and line breaks inside text are written
# as \\\\, \\n and \\r, so a line is a row and a file can be read by many tasks.
NULL_TEXT = "\\N"
TEXT_OPTIONS = {
    "csv": {"header": "true", "escape": '"', "nullValue": NULL_TEXT, "mode": "FAILFAST"},
    "json": {"mode": "FAILFAST"},
}
BREAKS = ("escaped", "quoted", "none")
BROKEN = "_broken"


def _text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def escape_breaks(df: DataFrame) -> DataFrame:
    """Text columns with backslashes and line breaks spelt out."""
    out = {}
    for c in _text_columns(df):
        text = F.replace(F.col(c), F.lit("\\"), F.lit("\\\\"))
        out[c] = F.replace(F.replace(text, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))
    return df.withColumns(out) if out else df


def unescape_breaks(df: DataFrame, leave: tuple[str, ...] = ()) -> DataFrame:
    """The inverse of ``escape_breaks``: parts between spelt-out backslashes hold spelt-out line breaks only."""
    out = {}
    for c in _text_columns(df):
        if c not in leave:
            parts = F.split(F.col(c), "\\\\\\\\")
            out[c] = F.array_join(F.transform(parts, lambda x: F.replace(F.replace(x, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))), "\\")
    return df.withColumns(out) if out else df


def text_options(fmt: str, breaks: str = "escaped") -> dict[str, str]:
    """Reader options; ``breaks`` says how CSV text holds line breaks: "escaped" (spelt out, files are split), "quoted" (inside quotes, one task per file) or "none"."""
    if breaks not in BREAKS:
        raise ValueError(f"breaks must be one of {BREAKS}")
    return {**TEXT_OPTIONS.get(fmt, {}), **({"multiLine": "true"} if fmt == "csv" and breaks == "quoted" else {})}


def write_landing(df: DataFrame, path: str, fmt: str = "csv", breaks: str = "escaped") -> None:
    """Drop ``df`` into a landing folder the way an upstream export would."""
    if fmt == "csv" and breaks == "escaped":
        df = escape_breaks(df)
    df.write.mode("overwrite").format(fmt).options(**text_options(fmt, breaks)).save(path)


def landing_ingest(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: StructType | str,
    stream: bool = False,
    out_path: str | None = None,
    checkpoint_path: str | None = None,
    breaks: str = "escaped",
) -> DataFrame:
    """Read a landing folder with a fixed schema (no inference).

    Rows that do not fit the schema fail the read (``FAILFAST``) rather
    than turning into silent NULLs.  With ``stream=True`` the folder is
    ingested incrementally into ``out_path`` (see
    ``ledgerlens.streaming.landing_stream``): only files not seen by
    earlier runs are read.
    """
    if stream:
        from ledgerlens.session import shared_dir
        from ledgerlens.streaming.landing_stream import ingest_available

        return ingest_available(
            spark,
            path,
            fmt,
            schema,
            out_path or shared_dir(spark, "ingested"),
            checkpoint_path or shared_dir(spark, "ingest-checkpoint"),
            breaks=breaks,
        )
    read = spark.read.schema(schema).format(fmt).options(**text_options(fmt, breaks)).load(path)
    return unescape_breaks(read) if fmt == "csv" and breaks == "escaped" else read


def with_broken(schema: StructType | str) -> StructType:
    """``schema`` with a column for the text of lines that don't fit it."""
    fields = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    return StructType([*fields.fields, StructField(BROKEN, StringType())])


def quarantine_options(fmt: str, breaks: str = "escaped", header: bool = True) -> dict[str, str]:
    options = {**text_options(fmt, breaks), "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}
    return {**options, "header": "true" if header else "false"} if fmt == "csv" else options


def tag_broken(raw: DataFrame, unescape: bool) -> DataFrame:
    """Rows read by ``quarantine_options`` with outcome (read or broken) and the file they came from."""
    raw = raw.withColumns({"outcome": F.when(F.col(BROKEN).isNull(), F.lit("read")).otherwise(F.lit("broken")), "file": F.col("_metadata.file_name")})
    return unescape_breaks(raw, (BROKEN, "outcome", "file")) if unescape else raw


def split_outcomes(spark: SparkSession, path: str, schema: StructType | str) -> tuple[DataFrame, DataFrame]:
    """The rows and the broken lines (line, file) of a folder that tagged rows were written to."""
    whole = StructType([*with_broken(schema).fields, StructField("file", StringType()), StructField("outcome", StringType())])
    rows = spark.read.schema(whole).parquet(path)
    good = rows.filter("outcome = 'read'").drop(BROKEN, "file", "outcome")
    return good, rows.filter("outcome = 'broken'").select(F.col(BROKEN).alias("line"), "file")


def ingest_with_quarantine(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: StructType | str,
    out_path: str,
    breaks: str = "escaped",
    header: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Read a landing folder once, keeping lines that don't fit the schema: (rows, broken lines with their file).

    Every line is parsed and written once, under ``out_path/outcome=read``
    or ``outcome=broken``, so rows and broken lines add up to what landed.
    """
    raw = spark.read.schema(with_broken(schema)).format(fmt).options(**quarantine_options(fmt, breaks, header)).load(path)
    tag_broken(raw, fmt == "csv" and breaks == "escaped").write.mode("overwrite").partitionBy("outcome").parquet(out_path)
    return split_outcomes(spark, out_path, schema)


# The landing sub-directories of the original pipeline.
LANDING_SOURCES = ("sales", "customers", "products")


def ingest_landing_sources(
    spark: SparkSession,
    root: str,
    schemas: dict[str, StructType | str],
    fmt: str = "csv",
) -> dict[str, DataFrame]:
    """One typed DataFrame per landing sub-directory (``root/<source>``).

    Only the sources given in ``schemas`` are read, each with its own fixed
    schema; the reads are lazy, so nothing is scanned until used.
    """
    return {
        name: landing_ingest(spark, f"{root.rstrip('/')}/{name}", fmt, schema)
        for name, schema in schemas.items()
    }


def clean_load(df: DataFrame, path: str, partition_by: str) -> None:
    """Write ``df`` as parquet partitioned by ``partition_by``.

    The ``rebalance`` hint clusters rows by the partition column so each
    task writes few partition folders (not tasks x months small files);
    AQE splits a month that holds a third of the data into several
    similar-sized tasks and coalesces tiny ones.
    """
    (
        df.hint("rebalance", partition_by)
        .sortWithinPartitions(partition_by)
        .write.mode("overwrite")
        .partitionBy(partition_by)
        .parquet(path)
    )


def read_loaded(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


# --------------------------------------------------------------- snapshots
SNAPSHOT_COLUMN = "snapshot_date"


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of a top-level partition column: one directory listing, no data read."""
    fs, root = hadoop_fs(spark, path)
    prefix = f"{column}="
    return sorted(
        status.getPath().getName()[len(prefix):]
        for status in fs.listStatus(root)
        if status.isDirectory() and status.getPath().getName().startswith(prefix)
    )


def list_snapshots(spark: SparkSession, path: str) -> list[dt.date]:
    """Snapshot days present under ``path``."""
    return [dt.date.fromisoformat(v) for v in partition_values(spark, path, SNAPSHOT_COLUMN)]


def expire_snapshots(
    spark: SparkSession, path: str, as_of: dt.datetime, keep_days: int = 7
) -> list[dt.date]:
    """Delete snapshots older than ``as_of - keep_days``; return the deleted days."""
    cutoff = as_of.date() - dt.timedelta(days=keep_days)
    fs, root = hadoop_fs(spark, path)
    jvm = spark.sparkContext._jvm
    expired = [d for d in list_snapshots(spark, path) if d < cutoff]
    for d in expired:
        fs.delete(jvm.org.apache.hadoop.fs.Path(root, f"{SNAPSHOT_COLUMN}={d.isoformat()}"), True)
    return expired


def write_snapshot(df: DataFrame, path: str, day: dt.date) -> None:
    """Write the whole table as the snapshot of ``day``, replacing only that
    day's partition; rows with a NULL or future date are part of it."""
    (
        df.withColumn(SNAPSHOT_COLUMN, F.lit(day))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(SNAPSHOT_COLUMN)
        .parquet(path)
    )


def snapshot_retention(
    df: DataFrame,
    path: str,
    as_of: dt.datetime,
    keep_days: int = 7,
    amount_col: str = "total_amount",
) -> DataFrame:
    """Daily snapshot run: write today's snapshot, drop expired ones and
    return rows / total per snapshot still kept."""
    spark = df.sparkSession
    write_snapshot(df, path, as_of.date())
    expire_snapshots(spark, path, as_of, keep_days)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return snapshot_summary(spark, path, schema, amount_col)


def snapshot_summary(spark: SparkSession, path: str, schema: str, amount_col: str) -> DataFrame:
    """Rows and total amount per remaining snapshot."""
    snaps = spark.read.schema(f"{schema}, {SNAPSHOT_COLUMN} DATE").parquet(path)
    return (
        snaps.groupBy(SNAPSHOT_COLUMN)
        .agg(F.count(F.lit(1)).alias("row_count"), F.sum(amount_col).alias("_total"))
        .select(SNAPSHOT_COLUMN, "row_count", F.col("_total").cast("double").alias("total_amount"))
        .orderBy(SNAPSHOT_COLUMN)
    )


def take_snapshot(df: DataFrame, path: str, at: dt.datetime, keep_days: int = 7) -> Versions:
    """Back up the whole table as of the second ``at`` and drop copies older than ``keep_days``.

    Runs of one day stand beside each other, an empty table gives an empty
    copy, and a run that fails leaves the earlier copies as they were.
    """
    versions = Versions(df.sparkSession, path)
    versions.publish(df, at)
    versions.expire(at, keep_days)
    return versions
