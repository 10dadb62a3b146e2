"""Incremental landing ingest with Structured Streaming.

``readStream`` over the landing folder picks up only files it has not seen
(the file source keeps its log in the checkpoint); ``availableNow`` processes
everything present now in bounded micro-batches and stops, which is the
periodic-refresh mode of the original pipeline.  The parquet sink commits
through its own metadata log, so a restarted run neither loses nor
duplicates files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ledgerlens.sources.landing import quarantine_options, split_outcomes, tag_broken, text_options, unescape_breaks, with_broken


def ingest_available(
    spark: SparkSession,
    landing_path: str,
    fmt: str,
    schema: StructType | str,
    out_path: str,
    checkpoint_path: str,
    max_files_per_trigger: int = 1000,
    timeout_s: float | None = None,
    breaks: str = "escaped",
) -> DataFrame:
    """Process every landing file not yet ingested, then return the table.

    Broken rows fail the ingest as they do in the batch path.  With a
    ``timeout_s`` that is too short the stream is stopped and TimeoutError
    raised: files already committed stay, the next run goes on from there.
    """
    stream = (
        spark.readStream.schema(schema)
        .format(fmt)
        .options(**text_options(fmt, breaks))
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(landing_path)
    )
    if fmt == "csv" and breaks == "escaped":
        stream = unescape_breaks(stream)
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start(out_path)
    )
    if not query.awaitTermination(timeout_s) and timeout_s is not None:
        query.stop()
        raise TimeoutError(f"landing files were left after {timeout_s} s")
    if query.exception() is not None:
        raise query.exception()
    return spark.read.schema(schema).parquet(out_path)


def ingest_available_with_quarantine(
    spark: SparkSession,
    landing_path: str,
    fmt: str,
    schema: StructType | str,
    out_path: str,
    checkpoint_path: str,
    max_files_per_trigger: int = 1000,
    breaks: str = "escaped",
    header: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Like ``ingest_available``, but lines that don't fit the schema are kept apart: (rows, broken lines with their file) of all runs so far.

    One sink takes both kinds, in folders by outcome, so a restarted run
    neither loses nor repeats a line of either.
    """
    options = quarantine_options(fmt, breaks, header)
    raw = spark.readStream.schema(with_broken(schema)).format(fmt).options(**options).option("maxFilesPerTrigger", max_files_per_trigger).load(landing_path)
    tagged = tag_broken(raw, fmt == "csv" and breaks == "escaped")
    query = (
        tagged.writeStream.format("parquet")
        .partitionBy("outcome")
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start(out_path)
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return split_outcomes(spark, out_path, schema)
