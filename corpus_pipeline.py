"""Training-data pipeline over ``documents``.

Stages, each on what its predecessor kept: toxic documents go; of each
group of similar documents the one with the smallest id stays (rows are
judged each, whether they share an id or have none); secrets are replaced by
a mark; documents are sampled to the target mix, ``BUDGET`` of the tokens,
with rare cells whole; what remains is tokenised, cut and packed into
sequences.  All stages but the last return the columns of documents, n_chars
counted anew where a text changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import jaccard_join, mixing, packing, secret_scan, toxicity
from ledgerlens.llm.common import small_batches, spill, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
BUDGET = 0.6  # share of the tokens that mixing keeps, whatever the cells


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), F.lit(True))
    return toxicity.score(docs, model, 0.3, COLUMNS).filter("predicted = 0").select(COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A group keeps its row of smallest doc_id, one without doc_id only if no other is there; rows without words stay, repeated ones once."""
    small_batches(spark)
    rows = spill(docs.select(F.monotonically_increasing_id().alias("key"), *COLUMNS), "keyed-documents")
    classes, _ = jaccard_join.join_similar(rows, doc_id="key")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "digest", "lang", "source", "n_chars", "key").alias("row")
    named = rows.withColumn("digest", F.sha2(F.col("text").cast("binary"), 256)).select("key", "doc_id", "digest", order)
    worded = F.col("n_shingles") > 0
    group = (F.when(worded, F.col("component_id")).alias("c"), F.when(~worded, F.col("doc_id")).alias("i"), F.when(~worded, F.col("digest")).alias("d"))
    first = named.join(classes.withColumnRenamed("doc_id", "key"), "key").groupBy(worded, *group).agg(F.min("row").alias("row")).select("row.key")
    return rows.join(first, "key", "left_semi").select(COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(docs, COLUMNS)
    changed = F.size("spans") > 0
    text = F.when(changed, secret_scan.redact(F.col("text"), F.col("spans"))).otherwise(F.col("text"))
    return found.withColumn("text", text).withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, COLUMNS, budget=BUDGET).filter("selected").select(COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return packing.pack(packing.pieces(docs, "byte_bpe_50k.json", end_id=0, capacity=2048, split="lead"), capacity=2048)


STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard_join", drop_near_duplicates),
    ("secret_scan", redact_secrets),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: Noisy-or training, the test battery and the genetic algorithm are not SQL; tests/llm holds each stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = spill(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
