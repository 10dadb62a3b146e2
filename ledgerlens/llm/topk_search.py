"""Exact top-k by inner product, with buckets of vectors of like length.

Rows are dealt by length (descending) into ranges, and each range is cut
into buckets of at most ``BUCKET_ROWS`` vectors.  A query's running k-th
best score, first taken from a bounded set of the longest vectors, becomes
a local cosine threshold in each bucket: threshold / (query's length times
the bucket's greatest length).  Above 1 the bucket is skipped.  A low
threshold prunes by length: only the bucket's vectors that are long enough
for the query are multiplied.  A high one prunes by coordinate: in the
query's largest coordinates, a unit vector within the threshold's angle
must lie in an interval.  Survivors are verified by their exact products.

Queries are written to the shared folder in blocks, and a task reads one
block at a time; at no place do all queries, or all pairs, come together.

Nulls: vectors that are null, or hold null or non-finite components, and
rows without vec_id take no part.  Shorter vectors count as ended by
zeros.  A query's own rows are all with its vec_id; of repeated query ids,
the least vector is searched once; repeated candidates each take a rank.
Ties go to the smaller vec_id.  An empty table gives no rows.  Extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import arrow_rows, column, filesystem, spill, write_file
from ledgerlens.session import shared_dir

BUCKET_ROWS = 2048
RANGE_ROWS = 65_536
QUERY_ROWS = 256
SEED_ROWS = 1024
COORDINATES = 3  # looked at per query
COSINE = 0.6  # local threshold from which on coordinates prune
SLACK = 1e-9


def clean(vectors: DataFrame, value, vec_id: str, vector: str) -> DataFrame:
    """vec_id, v (doubles, transformed by ``value``) and length of the rows that take part."""
    bad = F.exists(F.col(vector), lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    rows = vectors.filter(F.col(vec_id).isNotNull() & F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(True)))
    rows = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.transform(F.col(vector), lambda x: value(x.cast("double")).cast("double")).alias("v"))
    return rows.withColumn("length", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)))


def matrix(rows: pa.Array, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width))
    flat, ends = np.asarray(rows.flatten()), np.cumsum(np.asarray(pa.compute.list_value_length(rows)))
    if len(flat) == out.size:
        return flat.reshape(out.shape)
    for i, (a, b) in enumerate(zip([0, *ends.tolist()], ends.tolist(), strict=False)):
        out[i, : b - a] = flat[a:b]
    return out


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(scores) > 4 * k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= cut)
        return some[np.lexsort((ids[some], -scores[some]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def bucket_search(q: np.ndarray, size: float, bucket: "Bucket", least: float) -> np.ndarray:
    """Places of the bucket's vectors that may score ``least`` or more."""
    if not size or not bucket.lengths[0]:
        return np.arange(len(bucket.lengths)) if least <= 0 else np.zeros(0, np.int64)
    local = least / (size * bucket.lengths[0])
    if local > 1 + SLACK:
        return np.zeros(0, np.int64)
    if local < COSINE:  # by length
        reach = int(np.searchsorted(-bucket.lengths, -(least / size) * (1 - SLACK) + SLACK, side="right")) if least > 0 else len(bucket.lengths)
        return np.arange(reach)
    unit, local = q / size, min(local, 1.0)
    keep = bucket.lengths > 0
    for f in np.argsort(-np.abs(unit), kind="stable")[:COORDINATES].tolist():
        # unit vectors p with p.unit >= local: p_f lies about unit_f * local, and up to the pole if the cap holds it
        wide = np.sqrt(max(0.0, 1 - unit[f] ** 2) * (1 - local**2)) + 1e-7
        low = -2.0 if unit[f] <= -local else unit[f] * local - wide
        high = 2.0 if unit[f] >= local else unit[f] * local + wide
        keep &= (bucket.unit[:, f] >= low) & (bucket.unit[:, f] <= high)
    return np.flatnonzero(keep)


class Bucket:
    def __init__(self, ids: np.ndarray, rows: np.ndarray, lengths: np.ndarray):
        self.ids, self.rows, self.lengths = ids, rows, lengths
        self.unit = rows / np.maximum(lengths, 1e-300)[:, None]


def search(vectors: DataFrame, is_query: Column, k: int, value=lambda x: x, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score (double) of each query's k highest inner products."""
    spark = vectors.sparkSession
    rows = spill(clean(vectors, value, vec_id, vector), "search-vectors")
    n, width = rows.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(1))).first()
    width = max(width, 1)
    seed = rows.orderBy(F.desc("length"), "vec_id", "v").limit(SEED_ROWS).toPandas()
    seed_ids = seed["vec_id"].to_numpy(np.int64)
    seed_rows = np.zeros((len(seed), width))
    for i, x in enumerate(seed["v"]):
        seed_rows[i, : len(x)] = x
    folder = shared_dir(spark, "search-queries")
    queries = rows.filter(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        number = 0
        for batch in batches:
            for at in range(0, batch.num_rows, QUERY_ROWS):
                ids = np.asarray(column(batch, "vec_id"))[at : at + QUERY_ROWS]
                q = matrix(column(batch, "v").slice(at, QUERY_ROWS), width)
                scores = q @ seed_rows.T
                scores[ids[:, None] == seed_ids[None, :]] = -np.inf
                least = np.sort(scores, axis=1)[:, -k] if scores.shape[1] >= k else np.full(len(q), -np.inf)
                name = f"queries-{part:06d}-{number:06d}"
                write_file(folder, name, [np.array([len(ids)], "<i8").tobytes(), ids.astype("<i8").tobytes(), least.astype("<f8").tobytes(), q.astype("<f8").tobytes()])
                number += 1
                yield pa.RecordBatch.from_pydict({"file": [name]})

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    files = spill(queries.repartition(max(1, min(parts, n // RANGE_ROWS + 1)), "vec_id").sortWithinPartitions("vec_id").mapInArrow(write, "file string"), "search-query-files")
    names = sorted(r["file"] for r in files.collect())  # names only, one for QUERY_ROWS queries
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [(np.asarray(column(b, "vec_id")), matrix(column(b, "v"), width), np.asarray(column(b, "length"))) for b in batches if b.num_rows]
        if not got:
            return
        ids, vectors_, lengths = (np.concatenate([g[i] for g in got]) for i in range(3))
        buckets = [Bucket(ids[a : a + BUCKET_ROWS], vectors_[a : a + BUCKET_ROWS], lengths[a : a + BUCKET_ROWS]) for a in range(0, len(ids), BUCKET_ROWS)]
        store, base = filesystem(folder)
        for name in names:
            with store.open_input_stream(f"{base}/{name}") as f:
                data = f.read()
            m = int(np.frombuffer(data, "<i8", 1)[0])
            q_ids, least = np.frombuffer(data, "<i8", m, 8), np.frombuffer(data, "<f8", m, 8 + 8 * m)
            q = np.frombuffer(data, "<f8", m * width, 8 + 16 * m).reshape(m, width)
            sizes = np.sqrt((q * q).sum(axis=1))
            out: list[tuple] = []
            for i in range(m):
                bound, found, scores = float(least[i]), np.zeros(0, np.int64), np.zeros(0)
                for bucket in buckets:
                    at = bucket_search(q[i], float(sizes[i]), bucket, bound)
                    at = at[bucket.ids[at] != q_ids[i]]
                    if not len(at):
                        continue
                    product = bucket.rows[at] @ q[i]  # exact: integers below 2^53, or plain doubles
                    found, scores = np.concatenate([found, bucket.ids[at]]), np.concatenate([scores, product])
                    top = best(found, scores, k)
                    found, scores = found[top], scores[top]
                    if len(top) == k:
                        bound = max(bound, float(scores[-1]))
                keep = scores >= least[i] - SLACK * sizes[i] * lengths.max()  # the seed's products may be rounded otherwise
                if keep.any():
                    out.append((np.full(keep.sum(), q_ids[i]), found[keep], scores[keep]))
            if out:
                yield arrow_rows(schema, [np.concatenate([o[j] for o in out]) for j in range(3)])

    ranges = max(1, -(-n // RANGE_ROWS), min(parts, -(-n // BUCKET_ROWS)))
    dealt = rows.repartitionByRange(ranges, F.desc("length"), "vec_id").sortWithinPartitions(F.desc("length"), "vec_id")
    found = dealt.mapInArrow(run, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
