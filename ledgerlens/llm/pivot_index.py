"""Near-duplicate vectors by a pivot-permutation index.

1. Classes.  Equal vectors (ended by zeros where shorter) are one class
   with a count, so a large group of copies is one row of the index.
2. Pivots.  From a sample of ``SAMPLE`` classes, chosen by hash, those are
   taken one by one that lie apart from the earlier ones, ``PIVOTS`` at
   most: a dense group gives one pivot, not many that crowd out others.
3. Permutations.  Every class is described by its ``NEAREST`` nearest
   pivots in order.  Two vectors are candidates if they share at least
   ``SHARED`` of these.
4. Inverted lists.  Pivots are ranked by how rarely they occur.  Classes
   that share s of L pivots share j among the first L - s + j of either,
   by rank, so lists are kept for the j-subsets of these only; j grows with
   the table, so that lists stay short.  A pair is taken from the list of
   its first j shared pivots, and from no other.
5. Counting and checking.  In a list, the product of the classes' pivot
   incidences counts shared pivots; candidates are verified by their cosine
   in double precision.  Lists send sums of links and a spanning forest of
   what they linked, not pairs.  Lists of more than ``LIST_ROWS`` rows are
   dealt over tasks by pairs of parts.

The index is fit on the sample; every row is indexed and no list is cut.

Nulls: vectors that are null, zero, or hold null or non-finite components
link with nothing, and each is its own component.  A row without vec_id
takes part, but names a component only where that has no id.  Repeated
rows link with each other.  An empty table gives no rows.  Extra columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from ledgerlens.llm.common import arrow_rows, column, dealt_in_pairs, spill
from ledgerlens.llm.jaccard_join import components

COSINE = 0.95
SAMPLE = 4096
PIVOTS = 512
APART = (0.5, 0.7, 0.85, 0.95, 0.99, 0.999, 2.0)  # cosines below which a pivot lies apart; the first that gives enough pivots
NEAREST = 12
SHARED = 4
LIST_ROWS = 2048
CHECKED = 20_000  # candidate pairs multiplied at a time


def _lists(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Components one after another (null: not a number), lengths, and which rows are null."""
    lengths = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(col), 0)).astype(np.int64)
    flat = np.asarray(pa.compute.fill_null(col.flatten().cast(pa.float64()), float("nan")))
    return flat, lengths, np.asarray(pa.compute.is_null(col))


def keyed(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """vec_id, key (of equal vectors; null if the vector takes no part), v."""
    single = isinstance(vectors.schema[vector].dataType, ArrayType) and isinstance(vectors.schema[vector].dataType.elementType, FloatType)
    dtype, kind = (np.float32, "float") if single else (np.float64, "double")
    schema = pa.schema([("vec_id", pa.int64()), ("key", pa.binary()), ("v", pa.list_(pa.from_numpy_dtype(dtype)))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, lengths, null = _lists(column(batch, "v"))
            ends = np.cumsum(lengths)
            flat = (flat + 0.0).astype(dtype)  # one zero
            keys, kept = [], []
            for a, b, no in zip((ends - lengths).tolist(), ends.tolist(), null.tolist(), strict=True):
                some = np.flatnonzero(flat[a:b])
                good = not no and len(some) and np.isfinite(flat[a:b]).all()
                v = flat[a : a + some[-1] + 1] if good else None
                keys.append(hashlib.blake2b(v.tobytes(), digest_size=16).digest() if good else None)
                kept.append(v)
            yield arrow_rows(schema, [column(batch, "vec_id"), keys, kept])

    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("v"))
    return rows.mapInArrow(run, f"vec_id long, key binary, v array<{kind}>")


def unit_rows(col: pa.Array, width: int) -> np.ndarray:
    """Vectors of length one, ended by zeros."""
    flat, lengths, _ = _lists(col)
    out = np.zeros((len(lengths), width))
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    out /= np.abs(out).max(axis=1, initial=0, keepdims=True)  # no square over- or underflows
    return out / np.sqrt((out * out).sum(axis=1, keepdims=True))


def pick_pivots(sample: np.ndarray, most: int, nearest: int) -> np.ndarray:
    """At most ``most`` of the unit vectors, each apart from those before it: a sixteenth of them, or twice ``nearest``, are enough."""
    enough = min(most, len(sample), max(2 * nearest, len(sample) // 16))
    found = sample[:0]
    for bound in APART:
        kept: list[int] = []
        for i in range(len(sample)):
            if len(kept) < most and (not kept or (sample[kept] @ sample[i]).max() < bound):
                kept.append(i)
        if len(kept) > len(found):
            found = sample[kept]
        if len(found) >= enough:
            break
    return found


def nearest_pivots(rows: np.ndarray, pivots: np.ndarray, nearest: int) -> np.ndarray:
    """The numbers of each row's nearest pivots, the nearest first; ties to the lesser number."""
    return np.argsort(-(rows @ pivots.T), axis=1, kind="stable")[:, :nearest]


def _subsets(n_rows: int, pivots: int, nearest: int, shared: int) -> int:
    """Pivots that name a list: so many that the mean list is no longer than ``LIST_ROWS``."""
    for j in range(1, shared + 1):
        if n_rows * comb(nearest - shared + j, j) <= LIST_ROWS * comb(pivots, j):
            return j
    return shared


def link_list(ranks: np.ndarray, units: np.ndarray, side: np.ndarray, last: int, together: int, shared: int, n_pivots: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of the linked pairs of one list.  ``side``: pairs are of different sides only, if there are two."""
    incidence = np.zeros((len(ranks), n_pivots), np.float32)
    np.put_along_axis(incidence, ranks, 1, axis=1)
    low = incidence[:, : last + 1]
    a, b = (np.flatnonzero(side == k) for k in (0, 1)) if side.any() and not side.all() else (np.arange(len(ranks)),) * 2
    ok = (incidence[a] @ incidence[b].T >= shared) & (low[a] @ low[b].T == together)
    x, y = np.nonzero(ok if a is not b else np.triu(ok, 1))
    x, y = a[x], b[y]
    keep = np.zeros(len(x), bool)
    for i in range(0, len(x), CHECKED):
        keep[i : i + CHECKED] = np.einsum("ij,ij->i", units[x[i : i + CHECKED]], units[y[i : i + CHECKED]]) >= cosine
    return x[keep], y[keep]


def forest(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For each of ``n`` places the least place that the pairs connect it with."""
    root = np.arange(n)
    while True:
        before = root.copy()
        np.minimum.at(root, x, root[y])
        np.minimum.at(root, y, root[x])
        root = root[root]
        if (root == before).all():
            return root


_POSTED = pa.schema([("list", pa.binary()), ("cid", pa.int64()), ("m", pa.int64()), ("ranks", pa.binary()), ("v", pa.binary())])


def near_vectors(vectors: DataFrame, cosine: float = COSINE, pivots: int = PIVOTS, nearest: int = NEAREST, shared: int = SHARED, vec_id: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """Rows with their component, and the index's permutations.

    First: vec_id, n_links (other rows linked directly), component_id (the smallest vec_id that links reach, its own included).  Second: cid, m (rows of the class), pivots (the nearest first).
    """
    spark = vectors.sparkSession
    rows = spill(keyed(vectors, vec_id, vector), "keyed-vectors")
    classes = rows.filter("key is not null").groupBy("key").agg(F.count("*").alias("m"), F.min("vec_id").alias("least"), F.first("v").alias("v"))
    classes = spill(classes.select(F.monotonically_increasing_id().alias("cid"), "*"), "vector-classes")
    n, width = classes.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(1))).first()
    sample = classes.orderBy(F.xxhash64("key"), "key").limit(SAMPLE).select("v").toArrow()  # bounded
    points = pick_pivots(unit_rows(sample["v"].combine_chunks(), width), pivots, nearest) if n else np.zeros((0, width))
    nearest = max(1, min(nearest, len(points)))
    shared = max(1, min(shared, nearest // 3)) if nearest < NEAREST else min(shared, nearest)
    described = pa.schema([("cid", pa.int64()), ("m", pa.int64()), ("pivots", pa.list_(pa.int32())), ("v", pa.binary())])

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = column(batch, "v")
            units = unit_rows(col, width)
            exact = units.astype("<f8")
            near = nearest_pivots(units, points, nearest).astype(np.int32)
            yield arrow_rows(described, [column(batch, "cid"), column(batch, "m"), list(near), [x.tobytes() for x in exact]])

    permutations = spill(classes.select("cid", "m", "v").mapInArrow(describe, "cid long, m long, pivots array<int>, v binary"), "pivot-permutations")
    times = permutations.select(F.explode("pivots").alias("p")).groupBy("p").count().collect()  # a row per pivot
    often = np.zeros(max(1, len(points)), np.int64)
    for r in times:
        often[r["p"]] = r["count"]
    rank_of = np.empty(len(often), np.int64)
    rank_of[np.lexsort((np.arange(len(often)), often))] = np.arange(len(often))
    together = _subsets(n, len(often), nearest, shared)
    ways = np.array(list(combinations(range(nearest - shared + together), together)), np.int64)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            near = np.stack(column(batch, "pivots").to_pylist()).astype(np.int64)
            ranks = np.sort(rank_of[near], axis=1)
            names = ranks[:, ways].astype(">u2").reshape(-1, together)  # rows x ways
            who = pa.array(np.repeat(np.arange(len(ranks)), len(ways)))
            coded = pa.array([x.tobytes() for x in ranks.astype("<u2")], pa.binary())
            yield arrow_rows(_POSTED, [[x.tobytes() for x in names], column(batch, "cid").take(who), column(batch, "m").take(who), coded.take(who), column(batch, "v").take(who)])

    posted = permutations.mapInArrow(post, "list binary, cid long, m long, ranks binary, v binary")
    dealt = dealt_in_pairs(posted, ["list"], "cid", LIST_ROWS)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    made = pa.schema([("cid", pa.int64()), ("n", pa.int64()), ("root", pa.int64())])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def finish(name: tuple, held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held)
            if table.num_rows < 2:
                return
            cid, m, side = (table[c].to_numpy() for c in ("cid", "m", "side"))
            ranks = np.frombuffer(b"".join(table["ranks"].to_pylist()), "<u2").reshape(len(cid), nearest).astype(np.int64)
            units = np.frombuffer(b"".join(table["v"].to_pylist()), "<f8").reshape(len(cid), width)
            if name[1] != name[2] and not (side.any() and not side.all()):
                return
            x, y = link_list(ranks, units, side, int.from_bytes(name[0][-2:], "big"), together, shared, len(often), cosine)
            if len(x):
                n_links = np.bincount(x, m[y], len(cid)).astype(np.int64) + np.bincount(y, m[x], len(cid)).astype(np.int64)
                some = np.flatnonzero(n_links)
                yield arrow_rows(made, [cid[some], n_links[some], cid[forest(len(cid), x, y)[some]]])

        name, held = None, []
        for batch in batches:
            keys = list(zip(*(column(batch, c).to_pylist() for c in ("list", "lo", "hi")), strict=True))
            at = 0
            for i in [k for k in range(1, len(keys)) if keys[k] != keys[k - 1]] + [len(keys)]:
                if i == at:
                    continue
                if keys[at] != name and held:
                    yield from finish(name, held)
                    held = []
                name = keys[at]
                held.append(batch.slice(at, i - at))
                at = i
        if held:
            yield from finish(name, held)

    sorted_lists = dealt.repartition(parts, "list", "lo", "hi").sortWithinPartitions("list", "lo", "hi")
    linked = spill(sorted_lists.mapInArrow(link, "cid long, n long, root long"), "list-links")
    sums = linked.groupBy("cid").agg(F.sum("n").alias("n"))
    comps = components(linked.filter("cid != root").select(F.col("cid").alias("s"), F.col("root").alias("pivot"))).withColumnRenamed("s", "cid")
    named = classes.select("cid", "key", "m", "least").join(sums, "cid", "left").join(comps, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
    least = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    of_key = named.join(least, "comp").select("key", (F.col("m") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), "component_id")
    full = rows.select("vec_id", "key").filter("key is not null").join(of_key, "key").select("vec_id", "n_links", "component_id")
    alone = rows.filter("key is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return full.unionByName(alone), permutations.select("cid", "m", "pivots")
