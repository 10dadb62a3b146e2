"""Packing of token pieces into few sequences of bounded length.

Documents longer than a sequence are cut; whole-length pieces fill a
sequence each.  The others are dealt by a hash of their row number into
blocks of about ``BLOCK_PIECES``, and a grouping genetic algorithm packs
each block:

* an individual is a set of bins (the groups); its fitness prefers few
  bins, then full ones (mean square of fill);
* crossover takes whole well-filled bins from one parent, removes from the
  other every bin that shares a document with them, and puts the documents
  so displaced back by best fit, longest first;
* mutation breaks up the emptiest bins and a few others and refills them.

Every block evolves on several islands, each a row of a Spark table; after
each round the best individual of an island moves to its neighbour, and
the table is written to the shared folder.  An island rests once its best
needs no more bins than the block's tokens do.  The emptiest bin of each
block, unless it is well filled, gives its pieces back, and these go to the
far fewer blocks of the next level, until one block remains.

Nulls: a null text is empty (the end id alone); a null doc_id is kept.
Repeated rows are documents of their own.  Equal lengths are placed by row
number.  An empty table gives no rows.  Extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import arrow_rows, column, spill, text_slices, use_only
from ledgerlens.llm.tokenise import encoder

SLICE_CHARS = 2_000_000
BLOCK_PIECES = 2048
BLOCK_BINS = 64  # least that a block's tokens would fill, so that levels shrink
ISLANDS = 2
ROUNDS = 2
POPULATION = 4
GENERATIONS = 6
WELL_FILLED = 0.97

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, split: str = "whole", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of at most ``capacity`` ids: only longer documents are cut, and the first piece takes the remainder."""
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use_only("encoder")
        enc = encoder(tokenizer, split)
        end = np.array([end_id], "<u4").tobytes()
        for part, texts in text_slices(batches, "text", SLICE_CHARS):
            out: list[tuple] = []
            for key, ids in zip(column(part, "doc_id").to_pylist(), enc.encode(texts), strict=True):
                data = memoryview(np.frombuffer(ids, enc.dtype).astype("<u4").tobytes() + end)
                n = len(data) // 4
                cuts = [0, *range(n % capacity or capacity, n + 1, capacity)]
                out += [(key, i, a, b - a, zlib.crc32(data[4 * a : 4 * b])) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
            yield arrow_rows(schema, list(zip(*out, strict=True)))

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, PIECE)


class Bins:
    """Bins under construction: members and free space, and for each free space the bins that have it."""

    def __init__(self, capacity: int):
        self.members: list[list[int]] = []
        self.free: list[int] = []
        self.having: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.spaces = 0  # bit s: some bin has s left
        self.capacity = capacity

    def add(self, members: list[int], used: int) -> None:
        self.members.append(members)
        self.free.append(self.capacity - used)
        self._put(len(self.members) - 1)

    def _put(self, k: int) -> None:
        space = self.free[k]
        self.having[space].append(k)
        self.spaces |= 1 << space

    def best_fit(self, item: int, size: int) -> None:
        """Into the fullest bin that still has room, else a new one."""
        fitting = self.spaces >> size
        if not fitting:
            self.add([item], size)
            return
        space = size + (fitting & -fitting).bit_length() - 1
        k = self.having[space].pop()
        if not self.having[space]:
            self.spaces &= ~(1 << space)
        self.members[k].append(item)
        self.free[k] = space - size
        self._put(k)


class Packer:
    """The genetic algorithm on the lengths of one block."""

    def __init__(self, lengths: np.ndarray, capacity: int, seed: int):
        self.lengths, self.capacity = lengths.astype(int).tolist(), capacity
        self.least = -(-int(lengths.sum()) // capacity)
        self.order = np.lexsort((np.arange(len(lengths)), -lengths)).tolist()
        self.place = np.argsort(np.array(self.order)).tolist()
        self.random = np.random.default_rng(seed)

    def used(self, members: list[int]) -> int:
        return sum(map(self.lengths.__getitem__, members))

    def fitness(self, bins: list[list[int]]) -> tuple[int, float]:
        return -len(bins), sum((self.used(b) / self.capacity) ** 2 for b in bins) / max(1, len(bins))

    def refill(self, kept: list[list[int]], displaced: list[int]) -> list[list[int]]:
        out = Bins(self.capacity)
        for b in kept:
            out.add(list(b), self.used(b))
        for i in displaced:
            out.best_fit(i, self.lengths[i])
        return out.members

    def sorted(self, items: list[int]) -> list[int]:
        return sorted(items, key=self.place.__getitem__)

    def first(self, k: int) -> list[list[int]]:
        """Best fit by falling length; further individuals perturb the order."""
        if not k:
            return self.refill([], self.order)
        noise = np.array(self.lengths) * self.random.uniform(1 - 0.05 * k, 1, len(self.lengths))
        return self.refill([], np.argsort(-noise, kind="stable").tolist())

    def cross(self, mother: list[list[int]], father: list[list[int]]) -> list[list[int]]:
        ranked = sorted(father, key=self.used, reverse=True)
        best = ranked[: max(1, len(ranked) // 2)]
        injected = [best[i] for i in np.flatnonzero(self.random.random(len(best)) < 0.5).tolist()] or best[:1]
        inside = {i for b in injected for i in b}
        kept, displaced = [], []
        for b in mother:
            if inside.isdisjoint(b):
                kept.append(b)
            else:
                displaced += [i for i in b if i not in inside]
        return self.refill(injected + kept, self.sorted(displaced))

    def mutate(self, bins: list[list[int]]) -> list[list[int]]:
        ranked = sorted(bins, key=self.used)
        gone = set(range(max(1, len(ranked) // 20))) | set(self.random.integers(0, len(ranked), max(1, len(ranked) // 20)).tolist())
        return self.refill([b for k, b in enumerate(ranked) if k not in gone], self.sorted([i for k in gone for i in ranked[k]]))

    def evolve(self, population: list[list[list[int]]], size: int, generations: int) -> list[list[list[int]]]:
        population = list(population)
        k = 0
        while len(population) < size and not (population and max(map(len, population)) <= self.least):
            population.append(self.first(k))
            k += 1
        population.sort(key=self.fitness, reverse=True)
        for _ in range(generations):
            if len(population[0]) <= self.least:
                break
            a, b = self.random.choice(len(population), 2, replace=len(population) < 2).tolist()
            child = self.mutate(self.cross(population[min(a, b)], population[max(a, b)]))
            population = sorted([*population, child], key=self.fitness, reverse=True)[:size]
        return population


def _bins(labels: np.ndarray) -> list[list[int]]:
    order = np.argsort(labels, kind="stable")
    return [x.tolist() for x in np.split(order, np.flatnonzero(np.diff(labels[order])) + 1)] if len(labels) else []


def _labels(bins: list[list[int]], n: int) -> bytes:
    out = np.empty(n, "<i4")
    for k, b in enumerate(bins):
        out[b] = k
    return out.tobytes()


STATE = "block long, island int, lengths binary, population array<binary>, n_bins long, fitness double"


def _round(state: DataFrame, capacity: int, number: int, population: int, generations: int) -> DataFrame:
    schema = pa.schema([("block", pa.int64()), ("island", pa.int32()), ("lengths", pa.binary()), ("population", pa.list_(pa.binary())), ("n_bins", pa.int64()), ("fitness", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use_only()  # the encoder, which an idle worker would keep through the stages of others
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.frombuffer(row["lengths"], "<i4")
                packer = Packer(lengths, capacity, zlib.crc32(f"{row['block']},{row['island']},{number}".encode()))
                had = [_bins(np.frombuffer(x, "<i4")) for x in row["population"]]
                best = packer.evolve(had, population, generations)
                fit = packer.fitness(best[0])
                yield arrow_rows(schema, [[row["block"]], [row["island"]], [row["lengths"]], [[_labels(b, len(lengths)) for b in best]], [-fit[0]], [fit[1]]])

    return state.select("block", "island", "lengths", "population").mapInArrow(run, STATE)


def _blocks(items: DataFrame, blocks: int) -> DataFrame:
    """One row per block: its pieces, in an order of their own, and their lengths."""
    fields = [c for c in items.columns]
    return items.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks))).groupBy("block").agg(F.sort_array(F.collect_list(F.struct("row", *[c for c in fields if c != "row"]))).alias("items"))


def _pack_level(items: DataFrame, blocks: int, capacity: int, islands: int, rounds: int, population: int, generations: int) -> DataFrame:
    """(block, bin, items, used) of every bin."""
    dealt = spill(_blocks(items, blocks), "packing-blocks")
    to_bytes = pa.schema([("block", pa.int64()), ("lengths", pa.binary())])

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield arrow_rows(to_bytes, [column(batch, "block"), [np.array(x, "<i4").tobytes() for x in column(batch, "length").to_pylist()]])

    state = dealt.select("block", F.col("items.length").alias("length")).mapInArrow(lengths, "block long, lengths binary")
    state = state.select("block", F.explode(F.array(*[F.lit(i) for i in range(islands)])).alias("island"), "lengths", F.array().cast("array<binary>").alias("population"))
    for number in range(rounds):
        if number:
            elite = state.select("block", ((F.col("island") + 1) % islands).alias("island"), F.col("population")[0].alias("migrant"))
            state = state.join(elite, ["block", "island"]).select("block", "island", "lengths", F.concat(F.array("migrant"), "population").alias("population"))
        parts = max(1, min(blocks * islands, 4 * int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
        state = spill(_round(state.repartition(parts, "block", "island"), capacity, number, population, generations), "packing-islands")
    best = state.groupBy("block").agg(F.max_by(F.col("population")[0], F.struct(-F.col("n_bins"), "fitness", -F.col("island"))).alias("labels"))

    label_schema = pa.schema([("block", pa.int64()), ("bin", pa.list_(pa.int32()))])

    def ints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield arrow_rows(label_schema, [column(batch, "block"), [np.frombuffer(x, "<i4") for x in column(batch, "labels").to_pylist()]])

    packed = dealt.join(best.mapInArrow(ints, "block long, bin array<int>"), "block")
    packed = packed.select("block", F.explode(F.arrays_zip("items", "bin")).alias("x")).select("block", "x.bin", "x.items")
    bins = packed.groupBy("block", "bin").agg(F.sort_array(F.collect_list("items")).alias("items"))
    return bins.withColumn("used", F.aggregate("items.length", F.lit(0).cast("long"), lambda a, x: a + x))


def pack(
    parts: DataFrame, capacity: int, block_pieces: int = BLOCK_PIECES, islands: int = ISLANDS, rounds: int = ROUNDS, population: int = POPULATION, generations: int = GENERATIONS
) -> DataFrame:
    """``parts`` (with a column ``length`` from 1 to ``capacity``) with sequence_id and offset."""
    names = parts.columns
    rows = spill(parts.withColumn("row", F.monotonically_increasing_id()), "packing-pieces")
    whole = rows.filter(F.col("length") == capacity)
    out = [whole.select(*names, (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    items, level = rows.filter(F.col("length") < capacity), 0
    while True:
        n, tokens = items.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
        if not n:
            break
        blocks = max(1, min(-(-n // block_pieces), tokens // (BLOCK_BINS * capacity)))
        bins = spill(_pack_level(items, blocks, capacity, islands, rounds, population, generations), "packing-bins")
        emptiest = bins.groupBy("block").agg(F.min(F.struct("used", "bin")).alias("least"))
        freed = (F.col("bin") == F.col("least.bin")) & (F.col("used") < WELL_FILLED * capacity) & F.lit(blocks > 1)
        bins = bins.join(emptiest, "block").withColumn("freed", freed)
        done = bins.filter(~F.col("freed"))
        number = F.lit(level).cast("long") * F.lit(1 << 56) + F.col("block") * F.lit(1 << 24) + F.col("bin")
        ends = F.aggregate("items.length", F.array(F.lit(0).cast("long")), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
        placed = done.select(number.alias("sequence_id"), F.explode(F.arrays_zip("items", F.slice(ends, 1, F.size("items")).alias("offset"))).alias("x"))
        out.append(placed.select(*[F.col(f"x.items.{c}").alias(c) for c in names], "sequence_id", F.col("x.offset").alias("offset")))
        if blocks == 1:
            break
        items, level = bins.filter("freed").select(F.explode("items").alias("x")).select("x.*"), level + 1
    result = out[0]
    for more in out[1:]:
        result = result.unionByName(more)
    return result
