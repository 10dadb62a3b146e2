"""Exact join of documents on the Jaccard similarity of their word n-grams.

The join is the product of the sparse document by n-gram incidence matrix
with its transpose, in blocks of n-grams, cut down by size-derived bounds:

1. Sets.  A document's row is the set of its n-gram hashes (64 bits); equal
   sets are one row, named by a hash of the set.
2. First components.  Rows with an equal least n-gram, under each of a few
   orders, are checked against one of them.  Most copies are in one
   component from then on, and what a component shares only with itself
   needs no further work; nothing is ruled out by this step.
3. Columns that can matter.  With a similarity of at least t, two sets of
   sizes a <= b need a >= t b, and their first n - ceil(t n) + 1 n-grams in
   any common order share one; of the smaller set it is even among the first
   n - ceil(2 t / (1 + t) n) + 1.  The order puts n-grams first that repeat
   rarely (a table of bounded size holds rounded counts of all n-grams), so
   that passages of many documents stay out of the prefixes; n-grams that
   occur in one set only fill places there, but are sent nowhere.
4. Blocks.  Prefix postings go to shards by n-gram; a shard keeps the
   columns that touch two components or more.
5. Products.  Pairs of a column are checked against the exact overlap of
   their sets: first every row with the column's pivot; then, in columns
   that still touch several components, with another pivot, for as long as
   that unites something worth while; last all pairs of different components
   that the size bound, the triangle inequality for Jaccard distances (to
   the first pivot) and a bitmap of the sets leave (bits that differ are
   n-grams that differ, so they bound the overlap).  Pairs inside a component are never formed, so a
   large group of copies costs a few checks per copy, and no link between
   components is lost.
6. Components of the links by label propagation with shortcuts.

Nulls: a null text has the empty set, which links with nothing; a null
doc_id takes part, but names a component only where it has no other id.
Repeated rows share a set.  An empty table gives no rows.  Extra columns
are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import token_files
from ledgerlens.llm.common import arrow_rows, bitmap, column, dealt_in_pairs, give_back, in_bitmap, spill, text_slices, use_only
from ledgerlens.llm.hashing import U, hash_of, mix, shingles

SLICE_CHARS = 1_000_000
SENT_CHARS = 4_000_000  # whose prefixes a task holds before it sends them
SHARD_CHARS = 6_000_000
WANTED_BITS = 27  # of the filter of wanted documents, at most
SLOT_BITS = 25  # of the table of rounded counts: 32 MB
HELD_COUNTED = 2_000_000  # n-grams that a counting task holds before it sends them
WIDTH = 5
PERCENT = 75
HELD_HASHES = 4_000_000  # of sets that a checking task keeps, 32 MB
COLUMN_ROWS = 4096  # of a column that one task compares
WORTH = 8  # further pivots are tried while one in so many pairs links
ORDERS = np.random.default_rng(7).integers(0, 1 << 63, 4, dtype=np.uint64) * U(2) + U(1)  # multipliers of the least n-grams


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    return n - -(-n * percent // 100) + 1


def early_length(n: np.ndarray, percent: int) -> np.ndarray:
    """The prefix that suffices for the smaller set of a pair."""
    return n - -(-n * 2 * percent // (100 + percent)) + 1


def sets_of(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes of each text, one text after another, each ascending; sizes; set names."""
    h, counts = shingles(texts, width)
    doc = np.repeat(np.arange(len(texts)), counts)
    ends = np.cumsum(counts)
    for a, b in zip((ends - counts).tolist(), ends.tolist(), strict=True):
        h[a:b].sort()
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[new], doc[new]
    n = np.bincount(doc, minlength=len(texts))
    name = np.zeros(len(texts), U)
    if len(h):
        np.add.at(name, doc, hash_of([h]))
    return h, n, mix(name, n.astype(U))


def new_names(name: np.ndarray, known: set[int]) -> np.ndarray:
    """Which rows are the first of their set name, here and among the known; these are known from now on."""
    once = np.zeros(len(name), bool)
    for i in np.unique(name, return_index=True)[1].tolist():
        once[i] = (x := int(name[i])) not in known
        known.add(x)
    return once


BITS = 1024  # of a set's bitmap
LOWEST = 8  # of a row's early columns that it carries along, so that a pair is sent from few of those it shares
LEAST = [f"least_{k}" for k in range(len(ORDERS))]
_FACTS = pa.schema([("doc_id", pa.int64()), ("t", pa.int64()), ("n", pa.int64()), ("s", pa.int64()), *((c, pa.int64()) for c in LEAST), ("bits", pa.binary()), ("part", pa.int32()), ("data", pa.binary())])
FACTS = "doc_id long, t long, n long, s long, " + "".join(f"{c} long, " for c in LEAST) + "bits binary, part int, data binary"


def bits_of(h: np.ndarray, n: np.ndarray) -> list[bytes]:
    """Each set's bitmap."""
    out = np.zeros((len(n), BITS), bool)
    out[np.repeat(np.arange(len(n)), n), (h % U(BITS)).astype(np.int64)] = True
    return [x.tobytes() for x in np.packbits(out, axis=1)]


def least_of(h: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    """Each set's least n-gram under every order; 0 for empty sets."""
    some = np.flatnonzero(n)
    out = []
    for factor in ORDERS:
        least = np.zeros(len(n), U)
        if len(some):
            least[some] = np.minimum.reduceat(h * factor, (np.cumsum(n) - n)[some])
        out.append(least.view(np.int64))
    return out


def facts(docs: DataFrame, width: int, bits: int) -> DataFrame:
    """Per document (data null): doc_id, t, set size, set name, least n-grams; per part of the hash space: the order class of its slots.

    Tasks send the upper 32 bits of their sets' hashes, sorted and coded as differences; a slot's class is the binary logarithm of how many sets its most frequent n-gram is in, 0 if none is in two.
    """

    def send(held: list[np.ndarray]) -> pa.RecordBatch:
        high = np.concatenate(held)
        held.clear()
        high.sort()
        edges = np.searchsorted(high, np.arange(1 << bits, dtype=np.uint64) << U(32 - bits)).tolist() + [len(high)]
        out, parts = [], []
        for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
            if b > a:
                steps = np.diff(high[a:b], prepend=np.uint32(0)).astype(np.uint32)
                control, data = token_files.pack(steps, np.array([b - a]))
                parts.append(k)
                out.append(np.array([b - a], "<u4").tobytes() + control[0] + data[0])
        none = pa.nulls(len(parts), pa.int64())
        return arrow_rows(_FACTS, [*[none] * (4 + len(LEAST)), pa.nulls(len(parts), pa.binary()), parts, out])

    def read(data: bytes) -> np.ndarray:
        n = int(np.frombuffer(data, "<u4", 1)[0])
        at = 4 + (n + 3) // 4
        steps = token_files.unpack(np.frombuffer(data, np.uint8, at - 4, 4), np.frombuffer(data, np.uint8, -1, at), np.array([n]))
        return np.cumsum(steps, dtype=np.uint64).astype(np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use_only("words")
        held, known, size = [], set(), 0
        for part, texts in text_slices(batches, "text", SLICE_CHARS):
            h, n, name = sets_of(texts, width)
            where = (name.view(np.int64) % (1 << bits)).astype(np.int32)  # dealt like the counts
            yield arrow_rows(_FACTS, [column(part, "doc_id"), column(part, "t"), n, name.view(np.int64), *least_of(h, n), bits_of(h, n), where, pa.nulls(len(n), pa.binary())])
            once = new_names(name, known)  # copies count once
            held.append((h[np.repeat(once, n)] >> U(32)).astype(np.uint32))
            size += len(held[-1])
            if size > HELD_COUNTED:
                yield send(held)
                known, size = set(), 0
        if size:
            yield send(held)
        give_back()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        for batch in batches:  # sorted by part
            is_doc = pa.compute.is_null(column(batch, "data"))
            if pa.compute.any(is_doc).as_py():
                yield batch.filter(is_doc)
            rest = batch.filter(pa.compute.invert(is_doc))
            for part, data in zip(column(rest, "part").to_pylist(), column(rest, "data").to_pylist(), strict=True):
                if held and part not in held:
                    yield classes(*held.popitem())
                held.setdefault(part, []).append(read(data))
        if held:
            yield classes(*held.popitem())
        give_back()

    def classes(part: int, found: list[np.ndarray]) -> pa.RecordBatch:
        high = np.sort(np.concatenate(found))
        at = np.flatnonzero(np.concatenate([[True], high[1:] != high[:-1]]))
        times = np.diff(np.append(at, len(high)))
        often = times > 1
        out = np.zeros(1 << (SLOT_BITS - bits), np.uint8)
        slot = (high[at[often]] >> np.uint32(32 - SLOT_BITS)).astype(np.int64) - (part << (SLOT_BITS - bits))
        np.maximum.at(out, slot, np.log2(times[often]).astype(np.uint8))
        return arrow_rows(_FACTS, [*[pa.nulls(1, pa.int64())] * (4 + len(LEAST)), pa.nulls(1, pa.binary()), [part], [zlib.compress(out.tobytes(), 1)]])

    sent = docs.mapInArrow(run, FACTS).repartition(1 << bits, "part").sortWithinPartitions("part")
    return sent.mapInArrow(merge, FACTS)


def repeated(found: DataFrame, bits: int) -> np.ndarray:
    """The order class of every slot."""
    out = np.zeros((1 << bits, 1 << (SLOT_BITS - bits)), np.uint8)
    for r in found.select("part", "data").collect():  # a row per part, 2^SLOT_BITS bytes in all
        out[r["part"]] = np.frombuffer(zlib.decompress(r["data"]), np.uint8)
    return out.ravel()


def class_of(h: np.ndarray, often: np.ndarray) -> np.ndarray:
    return often[(h >> U(64 - SLOT_BITS)).astype(np.int64)]


_POSTINGS = pa.schema([("shard", pa.int64()), ("data", pa.binary())])


def postings(docs: DataFrame, width: int, percent: int, bits: int, often: np.ndarray) -> DataFrame:
    """Prefix n-grams by shard, in blocks of (n-gram, set name, component, size).  ``docs``: text, comp (null: the set's own name)."""
    packed = zstandard.ZstdCompressor(level=1).compress(often)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use_only("words")
        often = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
        held, known, chars = [], set(), 0
        for part, texts in text_slices(batches, "text", SLICE_CHARS):
            h, n, name = sets_of(texts, width)
            comp = np.where(np.asarray(pa.compute.is_null(column(part, "comp"))), name, np.asarray(pa.compute.fill_null(column(part, "comp"), 0)).view(U))
            once = new_names(name, known) & (n > 0)
            keep = np.repeat(once, n)
            doc = np.repeat(np.arange(len(n)), n)[keep]
            h = h[keep]
            kind = class_of(h, often)
            size = np.where(once, n, 0)
            ends = np.cumsum(size)
            order = np.arange(len(h))
            for a, b in zip((ends - size).tolist(), ends.tolist(), strict=True):
                order[a:b] = a + np.argsort(kind[a:b], kind="stable")
            h, kind = h[order], kind[order]
            place = np.arange(len(h)) - (ends - size)[doc]
            keep = (place < prefix_length(n, percent)[doc]) & (kind > 0)  # no other set has those of class 0
            who, at = np.unique(doc[keep], return_inverse=True)
            held.append((h[keep], at, (place < early_length(n, percent)[doc])[keep], n[who], name[who], comp[who]))
            chars += sum(map(len, texts))
            if chars >= SENT_CHARS:
                yield send(held)
                held, known, chars = [], set(), 0
        if held:
            yield send(held)
        held = often = None
        give_back()

    def send(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        before = np.cumsum([0, *(len(x[3]) for x in held)])
        h, early, n, name, comp = (np.concatenate([x[k] for x in held]) for k in (0, 2, 3, 4, 5))
        doc = np.concatenate([x[1] + b for x, b in zip(held, before.tolist(), strict=False)])
        order = np.argsort(h, kind="stable")
        h, doc, early = h[order], doc[order], early[order]
        shard = h >> U(64 - bits) if bits else np.zeros_like(h)
        edges = np.concatenate([[0], np.flatnonzero(np.diff(shard)) + 1, [len(h)]]) if len(h) else np.zeros(1, int)
        out = []
        for a, b in zip(edges.tolist(), edges[1:].tolist(), strict=False):
            who, at = np.unique(doc[a:b], return_inverse=True)
            small = zlib.compress(n[who].astype("<u4").tobytes() + (2 * at + early[a:b]).astype("<u4").tobytes(), 1)
            out.append(np.array([b - a, len(who)], "<u4").tobytes() + h[a:b].tobytes() + name[who].tobytes() + comp[who].tobytes() + small)
        return arrow_rows(_POSTINGS, [shard[edges[:-1]].view(np.int64) if len(h) else [], out])

    return docs.mapInArrow(run, "shard long, data binary")


_COLUMNS = pa.schema([("h", pa.int64()), ("s", pa.int64()), ("n", pa.int64()), ("early", pa.bool_())])


def shared_columns(blocks: DataFrame, bits: int) -> DataFrame:
    """(h, s, n, early): the rows of every n-gram that is in prefixes of two components or more, and early in one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[bytes]] = {}
        for batch in batches:  # sorted by shard
            for shard, data in zip(column(batch, "shard").to_pylist(), column(batch, "data").to_pylist(), strict=True):
                if held and shard not in held:
                    yield finish(held.popitem()[1])
                held.setdefault(shard, []).append(data)
        if held:
            yield finish(held.popitem()[1])
        give_back()

    def finish(data: list[bytes]) -> pa.RecordBatch:
        parts = []
        for x in data:
            rows, sets = np.frombuffer(x, "<u4", 2).astype(int).tolist()
            h, name = np.frombuffer(x, "<u8", rows, 8), np.frombuffer(x, "<u8", sets, 8 + 8 * rows)
            comp = np.frombuffer(x, "<u8", sets, 8 + 8 * rows + 8 * sets)
            small = np.frombuffer(zlib.decompress(x[8 + 8 * rows + 16 * sets :]), "<u4")
            at = small[sets:]
            parts.append((h, name[at >> 1], small[:sets][at >> 1], at & 1, comp[at >> 1]))
        h, s, n, early, comp = (np.concatenate([p[k] for p in parts]) for k in range(5))
        order = np.lexsort((s, h))
        h, s, n, early, comp = h[order], s[order], n[order], early[order], comp[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (s[1:] != s[:-1])
        h, s, n, early, comp = h[new], s[new], n[new], early[new] == 1, comp[new]
        first = np.concatenate([[0], np.flatnonzero(h[1:] != h[:-1]) + 1])
        size = np.diff(np.append(first, len(h)))
        several = np.minimum.reduceat(comp, first) != np.maximum.reduceat(comp, first)
        keep = np.repeat(several & np.logical_or.reduceat(early, first), size)
        return arrow_rows(_COLUMNS, [*(x[keep].astype(U).view(np.int64) for x in (h, s, n)), early[keep]])

    return blocks.repartition(1 << bits, "shard").sortWithinPartitions("shard").mapInArrow(run, "h long, s long, n long, early boolean")


PAIR = pa.schema([("s", pa.int64()), ("pivot", pa.int64())])


def open_pairs(groups: DataFrame, percent: int) -> DataFrame:
    """Distinct (pivot, s) of different components that sizes, distances and bitmaps leave; ``groups``: h, s, n, early, comp, d (distance to the column's pivot), bits, low (the least of the columns that the set has early, ascending)."""
    limit = percent / 100

    def pairs(h: int, rows: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        order = np.argsort(rows[5], kind="stable")
        s, n, early, comp, side, d, bits, low = (x[order] for x in rows)
        ends = np.searchsorted(d, d + (1 - limit) + 1e-9, side="right")
        split = side.any() and not side.all()
        low = np.where(low < h, low, np.iinfo(np.int64).max)
        for i in range(len(s) - 1):
            near = slice(i + 1, ends[i])
            fits = 100 * np.minimum(n[near], n[i]) >= percent * np.maximum(n[near], n[i])
            first = np.where(n[near] < n[i], early[near], np.where(n[near] > n[i], early[i], early[near] & early[i]))  # the smaller has the column early
            ok = fits & first & (comp[near] != comp[i])
            if split:
                ok &= side[near] != side[i]
            at = i + 1 + np.flatnonzero(ok)
            both = (n[at] + n[i] - np.bitwise_count(bits[at] ^ bits[i]).sum(axis=1)) // 2
            at = at[100 * both >= percent * (n[at] + n[i] - both)]
            if len(at):
                mine = low[i][low[i] < np.iinfo(np.int64).max]
                at = at[~np.isin(low[at], mine).any(axis=1)]  # a lesser column that both have sends them
            if len(at):
                yield np.full(len(at), s[i]), s[at]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()

        def emit(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            h, lo, hi, *rest = rows
            edges = np.concatenate([[0], np.flatnonzero((np.diff(h) != 0) | (np.diff(lo) != 0) | (np.diff(hi) != 0)) + 1, [len(h)]])
            out: list[tuple[int, int]] = []
            for a, b in zip(edges.tolist(), edges[1:].tolist(), strict=False):
                side = rest[4][a:b]
                if b - a < 2 or lo[a] != hi[a] and (side.all() or not side.any()):
                    continue
                for x, y in pairs(int(h[a]), [c[a:b] for c in rest]):
                    for pair in zip(np.minimum(x, y).tolist(), np.maximum(x, y).tolist(), strict=True):
                        if pair not in seen:
                            if len(seen) > 1_000_000:
                                seen.clear()
                            seen.add(pair)
                            out.append(pair)
                    if len(out) > 100_000:
                        yield made(out)
                        out = []
            yield made(out)

        def made(out: list[tuple[int, int]]) -> pa.RecordBatch:
            both = np.array(out, np.int64).reshape(-1, 2)
            return arrow_rows(PAIR, [both[:, 1].copy(), both[:, 0].copy()])

        rest: list[np.ndarray] = []
        for batch in batches:  # sorted by column, which may cross batches
            rows = [column(batch, c).to_numpy(zero_copy_only=False) for c in ("h", "lo", "hi", "s", "n", "early", "comp", "side", "d")]
            rows.append(np.frombuffer(b"".join(column(batch, "bits").to_pylist()), U).reshape(batch.num_rows, BITS // 64))
            rows.append(np.array([x + [np.iinfo(np.int64).max] * (LOWEST - len(x)) for x in column(batch, "low").to_pylist()], np.int64).reshape(batch.num_rows, LOWEST))
            rows = [np.concatenate([a, b]) for a, b in zip(rest, rows, strict=True)] if rest else rows
            if not len(rows[0]):
                continue
            last = len(rows[0]) - 1
            same = (rows[0] == rows[0][last]) & (rows[1] == rows[1][last]) & (rows[2] == rows[2][last])
            last = int(np.flatnonzero(same)[0])
            if last:
                yield from emit([x[:last] for x in rows])
            rest = [x[last:] for x in rows]
        if rest:
            yield from emit(rest)

    parts = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt_in_pairs(groups.select("h", "s", "n", "early", "comp", "d", "bits", "low"), ["h"], "s", COLUMN_ROWS)
    return dealt.repartition(parts, "h", "lo", "hi").sortWithinPartitions("h", "lo", "hi", "s").mapInArrow(run, "s long, pivot long").distinct()


def open_columns(cols: DataFrame, comps: DataFrame) -> DataFrame:
    """h, s, n, early, comp of the columns that touch several components."""
    named = cols.join(comps, "s", "left").select("h", "s", "n", "early", F.coalesce("comp", "s").alias("comp"))
    several = named.groupBy("h").agg(F.min("comp").alias("least"), F.max("comp").alias("most")).filter("least != most").select("h")
    return named.join(several, "h", "left_semi")


def verify(pairs: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """(pivot, s, a, b, overlap): the sizes of both sets and their exact overlap, from the texts."""
    schema = pa.schema([("pivot", pa.int64()), ("s", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("overlap", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        large = zstandard.ZstdDecompressor()
        held: dict[int, np.ndarray] = {}  # sets used last, oldest first
        size = 0

        def set_of(name: int, data: bytes) -> np.ndarray:
            nonlocal size
            found = held.pop(name, None)
            if found is None:
                found = sets_of([large.decompress(data).decode("utf-8", "replace")], width)[0]
                size += len(found)
                while size > HELD_HASHES and held:
                    size -= len(held.pop(next(iter(held))))
            held[name] = found
            return found

        for batch in batches:
            a, b, both = [], [], []
            for p, q, x, y in zip(*(column(batch, c).to_pylist() for c in ("pivot", "s", "text_p", "text_s")), strict=True):
                x, y = set_of(p, x), set_of(q, y)
                a.append(len(x))
                b.append(len(y))
                both.append(int(is_in(x, y).sum()) if len(x) < len(y) else int(is_in(y, x).sum()))
            yield arrow_rows(schema, [column(batch, "pivot"), column(batch, "s"), a, b, both])
        held.clear()
        give_back()

    joined = pairs.join(texts.select(F.col("s").alias("pivot"), F.col("data").alias("text_p")), "pivot")
    joined = joined.join(texts.select("s", F.col("data").alias("text_s")), "s")
    return joined.mapInArrow(run, "pivot long, s long, a long, b long, overlap long")


def is_in(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which values a sorted array holds."""
    if not len(among):
        return np.zeros(len(values), bool)
    return among[np.minimum(np.searchsorted(among, values), len(among) - 1)] == values


def components(links: DataFrame) -> DataFrame:
    """(s, comp) of the linked: the smallest name reachable."""
    edges = spill(links.select("s", "pivot").union(links.select("pivot", "s")).toDF("s", "other").distinct(), "links")
    labels = spill(edges.groupBy("s").agg(F.least(F.min("other"), F.first("s")).alias("comp")), "labels")
    while True:
        near = edges.join(labels.withColumnRenamed("s", "other"), "other").groupBy("s").agg(F.min("comp").alias("near"))
        step = labels.join(near, "s").select("s", F.col("comp").alias("was"), F.least("comp", "near").alias("comp"))
        over = step.select(F.col("s").alias("comp"), F.col("comp").alias("over"))
        step = spill(step.join(over, "comp").select("s", "was", F.col("over").alias("comp")), "labels")
        labels = step.select("s", "comp")
        if not step.filter("was != comp").limit(1).count():
            return labels


def wanted_texts(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(s, data): the compressed text of one document of each wanted set (s, doc_id, t).

    A filter of bounded size skips most other documents before they are read into words; those it lets through are dropped by the join.
    """
    mark = F.xxhash64(F.coalesce("doc_id", F.lit(-1)), "t")
    hits = bitmap(wanted.select(mark.alias("mark")), "mark", WANTED_BITS)
    schema = pa.schema([("s", pa.int64()), ("doc_id", pa.int64()), ("data", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small = zstandard.ZstdCompressor(level=3)
        some = (b.filter(pa.array(in_bitmap(np.asarray(column(b, "mark")), hits))) for b in batches)
        for part, texts in text_slices(some, "text", SLICE_CHARS):
            name = sets_of(texts, width)[2].view(np.int64)
            once = {(s, i): k for k, (s, i) in enumerate(zip(name.tolist(), column(part, "doc_id").to_pylist(), strict=True))}
            yield arrow_rows(schema, [*zip(*once, strict=True), [small.compress(texts[k].encode("utf-8", "replace")) for k in once.values()]])
        give_back()

    made = docs.withColumn("mark", mark).mapInArrow(run, "s long, doc_id long, data binary")
    same = (F.col("w.s") == F.col("m.s")) & F.col("w.doc_id").eqNullSafe(F.col("m.doc_id"))
    return made.alias("m").join(wanted.alias("w"), same, "left_semi").select("s", "data").dropDuplicates(["s"])


def first_pairs(classes: DataFrame) -> DataFrame:
    """(pivot, s): every set with the least-named one of those that have an equal least n-gram, under each order."""
    keyed = classes.select("s", F.posexplode(F.array(*LEAST)).alias("k", "least"))
    pivots = keyed.groupBy("k", "least").agg(F.min("s").alias("pivot"), F.count("*").alias("sets")).filter("sets > 1").drop("sets")
    return keyed.join(pivots, ["k", "least"]).filter("s != pivot").select("pivot", "s").distinct()


def reaches(percent: int) -> Column:
    """Whether a verified pair is linked."""
    return F.lit(100) * F.col("overlap") >= F.lit(percent) * (F.col("a") + F.col("b") - F.col("overlap"))


def unite(cols: DataFrame, classes: DataFrame, texts: DataFrame, checked: DataFrame, links: DataFrame, comps: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links (pivot, s) and components (s, comp) once no column (h, s, n, early) holds an unchecked pair of two components that can link.

    ``classes`` has s, bits; ``texts`` s, data of all sets in columns; ``checked`` what ``verify`` found so far, ``links`` and ``comps`` follow from it.
    """
    similar = reaches(percent)
    distance = 1 - F.col("overlap") / (F.col("a") + F.col("b") - F.col("overlap"))

    def unchecked(pairs: DataFrame) -> DataFrame:
        done = checked.select("pivot", "s").union(checked.select(F.col("s").alias("pivot"), F.col("pivot").alias("s")))
        return pairs.join(done, ["pivot", "s"], "left_anti")

    number = 0
    while True:  # a pivot for each column; the first one also meets its own component, for the distances
        open_ = spill(open_columns(cols, comps), "open-columns")
        chosen = open_.groupBy("h").agg(*(F.min_by(c, F.xxhash64("s", F.lit(number))).alias(to) for c, to in (("s", "pivot"), ("comp", "pivot_comp"))))
        if not number:
            cols, chosen = open_.drop("comp"), spill(chosen, "column-pivots")
            first = chosen.select("h", "pivot")
        met = open_.join(chosen, "h").filter(F.col("s") != F.col("pivot") if not number else F.col("comp") != F.col("pivot_comp"))
        new = spill(verify(unchecked(met.select("pivot", "s").distinct()), texts, width), "pairs")
        tried, united = new.agg(F.count("*"), F.count(F.when(similar, 1))).first()
        if united:
            links = spill(links.union(new.filter(similar).select("pivot", "s")), "links")
            comps = components(links)
        if tried:
            checked = spill(checked.union(new), "pairs")
        number += 1
        if united * WORTH <= tried:
            break
    known = checked.select("pivot", "s", distance.alias("d"))
    known = known.union(known.select("s", "pivot", "d")).dropDuplicates(["pivot", "s"])
    open_ = spill(open_columns(cols, comps), "open-columns")
    low = open_.groupBy("s").agg(F.slice(F.sort_array(F.collect_list(F.when(F.col("early"), F.col("h")))), 1, LOWEST).alias("low"))
    still = open_.join(first, "h").join(known, ["pivot", "s"], "left").join(low.join(classes.select("s", "bits"), "s"), "s")
    still = still.select("h", "s", "n", "early", "comp", "bits", "low", F.when(F.col("pivot") == F.col("s"), 0.0).otherwise(F.col("d")).alias("d"))
    new = spill(verify(unchecked(open_pairs(spill(still, "open-columns"), percent)), texts, width), "pairs").filter(similar).select("pivot", "s")
    if not new.isEmpty():
        links = links.union(new)
        comps = components(links)
    return links, comps


def join_similar(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Documents with their classes, and verified links between sets: enough to connect every component.

    The first table has a row per document: doc_id, n_shingles, component_id (the smallest doc_id that links reach, its own included).
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("t", F.xxhash64("text"))
    chars = docs.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    shards = max(chars // SHARD_CHARS + 1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    bits = min(SLOT_BITS, math.ceil(math.log2(shards)))
    found = spill(facts(docs, width, bits), "shingle-sets")
    rows = found.filter("data is null").select("doc_id", "t", "n", "s", *LEAST, "bits")
    least = F.min(F.struct("doc_id", "t"))  # of the ids, if there is one
    named = rows.filter("n > 0").groupBy("s").agg(least.alias("any"), F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "t"))).alias("row"), *(F.min(c).alias(c) for c in (*LEAST, "bits")))
    classes = spill(named.withColumn("row", F.coalesce("row", "any")).select("s", "row.doc_id", "row.t", *LEAST, "bits"), "set-classes")
    similar = reaches(percent)

    pairs = spill(first_pairs(classes), "first-pairs")
    met = pairs.select("s").union(pairs.select("pivot")).distinct()
    texts = spill(wanted_texts(docs, spill(classes.join(met, "s", "left_semi").select("s", "doc_id", "t"), "wanted-sets"), width), "wanted-texts")
    checked = spill(verify(pairs, texts, width), "pairs")
    links = checked.filter(similar).select("pivot", "s")
    comps = components(links)

    often = repeated(found.filter("data is not null"), bits)
    of_text = rows.select("t", "s").join(comps, "s").select("t", "comp").distinct()
    cols = spill(shared_columns(postings(docs.select("t", "text").join(of_text, "t", "left"), width, percent, bits, often), bits), "shared-columns")
    more = classes.join(cols.select("s").distinct(), "s", "left_semi").join(texts.select("s"), "s", "left_anti").select("s", "doc_id", "t")
    texts = texts.union(spill(wanted_texts(docs, spill(more, "wanted-sets"), width), "wanted-texts"))

    links, comps = unite(cols, classes, texts, checked, links, comps, width, percent)
    named = classes.join(comps, "s", "left").select("s", "doc_id", F.coalesce("comp", "s").alias("comp"))
    of_comp = named.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    of_set = named.join(of_comp, "comp").select("s", "component_id")
    full = rows.filter("n > 0").join(of_set, "s").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    empty = rows.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return full.unionByName(empty), links
