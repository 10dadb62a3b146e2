"""Periodic runs of words, by internal pattern matching.

A run is a stretch of words with smallest period q, at least ``times`` q
and ``min_length`` words long, that no neighbouring word extends.  Spark
deals the documents; each task works on a few of them at a time:

1. Suffix array by prefix doubling over (document, word) pairs.  Level k
   names every stretch of 2^k words; names are places in the suffix array,
   so that a stretch's occurrences are an interval of it.
2. A wavelet tree over the suffix array, as a matrix of bit rows, answers
   range successor queries: the next occurrence at or after a place.
3. Dyadic blocks.  The first 2q words of a run with 2^k <= q < 2^(k+1) hold
   a whole aligned block of 2^k words, which occurs again q words later.
   Each block asks for its occurrences that begin 2^k to 2^(k+1) - 1 words
   behind it.  One or two give candidate periods by their distance.  Three
   or more form an arithmetic progression, whose step p is the block's own
   period; the stretches of period p around the block and around the
   progression then end exactly one candidate period apart.
4. Candidates are extended to both sides by comparing names, longest
   first; of equal stretches the smallest period stays.

Collapsing drops the words of a run behind its first q.

Memory grows with the texts of a slice, or one longer document, not with
the table (about 0.3 kB a word).

Nulls: a null text has no words; a null doc_id is kept.  Repeated rows are
documents of their own.  An empty table gives no rows.  Extra columns are
not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import arrow_rows, column, text_slices

SLICE_CHARS = 1_000_000
MIN_LENGTH = 6
TIMES = 4  # the blocks' argument needs four periods


@dataclass
class Stretches:
    """Names of all stretches of 2^k words, and the suffix array (sorted as far as the longest of them)."""

    names: list[np.ndarray]
    order: np.ndarray
    blocks: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # per level: aligned blocks that occur again, their intervals


def name_stretches(words: np.ndarray, starts: np.ndarray, lengths: np.ndarray, min_length: int, times: int) -> Stretches:
    """``words``: numbers of the words of documents that stand one after another."""
    total = len(words)
    doc = np.repeat(np.arange(len(lengths)), lengths)
    place, end = np.arange(total) - starts[doc], (starts + lengths)[doc]
    room = np.where(lengths >= min_length, lengths // times, 0)[doc]  # the longest period
    levels = int(room.max(initial=0)).bit_length()
    key = doc * (int(words.max(initial=0)) + 1) + words
    order = np.argsort(key, kind="stable")
    first = np.ones(total, bool)
    first[1:] = key[order][1:] != key[order][:-1]
    rank = np.empty(total, np.int64)
    size = np.zeros(total, np.int64)
    slots = np.arange(total)  # of the suffix array: those whose suffix shares its name
    names, blocks = [], []
    for k in range(levels):
        if k:
            here = order[slots]
            after = here + (1 << k - 1)
            second = np.where(after < end[here], rank[np.minimum(after, total - 1)], -1)
            key = rank[here] * (total + 1) + second + 1
            by = np.argsort(key, kind="stable")
            order[slots] = here[by]
            key = key[by]
            first = np.ones(len(slots), bool)
            first[1:] = key[1:] != key[:-1]
        group = np.cumsum(first) - 1
        heads = slots[first]
        if len(slots):
            counts = np.bincount(group)
            rank[order[slots]] = heads[group]
            size[heads] = counts
            slots = slots[counts[group] > 1]
        names.append(rank.astype(np.int32))
        again = (room >> k > 0) & (place & (1 << k) - 1 == 0) & (np.arange(total) + (2 << k) <= end) & (size[rank] > 1)
        at = np.flatnonzero(again)
        blocks.append((at, rank[at], rank[at] + size[rank[at]]))
    return Stretches(names, order, blocks)


class WaveletTree:
    """Bit rows of a sequence of numbers, the highest bit first; each row is sorted by the bits before it."""

    def __init__(self, values: np.ndarray):
        self.zeros: list[np.ndarray] = []  # how many of a row's first numbers have a zero there
        self.bits = len(values).bit_length()
        for k in reversed(range(self.bits)):
            bit = values >> k & 1
            count = np.zeros(len(values) + 1, np.int32)
            np.cumsum(1 - bit, out=count[1:])
            self.zeros.append(count)
            values = np.concatenate([values[bit == 0], values[bit == 1]])

    def below(self, a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many of the numbers in [a, b) are less than x."""
        out = np.zeros(len(a), np.int64)
        for k, zeros in zip(reversed(range(self.bits)), self.zeros, strict=True):
            za, zb = zeros[a], zeros[b]
            one = x >> k & 1 == 1
            out += np.where(one, zb - za, 0)
            a, b = np.where(one, zeros[-1] + a - za, za), np.where(one, zeros[-1] + b - zb, zb)
        return out

    def nth(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The n-th smallest (from 0) of the numbers in [a, b)."""
        out = np.zeros(len(a), np.int64)
        for k, zeros in zip(reversed(range(self.bits)), self.zeros, strict=True):
            za, zb = zeros[a], zeros[b]
            one = n >= zb - za
            n = np.where(one, n - (zb - za), n)
            out |= one.astype(np.int64) << k
            a, b = np.where(one, zeros[-1] + a - za, za), np.where(one, zeros[-1] + b - zb, zb)
        return out

    def successor(self, a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The least number of [a, b) that is x or more; -1 if none is.  x is at most how many numbers there are."""
        n = self.below(a, b, x)
        there = n < b - a
        out = np.full(len(a), -1, np.int64)
        out[there] = self.nth(a[there], b[there], n[there])
        return out


def _matching(names: list[np.ndarray], i: np.ndarray, j: np.ndarray, room: np.ndarray, forward: bool) -> np.ndarray:
    """How many words from i on equal those from j on (or those before i those before j), ``room`` at most."""
    out = np.zeros(len(i), np.int64)
    for k in reversed(range(len(names))):
        open_ = np.arange(len(i))
        while len(open_):  # more than once only at the highest level
            open_ = open_[room[open_] - out[open_] >= 1 << k]
            move = out[open_] if forward else -out[open_] - (1 << k)
            same = names[k][i[open_] + move] == names[k][j[open_] + move]
            open_ = open_[same]
            out[open_] += 1 << k
            if k < len(names) - 1:
                break
    return out


def find_runs(words: np.ndarray, lengths: np.ndarray, min_length: int = MIN_LENGTH, times: int = TIMES) -> np.ndarray:
    """(document, start, length, period) of the runs of documents whose words' numbers stand one after another, in this order."""
    if times < TIMES:
        raise ValueError(f"times must be {TIMES} or more")
    starts = np.cumsum(lengths) - lengths
    found = name_stretches(words, starts, lengths, min_length, times)
    if not found.names:
        return np.zeros((0, 4), np.int64)
    doc = np.repeat(np.arange(len(lengths)), lengths)
    begin, end = starts[doc], (starts + lengths)[doc]
    tree = WaveletTree(found.order)

    def forward(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return _matching(found.names, i, j, end[i] - j, True)

    blocks, periods = [], []
    for k, (b, low, high) in enumerate(found.blocks):
        limit = b + (2 << k)
        one = tree.successor(low, high, b + (1 << k))
        ok = (one >= 0) & (one < limit)
        b, low, high, limit, one = (x[ok] for x in (b, low, high, limit, one))
        two = tree.successor(low, high, one + 1)
        ok = (two >= 0) & (two < limit)
        blocks.append(b[~ok])
        periods.append((one - b)[~ok])
        b, low, high, limit, one, two = (x[ok] for x in (b, low, high, limit, one, two))
        three = tree.successor(low, high, two + 1)
        ok = (three >= 0) & (three < limit)
        blocks += [b[~ok]] * 2
        periods += [(one - b)[~ok], (two - b)[~ok]]
        b, one, step = b[ok], one[ok], (two - one)[ok]
        q = one + forward(one, one + step) - b - forward(b, b + step)
        ok = (q >= 1 << k) & (q < 2 << k)
        blocks.append(b[ok])
        periods.append(q[ok])
    b, q = np.concatenate(blocks), np.concatenate(periods)
    first = b - _matching(found.names, b, b + q, b - begin[b], False)
    last = b + q + forward(b, b + q)
    keep = last - first >= np.maximum(min_length, times * q)
    runs = np.stack([first, last, q], axis=1)[keep]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    first, last, q = runs[new].T
    order = np.lexsort((q, first))
    first, last, q = first[order], last[order], q[order]
    return np.stack([doc[first], first - begin[first], last - first, q], axis=1)


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of n words no run (start, length, period) holds behind its first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge[:n]) == 0


def periodic_runs(
    docs: DataFrame,
    order: Callable[[int | None, int], np.ndarray | None] = lambda doc_id, n: None,
    min_length: int = MIN_LENGTH,
    times: int = TIMES,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and the collapsed text of every whole text.

    ``order`` may rearrange a document first: for its id and number of words, the numbers of the words that stand in their places.
    """
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(run_type)), ("collapsed", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches, "text", SLICE_CHARS):
            keys = column(part, "doc_id").to_pylist()
            split = [x.encode().split() for x in texts]  # ASCII white space
            for i, (key, found) in enumerate(zip(keys, split, strict=True)):
                at = order(key, len(found))
                if at is not None:
                    split[i] = [found[k] for k in at.tolist()]
            number: dict[bytes, int] = {}
            for found in split:
                for w in found:
                    number.setdefault(w, len(number))
            lengths = np.array([len(x) for x in split], np.int64)
            flat = np.fromiter((number[w] for x in split for w in x), np.int64, lengths.sum())
            runs = find_runs(flat, lengths, min_length, times)
            edges = np.searchsorted(runs[:, 0], np.arange(len(split) + 1))
            collapsed = []
            for found, a, b in zip(split, edges.tolist(), edges[1:].tolist(), strict=False):
                keep = found if a == b else [found[k] for k in np.flatnonzero(kept_words(len(found), runs[a:b, 1:])).tolist()]
                collapsed.append(b" ".join(keep))
            values = pa.StructArray.from_arrays([pa.array(runs[:, k]) for k in (1, 2, 3)], fields=list(run_type))
            listed = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), values)
            yield arrow_rows(schema, [column(part, "doc_id"), lengths, listed.cast(schema.field("runs").type), pa.array(collapsed, pa.binary()).cast(pa.string())])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")
