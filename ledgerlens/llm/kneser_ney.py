"""Interpolated modified Kneser-Ney n-gram models.

Counting.  Tasks hash words (64 bits), count the n-grams of a few million
tokens with numpy and send each shard one block of sorted rows.  A shard
task merges its blocks into distinct n-grams with their counts, writes them
as a file, and sends each n-gram's last n-1 words on to the shards of the
next lower order, where every distinct n-gram counts once (continuation
counts).  Shards are by hash of the n-gram's context, so a shard also knows
each context's total and its numbers of words seen once, twice and more;
contexts that a sample of the documents shows to be frequent are spread
over shards by their last word, and their parts are added up afterwards.

Storage.  Per order and shard: sorted 64-bit keys (shard number, then a
hash of the n-gram) with counts, and sorted context keys with their four
numbers.  Workers memory-map the files (a store without local paths is
copied into a temporary file first) and look up the sorted distinct keys
of many texts at a time.

Scoring.  p_n(w|h) = max(c - D(c), 0) / c(h) + gamma(h) p_{n-1}(w|h'), with
three discounts per order from its counts of counts, down to the uniform
1 / (V + 1).  Documents begin with n-1 start marks and end with an end
token.

Nulls: a null text is empty (one end token).  A null doc_id counts as the
empty text for the split.  Repeated rows count as often as they stand.  An
empty training set gives the uniform model with V = 0.  Extra columns are
not read.
"""

from __future__ import annotations

import math
import tempfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import arrow_rows, column, filesystem, spill, text_slices, uri, write_file
from ledgerlens.llm.hashing import WORDS, U, hash_of, mix, split_words
from ledgerlens.session import shared_dir

SLICE_CHARS = 12_000_000  # counted at a time
SCORE_CHARS = 6_000_000
SHARD_CHARS = 6_000_000
MOST_BITS = 24  # of shard numbers: at SHARD_CHARS each, 100 TB of text
HOT_SAMPLE = 0.01
BEGIN, END = b" begin", b" end"  # no word has a space


def tokens(texts: list[str], pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``pad`` start marks, the words and the end of each text one after another; numbers of words and end."""
    flat: list[bytes] = []
    counts = np.empty(len(texts), np.int64)
    begin = [BEGIN] * pad
    for i, x in enumerate(texts):
        words = split_words(x)
        counts[i] = len(words) + 1
        flat += begin
        flat += words
        flat.append(END)
    return np.fromiter(map(WORDS.__getitem__, flat), U, len(flat)), counts


def is_in(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    if not len(among):
        return np.zeros(len(values), bool)
    return among[np.minimum(np.searchsorted(among, values), len(among) - 1)] == values


def shard_and_key(grams: list[np.ndarray], bits: int, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shard, key (the shard's number above a hash of the n-gram) and context hash."""
    if len(grams) == 1:
        context = np.full(len(grams[0]), 0x243F6A8885A308D3, U)
        whole = hash_of(grams)
        by = whole
    else:
        context = hash_of(grams[:-1])
        whole = mix(context, grams[-1])
        by = np.where(is_in(context, hot), whole, mix(context, np.zeros_like(context)))
    shard = by >> U(64 - bits) if bits else np.zeros_like(by)
    return shard, (shard << U(64 - bits) if bits else shard) | (whole >> U(bits)), context


def blocks(grams: list[np.ndarray], counts: np.ndarray, raw: np.ndarray, bits: int, hot: np.ndarray) -> tuple[list[int], list[bytes]]:
    """Rows sorted and cut by shard; each cut compressed: first words by run, then the other words, the counts."""
    shard, key, _ = shard_and_key(grams, bits, hot)
    order = np.lexsort((key, grams[0], shard))
    shard = shard[order]
    edges = np.concatenate([[0], np.flatnonzero(np.diff(shard)) + 1, [len(shard)]]) if len(shard) else np.zeros(1, int)
    cols = [g[order] for g in grams]
    counts, raw = counts[order], raw[order]
    out = []
    for a, b in zip(edges.tolist(), edges[1:].tolist(), strict=False):
        runs = np.concatenate([[0], np.flatnonzero(np.diff(cols[0][a:b])) + 1, [b - a]])
        first = cols[0][a:b][runs[:-1]].tobytes()
        rest = b"".join(c[a:b].tobytes() for c in cols[1:])
        small = zlib.compress(np.diff(runs).astype("<u4").tobytes() + counts[a:b].astype("<u8").tobytes() + raw[a:b].astype("<u8").tobytes(), 1)
        out.append(np.array([b - a, len(runs) - 1], "<u4").tobytes() + first + rest + small)
    return shard[edges[:-1]].astype(int).tolist() if len(shard) else [], out


def unblock(data: bytes, order: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    n, runs = np.frombuffer(data, "<u4", 2).astype(int).tolist()
    first = np.frombuffer(data, "<u8", runs, 8)
    rest = np.frombuffer(data, "<u8", n * (order - 1), 8 + 8 * runs).reshape(order - 1, n)
    small = zlib.decompress(data[8 + 8 * runs + 8 * n * (order - 1) :])
    lengths = np.frombuffer(small, "<u4", runs)
    counts, raw = np.frombuffer(small, "<u8", 2 * n, 4 * runs).reshape(2, n)
    return [np.repeat(first, lengths), *rest], counts, raw


def merge(grams: list[np.ndarray], counts: np.ndarray, raw: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Distinct n-grams with their counts summed."""
    if not len(counts):
        return grams, counts, raw
    key = hash_of(grams)
    order = np.argsort(key, kind="stable")
    key = key[order]
    at = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1])
    return [g[order][at] for g in grams], np.add.reduceat(counts[order], at), np.add.reduceat(raw[order], at)


@dataclass(frozen=True)
class Model:
    folder: str
    order: int
    bits: int
    hot: dict[int, np.ndarray]  # order -> sorted context hashes that are spread
    spread: dict[int, dict[int, tuple[int, int, int, int]]]  # order -> context -> total, seen once, twice, more
    discounts: dict[int, tuple[float, float, float]]
    tokens: int  # N
    types: int  # V


BLOCK = "shard long, data binary"
_BLOCK = pa.schema([("shard", pa.int64()), ("data", pa.binary())])


def _frequent(rows: DataFrame, order: int, bits: int) -> dict[int, np.ndarray]:
    """Contexts with more than an eighth of a shard's share of the tokens in a sample; they steer the spreading only."""
    schema = pa.schema([("n", pa.int32()), ("context", pa.int64()), ("c", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in text_slices(batches, "text", SLICE_CHARS):
            h, _ = tokens(texts, order - 1)
            for n in range(2, order + 1):
                found, c = np.unique(hash_of([h[i : len(h) - n + 1 + i] for i in range(n - 1)]), return_counts=True)
                often = c > max(2, c.sum() / (20 << (bits + 3)))
                yield arrow_rows(schema, [np.full(often.sum(), n), found[often].view(np.int64), c[often]])
            yield arrow_rows(schema, [[0], [0], [len(h)]])

    counted = rows.sample(HOT_SAMPLE, 7).mapInArrow(run, "n int, context long, c long").groupBy("n", "context").agg(F.sum("c").alias("c"))
    counted = spill(counted, "frequent-contexts")
    total = counted.filter("n = 0").agg(F.sum("c")).first()[0] or 0
    often = counted.filter((F.col("n") > 0) & (F.col("c") > total / (1 << (bits + 3)))).collect()  # at most 2^(bits + 3) per order
    return {n: np.sort(np.array([r["context"] for r in often if r["n"] == n], np.int64).view(U)) for n in range(2, order + 1)}


def train(docs: DataFrame, usable: Column, order: int = 2, doc_id: str = "doc_id", text: str = "text") -> Model:
    """Count whole texts of the documents for which ``usable`` holds; write the model's files."""
    spark = docs.sparkSession
    rows = docs.filter(usable).select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    chars = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    wanted = max(chars // SHARD_CHARS + 1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    bits = min(MOST_BITS, max(0, math.ceil(math.log2(wanted))))
    hot = _frequent(rows, order, bits)
    folder = shared_dir(spark, "kneser-ney")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin = U(WORDS[BEGIN])
        for _, texts in text_slices(batches, "text", SLICE_CHARS):
            h, _ = tokens(texts, order - 1)
            if order == 1:
                real = np.ones(len(h), bool)
            else:
                real = h[order - 1 :] != begin
            grams = [h[i : len(h) - order + 1 + i][real] for i in range(order)]
            one = np.ones(len(grams[0]), np.int64)
            grams, c, _ = merge(grams, one, one)
            yield arrow_rows(_BLOCK, list(blocks(grams, c, c, bits, hot.get(order, np.zeros(0, U)))))

    def level(n: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[int, list[bytes]] = {}
            for batch in batches:  # sorted by shard
                for shard, data in zip(column(batch, "shard").to_pylist(), column(batch, "data").to_pylist(), strict=True):
                    if held and shard not in held:
                        yield from finish(*held.popitem())
                    held.setdefault(shard, []).append(data)
            if held:
                yield from finish(*held.popitem())

        def finish(shard: int, data: list[bytes]) -> Iterator[pa.RecordBatch]:
            got = [unblock(x, n) for x in data]
            data.clear()
            grams, c, raw = merge([np.concatenate([g[0][i] for g in got]) for i in range(n)], np.concatenate([g[1] for g in got]), np.concatenate([g[2] for g in got]))
            del got
            _, key, context = shard_and_key(grams, bits, hot.get(n, np.zeros(0, U)))
            at = np.argsort(key)
            parts = [np.array([len(at)], "<u8").tobytes(), key[at].tobytes(), c[at].astype("<u8").tobytes()]
            if n == 1:
                parts.append(raw[at].astype("<u8").tobytes())
            write_file(folder, f"grams-{n}-{shard:08d}", parts)
            by = np.argsort(context, kind="stable")
            context, cc = context[by], c[by]
            first = np.concatenate([[0], np.flatnonzero(np.diff(context)) + 1])
            numbers = np.stack([np.add.reduceat(x, first) for x in (cc, cc == 1, cc == 2, cc > 2)]).astype(np.int64)
            context = context[first]
            alone = np.zeros(len(context), bool) if n == 1 else ~is_in(context, hot[n])
            write_file(folder, f"contexts-{n}-{shard:08d}", [np.array([alone.sum()], "<u8").tobytes(), context[alone].tobytes(), numbers[0, alone].astype("<u8").tobytes(), numbers[1:, alone].astype("<u8").tobytes()])
            seen = np.array([(c == k).sum() for k in (1, 2, 3, 4)] + [len(c), raw.sum()], "<i8")
            spread = b"".join(x.tobytes() for x in (context[~alone], *numbers[:, ~alone]))
            yield arrow_rows(_BLOCK, [[-1 - n], [seen.tobytes() + spread]])
            if n > 1:
                one = np.ones(len(c), np.int64)
                lower, k, r = merge(grams[1:], one, raw)
                yield arrow_rows(_BLOCK, list(blocks(lower, k, r, bits, hot.get(n - 1, np.zeros(0, U)))))

        return run

    dealt = rows.mapInArrow(count, BLOCK)
    facts: dict[int, list[bytes]] = {}
    for n in range(order, 0, -1):
        merged = dealt.filter("shard >= 0").repartition(1 << bits, "shard").sortWithinPartitions("shard").mapInArrow(level(n), BLOCK)
        dealt = spill(merged, f"kneser-ney-{n}")
        facts[n] = [bytes(r["data"]) for r in dealt.filter(F.col("shard") == -1 - n).select("data").collect()]  # a row per shard
    discounts, spread, total, kinds = {}, {}, 0, 0
    for n in range(1, order + 1):
        seen = np.sum([np.frombuffer(x, "<i8", 6) for x in facts[n]], axis=0) if facts[n] else np.zeros(6, np.int64)
        discounts[n] = _discounts(seen[:4].tolist())
        spread[n] = {}
        for x in facts[n]:
            for context, *numbers in np.frombuffer(x, "<i8", -1, 48).reshape(5, -1).T.tolist():
                spread[n][context] = tuple(a + b for a, b in zip(spread[n].get(context, (0, 0, 0, 0)), numbers, strict=True))
        if n == 1:
            total, kinds = int(seen[5]), int(seen[4])
    return Model(folder, order, bits, hot, spread, discounts, total, kinds)


def _discounts(n: list[int]) -> tuple[float, float, float]:
    """Of counts of one, two, three and more, from how many n-grams have each count; 1/2 of a count where these don't tell."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] and n[1] else 0.5
    out = []
    for k in (1, 2, 3):
        d = k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] and n[k] else k / 2
        out.append(min(max(d, 0.05 * k), k * 0.95))
    return out[0], out[1], out[2]


class Reader:
    """A model's files mapped into memory."""

    def __init__(self, model: Model):
        self.model, self.files = model, {}
        found = [x.base_name for x in self._store()[0].get_file_info(self._selector()) if x.base_name[:1] != "."]
        self.names = set(found)
        spread = {}
        for n, of in model.spread.items():
            keys = np.array(sorted(of), np.int64).view(U)
            order = np.argsort(keys)
            spread[n] = keys[order], np.array([of[k] for k in sorted(of)], np.int64).reshape(-1, 4)[order]
        self.spread = spread

    def _store(self):
        return filesystem(self.model.folder)

    def _selector(self):
        from pyarrow import fs

        return fs.FileSelector(self._store()[1], allow_not_found=True)

    def _map(self, name: str) -> np.ndarray:
        if name not in self.files:
            path = uri(self.model.folder)
            if name not in self.names:
                self.files[name] = np.zeros(8, np.uint8)
            elif path.startswith("file://"):
                self.files[name] = np.memmap(f"{path[7:]}/{name}", np.uint8, "r")
            else:
                store, base = self._store()
                copy = tempfile.TemporaryFile()
                with store.open_input_stream(f"{base}/{name}") as f:
                    while part := f.read(1 << 22):
                        copy.write(part)
                copy.flush()
                self.files[name] = np.memmap(copy, np.uint8, "r")
        return self.files[name]

    def counts(self, n: int, shard: int) -> tuple[np.ndarray, ...]:
        data = self._map(f"grams-{n}-{shard:08d}")
        k = int(data[:8].view("<u8")[0])
        return data[8 : 8 + 8 * k].view("<u8"), data[8 + 8 * k : 8 + 16 * k].view("<u8"), data[8 + 16 * k :]

    def contexts(self, n: int, shard: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        data = self._map(f"contexts-{n}-{shard:08d}")
        k = int(data[:8].view("<u8")[0])
        return data[8 : 8 + 8 * k].view("<u8"), data[8 + 8 * k : 8 + 16 * k].view("<u8"), data[8 + 16 * k : 8 + 40 * k].view("<u8").reshape(3, k)

    def find(self, shards: np.ndarray, keys: np.ndarray, arrays, out: list[np.ndarray]) -> None:
        """Values of sorted keys, shard by shard; ``arrays`` gives a shard's sorted keys and values."""
        edges = np.concatenate([[0], np.flatnonzero(np.diff(shards)) + 1, [len(shards)]]) if len(shards) else np.zeros(1, int)
        for a, b in zip(edges.tolist(), edges[1:].tolist(), strict=False):
            stored, values = arrays(int(shards[a]))
            if len(stored):
                at = np.minimum(np.searchsorted(stored, keys[a:b]), len(stored) - 1)
                hit = stored[at] == keys[a:b]
                for o, v in zip(out, values, strict=True):
                    o[a:b][hit] = v[at[hit]]

    def score(self, texts: list[str]) -> list[np.ndarray]:
        """Per text: tokens, known tokens, base score, log10 probability."""
        m = self.model
        pad = m.order - 1
        h, counts = tokens(texts, pad)
        ends = np.cumsum(counts + pad)
        within = np.ones(len(h), bool)
        for k in range(pad):
            within[ends - counts - pad + k] = False
        at = np.flatnonzero(within)
        grams = [h[at - (pad - i)] for i in range(m.order)]
        probability = np.full(len(at), 1 / (m.types + 1))
        first = np.cumsum(counts) - counts
        raw = np.zeros(len(at), np.int64)
        for n in range(1, m.order + 1):
            cols = grams[m.order - n :]
            shard, key, context = shard_and_key(cols, m.bits, m.hot.get(n, np.zeros(0, U)))
            distinct, place, back = np.unique(key, return_index=True, return_inverse=True)
            c = np.zeros(len(distinct), np.int64)
            if n == 1:
                r = np.zeros(len(distinct), np.int64)

                def unigrams(s):
                    keys, found, more = self.counts(1, s)
                    return keys, [found, more.view("<u8")]

                self.find(shard[place], distinct, unigrams, [c, r])
                raw = r[back]
            else:
                self.find(shard[place], distinct, lambda s, n=n: ((x := self.counts(n, s))[0], [x[1]]), [c])
            if n == 1:
                numbers = self.spread[1][1] if len(self.spread[1][1]) else np.zeros((1, 4), np.int64)
                total, one, two, more = (np.full(1, x) for x in numbers[0].tolist())
                which = np.zeros(len(at), np.int64)
            else:
                contexts, where, which = np.unique(context, return_index=True, return_inverse=True)
                got = [np.zeros(len(contexts), np.int64) for _ in range(4)]
                lone = shard[where]
                order = np.lexsort((contexts, lone))
                parts = [x[order] for x in got]
                self.find(lone[order], contexts[order], lambda s, n=n: ((x := self.contexts(n, s))[0], [x[1], *x[2]]), parts)
                for g, p in zip(got, parts, strict=True):
                    g[order] = p
                keys, numbers = self.spread[n]
                if len(keys):
                    spot = np.minimum(np.searchsorted(keys, contexts), len(keys) - 1)
                    hit = keys[spot] == contexts
                    for k in range(4):
                        got[k][hit] = numbers[spot[hit], k]
                total, one, two, more = got
            d = np.array([0.0, *m.discounts[n]])
            gamma = np.where(total > 0, (d[1] * one + d[2] * two + d[3] * more) / np.maximum(total, 1), 1.0)
            own = np.maximum(c - d[np.minimum(c, 3)], 0)[back] / np.maximum(total, 1)[which]
            probability = own + gamma[which] * probability
        base = np.log10((raw + 0.5) / (m.tokens + 0.5 * (m.types + 1)))
        known = np.add.reduceat((raw > 0).astype(np.int64), first)
        return [counts, known, np.add.reduceat(base, first), np.add.reduceat(np.log10(probability), first)]


_READERS: dict[str, Reader] = {}


def score(docs: DataFrame, model: Model, held_out: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every whole text; perplexity is 10^(-score / n_tokens)."""
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model.folder not in _READERS:
            _READERS.clear()
            _READERS[model.folder] = Reader(model)
        for part, texts in text_slices(batches, "text", SCORE_CHARS):
            n, known, base, own = _READERS[model.folder].score(texts)
            yield arrow_rows(schema, [column(part, "doc_id"), column(part, "held_out"), n, known, [model.tokens] * len(n), base, own])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), held_out.alias("held_out"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
