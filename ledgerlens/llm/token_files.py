"""Token ids of a corpus in binary files, in document order.

Coding: ids are numbered by falling corpus frequency (ties by id), so that
frequent ids are small numbers.  A number takes 1 to 4 bytes; its length
less one stands as two bits in a separate control stream, four numbers to a
control byte, each document padded to whole control bytes with zeros.
Reading looks every control byte up in numpy tables of the places and masks
of its four numbers, then turns numbers back into ids by a table.

A segment file holds the documents of one range of ids, ascending:

    8 bytes   magic
    2 x u64   documents, length of the control stream
    i64[n]    doc_id;  u8[n] 1 where doc_id is null;  u32[n] ids;  u64[n] data bytes
    u8[]      control stream of all documents, then their data

``ranks.u32`` beside them holds the id of each number.  Ids before a
segment are in the manifest, a table of the segments.

Texts are encoded once, in one pass whose ids are written compressed to the
shared folder with the counts of ids; the numbers follow from the counts,
and a second pass codes and sorts the documents.  A doc_id that many rows
share is spread over as many ranges as it fills.

Nulls: a null text is empty, a null doc_id sorts first.  Repeated rows are
documents of their own, equal doc_ids in the order of a hash of their ids,
then of their coded bytes.  An empty table gives no segment.  Extra columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import arrow_rows, column, filesystem, give_back, spill, text_slices, use_only, write_file
from ledgerlens.llm.tokenise import encoder
from ledgerlens.session import shared_dir

MAGIC = b"TOKSEG01"
SLICE_CHARS = 2_000_000
SHARD_TOKENS = 4_000_000  # aimed at per range of ids
SEGMENT_TOKENS = 8_000_000  # most that a writer holds, but for one longer document
READ_TOKENS = 1_000_000

# For each control byte: the four lengths, where each number begins, all bytes.
_LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1
_BEGINS = np.concatenate([np.zeros((256, 1), int), np.cumsum(_LENGTHS, axis=1)[:, :3]], axis=1)
_TOTAL = _LENGTHS.sum(axis=1)
_MASKS = (np.uint64(1) << (8 * _LENGTHS).astype(np.uint64)) - np.uint64(1)
_MASKS = _MASKS.astype(np.uint32)


def pack(numbers: np.ndarray, counts: np.ndarray) -> tuple[list[bytes], list[bytes]]:
    """Control and data bytes of documents; ``numbers`` holds theirs one after another."""
    counts = np.asarray(counts, np.int64)
    padded = (counts + 3) // 4 * 4
    ends = np.cumsum(padded)
    full = np.zeros(int(padded.sum()), np.uint32)
    full[_real(counts, padded, ends)] = numbers
    most = int(full.max()) if len(full) else 0
    wide = 1 + (most > 0xFF) + (most > 0xFFFF) + (most > 0xFFFFFF)
    code = np.zeros(len(full), np.uint8)
    for k in range(1, wide):
        code += full >= 1 << (8 * k)
    four = code.reshape(-1, 4)
    control = (four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6).tobytes()
    rows = full.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :wide]
    keep = np.ones(rows.shape, bool)
    for k in range(1, wide):
        keep[:, k] = code >= k
    data = rows[keep].tobytes()
    total = np.concatenate([[0], np.cumsum(code, dtype=np.int64)])
    at = np.concatenate([[0], ends])
    data_end, control_end = (total[at] + at).tolist(), (at // 4).tolist()
    return [control[a:b] for a, b in zip(control_end, control_end[1:], strict=False)], [data[a:b] for a, b in zip(data_end, data_end[1:], strict=False)]


def _real(counts: np.ndarray, padded: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which places hold numbers, not the zeros that fill up a document's last control byte."""
    out = np.ones(int(padded.sum()), bool)
    for k in (1, 2, 3):
        out[(ends - k)[padded - counts >= k]] = False
    return out


def unpack(control: np.ndarray, data: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers of documents that stand one after another in both streams."""
    total = _TOTAL[control]
    at = ((np.cumsum(total) - total)[:, None] + _BEGINS[control]).ravel()
    counts = np.asarray(counts, np.int64)
    padded = (counts + 3) // 4 * 4
    real = _real(counts, padded, np.cumsum(padded))
    at, masks = at[real], _MASKS[control].ravel()[real]
    long = np.concatenate([data, np.zeros(3, np.uint8)])
    value = long[at].astype(np.uint32)
    most = int(masks.max()) if len(masks) else 0
    for k in (1, 2, 3):
        if most >> (8 * k):
            value |= long[at + k].astype(np.uint32) << np.uint32(8 * k)
    return value & masks


@dataclass(frozen=True)
class TokenFiles:
    folder: str
    manifest: DataFrame  # file, base (ids before it), n_docs, n_tokens


def encoded(docs: DataFrame, tokenizer: str, split: str) -> tuple[DataFrame, dict[int, int]]:
    """doc_id, n, ids (binary) of whole texts, written to the shared folder, and how often each id occurs."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use_only("encoder")
        enc = encoder(tokenizer, split)
        total = np.zeros(enc.vocabulary, np.int64)
        for part, texts in text_slices(batches, "text", SLICE_CHARS):
            ids = enc.encode(texts)
            total += np.bincount(np.frombuffer(b"".join(ids), enc.dtype), minlength=enc.vocabulary)
            yield arrow_rows(schema, [column(part, "doc_id"), [len(x) // enc.dtype.itemsize for x in ids], ids])
        seen = np.flatnonzero(total)
        yield arrow_rows(schema, [seen, total[seen], pa.nulls(len(seen), pa.binary())])  # ids null: the count of an id

    rows = spill(docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, ids binary"), "token-ids", compression="zstd")
    counted = rows.filter("ids is null").groupBy("doc_id").agg(F.sum("n").alias("n")).collect()  # at most the vocabulary
    return rows.filter("ids is not null"), {r["doc_id"]: r["n"] for r in counted}


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int, split: str = "whole", doc_id: str = "doc_id", text: str = "text") -> TokenFiles:
    """Encode whole texts and write them as segment files in ascending doc_id order."""
    spark = docs.sparkSession
    rows, counts = encoded(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), tokenizer, split)
    dtype = encoder(tokenizer, split).dtype
    seen = np.zeros(max([*counts, end_id]) + 1, np.int64)
    for k, n in counts.items():
        seen[k] = n
    seen[end_id] += rows.count()
    of_rank = np.lexsort((np.arange(len(seen)), -seen)).astype(np.uint32)
    rank_of = np.empty(len(seen), np.uint32)
    rank_of[of_rank] = np.arange(len(seen), dtype=np.uint32)
    folder = shared_dir(spark, "token-files")
    write_file(folder, "ranks.u32", [of_rank.astype("<u4").tobytes()])

    shards = max(int(seen.sum()) // SHARD_TOKENS + 1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    borders = rows.approxQuantile("doc_id", [(i + 1) / shards for i in range(shards - 1)], min(0.01, 0.25 / shards))
    borders = np.array(sorted(int(x) for x in borders if x < 2.0**63), np.int64)  # an id stands here as often as it fills ranges
    coded = pa.schema([("shard", pa.int32()), ("doc_id", pa.int64()), ("mixed", pa.int64()), ("n_tokens", pa.int64()), ("control", pa.binary()), ("data", pa.binary())])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use_only()
        for batch in batches:
            found = column(batch, "ids")
            sizes = np.cumsum(np.asarray(pa.compute.binary_length(found)))
            at = 0
            while at < batch.num_rows:
                done = sizes[at - 1] if at else 0
                end = max(at + 1, int(np.searchsorted(sizes, done + dtype.itemsize * READ_TOKENS, side="right")))
                part = batch.slice(at, end - at)
                data = column(part, "ids").to_pylist()
                n = np.asarray(column(part, "n"))
                ends = np.cumsum(n + 1)
                real = np.ones(int(ends[-1]), bool)
                real[ends - 1] = False
                ranks = np.full(len(real), rank_of[end_id], np.uint32)
                ranks[real] = rank_of[np.frombuffer(b"".join(data), dtype)]
                control, numbers = pack(ranks, n + 1)
                key = column(part, "doc_id")
                whole = np.asarray(pa.compute.fill_null(key, np.iinfo(np.int64).min))
                mixed = np.fromiter((xxhash.xxh3_64_intdigest(x) >> 1 for x in data), np.int64, len(data))
                low, high = (np.searchsorted(borders, whole, side=side) for side in ("left", "right"))
                own = np.maximum(high - low, 1)  # ranges of this id; its rows are in the order of their hashes
                shard = low + np.minimum((mixed / 2.0**63 * own).astype(np.int64), own - 1)
                yield arrow_rows(coded, [shard.astype(np.int32), key, mixed, n + 1, control, numbers])
                at = end
        give_back()

    files = pa.schema([("shard", pa.int32()), ("segment", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, segment, held, tokens = None, 0, [], 0

        def flush():
            name = f"segment-{shard:06d}-{segment:06d}.tok"
            key = [r[0] for r in held]
            control = b"".join(r[2] for r in held)
            head = [MAGIC, np.array([len(held), len(control)], "<u8").tobytes(), np.array([x or 0 for x in key], "<i8").tobytes(), np.array([x is None for x in key], np.uint8).tobytes()]
            head += [np.array([r[1] for r in held], "<u4").tobytes(), np.array([len(r[3]) for r in held], "<u8").tobytes()]
            write_file(folder, name, [*head, control, *(r[3] for r in held)])
            return arrow_rows(files, [[shard], [segment], [name], [len(held)], [tokens]])

        use_only()
        for batch in batches:
            cols = [column(batch, c).to_pylist() for c in ("shard", "doc_id", "n_tokens", "control", "data")]
            for s, *row in zip(*cols, strict=True):
                if held and (s != shard or tokens + row[1] > SEGMENT_TOKENS):
                    yield flush()
                    segment = segment + 1 if s == shard else 0
                    held, tokens = [], 0
                shard = s
                held.append(row)
                tokens += row[1]
        if held:
            yield flush()
            held = []
        give_back()

    by_range = rows.mapInArrow(code, "shard int, doc_id long, mixed long, n_tokens long, control binary, data binary")
    by_range = by_range.repartition(shards, "shard").sortWithinPartitions("shard", "doc_id", "mixed", "n_tokens", "control", "data")
    written = spill(by_range.mapInArrow(write, "shard int, segment int, file string, n_docs long, n_tokens long"), "token-manifest")
    before = Window.orderBy("shard", "segment").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    manifest = written.select("file", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("long").alias("base"), "n_docs", "n_tokens")
    return TokenFiles(folder, manifest)


def read_token_files(files: TokenFiles) -> DataFrame:
    """Per document, from the files alone: doc_id, start, n_tokens and its ids as little-endian unsigned 32-bit integers."""
    folder = files.folder
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use_only()
        store, base = filesystem(folder)
        with store.open_input_stream(f"{base}/ranks.u32") as f:
            of_rank = np.frombuffer(f.read(), "<u4")
        for batch in batches:
            for name, first in zip(column(batch, "file").to_pylist(), column(batch, "base").to_pylist(), strict=True):
                with store.open_input_file(f"{base}/{name}") as f:
                    if f.read(8) != MAGIC:
                        raise ValueError(f"{name} is not a token segment")
                    n, controls = np.frombuffer(f.read(16), "<u8").astype(int).tolist()
                    key, null, counts, sizes = (np.frombuffer(f.read(n * np.dtype(t).itemsize), t) for t in ("<i8", np.uint8, "<u4", "<u8"))
                    counts, sizes = counts.astype(np.int64), sizes.astype(np.int64)
                    control_at = f.tell() + np.concatenate([[0], np.cumsum((counts + 3) // 4)])
                    data_at = f.tell() + controls + np.concatenate([[0], np.cumsum(sizes)])
                    ends, at = np.cumsum(counts), 0
                    while at < n:
                        done = ends[at - 1] if at else 0
                        end = max(at + 1, int(np.searchsorted(ends, done + READ_TOKENS, side="right")))
                        control = np.frombuffer(f.read_at(int(control_at[end] - control_at[at]), int(control_at[at])), np.uint8)
                        data = np.frombuffer(f.read_at(int(data_at[end] - data_at[at]), int(data_at[at])), np.uint8)
                        ids = of_rank[unpack(control, data, counts[at:end])].astype("<u4").tobytes()
                        cut = 4 * np.concatenate([[0], ends[at:end] - done])
                        ids = [ids[a:b] for a, b in zip(cut.tolist(), cut[1:].tolist(), strict=False)]
                        yield arrow_rows(schema, [pa.array(key[at:end], mask=null[at:end] == 1), first + ends[at:end] - counts[at:end], counts[at:end], ids])
                        at = end

    manifest = files.manifest.select("file", "base")
    parts = max(1, min(manifest.count(), 4 * int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    return manifest.repartition(parts).mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def with_crc(documents: DataFrame) -> DataFrame:
    """The ids of ``read_token_files`` replaced by their unsigned crc32, by Spark's function: a second pass of Python would keep two more workers and all ids in Arrow batches."""
    return documents.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
