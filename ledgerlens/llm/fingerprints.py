"""MinHash fingerprints of documents, and joins on them.

A fingerprint is the least value of each of ``PERMUTATIONS`` universal
hashes (odd multiplier and shift, modulo 2^64) over the hashes of a text's
five-word shingles (ASCII lower case; a shorter text is one shingle), kept
to 16 bits each; the share of equal places estimates the Jaccard
similarity.  A text without words has the fingerprint of all ones, like
only to others of the kind.

``near_copies`` joins signature bands in Spark: rows with one shingle set
are one class, named by a hash of the set; a band of a class is a column
that it shares with the classes of an equal band.  Pairs of a column are
kept if the exact Jaccard similarity of their shingle sets reaches the
threshold: first every class with the column's pivot, then, where a column
still touches several components, other pivots and last all pairs of
different components that sizes, distances to the pivot and bitmaps leave.
Pairs inside a component are not formed, so a large group of copies costs a
few checks per copy; the components are those of all similar pairs that
share a band.

``edits`` compares each document with an edited text and with the next
document in descending doc_id order (after the last: the first).  Documents
are cut into ranges of ids at ids that exist, so a range needs just the
documents of one border id from the range below.

Nulls: a null text is empty, and no near copy of anything.  A row without
doc_id has no next document: its edited text only loses its end, and
near_next is null; it takes part in classes, but names a component only where
it has no other id.  Rows that share
a doc_id follow each other in the order of their texts' bytes, and have the
class of their own text each.  A table of
one document has itself as the next.  An empty table gives no rows.  Extra
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import arrow_rows, bitmap, column, in_bitmap, spill, text_slices
from ledgerlens.llm.hashing import U, hash_of
from ledgerlens.llm.jaccard_join import WANTED_BITS, bits_of, sets_of, unite, verify, wanted_texts

PERMUTATIONS = 128
BANDS = 32
WIDTH = 5
SLICE_CHARS = 1_500_000
SLICE_ROWS = 20_000
SHARD_CHARS = 8_000_000

_RANDOM = np.random.default_rng(20_240_229)
_FACTOR = _RANDOM.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) * U(2) + U(1)
_ADD = _RANDOM.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)


def signatures(texts: list[str]) -> np.ndarray:
    """One row of 16-bit places per text."""
    return signatures_of(*sets_of(texts, WIDTH)[:2])


def signatures_of(h: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One row of 16-bit places per set, from the hashes of one set after another and the sets' sizes."""
    out = np.full((len(counts), PERMUTATIONS), 0xFFFF, np.uint16)
    some = np.flatnonzero(counts)
    if len(some):
        starts = (np.cumsum(counts) - counts)[some]
        value, narrow = np.empty_like(h), np.empty(len(h), np.uint32)
        for k in range(PERMUTATIONS):
            np.multiply(h, _FACTOR[k], out=value)
            value += _ADD[k]
            value >>= U(32)
            narrow[:] = value
            out[some, k] = np.minimum.reduceat(narrow, starts).astype(np.uint16)  # the low half of the least
    return out


def as_text(signature: np.ndarray) -> list[str]:
    return [x.tobytes().hex() for x in signature.astype(">u2")]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(axis=1)


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by as many first ones of the following text, or all it has."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (text) of every whole text."""
    schema = pa.schema([("doc_id", pa.int64()), ("fingerprint", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches, "text", SLICE_CHARS):
            yield arrow_rows(schema, [column(part, "doc_id"), as_text(signatures(texts))])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, fingerprint string")


_OF_SET = [("t", pa.int64()), ("class_id", pa.int64()), ("n_shingles", pa.int64()), ("bits", pa.binary())]
OF_SET = "t long, class_id long, n_shingles long, bits binary"
_SENT = pa.schema([("shard", pa.int32()), ("guest", pa.bool_()), ("doc_id", pa.int64()), ("t", pa.int64()), ("packed", pa.binary())])


def _neighbours(docs: DataFrame) -> DataFrame:
    """Compressed texts in ranges of ids, each with the documents of the border id below it, in descending order."""
    spark = docs.sparkSession
    chars = docs.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    shards = max(chars // SHARD_CHARS + 1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rough = docs.approxQuantile("doc_id", [(i + 1) / shards for i in range(shards - 1)], min(0.01, 0.25 / shards))
    rough = np.unique(np.array([int(x) for x in rough if x < 2.0**63], np.int64))  # by way of doubles: above 2^53 not always ids

    def greatest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.sort(np.asarray(column(batch, "doc_id")))
            at = np.searchsorted(rough, ids, side="left")
            last = np.flatnonzero(np.append(at[1:] != at[:-1], True)) if len(ids) else []
            yield pa.RecordBatch.from_pydict({"at": pa.array(at[last], pa.int64()), "top": pa.array(ids[last], pa.int64())})

    tops = docs.select("doc_id").filter("doc_id is not null").mapInArrow(greatest, "at long, top long").groupBy("at").agg(F.max("top").alias("top"))
    borders = np.array(sorted(r["top"] for r in tops.collect()), np.int64)  # an id for each range

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small = zstandard.ZstdCompressor(level=1)
        for part, texts in text_slices(batches, "text", SLICE_CHARS):
            packed = [small.compress(x.encode("utf-8", "surrogatepass")) for x in texts]
            rows: list[tuple] = []
            for key, t, x in zip(column(part, "doc_id").to_pylist(), column(part, "t").to_pylist(), packed, strict=True):
                if key is None:
                    rows.append((-1 - hash_shard(x, shards), False, None, t, x))
                    continue
                at = int(np.searchsorted(borders, key, side="left"))
                rows.append((at, False, key, t, x))
                if borders[at] == key:
                    rows.append(((at + 1) % len(borders), True, key, t, x))
            yield arrow_rows(_SENT, list(zip(*rows, strict=True)))

    sent = docs.mapInArrow(run, "shard int, guest boolean, doc_id long, t long, packed binary")
    return sent.repartition(shards, "shard").sortWithinPartitions("shard", "guest", F.desc("doc_id"), "packed")


def hash_shard(data: bytes, shards: int) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=4).digest(), "little") % shards


def edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every document; besides, what ``near_copies`` needs: t (a hash of the text), class_id, n_shingles, bits (of the shingle set)."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()), *_OF_SET])

    def compare(rows: list[tuple]) -> pa.RecordBatch:
        """All rows but the last, whose next document is the row after; (shard, guest, doc_id, t, text)."""
        texts = [r[4] for r in rows]
        h, n, name = sets_of(texts, WIDTH)
        own, bits = signatures_of(h, n), bits_of(h, n)
        at = [i for i, r in enumerate(rows[:-1]) if not r[1]]
        linked = np.array([rows[i][2] is not None and rows[i + 1][0] == rows[i][0] for i in at], bool)
        changed = [edited(texts[i], texts[i + 1] if ok else "") for i, ok in zip(at, linked.tolist(), strict=True)]
        new = signatures(changed)
        own_at, after = own[at], own[[i + 1 for i in at]]
        return arrow_rows(
            schema,
            [
                [rows[i][2] for i in at],
                [len(texts[i]) for i in at],
                [hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in changed],
                as_text(own_at),
                as_text(new),
                likeness(own_at, new),
                pa.array(likeness(own_at, after), mask=~linked),
                [rows[i][3] for i in at],
                name[at].view(np.int64),
                n[at],
                [bits[i] for i in at],
            ],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        large = zstandard.ZstdDecompressor()
        held: list[tuple] = []
        chars = 0
        for batch in batches:
            for *key, packed in zip(*(column(batch, c).to_pylist() for c in ("shard", "guest", "doc_id", "t", "packed")), strict=True):
                if key[1] and len(held) and held[-1][1] and held[-1][0] == key[0]:
                    continue  # only the first document of the border id is next to anyone
                held.append((*key, large.decompress(packed).decode("utf-8", "surrogatepass")))
                chars += len(held[-1][4])
                if (chars > SLICE_CHARS or len(held) > SLICE_ROWS) and len(held) > 1:
                    yield compare(held)
                    held = held[-1:]
                    chars = len(held[0][4])
        if held:
            yield compare([*held, (None, True, None, None, "")])

    out = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, " + OF_SET
    return _neighbours(_read(docs, doc_id, text)).mapInArrow(run, out)


def _read(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("t", F.xxhash64("text"))


def described(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint, t, class_id, n_shingles, bits of every whole text."""
    schema = pa.schema([("doc_id", pa.int64()), ("fingerprint", pa.string()), *_OF_SET])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches, "text", SLICE_CHARS):
            h, n, name = sets_of(texts, WIDTH)
            yield arrow_rows(schema, [column(part, "doc_id"), as_text(signatures_of(h, n)), column(part, "t"), name.view(np.int64), n, bits_of(h, n)])

    return _read(docs, doc_id, text).mapInArrow(run, "doc_id long, fingerprint string, " + OF_SET)


def _bands(rows: DataFrame, hits: np.ndarray | None = None) -> DataFrame:
    """(h, s): every band of every set that has words, named by its place and value; with ``hits`` only those in the bitmap."""
    schema = pa.schema([("h", pa.int64()), ("s", pa.int64())])
    places = np.arange(BANDS, dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signature = np.frombuffer(bytes.fromhex("".join(column(batch, "fingerprint").to_pylist())), np.uint64).reshape(batch.num_rows, BANDS, -1)
            h = hash_of([np.broadcast_to(places, signature.shape[:2]).ravel(), *(signature[:, :, k].ravel() for k in range(signature.shape[2]))]).view(np.int64)
            s = np.repeat(np.asarray(column(batch, "class_id")), BANDS)
            if hits is not None:
                kept = in_bitmap(h, hits)
                h, s = h[kept], s[kept]
            yield arrow_rows(schema, [h, s])

    return rows.filter("n_shingles > 0").select("fingerprint", "class_id").mapInArrow(run, "h long, s long")


def near_copies(docs: DataFrame, percent: int = 75, made: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Classes of near copies, and verified links between sets: enough to connect all similar sets that share a band.

    First, a row per class of documents with one shingle set (none for texts without words): class_id, component_id (the smallest doc_id that links reach), documents (of the component).  Second: a, b (class ids, a < b), jaccard (exact).
    ``made`` is what ``described`` or ``edits`` gave for the same documents, if it is at hand in a table.
    """
    spark = docs.sparkSession
    docs = _read(docs, doc_id, text)
    made = spill(described(docs), "described-texts", "zstd") if made is None else made
    rows = made.filter("n_shingles > 0")
    row = F.struct("doc_id", "t")
    named = rows.groupBy(F.col("class_id").alias("s")).agg(F.count(F.lit(1)).alias("rows"), F.min(row).alias("any"), F.min(F.when(F.col("doc_id").isNotNull(), row)).alias("row"))
    classes = spill(named.withColumn("row", F.coalesce("row", "any")).select("s", "rows", "row.doc_id", "row.t"), "set-classes")
    shared = spill(_bands(rows).groupBy("h").agg(F.min("s").alias("low"), F.max("s").alias("high")).filter("low < high").select("h"), "shared-bands")
    inside = _bands(rows, bitmap(shared, "h", WANTED_BITS)).distinct().join(shared, "h")
    sizes = rows.groupBy(F.col("class_id").alias("s")).agg(F.min("n_shingles").alias("n"))
    cols = spill(inside.join(sizes, "s").select("h", "s", "n", F.lit(True).alias("early")), "shared-columns")
    met = spill(cols.select("s").distinct(), "wanted-sets")
    facts = spill(rows.withColumnRenamed("class_id", "s").join(met, "s", "left_semi").groupBy("s").agg(F.min("bits").alias("bits")), "set-bits")
    texts = spill(wanted_texts(docs, classes.join(met, "s", "left_semi").select("s", "doc_id", "t"), WIDTH), "wanted-texts")
    none = [spark.createDataFrame([], x) for x in ("pivot long, s long, a long, b long, overlap long", "pivot long, s long", "s long, comp long")]
    links, comps = unite(cols, facts, texts, *none, WIDTH, percent)
    to = classes.join(comps, "s", "left").select(F.col("s").alias("class_id"), "rows", "doc_id", F.coalesce("comp", "s").alias("comp"))
    groups = to.groupBy("comp").agg(F.min("doc_id").alias("component_id"), F.sum("rows").alias("documents"))
    pairs = verify(links, texts, WIDTH).select(F.least("pivot", "s").alias("a"), F.greatest("pivot", "s").alias("b"), (F.col("overlap") / (F.col("a") + F.col("b") - F.col("overlap"))).alias("jaccard"))
    return to.join(groups, "comp").select("class_id", "component_id", "documents"), pairs


def marked_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The columns of ``edits`` up to near_next, and of the verified near copies: component_id (the smallest doc_id reached, the row's own for a text without words) and near_documents (rows in the component, itself included)."""
    made = spill(edits(docs, doc_id, text), "edits", "zstd")
    classes, _ = near_copies(docs, made=made, doc_id=doc_id, text=text)
    worded = F.col("n_shingles") > 0
    own = made.columns[: made.columns.index("near_next") + 1]
    return made.join(classes, "class_id", "left").select(*own, F.when(worded, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), F.when(worded, F.col("documents")).otherwise(F.lit(1)).alias("near_documents"))
