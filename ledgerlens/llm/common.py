"""Helpers shared by the corpus operators.

Intermediate tables and files go to the folder that the cluster names in
``spark.checkpoint.dir``.  Workers reach it with ``pyarrow.fs``; a file is
written under a name of its own and then moved, so a repeated task leaves
the same file again.
"""

from __future__ import annotations

import contextlib
import ctypes
import math
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import shared_dir

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spill(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back: later reads don't recompute it."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Rows go to workers in Arrow batches of about ``BATCH_BYTES``; results don't depend on it.

    An executor holds a batch several times over outside its heap, for each task.  The setting stays with the session, since frames that an operator returns run later; one that the session has of its own is kept.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) == "67108864b":  # Spark's default
        spark.conf.set(key, f"{BATCH_BYTES}b")


def crc_mod(column: str, n: int) -> Column:
    """crc32 of the id as text modulo ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % F.lit(n)


def ascii_lower(column: Column) -> Column:
    return F.translate(column, ASCII_UPPER, ASCII_LOWER)


def uri(path: str) -> str:
    """A URI that ``pyarrow.fs`` takes: ``file:/x`` and ``/x`` become ``file:///x``."""
    if path.startswith("file:") and not path.startswith("file://"):
        path = path[len("file:") :]
    return f"file://{path}" if path.startswith("/") else path


def filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri(path))


def write_file(folder: str, name: str, parts: list[bytes]) -> None:
    """Write ``parts`` as ``folder/name`` by way of a file of this attempt's own."""
    store, base = filesystem(folder)
    store.create_dir(base, recursive=True)
    mine = f"{base}/.{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(mine) as out:
        for part in parts:
            out.write(part)
    store.move(mine, f"{base}/{name}")


_KEPT: dict[str, Callable[[], None]] = {}


def kept_by_worker(name: str, clear: Callable[[], None]) -> None:
    """Register what a Python worker keeps from task to task, by how it is dropped."""
    _KEPT[name] = clear


def use_only(*names: str) -> None:
    """Drop what this worker has kept for other operators: workers outlive the stages of a pipeline."""
    for name, clear in _KEPT.items():
        if name not in names:
            clear()
    _return_free_memory()


def give_back() -> None:
    """At a task's end: drop what this worker has kept, and return free memory to the system, which the next stage may need."""
    use_only()


def _return_free_memory() -> None:
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # a C library without it
        ctypes.CDLL(None).malloc_trim(0)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def text_slices(batches: Iterator[pa.RecordBatch], text: str, max_chars: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of the batches of about ``max_chars`` characters (one row at least), with their texts; null is the empty text."""
    for batch in batches:
        col = column(batch, text)
        lengths = np.asarray(pa.compute.fill_null(pa.compute.binary_length(col), 0))
        total = np.cumsum(lengths)
        at = 0
        while at < batch.num_rows:
            before = total[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(total, before + max_chars, side="right")))
            part = batch.slice(at, end - at)
            yield part, [x or "" for x in column(part, text).to_pylist()]
            at = end


def arrow_rows(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def slices_of(values: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """The bytes of ``values`` cut at ``ends`` (element counts so far)."""
    data, width = values.tobytes(), values.itemsize
    starts = np.concatenate([[0], ends[:-1]])
    return [data[a * width : b * width] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def bitmap(df: DataFrame, key: str, most_bits: int) -> np.ndarray:
    """A set of the low bits of the long column ``key`` as a bitmap: 32 places a row, but 2^``most_bits`` at most."""
    bits = min(most_bits, max(15, math.ceil(math.log2(32 * df.count() + 1))))
    place = F.pmod(F.col(key), F.lit(1 << bits)) + 1  # the functions count from one
    rows = df.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("part"))
    out = np.zeros((max(1, (1 << bits) >> 15), 4096), np.uint8)
    for r in rows.collect():  # at most 2^most_bits bits
        out[r["bucket"] - 1] = np.frombuffer(r["part"], np.uint8)
    return out.ravel()


def in_bitmap(keys: np.ndarray, there: np.ndarray) -> np.ndarray:
    """Which of the keys may be in the set."""
    place = keys.view(np.int64) & np.int64(8 * len(there) - 1)
    return (there[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def dealt_in_pairs(rows: DataFrame, group: list[str], member: str, most: int) -> DataFrame:
    """``rows`` with lo, hi and side, so that any two of a group meet where these agree, and groups of more than ``most`` rows are dealt over many places.

    Where lo = hi all pairs count, elsewhere those of different sides.  A row stands as often as its group has parts.
    """
    sizes = rows.groupBy(*group).count().filter(F.col("count") > most)
    large = spill(sizes.select(*group, F.ceil(F.col("count") / most).cast("int").alias("parts")), "large-groups")
    slot = F.pmod(F.xxhash64(member, F.lit(1)), F.col("parts")).cast("int")
    split = rows.join(large, group, "left").withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn("slot", slot)
    split = split.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return split.select(*rows.columns, F.least("slot", "k").alias("lo"), F.greatest("slot", "k").alias("hi"), (F.col("slot") > F.col("k")).alias("side"))
