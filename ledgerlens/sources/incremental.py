"""Loads that leave out what earlier loads brought.

``IncrementalTable`` keeps, beside its rows, an index of their keys: key
files in buckets by hash, and a blocked Bloom filter (one block of 32,768
bits for a part of a bucket; all bits of a key lie in one block).  A load

1. keeps one row per key of the landing (``dedupe_transactions``);
2. joins the keys with the few bytes of filter they fall into: most new keys
   are known to be new from that alone;
3. reads the key files of just those buckets in which a key may be present,
   and takes out the keys that are;
4. writes rows, keys and filter blocks into folders of their own and adds
   them to the manifest (see ``sources.manifest``): a load is visible whole
   or not at all, and one that fails leaves nothing behind for readers.

Filter blocks and key files grow by folders; ``compact`` merges them.  Null
key values are values like others.  Buckets and parts are set when the table
is made: about 3,000 keys a block give one false alarm in a hundred, which
costs a read, never a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlens.operators.cleaning import dedupe_transactions
from ledgerlens.session import shared_dir
from ledgerlens.sources.manifest import Manifest

BLOCK_BITS = 1 << 15  # of the bitmap functions
HASHES = 4
BUCKETS = 64
PARTS = 16


class IncrementalTable:
    """A table of ``schema`` with one row for each value of ``keys``; the first that came stays."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType, keys: list[str], buckets: int = BUCKETS, parts: int = PARTS):
        self.spark, self.root, self.schema, self.keys = spark, root.rstrip("/"), schema, keys
        self.manifest = Manifest(spark, self.root)
        self.state = self.manifest.load() or {"buckets": buckets, "parts": parts, "rows": [], "index": [], "loads": 0}

    # ------------------------------------------------------------- places
    def _hash(self, number: int, modulus: int) -> Column:
        return F.pmod(F.xxhash64(*self.keys, F.lit(number)), F.lit(modulus)).cast("int")

    def _placed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumns({"_bucket": self._hash(0, self.state["buckets"]), "_part": self._hash(1, self.state["parts"])})

    def _bits(self) -> list[Column]:
        return [self._hash(2 + k, BLOCK_BITS) for k in range(HASHES)]

    def _key_schema(self) -> str:
        fields = {f.name: f.dataType.simpleString() for f in self.schema.fields}
        return ", ".join(f"`{k}` {fields[k]}" for k in self.keys) + ", _bucket INT"

    # -------------------------------------------------------------- reads
    def _read(self, kind: str, schema: StructType | str, folders: list[str]) -> DataFrame:
        """Several folders as one table; each may be partitioned."""
        if not folders:
            return self.spark.createDataFrame([], schema)
        out = None
        for name in folders:  # each is a base path of its own; compaction bounds their number
            part = self.spark.read.schema(schema).parquet(f"{self.root}/{kind}/{name}")
            out = part if out is None else out.unionByName(part)
        return out

    def read(self) -> DataFrame:
        return self._read("rows", self.schema, self.state["rows"])

    def _filters(self) -> DataFrame:
        blocks = self._read("filters", "_bucket INT, _part INT, bits BINARY", self.state["index"])
        return blocks.groupBy("_bucket", "_part").agg(F.bitmap_or_agg("bits").alias("bits"))

    def known_keys(self, buckets: list[int]) -> DataFrame:
        """The keys of some buckets: other folders are not listed."""
        return self._read("keys", self._key_schema(), self.state["index"]).filter(F.col("_bucket").isin(buckets))

    # -------------------------------------------------------------- loads
    def _maybe_known(self, rows: DataFrame) -> DataFrame:
        """``rows`` with _maybe: whether all bits of the key are set."""

        def is_set(place: Column) -> Column:
            byte = F.conv(F.hex(F.substring("bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
            return F.call_function("shiftright", byte, place % 8).bitwiseAND(F.lit(1)) == 1

        hit = F.col("bits").isNotNull()
        for place in self._bits():
            hit = hit & is_set(place)
        joined = self._placed(rows).join(self._filters(), ["_bucket", "_part"], "left")
        return joined.withColumn("_maybe", F.coalesce(hit, F.lit(False))).drop("bits")

    def load(self, landed: DataFrame, order: list[str]) -> dict:
        """Add the rows whose keys are new; returns loaded, repeated (keys known before) and the buckets that were read."""
        names = self.schema.names
        once = dedupe_transactions(landed.select(*names), self.keys, order)
        path = shared_dir(self.spark, "probed-keys")
        self._maybe_known(once).write.parquet(path)
        probed = self.spark.read.parquet(path)
        touched = sorted(r["_bucket"] for r in probed.filter("_maybe").select("_bucket").distinct().collect())  # at most the buckets
        fresh = probed.filter(~F.col("_maybe"))
        if touched:
            known = self.known_keys(touched).alias("known")
            maybe = probed.filter("_maybe").alias("new")
            same = F.lit(True)
            for k in [*self.keys, "_bucket"]:
                same = same & F.col(f"new.{k}").eqNullSafe(F.col(f"known.{k}"))
            fresh = fresh.unionByName(maybe.join(known, same, "left_anti"))
        name = f"load-{self.state['loads'] + 1:08d}-{path.rsplit('-', 1)[-1]}"
        fresh.select(*names).write.parquet(f"{self.root}/rows/{name}")
        written = self._placed(self.spark.read.schema(self.schema).parquet(f"{self.root}/rows/{name}"))
        written.select(*self.keys, "_bucket").hint("rebalance", "_bucket").write.partitionBy("_bucket").parquet(f"{self.root}/keys/{name}")
        blocks = written.select("_bucket", "_part", F.explode(F.array(*self._bits())).alias("place"))
        blocks = blocks.groupBy("_bucket", "_part").agg(F.bitmap_construct_agg(F.col("place").cast("long")).alias("bits"))
        blocks.write.parquet(f"{self.root}/filters/{name}")
        loaded = written.count()
        state = {**self.state, "rows": [*self.state["rows"], name], "index": [*self.state["index"], name], "loads": self.state["loads"] + 1}
        self.manifest.commit(state)
        self.state = state
        return {"loaded": loaded, "repeated": probed.count() - loaded, "buckets_read": touched}

    def compact(self) -> None:
        """Merge the index's folders into one and publish it."""
        name = f"merged-{self.state['loads']:08d}-{shared_dir(self.spark, 'x').rsplit('-', 1)[-1]}"
        keys = self._read("keys", self._key_schema(), self.state["index"])
        keys.hint("rebalance", "_bucket").write.partitionBy("_bucket").parquet(f"{self.root}/keys/{name}")
        self._filters().write.parquet(f"{self.root}/filters/{name}")
        state = {**self.state, "index": [name]}
        self.manifest.commit(state)
        self.state = state
