"""Exact duplicates by an extendible-hash index on shared files (operator 12). DataFrame functions only.

A scan gathers the hash keys of all texts with their numbers of rows into index files. The directory starts as
one bucket and doubles: every bucket with more keys than its capacity is split by its next hash bit, until
none is overfull or the directory has ``MAX_DEPTH`` bits (then the bucket's chain grows). Buckets are ranges of
hash keys, so each owner task gets the texts of one range of buckets; there the rows of a bucket
are chained by key, and rows of one key are told apart by their bytes, never by the hash alone.

Hot keys, those with more than ``HOT_LEAST`` rows and more than one in ``HOT_KEYS`` of all (so at most
``HOT_KEYS`` of them, the bound of what is broadcast), do not travel row by row: Spark aggregates their texts
map-side, and their rows meet only the few texts that are left.

The hash key reads the text in Unicode lower case, which texts equal after ASCII lowering share; texts that
differ in the case of other letters collide on purpose and part in the chain.

Defined results: a null text counts as empty, and all empty texts are copies of each other; the row with the
largest key stays, a null key being smaller than any other, and of repeated rows with that key exactly one
stays; where all keys of a group are null, ``keep_id`` is null and one row stays; texts are compared whole, whatever
their length; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import string
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressloom.llm.common import stored

# Keys a bucket holds before it is split.
CAPACITY = 2048
# Bits of the largest directory: its 2^20 cells are the bound of what is broadcast.
MAX_DEPTH = 20
HOT_KEYS = 1 << 16
HOT_LEAST = 64


def normalised(text: Column) -> Column:
    """The text with A-Z lowered and nothing else changed (null: empty)."""
    whole = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(whole) == F.length(whole)
    return F.when(ascii_only, F.lower(whole)).otherwise(
        F.translate(whole, string.ascii_uppercase, string.ascii_lowercase))


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.lower(text))


def cell_of(hashed: Column, depth: int) -> Column:
    """The directory cell of a hash key: its leading bits."""
    return F.shiftrightunsigned(hashed, 64 - depth).cast("int") if depth else F.lit(0)


def _prefix(bits: Column) -> Column:
    """The bits of a cell that name its bucket: as many as the local depth."""
    return F.call_function("shiftright", F.col("cell"), bits - F.col("depth"))


@dataclass(frozen=True)
class HashIndex:
    """``keys``: the index files (hash, rows, cell); ``directory``: cell, bucket, local depth for each of 2^depth cells."""

    keys: DataFrame
    directory: DataFrame
    depth: int
    rows: int
    hashed: Callable[[Column], Column]

    def hot_keys(self, least: int = HOT_LEAST) -> DataFrame:
        """At most ``HOT_KEYS`` keys: each has more than one in so many of all rows."""
        return self.keys.filter(F.col("rows") > max(least, self.rows // HOT_KEYS)).select("hash")


def build_index(docs: DataFrame, text: str = "text", capacity: int = CAPACITY, max_depth: int = MAX_DEPTH,
                hashed: Callable[[Column], Column] = text_hash) -> HashIndex:
    """Write the keys of all texts, then split overfull buckets and double the directory until all fit."""
    found = docs.select(hashed(F.coalesce(F.col(text), F.lit(""))).alias("hash")).groupBy("hash").agg(F.count(F.lit(1)).alias("rows"))
    keys = stored(found.withColumn("cell", cell_of(F.col("hash"), max_depth)), "index-keys")
    # One row per finest cell that holds keys: at most 2^max_depth.
    cells = keys.groupBy("cell").agg(F.count(F.lit(1)).alias("keys"), F.sum("rows").alias("rows")).withColumn("depth", F.lit(0))
    depth, total = 0, 0
    while True:
        bucket = _prefix(F.lit(max_depth))
        load = F.sum("keys").over(Window.partitionBy("depth", bucket))
        cells = stored(cells.withColumn("overfull", (load > capacity) & (F.col("depth") < max_depth)), "index-directory")
        state = cells.agg(F.max("overfull").alias("split"), F.max("depth").alias("depth"), F.sum("rows").alias("rows")).first()
        depth, total = state["depth"] or 0, state["rows"] or 0
        if not state["split"]:
            break
        cells = cells.withColumn("depth", F.col("depth") + F.col("overfull").cast("int"))
    directory = cells.select(
        F.shiftright("cell", max_depth - depth).alias("cell"),
        # A bucket is named by the first cell of its range.
        F.call_function("shiftleft", _prefix(F.lit(max_depth)), F.lit(depth) - F.col("depth")).alias("bucket"),
        "depth",
    ).distinct()
    return HashIndex(keys, directory, depth, total, hashed)


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", index: HashIndex | None = None,
                 hot_least: int = HOT_LEAST) -> DataFrame:
    """A row per input row: key, ``keep_id``, ``group_size``, ``kept``, ``text_sha256`` of the normalised text."""
    index = index or build_index(docs, text)
    # Keys that equal one another by value are the same key.
    rows = docs.select(
        F.col(key).alias("key"), F.monotonically_increasing_id().alias("row"), index.hashed(F.coalesce(F.col(text), F.lit(""))).alias("hash"),
        normalised(F.col(text)).alias("bytes"))
    hot = index.hot_keys(hot_least)
    out = _by_owners(rows.join(F.broadcast(hot), "hash", "left_anti"), index)
    if hot.take(1):
        out = out.unionByName(_hot_chains(rows.join(F.broadcast(hot), "hash", "left_semi")))
    return out.select(F.col("key").alias(key), "keep_id", "group_size", "kept", "text_sha256")


def _by_owners(rows: DataFrame, index: HashIndex) -> DataFrame:
    """Deal rows to the owners of their key ranges; each owner sorts its buckets into chains and compares bytes."""
    owners = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    owner = F.floor(F.col("bucket") * F.lit(owners) / F.lit(1 << index.depth)).cast("int")
    # Bound of the directory: 2^MAX_DEPTH cells.
    placed = rows.withColumn("cell", cell_of(F.col("hash"), index.depth)).join(
        F.broadcast(index.directory.select("cell", "bucket")), "cell").withColumn("owner", owner)
    dealt = placed.select("owner", "bucket", "hash", "bytes", "key", "row").repartitionById(owners, F.col("owner"))
    same = Window.partitionBy("owner", "bucket", "hash", "bytes")
    last = F.max(F.struct("key", "row")).over(same)
    return dealt.select("key", last.alias("last"), "row", F.count(F.lit(1)).over(same).alias("group_size"), "bytes").select(
        "key", F.col("last.key").alias("keep_id"), "group_size", (F.col("row") == F.col("last.row")).alias("kept"),
        F.sha2("bytes", 256).alias("text_sha256"))


def _hot_chains(rows: DataFrame) -> DataFrame:
    """Groups of hot keys: their texts meet as aggregates, and each row finds its text in the chain of its key."""
    chains = stored(
        rows.groupBy("hash", "bytes").agg(F.count(F.lit(1)).alias("group_size"), F.max("key").alias("keep_id"))
        .withColumn("text_sha256", F.sha2("bytes", 256)), "index-chains")
    # Written without texts; the written row number tells repeated rows apart.
    linked = stored(rows.join(chains, ["hash", "bytes"]).select(
        "key", "row", "hash", "keep_id", "group_size", "text_sha256"), "index-hot-rows")
    last = linked.filter(F.col("key").eqNullSafe(F.col("keep_id"))).groupBy("hash", "text_sha256").agg(F.max("row").alias("last"))
    return linked.join(last, ["hash", "text_sha256"]).select(
        "key", "keep_id", "group_size", (F.col("row") == F.col("last")).alias("kept"), "text_sha256")
