"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree (operator 8).

Sizes are words. Targets are shares of the total by weight; a source stops at ``cap`` times its size and the
excess goes to the others by weight (water filling). The documents of a source fall into blocks by a seeded
hash of key and pass, which is a random permutation. A source that needs ``t`` words takes ``t / size`` whole
passes over all its blocks, then the blocks of a further pass in permuted order; the last block is filled up
document by document and its last document is cut after a word, so that the source meets its target exactly.

Output shards get their share of blocks through a binary tree: at each node the vector of block quotas (one
count per source) is split between the two halves by a draw from the multivariate hypergeometric
distribution, so that every shard holds an exact number of blocks and a fair share of each source. A source's
drawn blocks are dealt to the shards in permuted order, hence disjointly, and shuffled within the shard.

Defined results: null or empty texts have size 0 and nothing taken from them; null sources are one source,
the last in order; an empty table gives an empty mix; repeated rows are taken as one document several times
listed (same hash), each row counting by itself; rows with a null key are permuted by a hash of their text.
Rows are told apart by a number of their own, never by their key or any column of the caller: other columns, whatever
their names, change nothing. In the mix the columns ``shard``, ``position`` and ``taken_words`` are the mix's own; columns
of these names in the input give way to them. A cut text keeps its blanks and line breaks up to its last word.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressloom.llm.common import GAP, prepare, stored, word_count

SEED = 20240607
WEIGHTS = (5.0, 2.0, 1.0)
# A block holds at least this many words, and more where there would be more than MOST_BLOCKS of them: the
# table of blocks is small at any size of the input.
BLOCK_WORDS = 1 << 14
MOST_BLOCKS = 1 << 18
# Shards below one task's subtree of the splitting tree.
SUBTREE = 64
# The number of a row: given once, in stored form, so that every later reader sees the same one.
ROW = "_row"


def source_targets(totals: DataFrame, weights: tuple[float, ...], share: float, cap: float) -> DataFrame:
    """Add ``rank``, ``weight`` and ``target`` to ``totals`` (a row per source: ``source``, ``source_size``).

    With sources in order of cap over weight, the level ``L`` of the first source that stays below its cap
    decides: each target is the smaller of its cap and ``weight * L``. Only rows of sources meet in a task.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = totals.withColumn("rank", (F.row_number().over(by_name) - 1).cast("int"))
    listed = F.array(*[F.lit(float(w)) for w in weights])
    ranked = ranked.withColumn("weight", F.get(listed, F.col("rank") % len(weights)))
    ranked = ranked.withColumn("most", F.col("source_size") * F.lit(float(cap)))
    order = Window.orderBy((F.col("most") / F.col("weight")).asc(), F.col("rank"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0))
    total = F.sum("source_size").over(everything) * F.lit(float(share))
    filled = F.coalesce(F.sum("most").over(before), F.lit(0.0))
    level = (total - filled) / F.sum("weight").over(onward)
    levelled = ranked.withColumn("level", level)
    stays = F.when(F.col("most") >= F.col("weight") * F.col("level"), F.col("level"))
    common = F.min_by(stays, F.when(stays.isNotNull(), F.struct(F.col("most") / F.col("weight"), F.col("rank"))))
    levelled = levelled.withColumn("common", common.over(everything))
    target = F.least(F.col("most"), F.coalesce(F.col("weight") * F.col("common"), F.col("most")))
    return levelled.select("source", "source_size", "rank", "weight", F.greatest(target, F.lit(0.0)).alias("target"))


def permuted(passage: Column, blocks: Column, row_hash: Column) -> Column:
    """The block of a row in a pass: a seeded hash, so that each pass has its own permutation."""
    return F.pmod(F.xxhash64(row_hash, passage), blocks)


def split_quotas(counts: np.ndarray, shards: int, generator: np.random.Generator) -> np.ndarray:
    """Split a vector of block quotas between two halves of ``shards``; returns the left half's vector."""
    total = int(counts.sum())
    left = total * (shards // 2) // shards
    if left == 0 or not len(counts):
        return np.zeros_like(counts)
    return generator.multivariate_hypergeometric(counts, left, method="marginals")


def grow_tree(counts: np.ndarray, low: int, high: int, stop: int, seed: int) -> list[tuple[int, int, np.ndarray]]:
    """Split ``[low, high)`` until a node spans at most ``stop`` shards."""
    if high - low <= stop:
        return [(low, high, counts)]
    left = split_quotas(counts, high - low, np.random.default_rng([seed, low, high]))
    middle = low + (high - low) // 2
    return grow_tree(left, low, middle, stop, seed) + grow_tree(counts - left, middle, high, stop, seed)


def node_splitter(stop: int, seed: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def split(node: pd.DataFrame) -> pd.DataFrame:
        node = node.sort_values("rank")
        parts = grow_tree(node["n"].to_numpy(np.int64), int(node["low"].iloc[0]), int(node["high"].iloc[0]), stop, seed)
        return pd.concat([pd.DataFrame({"rank": node["rank"].to_numpy(), "n": n, "low": low, "high": high})
                          for low, high, n in parts])

    return split


def shard_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """Block quotas of every source in every shard: ``rank, shard, n``.

    ``quotas`` has ``rank`` and ``draws`` (blocks that the source gives). A round of the tree splits nodes down
    by a factor of ``SUBTREE``, each node in its own task; a task sees one count per source.
    """
    nodes = quotas.select("rank", F.col("draws").cast("long").alias("n"), F.lit(0).alias("low"), F.lit(shards).alias("high"))
    width = shards
    while width > 1:
        width = max(1, math.ceil(width / SUBTREE))
        nodes = nodes.groupBy("low", "high").applyInPandas(node_splitter(width, seed), "rank int, n long, low int, high int")
    return nodes.select("rank", F.col("low").alias("shard"), "n")


def plan(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, cap: float = 2.0, seed: int = SEED,
         key: str = "doc_id", text: str = "text", source: str = "source", row: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """What the mix takes of each row, and the sources with their targets and block quotas.

    The first frame has ``ROW, key, size, rank, row_hash, blocks, whole, edge, taken_part, taken``; the second one row
    per source. A row is taken ``whole`` times in full, and ``taken_part`` words more in the following pass. ``row`` is
    the number of a row where the caller has numbered the rows.
    """
    prepare(docs.sparkSession)
    number = F.monotonically_increasing_id() if row is None else row
    named = F.when(F.col(key).isNull(), F.xxhash64(F.lit(seed), F.col(text))).otherwise(F.xxhash64(F.lit(seed), F.col(key)))
    sized = stored(docs.select(
        number.alias(ROW), F.col(key).alias("key"), F.col(source).cast("string").alias("source"), word_count(F.col(text)).alias("size"),
        named.alias("row_hash"),
    ), "mix-sizes")
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy(F.lit(0))
    per_block = F.greatest(F.lit(BLOCK_WORDS), F.ceil(F.sum("source_size").over(everything) / F.lit(MOST_BLOCKS)))
    targets = source_targets(totals, weights, share, cap)
    targets = targets.withColumn("words", F.floor(F.col("target") + F.lit(0.5)).cast("long"))
    targets = targets.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("words") / F.col("source_size")))
                                 .otherwise(F.lit(0)).cast("int"))
    targets = stored(
        targets.withColumn("rest", F.col("words") - F.col("whole") * F.col("source_size"))
        .withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("source_size") / per_block)).cast("long")),
        "mix-targets",
    )
    by_source = sized["source"].eqNullSafe(targets["source"])
    placed = sized.join(targets.drop("words"), by_source).drop(sized["source"])
    placed = placed.withColumn("block", permuted(F.col("whole"), F.col("blocks"), F.col("row_hash")))
    # The block in which the last pass ends: block sums in permuted order.
    sums = placed.groupBy("rank", "block", "rest").agg(F.sum("size").alias("block_size"))
    running = F.sum("block_size").over(Window.partitionBy("rank").orderBy("block"))
    edges = stored(
        sums.withColumn("end", running).filter((F.col("end") >= F.col("rest")) & (F.col("rest") > 0))
        .groupBy("rank").agg(F.min("block").alias("edge"), F.min_by(F.col("rest") - F.col("end") + F.col("block_size"), "block").alias("room")),
        "mix-edges",
    )
    cut = placed.join(edges, "rank", "left")
    in_edge = F.coalesce(F.col("block") == F.col("edge"), F.lit(False))
    # Only the rows of an edge block, one block per source, are put in order.
    order = Window.partitionBy("rank").orderBy("row_hash", "key", "size", ROW).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("size").over(order), F.lit(0))
    last = cut.filter(in_edge).withColumn("taken_part", F.greatest(F.lit(0), F.least(F.col("size"), F.col("room") - before)))
    full = cut.filter(~in_edge).withColumn(
        "taken_part", F.when(F.col("block") < F.col("edge"), F.col("size")).otherwise(F.lit(0)))
    rows = full.unionByName(last).withColumn("taken_part", F.col("taken_part").cast("long"))
    rows = rows.withColumn("taken", F.col("whole") * F.col("size") + F.col("taken_part"))
    sources = targets.join(edges, "rank", "left").withColumn(
        "draws", F.col("whole") * F.col("blocks") + F.coalesce(F.col("edge") + 1, F.lit(0)))
    return rows, sources


def drawn(rows: DataFrame, sources: DataFrame, shards: int, seed: int) -> DataFrame:
    """The mix without its texts, written to the shared folder: ``ROW, _pass, _size, shard, position, taken_words``.

    A row per copy that is dealt to a shard. ``rows`` and ``sources`` are those of ``plan``; a copy is in the mix only
    if the tree gave its block to a shard.
    """
    quotas = shard_quotas(sources.select("rank", "draws"), shards, seed)
    upto = Window.partitionBy("rank").orderBy("shard")
    dealt = quotas.withColumn("stop", F.sum("n").over(upto)).filter(F.col("n") > 0)
    # A row per drawn block: bounded by MOST_BLOCKS and the number of sources.
    dealt = stored(dealt.select("rank", "shard", F.explode(F.sequence(F.col("stop") - F.col("n"), F.col("stop") - 1)).alias("draw")),
                   "mix-blocks")
    passes = F.transform(F.sequence(F.lit(0), F.col("whole")), lambda i: F.struct(
        i.alias("pass"), F.when(i < F.col("whole"), F.col("size")).otherwise(F.col("taken_part")).alias("taken_words")))
    copies = rows.select(ROW, "rank", "row_hash", "blocks", "size", F.inline(passes)).filter(F.col("taken_words") > 0)
    copies = copies.withColumn("draw", F.col("pass") * F.col("blocks") + permuted(F.col("pass"), F.col("blocks"), F.col("row_hash")))
    return stored(copies.join(dealt, ["rank", "draw"]).select(
        ROW, F.col("pass").alias("_pass"), F.col("size").alias("_size"), "shard",
        F.xxhash64(F.lit(seed), "row_hash", "pass").alias("position"), "taken_words"), "mix-drawn")


def mix_report(docs: DataFrame, shards: int = 64, seed: int = SEED, key: str = "doc_id", **options) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken``.

    ``taken`` counts the words of the copies that were drawn and dealt to the shards.
    """
    rows, sources = plan(docs, seed=seed, key=key, **options)
    rows = stored(rows.select(ROW, "key", "rank", "row_hash", "blocks", "whole", "taken_part", "size", "source_size", "target"),
                  "mix-rows")
    taken = drawn(rows, sources, shards, seed).groupBy(ROW).agg(F.sum("taken_words").alias("taken"))
    return rows.join(taken, ROW, "left").select(
        F.col("key").alias(key), "size", "source_size", "target", F.coalesce(F.col("taken"), F.lit(0)).cast("long").alias("taken"))


def mixed(docs: DataFrame, shards: int = 64, seed: int = SEED, key: str = "doc_id", text: str = "text",
          **options) -> DataFrame:
    """The mix itself: the rows of ``docs`` as often as they are taken, with ``shard``, ``position`` and ``taken_words``.

    Rows are dealt to shards by whole blocks and ordered by ``position`` within a shard (a seeded shuffle). A row that
    is cut keeps its first ``taken_words`` words.
    """
    # The caller's columns travel inside one column, so that no name of theirs meets a name of the plan.
    given = stored(docs.select(F.monotonically_increasing_id().alias(ROW), F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("doc")), "mix-docs")
    own = {name: F.col("doc")[name] for name in docs.columns}
    named = {"key": own[key], "text": own[text], "source": own[options.pop("source", "source")]}
    rows, sources = plan(given.select(ROW, *[value.alias(name) for name, value in named.items()]), seed=seed, key="key", text="text",
                         source="source", row=F.col(ROW), **options)
    rows = stored(rows.select(ROW, "rank", "row_hash", "blocks", "whole", "taken_part", "size"), "mix-rows")
    out = given.join(drawn(rows, sources, shards, seed), ROW)
    shown = F.when(F.col("taken_words") < F.col("_size"), first_words(own[text], F.col("taken_words"))).otherwise(own[text])
    mine = ["shard", "position", "taken_words"]
    kept = [(shown if name == text else value).alias(name) for name, value in own.items() if name not in mine]
    return out.select(*kept, *mine)


def first_words(text: Column, words: Column) -> Column:
    """A text up to the end of its n-th word, everything before it as it stands."""
    blanks = F.lit(" \t\n\r\v\f")
    rest = F.get(F.split(F.ltrim(text, blanks), GAP, words.cast("int") + 1), words.cast("int"))
    return F.rtrim(F.substring(text, F.lit(1), F.length(text) - F.length(F.coalesce(rest, F.lit("")))), blanks)
