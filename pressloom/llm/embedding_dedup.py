"""Embedding near-duplicates by a forest of random-projection trees (operator 4).

Every tree splits the vectors again and again along random directions, at medians fitted on a bounded sample;
a vector close to a split goes to both sides (spill), so that similar vectors part rarely, and another tree
joins those that do. Depth follows the largest count of one label, so leaves keep their size while the
table grows. Vectors are compared within leaves of equal label, in double precision and in blocks; a pair that
meets in several leaves counts in the first only. Links go out as counts and as a spanning set of edges, never as
all pairs.

Equal vectors of one label are one representative with a number of copies before any tree is built.

Defined results: a vector that is null, empty, zero, or holds null or non-finite components, and one with a
null label, links with nothing; vectors of different length never link; a null key keeps its row without
links; repeated rows (same key) are copies of each other, their key counts as smallest once.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressloom.llm.common import prepare, stored
from pressloom.llm.graph import components

THRESHOLD = 0.93
TREES = 6
LEAF = 512
# Compared at a time: a block of a leaf against a block of the same leaf.
BLOCK = 1024
# Bound of the fitted sample, and sample rows below which a node takes its split from its parent's mean.
SAMPLE = 20_000
LEAST_FIT = 64
# Half width of the spill, in standard deviations of the projected difference of two vectors at the threshold.
SPILL = 0.5
SEED = 7


def direction(dim: int, tree: int, level: int) -> np.ndarray:
    """The random unit direction of a level of a tree."""
    found = np.random.default_rng([SEED, dim, tree, level]).standard_normal(dim)
    return found / np.linalg.norm(found)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; the largest component goes to 1 first, so that no square overflows."""
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


class Forest:
    """Split points of all trees for vectors of one length."""

    def __init__(self, sample: np.ndarray, threshold: float = THRESHOLD, trees: int = TREES, most_levels: int = 40):
        self.dim, self.trees = sample.shape[1], trees
        self.margin = SPILL * math.sqrt((2 - 2 * threshold) / self.dim)
        self.splits: list[dict[int, float]] = []
        self.means: list[dict[int, np.ndarray]] = []
        for tree in range(trees):
            splits, means = {}, {1: sample.mean(axis=0)}
            nodes = {1: np.arange(len(sample))}
            for level in range(most_levels):
                below = {}
                for node, rows in nodes.items():
                    if len(rows) < LEAST_FIT:
                        continue
                    shadow = sample[rows] @ direction(self.dim, tree, level)
                    splits[node] = split = float(np.median(shadow))
                    for side, held in ((0, shadow <= split), (1, shadow > split)):
                        below[2 * node + side] = rows[held]
                        if held.any():
                            means[2 * node + side] = sample[rows[held]].mean(axis=0)
                if not below:
                    break
                nodes = below
            self.splits.append(splits)
            self.means.append(means)

    def split(self, tree: int, node: int, towards: np.ndarray) -> float:
        if (found := self.splits[tree].get(node)) is not None:
            return found
        while node not in self.means[tree]:
            node >>= 1
        return float(self.means[tree][node] @ towards)

    def leaves(self, rows: np.ndarray, levels: np.ndarray) -> list[list[int]]:
        """Leaf codes (tree and node) of each row, ascending; ``levels`` is the depth for each row."""
        out: list[list[int]] = [[] for _ in range(len(rows))]
        deepest = int(levels.max()) if len(levels) else 0
        for tree in range(self.trees):
            index, node = np.arange(len(rows)), np.ones(len(rows), dtype=np.int64)
            for level in range(deepest + 1):
                done = levels[index] == level
                for i, code in zip(index[done].tolist(), node[done].tolist()):
                    out[i].append((tree << 48) | code)
                index, node = index[~done], node[~done]
                if not len(index):
                    break
                towards = direction(self.dim, tree, level)
                shadow = rows[index] @ towards
                named, at = np.unique(node, return_inverse=True)
                away = shadow - np.array([self.split(tree, int(x), towards) for x in named])[at]
                low, high = away <= self.margin, away > -self.margin
                index = np.concatenate([index[low], index[high]])
                node = np.concatenate([2 * node[low], 2 * node[high] + 1])
        return [sorted(codes) for codes in out]


def usable(embedding) -> F.Column:
    """Vectors that can have a direction."""
    odd = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~odd & F.exists(embedding, lambda x: x != 0), F.lit(False))


def local_roots(linked: np.ndarray, names: np.ndarray) -> np.ndarray:
    """For each row the smallest name it reaches through the links of a block."""
    roots = names.copy()
    edge_a, edge_b = np.nonzero(linked)
    while True:
        before = roots.copy()
        np.minimum.at(roots, edge_a, before[edge_b])
        if (roots == before).all():
            return roots


def compare(leaf: pd.DataFrame) -> pd.DataFrame:
    """Links between two blocks of a leaf that meet here first: per vector their number and a neighbour to join."""
    code, low, high = int(leaf["code"].iloc[0]), int(leaf["low"].iloc[0]), int(leaf["high"].iloc[0])
    leaf = leaf.sort_values("rep").reset_index(drop=True)
    if len(leaf) < 2:
        return pd.DataFrame({"rep": pd.Series(dtype="int64"), "links": pd.Series(dtype="int64"), "root": pd.Series(dtype="int64")})
    kind = "<f8" if len(leaf["vector"].iloc[0]) == 8 * int(leaf["dim"].iloc[0]) else "<f4"
    rows = unit(np.frombuffer(b"".join(leaf["vector"]), dtype=kind).reshape(len(leaf), -1))
    names, copies = leaf["rep"].to_numpy(np.int64), leaf["copies"].to_numpy(np.int64)
    linked = rows @ rows.T >= leaf["threshold"].iloc[0]
    np.fill_diagonal(linked, False)
    if low != high:
        block = leaf["block"].to_numpy(np.int64)
        linked &= block[:, None] != block[None, :]
    if linked.any():
        # Pairs that share an earlier leaf were compared there.
        held = [(i, other) for i, codes in enumerate(leaf["codes"]) for other in codes if other < code]
        if held:
            at, earlier = np.array([i for i, _ in held]), np.unique([other for _, other in held], return_inverse=True)[1]
            shown = np.zeros((len(leaf), int(earlier.max()) + 1), dtype=np.float32)
            shown[at, earlier] = 1.0
            linked &= (shown @ shown.T) == 0
    links = linked @ copies
    some = links > 0
    return pd.DataFrame({"rep": names[some], "links": links[some], "root": local_roots(linked, names)[some]})


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, trees: int = TREES, key: str = "vec_id",
                    embedding: str = "embedding", label: str = "label") -> DataFrame:
    """``vec_id, n_links, component_id, kept``: a row per input row."""
    spark = vectors.sparkSession
    prepare(spark)
    wide = isinstance(vectors.schema[embedding].dataType.elementType, T.FloatType)
    element, code = ("float", "<f4") if wide else ("double", "<f8")
    good = F.col(key).isNotNull() & F.col(label).isNotNull() & usable(F.col(embedding))

    def pack(batches):
        for batch in batches:
            lists = batch.column("embedding")
            data = np.ascontiguousarray(lists.flatten().to_numpy(zero_copy_only=False), dtype=code).tobytes()
            width = int(code[-1])
            ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])]) * width
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), batch.column("label"), pa.array(np.diff(ends) // width, pa.int32()),
                 pa.array([data[a:b] for a, b in zip(ends[:-1], ends[1:])], pa.binary())], names=["rep", "label", "dim", "vector"])

    packed = vectors.filter(good).select(F.col(key).cast("long").alias("rep"), F.col(label).cast("string").alias("label"),
                                         F.col(embedding).cast(f"array<{element}>").alias("embedding")).mapInArrow(
        pack, "rep long, label string, dim int, vector binary")
    named = stored(packed.withColumns({"s1": F.xxhash64("vector"), "s2": F.xxhash64(F.lit(1), "vector")}), "forest-vectors")
    alike = ["label", "dim", "s1", "s2"]
    stands = named.groupBy(*alike).agg(F.min("rep").alias("first"), F.count(F.lit(1)).alias("copies"))
    stands = stored(stands, "forest-stands")
    # The vector of a representative: rows of a repeated key are equal, one is enough.
    firsts = named.join(stands, alike).filter(F.col("rep") == F.col("first")).dropDuplicates(["rep", *alike])
    reps = stored(firsts.select("rep", "label", "dim", "vector", "copies"), "forest-representatives")
    sizes = reps.groupBy("label", "dim").count()
    depth = F.greatest(F.lit(0), F.ceil(F.log2(F.col("count") / F.lit(LEAF)))).cast("int")
    reps_deep = reps.join(sizes.select("label", "dim", depth.alias("levels")), ["label", "dim"])

    # A bounded sample fits the splits; every vector is routed by them.
    total = reps.count()
    drawn = F.pmod(F.xxhash64(F.lit(SEED), "rep"), F.lit(1 << 30)) < F.lit(int(min(1.0, SAMPLE / max(1, total)) * (1 << 30)))
    sample = reps.filter(drawn).select("rep", "dim", "vector").limit(2 * SAMPLE).collect()
    forests = {}
    for dim in sorted({row["dim"] for row in sample}):
        own = sorted((row["rep"], row["vector"]) for row in sample if row["dim"] == dim)
        forests[dim] = Forest(unit(np.frombuffer(b"".join(v for _, v in own), dtype=code).reshape(len(own), -1)), threshold, trees)
    shared = spark.sparkContext.broadcast(forests)

    def route(batches):
        for batch in batches:
            dims, levels = batch.column("dim").to_numpy(), batch.column("levels").to_numpy()
            vectors_, codes = batch.column("vector").to_pylist(), [None] * batch.num_rows
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                rows = unit(np.frombuffer(b"".join(vectors_[i] for i in at), dtype=code).reshape(len(at), -1))
                # A length that the sample has none of is one leaf.
                found = shared.value[dim].leaves(rows, levels[at]) if dim in shared.value else [[1]] * len(at)
                for i, own in zip(at.tolist(), found):
                    codes[i] = own
            yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in ("rep", "label", "dim", "vector", "copies")),
                                              pa.array(codes, pa.list_(pa.int64()))],
                                             names=["rep", "label", "dim", "vector", "copies", "codes"])

    routed = stored(reps_deep.mapInArrow(route, "rep long, label string, dim int, vector binary, copies long, codes array<long>"),
                    "forest-leaves")
    leaf = ["label", "dim", "code"]
    placed = routed.withColumn("code", F.explode("codes"))
    blocks = placed.groupBy(*leaf).agg(F.count(F.lit(1)).alias("m")).filter(F.col("m") > 1).select(
        *leaf, F.ceil(F.col("m") / F.lit(BLOCK)).cast("int").alias("blocks"))
    parts = placed.join(blocks, leaf).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    met = parts.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumns(
        {"low": F.least("block", "other"), "high": F.greatest("block", "other"), "threshold": F.lit(float(threshold))})
    found = stored(met.groupBy(*leaf, "low", "high").applyInPandas(compare, "rep long, links long, root long"), "forest-links")
    linked = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    known = stands.join(counts.withColumnRenamed("rep", "first"), "first", "left").join(
        linked.withColumnRenamed("node", "first"), "first", "left")
    by_vector = named.select("rep", *alike).join(known, alike).select(
        F.col("rep").alias("_key"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "first").alias("component_id")).dropDuplicates(["_key"])
    out = vectors.select(F.col(key).alias(key)).join(by_vector, F.col(key) == F.col("_key"), "left")
    component = F.coalesce("component_id", key)
    return out.select(key, F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.cast("long").alias("component_id"),
                      F.coalesce(F.col(key) == component, F.lit(False)).alias("kept"))
