"""Integer centroid clustering with a vantage-point tree over the centroids (operator 11).

Vectors become integers once and are written to the shared folder. In every round the driver builds a
vantage-point tree over the k centroids and broadcasts it (k x dim integers, whatever the table's size). Each
vector searches best-first: a heap of nodes by their lower bound, where a node is given up only when its bound is
greater than the best distance, so that an equally near centroid with a smaller number is still met. Leaves compute
exact integer distances. Sums are gathered per batch, so a round ships k rows per batch at most.

A batch runs the searches of its vectors in step: every vector has its own bounds and takes its own next
node, and numpy does the distances of all vectors that stand at the same node.

Defined results: a vector that is null, has another number of components, or holds null or non-finite ones is
left out, and so is one with a component beyond ``LARGEST`` after scaling, whose squared distances would not fit
a long; a null key hashes as the empty text and stays; repeated rows count each by itself; ties of the starting
order go to the smaller vector; fewer vectors than centroids give as many centroids as there are vectors; an
empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.llm.common import stored

DIM = 64
SCALE = 64
CENTROIDS = 16
ROUNDS = 3
# Largest component in units of 1/SCALE: 64 squared differences of twice that fit a long.
LARGEST = 1 << 27
# Centroids in a leaf.
LEAF = 2
# Rounding of square roots and their sums, relative and absolute: bounds are loosened by it before they prune.
SLACK = 1e-12
NOWHERE = np.iinfo(np.int64).max


@dataclass
class Node:
    """A leaf with centroid numbers, or a vantage centroid with two children and the distances found in each."""

    members: list[int] | None = None
    vantage: int = -1
    near: Node | None = None
    far: Node | None = None
    near_span: tuple[float, float] = (0.0, 0.0)
    far_span: tuple[float, float] = (0.0, 0.0)


def squared(vectors: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer vectors to one centroid."""
    gap = vectors - centroid
    return np.einsum("ij,ij->i", gap, gap)


class VantageTree:
    """A vantage-point tree over integer centroids."""

    def __init__(self, centroids: np.ndarray, leaf: int = LEAF):
        self.centroids = centroids
        self.nodes: list[Node] = []
        if len(centroids):
            self._build(list(range(len(centroids))), leaf)

    def _build(self, members: list[int], leaf: int) -> Node:
        node = Node()
        self.nodes.append(node)
        if len(members) <= leaf:
            node.members = members
            return node
        node.vantage, rest = members[0], np.array(members[1:])
        apart = np.sqrt(squared(self.centroids[rest], self.centroids[node.vantage]).astype(float))
        order = np.argsort(apart, kind="stable")
        half = (len(rest) + 1) // 2
        for name, part in (("near", order[:half]), ("far", order[half:])):
            if len(part):
                setattr(node, f"{name}_span", (float(apart[part].min()), float(apart[part].max())))
                setattr(node, name, self._build([int(i) for i in rest[part]], leaf))
        return node

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of each vector's nearest centroid; of equally near ones the smallest number."""
        n = len(vectors)
        number, best = np.full(n, len(self.centroids)), np.full(n, NOWHERE)
        place = {id(node): i for i, node in enumerate(self.nodes)}
        # Every vector's heap: the lower bound of each node it has met and not yet taken.
        bounds = np.full((n, len(self.nodes)), np.inf)
        bounds[:, 0] = 0.0
        waiting = np.arange(n)
        while len(waiting):
            own = bounds[waiting]
            following = own.argmin(axis=1)
            bound = own[np.arange(len(waiting)), following]
            # Inclusive: a bound equal to the best distance is still followed.
            limit = np.sqrt(best[waiting].astype(float))
            open_ = bound <= limit * (1 + SLACK) + SLACK
            waiting, following = waiting[open_], following[open_]
            bounds[waiting, following] = np.inf
            for taken in np.unique(following):
                rows, node = waiting[following == taken], self.nodes[taken]
                for centroid in node.members if node.members is not None else [node.vantage]:
                    apart = squared(vectors[rows], self.centroids[centroid])
                    better = (apart < best[rows]) | ((apart == best[rows]) & (centroid < number[rows]))
                    best[rows[better]], number[rows[better]] = apart[better], centroid
                if node.members is None:
                    root = np.sqrt(apart.astype(float))
                    for child, (low, high) in ((node.near, node.near_span), (node.far, node.far_span)):
                        if child is not None:
                            gap = np.maximum(np.maximum(low - root, root - high), 0.0)
                            bounds[rows, place[id(child)]] = np.maximum(gap - SLACK * (root + high), 0.0)
            waiting = waiting[np.isfinite(bounds[waiting]).any(axis=1)]
        return number, best


def integer_vectors(vectors: DataFrame, key: str, embedding: str, dim: int, scale: int) -> DataFrame:
    """Key and integer components of every usable vector."""
    part: Column = F.col("value")

    def usable(x: Column) -> Column:
        wide = x.cast("double")
        return x.isNotNull() & ~F.isnan(wide) & (F.abs(wide) <= F.lit(LARGEST / scale))

    found = vectors.select(F.col(key).alias("key"), F.col(embedding).alias("value"))
    whole = F.coalesce((F.size(part) == dim) & F.forall(part, usable), F.lit(False))
    return found.filter(whole).select("key", F.transform(part, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long")).alias("point"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _as_array(batch: pa.RecordBatch, name: str) -> pa.Array:
    column = batch.column(name)
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def start_centroids(points: DataFrame, k: int) -> list[list[int]]:
    """The k vectors with the smallest hash of their key; k rows reach the driver."""
    order = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("key").cast("string"), F.lit(""))), 256)
    return [list(row["point"]) for row in points.orderBy(order, "point").limit(k).collect()]


def moved(points: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after one round: exact floored means; an empty cluster keeps its centroid."""
    dim, k = len(centroids[0]), len(centroids)
    tree = points.sparkSession.sparkContext.broadcast(VantageTree(np.array(centroids, dtype=np.int64)))
    names = [f"s{i}" for i in range(dim)]

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix = _matrix(_as_array(batch, "point"), dim)
            if not len(matrix):
                continue
            number, _ = tree.value.nearest(matrix)
            order = np.argsort(number, kind="stable")
            held, first = np.unique(number[order], return_index=True)
            sums = np.add.reduceat(matrix[order], first, axis=0)
            yield pa.RecordBatch.from_pydict({
                "cluster": pa.array(held.astype(np.int32)), "n": pa.array(np.diff(np.append(first, len(order))).astype(np.int64)),
                **{name: pa.array(sums[:, i]) for i, name in enumerate(names)}})

    parts = points.select("point").mapInArrow(gathered, "cluster int, n long, " + ", ".join(f"{name} long" for name in names))
    # Sums of all rows can pass a long: they are decimals. At most k rows reach the driver.
    whole = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(F.col(name).cast("decimal(38,0)")).alias(name) for name in names])
    out = [list(c) for c in centroids]
    for row in whole.collect():
        assert row["cluster"] < k
        out[row["cluster"]] = [int(row[name]) // int(row["n"]) for name in names]
    tree.unpersist()
    return out


def assigned(points: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """Key, cluster and squared distance of every vector."""
    dim = len(centroids[0])
    tree = points.sparkSession.sparkContext.broadcast(VantageTree(np.array(centroids, dtype=np.int64)))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, best = tree.value.nearest(_matrix(_as_array(batch, "point"), dim))
            yield pa.RecordBatch.from_pydict({
                "key": batch.column("key"), "cluster": pa.array(number.astype(np.int32)), "distance": pa.array(best.astype(np.int64))})

    return points.mapInArrow(placed, f"key {points.schema['key'].dataType.simpleString()}, cluster int, distance long")


def clusters(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", dim: int = DIM, k: int = CENTROIDS,
             rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """A row per usable vector: key, ``cluster``, ``distance``, inertia of the cluster and of all, hash of its centroid."""
    spark = vectors.sparkSession
    points = stored(integer_vectors(vectors, key, embedding, dim, scale), "cluster-points")
    centroids = start_centroids(points, k)
    for _ in range(rounds if centroids else 0):
        centroids = moved(points, centroids)
    if centroids:
        placed = stored(assigned(points, centroids), "cluster-assigned")
    else:
        placed = points.select("key", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
    # One row per cluster, k at most.
    totals = placed.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()
    rows = [(row["cluster"], row["inertia"], sum(r["inertia"] for r in totals),
             hashlib.sha256(",".join(map(str, centroids[row["cluster"]])).encode()).hexdigest()) for row in totals]
    facts = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(facts), "cluster").select(
        F.col("key").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
