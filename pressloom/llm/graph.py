"""Connected components of large link tables, as Spark joins over files in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressloom.llm.common import stored


def components(links: DataFrame, a: str = "a", b: str = "b", rounds: int = 100) -> DataFrame:
    """``node, component`` for every node of a link: the smallest node reachable from it.

    Alternating large-star and small-star rounds: each node hands its larger neighbours, then its smaller
    ones, to the smallest node it sees. Every round writes its links to the shared folder, so lineage stays
    short and a lost executor costs one round. Hot nodes meet only in aggregates that combine on the map side
    and in plain joins that adaptive execution can split. Links with nulls and links of a node to itself add
    nothing but are allowed.
    """
    edges = links.select(F.least(a, b).alias("v"), F.greatest(a, b).alias("u")).filter(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()
    edges, state = _measured(edges)
    for _ in range(rounds):
        before = state
        both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        edges = _towards_smallest(both, F.col("v") > F.col("u"))
        edges, state = _measured(_towards_smallest(edges, F.lit(True)))
        if state == before:
            break
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _measured(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """Write the links and take a fingerprint of the set: settled when it stays the same."""
    kept = stored(edges, "components")
    place = F.xxhash64("u", "v")
    return kept, tuple(kept.agg(F.count(F.lit(1)), F.bit_xor(place)).first())


def _towards_smallest(edges: DataFrame, moved) -> DataFrame:
    """Link the neighbours ``v`` of each ``u`` that ``moved`` selects, and ``u`` itself in the small star, to the smallest node around ``u``."""
    smallest = edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    joined = edges.join(smallest, "u")
    out = joined.filter(moved).select(F.col("m").alias("v"), F.col("v").alias("u"))
    out = out.unionByName(smallest.select(F.col("m").alias("v"), "u"))
    return out.filter(F.col("u") != F.col("v")).distinct()
