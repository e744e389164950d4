"""Chat formatting with collapse of cumulative snapshots (operator 2).

Logs often hold a conversation several times, each time with some more turns. Every turn gets a hash of its
position, role and text; the exclusive-or of the first ``k`` of them is the rolling hash of the prefix of length
``k`` (two hashes of 64 bits). A conversation whose whole hash is a proper prefix of a longer one is a snapshot
and goes by an anti join; of equal conversations the one with the smallest key stays. What is left is rendered.

A long conversation is worked on in segments of its turns: positions and rolling hashes are made within a
segment and then carried over the segments' totals, and the text is rendered in parts of ``PART`` turns, so no
task holds a conversation whole.

Defined results: rows without a conversation key belong to none and are left out; repeated rows count once; turns
of equal number follow each other by role and text (nulls first), null numbers come first; null role and
null text are kept apart from empty ones in comparing and rendered as empty; markers inside a text are broken up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressloom.llm.common import stored

SEGMENT = 4096
PART = 32
# Fixed wording of the rendered turns.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def rendered(role: Column, text: Column) -> Column:
    """One turn in the chat layout; a marker that occurs in the text loses its shape."""
    plain = [F.replace(F.coalesce(value, F.lit("")), F.lit("<|"), F.lit("< |")) for value in (role, text)]
    return F.concat(F.lit(OPEN), plain[0], F.lit("\n"), plain[1], F.lit(CLOSE + "\n"))


def _turn_hash(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), "position", F.col("role").isNull(), "role", F.col("text").isNull(), "text")


def _same_segment() -> Column:
    return (F.col("conv") == F.col("_conv")) & F.col("segment").eqNullSafe(F.col("_segment"))


def positions(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Distinct turns with ``position`` (from 1) and the hashes of turn and prefix, written to the shared folder."""
    named = turns.filter(F.col(conv).isNotNull()).select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.col(role).cast("string").alias("role"),
        F.col(text).cast("string").alias("text")).withColumn("segment", F.floor(F.col("turn") / F.lit(SEGMENT)))
    named = named.dropDuplicates()
    order = [F.col(name).asc_nulls_first() for name in ("turn", "role", "text")]
    within = Window.partitionBy("conv", "segment").orderBy(*order)
    counted = stored(named.withColumn("rank", F.row_number().over(within)), "chat-turns")
    by_conv = Window.partitionBy("conv").orderBy(F.col("segment").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    sizes = counted.groupBy("conv", "segment").agg(F.count(F.lit(1)).alias("size"))
    before = sizes.select(F.col("conv").alias("_conv"), F.col("segment").alias("_segment"),
                          F.coalesce(F.sum("size").over(by_conv), F.lit(0)).alias("before"))
    placed = counted.join(before, _same_segment()).withColumn("position", F.col("rank") + F.col("before"))
    hashed = placed.withColumns({"h1": _turn_hash(1), "h2": _turn_hash(2)})
    rolling = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    slim = hashed.select("conv", "segment", "turn", "role", "text", "position", "h1", "h2",
                         F.bit_xor("h1").over(rolling).alias("r1"), F.bit_xor("h2").over(rolling).alias("r2"))
    return stored(slim, "chat-positions")


def prefixes(placed: DataFrame) -> DataFrame:
    """``conv, position, p1, p2``: the rolling hash of every prefix of every conversation."""
    by_conv = Window.partitionBy("conv").orderBy(F.col("segment").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("conv", "segment").agg(F.bit_xor("h1").alias("t1"), F.bit_xor("h2").alias("t2"))
    carried = totals.select(F.col("conv").alias("_conv"), F.col("segment").alias("_segment"), *[F.coalesce(F.bit_xor(t).over(by_conv), F.lit(0)).alias(c) for t, c in (("t1", "c1"), ("t2", "c2"))])
    return placed.join(carried, _same_segment()).select("conv", "position", F.col("r1").bitwiseXOR(F.col("c1")).alias("p1"),
                                                        F.col("r2").bitwiseXOR(F.col("c2")).alias("p2"))


def maximal(placed: DataFrame) -> DataFrame:
    """``conv`` and ``copies`` of the conversations that no longer one begins with; of equal ones the smallest key."""
    whole = placed.groupBy("conv").agg(F.count(F.lit(1)).alias("position"), F.bit_xor("h1").alias("p1"), F.bit_xor("h2").alias("p2"))
    state = ["position", "p1", "p2"]
    unlike = whole.groupBy(*state).agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("copies"))
    longer = prefixes(placed).join(whole.select("conv", F.col("position").alias("turns")), "conv").filter(F.col("position") < F.col("turns"))
    # A first turn that many share is one row here, combined before the shuffle.
    return unlike.join(longer.select(*state).distinct(), state, "left_anti").select("conv", "copies")


def formatted(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, part, n_turns, copies, chat``: kept conversations, a row for each run of ``PART`` turns."""
    placed = positions(turns, conv, turn, role, text)
    kept = stored(maximal(placed), "chat-kept")
    shown = placed.join(kept, "conv").select("conv", "copies", "position", rendered(F.col("role"), F.col("text")).alias("shown"),
                                             F.floor((F.col("position") - 1) / F.lit(PART)).cast("long").alias("part"))
    rows = shown.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n_turns"), F.max("copies").alias("copies"),
                                             F.sort_array(F.collect_list(F.struct("position", "shown"))).alias("turns"))
    return rows.select(F.col("conv").alias(conv), "part", "n_turns", "copies", F.concat_ws("", F.col("turns.shown")).alias("chat"))
