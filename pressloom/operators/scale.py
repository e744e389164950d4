"""Helpers that keep hot keys and small tables safe at scale."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressloom.session import new_workspace

SALTS = 1024


def top_per_group(df: DataFrame, group: list[str], order: list[Column], limit: int, salt_by: list[str], rank: str = "rank") -> DataFrame:
    """The first ``limit`` rows of each group; ``salt_by`` are columns that tell its rows apart.

    Salted parts of a group are thinned first, so that a hot group never reaches one task whole, whatever the
    limit; Spark thins each of them once more before the shuffle where the limit is small.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*salt_by), F.lit(SALTS)))
    by_salt = Window.partitionBy(*group, "_salt").orderBy(*order)
    thinned = salted.withColumn("_pre", F.row_number().over(by_salt)).filter(F.col("_pre") <= limit).drop("_salt", "_pre")
    window = Window.partitionBy(*group).orderBy(*order)
    return thinned.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= limit)


def limit_of(group: Column, limits: dict[str, int]) -> Column:
    """The limit of a group as an expression; null where none is set."""
    out = F.lit(None).cast("int")
    for name, limit in limits.items():
        out = F.when(group == name, F.lit(max(0, int(limit)))).otherwise(out)
    return out


def rank_in_groups(df: DataFrame, group: str, limits: dict[str, int], order: list[Column],
                   salt_by: str, also: Column | None = None) -> DataFrame:
    """Add ``group_rank`` to the rows of limited groups that can be among the first ``limit``.

    Two rankings: within a salted part of each group, then among the few leaders of all parts. A
    group with most of the rows is thus ranked by many tasks, and the input is read once. Where
    ``also`` is given, the first such row of each part stays a leader too. Rows that cannot be
    chosen keep a null rank.
    """
    listed = F.coalesce(F.col(group).isin(list(limits)), F.lit(False))
    most = max([0, *limits.values()])
    part = Window.partitionBy(group, "_salt")
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(salt_by), F.lit(SALTS)))
    leader = F.row_number().over(part.orderBy(*order)) <= most
    if also is not None:
        first_also = F.row_number().over(Window.partitionBy(group, "_salt", also).orderBy(*order)) == 1
        leader = leader | (also & first_also)
    led = salted.withColumn("_leader", listed & leader)
    whole = Window.partitionBy(group, F.when(F.col("_leader"), F.lit(-1)).otherwise(F.col("_salt")))
    rank = F.row_number().over(whole.orderBy(*order))
    return led.withColumn("group_rank", F.when(F.col("_leader"), rank)).drop("_salt", "_leader")


def cap_per_group(df: DataFrame, group: str, limits: dict[str, int], order: list[Column], salt_by: str) -> DataFrame:
    """Keep at most ``limits[g]`` rows of each listed group; other groups pass whole and unranked.

    Salted parts of a listed group are thinned to the largest limit before they are shuffled; only those
    leaders meet in the ranking of the whole group.
    """
    if not limits:
        return df
    listed = F.coalesce(F.col(group).isin(list(limits)), F.lit(False))
    most = max(0, *limits.values())
    salted = df.filter(listed).withColumn("_salt", F.pmod(F.xxhash64(salt_by), F.lit(SALTS)))
    part = Window.partitionBy(group, "_salt").orderBy(*order)
    leaders = salted.withColumn("_place", F.row_number().over(part)).filter(F.col("_place") <= most)
    ranked = leaders.withColumn("_place", F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    kept = ranked.filter(F.col("_place") <= limit_of(F.col(group), limits)).drop("_salt", "_place")
    return kept.unionByName(df.filter(~listed))


def first_by(value: Column, order: Column) -> Column:
    """Aggregate: the first non-null value in the given order."""
    return F.min_by(value, F.when(value.isNotNull(), order))


def computed_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add costly derived columns that later filters use.

    The optimizer pushes a filter below a projection by copying the projected expressions into
    it. Behind a generator the columns are evaluated once and the filter stays above.
    """
    packed = F.array(F.struct(*[value.alias(name) for name, value in columns.items()]))
    return df.select(*[name for name in df.columns if name not in columns], F.inline(packed))


def with_columns_of(df: DataFrame, schema) -> DataFrame:
    """Add the columns of a schema that a frame lacks, as typed nulls."""
    have = set(df.columns)
    missing = {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in have}
    return df.withColumns(missing) if missing else df


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame as a written table in the shared folder."""
    spark = df.sparkSession
    path = new_workspace(spark, label)
    df.write.parquet(path)
    return spark.read.parquet(path)
