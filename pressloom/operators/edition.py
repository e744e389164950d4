"""The daily edition."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.functions.classify import distribution_rank
from pressloom.functions.times import civil_day
from pressloom.operators.candidates import utc
from pressloom.operators.scale import cap_per_group
from pressloom.policy import Policy
from pressloom.rules.pack import MARKETS, OBSERVATION


def language_allowed(policy: Policy) -> Column:
    if not policy.render_languages:
        return F.lit(True)
    return F.coalesce(F.col("language").isin(list(policy.render_languages)), F.lit(False))


def filter_language(merged: DataFrame, policy: Policy) -> DataFrame:
    """after merging, the language of the primary decides for the story."""
    return merged.filter(language_allowed(policy))


def age_days(now: dt.datetime) -> Column:
    return F.datediff(civil_day(utc(now)), civil_day(F.col("published_ts")))


def in_edition(policy: Policy, now: dt.datetime) -> Column:
    """today's civil day, or an allowed earlier day of a carried-forward source."""
    today = age_days(now) == 0
    if not policy.allow_carry_forward:
        return today
    return today | age_days(now).between(F.lit(0), F.col("carry_forward_days"))


def edition_day(merged: DataFrame, policy: Policy, now: dt.datetime) -> DataFrame:
    return merged.filter(in_edition(policy, now)).withColumn("is_carried_forward", age_days(now) != 0)


def reading_order() -> list[Column]:
    """Channel, source priority, recency, then arrival."""
    c = F.col
    return [distribution_rank(c("distribution")), c("content_priority"), c("published_ts").desc(), c("group_seq")]


def cap_market(items: DataFrame, policy: Policy) -> DataFrame:
    """Reading budget per market; a market without a limit is not ranked at all."""
    return cap_per_group(items, "market", policy.max_items_per_market, reading_order(), "group_seq")


def position() -> Column:
    """The place of an item in the edition as one sortable value."""
    c = F.col
    return F.struct(
        c("market").alias("market"),
        distribution_rank(c("distribution")).alias("channel"),
        c("content_priority").alias("priority"),
        (-F.unix_micros("published_ts")).alias("recency"),
        c("group_seq").alias("seq"),
    )


def daily_edition(merged: DataFrame, policy: Policy, now: dt.datetime) -> DataFrame:
    """Edition rows with their ``position``; sort by it for display."""
    today = edition_day(filter_language(merged, policy), policy, now)
    return cap_market(today, policy).withColumn("position", position())


def candidate_pool(merged: DataFrame, policy: Policy) -> DataFrame:
    """O1: the uncapped pool for content packs, taken before the day filter, newest first."""
    return filter_language(merged, policy).orderBy(F.col("published_ts").desc(), "group_seq")


def display_section(market: Column) -> Column:
    """An unknown market is shown with the observations."""
    return F.when(market.isin(list(MARKETS)), market).otherwise(F.lit(OBSERVATION))


def write_edition(edition: DataFrame, path: str) -> None:
    """One partition per civil day; a second run of the day replaces that day only."""
    (
        edition.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("edition_date")
        .parquet(path)
    )
