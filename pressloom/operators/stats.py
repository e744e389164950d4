"""Counters and coverage."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.functions import text as X
from pressloom.functions import times as D
from pressloom.functions.package import empty_market_note
from pressloom.operators.candidates import candidate_columns, utc
from pressloom.operators.dedup import primary_order
from pressloom.operators.edition import in_edition, language_allowed, reading_order
from pressloom.operators.scale import limit_of, rank_in_groups
from pressloom.policy import Policy
from pressloom.rules.pack import DISTRIBUTION_RANK, RulePack

FUNNEL = ["excluded", "source_filter", "undated", "stale"]


def drop_funnel(labelled: DataFrame) -> DataFrame:
    """records per first-match reason; ``kept`` for candidates."""
    return labelled.groupBy(F.coalesce("drop_reason", F.lit("kept")).alias("reason")).agg(
        F.count(F.lit(1)).alias("records")
    )


def metric_rows(df: DataFrame, metrics: dict[str, Column]) -> DataFrame:
    """One row per metric from a one-row aggregate."""
    pairs = F.array(*[F.struct(F.lit(name).alias("metric"), value.cast("bigint").alias("value"))
                      for name, value in metrics.items()])
    return df.select(F.explode(pairs).alias("m")).select("m.metric", "m.value")


def _outcome(policy: Policy, now: dt.datetime) -> Column:
    return (
        F.when(F.col("drop_reason").isNotNull(), F.col("drop_reason"))
        .when(~language_allowed(policy), F.lit("language"))
        .when(~in_edition(policy, now), F.lit("not_today"))
        .otherwise(F.lit("edition"))
    )


def run_stats(labelled: DataFrame, policy: Policy, pack: RulePack, now: dt.datetime, requests: DataFrame | None = None) -> DataFrame:
    """A2: counters of a run. ``labelled`` keeps the records of disabled sources.

    ``requests`` are the pages that the run asked for media; a run without pages asks for none.

    Record counters (drops before merging) and story counters come from one grouping and one scan:
    a dropped record joins the group of its reason, a candidate the group of its story.
    """
    c = F.col
    fields = ["language", "market", "published_ts", "carry_forward_days", "distribution", "content_priority"]
    is_new = (c("first_seen_at") == utc(now)).cast("bigint")
    groups = (
        candidate_columns(labelled, pack, keep_dropped=True)
        .groupBy("drop_reason", "dedup_key")
        .agg(
            F.min_by(F.struct(*fields), primary_order()).alias("item"),
            F.min("seq").alias("group_seq"),
            F.count(F.lit(1)).alias("records"),
            F.sum(is_new).alias("fresh"),
        )
        .select("drop_reason", "item.*", "group_seq", "records", "fresh")
        .withColumn("outcome", _outcome(policy, now))
        .withColumn("shelf", F.when(c("outcome") == "edition", c("market")))
    )
    limits = policy.max_items_per_market
    if limits:
        limit = limit_of(c("shelf"), limits)
        ranked = rank_in_groups(groups, "shelf", limits, reading_order(), "group_seq")
        fits = limit.isNull() | F.coalesce(c("group_rank") <= limit, F.lit(False))
    else:
        ranked, fits = groups, F.lit(True)
    story = c("drop_reason").isNull()
    in_day = c("outcome") == "edition"
    shown = in_day & fits
    carried = shown & (D.civil_day(c("published_ts")) != D.civil_day(utc(now)))
    row = ranked.withColumns({"_shown": shown, "_carried": carried}).agg(
        F.coalesce(F.sum("records"), F.lit(0)).alias("stored_records"),
        F.coalesce(F.sum("fresh"), F.lit(0)).alias("new_records"),
        F.count_if("_shown").alias("items"),
        F.count_if(story & c("outcome").isin("edition", "not_today")).alias("pool_items"),
        F.count_if(c("outcome") == "language").alias("dropped_language"),
        F.count_if(c("outcome") == "not_today").alias("dropped_not_today"),
        F.count_if(in_day & ~c("_shown")).alias("dropped_capacity"),
        F.count_if("_carried").alias("carried_forward"),
        *[
            F.coalesce(F.sum(F.when(c("outcome") == reason, c("records"))), F.lit(0)).alias(f"dropped_{reason}")
            for reason in FUNNEL
        ],
    )
    if requests is None:
        return metric_rows(row, {**{name: c(name) for name in row.columns}, "media_enrichment_requests": F.lit(0)})
    asked = requests.agg(F.count(F.lit(1)).alias("media_enrichment_requests"))
    return metric_rows(row, {name: c(name) for name in row.columns}).unionByName(
        metric_rows(asked, {name: c(name) for name in asked.columns}))


def distribution_counts(edition: DataFrame) -> DataFrame:
    """A3: items per release channel with zero rows for absent ones."""
    spark = edition.sparkSession
    channels = spark.createDataFrame([(name, rank) for name, rank in DISTRIBUTION_RANK.items()],
                                     "distribution string, rank int")
    counts = edition.groupBy("distribution").agg(F.count(F.lit(1)).alias("n"))
    return channels.join(counts, "distribution", "left").select("distribution", F.coalesce("n", F.lit(0)).alias("items"))


def source_status(items: DataFrame, registry: DataFrame, reports: DataFrame, now: dt.datetime) -> DataFrame:
    """A1: health of every enabled source in this run; a source without items stays visible.

    ``reports`` holds ``source_id, status, message`` of the fetch step. Items of a source that
    failed count as not fetched.
    """
    c = F.col
    cleaned = items.select("source_id", X.collapse_space(X.strip_markup(c("published"))).alias("cleaned"))
    today = (D.civil_day(c("ts")) == D.civil_day(utc(now))).cast("bigint")
    counts = (
        cleaned.select("source_id", D.published_at(c("cleaned")).alias("ts"))
        .groupBy("source_id")
        .agg(
            F.count(F.lit(1)).alias("fetched"),
            F.max("ts").alias("latest"),
            F.sum(today).alias("today_fetched"),
            F.count_if(c("ts").isNull()).alias("undated_items"),
        )
    )
    sources = registry.filter(F.coalesce("enabled", F.lit(False))).select("source_id", "name", "market")
    return (
        sources.join(reports, "source_id", "left")
        .withColumn("status", F.coalesce("status", F.lit("ok")))
        .join(counts, "source_id", "left")
        .select(
            "source_id", "name", "market", "status",
            *[
                F.when(c("status").isin("ok", "partial"), F.coalesce(name, F.lit(0))).otherwise(F.lit(0)).alias(name)
                for name in ("fetched", "today_fetched", "undated_items")
            ],
            F.when(c("status").isin("ok", "partial"), D.iso_stamp(c("latest"))).alias("latest_published_at"),
        )
    )


def source_totals(status: DataFrame) -> DataFrame:
    """Source counters of a run; a partial source counts as successful and as failed."""
    row = status.agg(
        F.count(F.lit(1)).alias("configured_sources"),
        F.count_if(F.col("status").isin("ok", "partial")).alias("successful_sources"),
        F.count_if(F.col("status") != "ok").alias("failed_sources"),
        F.coalesce(F.sum("fetched"), F.lit(0)).alias("fetched_items"),
    )
    return metric_rows(row, {name: F.col(name) for name in row.columns})


def market_coverage(edition: DataFrame, status: DataFrame, policy: Policy) -> DataFrame:
    """A4 with the reason for an empty market."""
    spark = edition.sparkSession
    markets = spark.createDataFrame([(m,) for m in policy.required_markets], "market string")
    items = edition.groupBy("market").agg(F.count(F.lit(1)).alias("items"))
    sources = status.groupBy("market").agg(
        F.count(F.lit(1)).alias("configured_sources"),
        F.count_if(F.col("status").isin("ok", "partial")).alias("successful_sources"),
        F.count_if(F.col("status") != "ok").alias("unavailable_sources"),
    )
    names = ["items", "configured_sources", "successful_sources", "unavailable_sources"]
    joined = markets.join(items, "market", "left").join(sources, "market", "left").select(
        "market", *[F.coalesce(name, F.lit(0)).alias(name) for name in names]
    )
    note = empty_market_note(F.col("items"), F.col("configured_sources"), F.col("successful_sources"), F.col("unavailable_sources"))
    return joined.withColumn("empty_note", note)
