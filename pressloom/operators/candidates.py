"""From stored records to edition candidates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.functions import classify as K
from pressloom.functions import text as X
from pressloom.functions import times as D
from pressloom.functions import urls as U
from pressloom.operators.scale import computed_once, with_columns_of
from pressloom.policy import Policy
from pressloom.rules.pack import RulePack
from pressloom.schemas import STORE

DROP_REASONS = ["disabled_source", "excluded", "source_filter", "undated", "stale"]
SUMMARY_CHARS = 800


def utc(now: dt.datetime) -> Column:
    return F.expr(f"timestamp'{now:%Y-%m-%d %H:%M:%S}Z'")


def stored_news(records: DataFrame) -> DataFrame:
    """Records with every store column present."""
    return with_columns_of(records, STORE)


def source_columns(registry: DataFrame) -> DataFrame:
    """The registry side of the record join, one row per enabled source."""
    return registry.filter(F.coalesce("enabled", F.lit(False))).select(
        F.col("source_id"),
        "source_order",
        F.col("name").alias("src_name"),
        F.coalesce("publisher_id", "source_id").alias("src_publisher_id"),
        F.col("source_class").alias("src_class"),
        F.col("market").alias("src_market"),
        "infer_market",
        F.col("entry_type").alias("src_entry_type"),
        F.col("language").alias("src_language"),
        F.col("distribution").alias("src_distribution"),
        F.col("content_priority").alias("src_priority"),
        F.col("carry_forward_days").alias("src_carry_days"),
        "filter_scope",
        F.col("max_age_hours").alias("src_max_age"),
        "enrich_media",
        K.keyword_pattern(F.col("include_keywords")).alias("include_pattern"),
        K.keyword_pattern(F.col("exclude_keywords")).alias("exclude_pattern"),
    )


def items_with_source(records: DataFrame, registry: DataFrame, keep_disabled: bool = False) -> DataFrame:
    """Records joined with their enabled source.

    No hint: adaptive execution broadcasts a registry of small size in bytes and splits a hot source otherwise.
    """
    return records.join(source_columns(registry), "source_id", "left" if keep_disabled else "inner")


def drop_reason(policy: Policy, pack: RulePack, now: dt.datetime) -> Column:
    """First reason to leave a record out of the edition; null for a candidate."""
    c = F.col
    scoped = F.when(c("filter_scope") == "title", c("heading")).otherwise(c("whole"))
    age = F.unix_micros(utc(now)) - F.unix_micros(c("published_ts"))
    hour = 3_600_000_000
    max_age = (F.coalesce(c("src_max_age"), F.lit(float(policy.max_age_hours))) * hour).cast("bigint")
    return (
        F.when(c("source_order").isNull(), F.lit("disabled_source"))
        .when(K.is_excluded(c("src_entry_type"), c("heading"), c("whole"), policy, pack), F.lit("excluded"))
        .when(~K.passes_source_filter(scoped, c("include_pattern"), c("exclude_pattern")), F.lit("source_filter"))
        .when(c("published_ts").isNull(), F.lit("undated"))
        .when((age < -hour) | (age > max_age), F.lit("stale"))
    )


def label_records(records: DataFrame, registry: DataFrame, policy: Policy, pack: RulePack,
                  now: dt.datetime, keep_disabled: bool = False) -> DataFrame:
    """Records with their source and ``drop_reason``; nothing is filtered yet."""
    c = F.col
    news = stored_news(records).withColumns(
        {
            "title": X.text_or_empty(c("title")),
            "summary": X.text_or_empty(c("summary")),
            "published_clean": X.collapse_space(X.strip_markup(c("published"))),
        }
    )
    derived = {
        "heading": X.search_text(c("title")),
        "whole": X.search_text(F.concat_ws(" ", "title", "summary")),
        "published_ts": D.published_at(c("published_clean")),
        "image_url": F.when(U.usable_news_image(c("image_url")), c("image_url")).otherwise(F.lit("")),
    }
    joined = computed_once(items_with_source(news, registry, keep_disabled), derived)
    return joined.withColumn("drop_reason", drop_reason(policy, pack, now))


def candidate_columns(labelled: DataFrame, pack: RulePack, keep_dropped: bool = False) -> DataFrame:
    """Candidate fields of labelled records that were not dropped.

    With ``keep_dropped`` the dropped ones stay for counting, without key and channel.
    """
    c = F.col
    alive = c("drop_reason").isNull()
    kept = labelled if keep_dropped else labelled.filter(alive)

    def of_kept(value: Column) -> Column:
        return F.when(alive, value) if keep_dropped else value

    lead = X.search_text(F.substring("summary", 1, 100))
    market = K.item_market(c("infer_market"), c("src_market"), c("heading"), lead, pack)
    cut = kept.withColumns({"market": market, "summary": F.substring("summary", 1, SUMMARY_CHARS)}).withColumns(
        {
            "folded": X.search_text(F.concat_ws(" ", "title", "summary")),
            "confidence": K.confidence(c("src_class")),
        }
    )
    configured = F.coalesce(X.blank_to_null(c("distribution")), c("src_distribution"))
    text = {name: X.text_or_empty(c(name)) for name in
            ("video_url", "video_page_url", "author", "author_id", "original_post_url")}
    return cut.select(
        K.record_id(c("source_id"), c("url")).alias("id"),
        "title",
        "summary",
        "url",
        "published",
        "published_ts",
        "first_seen_at",
        "last_seen_at",
        "market",
        c("src_entry_type").alias("entry_type"),
        c("src_language").alias("language"),
        F.coalesce("src_priority", F.lit(3)).alias("content_priority"),
        of_kept(K.classify_distribution(configured, c("title"), c("folded"), c("src_entry_type"), pack)).alias("distribution"),
        F.coalesce("src_carry_days", F.lit(0)).alias("carry_forward_days"),
        "confidence",
        "image_url",
        *[value.alias(name) for name, value in text.items()],
        F.coalesce("is_repost", F.lit(False)).alias("is_repost"),
        F.coalesce("text_complete", F.lit(True)).alias("text_complete"),
        "filings",
        "source_id",
        F.coalesce(X.blank_to_null(c("publisher_id")), c("src_publisher_id")).alias("publisher_id"),
        F.when(X.text_or_empty(c("author")) != "", F.concat(F.lit("微博 · "), c("author")))
        .otherwise(c("src_name")).alias("source_name"),
        c("src_class").alias("source_class"),
        F.struct(c("source_order"), c("arrival_seq")).alias("seq"),
        of_kept(
            K.dedup_key(c("title"), c("summary"), c("url"), c("source_id"), c("confidence"), c("published_ts"), pack)
        ).alias("dedup_key"),
        *([c("drop_reason")] if keep_dropped else []),
    )


def candidates(records: DataFrame, registry: DataFrame, policy: Policy, pack: RulePack, now: dt.datetime) -> DataFrame:
    return candidate_columns(label_records(records, registry, policy, pack, now), pack)
