"""Duplicate merging (W1, A5): one primary per key, every source link kept as a row."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pressloom.functions.classify import distribution_rank, source_rank
from pressloom.operators.scale import written
from pressloom.operators.store import KEY
from pressloom.rules.pack import RulePack

ITEM_FIELDS = [
    "id", "title", "summary", "url", "published", "published_ts", "first_seen_at", "last_seen_at",
    "market", "entry_type", "language", "content_priority", "distribution", "carry_forward_days",
    "confidence", "image_url", "video_url", "video_page_url", "author", "author_id", "is_repost",
    "original_post_url", "text_complete", "filings", "original_title", "original_summary",
]


def primary_order():
    """Channel, source priority, then first arrival."""
    return F.struct(
        distribution_rank(F.col("distribution")).alias("channel"),
        F.col("content_priority").alias("priority"),
        F.col("seq").alias("seq"),
    )


def merged_sources(candidates: DataFrame) -> DataFrame:
    """A5: the source links of every merged story, ordered by ``first_seq``."""
    return candidates.groupBy("dedup_key", "publisher_id", "url").agg(
        F.max_by(F.struct("source_id", "source_name", "source_class"), F.col("seq")).alias("source"),
        F.min("seq").alias("first_seq"),
    ).select("dedup_key", "publisher_id", "url", "source.source_id", "source.source_name", "source.source_class", "first_seq")


def merge_duplicates(candidates: DataFrame, pack: RulePack, fields: list[str] | None = None) -> DataFrame:
    """One primary per story, with the evidence of its merged sources as plain columns.

    Candidates are written once; what is ranked and counted are slim rows of keys, order and flags. A ranking to the
    first row is thinned in every task before the shuffle, and counts combine there, so a key with a third of all rows
    ships one row per task. Only the primaries then fetch their texts, by the store's key. A duplicate
    never raises the evidence class: all fields come from the primary.
    """
    fields = fields or [name for name in ITEM_FIELDS if name in candidates.columns]
    c = F.col
    slim = ["dedup_key", "publisher_id", "url", "source_id", "source_class", "distribution", "content_priority", "seq"]
    table = written(candidates.select(*dict.fromkeys([*fields, *slim])), "candidates")
    keyed = table.select("dedup_key", "publisher_id", *KEY, "source_class", "seq", primary_order().alias("order"))

    def first(rows: DataFrame, keys: list[str], order) -> DataFrame:
        ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(order)))
        return ranked.filter("_rank = 1").drop("_rank")

    # The last discovery of a link names its source.
    links = first(keyed, ["dedup_key", "publisher_id", "url"], c("seq").desc())
    evidence = links.groupBy("dedup_key").agg(
        F.count(F.lit(1)).alias("source_count"),
        F.min(source_rank(c("source_class"))).alias("evidence_rank"),
        F.max(F.coalesce(c("source_id").isin(list(pack.social_ids)), F.lit(False))).alias("from_social"),
        F.max(F.coalesce(c("source_class") == "industry_blog", F.lit(False))).alias("from_blog"),
    )
    totals = keyed.groupBy("dedup_key").agg(F.min("seq").alias("group_seq"), F.count(F.lit(1)).alias("record_count"))
    primaries = first(keyed, ["dedup_key"], c("order")).select("dedup_key", *KEY)
    stories = primaries.join(totals, "dedup_key").join(evidence, "dedup_key").select(
        c("dedup_key").alias("_story"), *[c(name).alias(f"_{name}") for name in KEY],
        "group_seq", "source_count", "record_count", "evidence_rank", "from_social", "from_blog")
    own = [table[name] == c(f"_{name}") for name in KEY]
    return table.join(stories, own).select(
        c("_story").alias("dedup_key"), *[table[name] for name in fields],
        "group_seq", "source_count", "record_count", "evidence_rank", "from_social", "from_blog")
