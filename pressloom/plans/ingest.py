"""Captured feeds, notices, listings and posts as one stream of items for the store, with an outcome per source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.operators.scale import written
from pressloom.session import new_workspace
from pressloom.sources import notices, pages, posts

ITEM = ["source_id", "title", "url", "summary", "published", "image_url", "video_url"]
POST = ["author", "author_id", "post_id", "publisher_id", "is_repost", "original_post_url", "text_complete", "video_page_url"]


def items_of(found: DataFrame, source_id: Column, more: list[str] | None = None) -> DataFrame:
    """A reader's rows with all item fields; a field that the reader does not give is empty."""
    have = set(found.columns)
    fields = [F.coalesce(F.col(name), F.lit("")).alias(name) if name in have else F.lit("").alias(name) for name in ITEM[1:]]
    return found.select(source_id.alias("source_id"), *fields, *[name for name in more or [] if name in have])


def listing_items(links: DataFrame, details: DataFrame) -> DataFrame:
    """Links of listing pages completed from their captured detail pages."""
    joined = links.join(details, "url", "left")
    return joined.select("url", F.coalesce(F.nullif("detail_title", F.lit("")), "title").alias("title"),
                         F.coalesce("detail_summary", F.lit("")).alias("summary"),
                         F.coalesce(F.date_format("detail_published", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit("")).alias("published"))


def notice_feed(captured: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Items, their filings as a child table by address, and rejected pages."""
    parsed = notices.notices(captured)
    rows = notices.filings(parsed)
    return notices.notice_items(parsed, rows), rows, notices.rejected_notices(parsed, rows)


def post_feed(responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Posts once each, and what keeps a target from full success: rejects, and pages that say they are partial.

    Posts and rejects come from one reading of the responses, which is written.
    """
    unpacked = posts.unpack_responses(responses)
    normal = written(posts.normalize_posts(unpacked), "posts")
    partial = posts.partial_pages(responses).select(F.col("target").alias("source_id"), F.lit("partial").alias("reason"), "n")
    rejects = posts.rejected(normal).select(F.col("target").alias("source_id"), F.col("reject").alias("reason"), "n")
    return posts.dedup_posts(posts.accepted(normal)), rejects.unionByName(partial)


def ingest(parts: list[DataFrame]) -> DataFrame:
    """All items with ``arrival_seq``: the place of a row in its part, without any global order.

    Written to the shared folder once, so that the numbers stay when a later job reads the items again.
    """
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part, allowMissingColumns=True)
    path = new_workspace(every.sparkSession, "ingest")
    every.withColumn("arrival_seq", F.monotonically_increasing_id()).write.parquet(path)
    return every.sparkSession.read.parquet(path)


def outcomes(items: DataFrame, rejects: DataFrame, registered: DataFrame) -> DataFrame:
    """Per registered source: items, rejects, and ``ok``, ``partial``, ``failed`` or ``silent``.

    A source that gave neither items nor rejects stays visible; rows of a source that is not registered count too.
    """
    found = items.groupBy("source_id").agg(F.count(F.lit(1)).alias("items"))
    lost = rejects.groupBy("source_id").agg(F.sum("n").alias("rejects"))
    known = registered.select("source_id").distinct().withColumn("registered", F.lit(True))
    joined = found.join(lost, "source_id", "full").join(known, "source_id", "full").select(
        "source_id", F.coalesce("items", F.lit(0)).alias("items"), F.coalesce("rejects", F.lit(0)).alias("rejects"))
    silent = (F.col("items") == 0) & (F.col("rejects") == 0)
    outcome = F.when(silent, "silent").when(F.col("rejects") == 0, "ok").when(F.col("items") > 0, "partial").otherwise("failed")
    return joined.withColumn("outcome", outcome)


def listing_of(captured: DataFrame, path_pattern: str, keywords: list[str]) -> DataFrame:
    return listing_items(pages.page_links(captured, path_pattern, keywords), pages.page_details(captured))
