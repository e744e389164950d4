"""Detail and media joins."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressloom.functions import text as X
from pressloom.functions import times as D
from pressloom.functions.urls import usable_news_image
from pressloom.operators.candidates import utc
from pressloom.operators.ledger import LedgerTable
from pressloom.operators.scale import written
from pressloom.operators.store import KEY, RecordStore
from pressloom.policy import Policy
from pressloom.rules.pack import RulePack
from pressloom.sources.pages import page_media

ATTEMPTS = T.StructType([
    T.StructField("source_id", T.StringType()), T.StructField("url", T.StringType()), T.StructField("run_ts", T.TimestampType())])


def wants_media(policy: Policy, pack: RulePack, now: dt.datetime) -> Column:
    """A fresh item of today that lacks an image, or a trailer item that lacks its video."""
    c = F.col
    no_image = X.text_or_empty(c("image_url")) == ""
    no_video = X.text_or_empty(c("video_url")) == ""
    return (
        c("drop_reason").isNull()
        & F.coalesce(c("enrich_media"), F.lit(False))
        & (c("last_seen_at") == utc(now))
        & (D.civil_day(c("published_ts")) == D.civil_day(utc(now)))
        & (no_image | (no_video & X.contains_any(c("heading"), pack.media_title_words)))
    )


def media_requests(labelled: DataFrame, policy: Policy, pack: RulePack, now: dt.datetime,
                   attempted: DataFrame | None = None) -> DataFrame:
    """The items whose page is read, in scan order; the budget counts attempts.

    ``attempted`` (``source_id, url``) holds the pages that earlier runs asked for: they are not asked for again.
    """
    budget = max(0, policy.max_media_enrichments)
    wanted = labelled.filter(wants_media(policy, pack, now))
    if attempted is not None:
        wanted = wanted.join(attempted.select(*KEY).distinct(), KEY, "left_anti")
    return (
        wanted.select(*KEY, "source_order", "arrival_seq")
        .orderBy("source_order", "arrival_seq")
        .limit(budget)
    )


def found_media(wanted: DataFrame, pages: DataFrame) -> DataFrame:
    """The media that the pages of the wanted items show; ``pages`` holds ``url, html``. Only their pages are parsed."""
    hits = pages.join(wanted.select("url").distinct(), "url", "left_semi")
    media = (
        page_media(hits)
        .groupBy("url")
        .agg(F.max("image_url").alias("image_url"), F.max("video_url").alias("video_url"))
    )
    return wanted.select(*KEY).join(media, "url").select(*KEY, "image_url", "video_url")


def with_media(labelled: DataFrame, found: DataFrame) -> DataFrame:
    """Fill missing media of items with what was found, never overwriting."""
    offered = found.select(*KEY, F.col("image_url").alias("page_image"), F.col("video_url").alias("page_video"))
    filled = labelled.join(offered, KEY, "left")

    def fill(name: str, page: str) -> Column:
        return F.coalesce(X.blank_to_null(F.col(name)), F.col(page), F.lit(""))

    return filled.withColumns(
        {"image_url": fill("image_url", "page_image"), "video_url": fill("video_url", "page_video")}
    ).drop("page_image", "page_video")


def enrich_media(labelled: DataFrame, pages: DataFrame, policy: Policy, pack: RulePack, now: dt.datetime) -> DataFrame:
    """J4 in one go: the budgeted items with the media of their captured pages."""
    return with_media(labelled, found_media(media_requests(labelled, policy, pack, now), pages))


class MediaRun:
    """J4 with memory: what a run finds goes back into the store, and what it asked for into a ledger of attempts."""

    def __init__(self, store: RecordStore, attempts: LedgerTable):
        self.store = store
        self.attempts = attempts

    def enrich(self, labelled: DataFrame, pages: DataFrame, policy: Policy, pack: RulePack, now: dt.datetime) -> tuple[DataFrame, DataFrame]:
        """The filled items, and the requests of this run. A page asked for by an earlier run costs no budget again."""
        part = self.attempts.append(lambda earlier: media_requests(labelled, policy, pack, now, earlier).select(
            *KEY, utc(now).alias("run_ts")))
        asked = self.attempts.read_parts([part])
        found = written(found_media(asked, pages), "found-media")
        self.store.fill(found, {"image_url": ~usable_news_image(F.col("image_url"))})
        return with_media(labelled, found), asked


def enrich_details(items: DataFrame, details: DataFrame) -> DataFrame:
    """Complete list rows from their detail page.

    A row is looked up if it has no date or its source reads details. The list row stays as it is,
    flagged ``detail_unavailable``, where the page is missing or shows no date: collection time
    never stands in. ``details`` holds ``url, detail_title, detail_summary, detail_published``.
    """
    c = F.col
    needed = (X.text_or_empty(c("published")) == "") | F.coalesce(c("read_details"), F.lit(False))
    usable = needed & c("detail_published").isNotNull()
    # Every row joins by its own address: a null key for the rows that need no page would send all
    # of them to one task.
    joined = items.join(details, "url", "left")
    return joined.select(
        *[name for name in items.columns if name not in ("title", "summary", "published")],
        F.when(usable, F.coalesce(X.blank_to_null(c("detail_title")), c("title"))).otherwise(c("title")).alias("title"),
        F.when(usable, X.text_or_empty(c("detail_summary"))).otherwise(c("summary")).alias("summary"),
        F.when(usable, D.iso_stamp(c("detail_published"))).otherwise(c("published")).alias("published"),
        F.when(needed & ~usable, F.lit("detail_unavailable")).otherwise(F.lit("ok")).alias("detail_status"),
    )
