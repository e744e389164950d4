"""Captured RSS and Atom feeds as items.

Feeds are read with the XML source, one read per row tag; namespaces are ignored. Where a field
can stand under several tags the tags are tried in a fixed order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressloom.functions import text as X
from pressloom.functions import urls as U
from pressloom.operators.scale import computed_once

_MEDIA = "array<struct<_VALUE:string,_url:string,_type:string>>"
# With namespaces ignored several elements share a name (title, media:title); all are read in their order.
_TEXTS = "array<struct<_VALUE:string>>"
_LINKS = "array<struct<_VALUE:string,_href:string,_url:string,_type:string>>"
ENTRY_SCHEMA = (
    f"title {_TEXTS}, link {_LINKS}, guid struct<_VALUE:string>, id string, description {_TEXTS}, summary {_TEXTS}, "
    f"content {_MEDIA}, encoded {_TEXTS}, pubDate {_TEXTS}, published {_TEXTS}, updated {_TEXTS}, date {_TEXTS}, "
    f"enclosure {_MEDIA}, thumbnail {_MEDIA}, "
    f"group struct<title:{_TEXTS},description:{_TEXTS},content:{_MEDIA},thumbnail:{_MEDIA}>"
)
IMAGE_FILE = r"(?i)\.(?:jpg|jpeg|png|webp)$"
VIDEO_FILE = r"(?i)\.(?:mp4|m3u8|webm)$"
_MARKUP_LINK = r"(?i)(?:src|href)=[\"'](https?://[^\"']+)"


def read_entries(spark: SparkSession, path: str) -> DataFrame:
    """All ``item`` and ``entry`` elements below a folder of captured feeds."""

    def read(tag: str) -> DataFrame:
        return (
            spark.read.format("xml").schema(ENTRY_SCHEMA).option("rowTag", tag)
            .option("ignoreNamespace", "true").option("attributePrefix", "_")
            .load(path).withColumn("file", F.input_file_name())
        )

    return read("item").unionByName(read("entry"))


def _media_list(rank: int, name: str, column: str) -> Column:
    return F.transform(
        F.coalesce(F.col(column), F.array().cast(_MEDIA)),
        lambda m: F.struct(
            F.lit(rank).alias("rank"), F.lit(name).alias("name"),
            F.trim(F.coalesce(m["_url"], F.lit(""))).alias("url"),
            F.lower(F.coalesce(m["_type"], F.lit(""))).alias("type"),
        ),
    )


def _first(values: Column) -> Column:
    return F.get(values, F.lit(0))


def _first_text(*names: str) -> Column:
    """The first text that is not blank, over the elements of each name in turn."""
    found = [_first(F.filter(F.transform(name, lambda k: X.blank_to_null(k["_VALUE"])), lambda text: text.isNotNull())) for name in names]
    return F.coalesce(*found, F.lit(""))


def with_media(entries: DataFrame, markup: Column) -> DataFrame:
    """Media the feed itself declares, else files linked in its markup; never invented."""
    declared = F.filter(
        F.concat(
            _media_list(0, "enclosure", "enclosure"), _media_list(1, "content", "content"),
            _media_list(2, "thumbnail", "thumbnail"), _media_list(3, "content", "group.content"),
            _media_list(4, "thumbnail", "group.thumbnail"),
        ),
        lambda m: U.is_http(m["url"]),
    )
    staged = computed_once(entries, {"_declared": declared, "_markup": X.decode_entities(markup)})
    # Most texts hold no address at all.
    links = F.when(F.col("_markup").contains("://"), F.regexp_extract_all("_markup", F.lit(_MARKUP_LINK), F.lit(1)))
    staged = computed_once(staged, {"_links": F.coalesce(links, F.array().cast("array<string>"))})
    image = F.filter(F.col("_declared"), lambda m: (m["name"] == "thumbnail") | m["type"].startswith("image/"))
    video = F.filter(F.col("_declared"), lambda m: m["type"].startswith("video/"))
    image_file = F.filter(F.col("_links"), lambda link: U.path(link).rlike(IMAGE_FILE))
    video_file = F.filter(F.col("_links"), lambda link: U.path(link).rlike(VIDEO_FILE))
    found = F.coalesce(_first(image)["url"], _first(image_file), F.lit(""))
    return staged.withColumns(
        {
            "image_url": F.when(U.usable_news_image(found), found).otherwise(F.lit("")),
            "video_url": F.coalesce(_first(video)["url"], _first(video_file), F.lit("")),
        }
    ).drop("_declared", "_markup", "_links")


def feed_items(entries: DataFrame) -> DataFrame:
    """Items with a title and an http link; the whole feed is kept."""
    c = F.col

    link = F.coalesce(
        _first(F.filter(F.transform("link", lambda k: F.coalesce(X.blank_to_null(k["_href"]), X.blank_to_null(k["_VALUE"]))),
                        lambda k: k.isNotNull())),
        F.when(c("guid._VALUE").startswith("http"), c("guid._VALUE")),
        F.when(c("id").startswith("http"), c("id")),
        F.lit(""),
    )
    # The filter on titles and links would copy the text work into itself.
    staged = computed_once(
        entries,
        {
            "raw_title": _first_text("title", "group.title"),
            "raw_summary": _first_text("description", "summary", "content", "group.description", "group.content"),
            "raw_encoded": _first_text("encoded"),
            "raw_link": F.trim(link),
            "raw_published": _first_text("pubDate", "published", "updated", "date"),
        },
    )
    with_files = with_media(staged, F.concat("raw_summary", "raw_encoded"))
    cleaned = computed_once(
        with_files.select("file", "raw_title", "raw_link", "raw_summary", "raw_published", "image_url", "video_url"),
        {
            "title": X.clean_text(c("raw_title")),
            "url": U.canonical_url(c("raw_link")),
            "summary": X.clean_text(c("raw_summary")),
            "published": X.clean_text(c("raw_published")),
        },
    )
    kept = cleaned.filter((c("title") != "") & U.is_http(c("raw_link")))
    return kept.select("file", "title", "url", "summary", "published", "image_url", "video_url")
