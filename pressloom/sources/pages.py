"""Captured article pages (S4, S7 and the detail side of J3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.functions import text as X
from pressloom.functions import times as D
from pressloom.functions import urls as U
from pressloom.operators.scale import computed_once

# Where article bodies stand on publisher pages.
BODY_CLASSES = "entry-content|article-text|left_zw|article-content|articleContent"
BODY_IDS = "artibody|articleContent"
IMAGE_FIELDS = ["og:image", "og:image:url", "twitter:image"]
VIDEO_FIELDS = ["og:video", "og:video:url", "og:video:secure_url"]

_NOT_CONTENT = r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>"
# Atomic and possessive: a tag that is never closed costs no stack and no second look.
_TAG = r"(?s)</?[A-Za-z][A-Za-z0-9]*+(?>[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+>"
_BODY_CLASS = rf"(?:^|\s)(?:{BODY_CLASSES})(?:\s|$)"
_BODY_ID = rf"^(?:{BODY_IDS})$"
_VOID = r"(?i)^<(?:img|meta|link|input|br|hr|source|area|base|embed|wbr)\b"


def attribute(tag: Column, name: str) -> Column:
    """The value of an attribute of one tag, with or without quotes, '' if absent."""
    found = rf"(?is)[\s\"']{name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*))"
    return F.concat(*[F.regexp_extract(tag, found, group) for group in (1, 2, 3)])


def decoded_list(values: Column) -> Column:
    """Texts with one layer of entities decoded; all of a row travel together, and only if one holds an ampersand.

    No entity decodes to the separator.
    """
    joined = X.decode_entities(F.array_join(values, "\u0000"), rounds=1)
    return F.when(F.size(values) > 0, F.split(joined, "\u0000")).otherwise(F.array().cast("array<string>"))


def html_meta(document: Column, name: str) -> Column:
    """Content of a named meta tag in either attribute order, cleaned."""
    named = rf"(?is)<meta\b[^>]*\bname=[\"']{name}[\"'][^>]*\bcontent=[\"'](.*?)[\"'][^>]*>"
    swapped = rf"(?is)<meta\b[^>]*\bcontent=[\"']([^\"']*)[\"'][^>]*\bname=[\"']{name}[\"'][^>]*>"
    return F.coalesce(X.first_match(document, named, 1), X.first_match(document, swapped, 1), F.lit(""))


def _body_images(tags: Column, page_url: Column) -> Column:
    """Source attributes of an article body, in page order, up to the first image that is usable for certain.

    One pass over the tags of a page: the body ends where its own element closes. What is carried is one candidate; only
    sources whose path holds an entity, which decoding may still change, are carried beside it, and nothing after
    the candidate is looked at.
    """
    start = F.struct(
        F.lit("").alias("element"), F.lit(0).alias("depth"), F.array().cast("array<string>").alias("unclear"),
        F.lit(None).cast("string").alias("image"),
    )

    def step(state: Column, tag: Column) -> Column:
        name = F.lower(F.regexp_extract(tag, r"^</?([A-Za-z][A-Za-z0-9]*)", 1))
        closing = tag.startswith("</")
        inside = state["depth"] > 0
        opens = ~closing & ~tag.rlike(_VOID) & ~tag.endswith("/>")
        enters = ~inside & opens & (attribute(tag, "class").rlike(_BODY_CLASS) | attribute(tag, "id").rlike(_BODY_ID))
        same = inside & (name == state["element"])
        source = F.coalesce(
            F.nullif(attribute(tag, "src"), F.lit("")),
            F.nullif(attribute(tag, "data-src"), F.lit("")),
            F.nullif(attribute(tag, "_src"), F.lit("")),
        )
        found = inside & ~closing & (name == "img") & source.isNotNull()
        unclear = source.rlike("^[^?#]*&")
        usable = ~unclear & U.usable_news_image(U.safe_url(source, page_url))
        moved = F.struct(
            F.when(enters, name).otherwise(state["element"]).alias("element"),
            F.when(enters, F.lit(1))
            .when(same & opens, state["depth"] + 1)
            .when(same & closing, state["depth"] - 1)
            .otherwise(state["depth"]).alias("depth"),
            F.when(found & unclear, F.concat(state["unclear"], F.array(source))).otherwise(state["unclear"]).alias("unclear"),
            F.when(found & usable, source).alias("image"),
        )
        return F.when(state["image"].isNotNull(), state).otherwise(moved)

    return F.aggregate(tags, start, step, lambda state: F.array_compact(F.concat(state["unclear"], F.array(state["image"]))))


def page_media(pages: DataFrame) -> DataFrame:
    """Declared image and video of a page; an image in the article body wins.

    Site furniture and images outside the body are never used.
    """
    c = F.col
    declared = F.regexp_extract_all(c("html"), F.lit(r"(?is)<meta\b[^>]*>"), F.lit(0))
    fields = F.transform(
        declared, lambda tag: F.lower(F.coalesce(F.nullif(attribute(tag, "property"), F.lit("")), attribute(tag, "name"))))
    tags = F.regexp_extract_all(F.regexp_replace(c("html"), _NOT_CONTENT, " "), F.lit(_TAG), F.lit(0))
    staged = pages.withColumns({"_fields": fields, "_contents": F.transform(declared, lambda tag: attribute(tag, "content")),
                                "_links": _body_images(tags, c("url"))})
    staged = computed_once(staged, {"_contents": decoded_list(c("_contents")), "_links": decoded_list(c("_links"))})
    metas = F.zip_with("_fields", "_contents", lambda field, content: F.struct(field.alias("field"), F.trim(content).alias("content")))
    staged = staged.withColumn("_metas", F.filter(metas, lambda m: U.is_http(m["content"])))
    links = F.transform(c("_links"), lambda link: U.safe_url(link, c("url")))
    images = F.filter(c("_metas"), lambda m: m["field"].isin(IMAGE_FIELDS) & U.usable_news_image(m["content"]))
    videos = F.filter(c("_metas"), lambda m: m["field"].isin(VIDEO_FIELDS))
    body = F.filter(links, U.usable_news_image)
    return staged.select(
        *[name for name in pages.columns if name != "html"],
        F.coalesce(F.get(body, F.lit(0)), F.get(images, F.lit(0))["content"], F.lit("")).alias("image_url"),
        F.coalesce(F.get(videos, F.lit(0))["content"], F.lit("")).alias("video_url"),
    )


def page_links(pages: DataFrame, path_pattern: str, keywords: list[str]) -> DataFrame:
    """Article links of listing pages; per address the shortest, then first, link text.

    Keeps links to the page's own host with a matching address and a keyword in the text.
    """
    anchors = F.regexp_extract_all(content_html(), F.lit(r"(?is)<a\b[^>]*>.*?</a>"), F.lit(0))
    links = (
        pages.select("page_id", F.col("url").alias("page_url"), F.posexplode(anchors).alias("pos", "anchor"))
        .select(
            "page_id", "pos", "page_url",
            F.regexp_extract("anchor", r"(?is)^<a\b[^>]*>(.*)</a>$", 1).alias("inner"),
            attribute(F.regexp_extract("anchor", r"(?is)^(<a\b[^>]*>)", 1), "href").alias("href"),
        )
    )
    links = computed_once(
        links,
        {
            "title": X.clean_page_text(F.col("inner")),
            "url": U.safe_url(X.decode_entities(F.col("href"), rounds=1), F.col("page_url")),
        },
    )
    kept = links.filter(
        (U.host(F.col("url")) == U.host(F.col("page_url")))
        & F.col("url").rlike(path_pattern)
        & X.contains_any(F.col("title"), keywords)
    )
    order = F.struct(F.length("title"), F.col("page_id"), F.col("pos"))
    return kept.groupBy("url").agg(F.min_by("title", order).alias("title"), F.count(F.lit(1)).alias("mentions"))


def content_html() -> Column:
    return F.regexp_replace(F.col("html"), _NOT_CONTENT, " ")


def page_details(pages: DataFrame) -> DataFrame:
    """Detail fields of article pages: headline, description and the page's own wall time."""
    c = F.col
    clock = F.regexp_extract("html", r"(?is)\bid=[\"']newstime[\"'][^>]*>(.*?)</", 1)
    return pages.select(
        "url",
        X.clean_page_text(F.regexp_extract(c("html"), r"(?is)<h1\b[^>]*>(.*?)</h1>", 1)).alias("detail_title"),
        F.substring(X.clean_page_text(html_meta(c("html"), "description")), 1, 500).alias("detail_summary"),
        D.local_date(clock).alias("detail_published"),
    )
