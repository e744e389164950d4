"""Official filing notices (HTML tables) as filings and as one item per notice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.functions import text as X
from pressloom.functions import urls as U
from pressloom.operators.scale import computed_once, top_per_group, written
from pressloom.sources.pages import html_meta

# Number prefixes of filing categories.
FILING_PREFIXES = {
    "影剧": "故事影片", "影动": "动画影片", "影纪": "纪录影片", "影科": "科教影片",
    "影特": "特种影片", "影虚": "虚拟现实影片", "影合": "合拍影片", "影协": "合拍影片",
}
DEFAULT_CATEGORY = "电影项目"
SAMPLE = 8

_TABLE = r"(?is)<div class=\"hmc4Table\">(.*?)</table>\s*</div>"
_ROW = r"(?is)<tr\b[^>]*>(.*?)</tr>"
_CELL = r"(?is)<td\b[^>]*>(.*?)</td>"
_SCRIPTED = r"(?s)var\s+_(?:badw|biju)\s*=\s*'([^']*)'"


def filing_category(number: Column, fallback: Column) -> Column:
    out = F.when(F.lit(False), fallback)
    for prefix, category in FILING_PREFIXES.items():
        out = out.when(number.startswith(prefix), F.lit(category))
    return out.otherwise(fallback)


def notices(pages: DataFrame) -> DataFrame:
    """Notice pages with headline and date; ``pages`` holds ``url, html``."""
    c = F.col
    # Filters on headline and date would copy the search of the page, and of what the page is made from, into themselves.
    found = computed_once(pages.select("url", "html"), {"html": c("html")}).select(
        "url", "html", html_meta(c("html"), "ArticleTitle").alias("title"), html_meta(c("html"), "PubDate").alias("date"))
    return computed_once(found, {"notice_title": X.clean_text(c("title")), "notice_date": X.clean_text(c("date"))}).drop("title", "date")


def rejected_notices(parsed: DataFrame, filings: DataFrame) -> DataFrame:
    """Pages that are no usable notice, with the reason."""
    c = F.col
    empty = (c("notice_title") == "") | (c("notice_date") == "")
    headless = parsed.filter(empty).select("url", F.lit("no_title_or_date").alias("reason"))
    tableless = parsed.filter(~empty).join(filings.select("url").distinct(), "url", "left_anti")
    return headless.unionByName(tableless.select("url", F.lit("no_filings").alias("reason")))


def filings(parsed: DataFrame) -> DataFrame:
    """One row per filing, with its place in the notice."""
    c = F.col
    usable = parsed.filter((c("notice_title") != "") & (c("notice_date") != ""))
    categories = F.split(F.regexp_extract("html", r"\bstr\s*=\s*[\"']([^\"']+)[\"']", 1), ",")
    tables = usable.select(
        "url", categories.alias("categories"),
        F.posexplode(F.regexp_extract_all(c("html"), F.lit(_TABLE), F.lit(1))).alias("table_pos", "table"),
    )
    rows = tables.select(
        "url", "table_pos",
        F.coalesce(X.blank_to_null(F.get(c("categories"), c("table_pos"))), F.lit(DEFAULT_CATEGORY)).alias("table_category"),
        F.posexplode(F.regexp_extract_all(c("table"), F.lit(_ROW), F.lit(1))).alias("row_pos", "row"),
    )
    # Both filters below would copy the search of a row into themselves.
    cells = computed_once(rows, {"cells": F.regexp_extract_all(c("row"), F.lit(_CELL), F.lit(1))}).filter(F.size("cells") >= 7)
    names = ["row_no", "filing_no", "title", "company", "writer", "result", "region"]

    def cell(index: int) -> Column:
        raw = F.get(c("cells"), F.lit(index))
        return X.clean_text(F.coalesce(X.first_match(raw, _SCRIPTED, 1), raw))

    numbered = computed_once(cells.select("url", "table_pos", "row_pos", "table_category", "cells"), {"row_no": cell(0)})
    return (
        numbered.filter(c("row_no").rlike(r"^\p{Nd}+$"))
        .select(
            "url", F.struct("table_pos", "row_pos").alias("place"), "table_category",
            *[cell(i).alias(n) for i, n in enumerate(names) if i > 0],
        )
        .select(
            "url", "place", *names[1:], filing_category(c("filing_no"), X.clean_text(c("table_category"))).alias("category"),
        )
    )


def notice_items(parsed: DataFrame, rows: DataFrame) -> DataFrame:
    """One item per notice with counts by category and at most eight sample titles.

    Both lists are bounded: categories by their fixed set, samples by the literal limit. The filings are counted and
    sampled, so what both need is written once.
    """
    c = F.col
    rows = written(rows.select("url", "place", "title", "category"), "filings")
    counts = rows.groupBy("url", "category").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first_place"))
    by_notice = counts.groupBy("url").agg(
        F.sum("n").alias("total"),
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("first_place", "category", "n"))),
                lambda x: F.concat(x["category"], x["n"].cast("string"), F.lit("部")),
            ),
            "、",
        ).alias("count_copy"),
    )
    samples = top_per_group(rows.select("url", "place", "title"), ["url"], [c("place")], SAMPLE, ["place"]).groupBy("url").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "title"))), lambda x: x["title"]), "、").alias("samples")
    )
    joined = parsed.drop("html").join(by_notice, "url").join(samples, "url")
    period = F.coalesce(X.first_match(c("notice_title"), r"(?U)关于(\d{4}年\d+月[上下]?)全国电影剧本", 1), c("notice_date"))
    more = F.when(c("total") > SAMPLE, F.concat(F.lit("等"), c("total"), F.lit("部"))).otherwise(F.lit(""))
    return joined.withColumn("period", period).select(
        U.canonical_url(c("url")).alias("url"),
        F.concat(c("period"), F.lit("电影备案立项公示："), c("total"), F.lit("部项目")).alias("title"),
        F.concat(
            F.lit("国家电影局公布"), c("period"), F.lit("电影剧本（梗概）备案、立项结果，共"), c("total"), F.lit("部："),
            c("count_copy"), F.lit("。涉及《"), c("samples"), more,
            F.lit("》。备案立项仅代表项目获准拍摄，不代表已经定档或取得公映许可。"),
        ).alias("summary"),
        F.concat(c("notice_date"), F.lit("T00:00:00+08:00")).alias("published"),
        F.lit("cinema_filing").alias("distribution"),
    )
