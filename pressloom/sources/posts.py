"""Captured social responses as items; bad envelopes and posts go to a reject table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.functions import text as X
from pressloom.functions import urls as U
from pressloom.operators.scale import top_per_group

POST_SCHEMA = (
    "idstr string, id string, mblogid string, bid string, text string, text_raw string, long_text string, "
    "longText string, is_long_text string, created_at string, original_pic string, bmiddle_pic string, "
    "pics string, page_info string, retweeted_status string, "
    "user struct<idstr:string,id:string,screen_name:string>"
)
_PICS = "array<string>"


def _json(column: Column, path: str) -> Column:
    return F.get_json_object(column, path)


def _truthy(value: Column) -> Column:
    """JSON truth of a field kept as text."""
    return F.coalesce(~value.isin("", "false", "0", "null", "{}", "[]"), F.lit(False))


def unpack_responses(responses: DataFrame) -> DataFrame:
    """One row per post of every response; ``responses`` holds ``target, page, payload``.

    An unknown envelope is never taken for "no news": it becomes a row with ``reject`` set.
    """
    c = F.col
    result = _json(c("payload"), "$.result")
    as_list = F.when(result.startswith("["), result)
    statuses = F.coalesce(_json(c("payload"), "$.result.statuses"), as_list)
    error = F.coalesce(_json(c("payload"), "$.error"), _json(c("payload"), "$.error_code"),
                       _json(c("payload"), "$.result.error"), _json(c("payload"), "$.result.error_code"))
    staged = responses.select(
        "target", "page",
        F.from_json(statuses, "array<string>").alias("posts"),
        error.alias("error"),
        _json(c("payload"), "$.meta.outcome").alias("outcome"),
    )
    reject = (
        F.when(_truthy(c("error")), F.lit("response_error"))
        .when(c("posts").isNull(), F.lit("schema_changed"))
        .when((F.size("posts") == 0) & c("outcome").isNotNull(), F.lit("outcome_unverified"))
    )
    judged = staged.withColumn("reject", reject)
    return judged.select(
        "target", "page", "reject",
        F.posexplode_outer(F.when(c("reject").isNull(), c("posts"))).alias("position", "post"),
    )


def post_url(post: Column) -> Column:
    uid = F.coalesce(F.nullif(post["user"]["idstr"], F.lit("")), post["user"]["id"], F.lit(""))
    bid = F.coalesce(F.nullif(post["mblogid"], F.lit("")), post["bid"], F.lit(""))
    ident = F.coalesce(F.nullif(post["idstr"], F.lit("")), post["id"], F.lit(""))
    return (
        F.when(uid.rlike(r"^\p{Nd}+$") & bid.rlike("^[A-Za-z0-9]+$"), F.concat(F.lit("https://weibo.com/"), uid, F.lit("/"), bid))
        .when(ident.rlike(r"^\p{Nd}+$"), F.concat(F.lit("https://m.weibo.cn/detail/"), ident))
        .otherwise(F.lit(""))
    )


def _http(value: Column) -> Column:
    """The value if it is an http address, else null."""
    return F.nullif(U.safe_url(value), F.lit(""))


def normalize_posts(unpacked: DataFrame) -> DataFrame:
    """Posts as items with ``reject`` set where text or link is missing.

    The posting account and time are kept; a repost links its original and proves nothing.
    """
    c = F.col
    parsed = unpacked.withColumn("p", F.from_json("post", POST_SCHEMA))
    long_raw = F.coalesce(X.blank_to_null(c("p.long_text")), X.blank_to_null(c("p.longText")))
    long_body = F.when(
        long_raw.startswith("{"),
        F.coalesce(
            X.blank_to_null(_json(long_raw, "$.longTextContent")), X.blank_to_null(_json(long_raw, "$.content")),
            X.blank_to_null(_json(long_raw, "$.text")),
        ),
    ).otherwise(long_raw)
    staged = parsed.withColumns(
        {
            "long_body": long_body,
            "pics": F.from_json(c("p.pics"), _PICS),
            "retweet": F.from_json(c("p.retweeted_status"), POST_SCHEMA),
            "user_id": F.coalesce(F.nullif(c("p.user.idstr"), F.lit("")), c("p.user.id"), F.lit("")),
        }
    )
    body = F.coalesce(c("long_body"), F.nullif(c("p.text_raw"), F.lit("")), c("p.text"))
    cleaned = staged.withColumns(
        {
            "summary": X.clean_post_text(body),
            "url": post_url(c("p")),
            "author": F.coalesce(F.nullif(X.clean_post_text(c("p.user.screen_name")), F.lit("")), F.lit("微博账号")),
        }
    )
    pictures = F.filter(
        F.transform(
            F.coalesce(c("pics"), F.array().cast(_PICS)),
            lambda pic: F.coalesce(_http(_json(pic, "$.large.url")), _http(_json(pic, "$.url"))),
        ),
        lambda link: link.isNotNull(),
    )
    page = c("p.page_info")
    reject = (
        F.when(c("reject").isNotNull(), c("reject"))
        .when(c("post").isNotNull() & (c("p").isNull() | (c("summary") == "") | (c("url") == "")), F.lit("bad_post"))
    )
    return cleaned.filter(c("reject").isNotNull() | c("post").isNotNull()).select(
        "target", "page", "position",
        reject.alias("reject"),
        F.when(F.length("summary") > 100, F.concat(F.substring("summary", 1, 100), F.lit("…"))).otherwise(c("summary")).alias("title"),
        "summary", "url",
        F.coalesce(c("p.created_at"), F.lit("")).alias("published"),
        F.coalesce(_http(c("p.original_pic")), _http(c("p.bmiddle_pic")), F.get(pictures, F.lit(0)), F.lit("")).alias("image_url"),
        F.coalesce(_http(_json(page, "$.media_info.stream_url_hd")), _http(_json(page, "$.media_info.stream_url")), F.lit("")).alias("video_url"),
        F.when(_json(page, "$.type") == "video", F.coalesce(_http(_json(page, "$.page_url")), F.lit(""))).otherwise(F.lit("")).alias("video_page_url"),
        "author",
        c("user_id").alias("author_id"),
        F.coalesce(F.nullif(c("p.idstr"), F.lit("")), c("p.id")).alias("post_id"),
        F.concat(F.lit("weibo:"), F.when(c("user_id") != "", c("user_id")).otherwise(c("author"))).alias("publisher_id"),
        F.lit("weibo").alias("platform"),
        _truthy(c("p.retweeted_status")).alias("is_repost"),
        F.when(c("retweet").isNotNull(), post_url(c("retweet"))).otherwise(F.lit("")).alias("original_post_url"),
        (~_truthy(c("p.is_long_text")) | c("long_body").isNotNull()).alias("text_complete"),
    )


def accepted(posts: DataFrame) -> DataFrame:
    return posts.filter(F.col("reject").isNull()).drop("reject")


def rejected(posts: DataFrame) -> DataFrame:
    """Reject counts by target and reason: what keeps a source from full success."""
    return posts.filter(F.col("reject").isNotNull()).groupBy("target", "reject").agg(F.count(F.lit(1)).alias("n"))


def partial_pages(responses: DataFrame) -> DataFrame:
    """Pages by target that hold posts and yet report an outcome: their posts stay, the target is not complete."""
    payload = F.col("payload")
    listed = F.coalesce(_json(payload, "$.result.statuses[0]"), _json(payload, "$.result[0]"))
    told = responses.filter(_json(payload, "$.meta.outcome").isNotNull() & listed.isNotNull())
    return told.groupBy("target").agg(F.count(F.lit(1)).alias("n"))


def dedup_posts(posts: DataFrame) -> DataFrame:
    """Each post once, as first seen over the targets and pages of a source."""
    order = [F.col("target"), F.col("page"), F.col("position")]
    return top_per_group(posts, ["post_id"], order, 1, ["target", "page", "position"]).drop("rank")
