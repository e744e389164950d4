"""Views over the given parquet tables in the shape of the jobs' inputs.

The tables hold Latin-script prose, so the jobs run on them with the Latin rule pack. All
columns are derived row by row from the given rows; no text is cut.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.policy import Policy
from pressloom.session import SPREAD

NOW = dt.datetime(2024, 1, 2, 18, 0, 0)

POLICY = Policy(
    max_age_hours=40.0,
    allow_carry_forward=True,
    render_languages=("en", "fr"),
    excluded_entry_types=("advert",),
    excluded_keywords=("thnd", "worthless"),
    max_items_per_market={"m-cn": 6, "m-hmt": 3, "m-intl": 40},
    max_media_enrichments=8,
)


ROW_KEYS = {"documents": ["doc_id"], "pages": ["page_id"], "events": ["event_id"], "conversations": ["conv_id", "turn"],
            "benchmark": ["item_id"]}


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = True) -> DataFrame:
    """One of the given tables, read as it lies.

    A session may ask, by ``spark.pressloom.spread``, to deal tables with a row key to that many partitions:
    local sessions do so for the single-part files of tests. The setting says it, not the size of a table.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    parts = spark.conf.get(SPREAD, None)
    return df.repartition(int(parts), *ROW_KEYS[name]) if spread and parts and name in ROW_KEYS else df


def headline(text: Column) -> Column:
    """Headline of a record: its whole first line. Only posts have theirs cut (``sources/posts.py``)."""
    return F.substring_index(text, "\n", 1)


def items_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored news records out of ``documents``."""
    stamp = F.expr("timestamp'2024-01-01 00:00:00Z' + make_dt_interval(0, cast(doc_id % 48 as int))")
    published = F.when(F.col("doc_id") % 17 == 0, F.lit("")).otherwise(F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    image = F.when(F.col("n_chars") % 3 == 0, F.concat(F.lit("https://img.example.com/"), "doc_id", F.lit(".jpg")))
    image = image.when(F.col("n_chars") % 3 == 1, F.lit("https://img.example.com/logo.png")).otherwise(F.lit(""))
    seen = F.expr("timestamp'2024-01-02 18:00:00Z'")
    first_seen = F.expr("timestamp'2024-01-02 18:00:00Z' - make_dt_interval(0, cast(doc_id % 4 as int))")
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("source_id"),
        F.concat(F.lit("https://"), "source", F.lit(".example.com/a/"), "doc_id").alias("url"),
        headline(F.col("text")).alias("title"),
        F.col("text").alias("summary"),
        published.alias("published"),
        image.alias("image_url"),
        first_seen.alias("first_seen_at"),
        seen.alias("last_seen_at"),
        F.col("doc_id").alias("arrival_seq"),
    )


def registry_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source registry out of the distinct sources of ``documents``."""
    n = F.col("n")
    named = (
        table(spark, sf_dir, "documents", spread=False).select("source").distinct()
        .select(F.col("source").alias("source_id"), F.substring("source", 4, 9).try_cast("int").alias("n"))
    )

    def pick(divisor: int, *labels) -> Column:
        out = F.when(F.lit(False), F.lit(labels[0]))
        for rest, label in enumerate(labels):
            out = out.when(n % divisor == rest, F.lit(label))
        return out

    words = F.array(F.lit("der"), F.lit("tion"), F.lit("elle"))
    none = F.array().cast("array<string>")
    return named.select(
        "source_id",
        F.concat(F.lit("Source "), n).alias("name"),
        F.concat(F.lit("pub"), n % 8).alias("publisher_id"),
        pick(5, "official", "established_media", "trade_media", "social", "industry_blog").alias("source_class"),
        pick(4, "m-cn", "m-hmt", "m-intl", "m-obs").alias("market"),
        (n % 2 == 0).alias("infer_market"),
        pick(9, "film", "series", "bulletin", "film", "bulletin", "bulletin", "film", "bulletin", "advert").alias("entry_type"),
        pick(6, "en", "en", "fr", "en", "de", "en").alias("language"),
        F.when(n % 9 == 4, F.lit("network")).alias("distribution"),
        (n % 4).cast("int").alias("content_priority"),
        F.when(n % 5 == 1, words).otherwise(none).alias("include_keywords"),
        F.when(n % 5 == 2, F.array(F.lit("Iónta"), F.lit("großen"))).otherwise(none).alias("exclude_keywords"),
        F.when(n % 2 == 1, F.lit("title")).alias("filter_scope"),
        F.when(n % 6 == 5, F.lit(12.0)).alias("max_age_hours"),
        F.when(n % 4 == 3, F.lit(1)).otherwise(F.lit(0)).alias("carry_forward_days"),
        (n % 3 == 0).alias("enrich_media"),
        (n % 3 == 1).alias("read_details"),
        (n % 7 != 6).alias("enabled"),
        n.alias("source_order"),
    )


def reports_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetch outcome per source."""
    n = F.col("source_order")
    status = F.when(n % 10 == 3, F.lit("partial")).when(n % 10 == 9, F.lit("error")).otherwise(F.lit("ok"))
    return registry_view(spark, sf_dir).select("source_id", status.alias("status"))


def observations_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw sightings out of ``events``; arrival order is shuffled, so older runs arrive late.

    The arrival number is unique: a shuffled rank with the event id below it.
    """
    return observations_of(table(spark, sf_dir, "events"))


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table as a stream over its files."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).parquet(path[:-1] + "[t]")


def observations_of(events: DataFrame) -> DataFrame:
    shuffled = F.expr("(event_id * 7919) % 1000003 * 4294967296 + event_id")
    return events.select(
        F.col("event_type").alias("source_id"),
        F.concat(F.lit("https://example.com/u/"), "user_id").alias("url"),
        F.col("event_type").alias("title"),
        F.when(F.col("event_id") % 3 == 0, F.lit("")).otherwise(F.get_json_object("props", "$.k")).alias("summary"),
        F.when(F.col("event_id") % 4 == 0, (F.col("event_id") % 5).cast("int")).alias("content_priority"),
        F.date_trunc("day", F.col("ts").cast("timestamp")).alias("run_ts"),
        shuffled.alias("arrival_seq"),
    )


def captured_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article pages out of ``pages``: with description, share image, wall time and, in a third of
    them, an article body that holds an image. The address is that of the matching record."""
    n = F.col("page_id")
    text = n.cast("string")
    share = F.when(n % 4 == 1, F.lit("https://cdn.example.com/logo.png")).otherwise(
        F.concat(F.lit("https://cdn.example.com/"), text, F.lit(".jpg"))
    )
    head = F.concat(
        F.lit('<meta charset="utf-8"><meta name="description" content="Brief of page '), text,
        F.lit('"><meta property="og:image" content="'), share, F.lit('">'),
    )
    clock = F.when(n % 5 != 0, F.concat(
        F.lit('<span id="newstime">2024-01-0'), (n % 3 + 1).cast("string"), F.lit(" 08:0"), (n % 10).cast("string"), F.lit("</span>")
    )).otherwise(F.lit(""))
    body = F.when(n % 3 == 0, F.concat(F.lit('<div class="entry-content wide"><div><img src="/img/'), text, F.lit('.png"></div>')))
    opening = F.concat(F.coalesce(body, F.lit("<article>")), clock)
    closing = F.when(n % 3 == 0, F.lit("</div>")).otherwise(F.lit("</article>"))
    html = F.replace(F.col("html"), F.lit('<meta charset="utf-8">'), head)
    html = F.replace(F.replace(html, F.lit("<article>"), opening), F.lit("</article>"), closing)
    url = F.concat(F.lit("https://src"), n % 20, F.lit(".example.com/a/"), text)
    return table(spark, sf_dir, "pages").select("page_id", url.alias("url"), html.alias("html"))


def notice_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notices out of ``pages``: every paragraph of a page becomes a row of its filing table."""
    n = F.col("page_id").cast("string")
    paragraphs = F.regexp_extract_all("html", F.lit(r"<p>([^<]*)"), F.lit(1))
    prefix = F.array(F.lit("影剧"), F.lit("影动"), F.lit("影合"), F.lit("备"))
    rows = F.transform(
        paragraphs,
        lambda p, i: F.concat(
            F.lit("<tr><td>"), (i + 1).cast("string"), F.lit("</td><td>"), F.get(prefix, i % 4), F.lit("字"), i.cast("string"),
            F.lit("</td><td>"), p, F.lit("</td><td><script>var _badw = 'Company "), n,
            F.lit("';</script></td><td>writer</td><td>ok</td><td>region</td></tr>"),
        ),
    )
    html = F.concat(
        F.lit('<meta name="ArticleTitle" content="关于2024年1月上全国电影剧本 '), n,
        F.lit('"><meta name="PubDate" content="2024-01-02"><script>str="纪录影片,故事影片";</script>'),
        F.lit('<div class="hmc4Table"><table><tr><td>head</td></tr>'), F.array_join(rows, ""), F.lit("</table></div>"),
    )
    return table(spark, sf_dir, "pages").select("url", html.alias("html"))


def responses_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Social responses out of ``conversations``: one response per turn, some of them faulty."""
    ident = F.col("conv_id").cast("string")
    post = F.struct(
        ident.alias("idstr"), F.col("text").alias("text"), F.lit("Tue Sep 22 10:10:00 +0800 2026").alias("created_at"),
        F.struct(ident.alias("idstr"), F.col("role").alias("screen_name")).alias("user"),
        F.when(F.col("turn") % 3 == 2, F.struct(F.lit("1").alias("idstr"))).alias("retweeted_status"),
        F.array(F.struct(F.struct(F.concat(F.lit("https://img.example.com/"), ident, F.lit(".jpg")).alias("url")).alias("large"))).alias("pics"),
        (F.col("turn") % 2 == 1).alias("is_long_text"),
    )
    listed = F.to_json(F.struct(F.struct(F.array(post).alias("statuses")).alias("result")))
    bare = F.to_json(F.struct(F.array(post).alias("result")))
    failed = F.to_json(F.struct(F.struct(F.lit(21301).alias("error_code")).alias("result")))
    payload = F.when(F.col("role") == "system", failed).when(F.col("turn") % 5 == 4, bare).otherwise(listed)
    return table(spark, sf_dir, "conversations").select(F.col("role").alias("target"), F.col("turn").alias("page"), payload.alias("payload"))


CACHE_MODEL = "m"


def cache_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Translations of a part of the records, a few of them invalid."""
    from pressloom.operators.translate import content_key

    items = items_view(spark, sf_dir).filter(F.length("summary") % 3 == 0)
    title = F.when(F.length("title") % 9 == 0, F.col("title")).otherwise(F.concat(F.lit("译 "), "title"))
    return items.select(content_key(F.col("title"), F.col("summary"), CACHE_MODEL).alias("key"), title.alias("title"), "summary").distinct()


def land_cache(spark: SparkSession, sf_dir: str) -> str:
    """Write the cache as a file that also holds entries of another version and of another model; returns the folder."""
    from pressloom.session import new_workspace

    folder = new_workspace(spark, "cache")
    right = cache_view(spark, sf_dir)
    stale = F.concat(F.lit("译旧 "), "title")
    rows = right.select(F.lit(1).alias("schema_version"), F.lit(CACHE_MODEL).alias("model"), "key", "title", "summary")
    old = right.select(F.lit(2).alias("schema_version"), F.lit(CACHE_MODEL).alias("model"), "key", stale.alias("title"), "summary")
    other = right.select(F.lit(1).alias("schema_version"), F.lit("other").alias("model"), "key", stale.alias("title"), "summary")
    rows.unionByName(old).unionByName(other).write.json(folder)
    return folder


def cast_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Announcements of a cast out of ``documents``: three ways to name people who are called by numbers."""
    def person(family: str, number: Column) -> Column:
        return F.concat(F.lit(family), F.translate(number.cast("string"), "0123456789", "零一二三四五六七八九"))

    n, size = F.col("doc_id"), F.col("n_chars")
    first, second, third = person("张", n % 97), person("李", size % 89), person("王", (n + size) % 83)
    text = (
        F.when(n % 3 == 0, F.concat(first, F.lit("、"), second, F.lit("、"), third, F.lit("领衔主演的影片开机。")))
        .when(n % 3 == 1, F.concat(F.lit("新片定档，主演包括："), first, F.lit("、"), second, F.lit("、"), first, F.lit("。影片将映。")))
        .otherwise(F.concat(F.lit("医生（"), first, F.lit(" 饰）与记者（"), third, F.lit("饰）相遇。")))
    )
    return table(spark, sf_dir, "documents").select("doc_id", text.alias("text"))


def tagged_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts out of ``documents``, half of them opened by a hashtag."""
    tag = F.concat(F.lit("#"), F.substring(headline(F.col("text")), 1, 20), F.lit("# "))
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.when(F.col("doc_id") % 2 == 0, F.concat(tag, "text")).otherwise(F.col("text")).alias("text"))


def mail_dates_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times of ``events`` as mail dates in several zones."""
    n = F.col("event_id")
    zone = F.lit("")
    for rest, name in enumerate(MAIL_ZONES_SHOWN):
        zone = F.when(n % len(MAIL_ZONES_SHOWN) == rest, F.lit(name)).otherwise(zone)
    day = F.when(n % 2 == 0, F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss")).otherwise(F.date_format("ts", "d MMM yyyy HH:mm:ss"))
    return table(spark, sf_dir, "events").select("event_id", F.trim(F.concat(day, F.lit(" "), zone)).alias("mail_date"))


MAIL_ZONES_SHOWN = ["", "GMT", "EST", "PDT", "+0800", "-0330"]


def land_feeds(spark: SparkSession, sf_dir: str) -> str:
    """Write every record as a feed item below the shared folder; returns the folder."""
    from pressloom.session import new_workspace

    c = F.col
    folder = new_workspace(spark, "feeds")
    place = c("arrival_seq").cast("string")
    media = F.struct(F.concat(F.lit("https://img.example.com/e"), place, F.lit(".jpg")).alias("_url"), F.lit("image/jpeg").alias("_type"))
    markup = F.concat(
        F.lit('<img src="https://img.example.com/b'), place, F.lit('.png"><a href="https://v.example.com/'), place, F.lit('.mp4">')
    )
    items = items_view(spark, sf_dir).select(
        c("title"),
        F.concat(c("url"), F.lit("?id="), place, F.lit("&utm_source=feed#top")).alias("link"),
        c("summary").alias("description"),
        F.when(c("published") != "", c("published")).alias("pubDate"),
        F.when(c("arrival_seq") % 3 == 0, media).alias("enclosure"),
        F.when(c("arrival_seq") % 3 == 1, markup).alias("encoded"),
    )
    items.write.format("xml").option("rootTag", "channel").option("rowTag", "item").save(folder)
    return folder
