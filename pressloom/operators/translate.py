"""Cached translations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.functions import text as X

MODEL = "@cf/meta/llama-3.3-70b-instruct-fp8-fast"
CACHE_VERSION = 1
CACHE_SCHEMA = "schema_version int, model string, key string, title string, summary string"
HAN = r"[一-鿿]"


def content_key(title: Column, summary: Column, model: str = MODEL) -> Column:
    """Hash of model, headline and summary, separated by the zero character."""
    zero = F.char(F.lit(0))
    return F.sha2(F.concat(F.lit(model), zero, X.text_or_empty(title), zero, X.text_or_empty(summary)), 256)


def read_cache(spark: SparkSession, path: str, model: str = MODEL) -> DataFrame:
    """Cache entries of the right version and model; others count as absent."""
    rows = spark.read.schema(CACHE_SCHEMA).json(path)
    return rows.filter((F.col("schema_version") == CACHE_VERSION) & (F.col("model") == model)).select("key", "title", "summary")


def is_valid(original_title: Column, original_summary: Column, title: Column, summary: Column) -> Column:
    """a usable translation: Chinese headline, no lost summary, sane lengths."""
    limit = F.greatest(F.lit(250), F.length(original_title) * 4)
    summary_limit = F.greatest(F.lit(1500), F.length(original_summary) * 4)
    lost = X.blank_to_null(original_summary).isNotNull() & X.blank_to_null(summary).isNull()
    return F.coalesce(
        title.rlike(HAN) & summary.isNotNull() & ~lost & (F.length(title) <= limit) & (F.length(summary) <= summary_limit),
        F.lit(False),
    )


def with_translation(items: DataFrame, cache: DataFrame, model: str = MODEL) -> DataFrame:
    """English items with their cached translation; the original stays on a miss.

    A cached entry is checked again on every hit. The cache has one row per key; copies of one
    text may share a key, which the skew-aware join splits.
    """
    c = F.col
    english = c("language") == "en"
    for name in ("original_title", "original_summary"):
        if name not in items.columns:
            items = items.withColumn(name, F.lit(None).cast("string"))
    named = items.withColumns(
        {
            "original_title": F.when(english, F.coalesce(X.blank_to_null(c("original_title")), c("title"))),
            "original_summary": F.when(english, F.coalesce(X.blank_to_null(c("original_summary")), c("summary"))),
        }
    ).withColumn("content_key", F.when(english, content_key(c("original_title"), c("original_summary"), model)))
    entries = cache.groupBy(c("key").alias("_key")).agg(
        F.min(F.struct(c("title").alias("title"), c("summary").alias("summary"))).alias("cached")
    )
    # Rows without a key get one that matches nothing and spreads them over all tasks.
    spread = F.concat(F.lit("-"), F.xxhash64("title", "summary").cast("string"))
    keyed = named.withColumn("_key", F.coalesce("content_key", spread))
    joined = keyed.join(entries, "_key", "left").withColumn(
        "_hit", is_valid(c("original_title"), c("original_summary"), c("cached.title"), c("cached.summary"))
    )
    return joined.withColumns(
        {
            "translated_title": F.when(c("_hit"), c("cached.title")),
            "translated_summary": F.when(c("_hit"), c("cached.summary")),
            "translation_status": F.when(c("_hit"), F.lit("machine_translated")).when(english, F.lit("original_english")),
        }
    ).withColumns(
        {
            "title": F.coalesce("translated_title", "original_title", "title"),
            "summary": F.coalesce("translated_summary", "original_summary", "summary"),
        }
    ).drop("cached", "_hit", "_key")


def translation_queue(translated: DataFrame, order: Column, max_requests: int = 75) -> DataFrame:
    """Texts to translate, each once, in reading order, within the budget.

    ``translated`` may hold several lists; equal texts share a key and one request.
    """
    misses = translated.filter(F.col("translation_status") == "original_english")
    first = misses.groupBy("content_key").agg(
        F.min_by(F.struct("original_title", "original_summary"), order).alias("text"), F.min(order).alias("position")
    )
    return first.orderBy("position", "content_key").limit(max(0, max_requests)).select("content_key", "text.*", "position")


def translation_stats(translated: DataFrame, max_requests: int = 75) -> DataFrame:
    """Translation counters as metric rows."""
    from pressloom.operators.stats import metric_rows

    c = F.col
    miss = c("translation_status") == "original_english"
    by_key = translated.filter(c("translation_status").isNotNull()).groupBy("content_key").agg(
        F.count_if(~miss).alias("hits"), F.count_if(miss).alias("misses")
    )
    row = by_key.agg(
        F.coalesce(F.sum("hits"), F.lit(0)).alias("translated_home_items"),
        F.coalesce(F.sum("misses"), F.lit(0)).alias("original_english_home_items"),
        F.coalesce(F.sum("hits"), F.lit(0)).alias("cache_hits"),
        F.least(F.count_if(c("misses") > 0), F.lit(max(0, max_requests))).alias("requests"),
    )
    return metric_rows(row, {name: c(name) for name in row.columns})
