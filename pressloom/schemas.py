"""Explicit schemas of the tables the jobs exchange."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, INT, BOOL, STAMP, LONG = (
    T.StringType(), T.IntegerType(), T.BooleanType(), T.TimestampType(), T.LongType(),
)

# The only fields a stored record may hold.
TEXT_FIELDS = [
    "id", "source_id", "source_name", "source_class", "source_type", "publisher_id",
    "title", "summary", "url", "published", "published_at", "market", "entry_type",
    "language", "distribution", "confidence", "image_url", "video_url", "video_page_url",
    "author", "author_id", "author_url", "platform", "post_id", "original_post_url",
    "date_status", "timestamp_status", "original_title", "original_summary",
    "translated_title", "translated_summary",
]
INTEGER_FIELDS = ["content_priority", "carry_forward_days"]
BOOLEAN_FIELDS = ["is_carried_forward", "is_repost", "text_complete"]
SOURCE_FIELDS = ["id", "source_id", "publisher_id", "name", "url", "class", "language"]
FILING_FIELDS = ["filing_no", "title", "company", "writer", "result", "region", "category"]


def _texts(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, STRING) for name in names])


NESTED_FIELDS = {
    "sources": T.ArrayType(_texts(SOURCE_FIELDS)),
    "filings": T.ArrayType(_texts(FILING_FIELDS)),
}

NEWS_RECORD = T.StructType(
    [T.StructField(name, STRING) for name in TEXT_FIELDS]
    + [T.StructField(name, INT) for name in INTEGER_FIELDS]
    + [T.StructField(name, BOOL) for name in BOOLEAN_FIELDS]
    + [T.StructField(name, kind) for name, kind in NESTED_FIELDS.items()]
)

STORE = T.StructType(
    NEWS_RECORD.fields
    + [
        T.StructField("first_seen_at", STAMP),
        T.StructField("last_seen_at", STAMP),
        T.StructField("arrival_seq", LONG),
    ]
)

# A fetched item before it is stored: record fields, the run and its place of arrival.
RAW_ITEM = T.StructType(
    NEWS_RECORD.fields + [T.StructField("run_ts", STAMP), T.StructField("arrival_seq", LONG)]
)

REGISTRY_ENTRY = T.StructType(
    [
        T.StructField("id", STRING),
        T.StructField("name", STRING),
        T.StructField("type", STRING),
        T.StructField("url", STRING),
        T.StructField("publisher_id", STRING),
        T.StructField("source_class", STRING),
        T.StructField("market", STRING),
        T.StructField("infer_market", BOOL),
        T.StructField("entry_type", STRING),
        T.StructField("language", STRING),
        T.StructField("distribution", STRING),
        T.StructField("content_priority", INT),
        T.StructField("include_keywords", T.ArrayType(STRING)),
        T.StructField("exclude_keywords", T.ArrayType(STRING)),
        T.StructField("filter_scope", STRING),
        T.StructField("max_age_hours", T.DoubleType()),
        T.StructField("carry_forward_days", INT),
        T.StructField("enrich_media", BOOL),
        T.StructField("read_details", BOOL),
        T.StructField("enabled", BOOL),
    ]
)

POLICY = T.StructType(
    [
        T.StructField("max_age_hours", T.DoubleType()),
        T.StructField("allow_carry_forward", BOOL),
        T.StructField("render_languages", T.ArrayType(STRING)),
        T.StructField("excluded_entry_types", T.ArrayType(STRING)),
        T.StructField("excluded_keywords", T.ArrayType(STRING)),
        T.StructField("required_markets", T.ArrayType(STRING)),
        T.StructField("max_items_per_market", T.MapType(STRING, INT)),
        T.StructField("max_media_enrichments", INT),
        T.StructField("editorial_budget", T.MapType(STRING, INT)),
        T.StructField("labels", T.MapType(STRING, STRING)),
    ]
)

SOURCE_CONFIG = T.StructType(
    [T.StructField("policy", POLICY), T.StructField("sources", T.ArrayType(REGISTRY_ENTRY))]
)

REGISTRY_DEFAULTS = {
    "market": "m-obs",
    "entry_type": "影视动态",
    "language": "und",
    "content_priority": 3,
    "carry_forward_days": 0,
    "infer_market": False,
    "enrich_media": False,
    "read_details": False,
    "enabled": False,
}
