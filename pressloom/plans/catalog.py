"""The registered queries: each runs one operator, or a whole job, over the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.functions import editorial as E
from pressloom.functions import package as P
from pressloom.functions import text as X
from pressloom.functions import times as D
from pressloom.functions import urls as U
from pressloom.operators import candidates as C
from pressloom.operators import edition as ED
from pressloom.operators import events as V
from pressloom.operators import media as M
from pressloom.operators import package as PK
from pressloom.operators import publish as PB
from pressloom.operators import stats as ST
from pressloom.operators import store as S
from pressloom.operators import translate as TR
from pressloom.operators.dedup import merge_duplicates, merged_sources
from pressloom.operators.ledger import LedgerTable
from pressloom.operators.scale import computed_once, written
from pressloom.plans import ingest as IN
from pressloom.plans import tables as T
from pressloom.rules import LATIN
from pressloom.session import new_workspace, tune
from pressloom.sources import feeds, notices, pages, posts
from pressloom.sources.registry import enabled_sources
from pressloom.streaming import daily_counts, publish_stream, store_stream

NOW, POLICY = T.NOW, T.POLICY
BUDGETS = {"m-cn": 9, "m-hmt": 4, "m-intl": 12}
PUBLISH_DAY = dt.date(2024, 1, 3)
ITEM_COLUMNS = ["id", "title", "url", "market", "distribution", "content_priority", "confidence", "language"]
LINK_PATH = r"^https?://[^/]+/[a-zß-ÿ]+$"
LINK_WORDS = ["th", "er", "ou", "ch", "ón"]


def _labelled(spark, d, keep_disabled=False):
    return C.label_records(T.items_view(spark, d), T.registry_view(spark, d), POLICY, LATIN, NOW, keep_disabled)


def _candidates(spark, d):
    return C.candidate_columns(_labelled(spark, d), LATIN)


def _merged(spark, d, fields=None):
    return merge_duplicates(_candidates(spark, d), LATIN, fields)


def _edition(spark, d):
    return ED.daily_edition(_merged(spark, d), POLICY, NOW)


def _pool(spark, d):
    return ED.filter_language(_merged(spark, d), POLICY).withColumn("position", ED.position())


def _analysed(spark, d):
    return V.analyse(_pool(spark, d), LATIN)


def _analysed_table(spark, d):
    """The analysed records as a written table, for queries that use them more than once."""
    return written(_analysed(spark, d), "analysed")


def _events(spark, d):
    return V.group_events(_analysed(spark, d), LATIN)


def _shown(items: DataFrame, *more) -> DataFrame:
    return items.select(*ITEM_COLUMNS, D.iso_stamp(F.col("published_ts")).alias("published_at"), *more)


# --- sources and filters -------------------------------------------------------------------


def source_registry(spark, d):
    return enabled_sources(T.registry_view(spark, d)).select(
        "source_id", "name", "publisher_id", "source_class", "market", "infer_market", "entry_type", "language",
        "distribution", "content_priority", F.array_join("include_keywords", ",").alias("include_keywords"),
        F.array_join("exclude_keywords", ",").alias("exclude_keywords"), "filter_scope", "max_age_hours",
        "carry_forward_days", "source_order",
    )


def items_with_source(spark, d):
    return C.items_with_source(T.items_view(spark, d), T.registry_view(spark, d)).select(
        "url", "title", "source_id", "src_name", "src_class", "src_market", "source_order"
    )


def filter_excluded(spark, d):
    return _labelled(spark, d).filter("drop_reason = 'excluded'").select("url", "title", "source_id")


def filter_source_keywords(spark, d):
    return _labelled(spark, d).filter("drop_reason = 'source_filter'").select("url", "title", "source_id")


def filter_freshness(spark, d):
    return _labelled(spark, d).filter("drop_reason = 'stale'").select(
        "url", "source_id", D.iso_stamp(F.col("published_ts")).alias("published_at")
    )


def filter_language(spark, d):
    return _shown(ED.filter_language(_merged(spark, d), POLICY))


def drop_funnel(spark, d):
    return ST.drop_funnel(_labelled(spark, d, keep_disabled=True))


# --- merging and the edition ---------------------------------------------------------------


def dedup_titles(spark, d):
    return _shown(_merged(spark, d), "dedup_key", "record_count", "source_count", "evidence_rank", "from_social", "from_blog")


def dedup_sources(spark, d):
    return merged_sources(_candidates(spark, d)).select("dedup_key", "publisher_id", "url", "source_id", "source_name", "source_class")


def candidate_pool(spark, d):
    return _shown(ED.candidate_pool(_merged(spark, d), POLICY))


def edition_day(spark, d):
    return _shown(ED.edition_day(_merged(spark, d), POLICY, NOW), "is_carried_forward")


def cap_market(spark, d):
    return _shown(ED.cap_market(_merged(spark, d), POLICY))


def daily_edition(spark, d):
    return _shown(
        _edition(spark, d).orderBy("position"), "is_carried_forward",
        ED.display_section(F.col("market")).alias("section"),
        D.item_time(F.col("published_ts")).alias("shown_time"),
        P.evidence_label(F.col("confidence"), {"official": "官方发布", "single_source": "媒体报道", "social_lead": "社媒线索",
                                                "industry_commentary": "行业观察"}).alias("evidence"),
        P.mapped(F.col("distribution"), P.DISTRIBUTION_LABELS, "影视动态").alias("channel"),
        X.excerpt(F.col("summary")).alias("lead"),
    )


def edition_sink(spark, d):
    """Every civil day as an edition; then one day again, for fewer languages, which replaces that day only."""
    editions = _merged(spark, d).withColumn("edition_date", D.civil_day(F.col("published_ts")))
    path = new_workspace(spark, "editions")
    ED.write_edition(editions, path)
    again = ED.filter_language(spark.read.parquet(path), POLICY).filter("edition_date = '2024-01-02'")
    ED.write_edition(written(again, "edition-again"), path)
    return spark.read.parquet(path).select("id", "url", "language", D.iso_day(F.col("edition_date")).alias("edition_date"))


# --- counters ------------------------------------------------------------------------------


def run_stats(spark, d):
    labelled = _labelled(spark, d, keep_disabled=True)
    return ST.run_stats(labelled, POLICY, LATIN, NOW, M.media_requests(labelled, POLICY, LATIN, NOW))


def distribution_counts(spark, d):
    return ST.distribution_counts(_edition(spark, d))


def _status(spark, d):
    return ST.source_status(T.items_view(spark, d), T.registry_view(spark, d), T.reports_view(spark, d), NOW)


def source_status(spark, d):
    return _status(spark, d)


def source_totals(spark, d):
    return ST.source_totals(_status(spark, d))


def market_coverage(spark, d):
    return ST.market_coverage(_edition(spark, d), _status(spark, d), POLICY)


# --- store ---------------------------------------------------------------------------------

STORE_BUCKETS = 16
STORE_COLUMNS = ["source_id", "url", "title", "summary", "content_priority"]


def _store_rows(df: DataFrame) -> DataFrame:
    return df.select(*STORE_COLUMNS, D.iso_stamp(F.col("first_seen_at")).alias("first_seen_at"),
                     D.iso_stamp(F.col("last_seen_at")).alias("last_seen_at"))


def store_projection(spark, d):
    with_secrets = T.observations_view(spark, d).withColumns(
        {
            "api_key": F.lit("secret"),
            "sources": F.array(F.struct(F.col("source_id").alias("id"), F.col("url").alias("url"), F.lit("secret").alias("token"))),
        }
    )
    kept = S.project_news(with_secrets, keep=["arrival_seq"])
    nested = F.transform("sources", lambda s: F.to_json(s))
    return kept.withColumn("sources", F.array_join(nested, ","))


def store_merge(spark, d):
    return _store_rows(S.merge_store(None, S.observations(T.observations_view(spark, d))))


def store_violations(spark, d):
    """A store built without merging, so that repeated keys show; some addresses are no articles."""
    rows = S.observations(T.observations_view(spark, d))
    url = (
        F.when(F.col("content_priority") == 1, F.replace("url", F.lit("https://"), F.lit("ftp://")))
        .when(F.col("content_priority") == 2, F.replace("url", F.lit("https://"), F.lit("https://user:pw@")))
        .otherwise(F.col("url"))
    )
    return S.store_violations(rows.withColumn("url", url))


def store_snapshot(spark, d):
    """Two runs through the store: the early arrivals, then the late ones."""
    rows = S.observations(T.observations_view(spark, d))
    late = F.col("arrival_seq") >= 500_000 * 4294967296
    store = S.RecordStore(spark, new_workspace(spark, "store"), STORE_BUCKETS)
    store.merge(rows.filter(~late))
    store.merge(rows.filter(late))
    return _store_rows(store.read())


def store_lookup(spark, d):
    """The stored records that the late purchases belong to, read from their buckets only."""
    rows = S.observations(T.observations_view(spark, d))
    store = S.RecordStore(spark, new_workspace(spark, "store"), STORE_BUCKETS)
    store.merge(rows)
    late = F.col("arrival_seq") >= 990_000 * 4294967296
    return _store_rows(store.records_of(rows.filter(late)))


def stream_store_merge(spark, d):
    """The merge as a stream over the files of the events table."""
    source = T.stream_table(spark, d, "events")
    store = S.RecordStore(spark, new_workspace(spark, "stream-store"), STORE_BUCKETS)
    store_stream.run_store_stream(T.observations_of(source), store, new_workspace(spark, "stream-check"))
    return _store_rows(store.read())


def stream_daily_counts(spark, d):
    events = T.stream_table(spark, d, "events").select(F.col("event_type").alias("source_id"), F.col("ts").cast("timestamp").alias("ts"))
    sink = new_workspace(spark, "daily-counts")
    daily_counts.run_daily_counts(events, sink, new_workspace(spark, "daily-check"))
    counts = daily_counts.read_daily_counts(spark, sink)
    return counts.select("source_id", D.iso_day(F.col("civil_day")).alias("civil_day"), "arrivals")


# --- pages, details, media -----------------------------------------------------------------


def page_links(spark, d):
    return pages.page_links(T.table(spark, d, "pages"), LINK_PATH, LINK_WORDS)


def page_media(spark, d):
    return pages.page_media(T.captured_pages(spark, d))


def media_enrich(spark, d):
    filled = M.enrich_media(
        _labelled(spark, d), T.captured_pages(spark, d).select("url", "html"), POLICY, LATIN, NOW
    )
    return filled.filter("drop_reason IS NULL").select("url", "image_url", "video_url")


def media_write_back(spark, d):
    """Two runs over the stored records: each asks for new pages only, and what they show is in the store afterwards."""
    store = S.RecordStore(spark, new_workspace(spark, "media-store"), STORE_BUCKETS)
    store.merge(T.items_view(spark, d))
    run = M.MediaRun(store, LedgerTable(spark, new_workspace(spark, "media-attempts"), M.ATTEMPTS))
    found = T.captured_pages(spark, d).select("url", "html")
    for _ in range(2):
        labelled = C.label_records(store.read(), T.registry_view(spark, d), POLICY, LATIN, NOW)
        run.enrich(labelled, found, POLICY, LATIN, NOW)
    asked = run.attempts.read().groupBy(*S.KEY).agg(F.count(F.lit(1)).alias("requests"))
    return store.read().join(asked, S.KEY, "left").select(
        "source_id", "url", "image_url", "video_url", F.coalesce("requests", F.lit(0)).alias("requests"),
        D.iso_stamp(F.col("last_seen_at")).alias("last_seen_at"))


def detail_enrich(spark, d):
    reg = enabled_sources(T.registry_view(spark, d)).select("source_id", "read_details")
    items = T.items_view(spark, d).join(reg, "source_id").select(
        "url", "title", "summary", "published", "read_details"
    )
    out = M.enrich_details(items, pages.page_details(T.captured_pages(spark, d)))
    return out.select("url", "title", "summary", "published", "detail_status")


def canonical_urls(spark, d):
    return T.table(spark, d, "pages").select("page_id", U.canonical_url(F.col("url")).alias("url"), U.host(F.col("url")).alias("host"))


def clean_titles(spark, d):
    title = F.regexp_extract("html", r"(?is)<title>(.*?)</title>", 1)
    return T.table(spark, d, "pages").select(
        "page_id", X.clean_text(title).alias("title"), X.title_key(X.clean_text(title)).alias("title_key")
    )


def mail_dates(spark, d):
    dated = computed_once(T.mail_dates_view(spark, d), {"published_ts": D.published_at(F.col("mail_date"))})
    return dated.select("event_id", D.iso_stamp(F.col("published_ts")).alias("published_at"))


# --- feeds, notices, posts -----------------------------------------------------------------


def feed_items(spark, d):
    return feeds.feed_items(feeds.read_entries(spark, T.land_feeds(spark, d))).select("title", "url", "summary", "published")


def feed_media(spark, d):
    return feeds.feed_items(feeds.read_entries(spark, T.land_feeds(spark, d))).select("url", "image_url", "video_url")


def notice_rows(spark, d):
    rows = notices.filings(notices.notices(T.notice_pages(spark, d)))
    return rows.select("url", F.col("place.row_pos").alias("row_pos"), "filing_no", "title", "company", "category")


def notice_summary(spark, d):
    parsed = notices.notices(T.notice_pages(spark, d))
    return notices.notice_items(parsed, notices.filings(parsed))


def _posts(spark, d):
    return posts.normalize_posts(posts.unpack_responses(T.responses_view(spark, d)))


def posts_normalized(spark, d):
    return posts.accepted(_posts(spark, d)).select(
        "target", "page", "title", "summary", "url", "published", "image_url", "author", "author_id", "post_id",
        "publisher_id", "is_repost", "original_post_url", "text_complete",
    )


def posts_rejected(spark, d):
    return posts.rejected(_posts(spark, d))


def posts_dedup(spark, d):
    return posts.dedup_posts(posts.accepted(_posts(spark, d))).select("post_id", "target", "page", "title")


def hashtag_titles(spark, d):
    return T.tagged_view(spark, d).select("doc_id", P.hashtag_headline(F.col("text")).alias("title"))


def _ingested(spark, d):
    fed = feeds.feed_items(feeds.read_entries(spark, T.land_feeds(spark, d)))
    noticed, _, _ = IN.notice_feed(T.notice_pages(spark, d))
    listed = IN.listing_of(T.table(spark, d, "pages"), LINK_PATH, LINK_WORDS)
    posted, rejects = IN.post_feed(T.responses_view(spark, d))
    named = {"feed": fed, "notice": noticed, "listing": listed}
    parts = [IN.items_of(found, F.lit(name)) for name, found in named.items()]
    return IN.ingest([*parts, IN.items_of(posted, F.col("target"), IN.POST)]), rejects


INGEST_SOURCES = ["feed", "notice", "listing", "user", "assistant", "system", "bureau"]


def ingest_items(spark, d):
    return _ingested(spark, d)[0].select("source_id", "title", "url", "summary", "published")


def ingest_status(spark, d):
    registered = spark.createDataFrame([(name,) for name in INGEST_SOURCES], "source_id string")
    return IN.outcomes(*_ingested(spark, d), registered)


# --- translation ---------------------------------------------------------------------------


def _translated(spark, d):
    """Every record as an edition row of its document's language."""
    lang = T.table(spark, d, "documents").select(
        F.concat(F.lit("https://"), "source", F.lit(".example.com/a/"), "doc_id").alias("url"),
        F.col("doc_id").alias("arrival_seq"), F.col("lang").alias("language"), F.col("text").alias("summary"),
        T.headline(F.col("text")).alias("title"),
    )
    return TR.with_translation(lang, TR.read_cache(spark, T.land_cache(spark, d), T.CACHE_MODEL), T.CACHE_MODEL)


def translation_attach(spark, d):
    return _translated(spark, d).select("url", "language", "title", "translation_status")


def translation_queue(spark, d):
    return TR.translation_queue(_translated(spark, d), F.col("arrival_seq")).select(
        "content_key", "original_title", F.col("position").alias("arrival_seq")
    )


def translation_stats(spark, d):
    return TR.translation_stats(_translated(spark, d))


# --- events --------------------------------------------------------------------------------


def low_signal(spark, d):
    return V.low_signal(_analysed(spark, d))


def market_fold(spark, d):
    return V.market_fold(_analysed(spark, d))


def event_groups(spark, d):
    return _events(spark, d).select("day", "topic", "event_market", "market", "group_size", "image_url")


def event_primary(spark, d):
    return _events(spark, d).select("id", "url", "event_key", "kind", "headline", "market")


def event_relevance(spark, d):
    ordered = V.relevance(_events(spark, d), LATIN)
    return ordered.orderBy("relevance").select(
        "id", "headline", "relevance_kind", F.col("relevance.kind").alias("kind_rank"),
        F.col("relevance.evidence").alias("evidence"), F.col("relevance.image").alias("no_image"),
    )


def choose_events(spark, d):
    return V.choose_events(V.relevance(_events(spark, d), LATIN), BUDGETS).select("id", "market", "distribution", "selected")


def brief_stats(spark, d):
    analysed = _analysed_table(spark, d)
    return V.brief_stats(analysed, V.choose_events(V.relevance(V.group_events(analysed, LATIN), LATIN), BUDGETS))


def trace_pool(spark, d):
    analysed = _analysed_table(spark, d)
    chosen = V.choose_events(V.relevance(V.group_events(analysed, LATIN), LATIN), BUDGETS)
    return V.trace_pool(chosen, analysed)


def event_members(spark, d):
    return V.event_members(_analysed_table(spark, d)).select("id", "url", "day", "topic", "event_market")


def event_sources(spark, d):
    found = written(_candidates(spark, d), "candidates")
    pool = ED.filter_language(merge_duplicates(found, LATIN), POLICY).withColumn("position", ED.position())
    members = V.event_members(written(V.analyse(pool, LATIN), "analysed"))
    return V.event_sources(members, merged_sources(found)).select("day", "topic", "event_market", "source_url", "source_id", "publisher_id")


def event_facts(spark, d):
    analysed = _analysed_table(spark, d)
    facts = V.with_facts(written(V.group_events(analysed, LATIN), "events"), analysed, LATIN)
    return facts.select("id", "event_title", "event_summary", F.size("key_points").alias("points"), "group_size")


def fact_overlap(spark, d):
    """Whether each record's factual line says something else than its headline, and what decided it."""
    lined = written(E.with_core_sentence(_analysed(spark, d), LATIN).select("id", "core_sentence", "headline"), "lines")
    line, headline = X.normalized(F.col("core_sentence")), X.normalized(F.col("headline"))
    return lined.select("id", "core_sentence", "headline", E.overlap_decision(line, headline, 0.78).alias("decided_by"),
                        E.overlap_below(line, headline, 0.78).alias("differs"))


# --- content pack and publishing -----------------------------------------------------------


def _pack(spark, d):
    pool = written(ED.filter_language(_merged(spark, d), POLICY), "pool")
    return written(PK.package_select(pool, PUBLISH_DAY, allow_fallback=True), "pack")


def package_select(spark, d):
    return _shown(_pack(spark, d), "place")


def package_tags(spark, d):
    return PK.package_tags(_pack(spark, d), LATIN, "daily")


def package_digest(spark, d):
    return PK.package_manifest(_pack(spark, d), LATIN, PUBLISH_DAY, "daily").select("digest", "publish_date", "source_date")


def package_caption(spark, d):
    return PK.package_manifest(_pack(spark, d), LATIN, PUBLISH_DAY, "daily").select("digest", "title", "caption")


def package_cards(spark, d):
    return PK.package_cards(_pack(spark, d), LATIN)


def cast_names(spark, d):
    return T.cast_view(spark, d).select("doc_id", F.array_join(P.actor_names(F.col("text")), ",").alias("names"))


def asset_match(spark, d):
    items = T.items_view(spark, d).select(C.K.record_id(F.col("source_id"), F.col("url")).alias("id"), "title", "summary")
    assets = T.table(spark, d, "benchmark").select(F.col("text").alias("asset"))
    return PK.asset_match(items, assets, LATIN)


def _digests(spark, d):
    return PK.daily_digests(ED.filter_language(_merged(spark, d), POLICY))


def publish_once(spark, d):
    manifests = written(_digests(spark, d), "digests")
    log = manifests.filter("source_date < '2024-01-02'").select("digest")
    return PB.publish_once(manifests, log)


def stream_publish(spark, d):
    """The publish log as a stream over manifest files; a second checkpoint brings all of them again and adds nothing."""
    landing = new_workspace(spark, "manifests")
    _digests(spark, d).repartition("source_date").write.parquet(landing)
    schema = spark.read.parquet(landing).schema
    log = PB.PublishLog(spark, new_workspace(spark, "publish-log"))
    for check in ("publish-check", "publish-check-again"):
        arriving = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landing)
        publish_stream.run_publish_stream(arriving, log, new_workspace(spark, check))
    return log.read()


def edition_index(spark, d):
    pool = _merged(spark, d, ["published_ts"])
    editions = pool.select(D.civil_day(F.col("published_ts")).alias("edition_date"))
    indexed = spark.createDataFrame([("2024-01-01",)], "edition_date string").select(F.col("edition_date").cast("date"))
    return PB.edition_index(editions, indexed)


def edition_diff(spark, d):
    """The edition expected under this policy against one that allowed a single language."""
    merged = written(_merged(spark, d, ["id", "title", "market", "language"]), "merged")
    expected = ED.filter_language(merged, POLICY).select("id", "title", "market")
    published = merged.filter("language = 'en' OR market = 'm-obs'").select("id", "title", "market")
    return PB.edition_diff(expected, published)


def missing_titles(spark, d):
    """Headlines that the page of their own record does not hold: pages here show the excerpt of a text only."""
    raw = T.table(spark, d, "documents")
    expected = raw.select(F.col("doc_id").alias("edition"), T.headline(F.col("text")).alias("title"))
    shown = raw.select(F.col("doc_id").alias("edition"), PB.escaped(X.excerpt(F.col("text"))).alias("page"))
    return PB.missing_titles(expected, shown)


QUERIES = [
    source_registry, items_with_source, filter_excluded, filter_source_keywords, filter_freshness, filter_language,
    drop_funnel, dedup_titles, dedup_sources, candidate_pool, edition_day, cap_market, daily_edition, edition_sink, run_stats,
    distribution_counts, source_status, source_totals, market_coverage, store_projection, store_merge, store_violations,
    store_snapshot, store_lookup, stream_store_merge, stream_daily_counts, page_links, page_media, media_enrich, media_write_back,
    detail_enrich,
    canonical_urls, clean_titles, mail_dates, feed_items, feed_media, hashtag_titles, ingest_items, ingest_status, notice_rows, notice_summary, posts_normalized, posts_rejected,
    posts_dedup, translation_attach, translation_queue, translation_stats, low_signal, market_fold, event_groups,
    event_primary, event_relevance, choose_events, brief_stats, trace_pool, event_members, event_sources, event_facts,
    fact_overlap, package_select, package_tags, package_digest, package_caption, package_cards, cast_names, asset_match,
    publish_once, stream_publish, edition_index, edition_diff, missing_titles,
]


def _tuned(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(tune(spark), sf_dir)

    run.__name__ = query.__name__
    run.__doc__ = query.__doc__
    return run


def queries():
    return {query.__name__: _tuned(query) for query in QUERIES}
