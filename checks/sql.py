"""The registered queries as SQL over the same tables, built from shared common table expressions."""

from __future__ import annotations

from pressloom.plans.catalog import BUDGETS, INGEST_SOURCES, LINK_WORDS
from pressloom.plans.tables import POLICY
from pressloom.rules.latin import LATIN
from pressloom.rules.pack import DISTRIBUTION_RANK, EVENT_RANK, MARKETS

NOW = "TIMESTAMP '2024-01-02 18:00:00'"
TODAY = "DATE '2024-01-03'"
ISO = "'%Y-%m-%dT%H:%M:%SZ'"


def iso(column: str) -> str:
    return f"strftime({column}, {ISO})"


def day(column: str) -> str:
    return f"CAST({column} + INTERVAL 8 HOUR AS DATE)"


def fold(text: str) -> str:
    return f"replace(lower({text}), 'ß', 'ss')"


def re2(pattern: str) -> str:
    return pattern.replace("(?iu)", "(?i)")


def matches(text: str, pattern: str) -> str:
    return f"regexp_matches({text}, '{re2(pattern)}')"


def case(pairs, default: str) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in pairs) + f" ELSE {default} END"


def picks(column: str, divisor: int, labels) -> str:
    return case([(f"{column} % {divisor} = {i}", f"'{label}'") for i, label in enumerate(labels)], "NULL")


def rank(column: str, ranks: dict, default: int) -> str:
    return case([(f"{column} = '{k}'", str(v)) for k, v in ranks.items()], str(default))


def title_of(text: str) -> str:
    return f"split_part({text}, chr(10), 1)"


ITEMS = f"""items AS (
  SELECT source AS source_id, 'https://' || source || '.example.com/a/' || doc_id AS url, {title_of('text')} AS title,
    text AS summary, lang,
    CASE WHEN doc_id % 17 = 0 THEN NULL ELSE TIMESTAMP '2024-01-01' + to_hours(CAST(doc_id % 48 AS INTEGER)) END AS published_ts,
    CASE WHEN n_chars % 3 = 0 THEN 'https://img.example.com/' || doc_id || '.jpg' ELSE '' END AS image_url,
    doc_id % 4 = 0 AS is_new, doc_id AS arrival_seq
  FROM documents)"""

REGISTRY = f"""registry AS (
  SELECT source_id, 'Source ' || n AS name, 'pub' || (n % 8) AS publisher_id,
    {picks('n', 5, ['official', 'established_media', 'trade_media', 'social', 'industry_blog'])} AS source_class,
    {picks('n', 4, ['m-cn', 'm-hmt', 'm-intl', 'm-obs'])} AS market, n % 2 = 0 AS infer_market,
    {picks('n', 9, ['film', 'series', 'bulletin', 'film', 'bulletin', 'bulletin', 'film', 'bulletin', 'advert'])} AS entry_type,
    {picks('n', 6, ['en', 'en', 'fr', 'en', 'de', 'en'])} AS language,
    CASE WHEN n % 9 = 4 THEN 'network' END AS distribution, CAST(n % 4 AS INTEGER) AS content_priority,
    CASE WHEN n % 5 = 1 THEN 'der,tion,elle' ELSE '' END AS include_keywords,
    CASE WHEN n % 5 = 2 THEN 'Iónta,großen' ELSE '' END AS exclude_keywords,
    CASE WHEN n % 2 = 1 THEN 'title' END AS filter_scope, CASE WHEN n % 6 = 5 THEN 12.0::DOUBLE END AS max_age_hours,
    CASE WHEN n % 4 = 3 THEN 1 ELSE 0 END AS carry_forward_days, n % 3 = 0 AS enrich_media, n % 3 = 1 AS read_details,
    n % 7 <> 6 AS enabled, n AS source_order
  FROM (SELECT DISTINCT source AS source_id, CAST(substr(source, 4) AS INTEGER) AS n FROM documents))"""

_EXCLUDED = (
    "entry_type = 'advert' OR (contains(heading, 'thnd') AND NOT (contains(heading, 'tion') OR contains(heading, 'ment')))"
    " OR contains(whole, 'worthless')"
)
_SCOPED = "CASE WHEN filter_scope = 'title' THEN heading ELSE whole END"
_FILTERED = (
    f"(include_keywords <> '' AND NOT regexp_matches({_SCOPED}, 'der|tion|elle'))"
    f" OR (exclude_keywords <> '' AND regexp_matches({_SCOPED}, 'iónta|grossen'))"
)
_MAX_AGE = f"coalesce(max_age_hours, {POLICY.max_age_hours})"
_STALE = (
    f"published_ts > {NOW} + INTERVAL 1 HOUR OR epoch_us({NOW}) - epoch_us(published_ts) > {_MAX_AGE} * 3600000000"
)

LABELLED = f"""joined AS (
  SELECT i.*, r.* EXCLUDE (source_id), {fold('title')} AS heading, {fold("title || ' ' || summary")} AS whole
  FROM items i LEFT JOIN (SELECT * FROM registry WHERE enabled) r ON i.source_id = r.source_id),
labelled AS (
  SELECT *, CASE WHEN source_order IS NULL THEN 'disabled_source' WHEN {_EXCLUDED} THEN 'excluded'
    WHEN {_FILTERED} THEN 'source_filter' WHEN published_ts IS NULL THEN 'undated' WHEN {_STALE} THEN 'stale' END AS drop_reason
  FROM joined)"""

_MARKET = case(
    [("NOT infer_market", "market")]
    + [(matches("heading", p), f"'{m}'") for m, p in LATIN.market_titles]
    + [(matches("lead", LATIN.dateline), f"'{LATIN.dateline_market}'")],
    "market",
)
_THEATRICAL, _FILM = matches("folded", LATIN.theatrical), matches("folded", LATIN.film)
_DISTRIBUTION = case(
    [
        ("distribution IS NOT NULL", "distribution"),
        (matches("folded", LATIN.network), "'network'"),
        (matches("title", LATIN.film_title), f"CASE WHEN {_THEATRICAL} THEN 'cinema' ELSE 'film_unspecified' END"),
        (f"entry_type = 'series' OR {matches('folded', LATIN.series)}", "'series'"),
        (f"{matches('folded', LATIN.premiere)} AND {_FILM}", "'network'"),
        (_THEATRICAL, "'cinema'"),
        (f"contains(entry_type, 'film') OR {_FILM}", "'film_unspecified'"),
    ],
    "'other'",
)
_CONFIDENCE = case(
    [("source_class = 'industry_blog'", "'industry_commentary'"), ("source_class = 'social'", "'social_lead'"),
     ("source_class = 'official'", "'official'")],
    "'single_source'",
)
_KEY = r"substr(regexp_replace(lower(title), '[^\p{L}\p{N}_]+', '', 'g'), 1, 160)"
_CAPTION = r"regexp_replace(summary, '\s+', '', 'g')"

CANDIDATES = f"""cut AS (
  SELECT * REPLACE (substr(summary, 1, 800) AS summary), {fold("substr(summary, 1, 100)")} AS lead,
    {fold("title || ' ' || substr(summary, 1, 800)")} AS folded, {_CONFIDENCE} AS confidence
  FROM labelled WHERE drop_reason IS NULL),
candidates AS (
  SELECT substr(sha256(source_id || url), 1, 16) AS id, title, summary, url, published_ts, is_new, {_MARKET} AS market, entry_type,
    language, content_priority, {_DISTRIBUTION} AS distribution, carry_forward_days, confidence, image_url, source_id, publisher_id,
    name AS source_name, source_class, CAST(source_order AS BIGINT) * 1000000000 + arrival_seq AS seq,
    CASE WHEN confidence = 'social_lead' AND source_id IN ('src3', 'src8') AND {_CAPTION} <> ''
           THEN 'ticketing:' || sha256({_CAPTION}) || {day('published_ts')}
         WHEN confidence = 'social_lead' THEN url ELSE {_KEY} || {day('published_ts')} END AS dedup_key
  FROM cut)"""

DIST = rank("distribution", DISTRIBUTION_RANK, 5)
_CLASS = rank("source_class", {"official": 0, "trade_media": 1, "established_media": 1, "social": 3, "industry_blog": 4}, 5)

MERGED = f"""evidence AS (
  SELECT dedup_key, count(*) AS record_count, min(seq) AS group_seq FROM candidates GROUP BY 1),
links AS (
  SELECT * FROM candidates QUALIFY row_number() OVER (PARTITION BY dedup_key, publisher_id, url ORDER BY seq DESC) = 1),
linked AS (
  SELECT dedup_key, count(*) AS source_count, min({_CLASS}) AS evidence_rank, bool_or(source_id IN ('src3', 'src8')) AS from_social,
    bool_or(source_class = 'industry_blog') AS from_blog FROM links GROUP BY 1),
primaries AS (
  SELECT * FROM candidates QUALIFY row_number() OVER (PARTITION BY dedup_key ORDER BY {DIST}, content_priority, seq) = 1),
merged AS (
  SELECT p.*, e.record_count, e.group_seq, l.source_count, l.evidence_rank, l.from_social, l.from_blog
  FROM primaries p JOIN evidence e USING (dedup_key) JOIN linked l USING (dedup_key))"""

_TODAY = f"{day('published_ts')} = {TODAY} OR (date_diff('day', {day('published_ts')}, {TODAY}) BETWEEN 0 AND carry_forward_days)"
_LIMIT = case([(f"market = '{m}'", str(n)) for m, n in POLICY.max_items_per_market.items()], "1000000000")
_READING = f"{DIST}, content_priority, published_ts DESC, group_seq"
_SPOKEN = "language IN ('en', 'fr')"

EDITION = f"""pool AS (SELECT * FROM merged WHERE {_SPOKEN}),
today AS (SELECT *, {day('published_ts')} <> {TODAY} AS is_carried_forward FROM pool WHERE {_TODAY}),
edition AS (SELECT * FROM today QUALIFY row_number() OVER (PARTITION BY market ORDER BY {_READING}) <= {_LIMIT})"""

LABEL_CTE = f"WITH {ITEMS}, {REGISTRY}, {LABELLED}"
CAND_CTE = f"{LABEL_CTE}, {CANDIDATES}"
MERGE_CTE = f"{CAND_CTE}, {MERGED}"
EDITION_CTE = f"{MERGE_CTE}, {EDITION}"

SHOWN = f"id, title, url, market, distribution, content_priority, confidence, language, {iso('published_ts')} AS published_at"

# --- status and coverage ------------------------------------------------------------------

STATUS = f"""reports AS (
  SELECT source_id, CASE WHEN source_order % 10 = 3 THEN 'partial' WHEN source_order % 10 = 9 THEN 'error' ELSE 'ok' END AS status
  FROM registry),
fetched AS (
  SELECT source_id, count(*) AS fetched, max(published_ts) AS latest,
    count(*) FILTER (WHERE {day('published_ts')} = {TODAY}) AS today_fetched,
    count(*) FILTER (WHERE published_ts IS NULL) AS undated_items FROM items GROUP BY 1),
status AS (
  SELECT r.source_id, r.name, r.market, p.status,
    CASE WHEN p.status <> 'error' THEN coalesce(f.fetched, 0) ELSE 0 END AS fetched,
    CASE WHEN p.status <> 'error' THEN coalesce(f.today_fetched, 0) ELSE 0 END AS today_fetched,
    CASE WHEN p.status <> 'error' THEN coalesce(f.undated_items, 0) ELSE 0 END AS undated_items,
    CASE WHEN p.status <> 'error' THEN {iso('f.latest')} END AS latest_published_at
  FROM registry r JOIN reports p USING (source_id) LEFT JOIN fetched f USING (source_id) WHERE r.enabled)"""

_ASKS = f"drop_reason IS NULL AND enrich_media AND {day('published_ts')} = {TODAY} AND (image_url = '' OR contains(heading, 'er') OR contains(heading, 'le'))"
_RUN_METRICS = [
    ("stored_records", "(SELECT count(*) FROM labelled)"),
    ("new_records", "(SELECT count(*) FROM labelled WHERE is_new)"),
    ("items", "(SELECT count(*) FROM edition)"),
    ("pool_items", "(SELECT count(*) FROM pool)"),
    ("dropped_language", f"(SELECT count(*) FROM merged WHERE NOT {_SPOKEN})"),
    ("dropped_not_today", "(SELECT count(*) FROM pool) - (SELECT count(*) FROM today)"),
    ("dropped_capacity", "(SELECT count(*) FROM today) - (SELECT count(*) FROM edition)"),
    ("carried_forward", "(SELECT count(*) FROM edition WHERE is_carried_forward)"),
    ("media_enrichment_requests", f"(SELECT least({POLICY.max_media_enrichments}, count(*)) FROM labelled WHERE {_ASKS})"),
] + [(f"dropped_{r}", f"(SELECT count(*) FROM labelled WHERE drop_reason = '{r}')") for r in ("excluded", "source_filter", "undated", "stale")]


def metric_union(metrics) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS metric, CAST({v} AS BIGINT) AS value" for n, v in metrics)


# --- store --------------------------------------------------------------------------------

OBSERVED = """observed AS (
  SELECT event_type AS source_id, 'https://example.com/u/' || user_id AS url, event_type AS title,
    CASE WHEN event_id % 3 = 0 THEN '' ELSE json_extract_string(props, '$.k') END AS summary,
    CASE WHEN event_id % 4 = 0 THEN CAST(event_id % 5 AS INTEGER) END AS content_priority,
    date_trunc('day', ts) AS run_ts, (event_id * 7919) % 1000003 * 4294967296 + event_id AS arrival_seq
  FROM events)"""

STORE_SQL = f"""WITH {OBSERVED}
SELECT source_id, url, arg_max(title, arrival_seq) AS title,
  coalesce(arg_max(summary, arrival_seq) FILTER (WHERE trim(coalesce(summary, '')) <> ''), min_by(summary, arrival_seq)) AS summary,
  arg_max(content_priority, arrival_seq) FILTER (WHERE content_priority IS NOT NULL) AS content_priority,
  {iso('arg_min(CAST(run_ts AS TIMESTAMP), arrival_seq)')} AS first_seen_at, {iso('CAST(max(run_ts) AS TIMESTAMP)')} AS last_seen_at
FROM observed GROUP BY 1, 2"""

_FAULTY = """CASE WHEN content_priority = 1 THEN replace(url, 'https://', 'ftp://')
  WHEN content_priority = 2 THEN replace(url, 'https://', 'https://user:pw@') ELSE url END"""

# --- pages --------------------------------------------------------------------------------

_HTML_CLEAN = r"regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', ' ', 'g')"


def decoded(text: str) -> str:
    """The entities these pages hold, decoded as often as the text needs."""
    one = f"replace(replace(replace({text}, '&quot;', '\"'), '&copy;', '©'), '&middot;', '·')"
    return f"regexp_replace(regexp_replace({one}, '&amp;?', '&', 'g'), '&amp;?', '&', 'g')"


def page_text(text: str) -> str:
    plain = f"regexp_replace({text}, '<[^>]+>', ' ', 'g')"
    return rf"trim(regexp_replace({decoded(plain)}, '\s+', ' ', 'g'))"


def host(url: str) -> str:
    return f"lower(regexp_extract({url}, '^[a-z]+://([^/?#:]*)', 1))"


PAGE_LINKS = rf"""WITH anchors AS (
  SELECT page_id, url AS page_url, unnest(regexp_extract_all({_HTML_CLEAN}, '(?is)<a\b[^>]*>.*?</a>')) AS anchor,
    generate_subscripts(regexp_extract_all({_HTML_CLEAN}, '(?is)<a\b[^>]*>.*?</a>'), 1) AS pos FROM pages),
links AS (
  SELECT page_id, pos, page_url, {page_text("regexp_extract(anchor, '(?is)^<a[^>]*>(.*)</a>$', 1)")} AS title,
    regexp_extract(anchor, 'href="([^"]*)"', 1) AS href FROM anchors),
resolved AS (
  SELECT *, CASE WHEN href LIKE 'http%' THEN href WHEN href LIKE '/%' THEN regexp_extract(page_url, '^([a-z]+://[^/?#]*)', 1) || href ELSE '' END AS url
  FROM links)
SELECT url, arg_min(title, (length(title), page_id, pos)) AS title, count(*) AS mentions FROM resolved
WHERE {host('url')} = {host('page_url')} AND regexp_matches(url, '^https?://[^/]+/[a-zß-ÿ]+$')
  AND ({' OR '.join(f"contains(title, '{w}')" for w in LINK_WORDS)})
GROUP BY url"""

CAPTURED = """captured AS (
  SELECT page_id, 'https://src' || (page_id % 20) || '.example.com/a/' || page_id AS url,
    CASE WHEN page_id % 3 = 0 THEN 'https://src' || (page_id % 20) || '.example.com/img/' || page_id || '.png'
         WHEN page_id % 4 = 1 THEN '' ELSE 'https://cdn.example.com/' || page_id || '.jpg' END AS image_url,
    CASE WHEN page_id % 5 <> 0 THEN TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(page_id % 3 AS INTEGER))
      + to_minutes(CAST(page_id % 10 AS INTEGER)) END AS clock,
    'Brief of page ' || page_id AS brief, html FROM pages)"""

_H1 = page_text("regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)")
_PAGE_TITLE = page_text("regexp_extract(html, '(?is)<title>(.*?)</title>', 1)")

MEDIA = f"""{LABEL_CTE}, {CAPTURED},
wanted AS (
  SELECT url FROM labelled WHERE drop_reason IS NULL AND enrich_media AND {day('published_ts')} = {TODAY}
    AND (image_url = '' OR contains(heading, 'er') OR contains(heading, 'le'))
  ORDER BY source_order, arrival_seq LIMIT {POLICY.max_media_enrichments})
SELECT l.url, CASE WHEN l.image_url <> '' THEN l.image_url WHEN w.url IS NOT NULL THEN coalesce(c.image_url, '') ELSE '' END AS image_url,
  '' AS video_url
FROM labelled l LEFT JOIN wanted w ON l.url = w.url LEFT JOIN captured c ON l.url = c.url WHERE l.drop_reason IS NULL"""

# Two runs, each with its own budget, over pages that no earlier run asked for.
WRITE_BACK = f"""{LABEL_CTE}, {CAPTURED},
wanted AS (SELECT url FROM labelled WHERE {_ASKS} ORDER BY source_order, arrival_seq LIMIT {2 * POLICY.max_media_enrichments}),
raw AS (
  SELECT i.source_id, i.url, CASE WHEN n_chars % 3 = 1 THEN 'https://img.example.com/logo.png' ELSE image_url END AS image_url
  FROM items i JOIN documents d ON d.doc_id = i.arrival_seq)
SELECT r.source_id, r.url, CASE WHEN r.image_url NOT LIKE '%.jpg' AND w.url IS NOT NULL AND c.image_url <> '' THEN c.image_url ELSE r.image_url END AS image_url,
  CAST(NULL AS VARCHAR) AS video_url,
  CASE WHEN w.url IS NOT NULL THEN 1 ELSE 0 END AS requests, '2024-01-02T18:00:00Z' AS last_seen_at
FROM raw r LEFT JOIN wanted w ON r.url = w.url LEFT JOIN captured c ON r.url = c.url"""

DETAIL = f"""WITH {ITEMS}, {REGISTRY}, {CAPTURED},
list AS (
  SELECT i.url, i.title, i.summary, coalesce({iso('i.published_ts')}, '') AS published, i.published_ts IS NULL OR r.read_details AS needed
  FROM items i JOIN registry r ON i.source_id = r.source_id WHERE r.enabled)
SELECT l.url, CASE WHEN needed AND clock IS NOT NULL AND {_H1} <> '' THEN {_H1} ELSE l.title END AS title,
  CASE WHEN needed AND clock IS NOT NULL THEN brief ELSE l.summary END AS summary,
  CASE WHEN needed AND clock IS NOT NULL THEN {iso('clock')} ELSE l.published END AS published,
  CASE WHEN needed AND clock IS NULL THEN 'detail_unavailable' ELSE 'ok' END AS detail_status
FROM list l LEFT JOIN captured c ON l.url = c.url"""

CANONICAL = rf"""WITH parts AS (
  SELECT page_id, regexp_extract(url, '^([a-z]+)://', 1) AS scheme, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host,
    regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(url, '\?([^#]*)', 1) AS query FROM pages),
kept AS (
  SELECT *, array_to_string(list_filter(string_split(query, '&'), lambda x: x <> '' AND NOT starts_with(lower(x), 'utm_')), '&') AS q FROM parts)
SELECT page_id, scheme || '://' || host || rtrim(path, '/') || CASE WHEN q <> '' THEN '?' || q ELSE '' END AS url, lower(host) AS host FROM kept"""

CLEAN_TITLES = rf"""SELECT page_id, {_PAGE_TITLE} AS title,
  substr(regexp_replace(lower({_PAGE_TITLE}), '[^\p{{L}}\p{{N}}_]+', '', 'g'), 1, 160) AS title_key FROM pages"""


# --- feeds, notices, posts ----------------------------------------------------------------


def squeezed(text: str) -> str:
    return rf"trim(regexp_replace({text}, '\s+', ' ', 'g'))"


FEED_ITEMS = f"""WITH {ITEMS} SELECT {squeezed('title')} AS title, url || '?id=' || arrival_seq AS url, {squeezed('summary')} AS summary,
  coalesce({iso('published_ts')}, '') AS published FROM items WHERE {squeezed('title')} <> ''"""
FEED_MEDIA = f"""WITH {ITEMS} SELECT url || '?id=' || arrival_seq AS url,
  CASE arrival_seq % 3 WHEN 0 THEN 'https://img.example.com/e' || arrival_seq || '.jpg'
    WHEN 1 THEN 'https://img.example.com/b' || arrival_seq || '.png' ELSE '' END AS image_url,
  CASE WHEN arrival_seq % 3 = 1 THEN 'https://v.example.com/' || arrival_seq || '.mp4' ELSE '' END AS video_url
FROM items WHERE {squeezed('title')} <> ''"""

NOTICE_ROWS = f"""notice AS (
  SELECT page_id, url, unnest(regexp_extract_all(html, '<p>([^<]*)', 1)) AS p,
    generate_subscripts(regexp_extract_all(html, '<p>([^<]*)', 1), 1) - 1 AS i FROM pages),
rows_of AS (
  SELECT url, CAST(i + 1 AS INTEGER) AS row_pos,
    CASE i % 4 WHEN 0 THEN '影剧字' WHEN 1 THEN '影动字' WHEN 2 THEN '影合字' ELSE '备字' END || i AS filing_no,
    {squeezed(decoded('p'))} AS title, 'Company ' || page_id AS company, page_id,
    CASE i % 4 WHEN 0 THEN '故事影片' WHEN 1 THEN '动画影片' WHEN 2 THEN '合拍影片' ELSE '纪录影片' END AS category FROM notice)"""

NOTICE_SUMMARY = f"""WITH {NOTICE_ROWS},
counts AS (SELECT url, category, count(*) AS n, min(row_pos) AS spot FROM rows_of GROUP BY 1, 2),
by_notice AS (SELECT url, sum(n) AS total, string_agg(category || n || '部', '、' ORDER BY spot) AS copy FROM counts GROUP BY 1),
samples AS (SELECT url, string_agg(title, '、' ORDER BY row_pos) AS names FROM rows_of WHERE row_pos <= 8 GROUP BY 1),
canonical AS ({CANONICAL})
SELECT c.url, '2024年1月上电影备案立项公示：' || total || '部项目' AS title,
  '国家电影局公布2024年1月上电影剧本（梗概）备案、立项结果，共' || total || '部：' || copy || '。涉及《' || names
  || CASE WHEN total > 8 THEN '等' || total || '部' ELSE '' END || '》。备案立项仅代表项目获准拍摄，不代表已经定档或取得公映许可。' AS summary,
  '2024-01-02T00:00:00+08:00' AS published, 'cinema_filing' AS distribution
FROM by_notice JOIN samples USING (url) JOIN pages p USING (url) JOIN canonical c ON c.page_id = p.page_id"""

POSTS = f"""posts AS (
  SELECT role AS target, turn AS page, {squeezed('text')} AS summary, CAST(conv_id AS VARCHAR) AS post_id, role AS author,
    turn % 3 = 2 AS is_repost, turn % 2 = 0 AS text_complete FROM conversations WHERE role <> 'system' AND {squeezed('text')} <> ''),
titled AS (SELECT *, CASE WHEN length(summary) > 100 THEN substr(summary, 1, 100) || '…' ELSE summary END AS title FROM posts)"""

INGEST = f"""SELECT 'feed' AS source_id, title, url, summary, published FROM ({FEED_ITEMS})
UNION ALL SELECT 'notice', title, url, summary, published FROM ({NOTICE_SUMMARY})
UNION ALL SELECT 'listing', title, url, '', '' FROM ({PAGE_LINKS})
UNION ALL SELECT target, title, url, summary, published FROM (WITH {POSTS} SELECT target, title, summary,
  'https://m.weibo.cn/detail/' || post_id AS url, 'Tue Sep 22 10:10:00 +0800 2026' AS published FROM titled
  QUALIFY row_number() OVER (PARTITION BY post_id ORDER BY target, page) = 1)"""

# --- translation --------------------------------------------------------------------------

TRANSLATED = f"""docs AS (
  SELECT 'https://' || source || '.example.com/a/' || doc_id AS url, doc_id AS arrival_seq, lang AS language, text AS summary,
    {title_of('text')} AS title FROM documents),
keyed AS (SELECT *, sha256(concat('m', chr(0), title, chr(0), summary)) AS content_key FROM docs),
cache AS (
  SELECT content_key, min(CASE WHEN length(title) % 9 = 0 THEN title ELSE concat('译 ', title) END) AS cached FROM keyed
  WHERE length(summary) % 3 = 0 GROUP BY 1),
translated AS (
  SELECT k.*, CASE WHEN language <> 'en' THEN NULL WHEN c.cached LIKE '译 %' AND length(c.cached) <= greatest(250, 4 * length(title))
      THEN 'machine_translated' ELSE 'original_english' END AS translation_status, c.cached
  FROM keyed k LEFT JOIN cache c USING (content_key))"""

# --- events -------------------------------------------------------------------------------


def compacted(text: str) -> str:
    """Compatibility form, as far as these texts need it, with single spaces."""
    return squeezed(f"replace({text}, '…', '...')")


def kind_of(*texts: str) -> str:
    return case([(matches(t, p), f"'{k}'") for t in texts for k, p in LATIN.event_kinds], "'other'")


def norm(text: str) -> str:
    return rf"regexp_replace(lower({text}), '[^\p{{L}}\p{{N}}_]+', '', 'g')"


def found(text: str, pattern: str, group: int = 0) -> str:
    return f"nullif(regexp_extract({text}, '{re2(pattern)}', {group}), '')"


def visible(text: str) -> str:
    plain = rf"regexp_replace({text}, 'https?://\S+', '', 'g')"
    plain = rf"regexp_replace({plain}, '#([^#\n]{{2,80}})#', '', 'g')"
    plain = rf"regexp_replace({plain}, '@[\p{{L}}\p{{N}}_-]+', '', 'g')"
    return f"trim({squeezed(plain)}, '，。；、# ')"


def signal(rule) -> str:
    parts = []
    if rule.title:
        parts.append(matches("title_c", rule.title))
    if rule.not_title:
        parts.append(f"NOT {matches('title_c', rule.not_title)}")
    if rule.summary:
        parts.append(matches("summary_c", rule.summary))
    if rule.not_summary:
        parts.append(f"NOT {matches('summary_c', rule.not_summary)}")
    if rule.social_only:
        parts.append("from_social")
    if rule.short_other:
        title_fact, summary_fact = LATIN.short_facts
        parts = ["length(summary_c) < 25", "kind = 'other'", f"NOT {matches('title_c', LATIN.fact_words)}",
                 f"NOT {matches('title_c', title_fact)}", f"NOT {matches('summary_c', summary_fact)}"]
    return " AND ".join(parts)


_WORK = f"coalesce({found('title_c', LATIN.work, 1)}, {found('substr(summary_c, 1, 170)', LATIN.work, 1)}, '')"
_MILESTONE = case(
    [
        ("kind = 'box_office'", f"CASE WHEN {matches('lead_c', LATIN.advance)} THEN 'advance:' ELSE 'total:' END || "
                                f"{norm('coalesce(' + found('lead_c', LATIN.amount) + ', title)')}"),
        ("kind = 'release_date'", norm(f"regexp_extract(lead_c, '{re2(LATIN.date)}')")),
        ("kind = 'music_asset'", norm(f"regexp_extract(lead_c, '{LATIN.song}', 1)")),
        ("kind IN ('trailer', 'poster')", norm(f"regexp_extract(title, '{LATIN.material}', 1)")),
    ],
    "''",
)
_EDITION_OF = f"coalesce({found('title_c || chr(32) || summary', LATIN.award_edition)}, '{LATIN.award_edition_default}')"
_TOPIC = case(
    [
        (f"event_market = 'm-cn' AND contains(title_c, '{LATIN.award_series}') AND {matches('title_c', LATIN.award_list)}",
         f"'{LATIN.award_series_name}:' || {_EDITION_OF} || ':nominees'"),
        (f"kind = 'box_office' AND contains(title_c, '{LATIN.person_title}')", f"'{LATIN.person_name}:box_office:' || milestone"),
        ("work <> '' AND kind <> 'other'", "work || ':' || kind || ':' || milestone"),
    ],
    f"kind || ':headline:' || {norm('title_c')}",
)
_BARE = squeezed(f"regexp_replace(CASE WHEN visible_title <> '' THEN visible_title ELSE title_c END, '{LATIN.lead_words}', '')")
_POSITION = f"(market, {DIST}, content_priority, -epoch_us(published_ts), group_seq)"
_RANK = (
    f"(evidence_rank, CASE WHEN market <> 'm-obs' THEN 0 ELSE 1 END, CASE WHEN {matches('title', LATIN.general_award)} THEN 0 ELSE 1 END, "
    f"CASE WHEN image_url <> '' THEN 0 ELSE 1 END, -length({visible('summary_c')}))"
)

ANALYSED = f"""compacted AS (
  SELECT *, {compacted('title')} AS title_c, {compacted('summary')} AS summary_c,
    {compacted("title || ' ' || substr(summary, 1, 140)")} AS lead_c, CAST({day('published_ts')} AS VARCHAR) AS day FROM pool),
kinds AS (
  SELECT *, {kind_of('title_c', 'substr(summary_c, 1, 180)')} AS kind, {norm(_WORK)} AS work, {visible('title_c')} AS visible_title,
    CASE WHEN market = 'm-obs' AND {matches('title_c', LATIN.award_market_title)} THEN 'm-cn' ELSE market END AS event_market
  FROM compacted),
staged AS (
  SELECT *, {_MILESTONE} AS milestone, {_BARE} AS bare, {case([(signal(r), f"'{r.reason}'") for r in LATIN.signals], 'NULL')} AS reason
  FROM kinds),
analysed AS (
  SELECT *, {_TOPIC} AS topic, CASE WHEN length(bare) > 72 THEN rtrim(substr(bare, 1, 72), '，。、：: -') || '…' ELSE bare END AS headline
  FROM staged),
seen AS (
  SELECT day, topic, bool_or(event_market = 'm-obs') AS observed, count(DISTINCT event_market) FILTER (WHERE event_market <> 'm-obs') AS specific,
    max(event_market) FILTER (WHERE event_market <> 'm-obs') AS single FROM analysed WHERE reason IS NULL GROUP BY 1, 2),
placed AS (
  SELECT a.*, CASE WHEN a.event_market = 'm-obs' AND s.specific = 1 THEN s.single ELSE a.event_market END AS target,
    a.event_market = 'm-obs' AND s.specific = 1 AS folded
  FROM analysed a JOIN seen s USING (day, topic) WHERE reason IS NULL)"""

EVENTS = f"""ranked AS (
  SELECT *, row_number() OVER (PARTITION BY day, topic, target ORDER BY {_RANK}, folded, {_POSITION}) AS rn,
    count(*) OVER (PARTITION BY day, topic, target) AS group_size,
    first_value(image_url) OVER (PARTITION BY day, topic, target ORDER BY CASE WHEN image_url <> '' THEN 0 ELSE 1 END, folded, {_POSITION}) AS any_image,
    min(CASE WHEN NOT folded THEN {_POSITION} END) OVER (PARTITION BY day, topic, target) AS event_position
  FROM placed),
events_of AS (
  SELECT * EXCLUDE (market, image_url), CASE WHEN target <> 'm-obs' THEN target ELSE market END AS market,
    CASE WHEN image_url <> '' THEN image_url ELSE any_image END AS image_url, day || ':' || event_market || ':' || topic AS event_key
  FROM ranked WHERE rn = 1),
relevant AS (
  SELECT *, {kind_of('headline', 'substr(summary_c, 1, 180)')} AS relevance_kind FROM events_of),
ordered AS (
  SELECT *, {rank('relevance_kind', EVENT_RANK, 5)} + CASE WHEN relevance_kind = 'filing' AND from_social THEN 2 ELSE 0 END AS kind_rank,
    CASE WHEN image_url <> '' THEN 0 ELSE 1 END AS no_image FROM relevant)"""

_BUDGET = case([(f"market = '{m}'", str(n)) for m, n in BUDGETS.items()], "NULL")
CHOSEN = f"""numbered AS (
  SELECT *, {_BUDGET} AS budget,
    row_number() OVER (PARTITION BY market ORDER BY kind_rank, evidence_rank, no_image, -epoch_us(published_ts), event_position) AS place FROM ordered),
series AS (
  SELECT market, min(place) FILTER (WHERE distribution = 'series') AS best,
    count(*) FILTER (WHERE distribution = 'series' AND place <= budget) AS shown FROM numbered GROUP BY 1),
chosen AS (
  SELECT n.*, CASE WHEN budget IS NULL THEN TRUE
    WHEN budget >= 6 AND s.shown = 0 AND s.best IS NOT NULL AND place = budget THEN FALSE
    WHEN budget >= 6 AND s.shown = 0 AND place = s.best THEN TRUE ELSE place <= budget END AS selected
  FROM numbered n JOIN series s USING (market))"""

ANALYSE_CTE = f"{EDITION_CTE}, {ANALYSED}"
EVENT_CTE = f"{ANALYSE_CTE}, {EVENTS}"
CHOSEN_CTE = f"{EVENT_CTE}, {CHOSEN}"

_BRIEF_METRICS = [
    ("source_items", "(SELECT count(*) FROM analysed)"),
    ("filtered_low_signal", "(SELECT count(*) FROM analysed WHERE reason IS NOT NULL)"),
    ("available_events", "(SELECT count(*) FROM events_of)"),
    ("brief_events", "(SELECT count(*) FROM chosen WHERE selected)"),
    ("more_events", "(SELECT count(*) FROM chosen WHERE NOT selected)"),
    ("merged_source_items", "(SELECT sum(group_size - 1) FROM events_of)"),
    ("items", "(SELECT count(*) FROM chosen WHERE selected)"),
    ("translated_home_items", "0"),
    ("original_english_home_items", "0"),
] + [(f"distribution_{d}", f"(SELECT count(*) FROM chosen WHERE selected AND distribution = '{d}')") for d in DISTRIBUTION_RANK] + [
    (f"market_{m}", f"(SELECT count(*) FROM chosen WHERE selected AND market = '{m}')") for m in MARKETS]

# --- content pack -------------------------------------------------------------------------

_PACK_RANK = rank("confidence", {"official": 0, "multi_source": 1, "single_source": 2}, 3)
_PACK_ORDER = f"{_PACK_RANK}, content_priority, published_ts DESC, group_seq"
PACK = f"""dated AS (SELECT *, {day('published_ts')} AS source_day FROM pool),
wanted AS (SELECT CASE WHEN bool_or(source_day = DATE '2024-01-02') THEN DATE '2024-01-02' ELSE max(source_day) END AS d FROM dated),
pack AS (
  SELECT *, row_number() OVER (ORDER BY {_PACK_ORDER}) AS place FROM dated WHERE source_day = (SELECT d FROM wanted)
  QUALIFY place <= 5)"""
PACK_CTE = f"{EDITION_CTE}, {PACK}"


def digest(order: str) -> str:
    return f"substr(sha256('[\"' || string_agg(id, '\",\"' ORDER BY {order}) || '\"]'), 1, 20)"


PACK_TAGS = f"""named AS (
  SELECT place, unnest(regexp_extract_all(title || ' ' || summary, '{LATIN.project}', 1)) AS tag,
    generate_subscripts(regexp_extract_all(title || ' ' || summary, '{LATIN.project}', 1), 1) AS pos FROM pack),
all_tags AS (
  SELECT 0 AS a, 1 AS b, 'news' AS tag UNION ALL SELECT 0, 2, 'daily' UNION ALL SELECT place, pos, tag FROM named
  UNION ALL SELECT 1000, 0, 'film'),
firsts AS (SELECT tag, min((a, b)) AS spot FROM all_tags GROUP BY 1)"""
_LEAD92 = f"CASE WHEN length({squeezed('summary')}) > 92 THEN rtrim(substr({squeezed('summary')}, 1, 92), '，、； ') || '…' ELSE {squeezed('summary')} END"
_LEAD76 = _LEAD92.replace("92", "76")
_STATUS = "CASE WHEN confidence IN ('official', 'multi_source') THEN '已确认' ELSE '待确认' END"

DIGESTS = f"""dated AS (SELECT *, {day('published_ts')} AS source_day FROM pool),
best AS (SELECT *, row_number() OVER (PARTITION BY source_day ORDER BY {_PACK_ORDER}) AS place FROM dated QUALIFY place <= 5),
digests AS (SELECT source_day, {digest('place')} AS digest FROM best GROUP BY 1)"""

ASSETS = f"""WITH {ITEMS},
names AS (
  SELECT substr(sha256(source_id || url), 1, 16) AS id, unnest(regexp_extract_all(title || summary, '{LATIN.project}', 1)) AS name,
    generate_subscripts(regexp_extract_all(title || summary, '{LATIN.project}', 1), 1) AS pos FROM items),
hits AS (
  SELECT n.id, n.pos, n.name, min(b.text) AS asset FROM names n JOIN benchmark b ON contains(b.text, n.name) GROUP BY 1, 2, 3)
SELECT id, arg_min(name, pos) AS name, arg_min(asset, pos) AS asset FROM hits GROUP BY id"""

_EVIDENCE = "CASE confidence WHEN 'official' THEN '官方发布' WHEN 'single_source' THEN '媒体报道' WHEN 'social_lead' THEN '社媒线索' ELSE '行业观察' END"
_CHANNEL = ("CASE distribution WHEN 'cinema' THEN '院线电影' WHEN 'cinema_filing' THEN '电影备案项目' WHEN 'network' THEN '网络电影' "
            "WHEN 'film_unspecified' THEN '电影·渠道待确认' WHEN 'series' THEN '剧集' ELSE '影视动态' END")
_LEAD180 = f"CASE WHEN length({squeezed('summary')}) <= 180 THEN {squeezed('summary')} ELSE rtrim(substr({squeezed('summary')}, 1, 180), '，。；、 ') || '…' END"

MISSING = f"""SELECT doc_id AS edition, {title_of('text')} AS title FROM (SELECT *, text AS summary FROM documents)
WHERE NOT contains({_LEAD180}, {title_of('text')})"""

_LABELS = case([("reason = 'anniversary'", "'纪念日回顾'"), ("reason = 'advance_teaser'", "'消息尚未公布'"),
                ("reason = 'promotion'", "'促销互动'"), ("reason = 'background_roundup'", "'背景整理'"),
                ("reason = 'outside_film_tv'", "'非影视业务动态'")], "'低信息量线索'")


def _person(family: str, number: str) -> str:
    return f"'{family}' || translate(CAST({number} AS VARCHAR), '0123456789', '零一二三四五六七八九')"


ORACLE_SQL: dict[str, str] = {
    "source_registry": f"""WITH {REGISTRY} SELECT source_id, name, publisher_id, source_class, market, infer_market, entry_type, language,
  distribution, content_priority, include_keywords, exclude_keywords, filter_scope, max_age_hours, carry_forward_days, source_order
FROM registry WHERE enabled""",
    "items_with_source": f"""WITH {ITEMS}, {REGISTRY} SELECT i.url, i.title, i.source_id, r.name AS src_name, r.source_class AS src_class,
  r.market AS src_market, r.source_order FROM items i JOIN registry r ON i.source_id = r.source_id WHERE r.enabled""",
    "filter_excluded": f"{LABEL_CTE} SELECT url, title, source_id FROM labelled WHERE drop_reason = 'excluded'",
    "filter_source_keywords": f"{LABEL_CTE} SELECT url, title, source_id FROM labelled WHERE drop_reason = 'source_filter'",
    "filter_freshness": f"{LABEL_CTE} SELECT url, source_id, {iso('published_ts')} AS published_at FROM labelled WHERE drop_reason = 'stale'",
    "filter_language": f"{EDITION_CTE} SELECT {SHOWN} FROM pool",
    "drop_funnel": f"{LABEL_CTE} SELECT coalesce(drop_reason, 'kept') AS reason, count(*) AS records FROM labelled GROUP BY 1",
    "dedup_titles": f"{MERGE_CTE} SELECT {SHOWN}, dedup_key, record_count, source_count, evidence_rank, from_social, from_blog FROM merged",
    "dedup_sources": f"{MERGE_CTE} SELECT dedup_key, publisher_id, url, source_id, source_name, source_class FROM links",
    "candidate_pool": f"{EDITION_CTE} SELECT {SHOWN} FROM pool ORDER BY published_ts DESC",
    "edition_day": f"""{MERGE_CTE} SELECT {SHOWN}, {day('published_ts')} <> {TODAY} AS is_carried_forward FROM merged WHERE {_TODAY}""",
    "cap_market": f"{MERGE_CTE}, capped AS (SELECT * FROM merged QUALIFY row_number() OVER (PARTITION BY market ORDER BY {_READING}) <= {_LIMIT}) SELECT {SHOWN} FROM capped",
    "daily_edition": f"""{EDITION_CTE} SELECT {SHOWN}, is_carried_forward, market AS section, strftime(published_ts + INTERVAL 8 HOUR, '%m/%d %H:%M') AS shown_time,
  {_EVIDENCE} AS evidence, {_CHANNEL} AS channel, {_LEAD180} AS lead FROM edition ORDER BY market, {_READING}""",
    "run_stats": f"{EDITION_CTE} {metric_union(_RUN_METRICS)}",
    "distribution_counts": f"""{EDITION_CTE} SELECT d.distribution, count(e.id) AS items
FROM (VALUES {', '.join(f"('{k}')" for k in DISTRIBUTION_RANK)}) d(distribution) LEFT JOIN edition e USING (distribution) GROUP BY 1""",
    "source_status": f"WITH {ITEMS}, {REGISTRY}, {STATUS} SELECT * FROM status",
    "source_totals": f"WITH {ITEMS}, {REGISTRY}, {STATUS} " + metric_union([
        ("configured_sources", "(SELECT count(*) FROM status)"),
        ("successful_sources", "(SELECT count(*) FROM status WHERE status IN ('ok', 'partial'))"),
        ("failed_sources", "(SELECT count(*) FROM status WHERE status <> 'ok')"),
        ("fetched_items", "(SELECT sum(fetched) FROM status)"),
    ]),
    "market_coverage": f"""{EDITION_CTE}, {STATUS},
cover AS (
  SELECT m.market, (SELECT count(*) FROM edition e WHERE e.market = m.market) AS items,
    (SELECT count(*) FROM status s WHERE s.market = m.market) AS configured_sources,
    (SELECT count(*) FROM status s WHERE s.market = m.market AND s.status <> 'error') AS successful_sources,
    (SELECT count(*) FROM status s WHERE s.market = m.market AND s.status <> 'ok') AS unavailable_sources
  FROM (VALUES ('m-cn'), ('m-hmt'), ('m-intl'), ('m-obs')) m(market))
SELECT *, CASE WHEN items > 0 THEN NULL WHEN configured_sources = 0 THEN 'no_source' WHEN successful_sources = 0 THEN 'no_success'
  WHEN unavailable_sources > 0 THEN 'partial' ELSE 'none_new' END AS empty_note FROM cover""",
    "store_projection": f"""WITH {OBSERVED} SELECT source_id, title, summary, url, content_priority, arrival_seq,
  '{{"id":"' || source_id || '","url":"' || url || '"}}' AS sources FROM observed""",
    "store_merge": STORE_SQL,
    "store_snapshot": STORE_SQL,
    "store_lookup": f"""SELECT s.* FROM ({STORE_SQL}) s JOIN (WITH {OBSERVED} SELECT DISTINCT source_id, url FROM observed
  WHERE arrival_seq >= 990000 * 4294967296) k USING (source_id, url)""",
    "stream_store_merge": STORE_SQL,
    "store_violations": f"""WITH {OBSERVED}, faulty AS (SELECT source_id, {_FAULTY} AS url FROM observed)
SELECT source_id, url, CASE WHEN url LIKE 'ftp%' THEN 'not_an_article_url' ELSE 'credentials_in_url' END AS violation FROM faulty
WHERE url LIKE 'ftp%' OR url LIKE '%@%'
UNION ALL SELECT source_id, url, 'duplicate_key' FROM faulty GROUP BY 1, 2 HAVING count(*) > 1""",
    "stream_daily_counts": f"""SELECT event_type AS source_id, CAST({day('ts')} AS VARCHAR) AS civil_day, count(*) AS arrivals FROM events GROUP BY 1, 2""",
    "page_links": PAGE_LINKS,
    "page_media": f"WITH {CAPTURED} SELECT page_id, url, image_url, '' AS video_url FROM captured",
    "media_enrich": MEDIA,
    "media_write_back": WRITE_BACK,
    "detail_enrich": DETAIL,
    "canonical_urls": CANONICAL,
    "clean_titles": CLEAN_TITLES,
    "feed_items": FEED_ITEMS,
    "feed_media": FEED_MEDIA,
    "notice_rows": f"WITH {NOTICE_ROWS} SELECT url, row_pos, filing_no, title, company, category FROM rows_of",
    "notice_summary": NOTICE_SUMMARY,
    "posts_normalized": f"""WITH {POSTS} SELECT target, page, title, summary, 'https://m.weibo.cn/detail/' || post_id AS url,
  'Tue Sep 22 10:10:00 +0800 2026' AS published, 'https://img.example.com/' || post_id || '.jpg' AS image_url, author, post_id AS author_id,
  post_id, 'weibo:' || post_id AS publisher_id, is_repost, CASE WHEN is_repost THEN 'https://m.weibo.cn/detail/1' ELSE '' END AS original_post_url,
  text_complete FROM titled""",
    "posts_rejected": f"""SELECT role AS target, CASE WHEN role = 'system' THEN 'response_error' ELSE 'bad_post' END AS reject, count(*) AS n
FROM conversations WHERE role = 'system' OR {squeezed('text')} = '' GROUP BY 1, 2""",
    "posts_dedup": f"""WITH {POSTS} SELECT post_id, target, page, title FROM titled
QUALIFY row_number() OVER (PARTITION BY post_id ORDER BY target, page) = 1""",
    "ingest_items": INGEST,
    "ingest_status": f"""WITH items AS ({INGEST}),
found AS (SELECT source_id, count(*) AS items FROM items GROUP BY 1),
lost AS (SELECT role AS source_id, count(*) AS rejects FROM conversations WHERE role = 'system' OR {squeezed('text')} = '' GROUP BY 1),
known AS (SELECT unnest({INGEST_SOURCES!r}) AS source_id)
SELECT source_id, coalesce(items, 0) AS items, coalesce(rejects, 0) AS rejects,
  CASE WHEN items IS NULL AND rejects IS NULL THEN 'silent' WHEN rejects IS NULL THEN 'ok' WHEN items > 0 THEN 'partial' ELSE 'failed' END AS outcome
FROM found FULL JOIN lost USING (source_id) FULL JOIN known USING (source_id)""",
    "hashtag_titles": rf"""WITH tagged AS (
  SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN '#' || substr({title_of('text')}, 1, 20) || '# ' || text ELSE text END AS text FROM documents)
SELECT doc_id, CASE WHEN regexp_matches(text, '#[^#\n]{{3,60}}#') THEN trim(regexp_extract(text, '#([^#\n]{{3,60}})#', 1))
  ELSE rtrim(substr(regexp_extract(text, '^([^。！？!?；;\n]*)', 1), 1, 70), '，。；、 ') END AS title FROM tagged""",
    "mail_dates": f"""SELECT event_id, {iso("date_trunc('second', CAST(ts AS TIMESTAMP)) - to_minutes(" + case(
        [("event_id % 6 = 2", "-300"), ("event_id % 6 = 3", "-420"), ("event_id % 6 = 4", "480"), ("event_id % 6 = 5", "-210")], "0") + ")")} AS published_at
FROM events""",
    "cast_names": f"""WITH people AS (SELECT doc_id, {_person('张', 'doc_id % 97')} AS a, {_person('李', 'n_chars % 89')} AS b,
  {_person('王', '(doc_id + n_chars) % 83')} AS c FROM documents)
SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN a || ',' || b || ',' || c WHEN 1 THEN a || ',' || b ELSE a || ',' || c END AS names FROM people""",
    "edition_sink": f"""{MERGE_CTE} SELECT id, url, language, CAST({day('published_ts')} AS VARCHAR) AS edition_date FROM merged
WHERE {day('published_ts')} <> DATE '2024-01-02' OR {_SPOKEN}""",
    "translation_attach": f"""WITH {TRANSLATED} SELECT url, language,
  CASE WHEN translation_status = 'machine_translated' THEN cached ELSE title END AS title, translation_status FROM translated""",
    "translation_queue": f"""WITH {TRANSLATED} SELECT content_key, arg_min(title, arrival_seq) AS original_title, min(arrival_seq) AS arrival_seq
FROM translated WHERE translation_status = 'original_english' GROUP BY 1 ORDER BY 3 LIMIT 75""",
    "translation_stats": f"WITH {TRANSLATED} " + metric_union([
        ("translated_home_items", "(SELECT count(*) FROM translated WHERE translation_status = 'machine_translated')"),
        ("original_english_home_items", "(SELECT count(*) FROM translated WHERE translation_status = 'original_english')"),
        ("cache_hits", "(SELECT count(*) FROM translated WHERE translation_status = 'machine_translated')"),
        ("requests", "(SELECT least(75, count(DISTINCT content_key)) FROM translated WHERE translation_status = 'original_english')"),
    ]),
    "low_signal": f"{ANALYSE_CTE} SELECT id, reason, title, url FROM analysed WHERE reason IS NOT NULL",
    "market_fold": f"""{ANALYSE_CTE} SELECT day, topic, 'm-obs' AS from_market, single AS to_market FROM seen WHERE observed AND specific = 1""",
    "event_groups": f"{EVENT_CTE} SELECT day, topic, target AS event_market, market, group_size, image_url FROM events_of",
    "event_primary": f"{EVENT_CTE} SELECT id, url, event_key, kind, headline, market FROM events_of",
    "event_relevance": f"{EVENT_CTE} SELECT id, headline, relevance_kind, kind_rank, evidence_rank AS evidence, no_image FROM ordered",
    "choose_events": f"{CHOSEN_CTE} SELECT id, market, distribution, selected FROM chosen",
    "brief_stats": f"{CHOSEN_CTE} {metric_union(_BRIEF_METRICS)}",
    "trace_pool": f"""{CHOSEN_CTE} SELECT id, headline AS title, url, 'more' AS reason, '简报之外的同日动态' AS label FROM chosen WHERE NOT selected
UNION ALL SELECT id, title, url, reason, {_LABELS} AS label FROM analysed WHERE reason IS NOT NULL""",
    "event_members": f"{ANALYSE_CTE} SELECT id, url, day, topic, target AS event_market FROM placed",
    "event_sources": f"""{ANALYSE_CTE} SELECT p.day, p.topic, p.target AS event_market, l.url AS source_url,
  arg_max(l.source_id, l.seq) AS source_id, arg_max(l.publisher_id, l.seq) AS publisher_id
FROM placed p JOIN links l USING (dedup_key) GROUP BY 1, 2, 3, 4""",
    "package_select": f"{PACK_CTE} SELECT {SHOWN}, place FROM pack",
    "package_tags": f"""{PACK_CTE}, {PACK_TAGS} SELECT row_number() OVER (ORDER BY spot) AS place, tag, row_number() OVER (ORDER BY spot) <= 18 AS shown FROM firsts""",
    "package_digest": f"""{PACK_CTE} SELECT {digest('place')} AS digest, '2024-01-03' AS publish_date, CAST(max(source_day) AS VARCHAR) AS source_date FROM pack""",
    "package_caption": f"""{PACK_CTE}, {PACK_TAGS},
tag_line AS (SELECT string_agg('#' || tag, ' ' ORDER BY spot) AS tags FROM (SELECT * FROM firsts ORDER BY spot LIMIT 18))
SELECT {digest('place')} AS digest, '一觉醒来，影视圈发生了什么？' AS title,
  '把昨天值得留意的影视动态整理成一组图。' || chr(10) || chr(10)
  || string_agg(lpad(CAST(place AS VARCHAR), 2, '0') || ' ' || title || '。' || {_LEAD92} || '（' || {_STATUS} || '）', chr(10) || chr(10) ORDER BY place)
  || chr(10) || chr(10) || (SELECT tags FROM tag_line) AS caption FROM pack""",
    "package_cards": f"""{PACK_CTE}, named AS (
  SELECT *, {squeezed('title')} AS raw, regexp_extract({squeezed('title')}, '{LATIN.project}', 1) AS work FROM pack)
SELECT place, id, CASE WHEN work <> '' THEN '《' || work || '》' ELSE raw END AS card_title,
  CASE WHEN work = '' THEN '' ELSE trim(raw, ' ，,·｜|-—') END AS card_event, {_LEAD76} AS lead, {_STATUS} AS status FROM named""",
    "asset_match": ASSETS,
    "publish_once": f"""{EDITION_CTE}, {DIGESTS} SELECT digest, CAST(min(source_day + INTERVAL 1 DAY)::DATE AS VARCHAR) AS publish_date FROM digests
WHERE digest NOT IN (SELECT digest FROM digests WHERE source_day < DATE '2024-01-02') GROUP BY 1""",
    "stream_publish": f"""{EDITION_CTE}, {DIGESTS} SELECT digest, CAST(min(source_day + INTERVAL 1 DAY)::DATE AS VARCHAR) AS publish_date
FROM digests GROUP BY 1""",
    "edition_index": f"""{MERGE_CTE} SELECT CAST({day('published_ts')} AS VARCHAR) AS d,
  '周' || substr('一二三四五六日', CAST(isodow({day('published_ts')}) AS INTEGER), 1) AS w, count(*) AS n FROM merged
WHERE {day('published_ts')} <> DATE '2024-01-01' GROUP BY 1, 2""",
    "edition_diff": f"""{EDITION_CTE}, published AS (SELECT id, title, market FROM merged WHERE language = 'en' OR market = 'm-obs'),
expected AS (SELECT id, title, market FROM pool)
SELECT *, 'missing' AS side FROM (SELECT * FROM expected EXCEPT ALL SELECT * FROM published)
UNION ALL SELECT *, 'unexpected' AS side FROM (SELECT * FROM published EXCEPT ALL SELECT * FROM expected)""",
    "missing_titles": MISSING,
}
