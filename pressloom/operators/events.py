"""Grouping records into events and choosing them under a budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressloom.functions import editorial as E
from pressloom.functions import text as X
from pressloom.functions.classify import ranked
from pressloom.functions.package import TRACE_LABELS, TRACE_MORE, TRACE_OTHER, mapped
from pressloom.functions.times import civil_day, iso_day
from pressloom.operators import phrases
from pressloom.operators.scale import SALTS, computed_once, first_by, limit_of, written
from pressloom.operators.stats import metric_rows
from pressloom.rules.pack import DISTRIBUTION_RANK, EVENT_RANK, MARKETS, OBSERVATION, SPECIFIC_MARKETS, RulePack

EVENT_KEY = ["day", "topic", "event_market"]
PRIMARY_FIELDS = [
    "id", "title", "summary", "url", "published_ts", "market", "confidence", "distribution",
    "entry_type", "image_url", "video_url", "title_c", "summary_c", "original_c", "kind", "headline",
    "copy", "raw_title", "raw_summary", "evidence_rank", "from_social", "from_blog", "event_market", "translation_status",
]
# Texts that decide the facts of a whole group.
_STREAMED = r"同步网播|同步上线网播"
_GROSS = r"(?U)(?:最终票房|票房)[^。；，,]{0,18}?\d+(?:\.\d+)?亿"
_ENTRIES = r"(?U)\d+部作品入围"
# Wording of the facts of a whole group.
_STREAMED_FACT = "同步网播"
_AWARD_LIST_FACT = "第35届电视剧飞天奖提名名单公布，"
_SONG_FACT = "同一歌曲的MV及歌词海报已发布"
_SONG_WORDS = ("MV", "歌词海报")
_RUN_END_TITLE = ("《", "》今日下映")
# Characters of the longest opening word and gap before the number of a gross.
_GROSS_REACH = 4 + 18


def analyse(items: DataFrame, pack: RulePack) -> DataFrame:
    """Edition items with kind, event key parts, headline, low-signal reason and primary rank.

    ``items`` come from the edition: they carry ``position`` and the merged evidence columns.
    """
    c = F.col
    for name in ("original_title", "original_summary", "translation_status"):
        if name not in items.columns:
            items = items.withColumn(name, F.lit(None).cast("string"))
    lead = F.concat_ws(" ", c("title"), F.substring(X.text_or_empty(c("summary")), 1, 140))
    compacted = computed_once(
        items,
        {
            "title_c": X.compact(c("title")),
            "summary_c": X.compact(c("summary")),
            "original_c": X.compact(c("original_title")),
            "original_summary_c": X.compact(c("original_summary")),
            "lead_c": X.compact(lead),
            "raw_title": X.text_or_empty(c("title")),
            "raw_summary": X.text_or_empty(c("summary")),
            "day": iso_day(civil_day(c("published_ts"))),
        },
    )
    kind_title = F.when(c("original_c") != "", c("original_c")).otherwise(c("title_c"))
    kind_summary = F.when(c("original_summary_c") != "", c("original_summary_c")).otherwise(c("summary_c"))
    named = computed_once(
        compacted,
        {
            "kind": E.event_kind(kind_title, kind_summary, pack),
            "work": E.work_name(c("title_c"), c("original_c"), c("summary_c"), pack),
            "event_market": E.editorial_market(c("market"), c("title_c"), pack),
            "visible_title": X.visible_copy(c("title_c")),
            "visible_summary": X.visible_copy(c("summary_c")),
        },
    )
    edition_text = F.concat_ws(" ", "title_c", "raw_summary")
    rank = F.struct(
        c("evidence_rank").alias("evidence"),
        F.when(c("market") != OBSERVATION, 0).otherwise(1).alias("specific"),
        F.when(c("raw_title").rlike(pack.general_award), 0).otherwise(1).alias("general"),
        F.when((X.text_or_empty(c("image_url")) != "") | (X.text_or_empty(c("video_url")) != ""), 0)
        .otherwise(1).alias("media"),
        (-F.length("visible_summary")).alias("length"),
    )
    keyed = named.withColumns(
        {
            "milestone": E.milestone(c("kind"), c("raw_title"), c("lead_c"), pack),
            "headline": E.short_headline(c("title_c"), c("visible_title"), pack),
            "copy": E.news_copy(c("visible_summary"), pack),
            "reason": E.low_signal_reason(c("title_c"), c("summary_c"), c("kind"), c("from_social"), pack),
            "primary_rank": rank,
        }
    ).withColumn(
        "topic",
        E.event_topic(c("kind"), c("event_market"), c("title_c"), edition_text, c("work"), c("milestone"), pack),
    )
    return computed_once(
        keyed.drop("lead_c", "original_summary_c", "visible_title", "visible_summary", "milestone"),
        {"reason": c("reason"), "topic": c("topic")},
    )


def low_signal(analysed: DataFrame) -> DataFrame:
    """F8: records kept out of the brief, with reason and link."""
    return analysed.filter(F.col("reason").isNotNull()).select("id", "reason", "title", "url")


def fold_target(markets_seen: dict[str, Column], market: Column) -> Column:
    """An observation joins the one specific market with the same key, if exactly one has it."""
    seen = sum((flag.cast("int") for flag in markets_seen.values()), F.lit(0))
    single = F.lit(None).cast("string")
    for name, flag in markets_seen.items():
        single = F.when(flag, F.lit(name)).otherwise(single)
    return F.when((market == OBSERVATION) & (seen == 1), single).otherwise(market)


def market_fold(analysed: DataFrame) -> DataFrame:
    """The event keys that move, with their target market.

    Keys are made distinct first; what is gathered per topic is one flag per market.
    """
    c = F.col
    keys = analysed.filter(c("reason").isNull()).groupBy("day", "topic").agg(
        F.max(c("event_market") == OBSERVATION).alias("observed"),
        *[F.max(c("event_market") == name).alias(name) for name in SPECIFIC_MARKETS],
    )
    target = fold_target({name: c(f"`{name}`") for name in SPECIFIC_MARKETS}, F.lit(OBSERVATION))
    return (
        keys.filter("observed")
        .select("day", "topic", F.lit(OBSERVATION).alias("from_market"), target.alias("to_market"))
        .filter(c("to_market") != OBSERVATION)
    )


def _partial_aggregates(pack: RulePack, place: Column) -> list[Column]:
    """Aggregates of an event that merge: counts, firsts by place, and the primary record."""
    c = F.col
    order = F.struct(c("primary_rank").alias("rank"), place.alias("place"))
    image = F.when(X.text_or_empty(c("image_url")) != "", c("image_url"))
    video = F.when(X.text_or_empty(c("video_url")) != "", c("video_url"))
    out = [
        F.min_by(F.struct(*PRIMARY_FIELDS), order).alias("primary"),
        F.min(order).alias("primary_order"),
        F.count(F.lit(1)).alias("size"),
        F.min(place).alias("first_place"),
        *_first("image", image, place),
        *_first("video", video, place),
    ]
    if pack.templates:
        out += [
            *_first("entries", X.first_match(c("raw_summary"), _ENTRIES), place),
            F.max(c("raw_summary").rlike(_STREAMED)).alias("streamed"),
            # A word may begin in the headline and end in the summary that follows it.
            F.max(F.concat("raw_title", "raw_summary").contains(_SONG_WORDS[0])).alias("has_mv"),
            F.max(F.concat("raw_title", "raw_summary").contains(_SONG_WORDS[1])).alias("has_lyrics"),
        ]
    return out


def _first(name: str, value: Column, place: Column) -> list[Column]:
    return [first_by(value, place).alias(name), F.min(F.when(value.isNotNull(), place)).alias(f"{name}_at")]


def group_events(analysed: DataFrame, pack: RulePack) -> DataFrame:
    """One row per event.

    The first grouping combines on the map side and leaves one row per key and market; folding an
    observation group into its market then only touches those rows, never the records.
    """
    c = F.col
    kept = analysed.filter(c("reason").isNull())
    place = F.struct(F.lit(0).alias("folded"), c("position").alias("position"))
    groups = kept.groupBy(*EVENT_KEY).agg(*_partial_aggregates(pack, place))
    # At most one row per market and topic reaches this window.
    topic = Window.partitionBy("day", "topic")
    flags = {name: F.max(c("event_market") == name).over(topic) for name in SPECIFIC_MARKETS}
    folded = groups.withColumn("target", fold_target(flags, c("event_market")))
    moved = c("target") != c("event_market")

    def later(place_column: str) -> Column:
        shifted = F.struct(F.when(moved, 1).otherwise(0).alias("folded"), c(f"{place_column}.position").alias("position"))
        return F.when(c(place_column).isNotNull(), shifted)

    firsts = ["image", "video"] + (["entries"] if pack.templates else [])
    flags_or = ["streamed", "has_mv", "has_lyrics"] if pack.templates else []
    shifted_order = F.struct(c("primary_order.rank").alias("rank"), later("primary_order.place").alias("place"))
    folded = folded.withColumn("_order", shifted_order)
    merged = folded.groupBy("day", "topic", c("target").alias("event_market")).agg(
        F.min_by("primary", "_order").alias("primary"),
        F.min("_order").alias("primary_order"),
        F.sum("size").alias("group_size"),
        F.min(F.when(~moved, c("first_place.position"))).alias("event_position"),
        *[F.min_by(name, F.when(c(name).isNotNull(), later(f"{name}_at"))).alias(name) for name in firsts],
        *[F.max(name).alias(name) for name in flags_or],
    )
    own_market = F.when(c("event_market") != OBSERVATION, c("event_market")).otherwise(c("primary.market"))
    own_key = F.concat_ws(":", c("day"), c("primary.event_market"), c("topic"))
    fields = [name for name in PRIMARY_FIELDS if name not in ("market", "image_url", "video_url", "event_market")]
    return merged.select(
        "day", "topic", "event_market",
        *[c(f"primary.{name}").alias(name) for name in fields],
        own_market.alias("market"),
        own_key.alias("event_key"),
        "group_size",
        "event_position",
        "primary_order",
        F.coalesce(X.blank_to_null(c("primary.image_url")), c("image"), F.lit("")).alias("image_url"),
        F.coalesce(X.blank_to_null(c("primary.video_url")), c("video"), F.lit("")).alias("video_url"),
        *[c(name) for name in firsts[2:] + flags_or],
    )


def _second_fact(analysed: DataFrame, events: DataFrame, pack: RulePack) -> DataFrame:
    """the first differing fact of another record of the event, in primary order.

    Records of one event share their kind, except under the award-list key; so only records with
    that key are candidates. Equal facts are merged before they meet the primary's fact.
    """
    c = F.col
    special = c("topic").startswith(pack.award_series_name + ":") & c("topic").endswith(":nominees")
    records = analysed.filter(c("reason").isNull() & special)
    facts = (
        E.with_core_sentence(records, pack)
        .filter(c("core_sentence").rlike(pack.fact_words))
        .groupBy("day", "topic", "event_market", "kind", "core_sentence")
        .agg(F.min(F.struct("primary_rank", "position")).alias("fact_order"))
    )
    primaries = events.filter(special).select(
        *EVENT_KEY, c("kind").alias("primary_kind"), c("core_sentence").alias("primary_fact")
    )
    differs = E.overlap_below(X.normalized(c("core_sentence")), X.normalized(c("primary_fact")), 0.45)
    return (
        facts.join(primaries, EVENT_KEY)
        .filter((c("kind") != c("primary_kind")) & (c("core_sentence") != ""))
        .withColumn("differs", differs)
        .filter("differs")
        .groupBy(*EVENT_KEY)
        .agg(F.min_by("core_sentence", "fact_order").alias("second_fact"))
    )


def _run_end_phrases(analysed: DataFrame) -> DataFrame:
    """``gross`` and ``run_work`` of each run-end event, from the joined summaries of its records.

    Neither a streaming note nor an entry count holds a blank, so these never reach across records and stay flags
    and firsts of the aggregate.
    """
    c = F.col
    fold = market_fold(analysed).select("day", "topic", c("from_market").alias("event_market"), "to_market")
    records = analysed.filter(c("reason").isNull() & (c("kind") == "run_end")).join(fold, EVENT_KEY, "left").select(
        "day", "topic", F.coalesce("to_market", "event_market").alias("event_market"),
        F.struct(c("to_market").isNotNull().alias("folded"), c("position").alias("position")).alias("place"),
        c("raw_summary").alias("text"))
    records = written(records, "run-end-records")
    position = c("place.position")
    minute = F.floor(position["recency"] / F.lit(60_000_000))
    chunk = F.struct(c("place.folded"), position["market"], position["channel"], position["priority"], minute.alias("minute"))
    gross = phrases.first_match(records, EVENT_KEY, chunk, _GROSS, _GROSS_REACH).withColumnRenamed("match", "gross")
    work = phrases.first_quoted(records, EVENT_KEY).withColumnRenamed("match", "run_work")
    return gross.join(work, EVENT_KEY, "full")


def with_facts(events: DataFrame, analysed: DataFrame, pack: RulePack) -> DataFrame:
    """Headline, key points and summary of each event, extracted from its records."""
    c = F.col
    lined = E.with_core_sentence(events, pack)
    joined = lined.join(_second_fact(analysed, lined, pack), EVENT_KEY, "left")
    if pack.templates:
        joined = joined.join(_run_end_phrases(analysed), EVENT_KEY, "left")
    fact, group = c("core_sentence"), c("group_size") > 1
    work_title = c("kind").isin("award", "trailer", "poster", "music_asset") & fact.startswith("《") & (F.length(fact) <= 68)
    title = F.when(work_title, fact).otherwise(c("headline"))
    own = F.array_compact(F.array(fact, c("second_fact")))
    if pack.templates:
        run_end = c("kind") == "run_end"
        details = F.array_compact(F.array(F.when(c("streamed"), F.lit(_STREAMED_FACT)), c("gross")))
        run_facts = F.when(F.size(details) > 0, F.array(F.array_join(details, "，"))).otherwise(F.array().cast("array<string>"))
        award_list = (c("kind") == "award") & title.contains(pack.award_series) & group
        list_fact = F.concat(F.lit(_AWARD_LIST_FACT), c("entries"))
        music = (c("kind") == "music_asset") & group
        facts = (
            F.when(run_end, run_facts)
            .when(award_list, F.array(F.coalesce(list_fact, fact)))
            .when(music & c("has_mv") & c("has_lyrics"), F.array(F.lit(_SONG_FACT)))
            .when(music, F.array(fact))
            .otherwise(own)
        )
        title = F.when(run_end & c("run_work").isNotNull(), F.concat(F.lit(_RUN_END_TITLE[0]), c("run_work"), F.lit(_RUN_END_TITLE[1]))).otherwise(title)
    else:
        facts = own
    staged = joined.withColumns({"event_title": title, "facts": facts})
    plain_title = X.normalized(c("event_title"))

    def keep(index: int) -> Column:
        line = F.get(c("facts"), F.lit(index))
        return F.when(E.overlap_below(X.normalized(line), plain_title, 0.78), line)

    points = F.array_compact(F.array(keep(0), keep(1)))
    return (
        staged.withColumn("key_points", points)
        .withColumn("event_summary", F.substring(F.array_join("key_points", "；"), 1, 190))
        .drop("facts", "second_fact", "core_sentence")
    )


def relevance(events: DataFrame, pack: RulePack) -> DataFrame:
    """O3: the order of events, from the headline and summary a reader sees."""
    c = F.col
    summary = c("event_summary") if "event_summary" in events.columns else c("summary_c")
    title = c("event_title") if "event_title" in events.columns else c("headline")
    seen = F.when(c("original_c") != "", c("original_c")).otherwise(title)
    staged = computed_once(events, {"relevance_kind": E.event_kind(seen, summary, pack)})
    social_filing = F.when((c("relevance_kind") == "filing") & c("from_social"), 2).otherwise(0)
    return staged.withColumn(
        "relevance",
        F.struct(
            (ranked(c("relevance_kind"), EVENT_RANK, 5) + social_filing).alias("kind"),
            c("evidence_rank").alias("evidence"),
            F.when(c("image_url") != "", 0).otherwise(1).alias("image"),
            (-F.unix_micros("published_ts")).alias("recency"),
            c("event_position").alias("position"),
        ),
    )


def choose_events(events: DataFrame, budgets: dict[str, int]) -> DataFrame:
    """Label each event ``selected`` or not.

    The best events of a market fill its budget. If six or more places hold no series, the last one
    goes to the best series left. A market outside the map is unlimited.

    Only slim rows (market, order, series flag, id) are ranked: thinned within salted parts of each market, then ranked
    among those leaders. What comes out is at most one id per place of the budgets; the events themselves are
    not shuffled, and those that are not chosen never carry a rank.
    """
    c = F.col
    table = written(events, "events")
    limit = limit_of(c("market"), budgets)
    selected = F.coalesce(c("_chosen"), F.lit(False))
    if not budgets:
        return table.withColumn("selected", F.lit(True))
    most = max(0, *budgets.values())
    slim = table.filter(limit.isNotNull()).select(
        "market", "id", "relevance", F.coalesce(c("distribution") == "series", F.lit(False)).alias("is_series"),
        F.pmod(F.xxhash64("id"), F.lit(SALTS)).alias("salt"))

    def leaders(rows: DataFrame, keep: int) -> DataFrame:
        order = [c("relevance"), c("id")]
        for keys in (["market", "salt"], ["market"]):
            place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
            rows = rows.withColumn("place", place).filter(c("place") <= keep)
        return rows

    best = leaders(slim, most).filter(c("place") <= limit)
    shown = best.groupBy("market").agg(F.max("is_series").alias("series_shown"))
    series = leaders(slim.filter("is_series"), 1).select("market", c("id").alias("series_id"))
    # A handful of rows from here on: one per place, one per market.
    rescue = series.join(shown, "market").filter((limit >= 6) & ~c("series_shown")).select("market", "series_id")
    kept = best.join(F.broadcast(rescue), "market", "left").filter(c("series_id").isNull() | (c("place") < limit))
    chosen = kept.select("id").unionByName(rescue.select(c("series_id").alias("id"))).withColumn("_chosen", F.lit(True))
    return table.join(F.broadcast(chosen), "id", "left").select(
        *[table[name] for name in table.columns], F.when(limit.isNull(), True).otherwise(selected).alias("selected"))


def brief_stats(analysed: DataFrame, chosen: DataFrame) -> DataFrame:
    """Counters of the brief as metric rows.

    ``chosen`` are all events with their label. Channels, market items and translation states are counted anew over
    the events of the brief, with zero rows for absent channels and markets.
    """
    c = F.col
    records = analysed.agg(
        F.count(F.lit(1)).alias("source_items"), F.count_if(c("reason").isNotNull()).alias("filtered_low_signal")
    )
    shown = c("selected")

    def shown_as(name: str, value: str) -> Column:
        return F.count_if(shown & F.coalesce(c(name) == value, F.lit(False)))

    groups = chosen.agg(
        F.count(F.lit(1)).alias("available_events"),
        F.count_if(shown).alias("brief_events"),
        F.count_if(~shown).alias("more_events"),
        F.coalesce(F.sum(c("group_size") - 1), F.lit(0)).alias("merged_source_items"),
        F.count_if(shown).alias("items"),
        *[shown_as("distribution", name).alias(f"distribution_{name}") for name in DISTRIBUTION_RANK],
        *[shown_as("market", name).alias(f"market_{name}") for name in MARKETS],
        shown_as("translation_status", "machine_translated").alias("translated_home_items"),
        shown_as("translation_status", "original_english").alias("original_english_home_items"),
    )
    return metric_rows(records, {n: c(n) for n in records.columns}).unionByName(
        metric_rows(groups, {n: c(f"`{n}`") for n in groups.columns})
    )


def event_members(analysed: DataFrame) -> DataFrame:
    """Every record with the event that holds it (``source_items`` as rows)."""
    c = F.col
    fold = market_fold(analysed).select("day", "topic", c("from_market").alias("event_market"), "to_market")
    kept = analysed.filter(c("reason").isNull()).select("dedup_key", "id", "title", "url", "headline", *EVENT_KEY)
    return kept.join(fold, EVENT_KEY, "left").select(
        "dedup_key", "id", "title", "url", "headline", "day", "topic",
        F.coalesce("to_market", "event_market").alias("event_market"),
    )


def event_sources(members: DataFrame, sources: DataFrame) -> DataFrame:
    """The source links of every event, one row per link."""
    c = F.col
    linked = members.select("dedup_key", "headline", *EVENT_KEY).join(
        sources.select("dedup_key", c("url").alias("source_url"), "publisher_id", "source_id", "source_name", "source_class", "first_seq"),
        "dedup_key",
    )
    return linked.groupBy(*EVENT_KEY, "source_url").agg(
        F.max_by(F.struct("publisher_id", "source_id", "source_name", "source_class", "headline"), F.col("first_seq")).alias("s")
    ).select(*EVENT_KEY, "source_url", "s.*")


def trace_pool(chosen: DataFrame, analysed: DataFrame) -> DataFrame:
    """U4: everything the page does not show as a card, each with a link and a reason label."""
    c = F.col
    more = chosen.filter(~c("selected")).select(
        "id", c("headline").alias("title"), "url", F.lit("more").alias("reason"), F.lit(TRACE_MORE).alias("label")
    )
    filtered = low_signal(analysed).select("id", "title", "url", "reason", mapped(c("reason"), TRACE_LABELS, TRACE_OTHER).alias("label"))
    return more.unionByName(filtered)
