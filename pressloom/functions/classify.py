"""Record classification (F1, F2, E7-E11) as expressions over a rule pack."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressloom.functions import text as X
from pressloom.functions.times import civil_day, iso_day
from pressloom.policy import Policy
from pressloom.rules.pack import DISTRIBUTION_RANK, SOURCE_RANK, RulePack


def ranked(value: Column, ranks: dict[str, int], default: int) -> Column:
    """Position of a label in a fixed ranking."""
    out = F.when(F.lit(False), F.lit(default))
    for label, rank in ranks.items():
        out = out.when(value == label, F.lit(rank))
    return out.otherwise(F.lit(default))


def distribution_rank(value: Column) -> Column:
    return ranked(value, DISTRIBUTION_RANK, 5)


def source_rank(value: Column) -> Column:
    return ranked(value, SOURCE_RANK, 5)


def is_excluded(entry_type: Column, heading: Column, whole: Column, policy: Policy, pack: RulePack) -> Column:
    """Policy exclusion on folded text; some keywords count in the headline only."""
    out = F.coalesce(entry_type.isin(list(policy.excluded_entry_types)), F.lit(False))
    title_only = {X.fold_keyword(word) for word in pack.title_only_keywords}
    long_form = X.contains_any(heading, pack.long_form_words)
    for keyword in map(X.fold_keyword, policy.excluded_keywords):
        hit = heading.contains(keyword) & ~long_form if keyword in title_only else whole.contains(keyword)
        out = out | hit
    return out


def keyword_pattern(keywords: Column) -> Column:
    """One literal-alternation pattern of a keyword list; null for an empty list."""
    folded = F.transform(keywords, lambda word: F.concat(F.lit("\\Q"), X.search_text(word), F.lit("\\E")))
    return F.when(F.size(keywords) > 0, F.array_join(folded, "|"))


def passes_source_filter(scoped: Column, include_pattern: Column, exclude_pattern: Column) -> Column:
    included = F.coalesce(F.rlike(scoped, include_pattern), F.lit(True))
    excluded = F.coalesce(F.rlike(scoped, exclude_pattern), F.lit(False))
    return included & ~excluded


def item_market(infer: Column, source_market: Column, heading: Column, lead: Column, pack: RulePack) -> Column:
    """Market of the story where the source asks for inference, else of the source."""
    out = F.when(~F.coalesce(infer, F.lit(False)), source_market)
    for market, pattern in pack.market_titles:
        out = out.when(heading.rlike(pattern), F.lit(market))
    return out.when(lead.rlike(pack.dateline), F.lit(pack.dateline_market)).otherwise(source_market)


def classify_distribution(configured: Column, title: Column, folded: Column, entry_type: Column, pack: RulePack) -> Column:
    """Release channel, only where the text gives a clear signal."""
    theatrical = folded.rlike(pack.theatrical)
    film = folded.rlike(pack.film)
    return (
        F.when(X.text_or_empty(configured) != "", configured)
        .when(folded.rlike(pack.network), F.lit("network"))
        .when(title.rlike(pack.film_title), F.when(theatrical, F.lit("cinema")).otherwise(F.lit("film_unspecified")))
        .when(entry_type.isin(list(pack.series_entry_types)) | folded.rlike(pack.series), F.lit("series"))
        .when(folded.rlike(pack.premiere) & film, F.lit("network"))
        .when(theatrical, F.lit("cinema"))
        .when(entry_type.contains(pack.film_entry_type) | film, F.lit("film_unspecified"))
        .otherwise(F.lit("other"))
    )


def confidence(source_class: Column) -> Column:
    return (
        F.when(source_class == "industry_blog", F.lit("industry_commentary"))
        .when(source_class == "social", F.lit("social_lead"))
        .when(source_class == "official", F.lit("official"))
        .otherwise(F.lit("single_source"))
    )


def record_id(source_id: Column, url: Column) -> Column:
    return F.substring(F.sha2(F.concat(source_id, url), 256), 1, 16)


def dedup_key(title: Column, summary: Column, url: Column, source_id: Column,
              confidence_label: Column, stamp: Column, pack: RulePack) -> Column:
    """Key of one story: a social post by URL, a ticketing caption by content, else headline and day."""
    day = iso_day(civil_day(stamp))
    caption = F.regexp_replace(summary, r"(?U)[\s\x1c-\x1f​‌‍]+", "")
    by_caption = F.concat(F.lit("ticketing:"), F.sha2(caption, 256), day)
    return (
        F.when(
            (confidence_label == "social_lead") & source_id.isin(list(pack.social_ids)) & (caption != ""),
            by_caption,
        )
        .when(confidence_label == "social_lead", url)
        .otherwise(F.concat(X.title_key(title), day))
    )
