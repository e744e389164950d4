"""The shape of a rule pack.

Every pattern is a Java regular expression. ``(?iU)`` stands for "ignore case, Unicode
classes and boundaries". The Chinese pack holds the production rules; the Latin pack has the
same shape for Latin-script tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Display order of release channels.
DISTRIBUTION_RANK = {
    "cinema": 0, "cinema_filing": 1, "film_unspecified": 2, "network": 3, "series": 4, "other": 5,
}
# Evidence order of source classes; anything else ranks 5.
SOURCE_RANK = {"official": 0, "trade_media": 1, "established_media": 1, "social": 3, "industry_blog": 4}
# Order of event kinds on the page.
EVENT_RANK = {
    "release_date": 0, "box_office": 1, "award": 1, "production": 2, "trailer": 2, "music_asset": 2,
    "renewal": 2, "rights": 2, "run_end": 2, "filing": 3, "casting": 3, "poster": 3,
    "campaign": 4, "review": 4, "other": 5,
}
# Events shown per market.
EVENT_BUDGET = {"m-cn": 18, "m-hmt": 8, "m-intl": 22, "m-obs": 5}
# Order of evidence classes in a content pack; anything else ranks 3.
PACK_RANK = {"official": 0, "multi_source": 1, "single_source": 2}
SPECIFIC_MARKETS = ("m-cn", "m-hmt", "m-intl")
MARKETS = ("m-cn", "m-hmt", "m-intl", "m-obs")
OBSERVATION = "m-obs"


@dataclass(frozen=True)
class SignalRule:
    """A low-signal rule: all conditions that are set must hold."""

    reason: str
    title: str | None = None
    summary: str | None = None
    not_title: str | None = None
    not_summary: str | None = None
    social_only: bool = False
    short_other: bool = False


@dataclass(frozen=True)
class RulePack:
    name: str
    # distribution
    network: str
    film_title: str
    theatrical: str
    series_entry_types: tuple[str, ...]
    series: str
    premiere: str
    film: str
    film_entry_type: str
    # market
    market_titles: tuple[tuple[str, str], ...]
    dateline: str
    dateline_market: str
    award_market_title: str
    # exclusion
    title_only_keywords: tuple[str, ...]
    long_form_words: tuple[str, ...]
    # de-duplication
    social_ids: tuple[str, ...]
    media_title_words: tuple[str, ...]
    # events
    event_kinds: tuple[tuple[str, str], ...]
    fact_words: str
    event_facts: dict[str, str]
    work: str
    quoted_work: str
    amount: str
    advance: str
    date: str
    song: str
    material: str
    general_award: str
    award_series: str
    award_series_name: str
    award_list: str
    award_edition: str
    award_edition_default: str
    person_title: str
    person_name: str
    # low signal, in order
    signals: tuple[SignalRule, ...]
    short_facts: tuple[str, str]
    # headline and sentence choice
    lead_words: str
    sentence_break: str
    clause_break: str
    number_cue: str
    fiction_cue: str
    # content pack
    project: str
    templates: bool = False
    default_tags: tuple[str, ...] = field(default=())
    closing_tag: str = ""
