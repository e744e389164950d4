"""Rules of the same shape for Latin-script tables.

The patterns stay within the syntax that Java and RE2 share (``(?iu)`` there is ``(?i)``), so that a SQL
check can use them.
"""

from pressloom.rules.pack import RulePack, SignalRule

LATIN = RulePack(
    name="latin",
    network=r"thbl|ciónr",
    film_title=r"edble|ment",
    theatrical=r"onwh|lich",
    series_entry_types=("series",),
    series=r"erint|keit",
    premiere=r"hane",
    film=r"tion",
    film_entry_type="film",
    market_titles=(("m-cn", "heit"), ("m-hmt", "elle"), ("m-intl", "ntion")),
    dateline=r"the[^\n]*and",
    dateline_market="m-intl",
    award_market_title=r"onin|eau",
    title_only_keywords=("thnd",),
    long_form_words=("tion", "ment"),
    social_ids=("src3", "src8"),
    media_title_words=("er", "le"),
    event_kinds=(
        ("filing", r"(?iu)thnd|nung"),
        ("run_end", r"(?iu)herhea"),
        ("award", r"(?iu)thor|ción"),
        ("box_office", r"(?iu)nble|lich"),
        ("release_date", r"(?iu)reat|keit"),
        ("music_asset", r"(?iu)ernt|elle"),
        ("trailer", r"(?iu)onha|entio"),
        ("poster", r"(?iu)ones|heit"),
        ("renewal", r"(?iu)erth"),
        ("production", r"(?iu)enbe|nque"),
        ("casting", r"(?iu)hing|ment"),
        ("rights", r"(?iu)onti"),
        ("review", r"(?iu)anea"),
        ("campaign", r"(?iu)thes"),
    ),
    fact_words=r"(?iu)tion|that|eau|ung",
    event_facts={
        "filing": r"(?iu)thnd", "run_end": r"(?iu)herhea", "award": r"(?iu)thor|ción",
        "box_office": r"(?iu)nble", "release_date": r"(?iu)reat", "music_asset": r"(?iu)ernt",
        "trailer": r"(?iu)onha", "poster": r"(?iu)ones", "renewal": r"(?iu)erth",
        "production": r"(?iu)enbe", "casting": r"(?iu)hing|ment", "rights": r"(?iu)onti",
    },
    work=r"([A-ZÀ-Þ][a-zß-ÿ]{4,20})",
    quoted_work=r"“([^”]{3,65})”",
    amount=r"(?iu)[a-z]+nble",
    advance=r"(?iu)than|ich",
    date=r"(?iu)[a-z]+reat",
    song=r"([a-z]{3,35}) the",
    material=r"and ([a-z]{2,35})",
    general_award=r"this",
    award_series=r"thor",
    award_series_name="thor",
    award_list=r"thor|the",
    award_edition=r"[a-z]+thor",
    award_edition_default="now",
    person_title=r"eriner",
    person_name="eriner",
    signals=(
        SignalRule("advance_teaser", title=r"erin", summary=r"hane|ich", not_summary=r"worthless", social_only=True),
        SignalRule("background_roundup", title=r"(?iu)thea.{0,60}thhe"),
        SignalRule("outside_film_tv", title=r"(?iu)anth.{0,25}tion"),
        SignalRule("promotion", title=r"enie|iónr"),
        SignalRule("insufficient_detail", title=r"hain|chli", not_title=r"[A-ZÀ-Þ][a-zß-ÿ]{8,20}"),
        SignalRule("insufficient_detail", short_other=True),
        SignalRule("anniversary", title=r"iner|ción", not_summary=r"that", social_only=True),
        SignalRule("advance_teaser", title=r"ttio|eux", social_only=True),
        SignalRule("promotion", title=r"rine|die", social_only=True),
    ),
    short_facts=(r"20[0-9]{2}", r"der|que"),
    lead_words=r"^(?:The|Der|Les)\s*",
    sentence_break=r"[.!?;]",
    clause_break=r"[,]",
    number_cue=r"[0-9]|eau|ich",
    fiction_cue=r"hing|elle",
    project=r"([A-Z][a-z]{5,23})",
    default_tags=("news",),
    closing_tag="film",
)
