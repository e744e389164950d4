"""Event expressions (F8, E13-E20): kind, work, milestone, key, headline, core sentence.

``title`` and ``summary`` arguments are already compacted (see ``text.compact``) unless a
function says otherwise.
"""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import BooleanType

from pressloom.functions import text as X
from pressloom.operators.scale import computed_once
from pressloom.rules.pack import OBSERVATION, RulePack

def _no_text() -> Column:
    return F.lit(None).cast("string")


def event_kind(title: Column, summary: Column, pack: RulePack) -> Column:
    """First matching rule on the headline, then on the first 180 characters of the summary."""
    lead = F.substring(summary, 1, 180)
    out = F.when(F.lit(False), _no_text())
    for text in (title, lead):
        for kind, pattern in pack.event_kinds:
            out = out.when(text.rlike(pattern), F.lit(kind))
    return out.otherwise(F.lit("other"))


def work_name(title: Column, original_title: Column, summary: Column, pack: RulePack) -> Column:
    """Normalised name of the work a record is about, or ''."""
    quoted = X.first_match(original_title, pack.quoted_work, 1)
    short_quote = F.when(F.size(F.split(F.trim(quoted), " +")) <= 8, quoted)
    named = F.coalesce(
        X.first_match(title, pack.work, 1),
        X.first_match(original_title, pack.work, 1),
        X.first_match(F.substring(summary, 1, 170), pack.work, 1),
        short_quote,
        F.lit(""),
    )
    return X.normalized(named)


def milestone(kind: Column, title: Column, text: Column, pack: RulePack) -> Column:
    """What sets two updates on one work apart; ``text`` is headline plus 140 summary characters."""
    amount = F.coalesce(X.first_match(text, pack.amount), title)
    scope = F.when(text.rlike(pack.advance), F.lit("advance:")).otherwise(F.lit("total:"))
    part = F.lit("")
    return (
        F.when(kind == "box_office", F.concat(scope, X.normalized(amount)))
        .when(kind == "release_date", X.normalized(F.coalesce(X.first_match(text, pack.date), part)))
        .when(kind == "music_asset", X.normalized(F.coalesce(X.first_match(text, pack.song, 1), part)))
        .when(kind.isin("trailer", "poster"), X.normalized(F.coalesce(X.first_match(title, pack.material, 1), part)))
        .otherwise(part)
    )


def editorial_market(market: Column, title: Column, pack: RulePack) -> Column:
    """An observation that is unmistakably a mainland award belongs to the mainland market."""
    return F.when((market == OBSERVATION) & title.rlike(pack.award_market_title), F.lit("m-cn")).otherwise(market)


def event_topic(kind: Column, market: Column, title: Column, edition_text: Column, work: Column,
                milestone_text: Column, pack: RulePack) -> Column:
    """The part of the event key after day and market."""
    edition = F.coalesce(X.first_match(edition_text, pack.award_edition), F.lit(pack.award_edition_default))
    award_list = (market == "m-cn") & title.contains(pack.award_series) & title.rlike(pack.award_list)
    return (
        F.when(award_list, F.concat(F.lit(pack.award_series_name + ":"), edition, F.lit(":nominees")))
        .when((kind == "box_office") & title.contains(pack.person_title),
              F.concat(F.lit(pack.person_name + ":box_office:"), milestone_text))
        .when((work != "") & (kind != "other"), F.concat_ws(":", work, kind, milestone_text))
        .otherwise(F.concat(kind, F.lit(":headline:"), X.normalized(title)))
    )


def low_signal_reason(title: Column, summary: Column, kind: Column, from_social: Column, pack: RulePack) -> Column:
    """Ordered reasons to keep a record out of the brief; null when it stays."""
    title_fact, summary_fact = pack.short_facts
    specific = title.rlike(title_fact) | summary.rlike(summary_fact)
    out = F.when(F.lit(False), _no_text())
    for rule in pack.signals:
        hit = F.lit(True)
        if rule.title:
            hit = hit & title.rlike(rule.title)
        if rule.not_title:
            hit = hit & ~title.rlike(rule.not_title)
        if rule.summary:
            hit = hit & summary.rlike(rule.summary)
        if rule.not_summary:
            hit = hit & ~summary.rlike(rule.not_summary)
        if rule.social_only:
            hit = hit & from_social
        if rule.short_other:
            hit = (F.length(summary) < 25) & (kind == "other") & ~title.rlike(pack.fact_words) & ~specific
        out = out.when(hit, F.lit(rule.reason))
    return out


# Wording of the awards headline.
_AWARD_HEADLINE = r"(?U)第\d+届[^，。]{2,20}金鹰奖"


def short_headline(title: Column, visible: Column, pack: RulePack) -> Column:
    """Headline without lead words, at most 72 characters; ``visible`` is the visible copy of the title."""
    full = F.when(visible != "", visible).otherwise(title)
    bare = X.recompact(F.regexp_replace(full, pack.lead_words, ""))
    cut = F.concat(X.trim_right(F.substring(bare, 1, 72), "，。、：: -"), F.lit("…"))
    short = F.when(F.length(bare) > 72, cut).otherwise(bare)
    if not pack.templates:
        return short
    award = X.first_match(full, _AWARD_HEADLINE)
    long_award = (F.length(full) > 100) & full.contains("金鹰奖") & full.contains("颁奖典礼") & award.isNotNull()
    return F.when(long_award, F.concat(award, F.lit("获奖结果公布"))).otherwise(short)


# Agency lead-ins that open a summary.
_AGENCY_LEADS = [
    r"(?U)^(?:中新网|人民网|新京报讯)[^。]{0,35}?(?:电|讯)\s*(?:[（(][^）)]{1,18}[）)])?",
    r"(?U)^[（(]中央社記者[^）)]{2,45}[）)]\s*",
]


def news_copy(visible_summary: Column, pack: RulePack) -> Column:
    """Visible summary without the agency lead-in."""
    out = visible_summary
    for pattern in _AGENCY_LEADS if pack.templates else []:
        out = F.regexp_replace(out, pattern, "")
    return out


def sentences(copy: Column, pack: RulePack) -> Column:
    return F.filter(F.transform(F.split(copy, pack.sentence_break), X.recompact), lambda part: part != "")


def _event_cue(kind: Column, part: Column, pack: RulePack) -> Column:
    cue = F.when(F.lit(False), F.lit(False))
    for name, pattern in pack.event_facts.items():
        cue = cue.when(kind == name, part.rlike(pattern))
    return cue.otherwise(F.lit(False))


def _points(kind: Column, part: Column, pack: RulePack) -> Column:
    def gain(condition: Column, points: int) -> Column:
        return F.when(condition, F.lit(points)).otherwise(F.lit(0))

    return (
        gain(_event_cue(kind, part, pack), 6)
        + gain(part.rlike(pack.fact_words), 3)
        + gain(part.rlike(pack.number_cue), 2)
        + gain(part.rlike(pack.fiction_cue), -5)
    )


def _best(parts: Column, kind: Column, pack: RulePack) -> Column:
    """Highest score, then shortest, then first."""
    scored = F.transform(
        parts,
        lambda part, pos: F.struct(
            _points(kind, part, pack).alias("points"), (-F.length(part)).alias("short"),
            (-pos).alias("early"), part.alias("text"),
        ),
    )
    return F.array_max(scored)["text"]


# Templates of the factual line, in order.
_HK_RELEASE = r"《([^》]+)》將於([^，,。]{2,25})上映"
_WINNER = r"([一-鿿]{2,4})凭借《([^》]+)》获(最佳(?:男|女)主角)"
_WORK = r"《([^》]+)》"
_MATERIAL = r"(?iU)[“「]([^”」]{2,35})[”」]\s*(特别视频|预告片?|先导片|海报|剧照|MV)"
_RELEASED = r"(?iU)(?:发布|释出|曝出?|推出)([^，。]{0,28}?(?:特别视频|预告片?|先导片|海报|剧照|MV))"
_COMPANY = r"备案单位[^。；，,]{3,60}"
_PLAYS = r"(?U)(?:正片|全网)?播放量\s*\d+(?:\.\d+)?\s*[亿万]"
_HONOR = r"[“「]([^”」]{3,45}(?:荣誉|奖|表扬|提名))(?=[”」])"
_DIRECTOR = r"导演([一-鿿]{2,4})凭借(?:动画)?电影《([^》]+)》(?:斩获|获得)([^。！!]{3,65})"
_SUBMISSIONS = r"(?U)收到\d+部影片报名[^。]{0,20}?覆盖\d+个国家和地区"


# Wording of the factual line of a template, in order of use.
_HK_SAYS = ("《", "》將於", "上映")
_WINNER_SAYS = ("凭《", "》获")
_GOLDEN_EAGLE = "金鹰奖"
_TRAILERS = (("先导片", "，并发布先导片"), ("预告片?", "，并发布预告"))
_MATERIAL_SAYS = ("发布“", "”")
_RELEASED_SAYS = "发布"
_CHAMPION = "播放量冠军"
_HONOR_SAYS = ("获“", "”")
_DIRECTOR_SAYS = ("《", "》导演", "获得")
_CALL = "征片"
_SHORT_SUBJECT = r"^(?:影片|电影|该剧)"


def _template_line(row: dict[str, Column], pack: RulePack) -> Column:
    """The factual line of a fixed template, or null where the scored sentence decides."""
    kind, headline, copy = row["kind"], row["headline"], row["copy"]
    work = X.first_match(headline, _WORK, 1)
    named = F.concat(F.lit("《"), work, F.lit("》"))
    prize_text = F.concat(row["raw_title"], F.lit("。"), row["raw_summary"])
    winners = F.array_distinct(
        F.transform(
            F.regexp_extract_all(prize_text, F.lit(_WINNER), F.lit(0)),
            lambda hit: F.concat(
                F.regexp_extract(hit, _WINNER, 1), F.lit(_WINNER_SAYS[0]), F.regexp_extract(hit, _WINNER, 2),
                F.lit(_WINNER_SAYS[1]), F.regexp_extract(hit, _WINNER, 3),
            ),
        )
    )
    with_trailer = (
        F.when(headline.rlike(_TRAILERS[0][0]), F.lit(_TRAILERS[0][1]))
        .when(headline.rlike(_TRAILERS[1][0]), F.lit(_TRAILERS[1][1]))
        .otherwise(F.lit(""))
    )
    asset = work.isNotNull() & kind.isin("trailer", "poster", "music_asset")
    return (
        F.when(row["from_blog"] & copy.rlike(_HK_RELEASE),
               F.concat(F.lit(_HK_SAYS[0]), F.regexp_extract(copy, _HK_RELEASE, 1), F.lit(_HK_SAYS[1]),
                        F.regexp_extract(copy, _HK_RELEASE, 2), F.lit(_HK_SAYS[2])))
        .when(row["from_blog"], headline)
        .when((kind == "award") & headline.contains(_GOLDEN_EAGLE) & (F.size(winners) > 0),
              F.array_join(F.slice(winners, 1, 2), "，"))
        .when(asset & headline.rlike(_MATERIAL),
              F.concat(named, F.lit(_MATERIAL_SAYS[0]), F.regexp_extract(headline, _MATERIAL, 1), F.lit(_MATERIAL_SAYS[1]),
                       F.regexp_extract(headline, _MATERIAL, 2)))
        .when(asset & headline.rlike(_RELEASED),
              F.concat(named, F.lit(_RELEASED_SAYS), F.trim(F.regexp_extract(headline, _RELEASED, 1))))
        .when((kind == "filing") & row["from_social"],
              F.concat(headline, F.coalesce(F.concat(F.lit("，"), X.first_match(copy, _COMPANY)), F.lit(""))))
        .when((kind == "box_office") & row["from_social"] & headline.rlike(pack.fact_words), headline)
        .when((row["distribution"] == "series") & headline.contains(_CHAMPION),
              F.coalesce(X.first_match(copy, _PLAYS), headline))
        .when((kind == "award") & work.isNotNull() & copy.rlike(_HONOR),
              F.concat(named, F.lit(_HONOR_SAYS[0]), F.regexp_extract(copy, _HONOR, 1), F.lit(_HONOR_SAYS[1]), with_trailer))
        .when((kind == "award") & copy.rlike(_DIRECTOR),
              F.concat(F.lit(_DIRECTOR_SAYS[0]), F.regexp_extract(copy, _DIRECTOR, 2), F.lit(_DIRECTOR_SAYS[1]),
                       F.regexp_extract(copy, _DIRECTOR, 1), F.lit(_DIRECTOR_SAYS[2]), F.regexp_extract(copy, _DIRECTOR, 3)))
        .when(headline.contains(_CALL) & copy.rlike(_SUBMISSIONS), X.first_match(copy, _SUBMISSIONS))
    )


def with_core_sentence(df, pack: RulePack):
    """Add ``core_sentence``: one factual line extracted from the record, never written anew.

    Needs ``kind, headline, copy`` and, for the templates, ``raw_title, raw_summary,
    distribution, from_social, from_blog``.
    """
    c = F.col
    staged = df.withColumn("_parts", sentences(c("copy"), pack))
    staged = staged.withColumn("_best", _best(F.slice("_parts", 1, 5), c("kind"), pack))
    clauses = F.filter(F.transform(F.split(c("_best"), pack.clause_break), X.recompact), lambda part: part != "")
    cued = F.filter(clauses, lambda part: _event_cue(c("kind"), part, pack))
    factual = F.filter(clauses, lambda part: part.rlike(pack.fact_words))
    chosen = F.when(F.size(cued) > 0, cued).otherwise(factual)
    long = F.length("_best") > 165
    staged = staged.withColumn("_clause", F.when(long, _best(chosen, c("kind"), pack)))
    if pack.templates:
        work = X.first_match(c("copy"), _WORK, 1)
        bare = F.regexp_replace(c("_clause"), _SHORT_SUBJECT, "")
        with_work = F.concat(F.lit("《"), work, F.lit("》"), bare)
        staged = staged.withColumn(
            "_clause", F.when(work.isNotNull() & ~c("_clause").contains(work), with_work).otherwise(c("_clause"))
        )
    staged = staged.withColumn("_fact", F.coalesce("_clause", "_best"))
    headline, fact, kind = c("headline"), c("_fact"), c("kind")
    size = F.length(fact)
    cut = F.concat(X.trim_right(F.substring(fact, 1, 105), "，、：: "), F.lit("…"))
    shown = F.when(size > 105, cut).otherwise(fact)
    scored = (
        F.when(kind.isin("music_asset", "trailer", "poster", "award") & (size > 115), headline)
        .when((size > 105) & headline.rlike(pack.fact_words) & (kind != "filing"), headline)
        .when((F.length(shown) < 12) | (X.normalized(shown) == X.normalized(headline)), headline)
        .otherwise(shown)
    )
    empty = (c("copy") == "") | (F.size("_parts") == 0)
    if pack.templates:
        template = _template_line(
            {name: c(name) for name in
             ("kind", "headline", "copy", "raw_title", "raw_summary", "distribution", "from_social", "from_blog")},
            pack,
        )
    else:
        template = F.when(c("from_blog"), headline)
    line = F.when(empty, headline).otherwise(F.coalesce(template, scored))
    # A filter on the line would copy all of its steps into itself.
    lined = staged.withColumn("core_sentence", line).drop("_parts", "_best", "_clause", "_fact")
    return computed_once(lined, {"core_sentence": c("core_sentence")})


@pandas_udf(BooleanType())
def _ratio_below(left: pd.Series, right: pd.Series, threshold: pd.Series) -> pd.Series:
    return pd.Series(
        [None if a is None or b is None else difflib.SequenceMatcher(None, a, b).ratio() < t
         for a, b, t in zip(left, right, threshold)],
        dtype="object",
    )


def _common_at_most(left: Column, right: Column) -> Column:
    """Characters that both lines hold, each as often as the poorer line has it."""
    def times(text: Column, char: Column) -> Column:
        return F.length(text) - F.length(F.replace(text, char, F.lit("")))

    chars = F.array_distinct(F.split(left, ""))
    return F.aggregate(chars, F.lit(0), lambda total, char: total + F.when(char == "", 0).otherwise(
        F.least(times(left, char), times(right, char))).cast("int"))


def overlap_decision(left: Column, right: Column, threshold: float) -> Column:
    """What decides whether two normalised lines overlap less than ``threshold``: ``empty`` and ``lengths`` and
    ``letters`` (less), ``contained`` (not less), or ``ratio`` (only the sequence ratio can tell)."""
    both = F.length(left) + F.length(right)
    # The ratio is 2 m / both, where m matched characters come in order from both lines.
    return (
        F.when(left.isNull() | right.isNull(), F.lit(None).cast("string"))
        .when((left == "") | (right == ""), F.lit("empty"))
        .when(right.contains(left) | left.contains(right), F.lit("contained"))
        .when(2 * F.least(F.length(left), F.length(right)) < both * F.lit(threshold), F.lit("lengths"))
        .when(2 * _common_at_most(left, right) < both * F.lit(threshold), F.lit("letters"))
        .otherwise(F.lit("ratio"))
    )


def overlap_below(left: Column, right: Column, threshold: float) -> Column:
    """Whether two normalised lines have less than ``threshold`` of their text in common.

    Bounds on lengths and letters decide most pairs in the JVM; only the others are sent to Python.
    """
    decision = overlap_decision(left, right, threshold)
    undecided = decision == "ratio"
    ratio = _ratio_below(F.when(undecided, left), F.when(undecided, right), F.lit(threshold))
    return F.when(decision == "contained", F.lit(False)).when(~undecided, F.lit(True)).otherwise(ratio)
