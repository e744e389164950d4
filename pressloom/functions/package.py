"""Content-pack and label expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressloom.functions import text as X
from pressloom.rules.pack import RulePack

# Words that look like names but are not.
NOT_NAMES = [
    "电影", "电视剧", "影片", "剧集", "导演", "编剧", "监制", "出品", "联合", "正式",
    "全国", "上线", "首播", "主演", "领衔", "以及", "等人", "按照", "姓氏", "笔画",
    "阵容", "主创", "儿童电影", "国产电影", "经典电影",
]
# Places in a text where cast names stand.
CAST_PATTERNS = [
    r"([一-鿿·]{2,4}?(?:、[一-鿿·]{2,4}?){1,8})(?=领衔主演|共同主演|主演)",
    r"(?U)(?:主演包括|主演有|演员包括|演员有)[：:\s]*([^。；…]{2,90})",
    r"(?U)[（(]([一-鿿·]{2,4})\s*饰",
    r"(?U)(?:^|[！!。；，,\s])([一-鿿·]{2,4})《",
]
# What a headline says before a work, and what stands where nothing is known.
WORK_KIND = r"^(电影|电视剧|剧集|网剧|优酷|爱奇艺|腾讯视频)"
NO_SUMMARY = "来源未提供可用摘要"
CONFIRMED, UNCONFIRMED = "已确认", "待确认"
SINGLE_SOURCE = "单源待确认"
NAME_BREAK = r"(?U)[、，,／/和与×\s]+"
EDGE = " ，,·｜|-—"
# Labels shown to readers.
DISTRIBUTION_LABELS = {
    "cinema": "院线电影", "cinema_filing": "电影备案项目", "network": "网络电影",
    "film_unspecified": "电影·渠道待确认", "series": "剧集", "other": "影视动态",
}
TRACE_LABELS = {
    "anniversary": "纪念日回顾", "advance_teaser": "消息尚未公布", "promotion": "促销互动",
    "background_roundup": "背景整理", "outside_film_tv": "非影视业务动态",
}
TRACE_OTHER = "低信息量线索"
TRACE_MORE = "简报之外的同日动态"
WEEKDAYS = "一二三四五六日"


def project_names(value: Column, pack: RulePack) -> Column:
    """Names of works in order of appearance, each once."""
    names = F.regexp_extract_all(X.text_or_empty(value), F.lit(pack.project), F.lit(1))
    bare = F.transform(names, lambda name: F.regexp_replace(name, X.SPACE_RUN, ""))
    return F.array_distinct(F.filter(bare, lambda name: name != ""))


def actor_names(normal: Column) -> Column:
    """Chinese cast names near explicit cast markers; ``normal`` is in compatibility form."""
    fragments = F.flatten(
        F.array(*[F.regexp_extract_all(normal, F.lit(pattern), F.lit(1)) for pattern in CAST_PATTERNS])
    )
    plain = F.transform(fragments, lambda part: F.regexp_replace(part, r"（[^）]*）|\([^)]*\)", ""))
    tokens = F.flatten(F.transform(plain, lambda part: F.split(part, NAME_BREAK)))
    names = F.transform(tokens, lambda token: F.btrim(F.regexp_replace(token, r"[^一-鿿·]", ""), F.lit("·")))
    kept = F.filter(names, lambda name: F.length(name).between(2, 4) & ~name.isin(NOT_NAMES))
    return F.slice(F.array_distinct(kept), 1, 8)


def first_sentence(value: Column, limit: int = 76) -> Column:
    text = X.collapse_space(X.text_or_empty(value))
    sentence = F.element_at(F.split(text, r"(?<=[。！？])", 2), 1)
    cut = F.concat(X.trim_right(F.substring(sentence, 1, limit), "，、； "), F.lit("…"))
    shown = F.when(F.length(sentence) > limit, cut).otherwise(sentence)
    return F.when(shown == "", F.lit(NO_SUMMARY)).otherwise(shown)


def status_label(confidence: Column) -> Column:
    confirmed = F.coalesce(confidence.isin("official", "multi_source"), F.lit(False))
    return F.when(confirmed, F.lit(CONFIRMED)).otherwise(F.lit(UNCONFIRMED))


def card_title(title: Column, pack: RulePack) -> Column:
    """Name of the work as the card title, or the whole headline."""
    raw = X.collapse_space(title)
    names = project_names(raw, pack)
    return F.when(F.size(names) > 0, F.concat(F.lit("《"), F.element_at(names, 1), F.lit("》"))).otherwise(raw)


def card_event(title: Column, card: Column) -> Column:
    """What is left of the headline besides the card title."""
    raw = X.collapse_space(title)
    place = F.instr(raw, card)
    rest = F.when(
        place > 0,
        F.concat(F.substring(raw, F.lit(1), place - 1), F.substring(raw, place + F.length(card), F.length(raw))),
    ).otherwise(raw)
    bare = F.regexp_replace(F.btrim(rest, F.lit(EDGE)), WORK_KIND, "")
    return F.when(raw == card, F.lit("")).otherwise(F.btrim(bare, F.lit(EDGE)))


def mapped(value: Column, labels: dict[str, str], default: str) -> Column:
    out = F.when(F.lit(False), F.lit(default))
    for key, label in labels.items():
        out = out.when(value == key, F.lit(label))
    return out.otherwise(F.lit(default))


def evidence_label(confidence: Column, labels: dict[str, str]) -> Column:
    return mapped(F.coalesce(confidence, F.lit("single_source")), labels, SINGLE_SOURCE)


def hashtag_headline(value: Column) -> Column:
    """Headline of a post: its hashtag of 3-60 characters, else its first clause."""
    clause = F.element_at(F.split(value, r"[。！？!?；;\n]", 2), 1)
    cut = X.trim_right(F.substring(clause, 1, 70), "，。；、 ")
    return F.coalesce(F.trim(X.first_match(value, r"#([^#\n]{3,60})#", 1)), cut)


def weekday_label(day: Column) -> Column:
    return F.concat(F.lit("周"), F.substring(F.lit(WEEKDAYS), F.weekday(day) + 1, F.lit(1)))


def empty_market_note(items: Column, configured: Column, successful: Column, unavailable: Column) -> Column:
    """Why a market of the edition is empty; null where it is not."""
    return (
        F.when(items > 0, F.lit(None).cast("string"))
        .when(configured == 0, F.lit("no_source"))
        .when(successful == 0, F.lit("no_success"))
        .when(unavailable > 0, F.lit("partial"))
        .otherwise(F.lit("none_new"))
    )
