"""Text normalisation expressions (E1, E3, E6, E12, E25 and small helpers)."""

from __future__ import annotations

import html
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

# One character of a word: letter, number or underscore in any script.
WORD = r"[\p{L}\p{N}_]"
NOT_WORDS = r"[^\p{L}\p{N}_]+"
SPACE_RUN = r"(?U)[\s\x1c-\x1f]+"
# Any character outside such runs.
NOT_SPACE = r"[^\x09-\x0d\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"

# Character variants folded for matching only, and their targets.
VARIANTS = {
    "電": "电", "視": "视", "劇": "剧", "網": "网", "紀": "纪", "錄": "录",
    "導": "导", "發": "发", "臺": "台", "灣": "湾", "國": "国", "藝": "艺",
    "獎": "奖", "開": "开", "預": "预", "戲": "戏", "線": "线", "華": "华",
    "長": "长", "陸": "陆", "韓": "韩", "萊": "莱", "塢": "坞", "歐": "欧", "動": "动",
}
# Case folding beyond lower(): one-to-one pairs here, the sharp s by replace.
CASE_FOLD = {"ς": "σ", "ſ": "s"}

# Characters that compatibility normalisation leaves as they are and that never combine:
# ASCII, Latin-1 without its compatibility forms, common CJK and general punctuation.
STABLE_CHARS = (
    r"\x00-\x7f¡-§©«-®°±¶·»¿-ÿ"
    r"‐‒-‖‘-•、-〃〈-】〔-〛一-鿿"
)
# Full-width ASCII block U+FF01..U+FF5E sits 0xFEE0 above ASCII; U+3000 is its blank.
_FULL_WIDTH = "".join(chr(code + 0xFEE0) for code in range(0x21, 0x7F)) + "　"
_HALF_WIDTH = "".join(chr(code) for code in range(0x21, 0x7F)) + " "


def text_or_empty(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def blank_to_null(value: Column) -> Column:
    """Null where the text is missing or only white space."""
    return F.when(value.rlike(NOT_SPACE), value)


def collapse_space(value: Column) -> Column:
    return F.trim(F.regexp_replace(value, SPACE_RUN, " "))


def contains_any(value: Column, words) -> Column:
    """True if any of a fixed list of words occurs in the text."""
    found = F.lit(False)
    for word in words:
        found = found | value.contains(word)
    return found


@pandas_udf(StringType())
def _decode_entities(texts: pd.Series) -> pd.Series:
    def decode(text):
        for _ in range(3):
            decoded = html.unescape(text)
            if decoded == text:
                break
            text = decoded
        return text

    return texts.map(decode, na_action="ignore")


@pandas_udf(StringType())
def _decode_entities_once(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


@pandas_udf(StringType())
def _compatibility_form(texts: pd.Series) -> pd.Series:
    return texts.map(lambda text: unicodedata.normalize("NFKC", text), na_action="ignore")


def decode_entities(value: Column, rounds: int = 3) -> Column:
    """Entity decoding; only texts holding an ampersand travel to Python."""
    decode = _decode_entities if rounds > 1 else _decode_entities_once
    return F.coalesce(decode(F.when(value.contains("&"), value)), value)


def strip_markup(value: Column) -> Column:
    return F.regexp_replace(value, r"<[^>]+>", " ")


def clean_text(value: Column) -> Column:
    """Feed text: decode up to three layers, drop tags and a dangling tag, collapse space."""
    decoded = decode_entities(text_or_empty(value))
    # Most texts have no markup to look for.
    bare = F.regexp_replace(strip_markup(decoded), r"<[^>]*\z", "")
    return collapse_space(F.when(decoded.contains("<"), bare).otherwise(decoded))


def clean_page_text(value: Column) -> Column:
    """Page text: drop tags first, then decode one layer."""
    return collapse_space(decode_entities(strip_markup(text_or_empty(value)), rounds=1))


def clean_post_text(value: Column) -> Column:
    """Post text: decode one layer first, then drop tags."""
    return collapse_space(strip_markup(decode_entities(text_or_empty(value), rounds=1)))


def title_key(title: Column) -> Column:
    return F.substring(F.regexp_replace(F.lower(title), NOT_WORDS, ""), 1, 160)


def search_text(value: Column) -> Column:
    """Folded text for matching; the stored text is never rewritten."""
    pairs = {**VARIANTS, **CASE_FOLD}
    lowered = F.lower(value)
    # translate() looks up every character, so texts without a variant go around it.
    varied = F.translate(lowered, "".join(pairs), "".join(pairs.values()))
    folded = F.when(value.rlike(f"[一-鿿{''.join(CASE_FOLD)}]"), varied).otherwise(lowered)
    return F.replace(folded, F.lit("ß"), F.lit("ss"))


def fold_keyword(word: str) -> str:
    """The plan-time twin of :func:`search_text` for configured keywords."""
    return word.casefold().translate(str.maketrans(VARIANTS))


def compatibility_form(value: Column) -> Column:
    """NFKC. Only texts with characters that cannot be folded natively go to Python."""
    text = text_or_empty(value)
    # Full-width forms and the ellipsis fold natively; translate() is spared for texts without them.
    half = F.when(text.rlike("[\uff01-\uff5e\u3000]"), F.translate(text, _FULL_WIDTH, _HALF_WIDTH)).otherwise(text)
    folded = F.replace(half, F.lit("…"), F.lit("..."))
    # The ranges before && tell most Latin text apart.
    odd = F.when(folded.rlike(rf"[[^\x00-\x7f]&&[^\xbf-\xff]&&[^{STABLE_CHARS}]]"), folded)
    return F.coalesce(_compatibility_form(odd), folded)


def compact(value: Column) -> Column:
    """NFKC, no zero-width characters, single spaces."""
    return collapse_space(F.regexp_replace(compatibility_form(value), r"[​-‍﻿]", ""))


def recompact(value: Column) -> Column:
    """:func:`compact` for a part cut out of an already compacted text."""
    return collapse_space(value)


# Phrases after which post copy is no longer news text.
COPY_TAIL = r"你观看过|一起来评论区|欢迎评论|点击链接|敬请期待|数据统计范围[:：]"
COPY_EDGE = "，。；、# "


def visible_copy(compacted: Column) -> Column:
    """Post copy without links, hashtags, mentions and call-to-action tails."""
    text = F.regexp_replace(compacted, r"(?U)https?://\S+", "")
    text = F.regexp_replace(text, r"#([^#\n]{2,80})#", "")
    text = F.regexp_replace(text, r"@[\p{L}\p{N}_-]+", "")
    text = F.regexp_replace(text, rf"(?s)(?:{COPY_TAIL}).*", "")
    return F.btrim(recompact(text), F.lit(COPY_EDGE))


def normalized(compacted: Column) -> Column:
    return F.regexp_replace(F.lower(compacted), NOT_WORDS, "")


def trim_right(value: Column, chars: str) -> Column:
    return F.rtrim(value, F.lit(chars))


def excerpt(value: Column, limit: int = 180) -> Column:
    """Card text of at most ``limit`` characters with an ellipsis when cut."""
    text = collapse_space(text_or_empty(value))
    cut = F.concat(trim_right(F.substring(text, 1, limit), "，。；、 "), F.lit("…"))
    return F.when(F.length(text) <= limit, text).otherwise(cut)


def first_match(value: Column, pattern: str, group: int = 0) -> Column:
    """The first match of a pattern, or null (``regexp_extract`` gives '' for no match)."""
    return F.when(value.rlike(pattern), F.regexp_extract(value, pattern, group))
