"""Time expressions (E4, E5, E25); stamps are UTC, civil days are Asia/Shanghai."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CIVIL_ZONE = "Asia/Shanghai"

# Zone names of mail dates and their offsets.
MAIL_ZONES = {
    "EST": "-0500", "EDT": "-0400", "CST": "-0600", "CDT": "-0500",
    "MST": "-0700", "MDT": "-0600", "PST": "-0800", "PDT": "-0700",
    "AST": "-0400", "ADT": "-0300",
}
# "Tue, 22 Sep 2026 10:10:00 +0800" and, for posts, "Tue Sep 22 10:10:00 +0800 2026".
_MAIL = (
    r"(?i)^(?:[a-z]{3,9} ?,? |[a-z]{3,9},)?"
    r"(\d{1,2})[ -]+([a-z]{3})[a-z]*[ -]+(\d{4}|\d{2}) (\d{1,2}:\d{2})(:\d{2})? ?([a-z]+|[+-]\d{4})?.*$"
)
_POST = (
    r"(?i)^(?:[a-z]{3,9} ?,? )?([a-z]{3})[a-z]* (\d{1,2}) (\d{1,2}:\d{2})(:\d{2})? ([a-z]+|[+-]\d{4}) (\d{4})$"
)
_ISO = (
    r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?(?:Z|[+-]\d{2}(?::?\d{2})?)?)?$"
)


def _number(text: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract(text, pattern, group).try_cast("int")


def _iso_with_zone(text: Column) -> Column:
    """An ISO date with an explicit zone; a naive one is UTC."""
    timed = F.regexp_replace(text, r"^(\d{4}-\d{2}-\d{2})$", "$1T00:00:00")
    zoned = F.regexp_replace(timed, r"([T ]\d{2}:[\d:.]+)$", "$1Z")
    return F.regexp_replace(zoned, r"([+-]\d{2})(\d{2})$", "$1:$2")


def _mail_with_zone(text: Column) -> Column:
    """A mail or post date as ``d MMM yyyy H:mm[:ss] +hhmm``; an unknown zone is UTC."""
    plain = F.regexp_replace(F.regexp_replace(text, _POST, "$2 $1 $6 $3$4 $5"), _MAIL, "$1 $2 $3 $4$5 $6")
    plain = F.regexp_replace(plain, r"^(\d+ \w+) ([0-5]\d|6[0-8]) ", "$1 20$2 ")
    plain = F.regexp_replace(plain, r"^(\d+ \w+) (\d{2}) ", "$1 19$2 ")
    zone = F.upper(F.regexp_extract(plain, r"([A-Za-z]+|[+-]\d{4})?$", 1))
    offset = F.when(zone.rlike(r"^[+-]"), zone)
    for name, value in MAIL_ZONES.items():
        offset = offset.when(zone == name, F.lit(value))
    return F.concat(F.trim(F.regexp_replace(plain, r"(?:[A-Za-z]+|[+-]\d{4})$", "")), F.lit(" "), offset.otherwise(F.lit("+0000")))


def published_at(cleaned: Column) -> Column:
    """A cleaned feed date as a UTC timestamp; null if absent or unreadable, never 'now'.

    The argument is used several times: pass a column, not a long expression.
    """
    mail = F.try_to_timestamp(_mail_with_zone(cleaned), F.lit("d MMM yyyy H:mm[:ss] Z"))
    return F.when(cleaned.rlike(_ISO), _iso_with_zone(cleaned).try_cast("timestamp")).when(cleaned != "", mail)


_LOCAL = r"(20\d{2})[-年/](\d{1,2})[-月/](\d{1,2})(?:日)?(?:\s*)(\d{1,2}):(\d{2})(?::(\d{2}))?"


def local_date(value: Column) -> Column:
    """Wall time at +08:00 found in page text, as a UTC timestamp; null if none or invalid."""
    text = F.coalesce(value, F.lit(""))
    parts = [_number(text, _LOCAL, group) for group in range(1, 7)]
    parts[5] = F.coalesce(parts[5], F.lit(0))
    return F.when(text.rlike(_LOCAL), F.try_make_timestamp(*parts, F.lit("+08:00")))


def epoch_millis(value: Column) -> Column:
    return F.timestamp_millis(value.try_cast("bigint"))


def civil_day(stamp: Column) -> Column:
    return F.to_date(F.from_utc_timestamp(stamp, CIVIL_ZONE))


def iso_stamp(stamp: Column) -> Column:
    return F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def iso_day(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def item_time(stamp: Column) -> Column:
    """Source time on the civil clock as shown on a card."""
    shown = F.date_format(F.from_utc_timestamp(stamp, CIVIL_ZONE), "MM/dd HH:mm")
    return F.coalesce(shown, F.lit("——"))
