"""URL expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

URL_PARTS = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#.*)?$"

# Query fields that only track visits.
TRACKING_FIELDS = ["fbclid", "gclid"]
# Path parts of site furniture that is never article artwork.
FURNITURE = [
    "/skin/", "logo", "weixin", "weixing", "qrcode", "icon", "pic_fb.jpg", "line-ad",
    "cropped-header", "cropped-15181454", "u435p4t47d50136", "u719p4t47d50049",
]


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, URL_PARTS, 1))


def authority(url: Column) -> Column:
    return F.regexp_extract(url, URL_PARTS, 2)


def path(url: Column) -> Column:
    return F.regexp_extract(url, URL_PARTS, 3)


def query(url: Column) -> Column:
    return F.regexp_extract(url, URL_PARTS, 4)


def user_info(url: Column) -> Column:
    """The part before the last '@' of the authority, null without one."""
    return F.when(authority(url).contains("@"), F.regexp_extract(authority(url), r"^(.*)@", 1))


def host(url: Column) -> Column:
    """Lower-case host name without user info and port."""
    return F.lower(F.regexp_extract(authority(url), r"^(?:.*@)?(\[[^\]]*\]|[^:]*)", 1))


def is_http(url: Column) -> Column:
    return F.coalesce(url.startswith("http://") | url.startswith("https://"), F.lit(False))


def _query_encoded(value: Column) -> Column:
    decoded = F.coalesce(F.try_url_decode(value), value)
    return F.replace(F.replace(F.url_encode(decoded), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def canonical_url(url: Column) -> Column:
    """Drop tracking fields, the fragment and trailing slashes of the path."""
    fields = F.filter(F.split(query(url), "&"), lambda field: field != "")
    pairs = F.transform(
        fields,
        lambda field: F.struct(
            F.regexp_extract(field, r"^([^=]*)", 1).alias("name"),
            F.regexp_extract(field, r"^[^=]*=(.*)$", 1).alias("value"),
        ),
    )
    kept = F.filter(
        pairs,
        lambda pair: ~F.lower(pair["name"]).startswith("utm_")
        & ~F.lower(pair["name"]).isin(TRACKING_FIELDS),
    )
    encoded = F.array_join(
        F.transform(
            kept,
            lambda pair: F.concat(_query_encoded(pair["name"]), F.lit("="), _query_encoded(pair["value"])),
        ),
        "&",
    )
    base = F.concat(scheme(url), F.lit("://"), authority(url), F.regexp_replace(path(url), "/+$", ""))
    with_query = F.when(encoded != "", F.concat(base, F.lit("?"), encoded)).otherwise(base)
    return F.when(url.rlike(URL_PARTS), with_query).otherwise(url)


def _drop_dot_parts(joined: Column) -> Column:
    """Resolve '.' and '..' in an absolute path, however many; empty parts inside it go too."""
    parts = F.split(joined, "/")
    last = F.element_at(parts, -1)
    inner = F.filter(F.slice(parts, 2, F.greatest(F.size(parts) - 2, F.lit(0))), lambda part: part != "")

    def step(kept: Column, part: Column) -> Column:
        return (F.when(part == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0))))
                .when(part == ".", kept).otherwise(F.concat(kept, F.array(part))))

    kept = F.aggregate(F.concat(inner, F.array(last)), F.array().cast("array<string>"), step)
    tail = F.when(last.isin(".", "..") & (F.size(kept) > 0), F.lit("/")).otherwise(F.lit(""))
    resolved = F.concat(F.lit("/"), F.array_join(kept, "/"), tail)
    # Most paths have nothing to resolve.
    return F.when(joined.rlike(r"/\.{0,2}(?:/|$)"), resolved).otherwise(joined)


def resolve_url(link: Column, base: Column) -> Column:
    """Join a link with the address of the page it stands on."""
    origin = F.concat(scheme(base), F.lit("://"), authority(base))
    folder = F.concat(F.regexp_extract(path(base), r"^(.*/)", 1))
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    own_path = F.regexp_extract(link, r"^([^?#]*)", 1)
    own_tail = F.regexp_extract(link, r"^[^?#]*(.*)$", 1)
    page = F.concat(origin, path(base))
    page_query = F.when(query(base) != "", F.concat(F.lit("?"), query(base))).otherwise(F.lit(""))
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(scheme(base), F.lit(":"), link))
        .when(link.startswith("/"), F.concat(origin, _drop_dot_parts(own_path), own_tail))
        .when(link.startswith("?"), F.concat(page, link))
        .when(link.startswith("#"), F.concat(page, page_query, link))
        .when(link == "", F.concat(page, page_query))
        .otherwise(F.concat(origin, _drop_dot_parts(F.concat(folder, own_path)), own_tail))
    )


def safe_url(link: Column, base: Column | None = None) -> Column:
    """The absolute http(s) address of a link, or '' if it has no host or carries credentials."""
    link = F.coalesce(link, F.lit(""))
    url = link if base is None else resolve_url(link, base)
    good = (link != "") & scheme(url).isin("http", "https") & (host(url) != "") & (
        F.coalesce(user_info(url), F.lit("")) == ""
    )
    return F.when(good, url).otherwise(F.lit(""))


def usable_news_image(url: Column) -> Column:
    tokens = "|".join(token.replace(".", r"\.") for token in FURNITURE)
    return is_http(url) & ~F.coalesce(F.lower(path(url)).rlike(tokens), F.lit(False))
