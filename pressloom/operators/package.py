"""The previous-day content pack."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.functions import package as P
from pressloom.functions import text as X
from pressloom.functions.classify import ranked
from pressloom.functions.times import civil_day, iso_day
from pressloom.operators.scale import written
from pressloom.rules.pack import PACK_RANK, RulePack

SHOWN_TAGS = 18
# Characters of the piece by which a work name finds asset names.
ANCHOR = 4


def pack_order() -> list[Column]:
    c = F.col
    return [ranked(c("confidence"), PACK_RANK, 3), F.coalesce("content_priority", F.lit(9)), c("published_ts").desc(), c("group_seq")]


def source_day(pool: DataFrame, publish_day: dt.date, allow_fallback: bool) -> DataFrame:
    """One row: the day before, or with ``allow_fallback`` the latest day present if that is empty."""
    wanted = F.lit((publish_day - dt.timedelta(days=1)).isoformat()).cast("date")
    day = civil_day(F.col("published_ts"))
    row = pool.agg(F.max(day).alias("latest"), F.max(day == wanted).alias("present"))
    chosen = F.when(F.coalesce("present", F.lit(False)), wanted)
    fallback = F.coalesce("latest", wanted) if allow_fallback else wanted
    return row.select(F.coalesce(chosen, fallback).alias("source_day"))


def package_select(pool: DataFrame, publish_day: dt.date, max_items: int = 5, allow_fallback: bool = False) -> DataFrame:
    """The best ``max_items`` of the source day, with their ``place``.

    The day is one aggregated row, so its join key is a broadcast of one row; the top items come
    from an ordered limit, without a one-partition window over the pool.
    """
    c = F.col
    day = source_day(pool, publish_day, allow_fallback)
    dated = pool.withColumn("source_day", civil_day(c("published_ts")))
    best = dated.join(F.broadcast(day), "source_day", "left_semi").orderBy(*pack_order()).limit(max_items)
    place = F.row_number().over(_whole().orderBy(*pack_order()))
    return best.withColumn("place", place)


def _whole():
    """A window over the few selected rows of a pack."""
    from pyspark.sql import Window

    return Window.partitionBy(F.lit(0))


def package_tags(selected: DataFrame, pack: RulePack, edition_name: str = "") -> DataFrame:
    """A10: ordered distinct tags of the pack with their place; the first 18 are shown.

    ``edition_name`` is the tag of the publication itself, second in the list. The input is a selected pack, so at most its few items are gathered.
    """
    c = F.col
    combined = F.concat_ws(" ", "title", "summary")
    listed = selected.select(
        "place", F.concat(P.project_names(combined, pack), P.actor_names(X.compatibility_form(combined))).alias("names")
    )
    gathered = listed.agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("place", "names"))), lambda x: x["names"])).alias("names"))
    tags = F.concat(
        F.array(*[F.lit(t) for t in (*pack.default_tags, edition_name)]), c("names"), F.array(F.lit(pack.closing_tag))
    )
    bare = F.filter(F.transform(tags, lambda tag: F.regexp_replace(tag, r"(?U)[\s#]+", "")), lambda tag: tag != "")
    return gathered.select(F.posexplode(F.array_distinct(bare)).alias("pos", "tag")).select(
        (c("pos") + 1).alias("place"), "tag", (c("pos") < SHOWN_TAGS).alias("shown")
    )


def package_manifest(selected: DataFrame, pack: RulePack, publish_day: dt.date, edition_name: str = "") -> DataFrame:
    """One row with digest, caption and tags of a pack of a few items."""
    c = F.col
    label = P.status_label(c("confidence"))
    paragraph = F.concat(
        F.lpad(c("place").cast("string"), 2, "0"), F.lit(" "), F.coalesce(X.blank_to_null(c("title")), F.lit("影视动态")), F.lit("。"),
        P.first_sentence(c("summary"), 92), F.lit("（"), label, F.lit("）"),
    )
    rows = selected.select("place", "id", "title", paragraph.alias("paragraph"), label.alias("status"),
                           civil_day(c("published_ts")).alias("day"))
    gathered = rows.agg(
        F.array_sort(F.collect_list(F.struct("place", "id", "title", "status", "paragraph"))).alias("items"),
        F.max("day").alias("source_day"),
    ).filter(F.size("items") > 0)
    tags = package_tags(selected, pack, edition_name).agg(
        F.array_sort(F.collect_list(F.struct("place", "tag", "shown"))).alias("tags")
    )
    ids = F.to_json(F.transform("items", lambda x: x["id"]))
    shown = F.transform(F.filter("tags", lambda t: t["shown"]), lambda t: F.concat(F.lit("#"), t["tag"]))
    caption = F.concat(
        F.lit("把昨天值得留意的影视动态整理成一组图。\n\n"),
        F.array_join(F.transform("items", lambda x: x["paragraph"]), "\n\n"), F.lit("\n\n"), F.array_join(shown, " "),
    )
    # Both sides are aggregates without a key: one row each, joined on a constant.
    one = gathered.withColumn("_k", F.lit(1)).join(tags.withColumn("_k", F.lit(1)), "_k")
    return one.select(
        F.substring(F.sha2(ids, 256), 1, 20).alias("digest"),
        F.lit(publish_day.isoformat()).alias("publish_date"),
        iso_day(c("source_day")).alias("source_date"),
        F.lit("一觉醒来，影视圈发生了什么？").alias("title"),
        caption.alias("caption"),
        F.transform("tags", lambda t: t["tag"]).alias("tags"),
        F.transform("items", lambda x: F.struct(x["id"].alias("id"), x["title"].alias("title"), x["status"].alias("status"))).alias("items"),
    )


def package_cards(selected: DataFrame, pack: RulePack) -> DataFrame:
    """Card texts of a pack."""
    card = P.card_title(F.col("title"), pack)
    return selected.select(
        "place", "id", card.alias("card_title"), P.card_event(F.col("title"), card).alias("card_event"),
        P.first_sentence(F.col("summary")).alias("lead"), P.status_label(F.col("confidence")).alias("status"),
    )


def daily_digests(pool: DataFrame, max_items: int = 5) -> DataFrame:
    """A11 for every civil day of a pool: digest over the ids of the day's pack, in order."""
    from pressloom.operators.scale import top_per_group

    c = F.col
    days = pool.withColumn("source_day", civil_day(c("published_ts")))
    best = top_per_group(days, ["source_day"], pack_order(), max_items, ["id"])
    ids = F.transform(F.array_sort(F.collect_list(F.struct("rank", "id"))), lambda x: x["id"])
    return best.groupBy("source_day").agg(ids.alias("ids")).select(
        iso_day(c("source_day")).alias("source_date"),
        iso_day(F.date_add("source_day", 1)).alias("publish_date"),
        F.substring(F.sha2(F.to_json("ids"), 256), 1, 20).alias("digest"),
        F.size("ids").alias("items"),
    )


def grams_of(text: Column, sizes: Column) -> Column:
    """All different pieces of a text of the given sizes."""
    return F.array_distinct(F.flatten(F.transform(sizes, lambda size: F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(text) - size + 1, F.lit(1))), lambda start: F.substring(text, start, size)))))


def rarest_anchors(names: DataFrame, asset_grams: DataFrame) -> DataFrame:
    """``name, anchor``: the piece of ``ANCHOR`` characters (a shorter name whole) that fewest assets hold.

    A name with a piece that no asset holds is in no asset, and has no anchor.
    """
    c = F.col
    frequency = asset_grams.groupBy("anchor").agg(F.count(F.lit(1)).alias("assets"))
    size = F.least(F.length("name"), F.lit(ANCHOR))
    pieces = names.select("name", F.explode(grams_of(c("name"), F.array(size))).alias("anchor"))
    found = pieces.join(frequency, "anchor", "left").groupBy("name").agg(
        F.min_by("anchor", F.struct("assets", "anchor")).alias("anchor"), F.count_if(c("assets").isNull()).alias("absent"))
    return found.filter("absent = 0").select("name", "anchor")


def asset_match(items: DataFrame, assets: DataFrame, pack: RulePack) -> DataFrame:
    """The asset of each item: first work name, in order, that an asset name contains.

    "Contains" is an equality join on anchors: of a name's pieces the one that fewest assets hold meets the assets that
    hold it, and only these are searched for the whole name. So a beginning that all names share, or a piece that
    all assets share, is no meeting point. ``assets`` holds ``asset``; of several assets the first by name counts.
    """
    c = F.col
    combined = F.concat(X.text_or_empty(c("title")), X.text_or_empty(c("summary")))
    found = items.select("id", F.posexplode(P.project_names(combined, pack)).alias("pos", "name"))
    names = written(found.filter(c("name") != ""), "work-names")
    pieces = grams_of(c("asset"), F.sequence(F.lit(1), F.lit(ANCHOR)))
    # Written: read twice, and its true size decides on the join.
    asset_grams = written(assets.select("asset").distinct().select("asset", F.explode(pieces).alias("anchor")), "asset-grams")
    anchored = rarest_anchors(names.select("name").distinct(), asset_grams)
    parts = anchored.join(asset_grams, "anchor").filter(F.contains("asset", "name")).groupBy("name").agg(
        F.min("asset").alias("asset"))
    return names.join(parts, "name").groupBy("id").agg(
        F.min_by(F.struct("name", "asset"), c("pos")).alias("hit")
    ).select("id", c("hit.name").alias("name"), c("hit.asset").alias("asset"))
