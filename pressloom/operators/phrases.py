"""Phrases in the joined text of a group, found without joining it.

The texts of a group stand one after the other with a blank between them; a phrase may begin in one record and
end in a later one. No group becomes one string: a record gets a bounded tail of what stands before it, or,
where a phrase may be of any length, the record that opens it and the one that closes it find each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressloom.functions import text as X


def _tail(text: Column, reach: int) -> Column:
    return F.substring(text, F.greatest(F.length(text) - reach + 1, F.lit(1)), F.lit(reach))


def first_match(records: DataFrame, group: list[str], chunk: Column, pattern: str, reach: int) -> DataFrame:
    """The first match of a pattern in the joined text of each group: ``group, match``.

    ``records`` have the group's columns, ``place`` (their order in it) and ``text``. ``reach`` is the most characters
    that a match across records has in the earlier ones; what follows there must lie in one record. ``chunk`` cuts
    the order of a group into stretches (it never decreases with ``place``): tails are carried within a
    stretch first, then from stretch to stretch, so that no task orders a whole group.
    """
    c = F.col
    # Every record adds a blank at least, so this many of them fill the reach.
    before = (-(reach + 1), -1)
    rows = records.select(*group, "place", "text", chunk.alias("chunk"), _tail(c("text"), reach).alias("tail"))
    within = Window.partitionBy(*group, "chunk").orderBy("place").rowsBetween(*before)
    rows = rows.withColumn("near", F.collect_list("tail").over(within))
    ends = rows.groupBy(*group, "chunk").agg(
        F.max_by(_tail(F.array_join(F.array_append("near", c("tail")), " "), reach), "place").alias("end"))
    across = Window.partitionBy(*group).orderBy("chunk").rowsBetween(*before)
    ends = ends.select(*group, "chunk", F.collect_list("end").over(across).alias("far"))
    carried = rows.join(ends, [*group, "chunk"]).withColumn("carry", _tail(F.array_join(F.concat("far", "near"), " "), reach))
    joined = F.concat("carry", F.lit(" "), "text")
    reaching = (F.regexp_instr(joined, F.lit(pattern)) > 0) & (F.regexp_instr(joined, F.lit(pattern)) <= F.length("carry"))
    found = F.when(reaching, F.regexp_extract(joined, pattern, 0)).otherwise(X.first_match(c("text"), pattern))
    hits = carried.select(*group, "place", found.alias("match")).filter(c("match").isNotNull())
    return hits.groupBy(*group).agg(F.min_by("match", "place").alias("match"))


def first_quoted(records: DataFrame, group: list[str], opening: str = "《", closing: str = "》") -> DataFrame:
    """What the first pair of quotes in the joined text of each group holds: ``group, match``.

    The first record with an opening quote that something follows decides. If it closes the quote too, that is all;
    else the first later record with a closing quote ends it, and the texts between belong to the name.
    """
    c = F.col
    begins = rf"(?s){opening}(?!{closing}).*"
    opened = records.filter(c("text").rlike(begins)).groupBy(*group).agg(
        F.min_by(F.regexp_extract("text", begins, 0), "place").alias("begun"), F.min("place").alias("from"))
    whole = F.regexp_extract("begun", rf"(?s)^{opening}([^{closing}]+){closing}", 1)
    done = opened.filter(c("begun").contains(closing)).select(*group, whole.alias("match"))
    still = opened.filter(~c("begun").contains(closing))
    later = records.join(still, group).filter(c("place") > c("from"))
    closed = later.filter(c("text").contains(closing)).groupBy(*group, "begun", "from").agg(
        F.min_by(F.substring_index("text", closing, 1), "place").alias("rest"), F.min("place").alias("to"))
    # Texts without any quote between the two: they are part of the name that is returned.
    between = records.join(closed, group).filter((c("place") > c("from")) & (c("place") < c("to"))).groupBy(*group).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("place", "text"))), lambda x: x["text"]).alias("middle"))
    parts = F.concat(F.array(F.substring("begun", 2, 1 << 30)), F.coalesce("middle", F.array().cast("array<string>")), F.array("rest"))
    return done.unionByName(closed.join(between, group, "left").select(*group, F.array_join(parts, " ").alias("match")))
