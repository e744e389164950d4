"""Benchmark decontamination by SimHash over item-sized windows (operator 7), in DataFrame functions only.

A benchmark item of ``n`` shingles (five words each) is held against windows of ``n`` shingles of every text.

1. Windows: sliding a window to the right until it starts at a shingle that some item of its size holds loses no
   common shingle, so these starts (and the last window of a text) hold the best window of every item.
2. Each window and item gets a 64-bit SimHash over the set of its numbered shingles: the second, third, ... occurrence
   of a shingle is an element of its own. So weighted similarity is set similarity, and no element outweighs others.
3. Fingerprints are cut into ``BLOCKS`` blocks. Within distance ``RADIUS`` one block at least differs in at most
   ``RADIUS // BLOCKS`` bits, so items are indexed under all block values that near, windows are looked up by their
   own, and no fingerprint within the radius is missed.
4. Candidates within the radius are verified by exact weighted similarity: the sum of the smaller over the sum
   of the larger counts of all shingles, at least 0.75.

The radius lies four standard deviations above the distance expected of a pair at exactly 0.75.

Items are taken in blocks of bounded size, each broadcast against all texts, so a benchmark of any size is
worked off exactly. The index has as many rows for an item of one shingle as for a long one, so it has a bound of
its own, beyond which it is joined without a broadcast. Defined results: null or empty texts and items match nothing; an item of fewer than five
words is one shingle of all its words; a text shorter than an item is one window; repeated items each match;
repeated rows of a text give one result per key; extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.llm.common import GAP, names_each_row, numbered, stored
from pressloom.operators.scale import computed_once

SHINGLE = 5
NUMERATOR, DENOMINATOR = 75, 100
RADIUS = 23
BLOCKS = 8
BITS = 64 // BLOCKS
# Shingles of the items that are broadcast at a time.
BLOCK_SHINGLES = 1_000_000
# Rows of the index of fingerprints that are broadcast at most; a larger index is a table that is joined by its keys.
INDEX_ROWS = 1_000_000
BLANK = " \t\n\r\v\f"


def words_of(text: Column) -> Column:
    """Lower-cased words of a text; none for null or blank."""
    bare = F.btrim(F.lower(text), F.lit(BLANK))
    return F.when(F.length(bare) > 0, F.split(bare, GAP)).otherwise(F.array().cast("array<string>"))


def grams(hashes: Column, width: int) -> Column:
    """Hashes of all runs of ``width`` words, in order."""
    starts = F.when(F.size(hashes) >= width, F.sequence(F.lit(0), F.size(hashes) - width)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.lit(width), *[F.get(hashes, i + k) for k in range(width)]))


def hashed_words(df: DataFrame, key: str, text: str) -> DataFrame:
    words = df.filter(F.col(text).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("key"), words_of(F.col(text)).alias("words"))
    # Behind a generator the hashes are made once per text; else each use of them below would make them anew.
    return computed_once(words.select("key", "words"), {"hashes": F.transform("words", lambda word: F.xxhash64(word))}).drop("words")


def fingerprints(shingles: DataFrame, keys: list[str]) -> DataFrame:
    """SimHash of the rows of each group, over a column ``shingle``; columns ``b0`` to ``b7`` hold its blocks.

    Two bits are counted in one sum, in its upper and lower half.
    """
    lanes = F.lit((1 << 32) + 1)
    sums = [F.sum(F.shiftrightunsigned("shingle", i).bitwiseAND(lanes)).alias(f"s{i}") for i in range(32)]
    counted = shingles.groupBy(*keys).agg(F.count(F.lit(1)).alias("held"), *sums)

    def bit(i: int) -> Column:
        lane = F.col(f"s{i % 32}")
        count = F.shiftright(lane, 32) if i >= 32 else lane.bitwiseAND(F.lit((1 << 32) - 1))
        return (count * 2 > F.col("held")).cast("int")

    blocks = [reduce(lambda a, b: a + b, [bit(block * BITS + k) * (1 << k) for k in range(BITS)]).alias(f"b{block}")
              for block in range(BLOCKS)]
    return counted.select(*keys, "held", *blocks)


def occurrences(shingles: DataFrame, keys: list[str]) -> DataFrame:
    """A row ``shingle`` per element of the array ``shingles`` of each row, told apart by number of occurrence.

    First occurrences keep their hash. Only rows with a repeated shingle are counted shingle by shingle.
    """
    plain = F.size(F.array_distinct("shingles")) == F.size("shingles")
    single = shingles.filter(plain).select(*keys, F.explode("shingles").alias("shingle"))
    counted = (shingles.filter(~plain).select(*keys, F.explode("shingles").alias("shingle"))
               .groupBy(*keys, "shingle").agg(F.count(F.lit(1)).cast("int").alias("k")))
    numbered = counted.select(*keys, "shingle", F.explode(F.sequence(F.lit(1), F.col("k"))).alias("i"))
    element = F.when(F.col("i") == 1, F.col("shingle")).otherwise(F.xxhash64("shingle", "i"))
    return single.unionByName(numbered.select(*keys, element.alias("shingle")))


def near_values() -> list[int]:
    """What to flip in a block: all patterns of at most ``RADIUS // BLOCKS`` bits."""
    return [sum(1 << i for i in places) for k in range(RADIUS // BLOCKS + 1) for places in combinations(range(BITS), k)]


def distance(left: str, right: str) -> Column:
    parts = [F.bit_count(F.col(f"{left}{i}").bitwiseXOR(F.col(f"{right}{i}"))) for i in range(BLOCKS)]
    return reduce(lambda a, b: a + b, parts)


def item_shingles(bench: DataFrame, key: str, text: str) -> DataFrame:
    """``item, n, width, shingles`` of every item with words; ``n`` counts shingles."""
    hashed = hashed_words(bench, key, text).withColumn("width", F.least(F.size("hashes"), F.lit(SHINGLE)))
    by_width = reduce(lambda other, width: F.when(F.col("width") == width, grams(F.col("hashes"), width)).otherwise(other),
                      range(1, SHINGLE + 1), F.array().cast("array<long>"))
    return hashed.filter(F.col("width") > 0).select(F.col("key").alias("item"), "width", by_width.alias("shingles")).withColumn(
        "n", F.size("shingles"))


def leaks(docs: DataFrame, bench: DataFrame, doc_key: str = "doc_id", item_key: str = "item_id",
          text: str = "text", item_text: str = "text") -> DataFrame:
    """``doc_id, item_id, similarity, first_word, last_word`` of the best window of each leaked item in each text.

    Word numbers start at 0; the last one is inclusive. Of equal windows the first counts.
    """
    items = stored(item_shingles(bench.select(item_key, item_text), item_key, item_text).withColumn(
        "row", F.monotonically_increasing_id()), "leak-items")
    total, rows = items.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    parts = max(1, -(-int(total) // BLOCK_SHINGLES))
    # Every item is listed under the values near each of its blocks. All items count, so no block has more rows.
    small = rows * BLOCKS * len(near_values()) <= INDEX_ROWS
    widths = sorted(row[0] for row in items.select("width").distinct().collect())
    found = []
    for part in range(parts):
        block = items.filter(F.pmod(F.xxhash64("row"), F.lit(parts)) == part)
        for width in widths:
            own = block.filter(F.col("width") == width)
            found.append(_leaks_of(docs.select(doc_key, text), own, width, doc_key, text, small))
    kind = docs.schema[doc_key].dataType
    if not found:
        spark = docs.sparkSession
        return spark.createDataFrame([], f"`{doc_key}` {kind.simpleString()}, `{item_key}` {bench.schema[item_key].dataType.simpleString()}, "
                                         "similarity double, first_word int, last_word int")
    every = reduce(DataFrame.unionByName, found)
    best = every.groupBy("key", "item").agg(F.max(F.struct("similarity", (-F.col("start")).alias("back"), "held", "width")).alias("best"))
    start = -F.col("best.back")
    return best.select(F.col("key").alias(doc_key), F.col("item").alias(item_key), F.col("best.similarity").alias("similarity"),
                       start.alias("first_word"), (start + F.col("best.held") + F.col("best.width") - 2).cast("int").alias("last_word"))


def _leaks_of(docs: DataFrame, items: DataFrame, width: int, doc_key: str, text: str, small: bool) -> DataFrame:
    """Verified windows of one block of items of one shingle width."""
    sizes = items.select("n", F.explode("shingles").alias("shingle")).distinct()
    spread = computed_once(hashed_words(docs, doc_key, text), {"shingles": grams(F.col("hashes"), width)}).drop("hashes")
    hits = spread.select("key", "shingles", F.posexplode("shingles").alias("at", "shingle")).join(F.broadcast(sizes), "shingle")
    start = F.greatest(F.lit(0), F.least(F.col("at"), F.size("shingles") - F.col("n")))
    windows = hits.select("key", "n", start.alias("start"), F.slice("shingles", start + 1, F.col("n")).alias("shingles"))
    windows = stored(windows.dropDuplicates(["key", "n", "start"]), "leak-windows")
    window = ["key", "n", "start"]
    of_windows = fingerprints(occurrences(windows, window), window)
    of_items = fingerprints(occurrences(items, ["item", "row", "n"]), ["item", "row", "n"])
    of_items = of_items.select("item", "row", "n", *[F.col(f"b{i}").alias(f"c{i}") for i in range(BLOCKS)])
    flips = F.array(*[F.lit(value) for value in near_values()])
    index = of_items.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))))
    own = F.element_at(F.array(*[F.col(f"c{i}") for i in range(BLOCKS)]), F.col("block") + 1)
    index = index.withColumn("value", own).withColumn("value", F.explode(F.transform(flips, lambda flip: F.col("value").bitwiseXOR(flip))))
    probes = of_windows.select("*", F.posexplode(F.array(*[F.col(f"b{i}") for i in range(BLOCKS)])).alias("block", "value"))
    index = F.broadcast(index) if small else stored(index, "leak-index")
    near = probes.join(index, ["n", "block", "value"]).filter(distance("b", "c") <= RADIUS)
    candidates = near.select(*window, "item", "row", "held").distinct()
    # Exact weighted similarity of the candidates.
    counts = windows.select(*window, F.explode("shingles").alias("shingle")).groupBy(*window, "shingle").agg(F.count(F.lit(1)).alias("k"))
    weights = items.select("row", F.explode("shingles").alias("shingle")).groupBy("row", "shingle").agg(F.count(F.lit(1)).alias("c"))
    common = (candidates.join(counts, window).join(F.broadcast(weights), ["row", "shingle"])
              .groupBy(*window, "item", "row", "held").agg(F.sum(F.least("k", "c")).alias("common")))
    either = F.col("n") + F.col("held") - F.col("common")
    alike = common.filter(F.col("common") * DENOMINATOR >= either * NUMERATOR)
    return alike.select("key", "item", "start", "held", F.lit(width).alias("width"), (F.col("common") / either).alias("similarity"))


def clean(docs: DataFrame, bench: DataFrame, doc_key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows without a leaked item, columns as given; rows whose key is null or shared are searched one by one too."""
    if names_each_row(docs, doc_key):
        dropped = leaks(docs, bench, doc_key, text=text, **options).select(doc_key).distinct()
        return docs.join(dropped, doc_key, "left_anti").select(docs.columns)
    given = numbered(docs, doc_key, text)
    dropped = leaks(given, bench, "row", text="text", **options).select("row").distinct()
    return given.join(dropped, "row", "left_anti").select("doc.*")
