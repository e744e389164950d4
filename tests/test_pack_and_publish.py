import datetime as dt
import hashlib
import json

from pyspark.sql import functions as F

from pressloom.operators import package as PK
from pressloom.operators import publish as PB
from pressloom.operators import translate as TR
from pressloom.plans import jobs
from pressloom.rules import CHINESE
from pressloom.session import new_workspace
from tests.conftest import stamp

POOL = "id string, title string, summary string, confidence string, content_priority int, published_ts timestamp, group_seq bigint"
DAY = dt.date(2026, 9, 23)


def pool(spark, *rows):
    base = [(i, f"《片{i}》定档", "由张三、李四主演。第二句。", "single_source", 3, stamp("2026-09-22T03:00:00Z"), n) for n, i in enumerate("abcdefg")]
    return spark.createDataFrame(list(rows) or base, POOL)


def test_pack_takes_the_previous_day_ranked_and_limited(spark):
    rows = [("old", "t", "s", "official", 0, stamp("2026-09-21T03:00:00Z"), 0), ("late", "t", "s", "single_source", 1, stamp("2026-09-22T15:59:00Z"), 1),
            ("first", "t", "s", "official", 3, stamp("2026-09-21T16:00:00Z"), 2), ("today", "t", "s", "official", 0, stamp("2026-09-22T16:00:00Z"), 3),
            ("lead", "t", "s", "social_lead", 0, stamp("2026-09-22T03:00:00Z"), 4)]
    got = PK.package_select(pool(spark, *rows), DAY, 5).orderBy("place").collect()
    assert [r.id for r in got] == ["first", "late", "lead"]


def test_pack_falls_back_to_the_latest_day_only_when_allowed(spark):
    row = ("a", "t", "s", "official", 0, stamp("2026-09-20T03:00:00Z"), 0)
    assert PK.package_select(pool(spark, row), DAY, 5).count() == 0
    assert PK.package_select(pool(spark, row), DAY, 5, allow_fallback=True).count() == 1


def test_manifest_digest_caption_and_tags(spark):
    out = jobs.pack_job(pool(spark), DAY, CHINESE, edition_name="简报")
    row = out.manifest.first()
    ids = [r.id for r in out.items.orderBy("place").collect()]
    assert ids == list("abcde")
    wanted = hashlib.sha256(json.dumps(ids, separators=(",", ":")).encode()).hexdigest()[:20]
    assert (row.digest, row.publish_date, row.source_date) == (wanted, "2026-09-23", "2026-09-22")
    assert row.tags[:3] == ["影视圈", "简报", "片a"] and row.tags[-1] == "电影宣发" and "李四" in row.tags
    assert row.caption.startswith("把昨天值得留意的影视动态整理成一组图。\n\n01 《片a》定档。由张三、李四主演。（待确认）\n\n02 ")
    assert row.caption.endswith(" ".join("#" + t for t in row.tags[:18]))
    card = out.cards.orderBy("place").first()
    assert (card.card_title, card.card_event, card.lead) == ("《片a》", "定档", "由张三、李四主演。")


def test_asset_match_equals_brute_force(spark):
    items = spark.createDataFrame([("1", "《乙片》和《甲》", ""), ("2", "《丙》", "《甲》"), ("3", "无", "")], "id string, title string, summary string")
    names = ["甲的海报", "甲-2", "乙片final", "xyz"]
    assets = spark.createDataFrame([(n,) for n in names], "asset string")
    got = {r.id: (r.name, r.asset) for r in PK.asset_match(items, assets, CHINESE).collect()}
    projects = {"1": ["乙片", "甲"], "2": ["丙", "甲"], "3": []}
    brute = {}
    for ident, works in projects.items():
        hit = next(((w, min(n for n in names if w in n)) for w in works if any(w in n for n in names)), None)
        if hit:
            brute[ident] = hit
    assert got == brute


def english(spark, *rows):
    return spark.createDataFrame(list(rows), "id string, title string, summary string, language string, seq int")


def test_names_that_all_begin_alike_meet_few_assets(spark):
    names = [f"长风起处第{i:05d}部" for i in range(10_000)]
    items = spark.createDataFrame([(str(i), f"《{name}》", "") for i, name in enumerate(names)], "id string, title string, summary string")
    assets = spark.createDataFrame([(f"海报 {name} 终版",) for name in names[::10]] + [("长风起处",)], "asset string")
    pieces = PK.grams_of(F.col("asset"), F.sequence(F.lit(1), F.lit(PK.ANCHOR)))
    grams = assets.select("asset", F.explode(pieces).alias("anchor"))
    wanted = spark.createDataFrame([(name,) for name in names], "name string")
    met = PK.rarest_anchors(wanted, grams).join(grams, "anchor").count()
    assert met < 20 * len(names)
    got = {r.id: r.asset for r in PK.asset_match(items, assets, CHINESE).collect()}
    assert got == {str(i): f"海报 {names[i]} 终版" for i in range(0, 10_000, 10)}


def test_cached_translation_is_attached_and_the_original_kept(spark):
    items = english(spark, ("1", "Harbour Film Week Names Its Prizes", "Three prizes tonight.", "en", 1), ("2", "Other", "", "en", 2), ("3", "中文", "x", "zh", 3))
    key = hashlib.sha256((TR.MODEL + "\0Harbour Film Week Names Its Prizes\0Three prizes tonight.").encode()).hexdigest()
    cache = spark.createDataFrame([(key, "海港电影周揭晓奖项", "电影周今晚揭晓三个奖项。")], "key string, title string, summary string")
    out = TR.with_translation(items, cache)
    rows = {r.id: (r.title, r.original_title, r.translation_status) for r in out.collect()}
    assert rows == {"1": ("海港电影周揭晓奖项", "Harbour Film Week Names Its Prizes", "machine_translated"),
                    "2": ("Other", "Other", "original_english"), "3": ("中文", None, None)}
    assert {r.metric: r.value for r in TR.translation_stats(out).collect()} == {
        "translated_home_items": 1, "original_english_home_items": 1, "cache_hits": 1, "requests": 1}


def test_equal_texts_are_queued_once_within_the_budget(spark):
    items = english(spark, ("1", "A", "s", "en", 3), ("2", "A", "s", "en", 1), ("3", "B", "s", "en", 2), ("4", "C", "s", "en", 4))
    empty = spark.createDataFrame([], "key string, title string, summary string")
    queue = TR.translation_queue(TR.with_translation(items, empty), F.col("seq"), 2).orderBy("position").collect()
    assert [(r.original_title, r.position) for r in queue] == [("A", 1), ("B", 2)]


def test_translation_validity(spark):
    rows = [("English film", "A film", "English film", "A film"), ("English film", "A film", "中文标题", ""), ("t", "", "中文", ""),
            ("t", "s", "中" * 251, "x"), ("t", "s", "中文", "x" * 1501), ("t", "s", "中文", None), ("t", "s", "中文", "好")]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string")
    assert [r[0] for r in df.select(TR.is_valid(*[F.col(x) for x in "abcd"])).collect()] == [False, False, True, False, False, False, True]


def test_cache_of_another_version_or_model_is_absent(spark):
    path = new_workspace(spark, "cache")
    rows = [(1, TR.MODEL, "k1", "题", "s"), (2, TR.MODEL, "k2", "题", "s"), (1, "other", "k3", "题", "s")]
    spark.createDataFrame(rows, TR.CACHE_SCHEMA).write.json(path)
    assert [r.key for r in TR.read_cache(spark, path).collect()] == ["k1"]


MANIFESTS = "digest string, publish_date string"


def test_publishing_twice_adds_nothing(spark):
    log = PB.PublishLog(spark, new_workspace(spark, "published"))
    assert log.read().count() == 0
    manifests = spark.createDataFrame([("d1", "2026-09-23"), ("d1", "2026-09-23"), ("d2", "2026-09-24")], MANIFESTS)
    log.append(manifests.filter("digest = 'd1'"))
    log.append(manifests)
    log.append(manifests)
    assert sorted(tuple(r) for r in log.read().collect()) == [("d1", "2026-09-23"), ("d2", "2026-09-24")]


def test_publish_stream_logs_a_digest_once_whatever_is_replayed(spark):
    from pressloom.operators.ledger import Batch
    from pressloom.streaming.publish_stream import run_publish_stream

    landing, check = new_workspace(spark, "landing"), new_workspace(spark, "check")
    log = PB.PublishLog(spark, new_workspace(spark, "published"))

    def arrive(rows):
        spark.createDataFrame(rows, MANIFESTS).coalesce(1).write.mode("append").parquet(landing)
        return spark.readStream.schema(MANIFESTS).option("maxFilesPerTrigger", 1).parquet(landing)

    run_publish_stream(arrive([("d1", "2026-09-23"), ("d2", "2026-09-24")]), log, check)
    stream = arrive([("d2", "2026-09-30"), ("d3", "2026-09-25")])
    run_publish_stream(stream, log, check)
    want = [("d1", "2026-09-23"), ("d2", "2026-09-24"), ("d3", "2026-09-25")]
    assert sorted(tuple(r) for r in log.read().collect()) == want
    run_publish_stream(stream, log, new_workspace(spark, "check"))
    assert sorted(tuple(r) for r in log.read().collect()) == want
    batch = spark.createDataFrame([("d4", "2026-09-26")], MANIFESTS)
    for _ in range(2):
        log.append(batch, Batch("s", "id", 0))
    log.append(batch, Batch("s", "id", 1))
    assert [r.digest for r in log.read().collect()].count("d4") == 1


def test_two_publishers_of_one_digest_log_it_once(spark):
    log = PB.PublishLog(spark, new_workspace(spark, "published"))
    rival = PB.PublishLog(spark, log.table.path)
    publish = log.table.log.publish

    def late(version, manifest):
        log.table.log.publish = publish
        rival.append(spark.createDataFrame([("d1", "2026-09-20")], MANIFESTS))
        publish(version, manifest)

    log.table.log.publish = late
    log.append(spark.createDataFrame([("d1", "2026-09-23"), ("d2", "2026-09-24")], MANIFESTS))
    assert sorted(tuple(r) for r in log.read().collect()) == [("d1", "2026-09-20"), ("d2", "2026-09-24")]


def test_edition_index_skips_known_dates(spark):
    days = [dt.date(2026, 9, 23)] * 2 + [dt.date(2026, 9, 22)]
    editions = spark.createDataFrame([(d,) for d in days], "edition_date date")
    known = spark.createDataFrame([(dt.date(2026, 9, 22),)], "edition_date date")
    assert [tuple(r) for r in PB.edition_index(editions, known).collect()] == [("2026-09-23", "周三", 2)]


def test_read_back_comparison(spark):
    schema = "edition string, title string"
    expected = spark.createDataFrame([("d", "A & B"), ("d", "C")], schema)
    assert PB.edition_diff(expected, expected).count() == 0
    changed = spark.createDataFrame([("d", "A & B"), ("d", "X")], schema)
    assert sorted((r.title, r.side) for r in PB.edition_diff(expected, changed).collect()) == [("C", "missing"), ("X", "unexpected")]
    pages = spark.createDataFrame([("d", "<h1>A &amp; B</h1>")], "edition string, page string")
    assert [r.title for r in PB.missing_titles(expected, pages).collect()] == ["C"]
