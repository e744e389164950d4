import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressloom.operators import store as S
from pressloom.operators.ledger import Batch, LedgerTable, StreamMismatch
from pressloom.operators.manifest import ManifestError, VersionTaken
from pressloom.schemas import RAW_ITEM
from pressloom.session import new_workspace
from tests.conftest import UTC, frame, stamp

T1, T2, T3 = (dt.datetime(2026, 9, 23, h, tzinfo=UTC) for h in (1, 2, 3))


def raw(spark, *rows):
    return S.observations(frame(spark, RAW_ITEM, [{"source_id": "s", "run_ts": T1, "arrival_seq": i, **r} for i, r in enumerate(rows)]))


def naive(value):
    return value.replace(tzinfo=None)


def test_last_non_empty_value_wins_and_blanks_do_not_erase(spark):
    url = "https://example.com/a"
    merged = S.merge_store(None, raw(
        spark,
        {"url": url, "title": "one", "image_url": "https://e.com/i.jpg", "published_at": "2026", "content_priority": 3, "is_repost": True},
        {"url": url, "title": "two", "image_url": " ", "published_at": None, "content_priority": 0, "is_repost": False},
    )).collect()
    assert len(merged) == 1
    row = merged[0]
    assert (row.title, row.image_url, row.published_at, row.content_priority, row.is_repost) == ("two", "https://e.com/i.jpg", "2026", 0, False)


def test_records_missing_from_a_later_fetch_stay(spark):
    store = S.merge_store(None, raw(spark, {"url": "https://example.com/a", "title": "a"}))
    merged = S.merge_store(store, raw(spark, {"url": "https://example.com/b", "title": "b"}))
    assert {r.url for r in merged.collect()} == {"https://example.com/a", "https://example.com/b"}


def test_first_arrival_keeps_even_empty_fields(spark):
    row = S.merge_store(None, raw(spark, {"url": "https://example.com/a", "title": "t", "summary": ""})).first()
    assert row.summary == ""


def test_replay_of_an_older_run_updates_values_but_not_last_seen(spark):
    url = "https://example.com/a"
    store = S.merge_store(None, raw(spark, {"url": url, "title": "new", "run_ts": T2}))
    row = S.merge_store(store, raw(spark, {"url": url, "title": "old run", "run_ts": T1})).first()
    assert row.title == "old run"
    assert row.last_seen_at == naive(T2) and row.first_seen_at == naive(T2)
    later = S.merge_store(store, raw(spark, {"url": url, "title": "x", "run_ts": T3})).first()
    assert later.last_seen_at == naive(T3) and later.first_seen_at == naive(T2)


def test_merging_the_same_records_again_changes_nothing(spark):
    rows = raw(spark, {"url": "https://example.com/a", "title": "a"}, {"url": "https://example.com/b", "title": "b", "filings": [("1",) + (None,) * 6]})
    once = S.merge_store(None, rows)
    assert sorted(map(str, once.collect())) == sorted(map(str, S.merge_store(once, rows).collect()))


def test_projection_drops_secrets_also_inside_lists(spark):
    schema = "source_id string, url string, title string, author_id string, post_id string, api_key string, sources array<struct<id:string,url:string,token:string>>"
    df = spark.createDataFrame([("s", "https://e.com/a", "t", "7", "9", "KEY", [("i", "https://e.com", "TOKEN")])], schema)
    out = S.project_news(df)
    row = out.first().asDict(recursive=True)
    assert "api_key" not in row and "TOKEN" not in str(row)
    assert (row["author_id"], row["post_id"], row["sources"][0]["id"]) == ("7", "9", "i")


def test_bad_identities(spark):
    rows = [("", "https://e.com"), ("s", ""), ("s", "ftp://e.com/x"), ("s", "https://u:p@e.com/x"), ("s", "https://e.com/x")]
    df = spark.createDataFrame(rows, "source_id string, url string")
    found = {(r.source_id, r.url): r.violation for r in S.incoming_violations(df).collect()}
    assert found == {("", "https://e.com"): "missing_source_id", ("s", ""): "missing_url",
                     ("s", "ftp://e.com/x"): "not_an_article_url", ("s", "https://u:p@e.com/x"): "credentials_in_url"}


def test_store_violations(spark):
    rows = [("s", "https://e.com/a", T1, T2), ("s", "https://e.com/a", T1, T2), ("s", "https://e.com/b", T2, T1), ("s", "https://e.com/c", None, T1)]
    df = spark.createDataFrame(rows, "source_id string, url string, first_seen_at timestamp, last_seen_at timestamp")
    assert sorted((r.url[-1], r.violation) for r in S.store_violations(df).collect()) == [
        ("a", "duplicate_key"), ("b", "last_before_first"), ("c", "missing_stamp")]


def test_snapshots_missing_is_empty_and_damaged_raises(spark):
    table = S.RecordStore(spark, new_workspace(spark, "store"), 8)
    assert table.latest() is None and table.read() is None
    assert table.merge(raw(spark, {"url": "https://e.com/a", "title": "a"})) == 0
    assert table.merge(raw(spark, {"url": "https://e.com/b", "title": "b"})) == 1
    assert table.read().count() == 2
    with pytest.raises(S.StoreError):
        table.merge(raw(spark, {"url": "https://u:p@e.com/c", "title": "c"}))
    assert table.latest() == 1
    assert {row.title for row in table.read().collect()} == {"a", "b"}
    fs = table.log._fs()
    gone = next(iter(table.folders(1).values()))
    fs.delete(table.log._path(gone), True)
    with pytest.raises(Exception):
        table.read().count()
    out = fs.create(table.log._path("_manifests/v=000000001.json"), True)
    out.write(bytearray(b'{"buckets": 8, "fold'))
    out.close()
    with pytest.raises(ManifestError):
        table.read()


def test_replay_of_a_batch_is_harmless(spark):
    table = S.RecordStore(spark, new_workspace(spark, "store"), 8)
    table.merge(raw(spark, {"url": "https://e.com/a", "title": "a"}), batch=("one", 0))
    batch = raw(spark, {"url": "https://e.com/a", "title": "b", "run_ts": T2})
    assert table.merge(batch, batch=("one", 1)) == 1
    first = table.read().collect()
    assert table.merge(batch, batch=("one", 1)) == 1
    assert table.read().collect() == first and table.latest() == 1
    assert table.merge(raw(spark, {"url": "https://e.com/c", "title": "c"})) == 2
    assert table.applied(2) == {"one": 1}


def test_new_checkpoint_on_a_filled_store_loses_nothing(spark):
    from pressloom.streaming.store_stream import run_store_stream

    table = S.RecordStore(spark, new_workspace(spark, "store"), 8)
    for name in "xyz":
        table.merge(raw(spark, {"url": f"https://e.com/{name}", "title": name}))
    landing = new_workspace(spark, "landing")
    row = {"url": "https://e.com/new", "title": "new", "source_id": "s", "run_ts": T2, "arrival_seq": 9}
    frame(spark, RAW_ITEM, [row]).coalesce(1).write.parquet(landing)
    for name in ("check", "check-again"):
        run_store_stream(spark.readStream.schema(RAW_ITEM).parquet(landing), table, new_workspace(spark, name))
        assert sorted(row.title for row in table.read().collect()) == ["new", "x", "y", "z"]
    assert table.latest() == 4


def test_stream_of_landing_files_matches_the_batch_merge(spark):
    from pressloom.streaming.store_stream import run_store_stream

    landing = new_workspace(spark, "landing")
    rows = [{"url": f"https://e.com/{i % 3}", "title": f"t{i}", "summary": "" if i % 2 else f"s{i}", "source_id": "s",
             "run_ts": T2 if i < 4 else T1, "arrival_seq": i} for i in range(8)]
    table = S.RecordStore(spark, new_workspace(spark, "store"), 8)
    check = new_workspace(spark, "check")
    for part in (rows[:3], rows[3:6], rows[6:]):
        frame(spark, RAW_ITEM, part).coalesce(1).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(RAW_ITEM).option("maxFilesPerTrigger", 1).parquet(landing)
        run_store_stream(stream, table, check)
    batch = S.merge_store(None, S.observations(frame(spark, RAW_ITEM, rows)))
    columns = ["url", "title", "summary", "first_seen_at", "last_seen_at"]
    assert sorted(table.read().select(*columns).collect()) == sorted(batch.select(*columns).collect())
    assert table.latest() == 2


def many(spark, names, run=T1):
    return raw(spark, *[{"url": f"https://e.com/{name}", "title": f"{name}", "run_ts": run} for name in names])


def test_only_touched_buckets_are_written(spark):
    table = S.RecordStore(spark, new_workspace(spark, "store"), 16)
    table.merge(many(spark, range(200)))
    first = table.folders(0)
    assert sorted(first) == list(range(16))
    table.merge(many(spark, [3, 500, 501], T2))
    second = table.folders(1)
    touched = {b for b in second if second[b] != first[b]}
    keys = spark.createDataFrame([("s", f"https://e.com/{n}") for n in (3, 500, 501)], "source_id string, url string")
    assert touched == {r[0] for r in keys.select(S.bucket_of(16)).collect()} and len(touched) < 4
    assert table.read().count() == 202 and table.read(0).count() == 200
    # A touched bucket meets its own stored rows only: nothing else is read.
    plan = table.read(buckets=touched)._jdf.queryExecution().optimizedPlan()
    assert plan.stats().sizeInBytes() < table.read()._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    assert {r.title for r in table.records_of(keys).collect()} == {"3", "500", "501"}


def test_bucketed_merges_equal_one_merge(spark):
    rows = [{"url": f"https://e.com/{i % 7}", "title": f"t{i}" if i % 3 else " ", "summary": None if i % 2 else f"s{i}", "content_priority": i % 2 or None,
             "run_ts": (T1, T3, T2)[i % 3], "arrival_seq": i} for i in range(60)]
    table = S.RecordStore(spark, new_workspace(spark, "store"), 4)
    for part in (rows[:13], rows[13:14], rows[14:40], rows[40:]):
        table.merge(raw(spark, *part))
    columns = ["url", "title", "summary", "content_priority", "first_seen_at", "last_seen_at", "arrival_seq"]
    whole = S.merge_store(None, raw(spark, *rows))
    assert sorted(map(str, table.read().select(*columns).collect())) == sorted(map(str, whole.select(*columns).collect()))


def test_incoming_is_evaluated_once_and_faults_of_stored_rows_stop_the_merge(spark):
    table = S.RecordStore(spark, new_workspace(spark, "store"), 4)
    seen = spark.sparkContext.accumulator(0)

    def watch(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    fetched = many(spark, range(20))
    table.merge(fetched.mapInArrow(watch, fetched.schema))
    assert seen.value == 20
    # A store that something else damaged: the same rows twice in a bucket.
    folder = table.folders(0)[0]
    rows = spark.read.parquet(f"{table.path}/{folder}")
    key = rows.first()
    rows.limit(1).write.mode("append").parquet(f"{table.path}/{folder}")
    again = raw(spark, {"url": key.url, "title": "new"})
    with pytest.raises(S.StoreError, match="duplicate_key"):
        table.merge(again)
    assert table.latest() == 0
    other = S.RecordStore(spark, new_workspace(spark, "store"), 1)
    other.merge(many(spark, ["a"]).withColumn("last_seen_at", F.lit(None).cast("timestamp")), check=False)
    with pytest.raises(S.StoreError, match="missing_stamp"):
        other.merge(many(spark, ["b"]))


def test_second_of_two_writers_fails_and_can_merge_again(spark):
    table = S.RecordStore(spark, new_workspace(spark, "store"), 4)
    table.merge(many(spark, ["a"]))
    publish, rival = table.log.publish, S.RecordStore(spark, table.path)

    def late(version, manifest):
        table.log.publish = publish
        rival.merge(many(spark, ["b"]))
        publish(version, manifest)

    table.log.publish = late
    with pytest.raises(VersionTaken):
        table.merge(many(spark, ["c"]))
    assert {r.title for r in table.read().collect()} == {"a", "b"}
    table.merge(many(spark, ["c"]))
    assert {r.title for r in table.read().collect()} == {"a", "b", "c"}


def test_expired_versions_leave_the_newest_whole(spark):
    table = S.RecordStore(spark, new_workspace(spark, "store"), 8)
    for name in "abcdef":
        table.merge(many(spark, [name]))
    assert table.expire(keep=1) == [] or table.latest() == 5
    assert table.log.versions() == [5]
    assert {r.title for r in table.read().collect()} == set("abcdef")
    table.merge(many(spark, ["a"], T2))
    assert len(table.expire(keep=1)) == 1
    assert {r.title for r in table.read().collect()} == set("abcdef")


def test_new_fields_of_later_records_are_read_as_null_before(spark):
    table = S.RecordStore(spark, new_workspace(spark, "store"), 4)
    table.merge(many(spark, ["a", "b"]).select("source_id", "url", "title", "first_seen_at", "last_seen_at", "arrival_seq"))
    table.merge(many(spark, ["c"]).withColumn("author", F.lit("x")))
    assert {(r.title, r.author) for r in table.read().collect()} == {("a", None), ("b", None), ("c", "x")}


def test_filling_is_no_sighting_and_overwrites_nothing(spark):
    table = S.RecordStore(spark, new_workspace(spark, "store"), 4)
    assert table.fill(spark.createDataFrame([("s", "u", "i")], "source_id string, url string, image_url string")) is None
    table.merge(raw(spark, {"url": "https://e.com/a", "image_url": ""}, {"url": "https://e.com/b", "image_url": "old"}, {"url": "https://e.com/c", "image_url": "bad"}))
    values = [("s", f"https://e.com/{n}", f"new-{n}", v) for n, v in (("a", "v"), ("b", None), ("c", ""), ("absent", "v"))]
    table.fill(spark.createDataFrame(values, "source_id string, url string, image_url string, video_url string"), {"image_url": F.col("image_url") == "bad"})
    got = {r.url[-1]: (r.image_url, r.video_url, r.last_seen_at) for r in table.read().collect()}
    assert got == {"a": ("new-a", "v", naive(T1)), "b": ("old", None, naive(T1)), "c": ("new-c", None, naive(T1))}


def landed_counts(spark, landing, parts):
    schema = "source_id string, ts timestamp"
    for part in parts:
        spark.createDataFrame([(name, stamp("2026-09-22T17:00:00Z")) for name in part], schema).coalesce(1).write.mode("append").parquet(landing)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landing)


def test_counts_stay_true_under_a_second_checkpoint(spark):
    from pressloom.streaming import daily_counts as DC

    landing, sink, check = (new_workspace(spark, n) for n in ("landing", "sink", "check"))
    stream = landed_counts(spark, landing, ["aaab", "aab"])
    DC.run_daily_counts(stream, sink, check)

    def counts():
        return {r.source_id: r.arrivals for r in DC.read_daily_counts(spark, sink).collect()}

    assert counts() == {"a": 5, "b": 2}
    with pytest.raises(Exception, match="another checkpoint"):
        DC.run_daily_counts(stream, sink, new_workspace(spark, "check"))
    assert counts() == {"a": 5, "b": 2}
    # Another input under its own name adds to the same sink.
    other = landed_counts(spark, new_workspace(spark, "landing"), ["bbb"])
    DC.run_daily_counts(other, sink, new_workspace(spark, "check"), stream="other")
    assert counts() == {"a": 5, "b": 5}


def test_replayed_batches_and_compaction_keep_the_counts(spark):
    from pressloom.streaming import daily_counts as DC

    table = LedgerTable(spark, new_workspace(spark, "sink"), DC.COUNTS)
    day = spark.createDataFrame([("a", stamp("2026-09-22T17:00:00Z"))], "source_id string, ts timestamp")
    for number in (0, 1, 1, 0, 2):
        table.append(lambda _: DC.day_counts(day), Batch("s", "id", number))
    assert len(table.parts()) == 3
    with pytest.raises(StreamMismatch):
        table.append(lambda _: DC.day_counts(day), Batch("s", "new", 0))
    table.compact(DC.total_counts)
    assert len(table.parts()) == 1
    table.append(lambda _: DC.day_counts(day), Batch("s", "id", 2))
    assert [r.arrivals for r in DC.read_daily_counts(spark, table.path).collect()] == [3]
    assert len(table.expire(keep=1)) == 3
    assert [r.arrivals for r in DC.read_daily_counts(spark, table.path).collect()] == [3]


def test_appends_of_two_writers_both_count(spark):
    from pressloom.streaming import daily_counts as DC

    path = new_workspace(spark, "sink")
    one, two = LedgerTable(spark, path, DC.COUNTS), LedgerTable(spark, path, DC.COUNTS)
    day = spark.createDataFrame([("a", stamp("2026-09-22T17:00:00Z"))], "source_id string, ts timestamp")
    publish = one.log.publish

    def late(version, manifest):
        one.log.publish = publish
        two.append(lambda _: DC.day_counts(day), Batch("two", "b", 0))
        publish(version, manifest)

    one.log.publish = late
    one.append(lambda _: DC.day_counts(day), Batch("one", "a", 0))
    assert [r.arrivals for r in DC.read_daily_counts(spark, path).collect()] == [2]
    assert len(one.parts()) == 2


def test_daily_counts_stream(spark):
    from pressloom.streaming import daily_counts as DC

    landing, sink, check = (new_workspace(spark, n) for n in ("landing", "sink", "check"))
    schema = "source_id string, ts timestamp"
    first = [("a", stamp("2026-09-22T14:00:00Z")), ("a", stamp("2026-09-22T17:00:00Z"))]
    second = [("a", stamp("2026-09-22T18:00:00Z")), ("b", stamp("2026-09-22T15:59:00Z"))]
    for part in (first, second):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landing)
        DC.run_daily_counts(stream, sink, check)
    counts = {(r.source_id, r.civil_day.isoformat()): r.arrivals for r in DC.read_daily_counts(spark, sink).collect()}
    assert counts == {("a", "2026-09-22"): 1, ("a", "2026-09-23"): 2, ("b", "2026-09-22"): 1}
