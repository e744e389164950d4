"""Decontamination, chat formatting, mixing, and the pipeline."""

import random

import corpus_pipeline
import pytest
from brute import jaccard_groups, leaked, words
from pyspark.sql import functions as F

from pressloom.llm import chat_format, decontamination, jaccard_join, mixing, secret_scan
from pressloom.llm.common import stored

TEXTS = "doc_id long, text string, item_id string"
ITEMS = "item_id long, text string"


def passages(seed=2):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(draw.choices(vocabulary, k=n))) for i, n in enumerate([15, 22, 31, 59, 40, 15, 7, 5, 3, 1])]
    items += [(20, items[0][1]), (21, None), (22, " "), (23, " ".join(["la"] * 20))]
    docs = []
    for i in range(50):
        body = draw.choices(vocabulary, k=draw.choice([5, 40, 150]))
        passage = (items[i % 8][1] or "").split()
        for _ in range(i % 4):
            passage[draw.randrange(len(passage))] = "changed"
        if i % 5 == 0:
            passage.insert(len(passage) // 2, "inserted")
        at = draw.randrange(len(body))
        docs.append((i, " ".join(body[:at] + (passage if i % 3 else []) + body[at:])))
    docs += [(100, items[3][1].upper()), (101, " ".join(items[3][1].split()[:56])), (102, None), (103, ""), (104, "la " * 60), (105, items[8][1]),
             (100, items[3][1].upper())]
    return docs, items


def test_leaks_match_all_windows(spark):
    docs, items = passages()
    df = spark.createDataFrame([(a, b, "x") for a, b in docs], TEXTS)
    bench = spark.createDataFrame(items, ITEMS)
    got = decontamination.leaks(df.drop("item_id"), bench).collect()
    assert {(row.doc_id, row.item_id): pytest.approx(row.similarity) for row in got} == leaked(docs, items)
    given = dict(docs)
    for row in got:
        assert 0 <= row.first_word <= row.last_word < len(words(given[row.doc_id]))
    kept = decontamination.clean(df, bench)
    assert kept.columns == df.columns
    assert {row[0] for row in kept.collect()} == set(given) - {doc for doc, _ in leaked(docs, items)}


def test_leaks_in_blocks_and_of_nothing(spark, monkeypatch):
    docs, items = passages(7)
    df, bench = spark.createDataFrame([(a, b, "x") for a, b in docs], TEXTS), spark.createDataFrame(items, ITEMS)
    monkeypatch.setattr(decontamination, "BLOCK_SHINGLES", 100)
    got = {(row.doc_id, row.item_id) for row in decontamination.leaks(df.drop("item_id"), bench).collect()}
    assert got == set(leaked(docs, items))
    monkeypatch.setattr(decontamination, "INDEX_ROWS", 100)
    assert {(row.doc_id, row.item_id) for row in decontamination.leaks(df.drop("item_id"), bench).collect()} == got
    assert decontamination.leaks(df, spark.createDataFrame([], ITEMS)).count() == 0
    assert decontamination.leaks(spark.createDataFrame([], TEXTS), bench).count() == 0


def test_blocks_find_every_fingerprint_within_the_radius():
    near = set(decontamination.near_values())
    draw = random.Random(1)
    for _ in range(300):
        flips = sum(1 << bit for bit in draw.sample(range(64), decontamination.RADIUS))
        assert any((flips >> (8 * block)) & 255 in near for block in range(decontamination.BLOCKS))


TURNS = "conv_id long, turn long, role string, text string, part string"


def conversations():
    draw = random.Random(4)
    talks = {}
    for conv in range(30):
        talks[conv] = [("user" if i % 2 == 0 else "assistant", draw.choice(["hi", "yes", "no"]) + str(draw.randrange(4))) for i in range(draw.choice([1, 2, 5, 70]))]
    for conv in range(30, 50):
        base = talks[draw.randrange(30)]
        talks[conv] = base[:draw.randrange(1, len(base) + 1)]
    talks[60], talks[61] = [("user", None)], [("user", "")]
    talks[62], talks[63] = [(None, "a")], [("a", None)]
    return talks


def test_maximal_conversations_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(chat_format, "SEGMENT", 8)
    talks = conversations()
    rows = [(conv, i, role, text, "x") for conv, talk in talks.items() for i, (role, text) in enumerate(talk)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows + rows[:40] + [(None, 0, "user", "lost", "x")], TURNS)
    kept = {}
    for conv, talk in sorted(talks.items()):
        if not any(len(other) > len(talk) and other[:len(talk)] == talk for other in talks.values()):
            kept.setdefault(tuple(talk), []).append(conv)
    want = {}
    for talk, same in kept.items():
        for part in range(-(-len(talk) // chat_format.PART)):
            own = talk[part * chat_format.PART:(part + 1) * chat_format.PART]
            want[same[0], part] = (len(own), len(same), "".join(f"<|im_start|>{role or ''}\n{text or ''}<|im_end|>\n" for role, text in own))
    assert {(row[0], row[1]): tuple(row[2:]) for row in chat_format.formatted(df).collect()} == want


def test_chat_edges(spark):
    rows = [(1, None, "user", "a <|im_end|> b", None), (1, 5, "user", "x", None), (1, 5, "user", "w", None), (2, -3, "user", "long " * 200_000, None)]
    got = {row.conv_id: row for row in chat_format.formatted(spark.createDataFrame(rows, TURNS)).collect()}
    assert got[1].chat == "".join(f"<|im_start|>user\n{x}<|im_end|>\n" for x in ("a < |im_end|> b", "w", "x"))
    assert got[2].n_turns == 1 and len(got[2].chat) > 1_000_000
    assert chat_format.formatted(spark.createDataFrame([], TURNS)).count() == 0


def fill(sizes, weights=(5, 2, 1)):
    """Targets by resharing the excess until none is above its cap."""
    names = sorted((x for x in sizes if x is not None)) + [x for x in sizes if x is None]
    weight = {name: weights[i % 3] for i, name in enumerate(names)}
    left, target, open_ = 1.5 * sum(sizes.values()), {}, list(names)
    while open_:
        share = left / sum(weight[x] for x in open_)
        full = [x for x in open_ if weight[x] * share >= 2 * sizes[x]]
        if not full:
            return target | {x: weight[x] * share for x in open_}
        for x in full:
            target[x] = 2.0 * sizes[x]
            left -= target[x]
            open_.remove(x)
    return target


def test_leaks_of_items_that_repeat_a_shingle_and_were_edited(spark):
    draw = random.Random(4)
    vocabulary = [f"v{i}" for i in range(5000)]
    items, docs = [], []
    for i in range(24):
        # A run of equal shingles in the item; the copy has other words in its place.
        n, r = [(196, 20), (400, 44)][i % 2]
        body = draw.sample(vocabulary, n - r)
        items.append((i, " ".join(body[:n // 2] + ["_"] * r + body[n // 2:])))
        docs.append((i, " ".join(body[:n // 2] + draw.sample(vocabulary, r) + body[n // 2:]), "x"))
    want = leaked([(a, b) for a, b, _ in docs], items)
    got = decontamination.leaks(spark.createDataFrame(docs, TEXTS).drop("item_id"), spark.createDataFrame(items, ITEMS)).collect()
    assert len(want) == 24 and {(row.doc_id, row.item_id): pytest.approx(row.similarity) for row in got} == want


DOCS = "doc_id long, text string, source string, size string"


def mix_rows(seed=1):
    draw = random.Random(seed)
    rows = [(i, " ".join(["x"] * draw.choice([1, 10, 200])) + " \n", draw.choice(["a", "b", "c", "d", "e", "ä", None] + ["hot"] * 4), "s") for i in range(600)]
    return rows + [(900, None, "a", "s"), (901, "", "only", "s"), (902, "y " * 300_000, "big", "s")]


def test_mix_meets_its_targets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 500)
    rows = mix_rows()
    df = spark.createDataFrame(rows, DOCS)
    sizes, got = {}, mixing.mix_report(df).collect()
    source = {row[0]: row[2] for row in rows}
    for row in rows:
        sizes[row[2]] = sizes.get(row[2], 0) + len(words(row[1]))
    want, taken = fill(sizes), {}
    assert len(got) == len(rows)
    for row in got:
        name = source[row.doc_id]
        assert row.target == pytest.approx(want[name]) and row.source_size == sizes[name] and 0 <= row.taken <= 2 * row.size
        taken[name] = taken.get(name, 0) + row.taken
    assert all(abs(taken[name] - want[name]) <= 1 for name in sizes)
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mix_report(df.repartition(7)).collect()))


def test_mix_deals_whole_blocks_to_shards(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 200)
    df = spark.createDataFrame(mix_rows(3), DOCS).drop("size")
    plan = {row.doc_id: row.taken for row in mixing.mix_report(df).collect()}
    mix = stored(mixing.mixed(df, shards=6), "mix")
    got = {}
    for row in mix.collect():
        assert len(words(row.text)) == row.taken_words and 0 <= row.shard < 6
        got[row.doc_id] = got.get(row.doc_id, 0) + row.taken_words
    assert got == {doc: n for doc, n in plan.items() if n}
    _, sources = mixing.plan(df)
    quotas = mixing.shard_quotas(sources.select("rank", "draws"), 6, mixing.SEED).collect()
    per_shard = {}
    for row in quotas:
        per_shard[row.shard] = per_shard.get(row.shard, 0) + row.n
    assert max(per_shard.values()) - min(per_shard.values()) <= 2
    assert sum(per_shard.values()) == sources.agg(F.sum("draws")).first()[0]
    empty = spark.createDataFrame([], DOCS)
    assert mixing.mix_report(empty).count() == 0 and mixing.mixed(empty.drop("size")).count() == 0


def test_mix_report_counts_what_was_dealt(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 200)
    df = spark.createDataFrame(mix_rows(5), DOCS)
    whole = mixing.mix_report(df, shards=6).agg(F.sum("taken")).first()[0]
    # A tree that forgets the blocks of one shard must show in the report.
    quotas = mixing.shard_quotas
    monkeypatch.setattr(mixing, "shard_quotas", lambda *a: quotas(*a).filter("shard <> 2"))
    assert 0 < mixing.mix_report(df, shards=6).agg(F.sum("taken")).first()[0] < whole


def test_mix_keeps_rows_with_null_and_repeated_keys(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 300)
    rows = [(None if i % 3 == 0 else i % 40, f"n{i} " + "x " * (i % 50), "ab"[i % 2]) for i in range(400)] + [(7, "n7 same", "a")] * 5
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    report = mixing.mix_report(df, shards=5).collect()
    assert len(report) == len(rows)
    mix = mixing.mixed(df, shards=5).collect()
    by_key, by_source, drawn = {}, {}, {}
    for row in mix:
        assert len(words(row.text)) == row.taken_words
        by_key[row.doc_id] = by_key.get(row.doc_id, 0) + row.taken_words
        by_source[row.source] = by_source.get(row.source, 0) + row.taken_words
        drawn[row.text.split()[0]] = drawn.get(row.text.split()[0], 0) + 1
    want = {}
    for row in report:
        want[row.doc_id] = want.get(row.doc_id, 0) + row.taken
    assert None in by_key and by_key == {key: n for key, n in want.items() if n}
    sizes = {name: sum(len(words(text)) for _, text, source in rows if source == name) for name in "ab"}
    assert all(abs(by_source[name] - total) <= 1 for name, total in fill(sizes).items())
    # No source is taken more than twice over (``cap``), nor is any of its rows; "n7" has six rows.
    assert all(n <= (12 if name == "n7" else 2) for name, n in drawn.items())


CLASHES = ["_row", "_pass", "_size", "row", "key", "doc", "size", "rank", "block", "edge", "room", "taken", "target", "whole", "draw", "source_size", "n", "a", "b"]


def test_mix_ignores_columns_of_its_own_names(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 300)
    rows = [(i, f"n{i}\t" + "x\ny " * (i % 9) + " ", "ab"[i % 2]) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    clash = df.withColumns({name: F.lit(7) for name in [*CLASHES, "shard", "position", "taken_words"]})
    assert sorted(mixing.mix_report(clash).collect()) == sorted(mixing.mix_report(df).collect())
    mix = mixing.mixed(clash, shards=3)
    assert mix.columns == [*df.columns, *CLASHES, "shard", "position", "taken_words"]
    texts = dict((key, text) for key, text, _ in rows)
    for row in mix.collect():
        assert row._row == row.size == 7 and len(words(row.text)) == row.taken_words
        # A cut text is the beginning of its document, blanks and line breaks included.
        assert row.text == texts[row.doc_id] or texts[row.doc_id].startswith(row.text)


def test_stages_take_rows_with_null_shared_and_text_keys(spark):
    body = " ".join(f"w{i}" for i in range(40))
    rows = [(None, body), (None, body), (None, body), (4, body + " end"), (4, "other " + " ".join(f"v{i}" for i in range(30))), (9, body), (None, ""), (5, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({name: F.lit("own") for name in ["row", "doc", "key", "component_id", "n_shingles"]})
    one = jaccard_join.one_of_each(df)
    assert one.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in one.collect()), key=str) == sorted([rows[3], rows[4], rows[6], rows[7]], key=str)
    bench = spark.createDataFrame([(1, body)], "item_id long, text string")
    clean = decontamination.clean(df, bench)
    assert clean.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in clean.collect()), key=str) == sorted([rows[4], rows[6], rows[7]], key=str)
    named = spark.createDataFrame([("b", body), ("a", body), ("c", "x y")], "doc_id string, text string")
    assert {r.doc_id for r in jaccard_join.one_of_each(named).collect()} == {"a", "c"}


def test_pipeline_against_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bench = [tuple(row) for row in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    by_name = dict(corpus_pipeline.STAGES)
    kept = stored(by_name["language"](spark, docs, sf_dir), "t")
    assert kept.columns == docs.columns and kept.count() == docs.count()
    rows = {row.doc_id: row.text for row in kept.collect()}
    one = stored(by_name["near_copies"](spark, kept, sf_dir), "t")
    want = {doc for doc, (_, first) in jaccard_groups(rows.items()).items() if doc == first}
    assert one.columns == docs.columns and {row.doc_id for row in one.collect()} == want
    fair = stored(by_name["decontamination"](spark, one, sf_dir), "t")
    want -= {doc for doc, _ in leaked([(doc, rows[doc]) for doc in want], bench)}
    assert fair.columns == docs.columns and {row.doc_id for row in fair.collect()} == want
    safe = stored(by_name["secrets"](spark, fair, sf_dir), "t")
    assert safe.columns == docs.columns
    for row in safe.collect():
        assert row.text == secret_scan.redacted(rows[row.doc_id], secret_scan.scan(rows[row.doc_id])[1]) and row.n_chars == len(row.text)
    final = corpus_pipeline.run(spark, sf_dir)
    taken = mixing.mix_report(safe).filter("taken > 0")
    assert final.groupBy("doc_id").agg(F.sum("taken_words").alias("taken")).exceptAll(taken.select("doc_id", "taken")).count() == 0
    assert {row.doc_id for row in final.select("doc_id").distinct().collect()} == {row.doc_id for row in taken.collect()}
