"""Exact duplicates, centroid clustering and token alignment against brute force."""

import hashlib
import math
import random
import string
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pressloom.llm import centroid_clustering as CC
from pressloom.llm import exact_dedup as ED
from pressloom.llm import token_alignment as TA
from pressloom.llm.queries import vocabulary

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


# --- exact duplicates ----------------------------------------------------------------------


def exact(rows):
    """Sorted (key, keep, size, digest) of all rows, and how many of each group are kept."""
    groups = defaultdict(list)
    for key, text in rows:
        groups[(text or "").translate(LOWER)].append(key)
    out = []
    for text, keys in groups.items():
        known = [k for k in keys if k is not None]
        keep = max(known) if known else None
        out += [(k, keep, len(keys), hashlib.sha256(text.encode()).hexdigest()) for k in keys]
    return sorted(out, key=str), len(groups)


def checked(found, rows):
    want, groups = exact(rows)
    got = found.collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == want
    kept = [r for r in got if r.kept]
    assert len(kept) == groups and all(r.doc_id == r.keep_id for r in kept)
    assert len({r.text_sha256 for r in kept}) == groups


def texts_with_copies(n=600, seed=3):
    rng = random.Random(seed)
    pool = ["", None, "A", "a", "Ä", "ä", "É x", "é X", "x" * 50_000, "Straße", "STRASSE", "퟿\n \t"] + [
        " ".join(rng.choice("ab Ab É 1".split()) for _ in range(rng.randint(1, 6))) for _ in range(200)]
    rows = [(i, rng.choice(pool)) for i in range(n)]
    rows += [(10_000 + i, rng.choice(["The same text", "the SAME text"])) for i in range(300)]
    return rows + [(None, "a"), (None, "alone"), (None, "alone"), (7, "repeat"), (7, "repeat"), (7, "REPEAT")]


DOCS = "doc_id long, text string"


def test_exact_duplicates_match_brute_force(spark):
    rows = texts_with_copies()
    docs = spark.createDataFrame(rows, DOCS).withColumns({n: F.lit("clash") for n in ("keep_id", "hash", "bytes", "row", "key", "owner", "cell")})
    checked(ED.exact_groups(docs), rows)


def test_directory_splits_and_hot_keys_give_the_same_groups(spark):
    rows = texts_with_copies()
    docs = spark.createDataFrame(rows, DOCS)
    index = ED.build_index(docs, capacity=8, max_depth=8)
    assert index.depth > 3 and index.rows == len(rows)
    cells = index.directory.collect()
    for cell in cells:
        # A bucket is a range of cells: its local depth says how many leading bits they share.
        assert cell.cell >> (index.depth - cell.depth) << (index.depth - cell.depth) == cell.bucket
    load = Counter()
    buckets = {c.cell: (c.bucket, c.depth) for c in cells}
    for key in index.keys.collect():
        load[buckets[key.cell >> (8 - index.depth)]] += 1
    assert all(n <= 8 or depth == 8 for (_, depth), n in load.items())
    checked(ED.exact_groups(docs, index=index, hot_least=1), rows)


@pytest.mark.parametrize("hot_least", [0, 64])
def test_texts_of_one_hash_key_are_told_apart_by_their_bytes(spark, hot_least):
    rows = texts_with_copies(200)
    docs = spark.createDataFrame(rows, DOCS)
    index = ED.build_index(docs, capacity=2, max_depth=4, hashed=lambda text: F.shiftleft((F.length(text) % 5).cast("long"), 61))
    checked(ED.exact_groups(docs, index=index, hot_least=hot_least), rows)


def test_exact_duplicates_of_an_empty_table_and_text_keys(spark):
    assert ED.exact_groups(spark.createDataFrame([], DOCS)).count() == 0
    named = spark.createDataFrame([("b", "X"), ("a", "x")], "doc_id string, text string")
    assert {(r.doc_id, r.keep_id, r.kept) for r in ED.exact_groups(named).collect()} == {("b", "b", True), ("a", "b", False)}


# --- centroid clustering -------------------------------------------------------------------


def clustered(rows, k=16, rounds=3, dim=64):
    """vec_id -> (cluster, distance, cluster inertia, inertia, digest) in plain integers."""
    points = [(key, [math.floor(64 * x) for x in v]) for key, v in rows
              if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) and abs(64 * x) <= 1 << 27 for x in v)]
    start = sorted(points, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    centroids = [p for _, p in start]

    def nearest(p):
        return min((sum((x - y) ** 2 for x, y in zip(p, c)), i) for i, c in enumerate(centroids))

    for _ in range(rounds):
        held = defaultdict(list)
        for _, p in points:
            held[nearest(p)[1]].append(p)
        for i, own in held.items():
            centroids[i] = [sum(column) // len(own) for column in zip(*own)]
    placed = [(key, *reversed(nearest(p))) for key, p in points]
    inertia = Counter()
    for _, cluster, distance in placed:
        inertia[cluster] += distance
    return sorted(((key, c, d, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
                   for key, c, d in placed), key=str)


VECTORS = "vec_id long, embedding array<double>"


def vector_rows(n, seed, levels):
    rng = random.Random(seed)
    return [(i, [rng.choice(levels) for _ in range(64)]) for i in range(n)]


@pytest.mark.parametrize("levels", [[-1.0, 0.0, 1.0], [0.0, 0.02], [-0.3, 0.1, 0.11, 0.25, 2.5]])
def test_clusters_match_brute_force(spark, levels):
    rows = vector_rows(150, len(levels), levels)
    rows += [(None, rows[0][1]), (3, rows[3][1]), (3, rows[4][1]), (900, None), (901, [1.0] * 63), (902, [None] + [0.0] * 63),
             (903, [float("nan")] + [0.0] * 63), (904, [float("inf")] * 64), (905, [1e300] * 64), (906, [-2097152.0] * 64), (907, [])]
    df = spark.createDataFrame(rows, VECTORS).withColumns({n: F.lit(1) for n in ("cluster", "distance", "key", "point", "inertia")})
    got = sorted((tuple(r) for r in CC.clusters(df).collect()), key=str)
    assert got == clustered(rows)


def test_few_equal_and_no_vectors(spark):
    rows = vector_rows(5, 1, [0.0, 1.0]) + [(5 + i, [0.5] * 64) for i in range(30)]
    assert sorted((tuple(r) for r in CC.clusters(spark.createDataFrame(rows, VECTORS)).collect()), key=str) == clustered(rows)
    assert sorted((tuple(r) for r in CC.clusters(spark.createDataFrame(rows[:3], VECTORS)).collect()), key=str) == clustered(rows[:3])
    empty = CC.clusters(spark.createDataFrame([(1, None)], VECTORS))
    assert empty.count() == 0 and empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


@pytest.mark.parametrize("leaf", [1, 2, 5])
def test_tree_search_is_exact_with_ties(leaf):
    rng = np.random.default_rng(5)
    for dim, spread, k in ((2, 3, 40), (3, 2, 25), (8, 50, 60), (64, 30, 16), (1, 4, 9), (2, 3, 1)):
        centroids = rng.integers(-spread, spread + 1, (k, dim))
        vectors = rng.integers(-spread - 2, spread + 3, (500, dim))
        apart = ((vectors[:, None] - centroids[None]) ** 2).sum(-1)
        number, best = CC.VantageTree(centroids, leaf).nearest(vectors)
        assert (number == apart.argmin(1)).all() and (best == apart.min(1)).all()


def test_search_leaves_parts_of_the_tree_out(monkeypatch):
    rng = np.random.default_rng(6)
    centroids = rng.integers(-1000, 1001, (200, 2))
    vectors = rng.integers(-1000, 1001, (300, 2))
    asked = []
    plain = CC.squared
    tree = CC.VantageTree(centroids)
    monkeypatch.setattr(CC, "squared", lambda v, c: asked.append(len(v)) or plain(v, c))
    tree.nearest(vectors)
    assert sum(asked) < 0.25 * 200 * 300


# --- token alignment -----------------------------------------------------------------------

HARD = ["a", "\n", "\n\n", " ", "  ", "a  b", " a", "a ", "a \n b", "a\r\nb", "();\r\n x", "\t\tx y", "▁x ▁", "<s> </s> <|endoftext|>",
        "é b c", "日本語 テスト\n\n  x", "\x00 a", "a b　c", "\x1c x\x1c y", "it's I'm ' s", "<0x0A> x", "x   \n\n\n   y", "😀 😀😀\n😀",
        "a\x85 b", "x" * 300 + " " + "é" * 50, "word " * 3000, "over\nand over " * 40, "", None]


def whole_alignment(aligner, text):
    """Both libraries over the whole text: groups as text and a counter of linked id pairs."""
    if not text:
        return None
    a, b = aligner.a.encode(" " + text, add_special_tokens=False).ids, aligner.b.encode(text)
    own = [(list(aligner.bytes_a[i] for i in a)), list(aligner.bytes_b[i] for i in b)]
    if any(b"".join(x) != (" " + text).encode() for x in own):
        return None
    ranges = []
    for tokens in own:
        at, found = 0, []
        for token in tokens:
            found.append((at, at + len(token)))
            at += len(token)
        ranges.append(found)
    cuts, groups, i, j = sorted({e for _, e in ranges[0]} & {e for _, e in ranges[1]}), [], 0, 0
    for cut in cuts:
        left, right = [], []
        while i < len(a) and ranges[0][i][1] <= cut:
            left.append(a[i])
            i += 1
        while j < len(b) and ranges[1][j][1] <= cut:
            right.append(b[j])
            j += 1
        groups.append(",".join(map(str, left)) + "|" + ",".join(map(str, right)))
    links, first = Counter(), 0
    for x, (start, end) in zip(a, ranges[0]):
        while ranges[1][first][1] <= start:
            first += 1
        at = first
        while at < len(b) and ranges[1][at][0] < end:
            links[x, b[at]] += 1
            at += 1
    return len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()


def aligned_rows(aligner, rows):
    found = {i: whole_alignment(aligner, text) for i, (_, text) in enumerate(rows)}
    total, most = Counter(), Counter()
    for one in found.values():
        if one:
            total.update(one[3])
    for (_, b), n in total.items():
        most[b] = max(most[b], n)
    out = []
    for i, (key, _) in enumerate(rows):
        if found[i] is None:
            out.append((key, 0, 0, 0, 0, 0, 0, ""))
        else:
            n_a, n_b, n_groups, links, digest = found[i]
            out.append((key, n_a, n_b, n_groups, sum(links.values()), sum(n for (a, b), n in links.items() if total[a, b] == most[b]),
                        sum(n * total[p] for p, n in links.items()), digest))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def files():
    return vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")


@pytest.mark.parametrize("block", [TA.BLOCK, 400])
def test_alignment_matches_the_libraries_over_whole_texts(spark, files, block):
    rng = random.Random(2)
    letters = [" ", "\n", "\t", "\r", "a", "B", "'", "s", "1", "é", "▁", "日", "😀", " ", "\x1c", ";", "}", "<"]
    texts = HARD + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 30))) for _ in range(300)]
    rows = [(i, text) for i, text in enumerate(texts)] + [(None, "a null key"), (5, "again"), (5, "again")]
    docs = spark.createDataFrame(rows, DOCS).withColumns({n: F.lit("clash") for n in ("key", "n_best", "pair", "n", "count_sum")})
    out = TA.alignment(docs, *files, block=block)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted((tuple(r) for r in out.collect()), key=str) == aligned_rows(TA.SpanAligner(*files), rows)


def test_alignment_of_nothing(spark, files):
    assert TA.alignment(spark.createDataFrame([], DOCS), *files).count() == 0
    row = TA.alignment(spark.createDataFrame([(1, None)], DOCS), *files).first()
    assert tuple(row) == (1, 0, 0, 0, 0, 0, 0, "")


def test_cuts_and_links_of_a_plain_case():
    a, b = np.array([1, 2, 3]), np.array([7, 8, 9])
    cuts, to_a, to_b, links, pairs = TA.align(a, np.array([2, 5, 6]), b, np.array([3, 5, 6]))
    assert (cuts.tolist(), to_a.tolist(), to_b.tolist(), links.tolist()) == ([5, 6], [2, 3], [2, 3], [2, 3, 5, 6])
    assert [(p >> 32, p & 0xFFFFFFFF) for p in pairs.tolist()] == [(1, 7), (2, 7), (2, 8), (3, 9)]


def test_a_table_that_begins_anew_does_not_change_the_result(files, monkeypatch):
    monkeypatch.setattr(TA, "MEMO_SPANS", 3)
    aligner = TA.SpanAligner(*files)
    for text in ("one two three one two\nthree", "lengthy words, one two", "one two three", "▁ one"):
        numbers = aligner.numbers([TA.spans_of(text)])
        table = aligner.table
        want = whole_alignment(aligner, text)
        if want is None:
            assert not table.whole.values[numbers].all()
            continue
        shown = "".join(table.shown[n] for n in numbers)[:-1]
        assert hashlib.sha256(shown.encode()).hexdigest() == want[4]
        assert [int(table.columns[name].values[numbers].sum()) for name in TA.COLUMNS] == [*want[:3], want[3].total()]
    assert len(aligner.table.index) <= 8
