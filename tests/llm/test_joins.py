"""Near-duplicate joins and the components below them."""

import random

import numpy as np
import pytest
from brute import Groups, jaccard_groups
from pyspark.sql import functions as F

from pressloom.llm.embedding_dedup import near_duplicates
from pressloom.llm.graph import components
from pressloom.llm.jaccard_join import groups, one_of_each, prefix_length
from pressloom.llm.shingles import shingle_sets, word_hashes

DOCS = "doc_id long, text string, source string, n long"


def texts(seed=1):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    line = " ".join(draw.choices(vocabulary, k=40))
    rows = []
    for i in range(60):
        base = draw.choices(vocabulary, k=draw.choice([3, 8, 30, 80]))
        for _ in range(draw.choice([1, 1, 2, 6])):
            copy = list(base)
            for _ in range(draw.choice([0, 0, 1, 2, 6])):
                copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
            rows.append(" ".join(copy) + (f"\n{line}" if i % 7 == 0 else ""))
    rows += [None, "", " \t\n", "One", "one", "TWO words", "two  words", "É é", "é é"]
    order = list(range(len(rows)))
    draw.shuffle(order)
    return [(key, rows[i]) for i, key in enumerate(order)]


def test_components_of_random_graphs(spark):
    draw = random.Random(5)
    edges = [(draw.randrange(150), draw.randrange(150)) for _ in range(90)] + [(i, i + 1) for i in range(200, 240)]
    edges += [(300, i) for i in range(301, 340)] + [(7, 7), (None, 3)]
    want = Groups()
    for a, b in edges:
        if a is not None:
            want.union(a, b)
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {x: want.find(x) for a, b in edges if a is not None and a != b for x in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_groups_match_brute_force(spark, seed):
    rows = texts(seed)
    got = {row[0]: (row[1], row[2]) for row in groups(spark.createDataFrame([(a, b, "x", 1) for a, b in rows], DOCS)).collect()}
    assert got == jaccard_groups(rows)


def test_jaccard_edges(spark):
    long = " ".join(f"v{i}" for i in range(60_000))
    rows = [(1, long), (2, long + " tail"), (3, None), (3, None), (None, "a b c"), (4, "a b c"), (5, "x" * 1_200_000), (6, "x" * 1_200_000)]
    df = spark.createDataFrame([(a, b, None, None) for a, b in rows], DOCS)
    got = sorted(map(tuple, groups(df).collect()), key=str)
    assert got == sorted([(1, 59_996, 1), (2, 59_997, 1), (3, 0, 3), (3, 0, 3), (None, 1, None), (4, 1, 4), (5, 1, 5), (6, 1, 5)], key=str)
    kept = one_of_each(df)
    assert kept.columns == df.columns
    # A row without a key is a copy like any other, and goes.
    assert sorted((row[0] for row in kept.collect()), key=str) == sorted([1, 3, 3, 4, 5], key=str)
    assert groups(spark.createDataFrame([], DOCS)).count() == 0


def test_prefix_length_is_enough():
    for n in range(1, 200):
        # Sets of one size that are similar share more tokens than lie outside a prefix.
        least = min(c for c in range(n + 1) if 100 * c >= 75 * (2 * n - c))
        assert least > n - prefix_length(n)


def test_word_hashes_do_not_depend_on_place():
    names = [b"a", b"ab", b"ba", b"a" * 70, b"\x00", b"\x00\x00"]
    found = word_hashes(names)
    assert len(set(found.tolist())) == len(names)
    assert (word_hashes([b"pad"] * 9 + names)[9:] == found).all()
    assert [len(s) for s in shingle_sets(["a b c d e f", "", None, "a"])] == [2, 0, 0, 1]


def vectors(seed=3):
    draw = np.random.default_rng(seed)
    rows = []
    for label in (0, 1, 2):
        for base in draw.standard_normal((25, 16)):
            for _ in range(int(draw.integers(1, 6))):
                rows.append((base + draw.normal(0, draw.choice([0.0, 0.1, 0.2, 0.3]), 16), label))
    crowd = draw.standard_normal(16)
    rows += [(crowd + draw.normal(0, 0.12, 16), 1) for _ in range(120)]
    return [(i, [float(np.float32(v)) for v in row], label) for i, (row, label) in enumerate(rows)]


def brute_vectors(rows, threshold=0.93):
    groups_, count = Groups(), {}
    for i, a, la in rows:
        groups_.find(i)
        count[i] = 0
        for j, b, lb in rows:
            if i != j and la == lb and np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b) >= threshold:
                count[i] += 1
                groups_.union(i, j)
    return {i: (count[i], groups_.find(i), groups_.find(i) == i) for i, _, _ in rows}


VECTORS = "vec_id long, embedding array<float>, label int"


def test_forest_matches_brute_force(spark, monkeypatch):
    from pressloom.llm import embedding_dedup

    # Small leaves and blocks, so that splits, spill and block pairs all occur.
    monkeypatch.setattr(embedding_dedup, "LEAF", 40)
    rows = vectors()
    got = {row[0]: tuple(row[1:]) for row in near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()}
    want = brute_vectors(rows)
    links = sum(n for n, _, _ in want.values())
    assert sum(n for n, _, _ in got.values()) >= 0.97 * links and all(got[i][0] <= want[i][0] for i in want)
    assert sum(got[i][1] == want[i][1] for i in want) >= 0.97 * len(want)


def test_forest_edges(spark):
    one = [1.0, 0.0, 2.0]
    rows = [(1, one, 0), (2, [2.0, 0.0, 4.0], 0), (3, one, None), (4, one, 1), (5, None, 0), (6, [0.0, 0.0, 0.0], 0), (7, [1.0, None, 2.0], 0),
            (8, [float("nan"), 0.0, 2.0], 0), (9, [float("inf"), 0.0, 2.0], 0), (10, [1.0, 0.0], 0), (11, one, 0), (None, one, 0), (12, [], 0)]
    out = near_duplicates(spark.createDataFrame(rows, VECTORS).withColumn("component_id", F.lit("x")))
    got = {row[0]: tuple(row[1:]) for row in out.collect()}
    linked = {1: (2, 1, True), 2: (2, 1, False), 11: (2, 1, False)}
    assert got == {**{i: (0, i, True) for i in range(1, 13)}, **linked, None: (0, None, False)}
    assert near_duplicates(spark.createDataFrame([], VECTORS)).count() == 0
