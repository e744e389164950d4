"""Toxicity grades by cumulative-link ordinal regression on sparse text features (operator 10).

Grades follow the labels: 0 clean, 1 toxic in an otherwise good text, 2 toxic in a poor text. The model is
``P(grade <= k) = sigmoid(threshold_k - w . x)`` with ordered thresholds and one weight vector for all of
them. Features are the logarithms of the rates of words and of word beginnings (4 to 6 letters); those are
kept whose presence differs most between toxic and clean training texts. Fitting takes a bounded, hash-drawn sample of
labelled rows: each grade gives its share of ``SAMPLE`` rows, and a rare one up to ``SAMPLE / GRADES``, so that it is
learned from however rare it is; rows weigh as many labels as they stand for, so that the thresholds keep the
frequencies of all labels. Every text is then scored whole.

Defined results: null or text without letters has no features and gets the grade of the thresholds alone;
documents without a label are scored like any other; labels without a document, or with null grades, are
left out of training; a label repeated with both values counts as toxic; only where all labelled texts have one grade
is there no model, and severity is 0 everywhere; repeated rows give repeated rows; texts are scored whole, however
long; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressloom.llm.common import prepare, stored, with_text

GRADES = 3
# Bounds of fitting: labelled rows drawn in proportion (with those of rare grades at most twice as many), and features kept.
SAMPLE = 8000
FEATURES = 2048
LEAST_TEXTS = 4
LEAST_Z = 4.0
BEGINNINGS = (4, 5, 6)
# Words to which a feature's count is related.
PASSAGE = 200.0
RIDGE = 0.05
STEPS = 400
MEMO_WORDS = 1 << 18

WORDS = re.compile(r"[^\W\d_]+").findall


def features_of(word: str) -> list[str]:
    return ["w:" + word, *(f"b:{word[:n]}" for n in BEGINNINGS if len(word) > n)]


class Extractor:
    """The kept features that a text holds: their indices, ascending, and their values.

    A value is ``log(1 + PASSAGE * count / words)``, so that it tells how dense a feature is in the text.
    """

    def __init__(self, vocabulary: list[str]):
        self.index = {name: i for i, name in enumerate(vocabulary)}
        self.memo: dict[str, tuple[int, ...]] = {}

    def __call__(self, text: str) -> tuple[list[int], np.ndarray]:
        memo, found = self.memo, Counter()
        words = Counter(WORDS(text.lower()))
        for word, times in words.items():
            hits = memo.get(word)
            if hits is None:
                if len(memo) >= MEMO_WORDS:
                    memo.clear()
                hits = tuple(self.index[name] for name in features_of(word) if name in self.index)
                if len(word) <= 64:
                    memo[word] = hits
            for hit in hits:
                found[hit] += times
        places = sorted(found)
        counts = np.array([found[i] for i in places], dtype=np.float64)
        return places, np.log1p(PASSAGE * counts / max(1, words.total()))


def graded(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """A grade per labelled document."""
    whole = labels.filter(F.col("toxic").isNotNull() & F.col(key).isNotNull())
    by_key = whole.groupBy(key).agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    poor = F.coalesce(F.col("quality") == 0, F.lit(False))
    return by_key.select(key, F.when(F.col("toxic") <= 0, 0).when(poor, 2).otherwise(1).alias("grade"))


def training_texts(docs: DataFrame, labels: DataFrame, key: str, text: str) -> tuple[DataFrame, dict[int, float]]:
    """``grade, text`` of at most about ``2 * SAMPLE`` labelled documents, and the share drawn of each grade.

    Only the keys of the drawn labels are broadcast.
    """
    grades = graded(labels, key)
    counts = {row["grade"]: row["count"] for row in grades.groupBy("grade").count().collect()}
    whole = max(1, sum(counts.values()))
    rates = {grade: min(1.0, max(SAMPLE / GRADES / n, SAMPLE / whole)) for grade, n in counts.items()}
    rate = F.lit(0.0)
    for grade, share in rates.items():
        rate = F.when(F.col("grade") == grade, F.lit(share)).otherwise(rate)
    place = F.pmod(F.xxhash64(F.lit("toxicity sample"), F.col(key)), F.lit(1 << 30))
    drawn = grades.filter(place < rate * F.lit(float(1 << 30))).limit(3 * SAMPLE)
    # A repeated row is one example, so that the sample keeps its bound.
    found = docs.filter(F.col(text).isNotNull()).select(key, F.col(text).alias("text")).join(F.broadcast(drawn), key)
    return stored(found.dropDuplicates([key]).select("grade", "text"), "toxicity-sample"), rates


def choose_features(sample: DataFrame) -> list[str]:
    """The features whose share of toxic texts differs most from their share of clean ones."""
    totals = sample.agg(F.count(F.lit(1)), F.sum(F.when(F.col("grade") > 0, 1).otherwise(0))).first()
    n, toxic = totals[0], totals[1] or 0
    if not 0 < toxic < n:
        return []

    def texts_with(batches):
        for batch in batches:
            names, flags = [], []
            for grade, value in zip(batch.column("grade").to_pylist(), batch.column("text").to_pylist()):
                held = {name for word in set(WORDS(value.lower())) for name in features_of(word)}
                names += held
                flags += [int(grade > 0)] * len(held)
            yield pa.RecordBatch.from_pydict({"name": pa.array(names, pa.string()), "toxic": pa.array(flags, pa.int32())})

    counts = sample.select("grade", "text").mapInArrow(texts_with, "name string, toxic int").groupBy("name").agg(
        F.count(F.lit(1)).alias("texts"), F.sum("toxic").alias("hits"))
    share = toxic / n
    z = (F.col("hits") - F.col("texts") * share) / F.sqrt(F.col("texts") * F.lit(share * (1 - share)))
    kept = (counts.filter(F.col("texts") >= LEAST_TEXTS).withColumn("z", z).filter(F.abs("z") >= LEAST_Z)
            .orderBy(F.abs("z").desc(), "name").limit(FEATURES))
    return [row[0] for row in kept.select("name").collect()]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def fit(rows: list[tuple[list[int], list[float]]], grades: np.ndarray, features: int, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by gradient steps with momentum (Adam) on the penalised likelihood.

    ``counts`` says how many labels each row stands for, in relation to the mean.
    """
    x = np.zeros((len(rows), features), dtype=np.float32)
    for i, (places, values) in enumerate(rows):
        x[i, places] = values
    levels = np.arange(GRADES - 1)
    below = np.average(grades[:, None] <= levels, axis=0, weights=counts).clip(1e-4, 1 - 1e-4)
    start = np.log(below / (1 - below))
    # Thresholds as a first value and positive gaps keep their order.
    theta = np.concatenate([np.zeros(features), [start[0]], np.log(np.maximum(np.diff(start), 1e-2))])
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    rate, n = 0.1, len(rows)
    for step in range(1, STEPS + 1):
        weights, gaps = theta[:features], np.exp(theta[features + 1:])
        thresholds = theta[features] + np.concatenate([[0.0], np.cumsum(gaps)])
        score = (x @ weights.astype(np.float32)).astype(np.float64)
        upto = np.hstack([np.zeros((n, 1)), sigmoid(thresholds - score[:, None]), np.ones((n, 1))])
        slope = upto * (1 - upto)
        at = np.arange(n)
        likelihood = np.maximum(upto[at, grades + 1] - upto[at, grades], 1e-9)
        # Rows enter the gradient as often as they count.
        likelihood = likelihood / counts
        push = (slope[at, grades + 1] - slope[at, grades]) / likelihood
        by_threshold = np.zeros(GRADES - 1)
        for level in levels:
            by_threshold[level] = (slope[:, level + 1] * ((grades == level) / likelihood - (grades == level + 1) / likelihood)).sum()
        tail = np.cumsum(by_threshold[::-1])[::-1]
        gradient = np.concatenate([x.T @ push.astype(np.float32) + RIDGE * weights, [-tail[0]], -tail[1:] * gaps]) / n
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient ** 2
        theta -= rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-9)
    thresholds = theta[features] + np.concatenate([[0.0], np.cumsum(np.exp(theta[features + 1:]))])
    return theta[:features], thresholds


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> dict | None:
    """The fitted model: kept features, weights and thresholds; None where all labelled texts have one grade."""
    sample, rates = training_texts(docs, labels, key, text)
    if len(sample.select("grade").distinct().collect()) < 2:
        return None
    vocabulary = choose_features(sample)
    extractor = Extractor(vocabulary)

    def sparse(batches):
        for batch in batches:
            found = [extractor(value) for value in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "grade": batch.column("grade").cast(pa.int32()),
                "held": pa.array([held for held, _ in found], pa.list_(pa.int32())),
                "values": pa.array([values for _, values in found], pa.list_(pa.float64()))})

    # About 2 * SAMPLE rows at most of short index lists come to the driver.
    rows = sample.select("grade", "text").mapInArrow(sparse, "grade int, held array<int>, values array<double>").collect()
    rows.sort()
    grades = np.array([row[0] for row in rows])
    counts = np.array([1.0 / rates[grade] for grade in grades])
    weights, thresholds = fit([(row[1], row[2]) for row in rows], grades, len(vocabulary), counts / counts.mean())
    return {"vocabulary": vocabulary, "weights": weights, "thresholds": thresholds}


def severity(docs: DataFrame, model: dict | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Score every whole text: key, ``severity`` (expected grade), ``grade`` (likeliest), ``p_toxic`` and ``toxic``."""
    prepare(docs.sparkSession)
    extractor = Extractor(model["vocabulary"] if model else [])

    def score(texts: list[str]) -> dict:
        if model is None:
            chances = np.tile([1.0] + [0.0] * (GRADES - 1), (len(texts), 1))
        else:
            held = [extractor(value) for value in texts]
            totals = np.array([model["weights"][places] @ values if places else 0.0 for places, values in held], dtype=np.float64)
            upto = np.hstack([np.zeros((len(texts), 1)), sigmoid(model["thresholds"] - totals[:, None]), np.ones((len(texts), 1))])
            chances = np.diff(upto, axis=1)
        return {
            "severity": pa.array(chances @ np.arange(GRADES), pa.float64()),
            "grade": pa.array(chances.argmax(axis=1), pa.int32()),
            "p_toxic": pa.array(1.0 - chances[:, 0], pa.float64()),
            "toxic": pa.array(chances[:, 0] < 0.5, pa.bool_()),
        }

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(with_text(score, [key], text),
                                             f"`{key}` {kind}, severity double, grade int, p_toxic double, toxic boolean")
