"""Language identification by multinomial naive Bayes over hashed character n-grams (operator 9).

A text becomes lower-cased letters with every run of other characters read as a gap; its 2-, 3- and 4-grams
around letters are hashed into a fixed number of buckets. Counts of a bounded, hash-drawn sample per language
give a matrix of log probabilities, which is broadcast (buckets times languages). A batch of texts becomes a sparse
matrix of counts (text, bucket), whose product with the log probabilities scores all of its texts at once.

Defined results: ``und`` with score 0 where the text is null or has no letter; ties go to the language that
comes first by code point; without any training row every text is ``und``; repeated rows give repeated rows; a null
key counts as the empty text and is not held out; an empty table gives an empty result; texts are read whole, however
long, with the same n-grams and sums as short ones; other columns are ignored in a report, and ``accepted`` returns
them as they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.llm.common import prepare, with_text

BUCKETS = 1 << 16
ORDERS = (2, 3, 4)
# At most about this many training texts are drawn of each language.
SAMPLE_PER_LANGUAGE = 4000
# Letters looked up at a time: bounds the memory that a batch or a very long text takes.
STEP = 1 << 18
UNKNOWN = "und"
MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], dtype=np.uint32)


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    """For each code point its lower-case letter, or 0 where it is no letter."""
    points = np.zeros(0x110000, dtype=np.uint32)
    for value in range(0x110000):
        letter = chr(value)
        if letter.isalpha():
            small = letter.lower()
            points[value] = ord(small) if len(small) == 1 else value
    return points


def letters_of(text: str) -> np.ndarray:
    """Lower-case letters of a text, with every run of other characters, and both ends, as one gap (0)."""
    letters = letter_table()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    letters = np.concatenate([[0], letters, [0]]).astype(np.uint32)
    return letters[np.concatenate([[True], (letters[1:] != 0) | (letters[:-1] != 0)])]


def grams_of(letters: np.ndarray, carried: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Start and bucket of all n-grams of each order, but for those inside the first ``carried`` letters.

    Texts may follow one another: two gaps side by side are the end of one and the beginning of the next, and no
    n-gram reaches across.
    """
    seams = np.concatenate([[0], np.cumsum((letters[1:] == 0) & (letters[:-1] == 0))])
    for order in ORDERS:
        starts = np.arange(max(0, carried - order + 1), len(letters) - order + 1)
        starts = starts[seams[starts] == seams[starts + order - 1]] if len(starts) else starts
        mixed = np.full(len(starts), order, dtype=np.uint32)
        for i in range(order):
            mixed = (mixed ^ letters[starts + i]) * MULTIPLIERS[i]
            mixed ^= mixed >> np.uint32(15)
        yield starts, (mixed % np.uint32(BUCKETS)).astype(np.int64)


def pieces_of(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """The letters of a batch in pieces of about ``STEP``: letters, the text of each, and how many were carried over.

    Short texts share a piece; a long one goes on in the next, after the letters its longest n-gram may need.
    """
    held, owners, size = [], [], 0
    for i, text in enumerate(texts):
        letters = letters_of(text)
        if len(letters) < 3:
            continue
        if size and size + len(letters) > STEP:
            yield np.concatenate(held), np.repeat(owners, [len(x) for x in held]), 0
            held, owners, size = [], [], 0
        if len(letters) > STEP:
            for at in range(0, len(letters), STEP):
                start = max(0, at - ORDERS[-1] + 1)
                yield letters[start:at + STEP], np.full(min(len(letters), at + STEP) - start, i), at - start
            continue
        held.append(letters)
        owners.append(i)
        size += len(letters)
    if held:
        yield np.concatenate(held), np.repeat(owners, [len(x) for x in held]), 0


def gram_counts(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The sparse count matrix of a batch, piece by piece: text, bucket, count, in order of text."""
    for letters, owners, carried in pieces_of(texts):
        found = list(grams_of(letters, carried))
        codes = np.concatenate([owners[starts] * BUCKETS + buckets for starts, buckets in found])
        codes, times = np.unique(codes, return_counts=True)
        yield codes // BUCKETS, codes % BUCKETS, times


def held_out(key: Column) -> Column:
    """Rows of the held-out fold: CRC-32 of the key as text, modulo 4, is 2."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def learn(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages in order of code point and their log probabilities (buckets x languages), learned outside the fold.

    The languages (one row each) and one count vector per language and sampled batch reach the driver; both are
    bounded by the number of languages and ``SAMPLE_PER_LANGUAGE``.
    """
    known = docs.filter(F.col(text).isNotNull() & F.col(lang).isNotNull() & ~held_out(F.col(key)))
    totals = {row[0]: row[1] for row in known.groupBy(lang).count().collect()}
    languages = sorted(totals)
    if not languages:
        return [], np.zeros((BUCKETS, 0))
    rate = F.lit(0.0)
    for name in languages:
        rate = F.when(F.col(lang) == name, F.lit(min(1.0, SAMPLE_PER_LANGUAGE / totals[name]))).otherwise(rate)
    drawn = F.pmod(F.xxhash64(F.lit("language sample"), F.col(key)), F.lit(1 << 30)) < rate * F.lit(float(1 << 30))
    sample = known.filter(drawn).select(F.col(lang).alias("lang"), F.col(text).alias("text"))

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, value in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                if name not in sums:
                    sums[name] = np.zeros(BUCKETS, dtype=np.int64)
                for _, buckets, times in gram_counts([value]):
                    np.add.at(sums[name], buckets, times)
        for name, vector in sums.items():
            hit = np.flatnonzero(vector)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([name] * len(hit), pa.string()),
                                              "bucket": pa.array(hit, pa.int64()), "n": pa.array(vector[hit], pa.int64())})

    counted = sample.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros((BUCKETS, len(languages)))
    got = counted.toPandas()
    counts[got["bucket"].to_numpy(np.int64), got["lang"].map({name: i for i, name in enumerate(languages)}).to_numpy(np.int64)] = got["n"]
    smoothed = counts + 0.5
    return languages, np.log(smoothed / smoothed.sum(axis=0))


def classify(texts: list[str], languages: list[str], log_probability: np.ndarray) -> tuple[list[str], np.ndarray]:
    """The likeliest language of each whole text and its posterior probability (equal priors)."""
    totals, seen = np.zeros((len(texts), len(languages))), np.zeros(len(texts), bool)
    for rows, buckets, times in gram_counts(texts) if languages else ():
        first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
        totals[rows[first]] += np.add.reduceat(log_probability[buckets] * times[:, None], first, axis=0)
        seen[rows[first]] = True
    if not languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    best = totals.argmax(axis=1)
    score = 1.0 / np.exp(totals - totals[np.arange(len(texts)), best][:, None]).sum(axis=1)
    return [languages[i] if ok else UNKNOWN for i, ok in zip(best, seen)], np.where(seen, score, 0.0)


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], keys: list[str], text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score`` to the columns ``keys`` of every row, read from the text alone."""
    prepare(docs.sparkSession)
    languages, matrix = model
    shared = docs.sparkSession.sparkContext.broadcast(matrix)

    def predict(texts: list[str]) -> dict:
        names, scores = classify(texts, languages, shared.value)
        return {"lang_pred": pa.array(names, pa.string()), "score": pa.array(scores, pa.float64())}

    fields = ", ".join(f"`{name}` {docs.schema[name].dataType.simpleString()}" for name in keys)
    columns = dict.fromkeys([*keys, text])
    return docs.select(*columns).mapInArrow(with_text(predict, keys, text), f"{fields}, lang_pred string, score double")


def language_report(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score``."""
    out = identify(docs, learn(docs, key, text, lang), [key], text)
    return out.select(key, held_out(F.col(key)).alias("held_out"), "lang_pred", "score")


def accepted(docs: DataFrame, least: float = 0.5, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows whose text has a language with at least ``least`` probability; columns as given."""
    # The caller's columns travel inside one column, so that no name of theirs meets a name of the result.
    given = docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("doc"), F.col(text).alias("text"))
    out = identify(given, learn(docs, key, text, lang), ["doc"], "text")
    return out.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select("doc.*")
