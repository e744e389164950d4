"""Alignment of two tokenizers' tokens over the same bytes (operator 13).

Both token lists are turned into cumulative byte ends, each with a dictionary from end to index. The intersection of
the two key sets, sorted, gives the cuts; between two cuts the id lists are sliced into a group, and the links of a
group are the pairs of its tokens whose byte ranges overlap: each stretch between two neighbouring ends of either
list lies in one token of both, so the stretches of a slice are its links.

A text is aligned span by span: it is parted before every blank or line break that follows a visible character. The
byte-level tokenizer always ends a token there, and the piece tokenizer does so because none of its pieces holds a
blank or line break behind another character (checked when it is loaded), so both have a cut at every span
start. Spans repeat: those that a worker has not met yet are aligned together, end to end on one byte axis, and kept
in a bounded table of the worker.

Texts are encoded once. What later steps need of a batch is written as one packed row: its spans by number, and the
linked pairs of each different span. Counts of id pairs are gathered corpus-wide from these rows: sums per task,
then a Spark aggregate. The table of pairs is read back in blocks of ``BLOCK`` rows, each broadcast by itself (the bound
of a broadcast, and of what the driver holds); the packed rows pass all blocks one after the other, and ``n_best``
and ``count_sum`` add up. The number of pairs never exceeds the product of the vocabularies, however large the corpus.

Defined results: a text that is null, empty, or not given back byte by byte by both tokenizers has no tokens: zeros
and an empty ``groups_sha256``; texts are aligned whole, whatever their length; repeated rows count each by
itself; a null key keeps its row; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pressloom.llm.common import prepare, stored
from pressloom.llm.token_counts import byte_letters

# Id pairs in a broadcast block.
BLOCK = 1 << 21
# Bounds of a worker's table: spans, and links of its spans. It begins anew where a batch finds it beyond them.
MEMO_SPANS = 1 << 18
MEMO_LINKS = 1 << 22
SPAN_START = re.compile(r"(?<=\S)(?=[ \n])")
SPACE_MARK = "▁"
COLUMNS = ["n_a", "n_b", "n_groups", "n_links"]
PACKED = ["sizes", "spans", "links", "pairs"]


def pair_id(a: np.ndarray, b: np.ndarray, bits: int = 32) -> np.ndarray:
    return a << bits | b


def spans_of(text: str | None) -> list[str]:
    """The spans of blank plus text; none for a text that is null or empty."""
    return SPAN_START.split(" " + text) if text else []


def counts_per(ends: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """How many of the sorted ``ends`` lie in each stretch up to the sorted ``limits``."""
    return np.diff(np.searchsorted(ends, limits, side="right"), prepend=0)


def align(a: np.ndarray, ends_a: np.ndarray, b: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Two token lists over the same bytes: the cuts, how far each list has come at them, link ends and linked pairs."""
    index_a = dict(zip(ends_a.tolist(), range(1, len(a) + 1)))
    index_b = dict(zip(ends_b.tolist(), range(1, len(b) + 1)))
    cuts = sorted(index_a.keys() & index_b.keys())
    to_a = np.fromiter(map(index_a.__getitem__, cuts), np.int64, len(cuts))
    to_b = np.fromiter(map(index_b.__getitem__, cuts), np.int64, len(cuts))
    # Two sorted runs: a stable sort merges them.
    links = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")
    links = links[np.concatenate([[True], links[1:] != links[:-1]])] if len(links) else links
    pairs = pair_id(a[np.searchsorted(ends_a, links)], b[np.searchsorted(ends_b, links)])
    return np.array(cuts, dtype=np.int64), to_a, to_b, links, pairs


class Grown:
    """An array that rows are appended to."""

    def __init__(self, kind):
        self.room, self.n = np.zeros(1024, kind), 0

    def add(self, values: np.ndarray) -> None:
        if self.n + len(values) > len(self.room):
            self.room = np.concatenate([self.room[:self.n], np.zeros(max(self.n, 2 * len(values)), self.room.dtype)])
        self.room[self.n:self.n + len(values)] = values
        self.n += len(values)

    def __array__(self, dtype=None, copy=None):
        return self.room[:self.n]

    @property
    def values(self) -> np.ndarray:
        return self.room[:self.n]


class SpanTable:
    """Alignments of spans by number: counts, whether the span is given back, its linked pairs, its groups as text."""

    def __init__(self):
        self.index: dict[str, int] = {}
        self.columns = {name: Grown(np.int64) for name in COLUMNS}
        self.whole = Grown(bool)
        self.pairs = Grown(np.int64)
        self.shown: list[str] = []
        # Where the pairs of each span end.
        self.stops = Grown(np.int64)


class SpanAligner:
    """Both vocabularies, and a table of aligned spans."""

    def __init__(self, byte_file: str, piece_file: str):
        # One thread for each task: the tasks share the machine already.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_file)
        self.a.encode_special_tokens = True
        value = {letter: byte for byte, letter in enumerate(byte_letters())}
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(value[x] for x in token) if all(x in value for x in token) else token.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE_MARK, " ").encode()
                        for i, p in enumerate(pieces)]
        if any(re.search(r"[^ ] |[^\n]\n", p.replace(SPACE_MARK, " ")) for p in pieces):
            raise ValueError("a piece holds a blank behind another character")
        self.pure = self.b.encode("\n")[0]
        self.sizes_a = np.array([len(x) for x in self.bytes_a])
        self.sizes_b = np.array([len(x) for x in self.bytes_b])
        # Ids as text with what follows them: inside a list, at its end.
        self.texts = [f"{i}{mark}" for i in range(len(self.bytes_a)) for mark in ",|"]
        self.texts += [f"{i}{mark}" for i in range(len(self.bytes_b)) for mark in ",;"]
        self.table = SpanTable()

    def numbers(self, rows: list[list[str]]) -> np.ndarray:
        """The numbers of all spans of all rows, one after the other; unknown spans are aligned first.

        The table they refer to is ``self.table`` until the next call.
        """
        if len(self.table.index) > MEMO_SPANS or self.table.pairs.n > MEMO_LINKS:
            self.table = SpanTable()
        index = self.table.index
        fresh = list({span: None for span in chain.from_iterable(rows) if span not in index})
        if fresh:
            self._add(fresh)
        return np.fromiter(map(index.__getitem__, chain.from_iterable(rows)), np.int64)

    def encoded(self, spans: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        ids_a = [found.ids for found in self.a.encode_batch_fast(spans, add_special_tokens=False)]
        # The piece tokenizer puts a blank before every text that is not empty: it takes the place of a span's own first
        # blank, and before a line break, with which no piece joins it, its token is taken off again.
        ids_b = self.b.encode([span[1:] if span[0] == " " else span for span in spans], num_threads=1)
        for i in [i for i, span in enumerate(spans) if span[0] != " " or span == " "]:
            ids_b[i] = [self.pure] if spans[i] == " " else ids_b[i][1:] if ids_b[i][0] == self.pure else []
        return ids_a, ids_b

    def _add(self, spans: list[str]) -> None:
        table = self.table
        lists_a, lists_b = self.encoded(spans)
        kept = np.ones(len(spans), bool)
        a, n_a, ends_a = self.laid_out(lists_a, self.sizes_a)
        b, n_b, ends_b = self.laid_out(lists_b, self.sizes_b)
        whole = "".join(spans).encode("utf-8", "surrogatepass")
        if b"".join(map(self.bytes_a.__getitem__, a.tolist())) != whole or b"".join(map(self.bytes_b.__getitem__, b.tolist())) != whole:
            # Some span is not given back: which one, and then the others without it.
            kept = np.array([self.given_back(*found) for found in zip(spans, lists_a, lists_b)], bool)
            lists_a, lists_b = ([ids if ok else [] for ids, ok in zip(lists, kept)] for lists in (lists_a, lists_b))
            a, n_a, ends_a = self.laid_out(lists_a, self.sizes_a)
            b, n_b, ends_b = self.laid_out(lists_b, self.sizes_b)
        cuts, to_a, to_b, links, pairs = align(a, ends_a, b, ends_b)
        limits = np.concatenate([[0], ends_a])[np.cumsum(n_a)]
        n_links = counts_per(links, limits)
        for name, values in zip(COLUMNS, (n_a, n_b, counts_per(cuts, limits), n_links)):
            table.columns[name].add(values)
        table.whole.add(kept)
        table.stops.add(np.cumsum(n_links) + table.pairs.n)
        table.pairs.add(pairs)
        # Groups in order: the A ids of a group, then its B ids.
        order = np.zeros(len(a) + len(b), np.int64)
        at_a, at_b = np.arange(len(a)), np.arange(len(b))
        group_a, group_b = np.searchsorted(to_a, at_a, side="right"), np.searchsorted(to_b, at_b, side="right")
        order[at_a + np.concatenate([[0], to_b])[group_a]] = 2 * a + (at_a + 1 == to_a[group_a])
        order[at_b + to_a[group_b]] = 2 * (len(self.bytes_a) + b) + (at_b + 1 == to_b[group_b])
        texts = list(map(self.texts.__getitem__, order.tolist()))
        stops = np.cumsum(n_a + n_b).tolist()
        table.shown += ["".join(texts[start:stop]) for start, stop in zip([0, *stops], stops)]
        table.index.update(zip(spans, range(len(table.index), len(table.index) + len(spans))))

    @staticmethod
    def laid_out(lists: list[list[int]], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids end to end, how many each span has, and the byte where each token ends."""
        flat = np.array(list(chain.from_iterable(lists)), np.int64)
        return flat, np.array(list(map(len, lists)), np.int64), np.cumsum(sizes[flat])

    def given_back(self, span: str, a: list[int], b: list[int]) -> bool:
        whole = span.encode("utf-8", "surrogatepass")
        return b"".join(self.bytes_a[i] for i in a) == whole and b"".join(self.bytes_b[i] for i in b) == whole


@lru_cache(maxsize=1)
def loaded(byte_file: str, piece_file: str) -> SpanAligner:
    """The aligner of a worker, which later tasks of the worker use again."""
    return SpanAligner(byte_file, piece_file)


def summed(pairs: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
    """Each pair once, with the sum of its times."""
    order = np.argsort(pairs, kind="stable")
    pairs, times = pairs[order], times[order]
    first = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]])) if len(pairs) else np.empty(0, np.int64)
    sums = np.add.reduceat(times, first) if len(pairs) else times
    return pa.RecordBatch.from_pydict({"pair": pa.array(pairs[first], pa.int64()), "n": pa.array(sums, pa.int64())})


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of several ranges, one range after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(sizes.sum())


def packed(docs: DataFrame, byte_file: str, piece_file: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per batch of texts: keys, counts and digests by text, spans by number, linked pairs of each different span."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = loaded(byte_file, piece_file)
        narrow = max(len(aligner.bytes_a), len(aligner.bytes_b)) <= 1 << 16
        for batch in batches:
            rows = [spans_of(value) for value in batch.column("text").to_pylist()]
            numbers = aligner.numbers(rows)
            table = aligner.table
            sizes = np.array(list(map(len, rows)), np.int64)
            stops = np.cumsum(sizes)
            # A text with a span that is not given back has no tokens.
            lost = np.concatenate([[0], np.cumsum(~table.whole.values[numbers])])
            whole = (sizes > 0) & (lost[stops] == lost[stops - sizes])
            numbers, kept = numbers[np.repeat(whole, sizes)], np.where(whole, sizes, 0)
            ends = np.cumsum(kept)
            sums = {}
            for name in COLUMNS:
                total = np.concatenate([[0], np.cumsum(table.columns[name].values[numbers])])
                sums[name] = total[ends] - total[ends - kept]
            digests, shown = [], list(map(table.shown.__getitem__, numbers.tolist()))
            for end, n in zip(ends.tolist(), kept.tolist()):
                digests.append(hashlib.sha256("".join(shown[end - n:end])[:-1].encode()).hexdigest() if n else "")
            different, local = np.unique(numbers, return_inverse=True)
            links = table.columns["n_links"].values[different]
            pairs = table.pairs.values[ranges(table.stops.values[different] - links, links)]
            if narrow:
                pairs = pair_id(pairs >> 32, pairs & 0xFFFFFFFF, 16).astype("<u4")
            yield pa.RecordBatch.from_pydict({
                "keys": pa.array([batch.column("key").to_pylist()], pa.list_(batch.column("key").type)),
                **{name: pa.array([values], pa.list_(pa.int64())) for name, values in sums.items()},
                "groups_sha256": pa.array([digests], pa.list_(pa.string())),
                "sizes": pa.array([kept.astype("<i4").tobytes()], pa.binary()), "spans": pa.array([local.astype("<i4").tobytes()], pa.binary()),
                "links": pa.array([links.astype("<i4").tobytes()], pa.binary()), "pairs": pa.array([pairs.tobytes()], pa.binary()),
                "narrow": pa.array([narrow], pa.bool_())})

    kind = docs.schema[key].dataType.simpleString()
    columns = ", ".join(f"{name} array<bigint>" for name in COLUMNS)
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        run, f"keys array<{kind}>, {columns}, groups_sha256 array<string>, sizes binary, spans binary, links binary, pairs binary, narrow boolean")


def unpacked(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per packed row: spans by text, spans by number, links by span, and the linked pairs."""
    for i in range(batch.num_rows):
        sizes, spans, links, pairs = (batch.column(name)[i].as_buffer() for name in PACKED)
        narrow = batch.column("narrow")[i].as_py()
        ids = np.frombuffer(pairs, "<u4" if narrow else "<i8").astype(np.int64)
        yield (*(np.frombuffer(values, "<i4").astype(np.int64) for values in (sizes, spans, links)),
               pair_id(ids >> 16, ids & 0xFFFF) if narrow else ids)


def pair_counts(rows: DataFrame) -> DataFrame:
    """``a, b, n, best``: how many links hold each id pair, and whether that is the most of its B id."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded.cache_clear()
        for batch in batches:
            for _, spans, links, pairs in unpacked(batch):
                yield summed(pairs, np.repeat(np.bincount(spans, minlength=len(links)), links))

    parts = rows.select(*PACKED, "narrow").mapInArrow(counted, "pair long, n long")
    pairs = stored(parts.groupBy("pair").agg(F.sum("n").alias("n")).select(
        F.shiftright("pair", 32).cast("int").alias("a"), F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("b"), "n"), "token-pairs")
    # At most one row per A id meets in the window of a B id: the vocabulary bounds it.
    return pairs.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("b")))


def alignment(docs: DataFrame, byte_file: str, piece_file: str, key: str = "doc_id", text: str = "text",
              block: int = BLOCK) -> DataFrame:
    """A row per input row: key, numbers of tokens, groups and links, ``n_best``, ``count_sum``, ``groups_sha256``."""
    spark = docs.sparkSession
    prepare(spark)
    rows = stored(packed(docs, byte_file, piece_file, key, text), "token-spans")
    pairs = stored(pair_counts(rows), "token-pair-counts")
    blocks = max(1, -(-pairs.count() // block))
    part = F.pmod(F.xxhash64("a", "b"), F.lit(blocks))
    scores = ["n_best", "count_sum"]
    rows = rows.withColumns({name: F.transform("n_a", lambda _: F.lit(0).cast("long")) for name in scores})
    for place in range(blocks):
        held = pairs.filter(part == place).select("a", "b", "n", "best").toPandas()
        ids = pair_id(held["a"].to_numpy(np.int64), held["b"].to_numpy(np.int64))
        order = np.argsort(ids)
        shared = spark.sparkContext.broadcast((ids[order], held["n"].to_numpy(np.int64)[order], held["best"].to_numpy(bool)[order]))
        # After the last block the packed columns have done their part.
        kept = rows.columns if place < blocks - 1 else [name for name in rows.columns if name not in (*PACKED, "narrow")]
        rows = rows.mapInArrow(scored(shared, kept), rows.select(*kept).schema)
    shown = ["keys", *COLUMNS, *scores, "groups_sha256"]
    out = rows.select(F.inline(F.arrays_zip(*shown)))
    return out.select(F.col("keys").alias(key), *COLUMNS, *scores, "groups_sha256")


def scored(block, kept: list[str]):
    """Add what one block of pairs gives to ``n_best`` and ``count_sum`` of every text; returns the columns ``kept``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The vocabularies and the table of spans have done their part in this worker.
        loaded.cache_clear()
        ids, counts, best = block.value
        for batch in batches:
            found = {"n_best": [], "count_sum": []}
            for sizes, spans, links, pairs in unpacked(batch):
                at = np.minimum(np.searchsorted(ids, pairs), max(0, len(ids) - 1))
                known = ids[at] == pairs if len(ids) else np.zeros(len(pairs), bool)
                for name, values in (("n_best", best), ("count_sum", counts)):
                    held = np.where(known, values[at], 0) if len(ids) else np.zeros(len(pairs), np.int64)
                    by_span = np.diff(np.concatenate([[0], np.cumsum(held)])[np.cumsum(links)], prepend=0)
                    total = np.concatenate([[0], np.cumsum(by_span[spans])])
                    found[name].append(total[np.cumsum(sizes)] - total[np.cumsum(sizes) - sizes])
            columns = {name: batch.column(name) for name in kept}
            for name, values in found.items():
                before = batch.column(name).to_pylist()
                columns[name] = pa.array([list(x + np.array(y, np.int64)) for x, y in zip(values, before)], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_pydict(columns)

    return run
