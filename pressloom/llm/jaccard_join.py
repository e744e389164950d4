"""N-gram Jaccard join by filtering under several global token orders (operator 6).

Two sets with Jaccard similarity ``t`` or more share a token among the first ``n - ceil(t n) + 1`` tokens of
each, whatever global order the tokens are put in. A pair is a candidate only if that holds under every one
of several orders; only candidates are verified, on whole sets.

1. ``profile``: size and 128-bit signature of every shingle set, and the tokens that are frequent within a run
   of texts. Equal sets fall together by signature; one representative of each goes on.
2. Tokens that are frequent in runs of texts and in at least ``1 / HOT_SHARE`` of all form a set of bounded size,
   which is broadcast. They come last in every order, so that a line shared by many texts pairs none of them.
3. ``occurrences``: all tokens are dealt to buckets by their leading bits, packed with the documents they
   occur in; a bucket counts texts per token. Tokens of a single text cannot be shared and go no further.
   What is left goes back to its document.
4. Each document orders its shared tokens, rare ones first, under two orders (fine rank of the count with the
   token; order of magnitude of the count with a second hash). Its unique tokens come before all of them, so most
   documents have no shared token in a prefix and leave here.
5. Star rounds: in each group of documents with a common prefix token, all are compared with one pivot; verified
   links are joined to components. A group of near copies is settled by these, without all its pairs. In the second
   round a text counts only with the tokens that other components hold too.
6. A last round compares every candidate pair whose documents are still in different components. No pair that
   could link two components is left out.

A pair is not compared where the sizes, the numbers of tokens that either text shares with any other, or parity
sketches of the sets (a lower bound of their difference) rule the similarity out.

Defined results: a document without words has an empty set, ``n_shingles`` 0 and is its own component; a null key
keeps its row with a null component; equal rows repeated give equal rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.llm.common import names_each_row, numbered, prepare, stored
from pressloom.llm.graph import components
from pressloom.llm.shingles import mix, shingle_sets

# Similarity as a fraction of whole numbers, so that no rounding decides.
NUMERATOR, DENOMINATOR = 75, 100
# A token counts as frequent from this share of all texts on: at most HOT_SHARE times the mean set size of them exist.
HOT_SHARE = 1024
LEAST_HOT = 64
# Tokens worked on together in a task, and tokens aimed at per bucket.
CHUNK_TOKENS = 1 << 20
BUCKET_TOKENS = 1 << 21
LEAST_BITS = 6
TOKEN_BITS = 40


def prefix_length(n: int) -> int:
    """Tokens of a set of ``n`` of which one must be shared."""
    return n - -(-NUMERATOR * n // DENOMINATOR) + 1


def similar(size_a: Column, size_b: Column, common: Column) -> Column:
    return common * (NUMERATOR + DENOMINATOR) >= NUMERATOR * (size_a + size_b)


def can_link(n_a: Column, n_b: Column, shared_a: Column, shared_b: Column) -> Column:
    """Whether two sets could be similar: by their sizes, and by how many of their tokens any other text has."""
    sizes = F.least(n_a, n_b) * DENOMINATOR >= F.greatest(n_a, n_b) * NUMERATOR
    return sizes & similar(n_a, n_b, F.least(shared_a, shared_b))


def _chunks(batches, key: str, text: str):
    """Runs of documents with about ``CHUNK_TOKENS`` tokens: keys and sets."""
    keys, sets, total = [], [], 0
    for batch in batches:
        got = shingle_sets(batch.column(text).to_pylist())
        keys += batch.column(key).to_pylist()
        sets += got
        total += sum(map(len, got))
        if total >= CHUNK_TOKENS:
            yield keys, sets
            keys, sets, total = [], [], 0
    if keys:
        yield keys, sets


def profile(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n, s1, s2`` per document; beside these, rows ``token, texts`` of tokens frequent in a run of texts."""

    def run(batches):
        for keys, sets in _chunks(batches, key, text):
            sums = np.array([[s.sum(dtype=np.uint64), mix(s).sum(dtype=np.uint64)] for s in sets], dtype=np.uint64).view(np.int64)
            n = len(keys)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(sums[:, 0]), pa.array(sums[:, 1]),
                 pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())], names=names)
            tokens, texts = np.unique(np.concatenate(sets), return_counts=True)
            often = texts >= max(8, n // (2 * HOT_SHARE))
            yield pa.RecordBatch.from_arrays(
                [*[pa.nulls(int(often.sum()), pa.int64())] * 4, pa.array(tokens[often].view(np.int64)), pa.array(texts[often].astype(np.int64))],
                names=names)

    names = ["doc_id", "n", "s1", "s2", "token", "texts"]
    columns = docs.select(F.col(key).cast("long").alias(key), text)
    return columns.mapInArrow(run, "doc_id long, n long, s1 long, s2 long, token long, texts long")


def frequent_tokens(profiles: DataFrame, documents: int) -> np.ndarray:
    """The frequent tokens, sorted: few by their definition, whatever the size of the corpus."""
    least = max(LEAST_HOT, documents // HOT_SHARE)
    found = (profiles.filter(F.col("token").isNotNull()).groupBy("token").agg(F.sum("texts").alias("texts"))
             .filter(F.col("texts") >= least).select("token").toPandas()["token"].to_numpy(np.int64))
    return np.sort(found.view(np.uint64))


PACKED = "bucket int, kind int, header binary, body binary"
# Kinds of packed rows: tokens still to be counted, frequent tokens, counted tokens, representatives.
TOKENS, HOT, COUNTED, STANDS = range(4)
MOST = 255
# Bits of a document's parity sketch.
PARITY = 1024


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    bucket, kind, header, body = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(kind, pa.int32()), pa.array(header, pa.binary()),
                                       pa.array(body, pa.binary())], names=["bucket", "kind", "header", "body"])


def _short(tokens: np.ndarray) -> bytes:
    """40 bits of each token; the others are those that its bucket stands for."""
    low = (tokens & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes()
    return low + ((tokens >> np.uint64(32)) & np.uint64(0xFF)).astype("u1").tobytes()


def _long(body: bytes, n: int) -> np.ndarray:
    return np.frombuffer(body, dtype="<u4", count=n).astype(np.uint64) | (
        np.frombuffer(body, dtype="u1", count=n, offset=4 * n).astype(np.uint64) << np.uint64(32))


def _dealt(kind: int, keys: np.ndarray, owner: np.ndarray, tokens: np.ndarray, bucket: int) -> tuple:
    """A packed row: documents with the number of their tokens here, and the tokens of each in turn."""
    which, times = np.unique(owner, return_counts=True)
    header = keys[which].astype("<i8").tobytes() + times.astype("<u4").tobytes()
    return bucket, kind, header, tokens.astype("<u8").tobytes() if kind == HOT else _short(tokens)


def _undealt(kind: int, header: bytes, body: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Key and token of each occurrence."""
    documents = len(header) // 12
    keys = np.frombuffer(header, dtype="<i8", count=documents)
    times = np.frombuffer(header, dtype="<u4", offset=8 * documents)
    return np.repeat(keys, times), np.frombuffer(body, dtype="<u8") if kind == HOT else _long(body, len(body) // 5)


def _place(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of a document."""
    return (mix(keys.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def occurrences(docs: DataFrame, hot: np.ndarray, bits: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All tokens of all documents, packed by bucket (the leading ``bits`` of a token).

    Frequent tokens need no counting: a run of texts sends them whole to one bucket or another.
    """
    shared = docs.sparkSession.sparkContext.broadcast(hot)
    buckets = 1 << bits

    def run(batches):
        frequent, number = shared.value, TaskContext.get().partitionId()
        for keys, sets in _chunks(batches, key, text):
            number += 1
            named = np.array([value is not None for value in keys])
            ids = np.array([value or 0 for value in keys], dtype=np.int64)
            tokens = np.concatenate(sets)
            owner = np.repeat(np.arange(len(keys)), [len(s) for s in sets])
            keep = named[owner]
            tokens, owner = tokens[keep], owner[keep]
            if len(frequent) and len(tokens):
                at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
                is_hot = frequent[at] == tokens
                if is_hot.any():
                    yield _rows([_dealt(HOT, ids, owner[is_hot], tokens[is_hot], number % buckets)])
                tokens, owner = tokens[~is_hot], owner[~is_hot]
            place = (tokens >> np.uint64(64 - bits)).astype(np.int64)
            by_place = np.argsort(place, kind="stable")
            tokens, owner, place = tokens[by_place], owner[by_place], place[by_place]
            edges = np.searchsorted(place, np.arange(buckets + 1))
            rows = [_dealt(TOKENS, ids, owner[a:b], tokens[a:b], bucket)
                    for bucket, (a, b) in enumerate(zip(edges[:-1], edges[1:])) if b > a]
            for i in range(0, len(rows), 64):
                yield _rows(rows[i:i + 64])

    return docs.select(F.col(key).cast("long").alias(key), text).mapInArrow(run, PACKED)


def shared_tokens(packed: DataFrame, bits: int) -> DataFrame:
    """Tokens of two or more texts, packed by bucket of the document.

    Each comes with a rank of its count, eight to an octave: any function of the token alone makes an order.
    """
    buckets = 1 << bits

    def back(source: int, keys: np.ndarray, tokens: np.ndarray, ranks: np.ndarray):
        place = _place(keys, buckets)
        order = np.lexsort((keys, place))
        edges = np.searchsorted(place[order], np.arange(buckets + 1))
        rows = []
        for bucket, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
            if b > a:
                part = order[a:b]
                rows.append((bucket, COUNTED, np.int32(source).tobytes() + keys[part].astype("<i8").tobytes(),
                             _short(tokens[part]) + ranks[part].astype("u1").tobytes()))
        if rows:
            yield _rows(rows)

    def run(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for bucket, kind, header, body in zip(*(column.to_pylist() for column in batch.columns)):
                if kind != HOT:
                    held.setdefault(bucket, []).append((header, body))
                    continue
                keys, tokens = _undealt(kind, header, body)
                source = (tokens >> np.uint64(64 - bits)).astype(np.int64)
                for one in np.unique(source).tolist():
                    own = source == one
                    yield from back(one, keys[own], tokens[own], np.full(int(own.sum()), MOST))
        for bucket in list(held):
            parts = [_undealt(TOKENS, *part) for part in held.pop(bucket)]
            keys, tokens = (np.concatenate(column) for column in zip(*parts))
            order = np.argsort(tokens, kind="stable")
            keys, tokens = keys[order], tokens[order]
            starts = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
            counts = np.diff(np.concatenate([starts, [len(tokens)]]))
            each = np.repeat(counts, counts)
            again = each > 1
            yield from back(bucket, keys[again], tokens[again], np.minimum(8 * np.log2(each[again]), MOST - 1))

    return packed.repartition(buckets, "bucket").mapInArrow(run, PACKED)


def packed_stands(stands: DataFrame, bits: int) -> DataFrame:
    """Representatives (``stands``) with their set sizes, packed by bucket of the document."""
    buckets = 1 << bits

    def run(batches):
        for batch in batches:
            keys, sizes = batch.column("stands").to_numpy(), batch.column("n").to_numpy()
            place = _place(keys, buckets)
            rows = [(int(bucket), STANDS, keys[own].astype("<i8").tobytes(), sizes[own].astype("<i8").tobytes())
                    for bucket in np.unique(place) for own in [place == bucket]]
            if rows:
                yield _rows(rows)

    return stands.select("stands", "n").mapInArrow(run, PACKED)


def _parity(tokens: np.ndarray) -> np.ndarray:
    """Which of ``PARITY`` hash classes hold an odd number of the tokens, as bits."""
    place = (mix(tokens ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(PARITY)).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=PARITY) & 1).astype(np.uint8)).view(np.int64)


def may_be_similar(a: str, b: str) -> Column:
    """A bound on the symmetric difference: tokens of one text alone, and hash classes of unlike parity."""
    apart = [F.bit_count(F.get(f"parity_{a}", i).bitwiseXOR(F.get(f"parity_{b}", i))) for i in range(PARITY // 64)]
    unlike = sum(apart[1:], apart[0]) + F.col(f"alone_{a}") + F.col(f"alone_{b}")
    return unlike * (DENOMINATOR + NUMERATOR) <= (F.col(f"n_{a}") + F.col(f"n_{b}")) * (DENOMINATOR - NUMERATOR)


def members(returned: DataFrame, bits: int) -> DataFrame:
    """Representatives with a shared token in a prefix: key, set size, shared tokens, prefixes under two orders.

    ``returned`` holds the counted tokens of all documents and the list of representatives.
    """

    def run(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for bucket, kind, header, body in zip(*(column.to_pylist() for column in batch.columns)):
                held.setdefault(bucket, []).append((kind, header, body))
        for bucket in list(held):
            columns, wanted = [], {}
            for kind, header, body in held.pop(bucket):
                if kind == STANDS:
                    wanted.update(zip(np.frombuffer(header, dtype="<i8").tolist(), np.frombuffer(body, dtype="<i8").tolist()))
                    continue
                source, keys = np.frombuffer(header, dtype="<i4", count=1)[0], np.frombuffer(header, dtype="<i8", offset=4)
                tokens = _long(body, len(keys)) | (np.uint64(source) << np.uint64(64 - bits))
                columns.append((keys, tokens, np.frombuffer(body, dtype="u1", offset=5 * len(keys))))
            if not columns:
                continue
            keys, tokens, ranks = (np.concatenate(column) for column in zip(*columns))
            order = np.lexsort((tokens, keys))
            keys, tokens, ranks = keys[order], tokens[order], ranks[order]
            edges = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
            out = []
            for a, b in zip(edges[:-1], edges[1:]):
                n = wanted.get(int(keys[a]))
                if n is None:
                    continue
                own, at = np.unique(tokens[a:b], return_index=True)
                room = prefix_length(n) - (n - len(own))
                if room <= 0:
                    continue
                often = ranks[a:b][at]
                first = own[np.lexsort((own, often))[:room]]
                second = own[np.lexsort((mix(own ^ np.uint64(0x5851F42D4C957F2D)), often >> 3))[:room]]
                out.append((int(keys[a]), n, n - len(own), own.view(np.int64), first.view(np.int64), np.sort(second).view(np.int64), _parity(own)))
            for i in range(0, len(out), 512):
                key, n, alone, *lists = zip(*out[i:i + 512])
                yield pa.RecordBatch.from_arrays([*(pa.array(values, pa.int64()) for values in (key, n, alone)), *(
                    pa.array(values, pa.list_(pa.int64())) for values in lists)],
                    names=["doc_id", "n", "alone", "tokens", "first", "second", "parity"])

    schema = ("doc_id long, n long, alone long, tokens array<long>, first array<long>, second array<long>, parity array<long>")
    return returned.repartition(1 << bits, "bucket").mapInArrow(run, schema)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of the pairs ``a, b`` those whose prefixes meet under the second order too and whose sets are similar."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"), F.col("second").alias("sa"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"), F.col("second").alias("sb"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b").filter(F.arrays_overlap("sa", "sb"))
    common = F.size(F.array_intersect("ta", "tb"))
    return both.filter(similar(F.col("na"), F.col("nb"), common)).select("a", "b")


def links_of(sets: DataFrame) -> DataFrame:
    """``node, component`` of the representatives that have a link, from their members table."""
    postings = stored(sets.select("doc_id", "n", F.size("tokens").alias("s"), F.explode("first").alias("token")), "jaccard-postings")
    placed = postings.withColumn("component", F.col("doc_id"))
    first = star_links(placed, sets)
    placed = _placed(postings, components(first))
    # From here on a text counts only with tokens that other components hold too.
    placed = stored(placed.drop("s").join(crossing(placed, sets), "doc_id"), "jaccard-crossing")
    second = star_links(placed, sets)
    found = first.unionByName(second)
    placed = _placed(placed.drop("component"), components(found))
    last = stored(verified(pairs_across(placed, sets), sets), "jaccard-links")
    return components(found.unionByName(last))


def mixed_tokens(placed: DataFrame) -> DataFrame:
    """Tokens of which several components hold a prefix."""
    return placed.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter(
        F.col("low") != F.col("high")).select("token")


def star_links(placed: DataFrame, sets: DataFrame) -> DataFrame:
    """Verified links of all texts of a token to one pivot: the text with the least share of tokens of its own."""
    chosen = placed.groupBy("token").agg(
        F.min_by(F.struct("doc_id", "n", "s", "component"), F.struct((F.col("n") - F.col("s")) / F.col("n"), F.xxhash64("doc_id"))).alias("pivot"),
        F.min("component").alias("low"), F.max("component").alias("high"))
    mixed = chosen.filter(F.col("low") != F.col("high")).select("token", "pivot")
    compared = placed.join(mixed, "token").filter(
        (F.col("component") != F.col("pivot.component")) & can_link(F.col("n"), F.col("pivot.n"), F.col("s"), F.col("pivot.s")))
    return stored(verified(_ordered(compared.select("doc_id", F.col("pivot.doc_id").alias("other"))), sets), "jaccard-links")


def crossing(placed: DataFrame, sets: DataFrame) -> DataFrame:
    """For texts that share a prefix token with another component: ``s``, their tokens that some other component holds.

    No pair across components has more tokens in common than either of these numbers.
    """
    open_docs = placed.join(mixed_tokens(placed), "token").select("doc_id", "component").distinct()
    held = sets.join(open_docs, "doc_id").select("doc_id", "component", F.explode("tokens").alias("token"))
    held = stored(held, "jaccard-held")
    return held.join(mixed_tokens(held), "token").groupBy("doc_id").agg(F.count(F.lit(1)).alias("s"))


def pairs_across(placed: DataFrame, sets: DataFrame) -> DataFrame:
    """Every candidate pair ``a, b`` of different components, once: at the first prefix token that both have."""
    still = placed.join(mixed_tokens(placed), "token")
    docs = still.groupBy("doc_id", "n", "s", "component").agg(F.collect_list("token").alias("tokens"))
    docs = stored(docs.join(sets.select("doc_id", "alone", "parity"), "doc_id"), "jaccard-open")
    columns = ["doc_id", "n", "s", "component", "alone", "parity"]
    left = docs.select(*[F.col(name).alias(f"{name}_a") for name in [*columns, "tokens"]], F.explode("tokens").alias("token"))
    right = docs.select(*[F.col(name).alias(f"{name}_b") for name in [*columns, "tokens"]], F.explode("tokens").alias("token"))
    return left.join(right, "token").filter(
        (F.col("doc_id_a") < F.col("doc_id_b")) & (F.col("component_a") != F.col("component_b"))
        & can_link(F.col("n_a"), F.col("n_b"), F.col("s_a"), F.col("s_b")) & may_be_similar("a", "b")
        & (F.col("token") == F.array_min(F.array_intersect("tokens_a", "tokens_b")))).select(
        F.col("doc_id_a").alias("a"), F.col("doc_id_b").alias("b"))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("doc_id", "other").alias("a"), F.greatest("doc_id", "other").alias("b")).distinct()


def _placed(postings: DataFrame, found: DataFrame) -> DataFrame:
    joined = postings.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    return stored(joined.select("doc_id", "n", "s", "token", F.coalesce("component", "doc_id").alias("component")), "jaccard-placed")


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id``: a row per input row."""
    prepare(docs.sparkSession)
    profiles = stored(profile(docs, key, text), "jaccard-profile")
    listed = profiles.filter(F.col("n").isNotNull()).select("doc_id", "n", "s1", "s2")
    documents, tokens = listed.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    bits = max(LEAST_BITS, math.ceil(math.log2(max(1, tokens) / BUCKET_TOKENS))) if tokens else LEAST_BITS
    bits = min(bits, 64 - TOKEN_BITS)
    hot = frequent_tokens(profiles, documents)
    # Equal sets: the smallest key stands for all.
    alike = ["n", "s1", "s2"]
    stands = stored(listed.filter((F.col("n") > 0) & F.col("doc_id").isNotNull()).groupBy(*alike).agg(F.min("doc_id").alias("stands")),
                    "jaccard-sets")
    returned = shared_tokens(occurrences(docs, hot, bits, key, text), bits)
    sets = stored(members(returned.unionByName(packed_stands(stands, bits)), bits), "jaccard-members")
    linked = links_of(sets)
    by_set = stands.join(linked.withColumnRenamed("node", "stands"), "stands", "left").select(
        *alike, F.coalesce("component", "stands").alias("component_id"))
    out = listed.join(by_set, alike, "left")
    return out.select(F.col("doc_id").alias(key), F.col("n").alias("n_shingles"),
                      F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of linked texts: the one with the smallest key, columns as given.

    Where the key is null, repeats or is no integer, rows get a number of their own: then each row is a text by itself,
    null keys come last, and of rows that share the smallest key one stays. Texts without words all stay.
    """
    if names_each_row(docs, key):
        dropped = groups(docs, key, text).filter(F.col("component_id") != F.col(key)).select(key).distinct()
        return docs.join(dropped, key, "left_anti").select(docs.columns)
    given = numbered(docs, key, text)
    found = groups(given, "row", "text").join(given.select("row", "key"), "row")
    first = F.min(F.struct(F.col("key").isNull().alias("unnamed"), "key", "row"))["row"].alias("row")
    return given.join(found.groupBy("component_id").agg(first).select("row"), "row", "left_semi").select("doc.*")
