"""Token counts by heap-and-linked-list byte-pair merging (operator 5).

Each distinct word starts as a linked list of byte symbols. A heap gives the adjacent pair of lowest
rank; merging it relinks the list and offers the two new pairs. The count is symbols minus merges, so no
token identifiers are made. Words repeat, so counts of words are kept in a bounded memo per worker.

Defined results: a null or empty text has 0 bytes and 0 tokens; repeated rows give repeated rows; other
columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections import Counter

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from pressloom.llm.common import prepare, with_text

# Bounds of the memo tables of a worker: entries of each, letters of an entry.
MEMO_WORDS = 1 << 19
MEMO_LETTERS = 64
# str.split() takes these for white space, the vocabulary does not.
SEPARATORS = regex.compile("[\x1c-\x1f]")


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies use for each byte value."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(value) if value in shown else chr(next(hidden)) for value in range(256)]


class WordCounter:
    """Token counts under a word-end BPE vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        model = config["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.letters = byte_letters()
        missing = [x for x in self.letters for x in (x, x + self.end) if x not in model["vocab"]]
        if missing:
            raise ValueError("the vocabulary lacks byte symbols")
        pairs = (pair if isinstance(pair, list) else pair.split(" ") for pair in model["merges"])
        self.ranks = {(left, right): rank for rank, (left, right) in enumerate(pairs)}
        self.special = [token["content"] for token in config["added_tokens"]]
        self.special_pattern = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        # Fixed pattern of the vocabulary: what is not matched is white space. Its white space is the
        # Unicode property, which leaves out the four separators U+001C to U+001F.
        self.words = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+").findall
        self.word_memo: dict[str, int] = {}
        self.chunk_memo: dict[str, int] = {}

    def merged(self, word: str) -> int:
        """Tokens of one word: initial symbols minus merges."""
        symbols = [self.letters[value] for value in word.encode("utf-8")]
        symbols[-1] += self.end
        n, merges, ranks = len(symbols), 0, self.ranks
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(ranks[pair], i) for i in range(n - 1) if (pair := (symbols[i], symbols[i + 1])) in ranks]
        heapq.heapify(heap)
        while heap:
            rank, left = heapq.heappop(heap)
            # An entry is stale once either of its symbols was merged away or has grown.
            if symbols[left] is None or (right := after[left]) < 0 or ranks.get((symbols[left], symbols[right])) != rank:
                continue
            symbols[left] += symbols[right]
            symbols[right] = None
            after[left] = follow = after[right]
            merges += 1
            if follow >= 0:
                before[follow] = left
                if (new := ranks.get((symbols[left], symbols[follow]))) is not None:
                    heapq.heappush(heap, (new, left))
            if (ahead := before[left]) >= 0 and (new := ranks.get((symbols[ahead], symbols[left]))) is not None:
                heapq.heappush(heap, (new, ahead))
        return n - merges

    def chunk(self, text: str) -> int:
        """Tokens of a piece of text that was not counted before."""
        if not text.isascii():
            # Letters are lowered one by one, so that a final sigma stays an ordinary one.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        words, total = self.word_memo, 0
        for word in self.words(text.lower()):
            count = words.get(word)
            if count is None:
                count = self.merged(word)
                if len(word) <= MEMO_LETTERS:
                    if len(words) >= MEMO_WORDS:
                        words.clear()
                    words[word] = count
            total += count
        return total

    def plain(self, text: str) -> int:
        if SEPARATORS.search(text):
            return self.chunk(text)
        # No token crosses white space, so equal runs between white space are counted once.
        chunks, total = self.chunk_memo, 0
        for piece, times in Counter(text.split()).items():
            count = chunks.get(piece)
            if count is None:
                count = self.chunk(piece)
                if len(piece) <= MEMO_LETTERS:
                    if len(chunks) >= MEMO_WORDS:
                        chunks.clear()
                    chunks[piece] = count
            total += times * count
        return total

    def __call__(self, text: str) -> int:
        if self.special_pattern is None or not any(token in text for token in self.special):
            return self.plain(text)
        parts = self.special_pattern.split(text)
        return len(parts) - 1 + sum(map(self.plain, parts))


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 2048, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Bytes and tokens of every text.

    ``vocabulary`` is the path of a word-end BPE file that every worker can read. Returns key, ``n_bytes``,
    ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens), a row per input row.
    """
    prepare(docs.sparkSession)
    loaded: list[WordCounter] = []

    def count(texts: list[str]) -> dict:
        if not loaded:
            loaded.append(WordCounter(vocabulary))
        tokens = [loaded[0](value) for value in texts]
        return {
            "n_bytes": pa.array([len(value.encode("utf-8")) for value in texts], pa.int64()),
            "n_tokens": pa.array(tokens, pa.int64()),
            "over_limit": pa.array([n > limit for n in tokens], pa.bool_()),
        }

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(with_text(count, [key], text),
                                             f"`{key}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
