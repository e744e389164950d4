"""Hashes of words and word shingles of whole texts, in numpy."""

from __future__ import annotations

import numpy as np

SHINGLE = 5
# Bytes hashed at a time; the tables of powers have this length unless a single word is longer.
STEP = 1 << 20
BASE = 0x9E3779B97F4A7C15
_TABLES: dict[str, np.ndarray] = {}
_FACTORS = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3],
                    dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64, and of its inverse."""
    if len(_TABLES.get("up", ())) < n:
        size = max(n, STEP + 1)
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _TABLES[name] = np.cumprod(steps, dtype=np.uint64)
    return _TABLES["up"], _TABLES["down"]


def words_of(text: str | None) -> list[bytes]:
    """Words of a text: A-Z lowered, split at the six ASCII white-space bytes only."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    """One hash per word, whatever its position."""
    if not words:
        return np.empty(0, dtype=np.uint64)
    found, at = [], 0
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths)
    while at < len(words):
        done = int(ends[at - 1]) if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, done + STEP, side="right")))
        size = lengths[at:upto]
        data = np.frombuffer(b"".join(words[at:upto]), dtype=np.uint8)
        up, down = _powers(len(data))
        starts = np.concatenate([[0], np.cumsum(size[:-1])])
        sums = np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], starts)
        found.append(mix(sums * down[starts] + size.astype(np.uint64) * _FACTORS[0]))
        at = upto
    return np.concatenate(found)


def shingle_hashes(hashes: np.ndarray) -> np.ndarray:
    """Hashes of all five-word shingles in order; fewer words make one shingle, none make none."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(n, SHINGLE)
    out = np.full(n - width + 1, width, dtype=np.uint64)
    for i in range(width):
        out += hashes[i:n - width + 1 + i] * _FACTORS[i]
    return mix(out)


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """The sorted set of shingle hashes of each text; words of many texts are hashed together."""
    listed = [words_of(text) for text in texts]
    hashes = word_hashes([word for words in listed for word in words])
    out, at = [], 0
    for words in listed:
        out.append(np.unique(shingle_hashes(hashes[at:at + len(words)])))
        at += len(words)
    return out
