"""Hashes of words and of runs of words, vectorised over the bytes of a whole text.

Words are runs of bytes other than ASCII white space. A word's hash is a polynomial of its bytes modulo 2^64, mixed; a
shingle's hash mixes those of its words in order. A text of fewer words than a shingle has one shingle, all its words;
a text without words has none.
"""

from __future__ import annotations

import numpy as np

MULTIPLIER = 0x9E3779B97F4A7C15
SPACE = np.zeros(256, bool)
SPACE[list(b"\t\n\x0b\x0c\r ")] = True
CHUNK = 1 << 20

_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2^64."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        made = []
        for base in (MULTIPLIER, pow(MULTIPLIER, -1, 1 << 64)):
            row = np.full(size, base, np.uint64)
            row[0] = 1
            made.append(np.cumprod(row))
        _powers = made[0], made[1]
    return _powers


def _chunk_hashes(data: bytes) -> np.ndarray:
    a = np.frombuffer(data, np.uint8)
    if not len(a):
        return np.empty(0, np.uint64)
    blank = np.concatenate(([True], SPACE[a], [True]))
    turns = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = turns[::2], turns[1::2]
    power, inverse = _tables(len(a))
    value = (a.astype(np.uint64) + np.uint64(1)) * power[: len(a)]
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)))
    return mix((total[ends] - total[starts]) * inverse[starts])


def word_hashes(text: str | None) -> np.ndarray:
    return byte_hashes((text or "").encode("utf-8", "surrogatepass"))


def byte_hashes(data: bytes) -> np.ndarray:
    """Word hashes of UTF-8 text, in pieces that end at a blank, so memory beside the result is bounded."""
    if len(data) <= CHUNK:
        return _chunk_hashes(data)
    out, at = [], 0
    while at < len(data):
        end = min(at + CHUNK, len(data))
        while end < len(data) and not SPACE[data[end]]:
            end += 1
        out.append(_chunk_hashes(data[at:end]))
        at = end
    return np.concatenate(out)


def runs_of(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of each ``size`` words in a row, by position; of all words together if there are fewer."""
    n = len(words)
    if not n:
        return words
    size = min(size, n)
    h = np.full(n - size + 1, size, np.uint64)
    for i in range(size):
        h = h * np.uint64(MULTIPLIER) + words[i : n - size + 1 + i]
        h ^= h >> np.uint64(29)
    return mix(h)


def shingle_set(text: str | None, size: int = 5) -> np.ndarray:
    """The distinct shingle hashes of a text, ascending."""
    return np.unique(runs_of(word_hashes(text), size))
