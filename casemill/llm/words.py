"""Words of many texts at once, as numbers.

A word is a maximal run of digits, letters A-Z in either case and bytes above 0x7F, which makes it a run of
``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing A-Z. Work is done on UTF-8 bytes in numpy: no
Python string is made for a word. A word is identified by a 64-bit hash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from casemill.llm.common import utf8

_SLICE = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def _table() -> tuple[np.ndarray, np.ndarray]:
    code = np.arange(256)
    lower = np.where((code >= 65) & (code <= 90), code + 32, code)
    is_word = (code >= 128) | ((code >= 48) & (code <= 57)) | ((lower >= 97) & (lower <= 122))
    return is_word, mix(lower.astype(np.uint64) + np.uint64(1))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scrambler (splitmix64)."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_IS_WORD, _BYTE = _table()


@dataclass
class Words:
    """hashes: uint64 per word; first: for each text the number of its first word, and the number of all words."""

    hashes: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def words(text: pa.Array) -> Words:
    """The words of a text column, in order. Null and empty texts have none."""
    data, ends = utf8(text)
    starts, hashes = [], []
    a, n = 0, len(data)
    while a < n:
        b = min(a + _SLICE, n)
        while b < n and _IS_WORD[data[b]]:  # a slice ends where no word goes on
            step = _IS_WORD[data[b : b + 4096]]
            stop = int(np.argmin(step))
            b = b + (len(step) if step[stop] else stop)
        at, h = _slice(data[a:b], ends[(ends > a) & (ends < b)] - a)
        starts.append(at + a)
        hashes.append(h)
        a = b
    starts = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    return Words(hashes, np.searchsorted(starts, ends))


def _slice(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    word = _IS_WORD[data]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    begins[borders] = word[borders]
    letters = np.flatnonzero(word)
    if len(letters) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    starts = np.flatnonzero(begins)
    first = np.searchsorted(letters, starts)
    lengths = np.diff(first, append=len(letters))
    with np.errstate(over="ignore"):
        powers = np.multiply.accumulate(np.full(int(lengths.max()), _BASE))
        place = np.arange(len(letters)) - np.repeat(first, lengths)
        sums = np.add.reduceat(_BYTE[data[letters]] * powers[place], first)
        return starts, mix(sums ^ (lengths.astype(np.uint64) << np.uint64(48)))


def shingles(w: Words, size: int) -> Words:
    """Hashes of ``size`` consecutive words; a text of fewer words, but not none, has one of all its words."""
    counts = w.counts
    made = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    first = np.concatenate([[0], np.cumsum(made)])
    at = np.arange(first[-1]) + np.repeat(w.first[:-1] - first[:-1], made)
    last = np.repeat(w.first[1:], made)
    out = np.zeros(len(at), np.uint64)
    padded = np.concatenate([w.hashes, np.zeros(size, np.uint64)])
    with np.errstate(over="ignore"):
        for k in range(size):
            out = mix(out ^ np.where(at + k < last, padded[at + k], np.uint64(0)))
    return Words(out, first)
