"""Words and word shingles of whole Arrow batches as 64-bit numbers, without a Python object per word.

Words are maximal runs of bytes other than space and 0x09-0x0D; the letters A-Z count as lower case. All
separators are ASCII, so the rule can be applied to UTF-8 bytes. Equal words have equal numbers on every
machine; different ones agree with a probability of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SHINGLE_WORDS = 5
# Bytes of text looked at together; a longer text is taken alone, in pieces cut at separators.
SLICE_BYTES = 1 << 18

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
# Also everything else in ASCII that is no letter or digit, for words without their punctuation.
PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xD6E8FEB86659FD93)
_powers = {"n": 0}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole number."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _powers["n"] <= n:
        size = max(n + 1, SLICE_BYTES + 1)
        inverse = pow(_BASE, -1, 1 << 64)
        for name, base in (("up", _BASE), ("down", inverse)):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _powers[name] = np.cumprod(factors, dtype=np.uint64)
        _powers["n"] = size
    return _powers["up"], _powers["down"]


def _hashes(data: np.ndarray, first: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and number of each word of `data`; a word also ends where a text begins (`first`)."""
    n = len(data)
    inside = ~separators[data]
    cut = np.zeros(n + 1, bool)
    cut[first[first < n]] = True
    cut[n] = True
    before = np.empty(n, bool)
    before[0] = True
    before[1:] = ~inside[:-1]
    after = np.empty(n, bool)
    after[-1] = True
    after[:-1] = ~inside[1:]
    starts = np.flatnonzero(inside & (before | cut[:n]))
    ends = np.flatnonzero(inside & (after | cut[1:])) + 1
    up, down = _tables(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * up[:n], dtype=np.uint64, out=total[1:])
    return starts, ends, mix((total[ends] - total[starts]) * down[starts])


def _pieces(data: np.ndarray, separators: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """A long text in pieces of about SLICE_BYTES that end at separators (or where the text does)."""
    at = 0
    while at < len(data):
        stop = min(len(data), at + SLICE_BYTES)
        while stop < len(data):
            found = np.flatnonzero(separators[data[stop : stop + SLICE_BYTES]])
            if len(found):
                stop += int(found[0])
                break
            stop = min(len(data), stop + SLICE_BYTES)
        yield at, data[at:stop]
        at = stop


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), offsets


class Words:
    """The words of some consecutive texts: `value`, byte `start` and `end`; text i has bounds[i]:bounds[i+1]."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACES) -> None:
        base, size = int(offsets[0]), int(offsets[-1] - offsets[0])
        parts = (
            [(0, data[base : base + size])]
            if size <= 2 * SLICE_BYTES
            else _pieces(data[base : base + size], separators)
        )
        first = offsets[:-1] - base
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))]
        for at, piece in parts:
            if len(piece):
                near = first[(first >= at) & (first < at + len(piece))] - at
                s, e, h = _hashes(piece, near, separators)
                found.append((s + at, e + at, h))
        start, end, self.value = (np.concatenate(x) for x in zip(*found))
        self.bounds = np.searchsorted(start, offsets - base)
        self.start, self.end = start + base, end + base

    def shingles(self, i: int, n: int = SHINGLE_WORDS) -> np.ndarray:
        """The shingles of text i in order; a text of fewer words is one shingle, one without words has none."""
        return shingle_values(self.value[self.bounds[i] : self.bounds[i + 1]], n)


def shingle_values(words: np.ndarray, n: int = SHINGLE_WORDS) -> np.ndarray:
    k = min(n, len(words))
    if not k:
        return words
    value = np.full(len(words) - k + 1, k, np.uint64)
    for j in range(k):
        value = value * _STEP + words[j : len(words) - k + 1 + j]
    return mix(value)


def batches_of_words(
    texts: pa.Array, separators: np.ndarray = SPACES
) -> Iterator[tuple[int, int, Words, np.ndarray, np.ndarray]]:
    """(first row, end row, words, data, offsets) for runs of rows of about SLICE_BYTES together."""
    data, offsets = utf8(texts)
    n, row = len(offsets) - 1, 0
    while row < n:
        stop = int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, side="right")) - 1
        stop = min(n, max(stop, row + 1))
        part = offsets[row : stop + 1]
        yield row, stop, Words(data, part, separators), data, part
        row = stop
