"""Vectorised word and shingle hashing over the raw UTF-8 bytes of many texts.

A word's hash is a polynomial over per-byte random values modulo 2**64,
taken from one running sum over the bytes, so no Python code runs per word.
Texts are walked in segments of fixed size; memory beyond the text itself is
a segment and a few numbers a word, however long a text or a word is.
"""

from __future__ import annotations

import numpy as np

SEGMENT = 1 << 18
_U = np.uint64
_M1, _M2 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15
_INV = pow(_BASE, -1, 1 << 64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _M1
    x = (x ^ (x >> _U(27))) * _M2
    return x ^ (x >> _U(31))


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.empty(n, _U)
    out[0] = 1
    filled = 1
    while filled < n:
        step = min(filled, n - filled)
        out[filled:filled + step] = out[:step] * _U(pow(base, filled, 1 << 64))
        filled += step
    return out


_rng = np.random.default_rng(20240611)
_TABLE = _rng.integers(1, 1 << 63, 256, dtype=_U) * _U(2) + _U(1)
_FOLDED = _TABLE.copy()
_FOLDED[65:91] = _TABLE[97:123]
_MIXER = _rng.integers(1, 1 << 63, 64, dtype=_U) * _U(2) + _U(1)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_cache: dict[str, np.ndarray] = {}


def _power_tables() -> tuple[np.ndarray, np.ndarray]:
    if not _cache:
        _cache["up"], _cache["down"] = _powers(_BASE, SEGMENT), _powers(_INV, SEGMENT)
    return _cache["up"], _cache["down"]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte start and end of every word, and the row it belongs to."""
    if not len(data):
        e = np.zeros(0, np.int64)
        return e, e, e
    text = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(data), bool)
    before[0] = True
    np.logical_or(~text[:-1], edge[1:-1], out=before[1:])
    starts = np.flatnonzero(text & before)
    after = np.empty(len(data), bool)
    after[-1] = True
    np.logical_or(~text[1:], edge[1:-1], out=after[:-1])
    ends = np.flatnonzero(text & after) + 1
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, rows


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold_case: bool = False) -> np.ndarray:
    """A 64-bit hash of the bytes of each (ascending, disjoint) span."""
    up, down = _power_tables()
    table = _FOLDED if fold_case else _TABLE
    first, last = np.zeros(len(starts), _U), np.zeros(len(starts), _U)
    inverse = np.empty(len(starts), _U)
    total, scale, unscale = _U(0), 1, 1
    with np.errstate(over="ignore"):
        for at in range(0, len(data), SEGMENT):
            part = data[at:at + SEGMENT]
            n = len(part)
            sums = np.empty(n + 1, _U)
            sums[0] = 0
            np.cumsum(table[part] * up[:n], out=sums[1:])
            sums *= _U(scale)
            sums += total
            a, b = np.searchsorted(starts, [at, at + n])
            first[a:b] = sums[starts[a:b] - at]
            inverse[a:b] = down[starts[a:b] - at] * _U(unscale)
            a, b = np.searchsorted(ends, [at, at + n], side="right")
            last[a:b] = sums[ends[a:b] - at]
            total = sums[n]
            scale = scale * pow(_BASE, SEGMENT, 1 << 64) & 0xFFFFFFFFFFFFFFFF
            unscale = unscale * pow(_INV, SEGMENT, 1 << 64) & 0xFFFFFFFFFFFFFFFF
        return _mix((last - first) * inverse + (ends - starts).astype(_U))


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of every run of ``width`` neighbours in ``words``."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, _U)
    with np.errstate(over="ignore"):
        out = words[:n] * _MIXER[0]
        for k in range(1, width):
            out += words[k:k + n] * _MIXER[k % 64]
        return _mix(out + _U(width))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int):
    """The sorted distinct shingle hashes of each row: windows of ``width``
    words, ASCII case folded; a shorter text is one shingle, an empty one none."""
    starts, ends, rows = word_spans(data, offsets)
    words = span_hashes(data, starts, ends, fold_case=True)
    bounds = np.searchsorted(rows, np.arange(len(offsets)))
    windows = window_hashes(words, width)
    for i in range(len(offsets) - 1):
        a, b = bounds[i], bounds[i + 1]
        if b - a >= width:
            s = np.sort(windows[a:b - width + 1])
            yield s[np.concatenate(([True], s[1:] != s[:-1]))]
        elif b > a:
            yield window_hashes(words[a:b], int(b - a))
        else:
            yield np.zeros(0, _U)


class WordTable:
    """Numbers known for word hashes, as sorted arrays: a few bytes a word, and
    look-ups and additions without a Python object a word."""

    def __init__(self, fields: int):
        self.keys = np.zeros(0, _U)
        self.fields = [np.zeros(0, np.int32) for _ in range(fields)]

    def __len__(self) -> int:
        return len(self.keys)

    def missing(self, keys: np.ndarray) -> np.ndarray:
        """Places in the sorted ``keys`` that are not known."""
        if not len(self.keys):
            return np.arange(len(keys))
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.flatnonzero(self.keys[at] != keys)

    def add(self, keys: np.ndarray, *values: np.ndarray) -> None:
        """Add sorted new ``keys``."""
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.fields = [np.insert(f, at, v) for f, v in zip(self.fields, values)]

    def get(self, keys: np.ndarray) -> list[np.ndarray]:
        at = np.searchsorted(self.keys, keys)
        return [f[at] for f in self.fields]
