"""Word and shingle hashing over Arrow string batches (numpy, no Spark).

A word is a maximal run of bytes outside ``\\x20 \\x09-\\x0D`` of the UTF-8 text
with A-Z lower-cased.  White space is ASCII only, so byte runs and code point
runs agree.  Words and shingles are 64-bit hashes: a polynomial over a random
byte table, finished with an avalanche step.  Texts are handled in slices of
at most ``SLICE_BYTES`` (one longer text is a slice of its own), so memory does
not follow the Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SHINGLE_WORDS = 5
SLICE_BYTES = 1 << 20

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_CASED = _BYTE.copy()
_CASED[_SPACE] = 0                     # white space adds nothing to a word's sum
_CODE = _CASED[_FOLD]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEP = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, grown when needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if len(self.up) < n:
            for name, factor in (("up", _BASE), ("down", _INVERSE)):
                steps = np.full(n, factor, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))


_powers = _Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """Avalanche step on unsigned 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, row offsets into the bytes) of consecutive rows; null counts as empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    off = np.frombuffer(offsets, kind, len(texts) + 1, texts.offset * np.dtype(kind).itemsize).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(off, off[at] + limit, "right")) - 1)
        yield at, raw[off[at]:off[end]], off[at:end + 1] - off[at]
        at = end


def word_bounds(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start byte, end byte) of every word and the first word of every row (one more at the end)."""
    solid = ~_SPACE[raw]
    fresh = np.ones(len(raw) + 1, bool)          # a word may not cross rows
    fresh[1:-1] = ~solid[:-1]
    fresh[off] = True
    starts = np.flatnonzero(solid & fresh[:-1])
    ends = np.flatnonzero(solid & (fresh[1:] | np.append(~solid[1:], True))) + 1 if len(raw) else starts
    return starts, ends, np.searchsorted(starts, off)


def word_hashes(raw: np.ndarray, starts: np.ndarray, fold: bool = True) -> np.ndarray:
    """Hash of every word; ``fold`` takes A-Z as a-z."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    _powers.grow(len(raw))
    sums = np.add.reduceat((_CODE if fold else _CASED)[raw] * _powers.up[:len(raw)], starts)
    return mix(sums * _powers.down[starts])


def windows(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive words."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(m, np.uint64(n), np.uint64)
    for k in range(n):
        total += words[k:k + m] * _STEP[k]
    return mix(total)


def row_words(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, word hashes) of every row."""
    for first, raw, off in text_slices(texts):
        starts, _, bound = word_bounds(raw, off)
        words = word_hashes(raw, starts)
        for i in range(len(off) - 1):
            yield first + i, words[bound[i]:bound[i + 1]]


def row_shingles(texts: pa.Array, n: int = SHINGLE_WORDS) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes); fewer than n words make one shingle of all of them."""
    for first, raw, off in text_slices(texts):
        starts, _, bound = word_bounds(raw, off)
        words = word_hashes(raw, starts)
        every = windows(words, n)
        for i in range(len(off) - 1):
            a, b = bound[i], bound[i + 1]
            if b - a >= n:
                yield first + i, np.unique(every[a:b - n + 1])
            else:
                yield first + i, windows(words[a:b], b - a) if b > a else np.zeros(0, np.uint64)


def jaccard_parts(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """(intersection, union) sizes of two sorted distinct arrays."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both, len(a) + len(b) - both


def row_blocks(off: np.ndarray, rows: int) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``rows`` rows."""
    for a in range(0, len(off) - 1, rows):
        yield a, min(len(off) - 1, a + rows)


def paragraph_starts(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """First word of every paragraph: a paragraph ends with its line, or after a word that ends in ``.``, ``!`` or ``?``."""
    if not len(starts):
        return np.zeros(0, np.int64)
    cut = np.zeros(len(starts) + 1, bool)
    cut[bound] = True
    lines = np.cumsum(raw == 10)
    cut[1:-1] |= (lines[starts[1:]] > lines[ends[:-1] - 1]) | np.isin(raw[ends[:-1] - 1], (33, 46, 63))
    return np.flatnonzero(cut[:-1])


def sequence_hashes(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One hash for each run of words that begins at ``starts`` (and ends at the next start)."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    _powers.grow(len(words))
    sums = np.add.reduceat(words * _powers.up[:len(words)], starts) * _powers.down[starts]
    return mix(sums + np.diff(np.append(starts, len(words))).astype(np.uint64))


def rolling(words: np.ndarray) -> np.ndarray:
    """Sums from which ``rolling_hash`` takes the hash of any run of the words."""
    _powers.grow(len(words) + 1)
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * _powers.up[:len(words)], dtype=np.uint64)])


def rolling_hash(sums: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Hash of the words from ``low`` to before ``high``."""
    return (sums[high] - sums[low]) * _powers.down[low]
