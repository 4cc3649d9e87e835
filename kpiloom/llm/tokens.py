"""Token ids of whole texts with a public word-level BPE vocabulary.

Tokens never cross white space, so a text is cut at ASCII white space.  Words of
plain characters (ASCII and the letters of U+00C0 to U+00FF) are cut further,
into runs of letters, single digits and runs of other signs, as the vocabulary's
own word pattern does; each distinct part of a slice is tokenised once (and
remembered up to a bound), and the ids of the texts are gathered from the
parts'.  All other words (other characters, apostrophes, strings that may be
special tokens) go whole through the unchanged tokenizer.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from kpiloom.llm.words import text_slices, word_bounds, word_hashes

SLICE_BYTES = 1 << 20
REMEMBERED_WORDS = 250_000        # parts that a worker keeps
TOGETHER = 64                     # parts in one call of the tokenizer

_SPACES = (9, 10, 11, 12, 13, 32)
_LETTER, _DIGIT, _SIGN, _ODD = 1, 2, 3, 4
_CLASS = np.full(256, _ODD, np.uint8)
_CLASS[33:127] = _SIGN
_CLASS[48:58] = _DIGIT
_CLASS[65:91] = _CLASS[97:123] = _LETTER
_CLASS[39] = _ODD                 # apostrophes begin endings of their own
_CLASS[list(_SPACES)] = 0
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LATIN = 0xC3                     # first byte of U+00C0 to U+00FF
_AS_IS = np.uint64(0xD6E8FEB86659FD93)      # keeps the hashes of odd words apart from those of parts


class WordTokens:
    """Ids of texts; one object per Python worker."""

    def __init__(self, vocabulary: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers
        self.vocabulary, self.whole = vocabulary, None       # the unchanged one is loaded when a word needs it
        self.parts = Tokenizer.from_file(vocabulary)         # for lower-cased parts between blanks
        self.parts.normalizer = normalizers.Sequence([])
        self.parts.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.last = np.zeros(self.parts.get_vocab_size() + 1, bool)
        for token, i in self.parts.get_vocab().items():
            self.last[i] = token.endswith("</w>")
        self.forget()

    def forget(self) -> None:
        self.slot: dict[int, int] = {}
        self.flat, self.at, self.size = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.whole is None:
            from tokenizers import Tokenizer
            self.whole = Tokenizer.from_file(self.vocabulary)
        ids = [x.ids for x in self.whole.encode_batch_fast(words, add_special_tokens=False)]
        return np.array([i for x in ids for i in x], np.uint32), np.array([len(x) for x in ids], np.int64)

    def _encode_parts(self, raw: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids, and the count of them for each part raw[a:b]."""
        size = b - a + 1
        upto = np.concatenate([[0], np.cumsum(size)])
        joined = np.full(upto[-1], 32, np.uint8)
        inside = np.repeat(a - upto[:-1], size) + np.arange(upto[-1])
        inside[upto[1:] - 1] = -1
        joined[inside >= 0] = _LOWER[raw[inside[inside >= 0]]]
        capital = np.flatnonzero((joined[:-1] == _LATIN) & (joined[1:] < 0x9F)) + 1
        joined[capital] += 32
        text = joined.tobytes()
        flat, count = [], []
        for k in range(0, len(a), TOGETHER):
            end = min(len(a), k + TOGETHER)
            some = text[upto[k]:upto[end]].decode()
            ids = np.array(self.parts.encode_batch_fast([some], add_special_tokens=False)[0].ids, np.uint32)
            stops = np.flatnonzero(self.last[ids])
            if len(stops) != end - k or len(ids) != stops[-1] + 1:       # a part did not end in a word end
                ids, sizes = self._encode(some.split())
            else:
                sizes = np.diff(np.append(-1, stops))
            flat.append(ids)
            count.append(sizes)
        return np.concatenate(flat), np.concatenate(count)

    def _slots(self, hashes: np.ndarray, raw: np.ndarray, a: np.ndarray, b: np.ndarray, odd: np.ndarray) -> np.ndarray:
        if len(self.slot) > REMEMBERED_WORDS:
            self.forget()
        known = self.slot.get
        slots = np.array([known(k, -1) for k in hashes.tolist()], np.int64)
        for missing in (np.flatnonzero((slots < 0) & ~odd), np.flatnonzero((slots < 0) & odd)):
            if not len(missing):
                continue
            if odd[missing[0]]:
                ids, sizes = self._encode([raw[i:j].tobytes().decode() for i, j in zip(a[missing].tolist(), b[missing].tolist())])
            else:
                ids, sizes = self._encode_parts(raw, a[missing], b[missing])
            fresh = np.arange(len(missing)) + len(self.size)
            self.at = np.concatenate([self.at, len(self.flat) + np.cumsum(sizes) - sizes])
            self.size = np.concatenate([self.size, sizes])
            self.flat = np.concatenate([self.flat, ids])
            self.slot.update(zip(hashes[missing].tolist(), fresh.tolist()))
            slots[missing] = fresh
        return slots

    def rows(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
        """(row, ids) of every text; a null text is empty."""
        for first, ids, edge in self.slices(texts):
            for i in range(len(edge) - 1):
                yield first + i, ids[edge[i]:edge[i + 1]]

    def slices(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, ids, row offsets into the ids) of consecutive rows."""
        for first, raw, off in text_slices(texts, SLICE_BYTES):
            starts, ends, bound = word_bounds(raw, off)
            if not len(starts):
                yield first, np.zeros(0, np.uint32), np.zeros(len(off), np.int64)
                continue
            a, b, odd = _parts(raw, starts, ends)
            hashes = word_hashes(raw, a)
            if odd.any():                                    # case may matter to them (special tokens)
                hashes[odd] = word_hashes(raw, a, fold=False)[odd] ^ _AS_IS
            distinct, at, which = np.unique(hashes, return_index=True, return_inverse=True)
            slots = self._slots(distinct, raw, a[at], b[at], odd[at])[which]
            sizes = self.size[slots]
            upto = np.concatenate([[0], np.cumsum(sizes)])
            ids = self.flat[np.repeat(self.at[slots] - upto[:-1], sizes) + np.arange(upto[-1])]
            yield first, ids, upto[np.searchsorted(a, off)]


def _parts(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start byte, end byte, whether it is a whole odd word) of every part."""
    kind = _CLASS[raw]
    pair = np.flatnonzero((raw[:-1] == _LATIN) & (raw[1:] != 0x97) & (raw[1:] != 0xB7))       # but for the two signs
    kind[pair] = kind[pair + 1] = _LETTER
    strange = kind == _ODD
    strange[1:] |= (raw[1:] == 124) & (raw[:-1] == 60)       # <|
    seen = np.concatenate([[0], np.cumsum(strange)])
    odd = seen[ends] > seen[starts]
    cut = np.zeros(len(raw), bool)
    cut[1:] = ((kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)) & (kind[1:] != 0)
    if odd.any():
        edge = np.zeros(len(raw) + 1, np.int8)
        edge[starts[odd]] += 1
        edge[ends[odd]] -= 1
        cut &= np.cumsum(edge[:-1], dtype=np.int8) == 0
    cut[starts] = True
    a = np.flatnonzero(cut)
    word = np.searchsorted(starts, a, "right") - 1
    return a, np.minimum(np.append(a[1:], len(raw)), ends[word]), odd[word]


@lru_cache(maxsize=2)
def worker_tokens(vocabulary: str) -> WordTokens:
    """One object per Python worker and vocabulary, kept from task to task."""
    return WordTokens(vocabulary)
