import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from kpiloom.llm import words as W

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAbB \n\t\x0b.é日", max_size=40)), max_size=8)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_and_shingles_agree_with_plain_python(texts):
    seen, sets = {}, {}
    got_words = dict(W.row_words(pa.array(texts, pa.string())))
    got_sets = dict(W.row_shingles(pa.array(texts, pa.string())))
    assert sorted(got_words) == list(range(len(texts)))
    for i, t in enumerate(texts):
        plain = split(t)
        assert len(plain) == len(got_words[i])
        for w, h in zip(plain, got_words[i].tolist()):
            assert seen.setdefault(w, h) == h
        want = {tuple(plain[k:k + 5]) for k in range(len(plain) - 4)} if len(plain) >= 5 else ({tuple(plain)} if plain else set())
        assert len(want) == len(got_sets[i])
        assert sets.setdefault(frozenset(want), got_sets[i].tobytes()) == got_sets[i].tobytes()
    assert len(set(seen.values())) == len(seen)


def test_slices_do_not_change_the_result():
    texts = pa.array([("w%d " % i) * (i % 7) for i in range(300)])
    whole = [w.tolist() for _, w in W.row_words(texts)]
    old, W.SLICE_BYTES = W.SLICE_BYTES, 16
    try:
        assert [w.tolist() for _, w in W.row_words(texts)] == whole
        assert [w.tolist() for _, w in W.row_words(texts.cast(pa.large_string()))] == whole
        offset = texts.slice(100, 50)
        assert [w.tolist() for _, w in W.row_words(offset)] == whole[100:150]
    finally:
        W.SLICE_BYTES = old


def test_paragraphs_end_with_lines_and_sentences():
    raw = np.frombuffer("one two. three\nfour five! six".encode(), np.uint8)
    starts, ends, bound = W.word_bounds(raw, np.array([0, len(raw)]))
    assert W.paragraph_starts(raw, starts, ends, bound).tolist() == [0, 2, 3, 5]
