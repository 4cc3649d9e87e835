import zlib

import numpy as np
import pytest

from kpiloom.llm.packing import best_fit, complete_bins, pack_documents
from kpiloom.llm.queries import vocabulary
from kpiloom.llm.tokens import WordTokens


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(vocabulary())


def test_ids_equal_the_tokenizer(tokenizer, hard_rows, monkeypatch):
    import pyarrow as pa
    from kpiloom.llm import tokens as T
    texts = [t for _, t in hard_rows] + ["Crème BRÛLÉE İstanbul ΣΑΣ Σ ﬁ é 日本語 <|endoftext|> don't 12½ a b\u0085c\x1cd",
                                         "x" * 3000 + " it's!!! <|startoftext|><|x|> '''s'd'll 1e5*** \u00a0\u00ad end", "\x00\x01 a\x00b"]
    monkeypatch.setattr(T, "REMEMBERED_WORDS", 50)
    monkeypatch.setattr(T, "SLICE_BYTES", 64)
    got = dict(WordTokens(vocabulary()).rows(pa.array(texts, pa.string())))
    for i, t in enumerate(texts):
        assert got[i].tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids


def test_ids_of_every_latin_letter(tokenizer):
    """All code points up to U+052F as capitals and inside words, beside digits, signs and apostrophes."""
    import random
    import pyarrow as pa
    r = random.Random(7)
    texts = [f"{chr(c)}aya B{chr(c)} {chr(c)}1.{chr(c)}'s" for c in range(1, 0x530)] + ["Ɗaya Ɓera", "<|ENDOFTEXT|> <|endoftext|> <||>"]
    texts += ["".join(r.choice(" \n\tabXYZ019.,'<|>_-sétdllvÉßΣİǅ\u0301×÷À") for _ in range(r.randint(0, 30))) for _ in range(3000)]
    got = dict(WordTokens(vocabulary()).rows(pa.array(texts, pa.string())))
    wrong = [t for i, t in enumerate(texts) if got[i].tolist() != tokenizer.encode(t, add_special_tokens=False).ids]
    assert not wrong, wrong[:5]


def fewest(lengths, capacity):
    """Smallest number of sequences, by trying all (small cases)."""
    lengths = sorted(lengths, reverse=True)
    best = [len(lengths)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(rooms)
            return
        for k in {r: j for j, r in enumerate(rooms) if r >= lengths[i]}.values():
            place(i + 1, [*rooms[:k], rooms[k] - lengths[i], *rooms[k + 1:]])
        place(i + 1, [*rooms, capacity - lengths[i]])
    place(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(25))
def test_bin_completion_is_valid_and_close_to_the_optimum(seed):
    r = np.random.default_rng(seed)
    lengths = r.integers(1, 60, 11).tolist()
    got = complete_bins(lengths, 100)
    assert sorted(x for b in got for x in b) == sorted(lengths)
    assert all(sum(b) <= 100 for b in got)
    assert fewest(lengths, 100) <= len(got) <= min(len(best_fit(lengths, 100)), fewest(lengths, 100) + 1)


def test_bin_completion_beats_best_fit():
    lengths = [51, 27, 26, 23, 23, 25, 25, 50, 50] * 3
    assert len(complete_bins(lengths, 100)) == 9
    assert complete_bins([], 100) == []


def test_round_trip(make_docs, tokenizer, hard_rows, prose):
    rows = [*hard_rows, *((100 + i, prose(i, 5 + 37 * (i % 30))) for i in range(150))]
    out = pack_documents(make_docs(rows), vocabulary(), 512).toPandas()
    want = []
    for d, t in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        want += [(d, k, a, len(ids[a:a + 512]), zlib.crc32(ids[a:a + 512].tobytes())) for k, a in enumerate(range(0, len(ids), 512))]
    got = [(None if r.doc_id != r.doc_id else int(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in out.itertuples()]
    assert sorted(got, key=str) == sorted(want, key=str)
    for _, s in out.sort_values("offset").groupby("sequence_id"):
        assert s.length.sum() <= 512
        assert (s.offset == s.length.cumsum() - s.length).all()
    total = out.length.sum()
    assert out.sequence_id.nunique() <= 1.02 * total / 512 + 1


def test_empty(make_docs):
    assert pack_documents(make_docs([]), vocabulary()).count() == 0
