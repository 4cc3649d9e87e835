import random
import re

from pyspark.sql import functions as F

from kpiloom.llm.passages import PASSAGE
from kpiloom.llm.substring_dedup import repeated_spans

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def copied(rows):
    """Words of each row that lie in a run of PASSAGE words an earlier place has, comparing all runs (rows in order of id)."""
    first, gone = {}, {}
    for r, (d, t) in enumerate(rows):
        w = WORD.findall((t or "").lower())
        gone[r] = set()
        for i in range(len(w) - PASSAGE + 1):
            at = first.setdefault(tuple(w[i:i + PASSAGE]), (r, i))
            if at[0] != r or i >= at[1] + PASSAGE:
                gone[r] |= set(range(i, i + PASSAGE))
    return gone


def short(seed, words):
    """Sentences of three to nine words only."""
    r, out = random.Random(seed), []
    while len(out) < words:
        out += [f"w{r.randrange(10**6)}" for _ in range(r.randint(2, 8))] + [f"w{r.randrange(10**6)}{r.choice('.!?')}"]
    return out[:words]


def test_passages_against_brute_force(make_docs, prose):
    r = random.Random(8)
    small, cut, other = short(1, 70), prose(2, 200).split(" "), short(3, 300)
    rows = [(0, " ".join(small)), (1, " ".join(cut)), (2, "é日 " + "\n".join(other))]
    for d in range(3, 30):
        own = short(100 + d, 60)
        at = r.randrange(60)
        source = (small, cut, other)[d % 3]
        n = r.randint(PASSAGE, min(len(source), 120)) if d % 4 else r.randint(30, PASSAGE - 1)
        low = r.randrange(len(source) - n + 1)
        rows.append((d, " ".join([*own[:at], *source[low:low + n], *own[at:]])))
    rows += [(40, " ".join(["same"] * 200)), (41, None), (42, ""), (43, rows[2][1].upper()), (43, rows[2][1].upper())]
    out = repeated_spans(make_docs(rows)).collect()
    spans = {}
    for x in out:
        if x.para is None:
            assert x.run_words == x.words and x.cluster_size > 1 and x.keep_doc_id <= x.doc_id
            spans.setdefault(x.doc_id, []).append((x.start, x.end, x.words))
    want = copied(rows)
    assert sum(map(bool, want.values())) > 20
    for k, (d, t) in enumerate(rows[:-2]):
        words = [(m.start(), m.end()) for m in WORD.finditer(t or "")]
        inside = {i for i, (a, b) in enumerate(words) for s, e, _ in spans.get(d, []) if s <= a and b <= e}
        assert sum(n for *_, n in spans.get(d, [])) == len(inside)                   # whole words, no overlaps
        assert want[k] <= inside                                                      # every long copied run is whole
        if d < 3:
            assert not inside                                                         # first places stay
        elif d < 40:
            source = " ".join((small, cut, other)[d % 3]).lower()
            for s, e, _ in spans.get(d, []):                                          # nothing but copied words goes
                assert " ".join(t[s:e].lower().split()) in source
    assert len(spans[43]) == 2                                                        # both rows of id 43 repeat row 2
    assert len(spans[40]) == 1 and spans[40][0][2] >= 200 - PASSAGE - 1               # its first copy stays


def test_short_sentences_and_cut_sentences(make_docs):
    whole = " ".join(short(5, 60))
    long_ = " ".join(f"v{i}" for i in range(300))
    part = " ".join(f"v{i}" for i in range(100, 160))
    out = repeated_spans(make_docs([(1, whole), (2, "Other. " + whole), (3, long_), (4, "Own words " + part + " and more.")])).collect()
    assert {(x.doc_id, x.start, x.end, x.words, x.keep_doc_id) for x in out} == {
        (2, 7, 7 + len(whole), 60, 1), (4, 10, 10 + len(part), 60, 3)}


def test_empty(make_docs):
    assert repeated_spans(make_docs([])).count() == 0
    assert repeated_spans(make_docs([(1, None), (2, "")])).count() == 0
