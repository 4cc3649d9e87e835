"""Periodic runs against a brute-force search over all starts and periods."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest

from kpiloom.llm.periodic import collapse_runs, digest, repeated_from


def brute_runs(w, least=24, periods=3):
    n, found = len(w), {}
    for p in range(1, n // periods + 1):
        i = p
        while i < n:
            if w[i] != w[i - p]:
                i += 1
                continue
            e = i
            while e < n and w[e] == w[e - p]:
                e += 1
            s, length = i - p, e - i + p
            if length >= max(least, periods * p):
                found.setdefault((s, length), p)         # the smallest period comes first
            i = e
    return sorted((s, length, p) for (s, length), p in found.items())


def brute(doc_id, text, rewritten=True):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if rewritten and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    runs = brute_runs(w)
    kept = [x for i, x in enumerate(w) if not any(s + p <= i < s + ln for s, ln, p in runs)]
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    return (doc_id, len(runs), *best, best[1] * 1000 // best[2] if runs else None,
            hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(kept).encode()).hexdigest())


def key(rows):
    return sorted(map(tuple, rows), key=str)


def periodic_rows():
    r = random.Random(11)
    rows = []
    for k in range(150):
        words, letters = [], "abcdefgh"[:r.randint(1, 8)]
        for _ in range(r.randint(1, 6)):
            kind = r.random()
            if kind < 0.3:
                words += [f"u{r.random()}" for _ in range(r.randint(0, 30))]
            else:
                base = [r.choice(letters) for _ in range(r.choice([1, 2, 3, 5, 7, 8, 9, 12, 15, 16, 17, 31, 33, 40]))]
                words += (base * 12)[:r.randint(1, len(base) * r.randint(1, 6))]
        rows.append((k, r.choice([" ", "\n", "\t  ", "\x0b"]).join(words)))
    return rows


def test_runs_against_brute_force(make_docs):
    rows = periodic_rows()
    got = digest(collapse_runs(make_docs(rows), rewrite=repeated_from)).collect()
    want = key(brute(*r) for r in rows)
    assert key(got) == want
    assert sum(x[1] > 1 for x in want) > 5 and sum(x[1] == 0 for x in want) > 5


def test_hard_rows_against_brute_force(make_docs, hard_rows):
    rows = [r for r in hard_rows if not r[1] or len(r[1]) < 9000] + [(20, "a " * 30), (30, " \x1c a  " * 40), (40, "ß é " * 25)]
    got = digest(collapse_runs(make_docs(rows), rewrite=repeated_from)).collect()
    assert key(got) == key(brute(*r) for r in rows)
    assert digest(collapse_runs(make_docs([]))).collect() == []


@pytest.mark.parametrize("unit, times", [(["a"], 600_000), (["a", "b", "a"], 200_000), ([f"w{i}" for i in range(40_000)], 5)])
def test_very_long_repetitive_texts(make_docs, unit, times):
    """600,000 words and more in one text, one run over all of them."""
    got = collapse_runs(make_docs([(1, "x1 " + " ".join(unit * times) + " x2")])).first()
    assert [tuple(r) for r in got["runs"]] == [(1, len(unit) * times, len(unit))]
    assert got["collapsed"] == " ".join(["x1", *unit, "x2"])


def test_rewritten_words_make_the_planted_run(make_docs, prose):
    rows = [(d, prose(d, 300)) for d in range(200)]
    planted = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 10 == 0]
    got = digest(collapse_runs(make_docs(rows), rewrite=repeated_from))
    assert key(got.collect()) == key(brute(*r) for r in rows)
    assert got.where("n_runs > 0").count() >= len(planted) // 2 > 5
