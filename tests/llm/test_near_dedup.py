import random
import re

import pytest

from kpiloom.llm.components import components
from kpiloom.llm.near_dedup import keep_one, near_duplicates

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, len(s), d if not s else least.get(root(i))) for i, (d, s) in enumerate(zip([r[0] for r in rows], sets))),
                  key=str)


def edited(text, n, r):
    w = text.split(" ")
    for _ in range(n):
        w[r.randrange(len(w))] = f"edit{r.randrange(10**6)}"
    return " ".join(w)


@pytest.mark.parametrize("chunk", [256, 3])
def test_components_agree_with_brute_force(make_docs, prose, hard_rows, monkeypatch, chunk):
    from kpiloom.llm import similar
    monkeypatch.setattr(similar, "CHUNK_NODES", chunk)           # long lists are cut into chunk pairs
    r = random.Random(5)
    rows = list(hard_rows)
    for g in range(6):
        base = prose(50 + g, 120)
        for k in range(12):
            rows.append((100 * g + k + 20, edited(base, r.randint(0, 5), r)))
    chain = prose(99, 150)
    for k in range(15):                                          # each near the one before, not near the first
        rows.append((900 - k, chain))
        chain = edited(chain, 2, r)
    rows += [(2000 + i, prose(3000 + i, 50)) for i in range(30)]
    out = near_duplicates(make_docs(rows))
    got = sorted(((x.doc_id, x.n_shingles, x.component_id) for x in out.collect()), key=str)
    assert got == brute(rows)
    assert all(x.kept == (x.doc_id == x.component_id) for x in out.collect())


def test_keep_one_leaves_one_row_of_each_group(make_docs, prose):
    base, other = prose(1, 100), prose(2, 100)
    rows = [(5, base), (5, base), (3, base), (3, other), (8, other + " x"), (9, ""), (9, ""), (None, None), (4, prose(3, 30))]
    out = keep_one(make_docs(rows))
    assert out.columns == make_docs([]).columns
    assert sorted(((x.doc_id, x.text) for x in out.collect()), key=str) == sorted(
        [(3, base), (3, other), (9, ""), (9, ""), (None, None), (4, prose(3, 30))], key=str)


def test_components_of_long_paths_and_stars(spark):
    r = random.Random(1)
    path = [(i, i + 1) for i in range(0, 300)]
    star = [(1000, 1001 + i) for i in range(200)]
    edges = path + star + [(5000, 5000)]
    r.shuffle(edges)
    got = {x.node: x.component for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(301)}, **{1000 + i: 1000 for i in range(201)}}


def test_empty(make_docs, spark):
    assert near_duplicates(make_docs([])).count() == 0
    assert keep_one(make_docs([])).count() == 0
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
