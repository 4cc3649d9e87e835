import random
import tracemalloc

import numpy as np

from kpiloom.llm.decontaminate import contaminated, drop_contaminated, greedy_tiles


def brute_tiles(a, b, least):
    """Greedy string tiling by comparing all positions."""
    in_a, in_b, tiles = [False] * len(a), [False] * len(b), []
    while True:
        best = (least - 1, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                k = 0
                while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k] and not in_a[i + k] and not in_b[j + k]:
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        n, i, j = best
        if n < least:
            return tiles
        for k in range(n):
            in_a[i + k] = in_b[j + k] = True
        tiles.append(n)


def test_tiles_against_brute_force():
    r = random.Random(4)
    for case in range(120):
        words = range(1, r.choice([3, 8, 40]))
        a = [r.choice(words) for _ in range(r.randint(0, 25))]
        b = [r.choice(words) for _ in range(r.randint(0, 40))]
        if case % 2 and len(a) > 10:
            b[3:3] = a[6:10] + [99] + a[:6]                      # reordered
        least = r.randint(2, 4)
        got = greedy_tiles(np.array(a, np.uint64), np.array(b, np.uint64), least)
        want = brute_tiles(a, b, least)
        assert [t[2] for t in got][:1] == want[:1]               # the longest first
        assert all(x >= y for x, y in zip([t[2] for t in got], [t[2] for t in got][1:]))
        used_a, used_b = set(), set()
        for i, j, n in got:
            assert a[i:i + n] == b[j:j + n] and n >= least
            assert not used_a & set(range(i, i + n)) and not used_b & set(range(j, j + n))
            used_a |= set(range(i, i + n))
            used_b |= set(range(j, j + n))
        left_a = [x if i not in used_a else -1 - i for i, x in enumerate(a)]
        left_b = [x if i not in used_b else -1000 - i for i, x in enumerate(b)]
        assert not brute_tiles(left_a, left_b, least)            # nothing of that length is left


def test_tiles_are_the_longest_first():
    """The tiles of random and repetitive sequences are those of the greedy search over all positions, length by length."""
    r = random.Random(14)
    for _ in range(200):
        words = range(1, r.choice([2, 3, 6, 30]))
        a, b = ([r.choice(words) for _ in range(r.randint(0, 30))] for _ in range(2))
        least = r.randint(1, 5)
        got = greedy_tiles(np.array(a, np.uint64), np.array(b, np.uint64), least)
        assert [t[2] for t in got] == brute_tiles(a, b, least)


def test_long_repetitive_text_takes_bounded_memory():
    item = np.concatenate([np.full(700, 7), np.arange(1000, 1300)]).astype(np.uint64)
    doc = np.concatenate([np.arange(5000, 5100), np.full(1_000_000, 7)]).astype(np.uint64)
    tracemalloc.start()
    assert greedy_tiles(item, doc) == [(0, 100, 700)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 400 * len(doc)                                  # bytes; all pairs of equal windows would be 200 times as many


def test_items_of_few_words(spark, make_docs):
    items = [(1, "Alpha beta gamma delta"), (2, "omega."), (3, "beta gamma"), (4, "Alpha beta gamma delta"), (5, " "), (6, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(1, "so alpha beta gamma delta it is"), (2, "alpha beta delta gamma"), (3, "beta  Gamma"), (4, "omega"), (5, "the omega."),
            (6, ""), (7, None), (8, "delta gamma beta alpha")]
    for block in (1 << 20, 2):
        out = contaminated(make_docs(rows), bench, block_words=block).collect()
        assert sorted((r.doc_id, r.item_id) for r in out) == [(1, 1), (1, 3), (1, 4), (3, 3), (5, 2)]
        assert all(r.coverage == 1 and r.n_tiles == 1 for r in out)


def test_reordered_and_partial_passages(spark, make_docs, prose, hard_rows):
    items = [prose(500 + i, 40) for i in range(12)]
    w = items[3].split(" ")
    rows = [*hard_rows, (20, prose(20, 60) + " " + items[0] + " " + prose(21, 60)),
            (21, prose(22, 30) + " " + " ".join(w[20:] + ["gap"] + w[:20])),                  # reordered
            (22, prose(23, 200) + " " + " ".join(items[5].split(" ")[:12])),                  # too little of it
            (23, items[7].upper()), (23, items[7]), (24, items[1] + "\n" + items[2]), (25, prose(24, 300))]
    bench = spark.createDataFrame([*((i, t, "x") for i, t in enumerate(items)), (90, None, "x"), (91, "", "x"), (92, "The of it.", "x"),
                                   (0, items[0], "x")], "item_id long, text string, coverage string")
    want = sorted([(20, 0), (20, 0), (21, 3), (23, 7), (23, 7), (24, 1), (24, 2)])
    for block in (1 << 20, 100):                                 # one block, many blocks
        out = contaminated(make_docs(rows), bench, block_words=block).collect()
        assert sorted((r.doc_id, r.item_id) for r in out) == want
        assert all(r.coverage >= 0.5 for r in out)
    assert {r.n_tiles for r in out if r.doc_id == 21} == {2}
    kept = drop_contaminated(make_docs(rows), bench)
    assert kept.columns == make_docs([]).columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d) for d, _ in rows if d not in {20, 21, 23, 24})


def test_repetitive_items_against_brute_force(spark, make_docs, prose):
    items = ["na " * 50, "1 2 3 " * 15, ("row col " * 4 + "end ") * 6, prose(600, 20) + " go" * 30, prose(601, 40)]
    rows = [(i, prose(610 + i, 30) + " " + t) for i, t in enumerate(items)]                   # exact copies
    rows += [(10, "na " * 24), (11, "na " * 25), (12, "3 1 2 " * 8), (13, "go " * 26), (14, prose(601, 40)[:90]), (15, "na " * 4)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    want = {}
    for d, t in rows:
        for i, x in enumerate(items):
            a = x.lower().split()
            covered = sum(brute_tiles(a, t.lower().split(), 5))
            if 2 * covered >= len(a):
                want[d, i] = covered
    assert {(i, i) for i in range(5)} <= set(want) and (11, 0) in want and (10, 0) not in want
    assert {(r.doc_id, r.item_id): r.covered for r in contaminated(make_docs(rows), bench).collect()} == want


def test_empty(spark, make_docs):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert contaminated(make_docs([(1, "a b c d e f")]), bench).count() == 0
    full = spark.createDataFrame([(1, "a b c d e f g h")], "item_id long, text string")
    assert contaminated(make_docs([]), full).count() == 0
    assert [r.doc_id for r in drop_contaminated(make_docs([(1, "a b c d e f g h"), (2, "z")]), full).collect()] == [2]
