import numpy as np
import pytest

from kpiloom.llm.sharding import cut_points, shard_documents


def brute_minimax(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        mid, used, load = (low + high) // 2, 1, 0
        for s in sizes:
            if load + s > mid:
                used, load = used + 1, 0
            load += s
        low, high = (low, mid) if used <= shards else (mid + 1, high)
    return low


@pytest.mark.parametrize("seed", range(20))
def test_capacity_is_the_smallest_feasible(seed):
    r = np.random.default_rng(seed)
    sizes = r.integers(1, 50, r.integers(5, 200)).tolist()
    ends = np.cumsum(sizes)
    shards = int(r.integers(1, 9))
    # coarse cells first: the bound must never pass for exact, refined cells must give the optimum
    cells = np.array([(c.min(), c.max()) for c in np.array_split(ends, min(6, len(ends))) if len(c)])
    capacity, _, more = cut_points(cells, 0, int(ends[-1]), shards)
    assert capacity >= brute_minimax(sizes, shards)
    assert more or capacity == brute_minimax(sizes, shards)
    capacity, cuts, more = cut_points(np.stack([ends, ends], 1), 0, int(ends[-1]), shards)
    assert not more and capacity == brute_minimax(sizes, shards)
    assert max(np.diff([0, *cuts, ends[-1]])) == capacity or len(cuts) < shards


def test_shards_of_a_corpus(spark, make_docs, prose, hard_rows):
    rows = hard_rows[:6] + [(100 + i, prose(i, 5 + i % 40)) for i in range(300)] + [(1000 + i, prose(7, 12)) for i in range(40)]
    out = shard_documents(make_docs(rows), 6).toPandas()
    assert len(out) == len(rows)
    assert sorted(out["size"]) == sorted(len((t or "").encode()) + 8 for _, t in rows)
    for _, s in out.groupby("shard"):
        assert sorted(s.slot) == list(range(len(s)))
    homes = {}
    text = {}
    for i, t in rows:
        text.setdefault(i, t)
    for r in out.itertuples():
        if r.doc_id >= 100:
            assert homes.setdefault(text[r.doc_id], r.shard) == r.shard          # equal texts stay together
    groups = {}
    for _, t in rows:
        groups[t] = groups.get(t, 0) + len((t or "").encode()) + 8
    load = out.groupby("shard")["size"].sum()
    assert load.max() == brute_minimax(sorted(groups.values(), reverse=True), 6)


def test_a_hot_group_takes_one_shard_and_the_rest_is_balanced(make_docs, prose):
    rows = [(i, "hot " * 20) for i in range(200)] + [(1000 + i, prose(i, 20)) for i in range(200)]
    out = shard_documents(make_docs(rows), 5).toPandas()
    load = out.groupby("shard")["size"].sum().sort_values()
    assert out[out.doc_id < 1000].shard.nunique() == 1
    rest = load.drop(out[out.doc_id < 1000].shard.iloc[0])
    assert len(rest) == 4 and rest.max() < 1.1 * rest.min()


def test_empty(make_docs):
    assert shard_documents(make_docs([]), 24).count() == 0
