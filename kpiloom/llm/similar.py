"""Exact links among the members of posting lists, without emitting all their pairs.

Nodes (distinct texts) are posted under tokens.  A list is compared in blocks of
bounded size; a long list is cut into chunks, and each pair of chunks is a block
of its own, so no task holds a list.  Inside a block token collisions are
counted, pairs that meet the count and could still reach the threshold are
verified on their full shingle sets, and only a spanning forest of the links is
returned: the components stay exact, the output is never larger than the block.
A pair is looked at in one list only, the first that both are posted under.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import partitions, saved, ship
from kpiloom.llm.words import jaccard_parts

CHUNK_NODES = 256
CHUNK_BYTES = 4 << 20
SLOT_BYTES = 8 << 20            # blocks are handed over together, about so many bytes at a time
BROADCAST_ROWS = 500_000        # at most so many rows of a few longs are broadcast
PAIRS_AT_ONCE = 1 << 16


def small_side(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (narrow, already saved) marked for broadcast if it has at most ``limit`` rows."""
    return F.broadcast(df) if df.count() <= limit else df


def _forest(bucket: int, node: np.ndarray, size: np.ndarray, tokens: list[np.ndarray], posted: np.ndarray,
            sets: list[np.ndarray], side: np.ndarray, cross: bool, least: int, num: int, den: int) -> list[tuple[int, int]]:
    """Spanning forest of the links in one block: den * intersection >= num * union."""
    m = len(node)
    length = np.array([len(t) for t in tokens])
    flat = np.concatenate(tokens)
    row = np.repeat(np.arange(m), length)
    _, which, count = np.unique(flat, return_inverse=True, return_counts=True)
    kept = count[which] > 1                             # tokens of one member can't collide
    _, col = np.unique(which[kept], return_inverse=True)
    hits = np.zeros((m, int(col.max()) + 1 if len(col) else 1), np.float32)
    hits[row[kept], col] = 1
    first = np.full((m, int(posted.max())), -1, np.int64)
    at = np.concatenate([[0], np.cumsum(length)])
    for i in range(m):
        first[i, :posted[i]] = which[at[i]:at[i] + posted[i]]
    here = which[np.flatnonzero(flat == bucket)[0]]
    together = hits @ hits.T
    together[den * np.minimum.outer(size, size) < num * np.maximum.outer(size, size)] = 0
    if cross:
        together[side[:, None] == side[None, :]] = 0
    i, j = np.nonzero(np.triu(together >= least, 1))
    parent = list(range(m))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    order = np.argsort(-together[i, j], kind="stable")   # likeliest links first, so more pairs are settled by then
    i, j = i[order], j[order]
    for k in range(0, len(i), PAIRS_AT_ONCE):
        a, b = i[k:k + PAIRS_AT_ONCE], j[k:k + PAIRS_AT_ONCE]
        same = ((first[a][:, :, None] == first[b][:, None, :]) & (first[a] >= 0)[:, :, None]).any(2)
        mine = first[a, same.argmax(1)] == here
        for x, y in zip(a[mine].tolist(), b[mine].tolist()):
            u, v = root(x), root(y)
            if u != v:
                both, union = jaccard_parts(sets[x], sets[y])
                if den * both >= num * union:
                    parent[u] = v
                    out.append((int(node[x]), int(node[y])))
    return out


def _pair(bucket: int, tokens: list[np.ndarray], posted: np.ndarray, sets: list[np.ndarray], least: int, num: int, den: int) -> bool:
    """Whether a block of two nodes links them; the same conditions as in ``_forest``, without its tables."""
    a, b = sets
    if den * min(len(a), len(b)) < num * max(len(a), len(b)):
        return False
    if len(np.intersect1d(tokens[0], tokens[1])) < least:
        return False
    second = set(tokens[1][:posted[1]].tolist())
    if next((x for x in tokens[0][:posted[0]].tolist() if x in second), None) != bucket:
        return False
    both, union = jaccard_parts(a, b)
    return den * both >= num * union


def linked(members: DataFrame, sets: DataFrame, num: int, den: int, least: int = 1) -> DataFrame:
    """Edges (a, b) that span the components of all links with den * intersection >= num * union.

    ``members``: bucket, node, size (of its set), tokens (in one global order) and
    posted (the node is posted under its first so many tokens).  ``sets``: node
    and shingles (sorted 64-bit values as bytes), a row per node.  At least
    ``least`` tokens must collide.  Most lists hold two nodes, so blocks are
    handed to Python many at a time, by a hash of the block.
    """
    ship(members.sparkSession)
    lists = saved(members.groupBy(F.col("bucket").alias("l_bucket"))
                    .agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("weight")).where("n > 1"))
    chunks = F.greatest(F.ceil(F.col("n") / CHUNK_NODES), F.ceil(8 * F.col("weight") / CHUNK_BYTES)).cast("int")
    sent = lists.agg(F.sum((F.col("n") * 100 + 8 * F.col("weight")) * chunks)).first()[0] or 0
    slots = max(partitions(members.sparkSession), -(-sent // SLOT_BYTES))
    each = (members.join(small_side(lists), F.col("bucket") == F.col("l_bucket"))
                   .withColumn("chunks", chunks)
                   .withColumn("chunk", F.pmod(F.xxhash64("node", F.lit(7)), F.col("chunks")).cast("int")))
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    dealt = (each.withColumn("other", other)
                 .select("bucket", "node", "size", "tokens", "posted", "chunk", F.least("chunk", "other").alias("low"),
                         F.greatest("chunk", "other").alias("high")))
    full = (dealt.join(sets.withColumnRenamed("node", "s_node"), F.col("node") == F.col("s_node")).drop("s_node")
                 .withColumn("slot", F.pmod(F.xxhash64("bucket", "low", "high"), F.lit(slots))))

    def compare(key: tuple, t: pa.Table) -> pa.Table:
        t = t.sort_by([("bucket", "ascending"), ("low", "ascending"), ("high", "ascending"), ("node", "ascending")])
        bucket, low, high, node, size, posted, chunk = (
            t.column(c).to_numpy().astype(np.int64) for c in ("bucket", "low", "high", "node", "size", "posted", "chunk"))
        listed, shingles = t.column("tokens").combine_chunks(), t.column("shingles")
        flat, at = listed.values.to_numpy(zero_copy_only=False), listed.offsets.to_numpy()
        new = (bucket[1:] != bucket[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
        edge = np.concatenate([[0], np.flatnonzero(new) + 1, [len(bucket)]]).tolist()
        edges = []
        for i, j in zip(edge[:-1], edge[1:]):
            if j - i < 2 or (low[i] != high[i] and (chunk[i:j] == chunk[i]).all()):
                continue
            tokens = [flat[at[k]:at[k + 1]].astype(np.int64) for k in range(i, j)]
            sets_ = [np.frombuffer(x.as_buffer(), np.uint64) for x in shingles.slice(i, j - i)]
            if j - i == 2:
                if _pair(int(bucket[i]), tokens, posted[i:j], sets_, least, num, den):
                    edges.append((int(node[i]), int(node[i + 1])))
            else:
                edges += _forest(int(bucket[i]), node[i:j], size[i:j], tokens, posted[i:j], sets_, chunk[i:j], low[i] != high[i], least, num, den)
        return pa.table({"a": pa.array([e[0] for e in edges], pa.int64()), "b": pa.array([e[1] for e in edges], pa.int64())})

    return full.groupBy("slot").applyInArrow(compare, "a long, b long")
