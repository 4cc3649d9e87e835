"""Sharding: minimax contiguous partition of atomic groups.

Groups of equal texts are atomic.  They are ordered by (total size descending,
smallest doc_id) and cut into contiguous shards; the capacity is the smallest
for which a greedy scan needs no more shards than there are, found by binary
search.  The groups stay distributed: the driver sees their boundaries only as
a histogram of bounded size, refined around the possible cuts until the
capacity is exact.

Defined results: a null text has size 8 and forms one group with the other null
texts; an empty table gives no rows; repeated rows are all placed; columns other
than ``doc_id`` and ``text`` are not looked at.  A group above the mean load
takes a shard of its own and the rest is balanced over the others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import KEY, mapped, running, saved, text_key

CELLS = 1 << 12             # histogram cells on the driver per refinement


def cut_points(cells: np.ndarray, start: int, total: int, shards: int) -> tuple[int, list[int], list[tuple[int, int]]]:
    """Minimax cuts over boundaries known as cells (first boundary, last boundary).

    Returns (capacity, cuts, cells to refine); the capacity is exact when no cell
    is left to refine.  Only first and last boundaries serve as cuts; a bound from
    below takes every point inside a cell as a boundary.
    """
    first, last = cells[:, 0], cells[:, 1]
    known = np.unique(np.concatenate([[start], first, last]))

    def sure(x: int) -> int:
        return int(known[np.searchsorted(known, x, "right") - 1])

    def hoped(x: int) -> int:
        i = int(np.searchsorted(first, x, "right")) - 1
        return x if i >= 0 and first[i] < x < last[i] else sure(x)

    def path(capacity: int, step) -> list[int]:
        at = [start]
        for _ in range(shards):
            at.append(step(min(total, at[-1] + capacity)))
        return at

    def least(step) -> int:
        low, high = max(1, -(-(total - start) // shards)), total - start
        while low < high:
            mid = (low + high) // 2
            if path(mid, step)[-1] >= total:
                high = mid
            else:
                low = mid + 1
        return low

    bound, capacity = least(hoped), least(sure)
    cuts = path(capacity, sure)
    if bound >= capacity:
        return capacity, cuts[1:shards], []
    below, above = path(bound, sure), path(capacity, hoped)
    open_cells = {(int(a), int(b)) for a, b in cells if b > a
                  and any(lo < b and a < hi for lo, hi in zip(below, above, strict=True))}
    return capacity, cuts[1:shards], sorted(open_cells)


def _histogram(groups: DataFrame, spans: list[tuple[int, int]], cells: int) -> np.ndarray:
    """(first, last) group end of every cell inside the spans (a, b].

    Ends are put in cells batch by batch, with the spans as data: as expressions
    they would be another plan, and other generated code, for every round.
    """
    low, high = (np.array(x, np.int64) for x in zip(*spans))
    width = np.maximum(1, -(-(high - low) // cells))

    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            end = np.sort(b.column(0).to_numpy())
            k = np.searchsorted(low, end, "right") - 1
            k[(k > 0) & (end == low[k]) & (end <= high[k - 1])] -= 1     # spans may touch: an end belongs to the one before
            inside = (k >= 0) & (end <= high[np.maximum(k, 0)])
            end, k = end[inside], k[inside]
            cell = (end - low[k]) // width[k]
            heads = np.flatnonzero(np.append(True, (cell[1:] != cell[:-1]) | (k[1:] != k[:-1]))[:len(end)])
            tails = np.append(heads[1:], len(end)) - 1 if len(heads) else heads
            yield pa.record_batch([pa.array(x, pa.int64()) for x in (k[heads], cell[heads], end[heads], end[tails])],
                                  ["span", "cell", "first", "last"])

    rows = (mapped(groups.select("end"), cut, "span long, cell long, first long, last long").groupBy("span", "cell")
            .agg(F.min("first"), F.max("last")).collect())               # at most cells x spans rows
    return np.array(sorted({(r[2], r[3]) for r in rows}), np.int64).reshape(-1, 2)


def shard_of_groups(groups: DataFrame, shards: int) -> DataFrame:
    """Adds ``shard`` to groups that carry ``size`` (total) and ``end`` (running total, own size included)."""
    total = groups.agg(F.max("end")).first()[0] or 0
    top = [r[0] for r in groups.orderBy(F.desc("size")).limit(shards).select("size").collect()]
    alone, start = 0, 0
    while alone < min(len(top), shards - 1) and top[alone] * (shards - alone) > total - start:
        start += top[alone]
        alone += 1
    ends = list(np.cumsum(top[:alone]))
    if start < total:
        spans, known = [(start, total)], np.zeros((0, 2), np.int64)
        while True:
            found = _histogram(groups, spans, max(16, CELLS // len(spans)))
            inside = np.zeros(len(known), bool)
            for a, b in spans:
                inside |= (known[:, 0] >= a) & (known[:, 1] <= b)
            known = np.unique(np.concatenate([known[~inside], found]), axis=0)
            known = known[known[:, 1] > start]
            known[:, 0] = np.maximum(known[:, 0], start)
            _, cuts, spans = cut_points(known, start, total, shards - alone)
            if not spans:
                break
        ends += cuts
    cuts = F.array(*[F.lit(int(c)) for c in ends]) if ends else F.array().cast("array<long>")
    return groups.withColumn("shard", F.size(F.filter(cuts, lambda c: c < F.col("end"))).cast("int"))


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row; equal texts share a shard."""
    rows = docs.select("doc_id", *text_key(F.col("text")))
    each = F.greatest(F.col("key_bytes"), F.lit(0)) + 8
    groups = rows.groupBy(*KEY).agg((F.count(F.lit(1)) * F.first(each)).alias("size"), F.min("doc_id").alias("first_id"))
    groups = running(groups, ["size", "first_id", *KEY], ("size",), "size", "before")
    groups = saved(groups.withColumn("end", F.col("before") + F.col("size")))
    homes = shard_of_groups(groups, shards).select(*KEY, "shard")
    placed = (rows.join(homes, KEY)
                  .select("doc_id", each.alias("bytes"), F.when(F.col("key_crc") >= 0, F.col("key_crc")).alias("text_crc32"),
                          "shard", F.lit(1).cast("long").alias("one"), *KEY[:2]))
    # Rows alike in shard, id and text are the same row, so which of them comes first does not show.
    return (running(placed, ["shard", "doc_id", *KEY[:2], "bytes"], (), "one", "slot", run="shard")
            .select("doc_id", F.col("bytes").alias("size"), "text_crc32", "shard", "slot"))
