"""Best-fit packing by bin completion.

Documents become token pieces of at most ``capacity`` (only longer documents are
cut, the last piece may be shorter).  Full pieces are sequences by themselves.
The others are dealt into groups of bounded size; each group is packed by bin
completion: around the largest piece left, undominated fillings are enumerated
and tried in order of waste, branches whose waste exceeds what the incumbent
allows are cut, and best-fit decreasing gives the first incumbent.  Sequences
that a group leaves with more than a hundredth unfilled are dealt again for a
second round, so the loss is not one sequence per group.

Defined results: a null or empty text is one piece (the end id alone); repeated
rows are packed each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import mapped, saved, ship
from kpiloom.llm.tokens import worker_tokens

CAPACITY = 4096
END_ID = 1
GROUP_PIECES = 4096        # pieces packed together
BRANCHES = 4               # fillings tried at one node
NODES = 6                  # search effort of a group, as nodes per sequence


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every piece of every row."""
    def pieces(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = worker_tokens(vocabulary)
        for b in it:
            row, piece, start, length, crc = [], [], [], [], []
            for i, ids in tokens.rows(b.column(1)):
                ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                for k, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at:at + capacity]
                    row.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
            yield pa.record_batch([b.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                                   *(pa.array(x, pa.int64()) for x in (start, length, crc))],
                                  ["doc_id", "piece", "start", "length", "ids_crc32"])
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    return mapped(rows, pieces, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


class _Stock:
    """Lengths left to pack: sorted distinct lengths and their counts."""

    def __init__(self, lengths: list[int]) -> None:
        self.count: dict[int, int] = {}
        for n in lengths:
            self.count[n] = self.count.get(n, 0) + 1
        self.kinds = sorted(self.count)

    def take(self, items: tuple[int, ...]) -> None:
        for n in items:
            self.count[n] -= 1
            if not self.count[n]:
                del self.kinds[bisect_left(self.kinds, n)]

    def give(self, items: tuple[int, ...]) -> None:
        for n in items:
            if not self.count[n]:
                self.kinds.insert(bisect_left(self.kinds, n), n)
            self.count[n] += 1

    def left(self, n: int, used: tuple[int, ...]) -> bool:
        return self.count[n] > used.count(n)

    def largest(self, most: int, used: tuple[int, ...] = ()) -> int:
        """Largest length up to ``most`` of which more is left than ``used`` takes; 0 if none."""
        i = bisect_right(self.kinds, most) - 1
        while i >= 0 and used and not self.left(self.kinds[i], used):
            i -= 1
        return self.kinds[i] if i >= 0 else 0


def best_fit(lengths: list[int], capacity: int) -> list[tuple[int, ...]]:
    """Best-fit decreasing."""
    room: list[tuple[int, int]] = []            # (room, sequence), sorted
    out: list[list[int]] = []
    for n in sorted(lengths, reverse=True):
        i = bisect_left(room, (n, -1))
        if i < len(room):
            r, k = room.pop(i)
            out[k].append(n)
        else:
            r, k = capacity, len(out)
            out.append([n])
        at = (r - n, k)
        room.insert(bisect_left(room, at), at)
    return [tuple(x) for x in out]


def _fillings(stock: _Stock, first: int, room: int) -> list[tuple[int, ...]]:
    """Undominated fillings of ``room`` beside ``first``, least waste first, at most ``BRANCHES``.

    Fillings are led by each of the largest lengths that fit and completed by
    the largest that fit after it.  A filling is dominated if one length left
    could stand for one of its members or a pair of them and waste less.
    """
    base = (first,)
    found: dict[tuple[int, ...], int] = {}
    at = bisect_right(stock.kinds, room)
    for lead in reversed(stock.kinds[max(0, at - 24):at]):
        if not stock.left(lead, base):
            continue
        one, rest = base + (lead,), room - lead
        for second in (stock.largest(rest, one), stock.largest(rest // 2, one), stock.largest(2 * rest // 3, one)):
            chosen, slack = one, rest
            nxt = second
            while nxt:
                chosen, slack = chosen + (nxt,), slack - nxt
                nxt = stock.largest(slack, chosen) if slack else 0
            found[chosen[1:]] = slack
            if not slack:
                break
        if sum(not s for s in found.values()) >= BRANCHES:
            break

    def dominated(items: tuple[int, ...], slack: int) -> bool:
        used = base + items
        groups = [*items, *(a + b for a, b in pairwise(items))]
        return slack > 0 and any(stock.largest(n + slack, used) > n for n in groups)

    best = sorted(found.items(), key=lambda x: (x[1], len(x[0])))
    kept = [f for f, s in best if not dominated(f, s)] or [f for f, _ in best]
    return kept[:BRANCHES] or [()]


def complete_bins(lengths: list[int], capacity: int) -> list[tuple[int, ...]]:
    """As few sequences as the bounded search finds for these lengths."""
    best = best_fit(lengths, capacity)
    total = sum(lengths)
    bound = -(-total // capacity)
    stock, done, waste = _Stock(lengths), [], 0
    effort = NODES * (len(best) + 1)
    path: list[list[tuple[int, ...]]] = []       # fillings still to try at each depth

    while len(best) > bound and effort > 0:
        allowed = (len(best) - 1) * capacity - total
        if waste > allowed or not stock.kinds:
            if not stock.kinds and len(done) < len(best):
                best = list(done)
            while path:                          # back to the deepest node with a choice left
                last = done.pop()
                stock.give(last)
                waste -= capacity - sum(last)
                if path[-1]:
                    break
                path.pop()
            if not path:
                break
        else:
            first = stock.kinds[-1]
            path.append([(first, *f) for f in reversed(_fillings(stock, first, capacity - first))])
        chosen = path[-1].pop()
        stock.take(chosen)
        done.append(chosen)
        waste += capacity - sum(chosen)
        effort -= 1
    return best


def _packed(capacity: int, base: int):
    """An ``applyInArrow`` function that packs the pieces of one group."""
    def pack(key: tuple, pieces: pa.Table) -> pa.Table:
        pieces = pieces.sort_by([("length", "descending"), ("tie", "ascending")])
        lengths = pieces.column("length").to_numpy().astype(np.int64)
        rows: dict[int, list[int]] = {}
        for i in range(len(lengths) - 1, -1, -1):
            rows.setdefault(int(lengths[i]), []).append(i)
        sequence, offset, fill = (np.zeros(len(lengths), np.int64) for _ in range(3))
        number = (base << 56) + (key[0].as_py() << 24)
        for k, items in enumerate(complete_bins(lengths.tolist(), capacity)):
            at = 0
            for n in items:
                i = rows[n].pop()
                sequence[i], offset[i], fill[i] = number + k, at, sum(items)
                at += n
        for name, x in (("sequence_id", sequence), ("offset", offset), ("fill", fill)):
            pieces = pieces.append_column(name, pa.array(x))
        return pieces.drop_columns(["part"])
    return pack


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece."""
    pieces = saved(token_pieces(docs, vocabulary, capacity).withColumn("tie", F.monotonically_increasing_id()))
    out = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    full = (pieces.where(F.col("length") == capacity)
                  .withColumns({"sequence_id": -1 - F.col("tie"), "offset": F.lit(0).cast("long")}).select(*out))

    def one_round(left: DataFrame, number: int) -> DataFrame:
        groups = max(1, -(-left.count() // GROUP_PIECES))
        schema = ", ".join(f"{n} {t}" for n, t in left.dtypes) + ", sequence_id long, offset long, fill long"
        ship(left.sparkSession)
        dealt = left.withColumn("part", F.pmod(F.xxhash64("tie"), F.lit(groups)))
        return saved(dealt.groupBy("part").applyInArrow(_packed(capacity, number), schema))

    first = one_round(pieces.where(F.col("length") < capacity), 1)
    tight = F.col("fill") * 100 >= 99 * capacity
    second = one_round(first.where(~tight).drop("sequence_id", "offset", "fill"), 2)
    return full.unionByName(first.where(tight).select(*out)).unionByName(second.select(*out))
