"""Benchmark decontamination: greedy string tiling.

Seeds are the ``MIN_MATCH``-word shingles of the benchmark items.  Documents that
share seeds with an item are joined to it on them; pairs whose shared seeds, each at all
its places in the item, hold too few words to reach the threshold are dropped.  For the rest, running Karp-Rabin marks the
longest non-overlapping word matches, longest first, until none of ``MIN_MATCH``
words is left.  A pair is contaminated if the tiles cover at least ``COVERAGE``
of the item's words: order does not count, so reordered passages are caught.

Distinct item texts are taken in blocks of about ``BLOCK_WORDS`` words, whatever the
size of the benchmark (a longer item is a block of its own); only one block is
broadcast at a time.  Tiling takes memory in proportion to the two texts and to the
number of their maximal matches.

Defined results: null texts are empty, and no item without words is matched; an item of
fewer than ``MIN_MATCH`` words is matched where all its words stand in a row (so an item
of one or two common words meets many documents); repeated documents or items give a row each; an empty table on
either side gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import mapped, saved, text_key
from kpiloom.llm.similar import small_side
from kpiloom.llm.words import mix, row_words, windows

MIN_MATCH = 5
COVERAGE = 0.5
BLOCK_WORDS = 1 << 20

_BASE = 0xD6E8FEB86659FD93


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**n modulo 2**64."""
    steps = np.full(n + 1, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


class _Rolling:
    """Karp-Rabin hashes of all windows of any length over a word sequence."""

    def __init__(self, words: np.ndarray) -> None:
        n = len(words)
        self.up, self.down = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(words) * self.up[:n], dtype=np.uint64)])

    def of(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Hashes of the windows of ``n`` words at ``at``."""
        return (self.sums[at + n] - self.sums[at]) * self.down[at]

    def free(self, n: int, marked: np.ndarray) -> np.ndarray:
        """Starts of the windows of n words without a marked one."""
        taken = np.concatenate([[0], np.cumsum(marked)])
        return np.flatnonzero(taken[n:] == taken[:len(taken) - n])


def _room(marked: np.ndarray) -> np.ndarray:
    """Unmarked words from every position on."""
    at = np.where(marked, np.arange(len(marked)), len(marked))
    return np.minimum.accumulate(at[::-1])[::-1] - np.arange(len(marked))


def _matches(item: np.ndarray, doc: np.ndarray, a: _Rolling, b: _Rolling, in_item: np.ndarray, in_doc: np.ndarray,
             n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lengths, item starts, document starts) of the maximal unmarked matches of at least n words, longest first.

    A match begins where its windows agree and the words before them don't, so equal windows inside a longer
    match are never paired: a repetitive text costs as many pairs as it has matches.
    """
    ia, da = a.free(n, in_item), b.free(n, in_doc)
    known, group = np.unique(a.of(ia, n), return_inverse=True)
    hashes = b.of(da, n)
    at = np.searchsorted(known, hashes)
    met = np.flatnonzero(known[np.minimum(at, len(known) - 1)] == hashes) if len(known) else np.zeros(0, np.int64)
    if not len(met):
        return (np.zeros(0, np.int64),) * 3
    da, at = da[met], at[met]
    # the word before a window; 0 where there is none or it is marked (such windows begin a match with any)
    before, which = np.unique(item[ia - 1], return_inverse=True)
    left = np.where((ia > 0) & ~in_item[ia - 1], which + 1, 0)
    place = np.searchsorted(before, doc[da - 1])
    same = (da > 0) & ~in_doc[da - 1] & (before[np.minimum(place, len(before) - 1)] == doc[da - 1])
    step = len(before) + 1
    order = np.argsort(group * step + left, kind="stable")
    code = (group * step + left)[order]
    low, high = np.searchsorted(code, at * step), np.searchsorted(code, (at + 1) * step)
    skip = at * step + np.where(same, place + 1, 0)
    from_, to = np.where(same, np.searchsorted(code, skip), high), np.where(same, np.searchsorted(code, skip, "right"), high)
    count = (from_ - low) + (high - to)
    d, step_in = np.repeat(da, count), np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    head = np.repeat(from_ - low, count)
    i = ia[order][np.where(step_in < head, np.repeat(low, count) + step_in, np.repeat(to, count) + step_in - head)]
    least, most = np.full(len(i), n), np.minimum(_room(in_item)[i], _room(in_doc)[d])
    while (least < most).any():                       # the longest equal stretch, by halving
        mid = (least + most + 1) // 2
        equal = a.of(i, mid) == b.of(d, mid)
        least, most = np.where(equal, mid, least), np.where(equal, most, mid - 1)
    best = np.lexsort((d, i, -least))
    return least[best], i[best], d[best]


def greedy_tiles(item: np.ndarray, doc: np.ndarray, least: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Tiles (item start, document start, length) over word hashes, the longest first (ties: first in the item, then in the document).

    What marked words leave of a match goes back among the matches at its own length; matches with too little left are dropped at once.
    """
    in_item, in_doc = np.zeros(len(item), bool), np.zeros(len(doc), bool)
    n = min(len(item), len(doc))
    if n < least:
        return []
    a, b = _Rolling(item), _Rolling(doc)
    tiles: list[tuple[int, int, int]] = []
    while True:
        length, i_at, d_at = _matches(item, doc, a, b, in_item, in_doc, n)
        rest: list[tuple[int, int, int]] = []         # heap of (-length, item start, document start)
        k = 0
        while (k < len(length) or rest) and not in_item.all():
            now = (-int(length[k]), int(i_at[k]), int(d_at[k])) if k < len(length) else None
            if rest and (now is None or rest[0] < now):
                now = heapq.heappop(rest)
            else:
                k += 1
            m, i, d = -now[0], now[1], now[2]
            marked = in_item[i:i + m] | in_doc[d:d + m]
            if not marked.any():
                in_item[i:i + m] = in_doc[d:d + m] = True
                tiles.append((i, d, m))
                length, i_at, d_at = (x[k:] for x in (length, i_at, d_at))
                used_i, used_d = (np.concatenate([[0], np.cumsum(x)]) for x in (in_item, in_doc))
                left = length - np.maximum(used_i[i_at + length] - used_i[i_at], used_d[d_at + length] - used_d[d_at])
                length, i_at, d_at, k = length[left >= n], i_at[left >= n], d_at[left >= n], 0
                continue
            edge = np.flatnonzero(np.diff(np.concatenate([[True], marked, [True]]).astype(np.int8)))
            for low, high in zip(edge[::2].tolist(), edge[1::2].tolist()):
                if high - low >= n:
                    heapq.heappush(rest, (low - high, i + low, d + low))
        if n == least or in_item.all():
            return tiles
        n = max(least, n // 2)


def _item_blocks(texts: DataFrame, block_words: int) -> Iterator[tuple[list[np.ndarray], DataFrame]]:
    """Blocks of distinct item texts: their words on the driver and as a table (number, item_key, item_words)."""
    total = texts.agg(F.sum("n")).first()[0] or 0
    blocks = -(-total // block_words)
    for k in range(blocks):
        part = texts.where(F.pmod(F.xxhash64("item_key", F.lit(3)), F.lit(blocks)) == k).select("item_key", "text")
        rows = part.collect()                         # about ``block_words`` words, or one longer item
        words = dict(row_words(pa.array([r.text for r in rows], pa.string())))
        kept = [(tuple(r.item_key), words[i]) for i, r in enumerate(rows) if len(words[i])]
        if kept:
            schema = f"number long, item_key {part.schema['item_key'].dataType.simpleString()}, item_words binary"
            yield [w for _, w in kept], texts.sparkSession.createDataFrame(
                [(n, key, bytearray(w.tobytes())) for n, (key, w) in enumerate(kept)], schema)


def _seed_hits(docs: DataFrame, items: list[np.ndarray], least: int) -> DataFrame:
    """(row, doc_id, words, seeds) of the documents that share a seed: their word hashes and distinct shared seeds."""
    seeds = docs.sparkSession.sparkContext.broadcast(np.unique(np.concatenate([windows(w, min(least, len(w))) for w in items])))
    lengths = sorted({min(least, len(w)) for w in items})

    def look(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = seeds.value
        for b in it:
            row, words, shared = [], [], []
            for i, w in row_words(b.column(2)):
                own = np.unique(np.concatenate([windows(w, n) for n in lengths]))
                if len(own):
                    own = own[known[np.minimum(np.searchsorted(known, own), len(known) - 1)] == own]
                    if len(own):
                        row.append(i)
                        words.append(w.tobytes())
                        shared.append(own.view(np.int64))
            at = pa.array(row, pa.int64())
            yield pa.record_batch([b.column(0).take(at), b.column(1).take(at), pa.array(words, pa.binary()),
                                   pa.array(shared, pa.list_(pa.int64()))], ["row", "doc_id", "words", "seeds"])
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.col("text").cast("string").alias("text"))
    return mapped(rows, look, f"row long, doc_id {dict(rows.dtypes)['doc_id']}, words binary, seeds array<long>")


def _seed_words(item: np.ndarray, least: int) -> list[tuple[int, int]]:
    """(seed, item words under it at any of its places) of every distinct seed: the sum over seeds bounds the coverage."""
    least = min(least, len(item))
    seeds, which = np.unique(windows(item, least), return_inverse=True)
    at = np.unique((which[:, None] * len(item) + np.arange(len(which))[:, None] + np.arange(least)).ravel())
    return list(zip(seeds.view(np.int64).tolist(), np.bincount(at // len(item), minlength=len(seeds)).tolist()))


def _tiled(docs: DataFrame, items: list[np.ndarray], table: DataFrame, least: int, coverage: float) -> DataFrame:
    spark = docs.sparkSession
    hits = saved(_seed_hits(docs, items, least))
    seeds = [(s, n, under, int(np.ceil(coverage * len(w) - 1e-9))) for n, w in enumerate(items) for s, under in _seed_words(w, least)]
    seeds = spark.createDataFrame(seeds, "seed long, number long, under long, enough long")     # bounded by the block
    pairs = (hits.select("row", F.explode("seeds").alias("h_seed"))
                 .join(F.broadcast(seeds), F.col("h_seed") == F.col("seed"))
                 .groupBy("row", "number", "enough").agg(F.sum("under").alias("most")).where("most >= enough"))
    full = (hits.select(F.col("row").alias("h_row"), "doc_id", "words").join(pairs, F.col("h_row") == F.col("row"))
                .join(F.broadcast(table), "number").select("doc_id", "item_key", "words", "item_words"))

    def tile(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            n, covered, longest, size = [], [], [], []
            for doc, item in zip(b.column(2), b.column(3), strict=True):
                item = np.frombuffer(item.as_py(), np.uint64)
                tiles = greedy_tiles(item, np.frombuffer(doc.as_py(), np.uint64), min(least, len(item)))
                n.append(len(tiles))
                covered.append(sum(t[2] for t in tiles))
                longest.append(max((t[2] for t in tiles), default=0))
                size.append(len(item))
            yield pa.record_batch([b.column(0), b.column(1), *(pa.array(x, pa.int64()) for x in (size, n, longest, covered))],
                                  ["doc_id", "item_key", "item_length", "n_tiles", "longest_tile", "covered"])
    kinds = dict(full.dtypes)
    out = mapped(full, tile, f"doc_id {kinds['doc_id']}, item_key {kinds['item_key']}, item_length long, n_tiles long, longest_tile long, covered long")
    return out.withColumn("coverage", F.col("covered") / F.col("item_length")).where(F.col("coverage") >= coverage)


def contaminated(docs: DataFrame, benchmark: DataFrame, least: int = MIN_MATCH, coverage: float = COVERAGE,
                 block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, item_id, item_length, n_tiles, longest_tile, covered, coverage) of the contaminated pairs."""
    rough = F.size(F.split("text", r"\s+"))
    named = benchmark.select("item_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    named = saved(named.select("item_id", F.struct(*text_key(F.col("text"))).alias("item_key"), "text", rough.alias("n")))
    texts = named.groupBy("item_key").agg(F.min("text").alias("text"), F.min("n").alias("n"))
    parts = [_tiled(docs, items, table, least, coverage) for items, table in _item_blocks(texts, block_words)]
    if parts:
        ids = named.select("item_id", F.col("item_key").alias("i_key"))
        found = reduce(DataFrame.unionByName, parts)
        return (found.join(ids, F.col("item_key") == F.col("i_key"))
                     .select("doc_id", "item_id", "item_length", "n_tiles", "longest_tile", "covered", "coverage"))
    kinds = (dict(docs.dtypes)["doc_id"], dict(benchmark.dtypes)["item_id"])
    return docs.sparkSession.createDataFrame([], "doc_id {}, item_id {}, item_length long, n_tiles long, longest_tile long, "
                                                 "covered long, coverage double".format(*kinds))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows and columns of ``docs`` less the documents that hold a benchmark item."""
    key = F.struct("doc_id", *text_key(F.col("text")))
    found = saved(contaminated(docs.select(key.alias("doc_id"), "text"), benchmark).select(F.col("doc_id").alias("__kpl_gone")).distinct())
    keyed = docs.select(*docs.columns, key.alias("__kpl_key"))
    return keyed.join(small_side(found), F.col("__kpl_key") == F.col("__kpl_gone"), "left_anti").select(*docs.columns)
