"""Periodic runs of words, found online on sparse diagonals, and texts collapsed to one period.

A run is a stretch of consecutive words with smallest period q and at least
max(``MIN_LENGTH``, ``MIN_PERIODS`` * q) words that no neighbouring word extends
with period q.

A word and an earlier equal one lie on a diagonal, its lag.  To keep diagonals
sparse a word is met together with the words before it: on level g (16, 32, 64,
...) an occurrence is a window of g words that ends here, and only its latest
earlier occurrence counts, if its lag is at most g.  Words are passed in order;
an occurrence on the diagonal that was active one word before adds one to its
match length, else it starts anew with g; a diagonal that is not extended ends,
and is emitted if the match is long enough.

Why nothing is missed: a run of period q and n words has n - q matches on
diagonal q, at least ``MIN_LENGTH`` - q and 2q of them, so never fewer than 16
(for three periods and 24 words).  On the least level g >= q every window
inside the run has its latest earlier occurrence exactly q words before: a
closer one would give the run a smaller period.  So its diagonal is active from
the first such window to the last.  Levels end where three periods no longer
fit the text, so the work of a text of n words is O(n log n), whatever it repeats.

Defined results: a null text is empty, an empty or blank text has no words, no
runs and collapses to nothing; repeated rows give a row each; an empty table
gives no rows; columns but ``doc_id`` and ``text`` are not looked at.  Very long
texts are scanned whole, one at a time.  64-bit hashes stand for words.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import mapped
from kpiloom.llm.words import text_slices, windows, word_bounds, word_hashes

MIN_LENGTH = 24
MIN_PERIODS = 3
LEAST_WINDOW = 16          # matches of the shortest run: min over q of max(24 - q, 2q)

Run = tuple[int, int, int]      # start, length, period


def _occurrences(words: np.ndarray, bound: np.ndarray, g: int) -> tuple[np.ndarray, np.ndarray]:
    """(last word, lag) of the windows of g words whose latest earlier occurrence in the same row is at most g words back."""
    hashes = windows(words, g) if g == LEAST_WINDOW else _doubled(words, g)
    row = np.searchsorted(bound, np.arange(len(hashes)), "right")
    inside = np.flatnonzero(np.arange(len(hashes)) + g <= bound[np.minimum(row, len(bound) - 1)])
    order = inside[np.argsort(hashes[inside], kind="stable")]
    same = (hashes[order][1:] == hashes[order][:-1]) & (row[order][1:] == row[order][:-1])
    lag = order[1:] - order[:-1]
    near = same & (lag <= g)
    at = order[1:][near] + g - 1
    up = np.argsort(at, kind="stable")
    return at[up], lag[near][up]


def _doubled(words: np.ndarray, g: int) -> np.ndarray:
    """Hashes of all windows of g words (a power of two), from those of half the size."""
    hashes, size = windows(words, LEAST_WINDOW), LEAST_WINDOW
    while size < g and len(hashes) > size:
        hashes = windows(np.stack([hashes[:-size], hashes[size:]], 1).reshape(-1), 2)[::2]
        size *= 2
    return hashes if size == g else np.zeros(0, np.uint64)


def _emitted(at: list[int], lag: list[int], g: int, least: int, least_periods: int) -> Iterator[Run]:
    """Online pass over the occurrences of one row: match lengths of the active lags; runs as their diagonals end."""
    active: dict[int, list[int]] = {}           # lag: [last word, match length]

    def run(p: int, last: int, matches: int) -> Iterator[Run]:
        if matches + p >= max(least, least_periods * p):
            yield last - matches - p + 1, matches + p, p

    for i, p in zip(at, lag):
        state = active.get(p)
        if state and state[0] == i - 1:
            state[0] = i
            state[1] += 1
        else:
            if state:
                yield from run(p, *state)
            active[p] = [i, g]
    for p, state in active.items():
        yield from run(p, *state)


def runs_of_rows(words: np.ndarray, bound: np.ndarray, least: int = MIN_LENGTH,
                 least_periods: int = MIN_PERIODS) -> dict[int, list[Run]]:
    """Runs of every row that has any, by start, then period; starts count from the row's first word."""
    found: dict[int, set[Run]] = {}
    longest = int(np.diff(bound).max()) if len(bound) > 1 else 0
    g = LEAST_WINDOW
    while g <= longest:
        at, lag = _occurrences(words, bound, g)
        rows = np.searchsorted(bound, at, "right") - 1
        heads = np.flatnonzero(np.append(True, rows[1:] != rows[:-1])) if len(rows) else rows
        for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(rows)]):
            r = int(rows[a])
            for s, n, p in _emitted(at[a:b].tolist(), lag[a:b].tolist(), g, least, least_periods):
                found.setdefault(r, set()).add((s - int(bound[r]), n, p))
        if least_periods * g >= longest:         # a longer period has no room
            break
        g *= 2
    out = {}
    for r, some in found.items():
        least_period: dict[tuple[int, int], int] = {}
        for s, n, p in some:
            least_period[s, n] = min(p, least_period.get((s, n), p))
        out[r] = sorted((s, n, p) for (s, n), p in least_period.items())
    return out


def repeated_from(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """(a, p) of the documents whose words from a on repeat with period p by the query's contract; else None."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def dropped_words(n: int, runs: list[Run]) -> np.ndarray:
    """Words that some run holds after its first period."""
    edge = np.zeros(n + 1, np.int64)
    for s, length, p in runs:
        edge[s + p] += 1
        edge[s + length] -= 1
    return np.cumsum(edge[:-1]) > 0


def _plain(raw: np.ndarray, off: np.ndarray, starts: np.ndarray, ends: np.ndarray, bound: np.ndarray) -> list[bytes]:
    """The words of every row joined by one space."""
    keep = np.zeros(len(raw) + 1, np.int8)
    keep[starts] += 1
    keep[ends] -= 1
    inside = np.cumsum(keep[:-1], dtype=np.int8) > 0
    after = ends[ends < len(raw)]
    after = after[~inside[after]]                # a word that ends its row may touch the next row's first
    inside[after] = True
    out = raw.copy()
    out[after] = 32
    upto = np.concatenate([[0], np.cumsum(inside)])
    joined, cut = out[inside].tobytes(), upto[off].tolist()
    some = np.diff(bound) > 0
    rows = []
    for i in range(len(off) - 1):
        x = joined[cut[i]:cut[i + 1]]
        rows.append((x[:-1] if x.endswith(b" ") else x).lstrip(b" ") if some[i] else b"")
    return rows


def collapse_runs(docs: DataFrame, least: int = MIN_LENGTH, least_periods: int = MIN_PERIODS,
                  rewrite: Callable[[int | None, int], tuple[int, int] | None] | None = None) -> DataFrame:
    """(doc_id, n_words, runs array of (start, length, period), collapsed text) of every row.

    The collapsed text has the words that no run holds after its first period,
    joined by one space.  ``rewrite(doc_id, n)`` may give (a, p): the words from a
    on are then read as the p words at a, over and over.
    """
    def scan(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            ids = b.column(0)
            counts, runs_out, texts = [], [], []
            for first, raw, off in text_slices(b.column(1)):
                starts, ends, bound = word_bounds(raw, off)
                index = np.arange(len(starts))
                changed = set()
                for i in range(len(off) - 1):
                    n = int(bound[i + 1] - bound[i])
                    if rewrite and (at := rewrite(ids[first + i].as_py(), n)):
                        changed.add(i)
                        low = int(bound[i]) + at[0]
                        index[low:bound[i + 1]] = low + np.arange(n - at[0]) % at[1]
                words = word_hashes(raw, starts, fold=False)[index]
                runs = runs_of_rows(words, bound, least, least_periods)
                plain = _plain(raw, off, starts, ends, bound)
                for i in range(len(off) - 1):
                    lo, hi = int(bound[i]), int(bound[i + 1])
                    here = runs.get(i, [])
                    counts.append(hi - lo)
                    runs_out.append([{"start": s, "length": n, "period": p} for s, n, p in here])
                    if i in changed or here:
                        kept = index[lo:hi][~dropped_words(hi - lo, here)]
                        texts.append(b" ".join(raw[x:y].tobytes() for x, y in zip(starts[kept].tolist(), ends[kept].tolist())))
                    else:
                        texts.append(plain[i])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
            yield pa.record_batch([ids, pa.array(counts, pa.int64()), pa.array(runs_out, kind),
                                   pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    return mapped(rows, scan, f"doc_id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def digest(found: DataFrame) -> DataFrame:
    """The run of greatest exponent and the hashes of all runs and of the collapsed text."""
    greater = F.aggregate(
        "runs", F.lit(None).cast("struct<start: long, length: long, period: long>"),
        lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"),
                                                   F.lit(","), r["period"].cast("string"), F.lit("\n")))
    best = F.col("best")
    return (found.withColumn("best", greater)
                 .select("doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"),
                         best["length"].alias("length"), best["period"].alias("period"),
                         F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
                         F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
                         F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")))
