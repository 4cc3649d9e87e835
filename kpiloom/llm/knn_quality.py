"""Quality classifier: nearest-neighbour voting over latent-semantic vectors.

Terms of a text are word shapes (case, tail, length, doubling, repetition) and
byte pairs, hashed into a fixed number of places.  Inverse document frequencies
come from all documents.  A bounded sample of labelled texts (``rows``) gives
the latent space (truncated SVD of the weighted term matrix) and the labelled
vectors.  Both are broadcast; their size is at most ``rows`` x ``dims`` +
``TERMS`` x ``dims`` floats.  Every document meets every labelled vector in
exact cosine products, block by block; the nearest labels vote with weights
that rise with the similarity.

Defined results: a null or empty text has no terms and gets the sample's share
of good texts as its score; without labels every score is 0.5; repeated rows are
scored each; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import mapped
from kpiloom.llm.labelled import fold, training_sample
from kpiloom.llm.words import row_blocks, text_slices, windows, word_bounds, word_hashes

SHAPES, PAIRS = 1024, 1024
TERMS = SHAPES + PAIRS
ROWS = 4000              # labelled documents in the sample, at most
DIMS = 48
NEIGHBOURS = 25
SHARPNESS = 12           # exponent of the similarity in a vote
THRESHOLD = 0.3
BLOCK = 256              # documents in a block of products

_KIND = np.zeros(256, np.uint8)                       # class of a byte
for _k, _set in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".", b",;:",
                           b"!?", b"#*$%&<>", b"|", b"\"'()[]{}-_/")):
    _KIND[list(_set)] = _k + 1
_KIND[128:] = 1                                       # letters beyond ASCII
_PAIR = (np.arange(1 << 16, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(54)).astype(np.int64)


def _repeated(words: np.ndarray, bound: np.ndarray, n: int = 5) -> np.ndarray:
    """Whether each word lies in a window of n words that its text has twice or more."""
    out = np.zeros(len(words), bool)
    every = windows(words, n)
    for a, b in zip(bound[:-1].tolist(), bound[1:].tolist()):
        if b - a > n:
            _, which, count = np.unique(every[a:b - n + 1], return_inverse=True, return_counts=True)
            hit = np.flatnonzero(count[which] > 1)
            if len(hit):
                for k in range(n):
                    out[a + hit + k] = True
    return out


def term_counts(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, counts [rows x TERMS]) of consecutive rows."""
    for first, raw, off in text_slices(texts):
        for a, b in row_blocks(off, BLOCK):
            part, edge = raw[off[a]:off[b]], off[a:b + 1] - off[a]
            counts = np.zeros((b - a, TERMS), np.float32)
            starts, ends, bound = word_bounds(part, edge)
            if len(starts):
                row = np.repeat(np.arange(b - a), np.diff(bound))
                words = word_hashes(part, starts)
                doubled = np.zeros(len(words), bool)
                doubled[1:] = (words[1:] == words[:-1]) & (row[1:] == row[:-1])
                kinds = _KIND[part]
                upper = np.concatenate([[0], np.cumsum(kinds == 2)])
                caps = np.minimum(upper[ends] - upper[starts], 2)
                length = np.searchsorted([2, 4, 7, 11], ends - starts, "right")
                tail = kinds[ends - 1].astype(np.int64)
                shape = ((((tail * 3 + caps) * 5 + length) * 2 + doubled) * 2 + _repeated(words, bound)).astype(np.int64)
                counts[:, :SHAPES] = np.bincount(row * SHAPES + shape, minlength=(b - a) * SHAPES).reshape(b - a, SHAPES)
                at = np.repeat(np.arange(b - a), np.diff(edge))
                pair = _PAIR[part[:-1].astype(np.int64) << 8 | part[1:]]
                inside = at[1:] == at[:-1]
                counts[:, SHAPES:] = np.bincount(at[1:][inside] * PAIRS + pair[inside],
                                                 minlength=(b - a) * PAIRS).reshape(b - a, PAIRS)
            yield first + a, counts


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many of all documents each term occurs, and the number of documents."""
    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(TERMS, np.int64), 0
        for b in it:
            for _, c in term_counts(b.column(0)):
                seen += (c > 0).sum(0)
                n += len(c)
        yield pa.record_batch([pa.array(np.arange(-1, TERMS)), pa.array(np.append(n, seen))], ["term", "n"])

    found = mapped(docs.select(F.col("text").cast("string")), count, "term long, n long").groupBy("term").agg(F.sum("n"))
    out = np.zeros(TERMS + 1, np.int64)
    for term, n in found.collect():                    # TERMS + 1 rows
        out[term + 1] = n
    return out[1:], int(out[0])


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit rows of log-scaled counts times inverse document frequency; shapes and pairs weigh alike."""
    x = np.log1p(counts) * idf
    for part in (x[:, :SHAPES], x[:, SHAPES:]):
        part /= np.maximum(np.linalg.norm(part, axis=1, keepdims=True), 1e-9)
    x[:, SHAPES:] *= 0.5
    return x


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def fit(docs: DataFrame, labels: DataFrame, rows: int = ROWS, dims: int = DIMS) -> dict:
    """Model on a bounded labelled sample and the document frequencies of all documents."""
    seen, n = document_frequencies(docs)
    idf = np.log((n + 1) / (seen + 1)).astype(np.float32) + np.float32(0.1)

    def sample(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for at, c in term_counts(b.column(0)):
                yield pa.record_batch([pa.array([r.tobytes() for r in weighted(c, idf).astype(np.float16)], pa.binary()),
                                       b.column(1).slice(at, len(c))], ["x", "quality"])

    got = mapped(training_sample(docs, labels, rows), sample, "x binary, quality int").collect()     # at most ``rows`` rows
    if not got:
        return {"idf": idf, "space": np.zeros((TERMS, 1), np.float32), "vectors": np.zeros((0, 1), np.float32),
                "votes": np.zeros(0, np.float32), "prior": 0.5}
    got.sort(key=lambda r: (bytes(r[0]), r[1]))        # the same model whatever the task order
    x = np.stack([np.frombuffer(r[0], np.float16) for r in got]).astype(np.float32)
    y = np.array([r[1] for r in got], np.float32)
    values, space = np.linalg.eigh(x.T @ x)
    space = np.ascontiguousarray(space[:, ::-1][:, :dims])
    return {"idf": idf, "space": space, "vectors": _unit(x @ space), "votes": y, "prior": float(y.mean())}


def votes(model: dict, counts: np.ndarray) -> np.ndarray:
    """Score of every row of term counts."""
    out = np.full(len(counts), model["prior"], np.float64)
    full = np.flatnonzero(counts.any(1))
    if len(full) and len(model["votes"]):
        near = _unit(weighted(counts[full], model["idf"]) @ model["space"]) @ model["vectors"].T
        k = min(NEIGHBOURS, near.shape[1])
        best = np.argpartition(-near, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(near, best, 1), 1e-3).astype(np.float64) ** SHARPNESS
        out[full] = (weight * model["votes"][best]).sum(1) / weight.sum(1)
    return np.clip(out, 0.0, 1.0)


def scored(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...], name: str, rows: int = ROWS, dims: int = DIMS) -> DataFrame:
    """The columns ``keep`` of every document with its score under ``name``."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, rows, dims))
    rest = [c for c in keep if c != "text"]                # the text goes over once
    at = {c: i + 1 for i, c in enumerate(rest)}

    def score(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for b in it:
            if b.num_rows:
                s = np.concatenate([votes(m, c) for _, c in term_counts(b.column(0))])
                held = [b.column(at.get(c, 0)) for c in keep]
                yield pa.record_batch([*held, pa.array(s)], [*keep, name])

    rows_in = docs.select(F.col("text").cast("string").alias("__kpl_text"), *rest)
    kinds = {**dict(rows_in.dtypes), "text": "string"}
    return mapped(rows_in, score, ", ".join(f"`{c}` {kinds[c]}" for c in keep) + f", `{name}` double")


def score_quality(docs: DataFrame, labels: DataFrame, rows: int = ROWS, dims: int = DIMS, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, held_out, predicted) of every document; predicted is 1 for a good one."""
    return (scored(docs, labels, ("doc_id",), "score", rows, dims)
            .withColumn("held_out", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)))
            .withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0)))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows and columns of ``docs`` whose texts are called good."""
    return scored(docs, labels, tuple(docs.columns), "__kpl_score").where(F.col("__kpl_score") >= threshold).select(*docs.columns)
