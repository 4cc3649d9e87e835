"""Lexical retrieval packing: a sharded BM25 index gives each seed document its unused neighbours.

Texts become token ids once; the ids are also the terms of the index, so the
vocabulary is bounded, and document frequencies and the mean length are those of
all documents.  Documents are ordered by their strongest terms (largest BM25
weights) and dealt into ranges; a range is read in shards of bounded size, each an
inverted index of its documents.  A window begins with a seed; all its terms are
looked up, scores of the unused documents of the shard are summed, and the best
fill the window greedily.  The document that no longer fits is cut, its rest is
the next seed, so every window is full.  What a range leaves over is joined with
the other ranges' rests and cut at the capacity; the last rest of all is cut into
powers of two, which need no padding.

Defined results: a null or empty text is the end id alone, and like any text
without shared terms it goes where no neighbour is left; texts longer than a
window fill windows by themselves and go on with their rest; repeated rows are
packed each; an empty table gives no rows; columns but ``doc_id`` and ``text``
are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import mapped, partitions, running, saved
from kpiloom.llm.tokens import worker_tokens

CAPACITY = 2048
END_ID = 1
K1, B = 1.2, 0.75
SHARD_TOKENS = 1 << 19      # tokens in the documents of one index
ROUTE = 3                   # strongest terms that order the documents

OUT = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def token_ids(docs: DataFrame, vocabulary: str, terms: int) -> DataFrame:
    """(doc_id, ids as little-endian unsigned integers, end id included) of every row."""
    kind = "<u2" if terms <= 1 << 16 else "<u4"

    def read(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = worker_tokens(vocabulary)
        for b in it:
            ids = [np.append(x, np.uint32(END_ID)).astype(kind).tobytes() for _, x in tokens.rows(b.column(1))]
            yield pa.record_batch([b.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return mapped(rows, read, f"doc_id {dict(rows.dtypes)['doc_id']}, ids binary")


def batch_ids(column: pa.Array, terms: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows in one array, and the row offsets into it."""
    kind = np.dtype("<u2" if terms <= 1 << 16 else "<u4")
    rows = column.to_pylist()
    size = np.array([len(x) // kind.itemsize for x in rows], np.int64)
    return np.frombuffer(b"".join(rows), kind), np.concatenate([[0], np.cumsum(size)])


def term_counts(ids: np.ndarray, bound: np.ndarray, terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, count) by row and term; the end id of every row is no term."""
    row = np.repeat(np.arange(len(bound) - 1), np.diff(bound))
    inner = np.ones(len(ids), bool)
    inner[bound[1:] - 1] = False
    kind = np.uint32 if (len(bound) - 1) * terms < 1 << 32 else np.uint64        # half the bits sort twice as fast
    both, count = np.unique(row[inner].astype(kind) * kind(terms) + ids[inner].astype(kind), return_counts=True)
    row = both // kind(terms)
    return row.astype(np.int64), (both - row * kind(terms)).astype(np.int64), count


class Corpus:
    """Statistics of all documents that a weight needs."""

    def __init__(self, frequency: np.ndarray, documents: int, tokens: int) -> None:
        self.terms = len(frequency)
        self.shared = frequency > 1
        self.idf = np.log1p((documents - frequency + 0.5) / (frequency + 0.5))
        self.mean = max(1.0, tokens / max(1, documents))

    def weights(self, row: np.ndarray, term: np.ndarray, count: np.ndarray, length: np.ndarray) -> np.ndarray:
        """BM25 weight of every (document, term); ``length``: tokens of each row, without the end id."""
        norm = K1 * (1 - B + B * length[row] / self.mean)
        return self.idf[term] * count * (K1 + 1) / (count + norm)


def corpus_of(ids: DataFrame, terms: int) -> Corpus:
    """Document frequencies over all documents; at most one row for each token id reaches the driver."""
    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms + 2, np.int64)                # frequencies, documents, tokens
        for b in it:
            flat, bound = batch_ids(b.column(0), terms)
            total[:terms] += np.bincount(term_counts(flat, bound, terms)[1], minlength=terms)
            total[terms:] += (b.num_rows, len(flat) - b.num_rows)
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some), pa.array(total[some])], ["term", "n"])

    total = np.zeros(terms + 2, np.int64)
    for r in mapped(ids.select("ids"), count, "term long, n long").groupBy("term").agg(F.sum("n")).collect():
        total[r[0]] = r[1]
    return Corpus(total[:terms], int(total[terms]), int(total[terms + 1]))


def strongest(ids: DataFrame, corpus: Corpus) -> DataFrame:
    """Adds the terms with the largest weights of every row, of those that another document has (-1: none)."""
    def keys(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            flat, bound = batch_ids(b.column(b.schema.get_field_index("ids")), corpus.terms)
            row, term, count = term_counts(flat, bound, corpus.terms)
            weight = corpus.weights(row, term, count, np.diff(bound) - 1)
            some = corpus.shared[term]
            row, term, weight = row[some], term[some], weight[some]
            heads = np.flatnonzero(np.append(True, row[1:] != row[:-1])[:len(row)])
            for k in range(ROUTE):
                top = np.full(b.num_rows, -1, np.int32)
                if len(row):
                    most = np.repeat(np.maximum.reduceat(weight, heads), np.diff(np.append(heads, len(row))))
                    best = np.minimum.reduceat(np.where(weight == most, term, corpus.terms), heads)
                    top[row[heads]] = np.where(most[heads] > 0, best, -1)
                    weight = np.where(term == best[np.searchsorted(heads, np.arange(len(row)), "right") - 1], 0, weight)
                b = b.append_column(f"top{k}", pa.array(top))
            yield b

    schema = ids.withColumns({f"top{k}": F.lit(0) for k in range(ROUTE)}).schema
    return mapped(ids, keys, schema)


class Shard:
    """Inverted index of some documents: postings by term, with their BM25 weights."""

    def __init__(self, docs: list[np.ndarray], corpus: Corpus) -> None:
        length = np.array([len(x) for x in docs], np.int64)
        bound = np.concatenate([[0], np.cumsum(length)])
        row, term, count = term_counts(np.concatenate(docs), bound, corpus.terms)
        weight = corpus.weights(row, term, count, length - 1)
        order = np.argsort(term.astype(np.uint16) if corpus.terms <= 1 << 16 else term, kind="stable")      # 16 bits: radix
        self.size, self.doc, self.weight = len(docs), row[order], weight[order]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=corpus.terms))])
        self.row_term, self.row_first = term, np.searchsorted(row, np.arange(len(docs) + 1))

    def terms(self, k: int) -> np.ndarray:
        return self.row_term[self.row_first[k]:self.row_first[k + 1]]

    def scores(self, query: np.ndarray) -> np.ndarray:
        """Score of every document of the shard for the distinct terms of a query."""
        size = self.first[query + 1] - self.first[query]
        upto = np.cumsum(size)
        at = np.arange(upto[-1] if len(upto) else 0) + np.repeat(self.first[query] - upto + size, size)
        return np.bincount(self.doc[at], self.weight[at], self.size)


class Packer:
    """Fills windows from shard after shard; the open window and a cut document's rest go over to the next shard."""

    def __init__(self, corpus: Corpus, capacity: int) -> None:
        self.corpus, self.capacity = corpus, capacity
        self.query, self.fill, self.number = np.zeros(0, np.int64), 0, 0
        self.rest: tuple | None = None           # (document's row, its ids, first id not placed, its terms)
        self.pieces: list[tuple] = []            # (row, ids, start, length, sequence number, offset)

    def place(self, row, ids: np.ndarray, start: int) -> int:
        """Put what fits of a document into the open window; gives the first id not placed."""
        n = min(self.capacity - self.fill, len(ids) - start)
        self.pieces.append((row, ids, start, n, self.number, self.fill))
        self.fill += n
        if self.fill == self.capacity:
            self.number, self.fill = self.number + 1, 0
        return start + n

    def seed(self, row, ids: np.ndarray, start: int, terms: np.ndarray) -> None:
        """Open a window with a document (or its rest)."""
        self.query = terms
        while start < len(ids):
            start = self.place(row, ids, start)

    def pack(self, rows: list, docs: list[np.ndarray]) -> None:
        """Place all documents of a shard."""
        shard, unused, first = Shard(docs, self.corpus), np.ones(len(docs), bool), 0
        while True:
            if not self.fill:
                if self.rest:
                    rest, self.rest = self.rest, None
                    self.seed(*rest)
                else:
                    while first < len(docs) and not unused[first]:
                        first += 1
                    if first == len(docs):
                        return
                    unused[first] = False
                    self.seed(rows[first], docs[first], 0, shard.terms(first))
                if not self.fill:
                    continue
            left = np.flatnonzero(unused)
            for k in left[np.argsort(-shard.scores(self.query)[left], kind="stable")].tolist():
                unused[k] = False
                start = self.place(rows[k], docs[k], 0)
                if start < len(docs[k]):
                    self.rest = (rows[k], docs[k], start, shard.terms(k))
                if not self.fill:
                    break
            else:
                return

    def finish(self) -> None:
        """Place a rest that is left when there are no more documents."""
        if self.rest:
            rest, self.rest = self.rest, None
            self.seed(*rest)


def _pieces(pieces: list[tuple], base: int, open_number: int | None, ids_type: pa.DataType) -> pa.RecordBatch:
    """A batch of pieces; those of the open window carry their ids."""
    cut = [(ids[start:start + n], number == open_number) for _, ids, start, n, number, _ in pieces]
    numbers = [[p[k] for p in pieces] for k in (2, 3, 4, 5)]
    return pa.record_batch([
        pa.array([p[0] for p in pieces], ids_type), pa.array(numbers[0], pa.int64()), pa.array(numbers[1], pa.int64()),
        pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x, _ in cut], pa.int64()),
        pa.array([len(p[1]) for p in pieces], pa.int64()),
        pa.array([base + x for x in numbers[2]], pa.int64()), pa.array(numbers[3], pa.int64()),
        pa.array([x.astype("<u4").tobytes() if loose else None for x, loose in cut], pa.binary())], [*OUT, "loose"])


def pack_related(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every piece of every row."""
    spark = docs.sparkSession
    terms = worker_tokens(vocabulary).parts.get_vocab_size()
    ids = saved(token_ids(docs, vocabulary, terms).withColumn("tie", F.monotonically_increasing_id()))
    corpus = corpus_of(ids, terms)

    def pack(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, base, kind = Packer(corpus, capacity), TaskContext.get().partitionId() << 40, pa.null()
        rows, some, size = [], [], 0
        for b in it:
            kind = b.schema.field("doc_id").type
            flat, bound = batch_ids(b.column(b.schema.get_field_index("ids")), terms)
            for k, row in enumerate(b.column(b.schema.get_field_index("doc_id")).to_pylist()):
                rows.append(row)
                some.append(flat[bound[k]:bound[k + 1]])
                size += len(some[-1])
                if size >= SHARD_TOKENS:
                    packer.pack(rows, some)
                    done = [p for p in packer.pieces if p[4] < packer.number]
                    packer.pieces = packer.pieces[len(done):]
                    yield _pieces(done, base, None, kind)
                    rows, some, size = [], [], 0
        if rows:
            packer.pack(rows, some)
        packer.finish()
        if packer.pieces:
            yield _pieces(packer.pieces, base, packer.number if packer.fill else None, kind)

    order = [*(f"top{k}" for k in range(ROUTE)), "tie"]
    dealt = strongest(ids, corpus).repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    schema = (f"doc_id {dict(ids.dtypes)['doc_id']}, start long, length long, ids_crc32 long, doc_tokens long, "
              "sequence_id long, offset long, loose binary")
    pieces = saved(mapped(dealt.select("doc_id", "ids"), pack, schema))
    full = pieces.where("loose is null").select(*OUT)
    return full.unionByName(_rests(pieces.where("loose is not null"), capacity).select(*OUT))


def _rests(loose: DataFrame, capacity: int) -> DataFrame:
    """Cut the windows that ranges left open, one behind the other, at the capacity; the last rest at powers of two."""
    rows = running(loose, ["sequence_id", "offset"], (), "length", "before")
    total = loose.agg(F.sum("length")).first()[0] or 0
    full = total // capacity
    last = np.cumsum([1 << k for k in range(capacity.bit_length(), -1, -1) if (total % capacity) >> k & 1], dtype=np.int64)
    tail = full * capacity + last                # ends of the sequences after the full ones

    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            rows_, starts, crc, number, offset, length = [], [], [], [], [], []
            for i, r in enumerate(b.select(["start", "length", "before", "loose"]).to_pylist()):
                at, end, ids = r["before"], r["before"] + r["length"], np.frombuffer(r["loose"], "<u4")
                while at < end:
                    k = at // capacity
                    opened, upto = k * capacity, (k + 1) * capacity
                    if k == full:
                        j = int(np.searchsorted(tail, at, "right"))
                        k, opened, upto = full + j, int(tail[j - 1]) if j else full * capacity, int(tail[j])
                    upto = min(upto, end)
                    part = ids[at - r["before"]:upto - r["before"]]
                    for x, v in ((rows_, i), (starts, r["start"] + at - r["before"]), (length, upto - at), (number, -1 - k),
                                 (offset, at - opened), (crc, zlib.crc32(part.tobytes()))):
                        x.append(v)
                    at = upto
            took = pa.array(rows_, pa.int64())
            yield pa.record_batch([b.column(b.schema.get_field_index("doc_id")).take(took), pa.array(starts, pa.int64()),
                                   pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                                   b.column(b.schema.get_field_index("doc_tokens")).take(took),
                                   pa.array(number, pa.int64()), pa.array(offset, pa.int64())], OUT)

    kind = dict(loose.dtypes)["doc_id"]
    return mapped(rows, cut, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
