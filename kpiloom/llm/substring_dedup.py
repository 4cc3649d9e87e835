"""Substring dedup: paragraph MinHash banding.

Lines are cut after sentence ends into paragraphs; those of at least
``MIN_WORDS`` words take part.  Equal paragraphs are one node.  MinHash bands
(tuned for a recall of ``RECALL`` at the threshold) bring colliding nodes
together, their Jaccard similarity is verified on full sets of 5-word shingles
(``similar.linked``), and components of links are clusters.  All but a cluster's
first paragraph, in the order of (doc_id, text key, place), are removals, if the repeated
paragraphs that follow one another there come to at least ``MIN_RUN`` words:
single short sentences that recur are no copied passage.

Paragraphs miss passages of short sentences and such as start and end inside long
ones; ``repeated_spans`` adds the copied runs of ``passages.PASSAGE`` words or
more, exact to the word.  Both take the same order of places, so the first stays.

Defined results: a null or empty text has no paragraphs; a passage that repeats
inside one text counts too; repeated rows are copies of each other, the later
ones are removals; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.llm.common import KEY, mapped, saved, text_key
from kpiloom.llm.components import components
from kpiloom.llm.passages import repeated_passages
from kpiloom.llm.similar import linked, small_side
from kpiloom.llm.words import SHINGLE_WORDS, mix, paragraph_starts, sequence_hashes, text_slices, windows, word_bounds, word_hashes

MIN_WORDS = 10
MIN_RUN = 16
NUM, DEN = 80, 100
RECALL = 0.9995
MOST_HASHES = 16


def tune_bands(threshold: float, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): the most selective banding within ``most`` hashes that finds a pair at the threshold with this chance."""
    best = (most, 1)
    for rows in range(1, most + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows))
        if bands * rows <= most:
            best = (bands, rows)
    return best


BANDS, ROWS = tune_bands(NUM / DEN)
_FACTOR = np.random.Generator(np.random.PCG64(80)).integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)


def paragraphs(texts: pa.Array, min_words: int) -> Iterator[tuple]:
    """Slices as (row, number in its text, first character, end, words, hash) arrays with the shingles and where each paragraph's begin."""
    for first, raw, off in text_slices(texts):
        starts, ends, bound = word_bounds(raw, off)
        words = word_hashes(raw, starts)
        begin = paragraph_starts(raw, starts, ends, bound)
        size = np.diff(np.append(begin, len(words)))
        node = sequence_hashes(words, begin).view(np.int64)
        long = size >= min_words
        begin, size, node = begin[long], size[long], node[long]
        if not len(begin):
            continue
        row = np.searchsorted(bound, begin, "right") - 1
        number = np.arange(len(begin)) - np.searchsorted(row, row, "left")
        chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        at = chars[off[row]]
        every = windows(words, SHINGLE_WORDS)
        count = np.maximum(size - SHINGLE_WORDS + 1, 1)
        seg = np.concatenate([[0], np.cumsum(count)])
        index = np.repeat(begin - seg[:-1], count) + np.arange(seg[-1])
        shingles = every[np.minimum(index, max(0, len(every) - 1))] if len(every) else node.view(np.uint64)
        yield first + row, number, chars[starts[begin]] - at, chars[ends[begin + size - 1]] - at, size, node, shingles, seg


def _occurrences(docs: DataFrame, min_words: int) -> DataFrame:
    def find(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for row, number, start, end, size, node, _, _ in paragraphs(b.column(0), min_words):
                at = pa.array(row)
                yield pa.record_batch([*(c.take(at) for c in b.columns[1:]), pa.array(number.astype(np.int32)),
                                       pa.array(start), pa.array(end), pa.array(size.astype(np.int32)), pa.array(node)],
                                      ["row", "doc_id", *KEY, "para", "start", "end", "words", "node"])
    text = F.col("text").cast("string")
    rows = docs.select(text.alias("text"), F.monotonically_increasing_id().alias("row"), "doc_id", *text_key(text))
    return mapped(rows, find, ", ".join(f"{n} {t}" for n, t in rows.dtypes[1:]) + ", para int, start long, end long, words int, node long")


def _posts(docs: DataFrame, min_words: int) -> DataFrame:
    """(node, bucket) of every paragraph and band."""
    def band(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for *_, node, shingles, seg in paragraphs(b.column(0), min_words):
                keys = []
                for k in range(BANDS):
                    h = np.full(len(node), np.uint64(k + 1), np.uint64)
                    for f in _FACTOR[k * ROWS:(k + 1) * ROWS]:
                        h = mix(h ^ np.minimum.reduceat(shingles * f, seg[:-1]))
                    keys.append(h.view(np.int64))
                yield pa.record_batch([pa.array(node), pa.ListArray.from_arrays(
                    pa.array(np.arange(0, len(node) * BANDS + 1, BANDS, dtype=np.int32)), pa.array(np.stack(keys, 1).ravel()))],
                    ["node", "buckets"])
    rows = docs.select(F.col("text").cast("string"))
    return mapped(rows, band, "node long, buckets array<long>").select("node", F.explode("buckets").alias("bucket"))


def _sets(docs: DataFrame, min_words: int) -> DataFrame:
    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for *_, node, shingles, seg in paragraphs(b.column(0), min_words):
                sets = [np.unique(shingles[x:y]).tobytes() for x, y in zip(seg[:-1].tolist(), seg[1:].tolist())]
                yield pa.record_batch([pa.array(node), pa.array(sets, pa.binary())], ["node", "shingles"])
    return mapped(docs.select(F.col("text").cast("string")), cut, "node long, shingles binary")


def paragraph_links(docs: DataFrame, min_words: int = MIN_WORDS, num: int = NUM, den: int = DEN) -> DataFrame:
    """Edges between different paragraphs that span the components of all links."""
    posts = _posts(docs, min_words)
    shared = saved(posts.groupBy(F.col("bucket").alias("s_bucket")).agg(F.min("node").alias("low"), F.max("node").alias("high"))
                        .where("low != high").select("s_bucket"))
    met = posts.join(small_side(shared), F.col("bucket") == F.col("s_bucket")).select("node", "bucket").distinct()
    tokens = saved(met.groupBy("node").agg(F.array_sort(F.collect_list("bucket")).alias("tokens")))       # at most BANDS
    wanted = small_side(tokens.select(F.col("node").alias("w_node")))
    sets = saved(_sets(docs, min_words).join(wanted, F.col("node") == F.col("w_node")).drop("w_node").dropDuplicates(["node"]))
    members = (tokens.join(sets.select(F.col("node").alias("z_node"), (F.octet_length("shingles") / 8).cast("long").alias("size")),
                           F.col("node") == F.col("z_node"))
                     .select("node", "size", "tokens", F.size("tokens").alias("posted"), F.explode("tokens").alias("bucket")))
    return linked(members, sets, num, den)


def repeated_paragraphs(docs: DataFrame, min_words: int = MIN_WORDS, min_run: int = MIN_RUN) -> DataFrame:
    """Removals: doc_id, para (number among the text's paragraphs), start, end (code points), words, run_words,
    keep_doc_id, keep_para (the cluster's first paragraph) and cluster_size."""
    found = saved(_occurrences(docs, min_words))
    joined = saved(components(paragraph_links(docs, min_words)))
    of_node = small_side(joined).withColumnRenamed("node", "c_node")
    named = found.join(of_node, F.col("node") == F.col("c_node"), "left").withColumn("cluster", F.coalesce("component", "node"))
    place = F.struct("doc_id", *KEY, "row", "para")
    first = (named.groupBy(F.col("cluster").alias("f_cluster")).agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("cluster_size"))
                  .where("cluster_size > 1"))
    later = (named.join(first, F.col("cluster") == F.col("f_cluster"))
                  .where(~((F.col("row") == F.col("first.row")) & (F.col("para") == F.col("first.para")))))
    later = later.select("doc_id", "row", "para", "start", "end", "words", F.col("first.doc_id").alias("keep_doc_id"),
                         F.col("first.para").alias("keep_para"), "cluster_size")
    run = F.col("para") - F.row_number().over(Window.partitionBy("row").orderBy("para"))     # equal along neighbours
    later = (later.withColumn("run", run)
                  .withColumn("run_words", F.sum("words").over(Window.partitionBy("row", "run"))))
    return later.where(F.col("run_words") >= min_run).drop("row", "run")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """The removals of ``repeated_paragraphs``, and those of ``repeated_passages`` with null for para and keep_para.

    A row is a span of characters to remove; spans of the two kinds may overlap.
    """
    more = saved(repeated_passages(docs).withColumn("run_words", F.col("words").cast("long")))
    return repeated_paragraphs(docs).unionByName(more, allowMissingColumns=True)
