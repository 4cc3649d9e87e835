"""Copied passages: runs of ``PASSAGE`` words that an earlier text or place has, spans exact to the word.

Every run of ``PASSAGE`` words is looked up, whatever sentences it is made of and
wherever in them it starts and ends; winnowing says which need to be: the words
make grams of ``GRAM``, the smallest of the ``WINDOW`` in a run is its
fingerprint, and a run whose fingerprint occurs once can't occur twice.  A run's
later places, in the order of (doc_id, text key, word), are removals; those
that touch become one span.  Equal texts are looked up once, the later ones are
copies whole.

No pairs are made: a run that many texts share costs a partial aggregate and a
join with one row for each different run.  A copy that overlaps its first place
is none, so the first copy always stays.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.llm.common import KEY, mapped, running, saved, text_key
from kpiloom.llm.similar import small_side
from kpiloom.llm.words import mix, rolling, rolling_hash, text_slices, windows, word_bounds, word_hashes

GRAM, WINDOW = 26, 25
PASSAGE = GRAM + WINDOW - 1
_PLACE = 32                     # bits of a word's number in a place, a text's number above them


def _slide(x: np.ndarray, n: int, f: Callable) -> np.ndarray:
    """``f`` (minimum or maximum) of every n consecutive values."""
    have = 1
    while have < n:
        step = min(have, n - have)
        x = f(x[:-step], x[step:])
        have += step
    return x


def _runs(texts: pa.Array) -> Iterator[tuple]:
    """(row, word hashes, gram hashes, fingerprint of every run of PASSAGE words, first and end character) of the rows that have such runs."""
    for first, raw, off in text_slices(texts):
        starts, ends, bound = word_bounds(raw, off)
        words = word_hashes(raw, starts)
        grams = windows(words, GRAM)
        chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        for i in np.flatnonzero(np.diff(bound) >= PASSAGE).tolist():
            a, b = bound[i], bound[i + 1]
            own = grams[a:b - GRAM + 1]
            base = chars[off[i]]
            yield first + i, words[a:b], own, _slide(own, WINDOW, np.minimum), chars[starts[a]] - base, chars[ends[b - 1]] - base


def _prints(docs: DataFrame) -> DataFrame:
    """(doc_id, text key, n_words, start, end, prints: fingerprints, each as often as it has places) of the texts of PASSAGE words or more."""
    def find(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            row, size, start, end, prints = [], [], [], [], []
            edge = np.zeros(WINDOW - 1, np.uint64)
            for i, words, grams, least, low, high in _runs(b.column(0)):
                row.append(i)
                size.append(len(words))
                start.append(int(low))
                end.append(int(high))
                prints.append(grams[_slide(np.concatenate([edge, least, edge]), WINDOW, np.maximum) == grams].view(np.int64))
            at = pa.array(row, pa.int64())
            yield pa.record_batch([*(c.take(at) for c in b.columns[1:]), pa.array(size, pa.int32()), pa.array(start, pa.int64()),
                                   pa.array(end, pa.int64()), pa.array(prints, pa.list_(pa.int64()))],
                                  ["doc_id", *KEY, "n_words", "start", "end", "prints"])
    rows = docs.select(F.col("text").cast("string").alias("text"), "doc_id", *text_key(F.col("text").cast("string")))
    return mapped(rows, find, ", ".join(f"{n} {t}" for n, t in rows.dtypes[1:]) + ", n_words int, start long, end long, prints array<long>")


def _same(at: str) -> Column:
    """The row's doc_id and text key are those of the struct ``at``."""
    cond = F.col("doc_id").eqNullSafe(F.col(f"{at}.doc_id"))
    for k in KEY:
        cond = cond & (F.col(k) == F.col(f"{at}.{k}"))
    return cond


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(text and the columns of ``wanted``) of the documents whose struct ``at`` (doc_id, text key) is in it."""
    rows = docs.select(F.col("text").cast("string").alias("text"), "doc_id", *text_key(F.col("text").cast("string")))
    return rows.join(small_side(wanted), _same("at")).select("text", *[F.col(c) for c in wanted.columns])


def _places(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(run, place) of every run of PASSAGE words whose fingerprint is in its text's ``prints``."""
    def look(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for i, words, _, least, _, _ in _runs(b.column(0)):
                low = np.flatnonzero(np.isin(least, b.column(2)[i].values.to_numpy().view(np.uint64)))
                run = mix(rolling_hash(rolling(words), low, low + PASSAGE))
                yield pa.record_batch([pa.array(run.view(np.int64)), pa.array(low + (b.column(1)[i].as_py() << _PLACE))], ["run", "place"])
    return mapped(_texts(docs, wanted).select("text", "number", "prints"), look, "run long, place long")


def _spans(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, number, start, end, words, keep, cluster_size) of the word ranges in ``spans`` (low, high, keep, n) of each text."""
    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for first, raw, off in text_slices(b.column(0)):
                starts, ends, bound = word_bounds(raw, off)
                chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
                for i in range(len(off) - 1):
                    spans = b.column(3)[first + i].values
                    low, high = (spans.field(k).to_numpy() for k in range(2))
                    take = pa.array(np.full(len(low), first + i))
                    yield pa.record_batch([b.column(1).take(take), b.column(2).take(take),
                                           pa.array(chars[starts[bound[i] + low]] - chars[off[i]]),
                                           pa.array(chars[ends[bound[i] + high - 1]] - chars[off[i]]), pa.array((high - low).astype(np.int32)),
                                           spans.field(2), spans.field(3)], ["doc_id", "number", "start", "end", "words", "keep", "cluster_size"])
    kind = dict(docs.dtypes)["doc_id"]
    full = _texts(docs, wanted).select("text", F.col("at.doc_id").alias("doc_id"), "number", "spans")
    return mapped(full, cut, f"doc_id {kind}, number long, start long, end long, words int, keep long, cluster_size long")


def repeated_passages(docs: DataFrame) -> DataFrame:
    """Removals: doc_id, start, end (code points), words, keep_doc_id (of the first place of the run that the span
    begins with) and cluster_size (places of its most frequent run among different texts; rows with the text if it is a copy)."""
    found = saved(_prints(docs))

    # texts in order, each at its first id
    least = found.groupBy(*KEY).agg(F.min(F.struct("doc_id")).alias("least"), F.count(F.lit(1)).alias("copies"))
    texts = least.select("least.doc_id", *KEY, "copies", F.lit(1).alias("one"))
    texts = saved(running(texts, ["doc_id", *KEY], (), "one", "number").select(
        F.struct("doc_id", *KEY).alias("t_at"), F.col("number").alias("t_number"), "copies"))
    prints = (found.join(small_side(texts), _same("t_at"))
                   .select(F.col("t_at").alias("at"), F.col("t_number").alias("number"), F.explode("prints").alias("print")))
    often = saved(prints.groupBy(F.col("print").alias("o_print")).agg(F.count(F.lit(1)).alias("n"))
                        .where("n > 1").select("o_print"))
    wanted = saved(prints.join(small_side(often), F.col("print") == F.col("o_print"))
                         .groupBy("number").agg(F.first("at").alias("at"), F.collect_set("print").alias("prints")))

    places = _places(docs, wanted)
    first = saved(places.groupBy(F.col("run").alias("f_run")).agg(F.min("place").alias("first"), F.max("place").alias("last"),
                                                                   F.count(F.lit(1)).alias("n"))
                        .where(f"last >= first + {PASSAGE}").select("f_run", "first", "n"))
    later = (places.join(small_side(first), F.col("run") == F.col("f_run")).where(f"place >= first + {PASSAGE}")
                   .select(F.shiftright("place", _PLACE).alias("number"), F.col("place").bitwiseAND((1 << _PLACE) - 1).alias("low"),
                           F.shiftright("first", _PLACE).alias("keep"), "n"))

    # runs that touch become one span
    by_text = Window.partitionBy("number").orderBy("low")
    fresh = F.coalesce((F.col("low") > F.lag("low").over(by_text) + PASSAGE).cast("int"), F.lit(1))
    spans = (later.withColumn("fresh", fresh).withColumn("span", F.sum("fresh").over(by_text)).groupBy("number", "span")
                  .agg(F.min(F.struct("low", "keep")).alias("near"), (F.max("low") + PASSAGE).alias("high"), F.max("n").alias("n")))
    spans = (spans.groupBy("number").agg(F.collect_list(F.struct("near.low", "high", "near.keep", "n")).alias("spans"))
                  .join(small_side(texts), F.col("number") == F.col("t_number")).select(F.col("t_at").alias("at"), "number", "spans"))
    own = _spans(docs, saved(spans)).dropDuplicates(["number", "start"])          # rows with equal id and text
    names = small_side(texts.select("t_number", F.col("t_at.doc_id").alias("keep_doc_id")))
    own = own.join(names, F.col("keep") == F.col("t_number")).select("doc_id", "start", "end", "words", "keep_doc_id", "cluster_size")

    # all rows of a text but the first
    again = saved(texts.where("copies > 1").select("t_at", "copies"))
    again = found.join(small_side(again), [F.col(k) == F.col(f"t_at.{k}") for k in KEY])
    again = (again.groupBy("doc_id", "t_at", "copies", "n_words", "start", "end").agg(F.count(F.lit(1)).cast("int").alias("rows"))
                  .withColumn("rows", F.col("rows") - F.col("doc_id").eqNullSafe(F.col("t_at.doc_id")).cast("int"))
                  .where("rows > 0").withColumn("each", F.explode(F.array_repeat(F.lit(1), F.col("rows")))))
    return own.unionByName(again.select("doc_id", "start", "end", F.col("n_words").alias("words"),
                                        F.col("t_at.doc_id").alias("keep_doc_id"), F.col("copies").alias("cluster_size")))

