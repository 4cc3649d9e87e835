"""Quality rules: line sequence labelling with a linear-chain CRF.

Base counts come first (words, symbols, repeated lines, words in repeated
windows).  Then every line with a word gets features, and Viterbi decoding of a
linear-chain conditional random field marks it as content or boilerplate.  A
document is kept if it does not fail the base rules and enough of its words are
in content lines.

Lines have no labels, so they are taken from two sources.  A furniture line is one that
``TEXTS`` different texts or more have, in changing company: the lines before it,
or those after it, are different in ``VARIETY`` of its occurrences (near copies
of a document share their lines in the same company, so only lines beside a changed one can be).
It is counted over all documents.  The field has three states: in the training sample
lines of bad documents stand for junk, furniture lines of good ones for furniture, all others
for content; junk and furniture are boilerplate.  (With one state for both, the long runs of junk make
boilerplate sticky, and a line beside furniture is drawn in.)  Each sample is learnt with the mark of
furniture as a feature and without it, so the look of such lines counts too.

The field is trained here, on a bounded sample of labelled documents (at most
``rows`` of them, those with at most ``TRAIN_LINES`` lines).

Defined results: a null or empty text has zero counts and fails the base rules;
without labels all lines are content; repeated rows are judged each, and are one text
for the furniture; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import KEY, mapped, saved, text_key
from kpiloom.llm.labelled import training_sample
from kpiloom.llm.similar import small_side
from kpiloom.llm.words import text_slices, windows, word_bounds, word_hashes

ROWS = 3000              # labelled documents in the training sample, at most
TRAIN_LINES = 48         # lines of a document in the training sample, at most
STEPS = 150
CONTENT_SHARE = 0.25     # words in content lines, at least
TEXTS = 5                # texts that have a furniture line, at least
VARIETY = 0.3            # different neighbours on one side, per occurrence
REPEAT_WINDOW = 5
MIN_WORDS = 10           # fixed base rules
MAX_REPEATED = 20        # per cent of the words

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER, _LOWER, _DIGIT, _END, _BANG = (np.zeros(256, bool) for _ in range(5))
_UPPER[65:91] = _LOWER[97:123] = _LOWER[128:] = _DIGIT[48:58] = True
_END[list(b".!?:;\"')")] = True
_BANG[list(b"!?")] = True
LOOKS = 12               # features of a line's own look
FEATURES = LOOKS + 1     # and whether it is furniture
JUNK, CONTENT, FURNITURE = STATES = 0, 1, 2
_SPACE = " \t\n\v\f\r"


def line_hashes(text: Column) -> Column:
    """64-bit hashes of the lines with a word, less white space at their ends."""
    lines = F.transform(F.split(F.coalesce(text.cast("string"), F.lit("")), "\n"), lambda x: F.btrim(x, F.lit(_SPACE)))
    return F.transform(F.filter(lines, lambda x: x != ""), lambda x: F.xxhash64(x))


def furniture(docs: DataFrame, texts: int = TEXTS, variety: float = VARIETY) -> DataFrame:
    """(line): hashes of the furniture lines of all documents, written once."""
    one = (docs.select(*text_key(F.col("text").cast("string")), line_hashes(F.col("text")).alias("lines"))
               .groupBy(*KEY).agg(F.first("lines").alias("lines")))

    def entry(line: Column, side: int, company: Column) -> Column:
        return F.struct(line.alias("line"), F.lit(side).alias("side"), F.coalesce(company, F.lit(0).cast("long")).alias("company"))

    each = F.concat(F.transform("lines", lambda x, i: entry(x, 0, F.get("lines", i - 1))),
                    F.transform("lines", lambda x, i: entry(x, 1, F.get("lines", i + 1))),
                    F.transform(F.array_distinct("lines"), lambda x: entry(x, 2, F.lit(None).cast("long"))))
    met = one.select(F.explode(each).alias("e")).groupBy("e.line", "e.side", "e.company").agg(F.count(F.lit(1)).alias("n"))

    def total(value: Column, side: int) -> Column:
        return F.sum(F.when(F.col("side") == side, value).otherwise(0))

    counts = met.groupBy("line").agg(total(F.col("n"), 0).alias("places"), total(F.lit(1), 0).alias("before"),
                                     total(F.lit(1), 1).alias("after"), total(F.col("n"), 2).alias("texts"))
    often = (F.col("texts") >= texts) & (F.greatest("before", "after") >= variety * F.col("places"))
    return saved(counts.where(often).select("line"))


def repeated_words(words: np.ndarray, n: int = REPEAT_WINDOW) -> np.ndarray:
    """Whether each word lies in a window of n words found twice or more."""
    out = np.zeros(len(words), bool)
    if len(words) > n:
        _, which, count = np.unique(windows(words, n), return_inverse=True, return_counts=True)
        hit = np.flatnonzero(count[which] > 1)
        for k in range(n):
            out[hit + k] = True
    return out


def document_lines(texts: pa.Array) -> Iterator[tuple[int, tuple[int, int, int, int, int], np.ndarray, np.ndarray]]:
    """(row, (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words), line features, words per line)."""
    for first, raw, off in text_slices(texts):
        starts, ends, bound = word_bounds(raw, off)
        words = word_hashes(raw, starts, fold=False)
        symbol, head = _SYMBOL[raw], (raw & 0xC0) != 0x80        # first bytes of code points
        marks = np.stack([symbol, _UPPER[raw], _LOWER[raw], _DIGIT[raw], _BANG[raw]], 1)
        upto = np.concatenate([np.zeros((1, 5), np.int64), np.cumsum(marks, 0, dtype=np.int64)])
        chars = np.concatenate([[0], np.cumsum(head)])
        breaks = np.flatnonzero(raw == 10)
        for i in range(len(off) - 1):
            lo, hi, a, b = off[i], off[i + 1], bound[i], bound[i + 1]
            own, s, e = words[a:b], starts[a:b], ends[a:b]
            again = repeated_words(own)
            cuts = breaks[np.searchsorted(breaks, lo):np.searchsorted(breaks, hi)]
            begin, end = np.concatenate([[lo], cuts + 1]), np.concatenate([cuts, [hi]])
            at = np.searchsorted(s, np.append(begin, hi))                  # first word of each line
            full = np.flatnonzero(np.diff(at))                             # lines with a word
            seen: set[bytes] = set()
            dup = np.zeros(len(full), bool)
            for k, j in enumerate(full.tolist()):
                line = raw[begin[j]:end[j]].tobytes()
                dup[k] = line in seen
                seen.add(line)
            counts = (b - a, int((chars[e] - chars[s]).sum()), int(symbol[lo:hi].sum()), int(dup.sum()), int(again.sum()))
            n = np.diff(at)[full]
            x = np.zeros((len(full), LOOKS))
            if len(full):
                w0 = at[full]
                part = upto[end[full]] - upto[begin[full]]
                letters = np.maximum(1, part[:, 1] + part[:, 2])
                solid = np.maximum(1, end[full] - begin[full])
                twice = np.zeros(len(own), bool)
                twice[1:] = own[1:] == own[:-1]
                tail = raw[e - 1]
                odd = symbol[s] | _SYMBOL[tail] | _BANG[tail]
                x[:, 0] = 1
                x[:, 1] = part[:, 1] / letters
                x[:, 2] = part[:, 0] / solid
                x[:, 3] = np.add.reduceat(odd, w0, dtype=np.int64) / n
                x[:, 4] = np.add.reduceat(twice, w0, dtype=np.int64) / n
                x[:, 5] = np.add.reduceat(again, w0, dtype=np.int64) / n
                x[:, 6] = part[:, 3] / solid
                x[:, 7] = np.minimum(1, np.log1p(n) / 6)
                x[:, 8] = np.minimum(1, np.add.reduceat(e - s, w0) / n / 20)
                x[:, 9] = dup
                x[:, 10] = _END[raw[e[np.append(w0[1:], len(own)) - 1] - 1]]
                x[:, 11] = n < 3
            yield first + i, counts, x, n


def viterbi(x: np.ndarray, model: dict) -> np.ndarray:
    """Most likely states of a sequence of lines."""
    return decode(x @ model["emit"].T, model["move"])


def decode(scores: np.ndarray, move: np.ndarray) -> np.ndarray:
    """The best path through the scores [lines, states]; content wins ties."""
    if not len(scores):
        return np.zeros(0, np.int64)
    rows, into = scores.tolist(), move.T.tolist()
    order = sorted(range(len(into)), key=lambda k: k != CONTENT)
    best, back = rows[0], []
    for row in rows[1:]:
        came = [max(order, key=lambda k, to=to: best[k] + to[k]) for to in into]
        best = [best[k] + to[k] + v for k, to, v in zip(came, into, row, strict=True)]
        back.append(came)
    state = max(order, key=best.__getitem__)
    out = [state]
    for came in reversed(back):
        state = came[state]
        out.append(state)
    return np.array(out[::-1], np.int64)


def expected(x: np.ndarray, live: np.ndarray, emit: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over sequences from the longest: log of the sum over all paths [d], chances of states [d, m, s] and of moves [d, m - 1, s, s]."""
    d, m = live.shape
    many, rows = live.sum(0), np.arange(d)                          # sequences that have a line t come first
    score = x @ emit.T                                              # [d, m, s]
    fore, after = np.zeros_like(score), np.zeros_like(score)
    fore[:, 0] = score[:, 0]
    for t in range(1, m):
        k = many[t]
        fore[:k, t] = np.logaddexp.reduce(fore[:k, t - 1, :, None] + move, axis=1) + score[:k, t]
    for t in range(m - 2, -1, -1):
        k = many[t + 1]
        after[:k, t] = np.logaddexp.reduce(move + (score[:k, t + 1] + after[:k, t + 1])[:, None, :], axis=2)
    whole = np.logaddexp.reduce(fore[rows, live.sum(1) - 1], axis=1)
    state, pair = np.zeros_like(score), np.zeros((d, m - 1, *move.shape))
    for t in range(m):
        k = many[t]
        state[:k, t] = np.exp(fore[:k, t] + after[:k, t] - whole[:k, None])
        if t:
            pair[:k, t - 1] = np.exp(fore[:k, t - 1, :, None] + move + (score[:k, t] + after[:k, t])[:, None, :] - whole[:k, None, None])
    return whole, state, pair


def laid_out(samples: list[tuple[np.ndarray, np.ndarray, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(features, live lines, true states [d, m, s], weights) of (line features, line states, document class), the longest first."""
    samples = sorted(samples, key=lambda s: -len(s[0]))
    d, m = len(samples), len(samples[0][0])
    x, live, truth = np.zeros((d, m, FEATURES)), np.zeros((d, m), bool), np.zeros((d, m, len(STATES)))
    for i, (lines, states, _) in enumerate(samples):
        n = len(lines)
        x[i, :n], live[i, :n] = lines, True
        truth[i, np.arange(n), states] = 1
    y = np.array([q for _, _, q in samples])
    weight = (0.5 / np.maximum(1, np.bincount(y, minlength=2)))[y] / live.sum(1)      # classes and documents weigh alike
    return x, live, truth, weight


def gradient(x: np.ndarray, live: np.ndarray, truth: np.ndarray, weight: np.ndarray, emit: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the weighted conditional log-likelihood, by emissions and moves."""
    _, state, pair = expected(x, live, emit, move)
    true_pair = truth[:, :-1, :, None] * truth[:, 1:, None, :]
    off = (truth - state) * weight[:, None, None]
    return off[live].T @ x[live], np.einsum("d,dmab->ab", weight, true_pair - pair, optimize=True)


def train(samples: list[tuple[np.ndarray, np.ndarray, int]], steps: int = STEPS) -> dict:
    """Field fitted by gradient ascent on the conditional log-likelihood."""
    emit, move = np.zeros((len(STATES), FEATURES)), np.zeros((len(STATES), len(STATES)))
    if not samples:
        emit[CONTENT, 0] = 1.0
        return {"emit": emit, "move": move}
    x, live, truth, weight = laid_out(samples)
    speed = [np.zeros_like(emit), np.zeros_like(move)]
    for _ in range(steps):
        for k, (target, grad) in enumerate(zip((emit, move), gradient(x, live, truth, weight, emit, move), strict=True)):
            speed[k] = 0.9 * speed[k] + grad - 1e-4 * target
            target += 0.8 * speed[k]
    return {"emit": emit, "move": move}


def fit(docs: DataFrame, labels: DataFrame, marks: DataFrame, rows: int = ROWS) -> dict:
    def looks(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            x = [x.astype("<f4").tobytes() for _, _, x, _ in document_lines(b.column(0))]
            yield pa.record_batch([pa.array(x, pa.binary()), b.column(1), b.column(2)], ["x", "quality", "lines"])

    sample = training_sample(docs, labels, rows).withColumn("lines", line_hashes(F.col("text")))
    sample = saved(sample.where(F.size("lines").between(1, TRAIN_LINES)))
    own = sample.select(F.explode("lines").alias("own")).distinct()                     # at most rows * TRAIN_LINES
    known = {r[0] for r in marks.join(F.broadcast(own), F.col("line") == F.col("own"), "left_semi").collect()}
    got = mapped(sample.select("text", "quality", "lines"), looks, "x binary, quality int, lines array<long>").collect()  # at most ``rows`` rows
    samples = []
    for x, q, lines in sorted((bytes(r[0]), r[1], list(r[2])) for r in got):
        mark = np.array([h in known for h in lines])
        states = np.where(mark, FURNITURE, CONTENT) if q else np.full(len(mark), JUNK)
        for shown in (mark, np.zeros(len(mark))):
            samples.append((np.column_stack([np.frombuffer(x, "<f4").reshape(-1, LOOKS).astype(float), shown]), states, q))
    return train(samples)


def label_lines(docs: DataFrame, labels: DataFrame, rows: int = ROWS, share: float = CONTENT_SHARE) -> DataFrame:
    """doc_id, the base counts, n_lines, content_lines, content_share, boilerplate (numbers of such lines among those with a word), base_failed, kept of every document."""
    marks = furniture(docs)
    model = fit(docs, labels, marks, rows)
    other = [JUNK, FURNITURE]
    lean, move = model["emit"][other] - model["emit"][CONTENT], model["move"]          # boilerplate against content

    def look(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            if not b.num_rows:
                continue
            out = [(*counts, len(n), n.tolist(), (x @ lean[:, :LOOKS].T).astype("<f4").ravel()) for _, counts, x, n in document_lines(b.column(0))]
            cols = list(zip(*out, strict=True))
            yield pa.record_batch([b.column(1), *(pa.array(c, pa.int64()) for c in cols[:6]), pa.array(cols[6], pa.list_(pa.int32())),
                                   pa.array(cols[7], pa.list_(pa.float32())), b.column(2)], [*NAMES, "words", "looks", "lines"])

    def judge(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            if not b.num_rows:
                continue
            content, parts, gone = [], [], []
            for n, looks, marked in zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in ("words", "looks", "marked")), strict=True):
                score = np.zeros((len(n), len(STATES)))
                score[:, other] = np.reshape(looks, (-1, len(other)))
                if marked:
                    score[np.ix_(marked, other)] += lean[:, LOOKS]
                good = decode(score, move) == CONTENT
                content.append(int(good.sum()))
                parts.append(float((good * n).sum() / max(1, sum(n))))
                gone.append(np.flatnonzero(~good).astype(np.int32))
            keep = [b.column(b.schema.get_field_index(c)) for c in NAMES]
            yield pa.record_batch([*keep, pa.array(content, pa.int64()), pa.array(parts, pa.float64()), pa.array(gone, pa.list_(pa.int32()))],
                                  [*NAMES, "content_lines", "content_share", "boilerplate"])

    rows_in = docs.select(F.col("text").cast("string"), "doc_id", line_hashes(F.col("text")).alias("lines"))
    head = f"doc_id {dict(rows_in.dtypes)['doc_id']}, " + ", ".join(f"{c} long" for c in NAMES[1:])
    seen = saved(mapped(rows_in, look, head + ", words array<int>, looks array<float>, lines array<long>")
                 .withColumn("number", F.monotonically_increasing_id()))
    places = seen.select(F.col("number").alias("m_number"), F.posexplode("lines").alias("at", "own"))
    marked = (places.join(small_side(marks), F.col("own") == F.col("line"))
                    .groupBy("m_number").agg(F.collect_list("at").alias("marked")))
    both = seen.drop("lines").join(marked, F.col("number") == F.col("m_number"), "left").drop("number", "m_number")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return (mapped(both, judge, head + ", content_lines long, content_share double, boilerplate array<int>")
            .withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("content_share") >= share)))


NAMES = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
