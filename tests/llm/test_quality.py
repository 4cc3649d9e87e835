import collections
import itertools
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kpiloom.llm import knn_quality as K
from kpiloom.llm import line_crf as C

LABELS = "doc_id long, quality int, toxic int"


def junk(text):
    return " ".join(w + "***" for w in text.split())


@pytest.fixture(scope="module")
def labelled(spark, prose, make_docs):
    rows = [(i, prose(i, 30 + i % 50)) for i in range(160)] + [(1000 + i, junk(prose(i, 30 + i % 50))) for i in range(60)]
    labels = [(i, 1, 0) for i in range(160)] + [(1000 + i, 0, 0) for i in range(60)] + [(None, 1, 0), (3, None, 0), (77777, 1, 1)]
    return rows, spark.createDataFrame(labels, LABELS)


def test_knn_learns_only_outside_the_held_out_fold(spark, make_docs, labelled, hard_rows):
    rows, labels = labelled
    extra = [(5000 + i, t) for i, (_, t) in enumerate(hard_rows)] + [(None, "x y z")]
    out = K.score_quality(make_docs(rows + extra), labels).toPandas()
    assert len(out) == len(rows) + len(extra)
    assert out.score.between(0, 1).all()
    assert ((out.score >= 0.3) == (out.predicted == 1)).all()
    want = spark.createDataFrame([(i,) for i, _ in rows], "doc_id long").select(
        "doc_id", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0).alias("h"))
    held = {r.doc_id for r in want.collect() if r.h}
    assert set(out[out.held_out & (out.doc_id < 5000)].doc_id) == held
    assert (out[out.doc_id < 1000].predicted == 1).all()
    assert (out[(out.doc_id >= 1000) & (out.doc_id < 5000)].predicted == 0).all()
    flipped = labels.withColumn("quality", F.when(F.col("doc_id").isin(list(held)), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = K.score_quality(make_docs(rows + extra), flipped).toPandas()
    assert np.array_equal(again.sort_values("doc_id").score.to_numpy(), out.sort_values("doc_id").score.to_numpy())


def test_knn_products_are_exact(make_docs, labelled):
    rows, labels = labelled
    model = K.fit(make_docs(rows), labels)
    counts = np.concatenate([c for _, c in K.term_counts(pa.array([t for _, t in rows[:40]] + ["", None]))])
    got = K.votes(model, counts)
    for i, c in enumerate(counts):
        v = K.weighted(c[None], model["idf"]) @ model["space"]
        if not c.any():
            assert got[i] == model["prior"]
            continue
        near = (model["vectors"] @ v[0]) / np.linalg.norm(v[0])
        best = np.argsort(-near)[:K.NEIGHBOURS]
        w = np.maximum(near[best], 1e-3).astype(float) ** K.SHARPNESS
        assert abs(got[i] - (w * model["votes"][best]).sum() / w.sum()) < 1e-3


def test_document_frequencies_cover_all_documents(make_docs, labelled):
    rows, _ = labelled
    seen, n = K.document_frequencies(make_docs(rows + [(1, None)]).repartition(7))
    counts = np.concatenate([c for _, c in K.term_counts(pa.array([t for _, t in rows]))])
    assert n == len(rows) + 1
    assert np.array_equal(seen, (counts > 0).sum(0))


def test_without_labels_or_documents(spark, make_docs, labelled):
    rows, labels = labelled
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in K.score_quality(make_docs(rows[:5]), none).collect()} == {0.5}
    assert K.score_quality(make_docs([]), labels).count() == 0
    assert all(r.kept for r in C.label_lines(make_docs(rows[:5]), none).collect())
    assert C.label_lines(make_docs([]), labels).count() == 0


def base(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    c = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    rep = {i + k for i in range(len(w) - 4) if c[tuple(w[i:i + 5])] > 1 for k in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(rep)


def test_base_counts_and_verdicts(make_docs, labelled, hard_rows):
    rows, labels = labelled
    odd = [(6000, "a a a a a a a a a a a"), (6001, "x | y # z\nx | y # z\n\n \n"), (6002, "日本 é *&%\n日本 é *&%\r\n"), (6003, "A b c d e a b c d e " * 3)]
    every = rows + hard_rows + odd
    out = C.label_lines(make_docs(every), labels).toPandas()
    want = collections.Counter((d, *base(t)) for d, t in every)
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = collections.Counter((None if r.doc_id != r.doc_id else int(r.doc_id), *(int(getattr(r, c)) for c in cols)) for r in out.itertuples())
    assert got == want
    failed = (out.n_words < 10) | (100 * out.n_repeat_words > 20 * out.n_words)
    assert (failed == out.base_failed).all() and not (out.kept & out.base_failed).any()
    assert out[(out.doc_id < 1000) & ~out.base_failed & (out.n_words < 1000)].kept.all()
    assert not out[(out.doc_id >= 1000) & (out.doc_id < 2000)].kept.any()


def test_viterbi_finds_the_best_path():
    r = np.random.default_rng(0)
    for n in (1, 2, 7):
        x = r.normal(size=(n, C.FEATURES))
        model = {"emit": r.normal(size=(2, C.FEATURES)), "move": r.normal(size=(2, 2))}

        def value(path, x=x, model=model):
            s = sum(x[i] @ model["emit"][q] for i, q in enumerate(path))
            return s + sum(model["move"][a, b] for a, b in zip(path, path[1:]))
        best = max((tuple(int(c) for c in f"{k:0{n}b}") for k in range(2 ** n)), key=value)
        assert tuple(C.viterbi(x, model)) == best
    assert len(C.viterbi(np.zeros((0, C.FEATURES)), model)) == 0


def test_gradient_is_that_of_the_conditional_log_likelihood():
    r = np.random.default_rng(1)
    states = len(C.STATES)
    samples = [(r.normal(size=(n, C.FEATURES)), r.integers(0, states, n), q) for n, q in ((6, 1), (4, 1), (3, 0), (1, 0))]
    x, live, truth, weight = C.laid_out(samples)
    emit, move = r.normal(size=(states, C.FEATURES)), r.normal(size=(states, states))

    def log_sum(f, emit, move):
        return np.logaddexp.reduce([sum(f[i] @ emit[q] for i, q in enumerate(y)) + sum(move[a, b] for a, b in zip(y, y[1:]))
                                    for y in itertools.product(range(states), repeat=len(f))])

    def value(emit, move):
        paths = [sum(f[i] @ emit[q] for i, q in enumerate(y)) + sum(move[a, b] for a, b in zip(y, y[1:])) for f, y, _ in samples]
        return (weight * (np.array(paths) - C.expected(x, live, emit, move)[0])).sum()

    whole = C.expected(x, live, emit, move)[0]
    assert np.allclose(whole, [log_sum(f, emit, move) for f, _, _ in samples])
    got = C.gradient(x, live, truth, weight, emit, move)
    for k, target in enumerate((emit, move)):
        for at in np.ndindex(target.shape):
            up, down = target.copy(), target.copy()
            up[at] += 1e-5
            down[at] -= 1e-5
            args = ((up, move), (down, move)) if k == 0 else ((emit, up), (emit, down))
            assert abs((value(*args[0]) - value(*args[1])) / 2e-5 - got[k][at]) < 1e-6


def brute_furniture(texts):
    places = collections.defaultdict(list)
    for t in set(texts):
        lines = [x.strip(" \t\n\v\f\r") for x in (t or "").split("\n")]
        lines = [x for x in lines if x]
        for i, x in enumerate(lines):
            places[x].append((t, lines[i - 1] if i else None, lines[i + 1] if i + 1 < len(lines) else None))
    return {x for x, p in places.items() if len({t for t, _, _ in p}) >= C.TEXTS
            and max(len({b for _, b, _ in p}), len({a for _, _, a in p})) >= C.VARIETY * len(p)}


def test_planted_boilerplate_is_labelled_among_content(spark, make_docs, prose, hard_rows):
    notes = ["Share this page with a friend", "Sign up for our letter", "All rights reserved by the owner"]
    rows, planted = [], {}
    for d in range(90):
        lines = [prose(10_000 + 50 * d + k, 14) for k in range(6)]
        mine = [n for k, n in enumerate(notes) if (d + k) % 3 != 0]
        for k, n in enumerate(mine):
            lines.insert((d * 3 + 2 * k) % (len(lines) + 1), n)
        planted[d] = {i for i, x in enumerate(lines) if x in notes}
        rows.append((d, "\n\n".join(lines)))
    copied = [prose(99_000 + k, 14) for k in range(8)]
    near = [(2000 + d, "\n".join([*copied[:7], prose(98_000 + d, 14)])) for d in range(30)]      # near copies are content
    bad = [(1000 + d, "\n".join(junk(prose(20_000 + 9 * d + k, 10)) for k in range(5))) for d in range(60)]
    every = rows + near + bad + hard_rows
    docs = make_docs(every + rows[:20])
    want = {spark.createDataFrame([(x,)], "x string").select(F.xxhash64("x")).first()[0] for x in brute_furniture([t for _, t in every])}
    assert {r.line for r in C.furniture(docs).collect()} == want and len(want) == 4    # notes, and the line beside the changed one of the near copies
    labels = spark.createDataFrame([(d, 1, 0) for d in range(90)] + [(1000 + d, 0, 0) for d in range(60)], LABELS)
    out = [r for r in C.label_lines(docs, labels).collect() if r.doc_id is not None]
    assert len(out) == len(every) + 20 - 2
    mixed = [r for r in out if r.doc_id in planted and r.n_lines > 5 and r.doc_id > 9]
    hits = sum(len(planted[r.doc_id] & set(r.boilerplate)) for r in mixed)
    assert hits >= 0.95 * sum(len(planted[r.doc_id]) for r in mixed)
    assert sum(len(r.boilerplate) for r in mixed) <= 1.05 * hits                       # and little else
    assert all(0 < r.content_lines < r.n_lines and r.kept for r in mixed)
    assert all(r.kept and set(r.boilerplate) <= {6} for r in out if 2000 <= r.doc_id < 3000)
    assert not any(r.kept for r in out if 1000 <= r.doc_id < 2000)
