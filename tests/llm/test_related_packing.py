"""Retrieval packing: every id placed once, full windows, scores and greedy choices against slow versions."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from kpiloom.llm import related_packing
from kpiloom.llm.queries import vocabulary
from kpiloom.llm.related_packing import B, K1, Corpus, Packer, Shard, pack_related


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(vocabulary())


def checked(pieces, rows, tokenizer, capacity):
    """Sequences of (doc, start, length) after all checks of the contract."""
    texts = defaultdict(list)
    for d, t in rows:
        texts[d].append(np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4"))
    placed, sequences = defaultdict(int), defaultdict(list)
    for p in pieces:
        same = [x for x in texts[p["doc_id"]] if len(x) == p["doc_tokens"]
                and zlib.crc32(x[p["start"]:p["start"] + p["length"]].tobytes()) == p["ids_crc32"]]
        assert same and p["length"] > 0
        placed[p["doc_id"]] += p["length"]
        sequences[p["sequence_id"]].append((p["offset"], p["length"], p["doc_id"], p["start"]))
    assert placed == {d: sum(map(len, some)) for d, some in texts.items()}
    for some in sequences.values():
        some.sort(key=lambda x: x[0])
        assert [x[0] for x in some] == [sum(y[1] for y in some[:k]) for k in range(len(some))]
        fill = sum(x[1] for x in some)
        assert fill <= capacity and (fill == capacity or fill & (fill - 1) == 0)
    return sequences


@pytest.mark.parametrize("shard_tokens", [1 << 19, 900])
@pytest.mark.parametrize("capacity", [2048, 128])
def test_every_id_once_and_no_padding(spark, make_docs, hard_rows, prose, tokenizer, monkeypatch, shard_tokens, capacity):
    monkeypatch.setattr(related_packing, "SHARD_TOKENS", shard_tokens)
    rows = hard_rows + [(100 + k, prose(k % 20, 20 + 7 * k)) for k in range(60)]
    checked(pack_related(make_docs(rows), vocabulary(), capacity).collect(), rows, tokenizer, capacity)
    assert pack_related(make_docs([]), vocabulary()).collect() == []


def test_null_texts_only(make_docs, tokenizer):
    rows = [(k, None) for k in range(37)]
    checked(pack_related(make_docs(rows), vocabulary()).collect(), rows, tokenizer, 2048)


def slow_scores(docs, query, frequency, documents, mean):
    out = []
    for d in docs:
        words, s = Counter(d[:-1].tolist()), 0.0
        for t in query:
            if words[t]:
                idf = math.log(1 + (documents - frequency[t] + 0.5) / (frequency[t] + 0.5))
                s += idf * words[t] * (K1 + 1) / (words[t] + K1 * (1 - B + B * (len(d) - 1) / mean))
        out.append(s)
    return out


def random_docs(seed, n, terms):
    r = np.random.default_rng(seed)
    docs = [np.append(r.zipf(1.3, r.integers(0, 60)) % terms, 1).astype("<u2") for _ in range(n)]
    return docs + [d.copy() for d in docs[:n // 5]]


def statistics(docs, terms):
    frequency = np.zeros(terms, np.int64)
    for d in docs:
        frequency[np.unique(d[:-1])] += 1
    return frequency, len(docs), sum(len(d) - 1 for d in docs)


@pytest.mark.parametrize("seed", range(5))
def test_scores_against_brute_force(seed):
    docs = random_docs(seed, 40, 300)
    frequency, n, tokens = statistics(docs, 300)
    shard = Shard(docs, Corpus(frequency, n, tokens))
    for k in range(len(docs)):
        assert shard.terms(k).tolist() == sorted(set(docs[k][:-1].tolist()))
        assert np.allclose(shard.scores(shard.terms(k)), slow_scores(docs, shard.terms(k).tolist(), frequency, n, tokens / n))


@pytest.mark.parametrize("seed", range(5))
def test_windows_against_a_slow_greedy_version(seed):
    docs, capacity = random_docs(seed, 40, 300), 64
    frequency, n, tokens = statistics(docs, 300)
    packer = Packer(Corpus(frequency, n, tokens), capacity)
    packer.pack(list(range(len(docs))), docs)
    packer.finish()
    got = defaultdict(list)
    for row, _, start, length, number, offset in packer.pieces:
        got[number].append((row, start, length, offset))

    shard = Shard(docs, Corpus(frequency, n, tokens))       # checked above
    stream, unused, query, rest = [], list(range(len(docs))), None, None
    while unused or rest:
        fill = sum(x[2] for x in stream) % capacity
        if not fill:
            k, start = rest or (unused.pop(0), 0)
            rest, query = None, k
            stream.append((k, start, len(docs[k]) - start))
        elif unused:
            scores = shard.scores(shard.terms(query))
            k = max(unused, key=lambda x: (scores[x], -x))
            unused.remove(k)
            room = capacity - fill
            stream.append((k, 0, min(room, len(docs[k]))))
            rest = (k, room) if len(docs[k]) > room else None
        else:
            break
    if rest:
        stream.append((rest[0], rest[1], len(docs[rest[0]]) - rest[1]))
    flat = [(k, start + i) for k, start, length in stream for i in range(length)]
    mine = [(row, start + i) for number in sorted(got) for row, start, length, _ in got[number] for i in range(length)]
    assert mine == flat


def test_related_documents_share_windows(make_docs, prose, tokenizer):
    """Four versions of each text, ids far apart: most of them come to share a window with another version."""
    rows = [(100 * v + k, prose(k, 90) + f" {prose(1000 + 10 * k + v, 10)}") for v in range(4) for k in range(60)]
    sequences = checked(pack_related(make_docs(rows), vocabulary()).collect(), rows, tokenizer, 2048)
    together = {d for s in sequences.values() for _, _, d, _ in s if len({x[2] for x in s if x[2] % 100 == d % 100}) > 1}
    assert len(together) > 0.7 * len(rows), len(together)       # left to chance, about 0.1
