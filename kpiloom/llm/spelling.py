"""Spelling variant grouping: words one edit apart, found by search schemes on a bidirectional FM-index.

Words are maximal runs of letters (A-Z, a-z, U+00C0 to U+00FF), A-Z lower-cased.
Two words are near if exactly one inserted, deleted or replaced code point
separates them.  A word's form is its near word of largest count, if that is at
least ``ratio`` times its own; forms are followed to the root of a group.

Search: one edit leaves one half of a word as it is.  A word of L code points is
split at L // 2 and searched twice: its first half exactly, then on across the
second with one error, and its second half exactly, then back across the first.
The index is the delimited vocabulary (``_`` before every word, as a ring), once
forwards and once backwards; a state of a search is an interval of suffix ranks,
extended by one sign through a rank query on either index, for all words of a
shard at once.  Branches are the signs that occur in the interval.  Only
replacements and insertions are searched: a deletion is an insertion seen from
the other word.

Sharding: a word meets near words only where it shares an exact half with them.
So it is posted under the halves for its own length and for one less, and shards
are hashes of (length, side, half); a shard's index holds the words posted to
it.  A half with more than ``HOT`` words is cut into chunks, and its queries go to
every chunk, so no index grows with the vocabulary.

Defined results: null and empty texts have no words; a null id counts as an empty
one; repeated rows count each; an empty table gives no rows; columns but
``doc_id`` and ``text`` are not looked at; ties between forms go to the smallest
word in code-point order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import saved, ship
from kpiloom.llm.similar import small_side

MIN_LETTERS = 7
MIN_COUNT = 2
RATIO = 10
SHARD_WORDS = 1 << 14       # posted words that share one index, on average
HOT = 1 << 13               # words of one half beyond which it is cut into chunks
DAMAGED = 31                # the query deletes a letter of one in so many runs
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LETTERS = "[A-Za-zÀ-ÿ]"


def word_counts(docs: DataFrame, least: int = MIN_LETTERS, damaged: int | None = None) -> DataFrame:
    """(word, n) of all words of ``least`` letters or more.

    With ``damaged``, a run whose CRC-32 with its document's id is divisible by it
    loses the code point at (CRC-32 modulo its length).
    """
    found = docs.select(F.col("doc_id").cast("string").alias("id"), F.explode(
        F.regexp_extract_all(F.col("text").cast("string"), F.lit(f"({_LETTERS}{{{least},}})"), F.lit(1))).alias("run"))
    plain = F.when(F.octet_length("run") == F.char_length("run"), F.lower("run")).otherwise(F.translate("run", _UPPER, _LOWER))
    rows = found.select("id", plain.alias("word"))
    if damaged:
        h = F.crc32(F.concat(F.coalesce("id", F.lit("")), F.lit(":"), F.col("word")).cast("binary"))
        size = F.char_length("word")
        at = F.pmod(F.col("h"), size).cast("int")
        less = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, size))
        rows = (rows.withColumn("h", h)
                    .select(F.when(F.col("h") % damaged == 0, less).otherwise(F.col("word")).alias("word"))
                    .where(F.char_length("word") >= least))
    return rows.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


class RingIndex:
    """FM-index of a ring of signs: sorted rotations, and ranks of signs among the signs before them."""

    def __init__(self, ring: np.ndarray) -> None:
        n = len(ring)
        self.size, self.signs = n, int(ring.max()) + 1
        packed = np.zeros(n, np.int64)
        for k in range(8):                                   # signs are below 128
            packed = (packed << 7) | np.roll(ring, -k)
        rank, span = np.unique(packed, return_inverse=True)[1], 8
        while span < n and rank.max() < n - 1:
            rank, span = np.unique(rank * n + np.roll(rank, -span), return_inverse=True)[1], 2 * span
        self.order = np.argsort(rank, kind="stable")         # rotation starts by rank
        self.before = ring[self.order - 1].astype(np.int64)
        self.keys = np.sort(self.before * n + np.arange(n))

    def step(self, sign: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the rotations that begin with the sign and go on as those in [low, high)."""
        at = sign * self.size
        return np.searchsorted(self.keys, at + low), np.searchsorted(self.keys, at + high)

    def branches(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(state, sign) of every distinct sign before the rotations of every interval."""
        width = high - low
        wide = np.flatnonzero(width > self.signs)
        thin = np.flatnonzero((width > 0) & (width <= self.signs))
        upto = np.cumsum(width[thin])
        place = np.arange(upto[-1] if len(thin) else 0) + np.repeat(low[thin] - upto + width[thin], width[thin])
        seen = np.unique(np.repeat(thin, width[thin]) * self.signs + self.before[place])
        state, sign = np.repeat(wide, self.signs), np.tile(np.arange(self.signs), len(wide))
        if len(wide):
            a, b = self.step(sign, low[state], high[state])
            state, sign = state[b > a], sign[b > a]
        return np.concatenate([seen // self.signs, state]), np.concatenate([seen % self.signs, sign])


def one_edit(index: RingIndex, heads: np.ndarray, flat: np.ndarray, start: np.ndarray, length: np.ndarray,
             exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, word) of the words that are a query with one sign replaced or inserted after its exact part.

    ``flat[start:start + length]`` are a query's signs in the order in which the
    index extends; ``heads`` are the places of the delimiters in the ring.
    """
    m = len(start)
    query, at = np.arange(m), np.zeros(m, np.int64)
    low, high = np.zeros(m, np.int64), np.full(m, len(heads), np.int64)         # rotations that begin with the delimiter
    erred = np.zeros(m, bool)
    found_q, found_w = [], []
    while len(query):
        left = length[query] - at
        done = erred & (left == 0)
        if done.any():
            a, b = index.step(np.zeros(int(done.sum()), np.int64), low[done], high[done])
            hit = b > a                                      # a whole word: words are distinct, so one rotation
            found_q.append(query[done][hit])
            found_w.append(np.searchsorted(heads, index.order[a[hit]]))
        sign = flat[start[query] + np.minimum(at, length[query] - 1)]
        fork = np.flatnonzero(~erred & (at >= exact[query]))
        state, other = index.branches(low[fork], high[fork])
        state = fork[state]
        new = (other != 0) & ((other != sign[state]) | (left[state] == 0))
        state, other = state[new], other[new]
        a, b = index.step(other, low[state], high[state])
        replaced = left[state] > 0
        on = left > 0
        lo, hi = index.step(sign[on], low[on], high[on])
        live = hi > lo
        edited = np.ones(len(state), bool)
        query, at, erred, low, high = (np.concatenate(x) for x in (             # on exactly; a sign replaced; one inserted
            (query[on][live], query[state][replaced], query[state]),
            (at[on][live] + 1, at[state][replaced] + 1, at[state]),
            (erred[on][live], edited[replaced], edited),
            (lo[live], a[replaced], a), (hi[live], b[replaced], b)))
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *found_q]), np.concatenate([none, *found_w])


def near_in_shard(words: list[str], asks: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (word, near word) numbers, both ways; ``asks``: the words searched by their first and by their second half."""
    length = np.array([len(w) for w in words], np.int64)
    start = np.concatenate([[0], np.cumsum(length)[:-1]])
    text = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    alphabet = np.unique(text)
    signs = np.searchsorted(alphabet, text) + 1              # 0 is the delimiter
    word = np.repeat(np.arange(len(words)), length)
    mirrored = signs[2 * start[word] + length[word] - 1 - np.arange(len(text))]
    heads = start + np.arange(len(words))
    pairs = [np.zeros(0, np.int64)]
    # A ring is extended to the left: the mirrored words' ring reads words from their start on, the other from their end.
    for asked, ring_signs, order, exact in ((asks[0], mirrored, signs, length // 2),
                                            (asks[1], signs, mirrored, length - length // 2)):
        if len(asked):
            ring = np.zeros(len(text) + len(words), np.int64)
            ring[np.arange(len(text)) + word + 1] = ring_signs
            q, v = one_edit(RingIndex(ring), heads, order, start[asked], length[asked], exact[asked])
            pairs += [asked[q] * len(words) + v, v * len(words) + asked[q]]
    both = np.unique(np.concatenate(pairs))
    return both // len(words), both % len(words)


def _half(length: Column, side: int) -> Column:
    cut = F.floor(length / 2).cast("int")
    return F.substring("word", F.lit(1), cut) if side == 0 else F.substring("word", F.char_length("word") - (length - cut) + 1, length - cut)


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """Distinct (word, near, near_n) of all words exactly one edit apart, both ways, of a stored (word, n) table."""
    spark = vocabulary.sparkSession
    ship(spark)
    size = F.char_length("word")
    posts = F.array(*[F.struct(F.xxhash64(length, F.lit(side), _half(length, side)).alias("key"), F.lit(side).alias("side"),
                               F.lit(asks).alias("asks"))
                      for length, asks in ((size, True), (size - 1, False)) for side in (0, 1)])
    posted = vocabulary.select("word", "n", F.explode(posts).alias("post")).select("word", "n", "post.*")
    shards = max(1, -(-4 * vocabulary.count() // SHARD_WORDS))
    hot = saved(posted.groupBy(F.col("key").alias("hot_key")).agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > HOT))
    chunks = F.coalesce(F.ceil(F.col("members") / HOT), F.lit(1)).cast("int")
    each = (posted.join(small_side(hot), F.col("key") == F.col("hot_key"), "left")
                  .withColumn("chunks", chunks)
                  .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
                  .withColumn("holds", F.col("chunk") == F.pmod(F.xxhash64("word", F.lit(3)), F.col("chunks")))
                  .where("asks or holds")
                  .select("word", "n", "side", "asks", F.pmod(F.xxhash64("key", "chunk"), F.lit(shards)).alias("shard")))

    def search(key: tuple, t: pa.Table) -> pa.Table:
        coded = t.column("word").combine_chunks().dictionary_encode()
        number, words = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        n = np.zeros(len(words), np.int64)
        n[number] = t.column("n").to_numpy()
        side, asks = t.column("side").to_numpy(), t.column("asks").to_numpy()
        a, b = near_in_shard(words.to_pylist(), [np.unique(number[asks & (side == s)]) for s in (0, 1)])
        return pa.table({"word": words.take(pa.array(a)).cast(pa.string()), "near": words.take(pa.array(b)).cast(pa.string()),
                         "near_n": pa.array(n[b])})

    found = each.groupBy("shard").applyInArrow(search, "word string, near string, near_n long")
    return found.dropDuplicates(["word", "near"])


def variant_groups(counts: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every row of a (word, n) table."""
    words = saved(counts)
    near = (near_pairs(words).groupBy("word")
            .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")))
    common = -F.col("best.less") >= ratio * F.col("n")
    out = saved(words.join(near, "word", "left")
                     .select("word", F.when(common, F.col("best.near")).alias("form"), "n",
                             F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(common, -F.col("best.less")).alias("form_n")))
    links = saved(out.where("form is not null").select("word", F.col("form").alias("root")))
    while True:                                  # counts rise tenfold at every step, so a few doublings reach the roots
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = saved(links.join(onward, "root", "left")
                           .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if links.where("moved").isEmpty():
            break
    return (out.join(links.select("word", "root"), "word", "left")
               .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
