"""MinHash near-dedup: signature-coordinate inverted join.

Documents with equal shingle sets are one node.  A node's signature has ``COORDS``
coordinates; it is posted under (coordinate, value) pairs.  Two nodes whose sets
are ``NUM``/``DEN`` alike share at least ``MATCHES`` coordinates (but for a chance
of about one in 10^5 at the threshold itself).  Values that a single node has
can't collide, nodes with fewer than ``MATCHES`` other values are skipped, and
the rest are posted under their rarest ones only: so many that two nodes with
``MATCHES`` collisions must meet (prefix).  Collisions are counted in the lists
and links confirmed on full sets (``similar.linked``); components follow.

Defined results: a text without words has no shingles and is linked with
nothing; a null doc_id takes part, but only ids that are not null name a
component; rows with equal texts are in one component, and rows that share the
kept id are all kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import KEY, mapped, saved, text_key
from kpiloom.llm.components import components
from kpiloom.llm.similar import linked, small_side
from kpiloom.llm.words import SHINGLE_WORDS, mix, row_shingles

COORDS, MATCHES = 16, 7
NUM, DEN = 85, 100
STAGE_MATCHES = 6               # of COORDS, for the pipeline's stage: about 3 in 10^5 at its threshold are missed
STAGE_NUM, STAGE_DEN = 80, 100
_FACTOR = np.random.Generator(np.random.PCG64(85)).integers(1, 1 << 63, COORDS, dtype=np.uint64) | np.uint64(1)


def set_number(shingles: np.ndarray) -> int:
    """64-bit number of a shingle set (0 if empty)."""
    with np.errstate(over="ignore"):
        return int(mix(np.array([mix(shingles).sum() + np.uint64(len(shingles))], np.uint64)).view(np.int64)[0]) if len(shingles) else 0


def signatures(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, text key, node, size, coords) of every row; no node and no coords without shingles."""
    def sign(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            node, size, coords = [], [], []
            for _, s in row_shingles(b.column(0), words):
                node.append(set_number(s) if len(s) else None)
                size.append(len(s))
                coords.append((s[:, None] * _FACTOR).min(0).view(np.int64) if len(s) else None)
            yield pa.record_batch([*b.columns[1:], pa.array(node, pa.int64()), pa.array(size, pa.int64()),
                                   pa.array(coords, pa.list_(pa.int64()))], ["doc_id", *KEY, "node", "size", "coords"])
    rows = docs.select(F.col("text").cast("string").alias("text"), "doc_id", *text_key(F.col("text")))
    schema = ", ".join(f"{n} {t}" for n, t in rows.dtypes[1:]) + ", node long, size long, coords array<long>"
    return mapped(rows, sign, schema)


def shingle_sets(docs: DataFrame, wanted: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """(node, shingles) of the nodes in ``wanted`` (node, place: id and text key of one document that has the set)."""
    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            sets = [s.tobytes() for _, s in row_shingles(b.column(0), words)]
            yield pa.record_batch([b.column(1), pa.array(sets, pa.binary())], ["node", "shingles"])
    rows = docs.select(F.struct("doc_id", *text_key(F.col("text"))).alias("at"), F.col("text").cast("string").alias("text"))
    met = rows.join(small_side(wanted), F.col("at") == F.col("place"))
    return mapped(met.select("text", "node"), cut, "node long, shingles binary").dropDuplicates(["node"])


def near_links(docs: DataFrame, signed: DataFrame, num: int = NUM, den: int = DEN, matches: int = MATCHES,
               words: int = SHINGLE_WORDS) -> DataFrame:
    """Edges between nodes that span the components of all links."""
    nodes = (signed.where("node is not null").groupBy("node", "size")
                   .agg(F.min(F.struct("doc_id", *KEY)).alias("place"), F.first("coords").alias("coords")))
    posts = nodes.select("node", F.posexplode("coords").alias("pos", "value")).select("node", F.xxhash64("pos", "value").alias("token"))
    often = posts.groupBy(F.col("token").alias("o_token")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = (posts.join(often, F.col("token") == F.col("o_token"))
                   .groupBy("node").agg(F.array_sort(F.collect_list(F.struct("n", "token"))).alias("by_n"))     # at most COORDS
                   .where(F.size("by_n") >= matches)
                   .select("node", F.transform("by_n", lambda x: x["token"]).alias("tokens"),
                           (F.size("by_n") - matches + 1).alias("posted")))
    active = saved(nodes.select("node", "size", "place").join(shared, "node"))
    members = active.select("node", "size", "tokens", "posted", F.explode(F.slice("tokens", 1, F.col("posted"))).alias("bucket"))
    sets = shingle_sets(docs, active.select("place", "node"), words)
    return linked(members, sets, num, den, matches)


def near_duplicates(docs: DataFrame, num: int = NUM, den: int = DEN, matches: int = MATCHES,
                    words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row."""
    signed = saved(signatures(docs, words))
    joined = saved(components(near_links(docs, signed, num, den, matches, words)))
    named = (signed.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
                   .join(joined, "node", "left").withColumn("component", F.coalesce("component", "node")))
    named = saved(named)
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of_node = named.join(least, "component").select(F.col("node").alias("c_node"), "component_id")
    return (signed.select("doc_id", "node", F.col("size").alias("n_shingles"))
                  .join(of_node, F.col("node") == F.col("c_node"), "left")
                  .withColumn("component_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
                  .select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")))


def keep_one(docs: DataFrame, num: int = STAGE_NUM, den: int = STAGE_DEN, matches: int = STAGE_MATCHES) -> DataFrame:
    """The rows and columns of ``docs`` less all but one document of each group of near duplicates.

    Documents are told apart by id and text, so ids may repeat; rows equal in both become one.
    """
    key = F.struct("doc_id", *text_key(F.col("text")))
    keyed = docs.select(*docs.columns, key.alias("__kpl_key"))
    named = saved(near_duplicates(docs.select(key.alias("doc_id"), "text"), num, den, matches))
    gone = saved(named.where("not kept").select(F.col("doc_id").alias("__kpl_gone")).distinct())
    rest = keyed.join(small_side(gone), F.col("__kpl_key") == F.col("__kpl_gone"), "left_anti")
    again = saved(named.where("kept and n_shingles > 0").groupBy(F.col("doc_id").alias("__kpl_again"))
                       .agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("__kpl_again"))
    if again.isEmpty():
        return rest.select(*docs.columns)
    once = rest.join(small_side(again), F.col("__kpl_key") == F.col("__kpl_again"), "left_anti")
    more = rest.join(small_side(again), F.col("__kpl_key") == F.col("__kpl_again"), "left_semi").dropDuplicates(["__kpl_key"])
    return once.unionByName(more).select(*docs.columns)
