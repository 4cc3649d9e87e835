"""Copies of a row carried as a count, and laid out again at the end.

A table without a uniqueness test may hold one key many times over.  Its rows
are first counted per distinct value (combined map-side), so joins and windows
meet each value once, whatever the number of its copies; sums weigh a value by
its count.  ``lay_out`` then emits the copies in chunks of bounded size that a
shuffle spreads over the cluster.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK = 1024            # copies laid out by one row of the spread


def count_copies(df: DataFrame, n: str) -> DataFrame:
    """Distinct rows with the number of their copies as ``n``."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(n))


def lay_out(df: DataFrame, n: str, copy: str, by: Sequence[Column] = ()) -> DataFrame:
    """Each row ``n`` times, numbered by ``copy`` from 0 (``n`` is dropped).

    One generator deals (row, chunk) and a second one the copies of a chunk; the
    shuffle between them spreads the chunks of a row with many copies.  ``df`` is
    computed once, whatever has copies.  ``by``: chunks of the same number are dealt
    by it and not by the whole row, so that rows grouped next by it or a part of it
    are combined before their shuffle.
    """
    rest = [c for c in df.columns if c != n]
    first = F.col("__chunk") * CHUNK
    return (df.select(*rest, n, F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(n) - 1) / CHUNK))).alias("__chunk"))
            .repartition(F.xxhash64(*(by or rest)), F.col("__chunk"))
            .select(*rest, F.explode(F.sequence(first, F.least(first + CHUNK, F.col(n)) - 1)).alias(copy)))
