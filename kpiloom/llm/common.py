"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet under the cluster's shared checkpoint folder and read it back.

    Cuts the lineage: what follows survives the loss of the executors that made
    it.  The folder goes with the session's checkpoint folder.
    """
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/kpiloom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


ARROW_ROWS = "2000"         # whole texts go over in batches of this size where the session has Spark's own 10,000

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's source to the executors, once per application, and size Arrow batches for whole texts."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(rows) == "10000":
        spark.conf.set(rows, ARROW_ROWS)
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="kpiloom-src-"), "kpiloom_src.zip")     # read by the driver only
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def give_back() -> None:
    """Return freed memory to the system: Python workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):       # glibc only
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def mapped(df: DataFrame, fn: Callable, schema) -> DataFrame:
    """``df.mapInArrow`` with this package at hand on the executors."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(it)
        give_back()

    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_key(text: Column) -> list[Column]:
    """Three longs that tell texts apart (64-bit hash, CRC-32, length); null text is a value of its own."""
    return [F.xxhash64(text).alias("key_hash"),
            F.coalesce(F.crc32(F.encode(text, "UTF-8")), F.lit(-1)).alias("key_crc"),
            F.coalesce(F.octet_length(text), F.lit(-1)).cast("long").alias("key_bytes")]


KEY = ["key_hash", "key_crc", "key_bytes"]


def running(df: DataFrame, order: list[str], descending: tuple[str, ...], value: str, name: str,
            run: str | None = None) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over all rows before a row in the total order ``order``.

    With ``run`` (a prefix of the order) sums start anew for each of its values.
    One range shuffle; sums inside a partition are taken as its sorted rows pass
    by.  Only one sum per partition (and run) reaches the driver.
    """
    spark = df.sparkSession
    by = [F.col(c).desc() if c in descending else F.col(c).asc() for c in order]
    dealt = df.repartitionByRange(partitions(spark), *by).sortWithinPartitions(*by).withColumn("_part", F.spark_partition_id())

    def local(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, current = 0, None
        for b in it:
            if not b.num_rows:
                continue
            v = b.column(b.schema.get_field_index(value)).to_numpy(zero_copy_only=False).astype(np.int64)
            total = np.cumsum(v) - v
            if run is None:
                out, before = total + before, before + int(v.sum())
            else:
                r = b.column(b.schema.get_field_index(run)).to_numpy(zero_copy_only=False)
                heads = np.flatnonzero(np.append(True, r[1:] != r[:-1]))
                length = np.diff(np.append(heads, len(v)))
                out = total - np.repeat(total[heads], length)
                if r[0] == current:
                    out[:length[0]] += before
                before, current = int(out[-1] + v[-1]), r[-1]
            yield b.append_column(name, pa.array(out, pa.int64()))

    schema = dealt.withColumn(name, F.lit(0).cast("long")).schema
    done = saved(mapped(dealt, local, schema))
    keys = ["_part"] + ([run] if run else [])
    sums = sorted(tuple(r) for r in done.groupBy(*keys).agg(F.sum(value)).collect())   # partitions (+ runs) rows
    offsets, totals = [], {}
    for *k, s in sums:
        r = k[1] if run else None
        offsets.append((*k, totals.get(r, 0)))
        totals[r] = totals.get(r, 0) + s
    types = ", ".join(f"{k} {dict(done.dtypes)[k]}" for k in keys)
    shift = spark.createDataFrame(offsets, f"{types}, _shift long")
    return (done.join(F.broadcast(shift), keys)            # at most partitions + runs rows
                .withColumn(name, F.col(name) + F.col("_shift")).drop("_part", "_shift"))
