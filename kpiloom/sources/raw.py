"""The four raw sources of the star schema, their schemas and readers."""

from __future__ import annotations

import os
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom.sources.sink import path_exists, write_table

RAW_SCHEMAS: dict[str, T.StructType] = {
    "plan_medical_group": T.StructType([
        T.StructField("plan_id", T.LongType()),
        T.StructField("medical_group_id", T.LongType()),
        T.StructField("plan_name", T.StringType()),
        T.StructField("medical_group_name", T.StringType()),
    ]),
    "claims": T.StructType([
        T.StructField("awv_date_of_service", T.DateType()),
        T.StructField("medical_group_id", T.LongType()),
        T.StructField("patient_id", T.LongType()),
        T.StructField("plan_id", T.LongType()),
    ]),
    "actions_available": T.StructType([
        T.StructField("plan_id", T.LongType()),
        T.StructField("medical_group_id", T.LongType()),
        T.StructField("date_day", T.DateType()),
        T.StructField("count_actions_available", T.LongType()),
    ]),
    "actions_attested": T.StructType([
        T.StructField("plan_id", T.LongType()),
        T.StructField("medical_group_id", T.LongType()),
        T.StructField("date_day", T.DateType()),
        T.StructField("count_actions_attested_as_complete", T.LongType()),
    ]),
}


RAW_TABLES = ("plan_medical_group", "claims", "actions_available", "actions_attested")
COLUMNAR_FORMATS = ("parquet", "orc")


class RawTables(NamedTuple):
    """The raw inputs: reference table, claims and the two daily snapshots.

    ``columnar`` says re-reading a table is a cheap pruned scan (Parquet/ORC);
    otherwise (CSV, JSON, derived inputs) a table read by many consumers is
    worth storing once.  ``rejected`` has the malformed rows where they are kept
    apart.  ``footers`` has, for Parquet, each table as a scan whose least and
    greatest values come from the file footers.
    """

    plan_medical_group: DataFrame
    claims: DataFrame
    actions_available: DataFrame
    actions_attested: DataFrame
    columnar: bool = False
    rejected: DataFrame | None = None
    footers: dict[str, DataFrame] | None = None

    def tables(self) -> tuple[DataFrame, ...]:
        return tuple(getattr(self, n) for n in RAW_TABLES)


TEXT_FORMATS = ("csv", "json")
BAD_ROWS = ("fail", "apart")
_CORRUPT = "_corrupt_record"


def _reader(spark: SparkSession, name: str, fmt: str, header: bool):
    reader = spark.read.schema(RAW_SCHEMAS[name]).format(fmt)
    return reader.option("header", str(header).lower()) if fmt == "csv" else reader


def read_raw(spark: SparkSession, path: str, name: str, fmt: str = "csv",
             header: bool = True) -> DataFrame:
    """Scan one raw table with its declared schema (no inference).

    ``fmt`` is any Spark source (``csv``, ``parquet``, ``json``, ``orc``).
    CSV and JSON parsing is FAILFAST so a malformed row raises instead of becoming null.
    """
    reader = _reader(spark, name, fmt, header)
    return (reader.option("mode", "FAILFAST") if fmt in TEXT_FORMATS else reader).load(path)


class SplitRead(NamedTuple):
    """A raw table's well-formed rows, and its malformed ones as (table, file, record)."""

    good: DataFrame
    rejected: DataFrame


def read_raw_split(spark: SparkSession, path: str, name: str, fmt: str = "csv", header: bool = True) -> SplitRead:
    """Like ``read_raw``, with malformed rows (bad values, too few or too many fields) kept apart.

    Every row is parsed whole on every read, whatever columns are asked for, so
    that each row is on the same side in all of them.
    """
    if fmt not in TEXT_FORMATS:
        raise ValueError(f"{fmt} files have no malformed rows: they can be read or not")
    schema = T.StructType([*RAW_SCHEMAS[name].fields, T.StructField(_CORRUPT, T.StringType())])
    rows = (_reader(spark, name, fmt, header).schema(schema).option("mode", "PERMISSIVE").option("columnPruning", "false")
            .option("columnNameOfCorruptRecord", _CORRUPT).load(path))
    columns = RAW_SCHEMAS[name].names
    # The parser looks only at fields that some expression reads; this condition, always true, reads them all.
    whole = F.hash(*columns).bitwiseOR(F.lit(1)) != 0
    good = rows.filter(F.col(_CORRUPT).isNull() & whole).select(*columns)
    rejected = (rows.filter(F.col(_CORRUPT).isNotNull() & whole)
                .select(F.lit(name).alias("table"), F.col("_metadata.file_path").alias("file"), F.col(_CORRUPT).alias("record")))
    return SplitRead(good, rejected)


def rejected_counts(rejected: DataFrame) -> DataFrame:
    """(table, file, rows) of the malformed rows."""
    return rejected.groupBy("table", "file").agg(F.count(F.lit(1)).alias("rows"))


def footer_scan(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet scan that answers a global min, max or count from the file footers, without reading rows.

    Every file must have a value in the column: Spark raises on one with nulls alone.
    Only the newer scan of Spark does so, and only for Parquet in general if the
    session says so; here it is asked for while this one table is opened.
    """
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    listed = "spark.sql.sources.useV1SourceList"
    before = spark.conf.get(listed)
    spark.conf.set(listed, ",".join(x for x in before.split(",") if x.strip().lower() != "parquet"))
    try:
        return spark.read.schema(schema).parquet(path)
    finally:
        spark.conf.set(listed, before)


def read_raw_dir(spark: SparkSession, directory: str, fmt: str = "csv", bad_rows: str = "fail",
                 footers: bool = False) -> RawTables:
    """Read the four raw tables stored as ``<directory>/<name>`` (file or folder) or ``<name>.<fmt>``.

    ``bad_rows``: ``fail`` raises on a malformed row, ``apart`` reads on and keeps
    those rows in ``rejected``.  ``footers`` opens Parquet tables as ``footer_scan`` too.
    """
    if bad_rows not in BAD_ROWS:
        raise ValueError(f"bad_rows is one of {BAD_ROWS}")

    def place(name: str) -> str:
        path = os.path.join(directory, name)
        return f"{path}.{fmt}" if not path_exists(spark, path) and path_exists(spark, f"{path}.{fmt}") else path

    paths = {n: place(n) for n in RAW_TABLES}
    if bad_rows == "apart" and fmt in TEXT_FORMATS:
        split = {n: read_raw_split(spark, p, n, fmt) for n, p in paths.items()}
        rejected = reduce(DataFrame.unionByName, (x.rejected for x in split.values()))
        return RawTables(*(x.good for x in split.values()), rejected=rejected)
    scans = {n: footer_scan(spark, p, RAW_SCHEMAS[n]) for n, p in paths.items()} if footers and fmt == "parquet" else None
    return RawTables(*(read_raw(spark, p, n, fmt) for n, p in paths.items()), columnar=fmt in COLUMNAR_FORMATS, footers=scans)


def write_raw_dir(raw: RawTables, directory: str, fmt: str = "csv") -> None:
    """Write the four raw tables so ``read_raw_dir`` can load them back."""
    for name, df in zip(RAW_TABLES, raw.tables()):
        write_table(df, os.path.join(directory, name), fmt)
