"""Table sink: versions in folders of their own, and a log of commits that names the current one.

A table is a folder:

    <path>/data-<id>/...            one complete version each
    <path>/_commits/<number>        one line: what the version is, and a checksum of the line

A write makes a new data folder and then a commit file under the next number;
nothing is renamed, and nothing that a reader may be reading is overwritten.  The
current version is that of the highest commit whose line is complete.  So a write
that is killed at any point leaves the table as it was: a data folder without a
commit is never looked at, a commit file cut short does not count.  A reader
holds on to the version that it resolved; ``keep`` versions stay after a commit.
This needs no more of a store than that a closed file is visible and listed.

A Parquet table can be bucketed (``Buckets``): its files are dealt by a hash of key columns,
so aggregates and windows by these keys need no exchange when they read it.  The commit keeps the buckets,
and a reader names the version's folder in its session's catalog under them, as Spark takes buckets from
there only; the catalog entry holds no data.

Two writers at once: the commit file is created exclusively, so on stores that
have exclusive creation the second one fails and leaves the first one's table.
"""

from __future__ import annotations

import dataclasses
import json
import uuid
import zlib

from pyspark.sql import DataFrame, SparkSession

from kpiloom.session import checkpoint_dir

COMMITS = "_commits"
KEEP = 2


@dataclasses.dataclass(frozen=True)
class Buckets:
    """``number`` buckets by a hash of the columns ``by``, each sorted by them and ``sort``.

    ``dealt``: the rows come out of a shuffle by these columns already (a window or
    aggregate); otherwise they are dealt before the write, so that a bucket is one file.
    """

    number: int
    by: tuple[str, ...]
    sort: tuple[str, ...] = ()
    dealt: bool = False

    def noted(self) -> dict:
        return {"number": self.number, "by": list(self.by), "sort": list(self.sort)}


def _file_system(spark: SparkSession, path: str):
    """(Hadoop path, its file system): whatever store the path names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _file_system(spark, path)
    return fs.exists(p)


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: list[str] | None = None) -> None:
    """Write one folder of files, as a plain full overwrite."""
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def _entry(path: str) -> str:
    """The catalog name of a version's folder."""
    return f"kpiloom_{zlib.crc32(path.encode()):08x}_{path.rstrip('/').rsplit('-', 1)[-1]}"


def write_bucketed(df: DataFrame, path: str, buckets: Buckets) -> None:
    """Write one folder of bucketed Parquet files."""
    if not buckets.dealt:
        df = df.repartition(buckets.number, *buckets.by)
    (df.write.mode("overwrite").format("parquet").option("path", path)
       .bucketBy(buckets.number, *buckets.by).sortBy(*buckets.by, *buckets.sort).saveAsTable(_entry(path)))


def read_bucketed(spark: SparkSession, path: str, noted: dict) -> DataFrame:
    """A folder of bucketed files, with the buckets known to the planner."""
    def listed(columns: list[str]) -> str:
        return ", ".join(f"`{c}`" for c in columns)

    if not spark.catalog.tableExists(_entry(path)):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
        place = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {_entry(path)} ({columns}) USING parquet "
                  f"CLUSTERED BY ({listed(noted['by'])}) SORTED BY ({listed(noted['by'] + noted['sort'])}) "
                  f"INTO {int(noted['number'])} BUCKETS LOCATION '{place}'")
    return spark.table(_entry(path))


def store_bucketed(df: DataFrame, buckets: Buckets) -> DataFrame:
    """Write ``df`` bucketed under the session's checkpoint folder and read it back."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/kpiloom-{uuid.uuid4().hex}"
    write_bucketed(df, path, buckets)
    return read_bucketed(df.sparkSession, path, buckets.noted())


def _line(commit: dict) -> str:
    body = json.dumps(commit, sort_keys=True)
    return f"{zlib.crc32(body.encode()):08x} {body}\n"


def _parse(line: str | None) -> dict | None:
    """The commit that a line holds; None if it is not complete."""
    crc, _, body = (line or "").partition(" ")
    return json.loads(body) if body and crc == f"{zlib.crc32(body.encode()):08x}" else None


def commits(spark: SparkSession, path: str) -> list[tuple[int, dict]]:
    """Complete commits of a table, latest first."""
    folder, fs = _file_system(spark, f"{path}/{COMMITS}")
    if not fs.exists(folder):
        return []
    found = []
    for f in sorted((s.getPath() for s in fs.listStatus(folder)), key=lambda p: p.getName(), reverse=True):
        if not f.getName().isdigit():
            continue
        stream = fs.open(f)
        try:
            line = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
        finally:
            stream.close()
        commit = _parse(line)
        if commit:
            found.append((int(f.getName()), commit))
    return found


def _last_number(spark: SparkSession, path: str) -> int:
    folder, fs = _file_system(spark, f"{path}/{COMMITS}")
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    return max((int(n) for n in names if n.isdigit()), default=0)


def current_path(spark: SparkSession, path: str) -> str:
    """The folder of the current version; ``path`` itself for a plain folder without commits."""
    found = commits(spark, path)
    return f"{path}/{found[0][1]['data']}" if found else path


def current_notes(spark: SparkSession, path: str) -> dict:
    """What the writer noted about the current version."""
    found = commits(spark, path)
    return found[0][1].get("notes", {}) if found else {}


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The current version of a table."""
    found = commits(spark, path)
    if found and found[0][1].get("buckets"):
        return read_bucketed(spark, f"{path}/{found[0][1]['data']}", found[0][1]["buckets"])
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true").option("inferSchema", "true")
    return reader.load(f"{path}/{found[0][1]['data']}" if found else path)


def replace_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None,
                  keep: int = KEEP, notes=None, buckets: Buckets | None = None) -> str:
    """Write ``df`` as the new version of the table at ``path``; gives the version's folder.

    ``notes`` is called after the write; what it returns (plain values) is kept
    with the commit.  Versions before the last ``keep`` are removed.  ``buckets``: for
    Parquet without partition columns.
    """
    if buckets and (fmt != "parquet" or partition_by):
        raise ValueError("buckets need Parquet without partition columns")
    spark = df.sparkSession
    version = f"data-{uuid.uuid4().hex}"
    data, fs = _file_system(spark, f"{path}/{version}")
    number = _last_number(spark, path) + 1
    try:
        if buckets:
            write_bucketed(df, f"{path}/{version}", buckets)
        else:
            write_table(df, f"{path}/{version}", fmt, partition_by)
        commit = {"data": version, "format": fmt, "notes": notes() if notes else {}}
        if buckets:
            commit["buckets"] = buckets.noted()
        _commit(spark, path, number, commit)
    except Exception:
        fs.delete(data, True)
        spark.sql(f"DROP TABLE IF EXISTS {_entry(f'{path}/{version}')}")
        raise
    for _, old in commits(spark, path)[keep:]:
        fs.delete(_file_system(spark, f"{path}/{old['data']}")[0], True)
        if old.get("buckets"):
            spark.sql(f"DROP TABLE IF EXISTS {_entry(f'{path}/{old['data']}')}")
    for old_number, _ in commits(spark, path)[keep:]:
        fs.delete(_file_system(spark, f"{path}/{COMMITS}/{old_number:020d}")[0], False)
    return f"{path}/{version}"


def _commit(spark: SparkSession, path: str, number: int, commit: dict) -> None:
    """Create the commit file under its number; raises if another writer has taken it."""
    file, fs = _file_system(spark, f"{path}/{COMMITS}/{number:020d}")
    out = fs.create(file, False)
    try:
        out.write(bytearray(_line(commit).encode()))
    finally:
        out.close()


def remove_leftovers(spark: SparkSession, path: str, older_than_seconds: float = 86_400) -> list[str]:
    """Delete data folders that no commit names (of killed writes) and that are older than any running write could be."""
    folder, fs = _file_system(spark, path)
    named = {c["data"] for _, c in commits(spark, path)}
    now = spark._jvm.java.lang.System.currentTimeMillis()
    gone = []
    for s in fs.listStatus(folder):
        name = s.getPath().getName()
        if name.startswith("data-") and name not in named and now - s.getModificationTime() >= older_than_seconds * 1000:
            fs.delete(s.getPath(), True)
            gone.append(name)
    return gone
