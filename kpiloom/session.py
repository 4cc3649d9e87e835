"""SparkSession helpers: sane defaults and the shared checkpoint folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
}


def cluster_conf(executors: int, cores_per_executor: int) -> dict[str, str]:
    """Settings for a large cluster: many shuffle partitions, AQE coalesces them.

    With AQE, ``shuffle.partitions`` is an upper bound; partitions are merged
    to ~``advisoryPartitionSizeInBytes`` and skewed ones split, so a high
    value keeps every task's input small at 100 TB without hurting small runs.
    """
    slots = executors * cores_per_executor
    return {
        "spark.sql.shuffle.partitions": str(max(200, 4 * slots)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "kpiloom", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the models assume.

    ``master`` and ``shuffle_partitions`` are set only when given, so under
    ``spark-submit`` the cluster's own master and sizing stay in force.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when the session has none and runs on this machine alone (tests) is a
    scratch folder set; on a cluster that would be a folder no executor shares.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:            # Spark Connect: the server owns the checkpoint folder
        return configured or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors share (master {sc.master})")
        configured = tempfile.mkdtemp(prefix="kpiloom-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def store(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet under the checkpoint folder and read it back: columnar, lineage cut.

    The folders belong to the application and can go when it has ended.
    """
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
