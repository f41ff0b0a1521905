"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job in the library assumes.  Zone-less timestamps are typed
# as TIMESTAMP_NTZ, so the session zone only matters for display.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "demandlens",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster leave ``master`` unset so spark-submit decides; tests pass
    ``local[*]`` and a small shuffle-partition count.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    Reads ``spark.checkpoint.dir`` from the session.  Where it is unset, a
    single-JVM ``local`` session gets a private folder; on any other master
    that folder would not be shared with the executors, so it raises.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not is_single_jvm(spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="demandlens-ckpt-")
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir() or configured


def is_single_jvm(master: str) -> bool:
    """Whether driver and executors are one process (``local``, ``local[N]``)."""
    return master == "local" or master.startswith("local[")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location for written tables.

    Sinks that must write and read back (round trips, landed text) use this
    instead of a machine-local temporary folder, so the path is valid on every
    executor of a cluster.
    """
    base = checkpoint_dir(spark).rstrip("/")
    token = f"{name}-{os.getpid()}-{next(_COUNTER)}-{os.urandom(4).hex()}"
    return f"{base}/demandlens-scratch/{token}"


def write_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: evaluated once, lineage cut."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _counter():
    i = 0
    while True:
        i += 1
        yield i


_COUNTER = _counter()
