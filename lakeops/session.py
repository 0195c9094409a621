"""SparkSession factory and shared-folder helpers.

Everything in the package is a DataFrame -> DataFrame function; the only
session-level concerns are the settings the operators rely on (UTC, ANSI,
AQE with skew handling, no UI) and a place for intermediate tables that
every executor can reach (``spark.checkpoint.dir``).
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Partitions are sized from bytes, not from a fixed count, so the same
    # code holds from a laptop to a large cluster.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "lakeops", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults."""
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


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names for intermediate data.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir) and
    used as it stands, scheme included. Only a session in local mode, where
    one machine holds every executor, may go without: a temporary folder is
    then registered as the checkpoint dir. On a cluster a missing setting is
    an error, since a machine-local folder would lose other executors' files.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lakeops-ckpt-"))
        path = spark.sparkContext.getCheckpointDir()
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared dir (never reused). What lies
    there is deleted when the driver's Python ends."""
    root = f"{shared_dir(spark).rstrip('/')}/lakeops/{spark.sparkContext.applicationId}"
    if root not in _CLEANED:
        _CLEANED.add(root)
        atexit.register(_delete, spark, root)
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


_CLEANED: set[str] = set()


def _delete(spark: SparkSession, path: str) -> None:
    """Best effort at exit: the session may be gone already."""
    if spark.sparkContext._jsc is not None:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def materialize(df, name: str):
    """Write ``df`` as Parquet under the shared folder and return a DataFrame
    reading it back. Used where one intermediate feeds several branches of a
    plan: the branches then scan the written table instead of recomputing
    (re-scanning and re-shuffling) its whole lineage, and a lost executor
    costs a re-read, not a recomputation. Runs a job immediately."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
