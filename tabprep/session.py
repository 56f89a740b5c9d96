"""Session helpers.

The library never creates a session behind the caller's back; these helpers
exist for tests, the bench and the driver entry point.  On a cluster the
session comes from the platform and only ``checkpoint_dir`` is consulted.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every session we build gets.  AQE re-plans joins and coalesces
# shuffle partitions at runtime; skew join splits hot partitions.
_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "tabprep", checkpoint_dir: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """A local session for tests and benchmarks.  Python workers inherit the
    package through ``PYTHONPATH``; on a cluster ship it with
    ``spark-submit --py-files`` instead."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        os.environ["PYTHONPATH"] = os.pathsep.join([root, *paths])
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("TABPREP_DRIVER_MEMORY", "8g"))
               .config("spark.checkpoint.dir", checkpoint_dir or tempfile.mkdtemp(prefix="tabprep-ckpt-", dir="/tmp")))
    for k, v in {**_DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that one is
    always used.  Only where it is unset and the master is local is a scratch
    folder created, once per session; elsewhere that is an error, because
    executors do not see one another's local folders.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tabprep-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return configured


def save_table(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder as Parquet and read it back: cuts the
    lineage, keeps columns columnar, and lets several readers share one
    computation.  ``drop_tables`` removes what a session has written."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._saved_path = path
    return out


_written: dict[str, list[str]] = {}


def table_bytes(table: DataFrame) -> int:
    """Bytes on disk of a table from ``save_table``: what a broadcast of it is
    decided by, without a job."""
    spark = table.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table._saved_path)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(path).getLength()


def drop_tables(spark: SparkSession) -> int:
    """Delete the tables written by ``save_table`` in this application; call it
    when no DataFrame built on them is needed any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    paths = _written.pop(spark.sparkContext.applicationId, [])
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
    return len(paths)
