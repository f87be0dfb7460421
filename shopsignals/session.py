"""Spark session helpers.

The library never hard-codes cluster sizing.  ``build_session`` gives sane
defaults for local runs and tests; on a cluster the caller's session is used
as is and only the settings the library relies on are checked:

* ``spark.sql.session.timeZone`` must be UTC: hour / weekday / date features
  and all timestamp arithmetic are defined in UTC.
* ``spark.checkpoint.dir`` names the shared folder used to cut lineage
  (iterative ML).  It is read from the session; a folder is only chosen here
  when the setting is absent, which is the case in local tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

#: settings the plans rely on; AQE re-plans joins (broadcast when a side is
#: small at run time, split skewed partitions) and coalesces small partitions.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.ui.enabled": "false",
    # call-site capture for error messages costs two JVM round trips per
    # DataFrame / Column call while a plan is built; plans here are large
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app_name: str = "shopsignals",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """All time features are defined in UTC; pin the session zone."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering it with the context.

    Uses ``spark.checkpoint.dir`` when the cluster sets it; only when it is
    unset on a local master (local runs, tests) a fresh folder under the
    system temp dir is created and recorded in the session; on a cluster an
    unset folder is an error.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local"):
            # a machine-local folder is not visible to the other executors
            raise RuntimeError(
                "spark.checkpoint.dir is not set: point it at a shared folder "
                "(HDFS / object store) before running on a cluster."
            )
        configured = tempfile.mkdtemp(prefix="shopsignals-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured


def local_session_for_tests(cpus: int | None = None) -> SparkSession:
    cpus = cpus or int(os.environ.get("SHOPSIGNALS_CPUS", "8"))
    return build_session(
        "shopsignals-tests",
        master=f"local[{cpus}]",
        shuffle_partitions=cpus,
        extra_conf={"spark.driver.memory": "8g"},
    )


def materialize(df):
    """Cut lineage of an intermediate that several branches consume.

    The rows are written once as a Parquet table under the shared
    ``spark.checkpoint.dir`` (never ``localCheckpoint``) and read back: the
    data survives the loss of the executors that computed it, downstream
    branches read it instead of recomputing, and the read gets column
    pruning and filter pushdown.  (An eager ``checkpoint()`` of an
    unpersisted plan would compute it twice: once for the count, once for
    the checkpoint write.)
    """
    spark = df.sparkSession
    path = scratch_path(spark, "tables")
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A fresh path for intermediate data, under the shared checkpoint folder.

    All of an application's paths lie in one folder, which its file system
    removes when the application ends.
    """
    own = f"{checkpoint_dir(spark).rstrip('/')}/shopsignals/{spark.sparkContext.applicationId}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(own)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return f"{own}/{kind}/{uuid.uuid4().hex}"
