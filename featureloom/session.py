"""Session settings and the shared scratch area."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators are written for. They are defaults for sessions built
# here; a session handed in by the caller is used as it is.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A split of a hot key is worth the extra exchange it may cause further down.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Joins on (graph, node) may reuse a partitioning on a subset of these columns.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Where every shuffled partition is measured to be small, hash instead of sorting both sides.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # Nested column expressions are built from many small calls; do not record where each began.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str = "featureloom", master: str | None = None, **conf) -> SparkSession:
    """A session with :data:`DEFAULTS`; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULTS)
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _shared_dir(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names.

    Only a local-mode session may fall back to a folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = os.path.join(tempfile.gettempdir(), f"featureloom-{os.getuid()}")
    return base.rstrip("/")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared folder; its name tells the application that owns it."""
    return f"{_shared_dir(spark)}/{purpose}-{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"


def drop_staged(spark: SparkSession) -> None:
    """Delete all that this application has staged; call it when its results are written."""
    own = spark._jvm.org.apache.hadoop.fs.Path(f"{_shared_dir(spark)}/*-{spark.sparkContext.applicationId}-*")
    fs = own.getFileSystem(spark._jsc.hadoopConfiguration())
    for found in fs.globStatus(own) or []:
        fs.delete(found.getPath(), True)


def stage(df: DataFrame, purpose: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared scratch area and read it back.

    Used where one result feeds several branches: the copy survives the loss of executors
    and the branches do not repeat the work.
    """
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(side: DataFrame) -> DataFrame:
    """A side of a join whose rows are dealt out by key on both sides, never sent whole through the driver.

    The size of a staged file tells little about its rows: arrays of equal texts take a few bytes in Parquet and
    a hundred times as much once they are exploded. Spark would broadcast them by the size of the file.
    """
    return side.hint("merge")


def spread(scan: DataFrame) -> DataFrame:
    """Deal a plain scan out over all cores if it has fewer splits than there are cores.

    Meant in front of work that is heavy per row (parsing, token runs). A large input has
    many splits and is returned as it is, without a shuffle. Only for scans: counting the
    splits of a plan with shuffles would run them.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
