"""Session settings and the shared scratch location.

Nothing here overrides what a cluster already configures: the local
builder is for tests and the bench, and ``scratch_path`` only invents a
folder when the session names none in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings a cluster job should run with. AQE coalesces small shuffle
# partitions to the advisory size and splits skewed ones; input splits of
# 256 MB give about 400k scan tasks per 100 TB. The initial shuffle partition
# count is left to the cluster (AQE shrinks it per stage).
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    # Broadcast only from measured sizes: no broadcast planned from size
    # estimates; AQE may still switch a join to a broadcast once the shuffle
    # statistics of a side show it is small.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
}


def apply_recommended_conf(spark: SparkSession) -> SparkSession:
    """Set each ``CLUSTER_CONF`` entry the submitter did not set explicitly."""
    submitted = spark.sparkContext.getConf()
    for key, value in CLUSTER_CONF.items():
        if not submitted.contains(key):
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tickweek") -> SparkSession:
    """A local session for tests and the bench (UI off, small shuffles)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        # Local inputs are small: AQE sizes coalesced partitions by bytes only, and
        # with the 1 MB default a CPU-heavy post-shuffle stage (JSON, text parsing)
        # of a few MB would run on one core.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    )
    for key, value in CLUSTER_CONF.items():
        if key not in ("spark.sql.files.maxPartitionBytes",):
            builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a ``local[...]`` session that names none (a bare test session) gets a
    local folder, registered so that later calls agree on it. Elsewhere each
    executor would write to its own disk, so a missing setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master or ""
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tickweek-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder below the shared checkpoint root.

    Each call gets its own folder, so re-running a query that appends or
    refuses to overwrite never meets files of an earlier run. The folder is
    deleted when the application ends: the frames read from it are lazy, so
    no earlier moment is safe.
    """
    run = f"{checkpoint_root(spark)}/tickweek/{spark.sparkContext.applicationId}"
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(run)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(folder)  # only an existing path can be registered
    files.deleteOnExit(folder)
    return f"{run}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of an action in here go when it ends, unless the submitter says otherwise; by itself Spark waits for the driver's garbage collection."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    if spark.sparkContext.getConf().contains(key):
        yield
        return
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def one_writer(spark: SparkSession) -> Iterator[None]:
    """A partitioned write in here, whose tasks have one partition value each, does not sort its rows by it first."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, "1")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to a scratch folder and read back: lineage ends there, and its shuffle files go."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_removed(spark):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Delete a table that ``stored`` wrote; nothing may read it afterwards."""
    files = df.inputFiles()
    if files:
        spark = df.sparkSession
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
