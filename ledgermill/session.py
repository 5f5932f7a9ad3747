"""Session settings and the shared stage folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every operator assumes. Nothing here fixes a partition count:
# AQE coalesces or splits shuffle partitions from the sizes it sees at run time. Times are
# written as microseconds, since Parquet keeps no minimum and maximum of Spark's default format.
# Partitions are merged up to 32 MB as shuffled, not 64: ledger keys shrink to a tenth in a
# shuffle, and what a task sorts or counts of them is several times that.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}

# Settings that only a new session can take. Origin tracking sends several messages to the
# JVM for every column expression, which costs seconds on wide plans.
STATIC_CONF = {"spark.python.sql.dataFrameDebugging.enabled": "false"}

STAGE_DIR_CONF = "spark.checkpoint.dir"
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int | str = "*", **conf: str) -> SparkSession:
    """A session for one machine, as the tests and the benchmark use it."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("ledgermill")
    settings = STATIC_CONF | RUNTIME_CONF
    settings |= {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "12g",
    }
    for key, value in (settings | conf).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Pin UTC and the adaptive settings on a running session."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def stage_root(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it.

    Only a local master may fall back to a temporary folder: there the driver and
    the executors are one process on one machine.
    """
    root = spark.conf.get(STAGE_DIR_CONF, None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError(f"set {STAGE_DIR_CONF} to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="ledgermill-stage-")
    spark.conf.set(STAGE_DIR_CONF, root)
    return root


def application_folder(spark: SparkSession) -> str:
    return f"{stage_root(spark)}/ledgermill-{spark.sparkContext.applicationId}"


def stage_path(spark: SparkSession, label: str) -> str:
    return f"{application_folder(spark)}/{label}-{uuid.uuid4().hex}"


def clear_stages(spark: SparkSession) -> None:
    """Delete what this application staged, once its frames are no longer needed."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(application_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def settings(spark: SparkSession, **conf: str) -> Iterator[None]:
    """These settings, with ``__`` for a dot, for what is run in here."""
    named = {key.replace("__", "."): value for key, value in conf.items()}
    before = {key: spark.conf.get(key, None) for key in named}
    for key, value in named.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shuffles_dropped(spark: SparkSession):
    """Delete the shuffle files of each query that is run in here as soon as it has ended."""
    return settings(spark, **{CLEANUP_CONF: "true"})


def staged(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back, so that several consumers share the work.

    A written table survives the loss of executors and cuts the lineage; its readers
    still prune columns and push filters. The shuffles that led to it are deleted, so the
    disk holds the table and not also what it was made of. ``codec`` packs ledgers closer
    than Spark's default.
    """
    spark = df.sparkSession
    path = stage_path(spark, label)
    with shuffles_dropped(spark):
        df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)
