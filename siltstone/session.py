"""Session defaults and table access shared by every query."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def get_spark(app: str = "siltstone", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings that the queries assume; an existing session is reused."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        b = b.master(master).config("spark.driver.host", "127.0.0.1")
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A scan of fewer partitions than the cluster has cores, dealt to all of them; any larger scan as it is.

    For costly work on each row of a small table, which may lie in one row group; what is dealt is no more than a split a core.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


#: Tasks a core that evenly deals rows to.
TASKS = 4


def evenly(df: DataFrame) -> DataFrame:
    """The rows of a narrow scan, dealt evenly over several tasks a core.

    For costly work on each row of a table of a few small columns. However many splits a scan has, all rows may lie in the few that hold a
    row group's start, so its number of partitions says nothing; moving some bytes a row costs little beside the work.
    """
    return df.repartition(TASKS * df.sparkSession.sparkContext.defaultParallelism)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir).

    Only in one process (a local master), as in tests, a folder on this machine stands in where none is named.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"spark.checkpoint.dir must name a folder that the driver and all executors of {master} share")
    os.makedirs("/tmp/checkpoints", exist_ok=True)
    path = "file://" + tempfile.mkdtemp(dir="/tmp/checkpoints")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    atexit.register(_remove_local, path[len("file://") :])
    return path


def _remove_local(path: str) -> None:
    import shutil

    shutil.rmtree(path, ignore_errors=True)


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
