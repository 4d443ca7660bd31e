"""Session settings every job relies on, and the shared folder for intermediate data."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A key that holds a large share of the rows is split at run time, also where
    # the split costs one more shuffle behind the join.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Only the touched buckets of a fact store are replaced.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# A task's share of files and of a shuffle is a number of bytes, so the memory of its groupings doesn't grow with the tables.
TASK_BYTES = {"spark.sql.files.maxPartitionBytes": "16m", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m"}
# Partitions a shuffle starts with at least, before AQE puts small ones together.
INITIAL_PARTITIONS = 1000
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings; joins are left to Catalyst's size-checked choice."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def bound_tasks(spark: SparkSession) -> SparkSession:
    """Let the number of tasks follow the bytes read and shuffled, instead of the bytes of a task follow the tables."""
    for name, value in TASK_BYTES.items():
        spark.conf.set(name, value)
    given = (spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get(_INITIAL, None) or 0)
    spark.conf.set(_INITIAL, str(max(INITIAL_PARTITIONS, *map(int, given))))
    return spark


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidegauge")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only where everything runs in one process."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tidegauge-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows below the shared folder and read them back.

    The plan is run once, later steps start from the files, and a lost executor never replays
    the steps before.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "step")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def written_once(df: DataFrame) -> Iterator[DataFrame]:
    """The rows of ``df`` from a folder of their own, for several uses; the folder is deleted at the end."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "batch")
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete_folder(spark, path)


def _path(spark: SparkSession, path: str):
    """A Hadoop path with its file system."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(context._jsc.hadoopConfiguration())


def delete_folder(spark: SparkSession, path: str) -> None:
    folder, system = _path(spark, path)
    system.delete(folder, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, without looking into any of them; none if the folder isn't there."""
    folder, system = _path(spark, path)
    return sorted(status.getPath().getName() for status in system.listStatus(folder)) if system.exists(folder) else []


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The Parquet files below ``path``, or no rows while there are none."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
