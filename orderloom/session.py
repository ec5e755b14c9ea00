"""Session settings, the shared scratch folder and staged (written) intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app: str, **overrides: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_settings(shuffled_bytes: int, cores: int) -> dict[str, str]:
    """Settings for a job whose largest shuffle moves about `shuffled_bytes`.

    Partitions of some 200 MB fit an executor core's memory with room to sort, and there are
    never fewer than three per core. Adaptive execution merges those that turn out small, so
    too many cost little, while too few spill.
    """
    partitions = max(3 * cores, -(-shuffled_bytes // (200 << 20)))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.files.maxPartitionBytes": "256m",
    }


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in spark.checkpoint.dir.

    A folder of our own is made only in local mode, where driver and executors are one
    process; anywhere else an unset folder is an error, since a machine-local path would
    be lost with its executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
    return _local_folder()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="orderloom-")


def _application_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/orderloom/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in this application's part of the shared folder that nothing has used yet."""
    path = f"{_application_folder(spark)}/{label}-{uuid.uuid4().hex}"
    for scope in _SCOPES:
        scope.append(path)
    return path


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shuffles_removed(spark: SparkSession):
    """Inside, what a query has shuffled is removed from the disks as soon as the query ends.

    Otherwise it stays until the driver happens to collect its garbage, so a job of many steps
    holds the shuffles of all of them at once. What a query made is not lost: if it is run once
    more, its shuffles are made anew.
    """
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def parts_joined(spark: SparkSession):
    """Inside, two tables that both lie by some of the columns they are joined on are not shuffled
    by all of them."""
    return _setting(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false")


# Paths made inside each open `scratch`; jobs that run side by side share them.
_SCOPES: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove what is staged inside once it ends, however it ends, and what its queries shuffle
    as each of them ends.

    For jobs whose results are written elsewhere; nothing lazy that reads a staged table may
    leave it. With several open at once, whichever ends first keeps what the others made too.
    """
    paths: list[str] = []
    _SCOPES.append(paths)
    try:
        with shuffles_removed(spark):
            yield
    finally:
        _SCOPES[:] = [scope for scope in _SCOPES if scope is not paths]
        others = {path for scope in _SCOPES for path in scope}
        for path in paths:
            if path not in others:
                files, folder = hadoop_path(spark, path)
                files.delete(folder, True)


def hadoop_path(spark: SparkSession, path: str):
    """The file system that a path lies in, and the path as that system takes it."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def folder_exists(spark: SparkSession, path: str) -> bool:
    """Whether `path` is there, asked of its own file system."""
    files, folder = hadoop_path(spark, path)
    return files.exists(folder)


def clear_staged(spark: SparkSession) -> None:
    """Remove this application's staged tables, once no result that reads them is needed."""
    files, folder = hadoop_path(spark, _application_folder(spark))
    files.delete(folder, True)


ROWS_A_TASK = 1 << 17


def sized(df: DataFrame, rows: int) -> DataFrame:
    """`df` in no more tasks than about `rows` short rows need, and one for each core.

    A small table then costs neither a task nor a file for every shuffle partition there is; a
    large one keeps its partitions.
    """
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS_A_TASK)))


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once and read it back: cuts lineage, survives the loss of executors."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
