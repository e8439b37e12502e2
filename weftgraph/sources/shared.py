"""Staging tables in the folder all executors share.

A staged table cuts lineage and survives the loss of any executor, which is
why intermediate results that are read more than once are written here.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session may do without the setting: its executors run on
    this machine, so one temporary folder per application is shared by all.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder all executors share")
    app = context.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="weftgraph-")
    return _local_dirs[app]


def new_dir(spark: SparkSession, purpose: str) -> str:
    """A path in the shared folder that nothing uses yet."""
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write the frame and return the written table."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_counted(df: DataFrame, path: str) -> int:
    """Write the frame as ORC and return its rows, counted by the tasks that wrote them.

    A task that is run again counts once.
    """
    counted = Observation()
    df.observe(counted, F.count(F.lit(1)).alias("rows")).write.orc(path)
    return counted.get["rows"]


def fits_broadcast(spark: SparkSession, table_bytes: int) -> bool:
    """Is a table of this many bytes within the session's own broadcast limit?"""
    limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return table_bytes <= limit


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder this process made."""
    target, files = _files(spark, path)
    files.delete(target, True)


def _files(spark: SparkSession, path: str):
    """The path and its file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def move(spark: SparkSession, old: str, new: str) -> None:
    """Rename a folder; nothing may be at ``new``."""
    (source, files), (target, _) = _files(spark, old), _files(spark, new)
    if not files.rename(source, target):
        raise OSError(f"cannot move {old} to {new}")


def create_empty(spark: SparkSession, path: str) -> None:
    """Create an empty file and its folders; in one step, and never over another file."""
    target, files = _files(spark, path)
    if not files.createNewFile(target):
        raise FileExistsError(path)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder, none if there is no such folder."""
    target, files = _files(spark, path)
    if not files.exists(target):
        return []
    return [status.getPath().getName() for status in files.listStatus(target)]


def exists(spark: SparkSession, path: str) -> bool:
    target, files = _files(spark, path)
    return files.exists(target)
