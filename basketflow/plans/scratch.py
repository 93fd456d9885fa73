"""Where intermediate tables go."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the cluster shares (``spark.checkpoint.dir``)."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def require_free(spark: SparkSession, path: str) -> None:
    at, files = _file_system(spark, path)
    if files.exists(at):
        raise ValueError(f"there is something at {path}")


def remove(spark: SparkSession, path: str) -> None:
    at, files = _file_system(spark, path)
    files.delete(at, True)


def children(spark: SparkSession, folder: str) -> list[str]:
    """The names of what is directly in a folder; none if it is not there."""
    at, files = _file_system(spark, folder)
    if not files.exists(at):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(at))


def bytes_below(spark: SparkSession, folder: str) -> int:
    """The bytes of all files below a folder."""
    at, files = _file_system(spark, folder)
    return files.getContentSummary(at).getLength()


def file_versions(spark: SparkSession, folder: str) -> tuple:
    """Name, size and time of each file below a folder, in order."""
    at, files = _file_system(spark, folder)
    found = []
    listed = files.listFiles(at, True)
    while listed.hasNext():
        status = listed.next()
        found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return tuple(sorted(found))
