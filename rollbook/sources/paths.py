"""Folder checks through the session's own file system client (local, HDFS, object stores)."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _client(spark: SparkSession, path: str):
    jvm = spark._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def is_complete(spark: SparkSession, path: str) -> bool:
    """True where a finished write left its success marker."""
    fs, location = _client(spark, f"{path}/_SUCCESS")
    return fs.exists(location)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    fs, location = _client(spark, path)
    if not fs.exists(location):
        return []
    return [s.getPath().getName() for s in fs.listStatus(location) if s.isDirectory()]


def file_names(spark: SparkSession, path: str) -> list[str]:
    fs, location = _client(spark, path)
    if not fs.exists(location):
        return []
    return [s.getPath().getName() for s in fs.listStatus(location) if s.isFile()]


def claim(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False where it is there already. File systems with an atomic create (local, HDFS)
    let one of several callers through."""
    fs, location = _client(spark, path)
    try:
        fs.create(location, False).close()
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, location = _client(spark, path)
    fs.delete(location, True)
