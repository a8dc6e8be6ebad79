"""Numbered folders (kind=N) of a shared path: which are whole, and removing old ones."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def numbered(spark: SparkSession, path: str, kind: str) -> list[int]:
    """Numbers of the folders path/kind=N that were written to the end, in order."""
    fs, root = _open(spark, path)
    found = []
    for status in fs.listStatus(root) if fs.exists(root) else []:
        name = status.getPath().getName()
        if name.startswith(f"{kind}=") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
            found.append(int(name.split("=")[1]))
    return sorted(found)


def delete(spark: SparkSession, folder: str) -> None:
    fs, path = _open(spark, folder)
    fs.delete(path, True)
