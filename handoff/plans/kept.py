"""Results that several queries of one session share, kept as long as their input files are the same."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import SparkSession


def folder_state(spark: SparkSession, folder: str) -> tuple:
    """(path, length, modification time) of every file below the folder, in order."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True)
    found = []
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(found))


def kept_per_input(make: Callable) -> Callable:
    """Keep what ``make(spark, folder)`` returned last; make it again for another session or changed files."""
    last: dict[str, tuple] = {}

    @wraps(make)
    def kept(spark: SparkSession, folder: str):
        state = spark.sparkContext.applicationId, folder_state(spark, folder)
        if folder not in last or last[folder][0] != state:
            last[folder] = state, make(spark, folder)
        return last[folder][1]

    return kept
