"""Materialise a DataFrame that several later steps read.

The copy is a Parquet table in the session's shared folder, so it outlives lost executors, later
steps read only the columns they need, and the optimiser sees its size. The process that made a
copy owns it: `drop` removes one that nothing reads any more, `release` all, at the latest when
the process ends. Shuffle files of the job that writes a copy go when the copy is there.
"""

from __future__ import annotations

import atexit
import posixpath
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

from colsight.session import shared_folder

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_MADE: list[tuple[SparkSession, str]] = []
_PATHS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()  # of the DataFrames `stage` gave


def scratch_folder(spark: SparkSession, kind: str = "staged") -> str:
    """A new folder's path; it is removed by `release`."""
    path = posixpath.join(shared_folder(spark), kind, uuid.uuid4().hex)
    _MADE.append((spark, path))
    return path


def stage(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    path = scratch_folder(spark)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    _PATHS[out] = path
    return out


def _remove(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is not None:  # the session is still there
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def drop(*staged: DataFrame) -> None:
    """Remove the copies that `stage` gave. No DataFrame that reads them can run any more."""
    for df in staged:
        path = _PATHS.pop(df)
        _MADE.remove((df.sparkSession, path))
        _remove(df.sparkSession, path)


def release() -> None:
    """Remove every copy this process has made. DataFrames that read them can't run any more."""
    while _MADE:
        _remove(*_MADE.pop())


atexit.register(release)
