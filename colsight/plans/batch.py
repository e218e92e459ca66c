"""Profiles of a catalog's tables in batches that can be resumed.

Tables are profiled a slice at a time, each slice as one plan. A slice's profiles are written to a
folder of their own and only then named in the ledger; what a run that died has left without being
named there is never read. A slice that fails is halved until the table that can't be read stands alone; it
is put in the ledger with its error, and the others are done. A later run does what the ledger doesn't
have; nothing is written twice.
"""

from __future__ import annotations

import posixpath
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from colsight.plans.profile import PROFILE_SCHEMA, profile_folder

LEDGER_SCHEMA = "dataset string, state string, slice string, error string"
DONE, FAILED = "done", "failed"


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def read_ledger(spark: SparkSession, out: str) -> DataFrame:
    """(dataset, state, slice, error) of all finished tables."""
    path = posixpath.join(out, "ledger")
    return spark.read.schema(LEDGER_SCHEMA).parquet(path) if _exists(spark, path) else spark.createDataFrame([], LEDGER_SCHEMA)


def read_batch(spark: SparkSession, out: str) -> DataFrame:
    """Profiles of all tables that are done."""
    path = posixpath.join(out, "profiles")
    if not _exists(spark, path):
        return spark.createDataFrame([], PROFILE_SCHEMA)
    rows = spark.read.option("basePath", path).schema(f"{PROFILE_SCHEMA}, slice string").json(path)
    done = read_ledger(spark, out).where(F.col("state") == DONE).select("slice").distinct()
    return rows.join(done, "slice", "left_semi").drop("slice")


def _enter(spark: SparkSession, out: str, names: list[str], state: str, name: str, error: str | None) -> None:
    rows = spark.createDataFrame([(n, state, name, error) for n in names], LEDGER_SCHEMA)
    rows.coalesce(1).write.mode("append").parquet(posixpath.join(out, "ledger"))


def _slice(spark: SparkSession, folder: str, out: str, names: list[str], ending: str, sep: str) -> None:
    name = uuid.uuid4().hex
    paths = [posixpath.join(folder, n + ending) for n in names]
    try:
        profile_folder(spark, paths, sep=sep).write.json(posixpath.join(out, "profiles", f"slice={name}"))
    except Exception as e:  # whatever keeps a table from being read is that table's entry
        if len(names) > 1:
            for part in (names[: len(names) // 2], names[len(names) // 2 :]):
                _slice(spark, folder, out, part, ending, sep)
        else:
            _enter(spark, out, names, FAILED, name, str(e)[:2000])
        return
    _enter(spark, out, names, DONE, name, None)


def profile_catalog(
    spark: SparkSession, catalog: DataFrame, folder: str, out: str, skip: DataFrame | None = None, size: int = 200, ending: str = ".tsv*", retry: bool = False, sep: str = "\t"
) -> DataFrame:
    """Profile the tables of `catalog(dataset)`, files `<folder>/<dataset><ending>`, into `out`; returns the ledger.

    Tables in `skip(dataset)` and those the ledger has are left out; with `retry` failed ones are tried
    again. The driver holds the names of one slice of `size` tables at a time.
    """
    before = read_ledger(spark, out)
    if retry:
        before = before.where(F.col("state") == DONE)
    open_names = catalog.select("dataset").where("dataset <> ''").distinct().join(before.select("dataset"), "dataset", "left_anti")
    if skip is not None:
        open_names = open_names.join(skip.select("dataset"), "dataset", "left_anti")
    names: list[str] = []
    for row in open_names.orderBy("dataset").toLocalIterator():
        names.append(row["dataset"])
        if len(names) == size:
            _slice(spark, folder, out, names, ending, sep)
            names = []
    if names:
        _slice(spark, folder, out, names, ending, sep)
    return read_ledger(spark, out)
