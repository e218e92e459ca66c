"""Session helpers: defaults for local runs, folder for intermediate tables."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "colsight") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # call sites are looked up for every expression built; plans here hold hundreds
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", os.environ.get("COLSIGHT_DRIVER_MEMORY", "12g"))
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables: the one `spark.checkpoint.dir` names, else one beside the
    warehouse's tables. On a cluster it has to be shared by driver and executors, so a warehouse on a
    machine's own disk is refused there; a machine's temporary folder is never used."""
    named = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if spark.sparkContext.master.partition("[")[0] != "local" and warehouse.startswith(("file:", "/")):
        raise ValueError("name a folder that all machines share in spark.checkpoint.dir: the warehouse is a local folder")
    return f"{warehouse}/_colsight"
