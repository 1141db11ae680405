"""Where intermediate tables go: the shared folder the cluster names; and where workers find this package."""

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from landfall.functions.names import join_location

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach.

    Read from the session. A local session without the setting gets a fresh
    temporary folder; on a cluster the setting is required.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def fresh_folder(spark: SparkSession, name: str) -> str:
    """New, unused folder below the shared one."""
    return join_location(shared_folder(spark), "landfall", f"{name}-{uuid.uuid4().hex[:12]}")


def show_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did, wherever the session was started.

    On a cluster the path must be there too, or the package be installed.
    """
    root, environment = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    known = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *known])


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write a result that several branches use to the shared folder and read it back.

    It is computed once, and a lost executor cannot make the branches differ.
    """
    path = fresh_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
