"""Session settings the library is written for."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(master: str | None = None, shuffle_partitions: int | None = None, **more: str) -> SparkSession:
    """A session with the settings; master and partition count only where given (a cluster sets its own)."""
    builder = SparkSession.builder.appName("wattframe")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SETTINGS, **more}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once a session, unless the environment already names its folder to them."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    context = spark.sparkContext
    if root in map(os.path.abspath, os.environ.get("PYTHONPATH", "").split(os.pathsep)) or getattr(context, "_wattframe_shipped", False):
        return
    folder = os.path.realpath(tempfile.mkdtemp())
    context.addPyFile(shutil.make_archive(f"{folder}/wattframe", "zip", root, "wattframe"))
    context._wattframe_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str):
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or the context's checkpoint folder.

    Where neither is set, a local master (tests) gets a folder of its own; a cluster is refused, since a folder of one
    machine would lose data with it.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not (spark.sparkContext.master or "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="wattframe-shared-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
