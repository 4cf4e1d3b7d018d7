"""The folder that all machines share: fresh paths in it, and their end."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session. Where it is unset: a temporary folder if driver and executors are one
    process on one machine, else a folder of the warehouse, which all machines share too."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        alone = spark.sparkContext._jsc.sc().isLocal()
        at = tempfile.mkdtemp(prefix="loomspan-") if alone else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/loomspan"
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def _target(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, deleted when the application ends."""
    path = f"{shared_dir(spark)}/loomspan-{name}-{uuid.uuid4().hex}"
    target, system = _target(spark, path)
    system.deleteOnExit(target)
    return path


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a table that no later plan reads."""
    target, system = _target(spark, path)
    system.delete(target, True)
    system.cancelDeleteOnExit(target)
