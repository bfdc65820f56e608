"""Folders that driver and executors share, and what lies in them."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir; where that isn't set below the warehouse, and in local mode (tests) below a temporary folder of the session."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if spark.sparkContext.master.partition("[")[0] == "local":
            root = tempfile.mkdtemp(prefix="spark-")
            spark.sparkContext.setCheckpointDir(root)
        else:
            root = spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/foliary-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def complete(spark: SparkSession, path: str) -> bool:
    """Whether a table has been written at path to its end."""
    return exists(spark, f"{path}/_SUCCESS")


def remove(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
