"""Folders that every executor reaches."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``.

    Where nobody set it, a session of one machine gets a temporary folder; on a cluster that
    would lose rows, so there it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return f"{root.rstrip('/')}/calipers-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to a new shared folder and read from there."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
