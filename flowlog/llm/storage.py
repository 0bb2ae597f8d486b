"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_local: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a local session that has none gets a temporary folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _local:
        _local.append(tempfile.mkdtemp(prefix="run-"))
    return _local[0]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` written once and read back: later plans start from files that outlive any executor."""
    spark = frame.sparkSession
    path = new_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    """Partitions a shuffle has in this session; they are set in proportion to the input."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
