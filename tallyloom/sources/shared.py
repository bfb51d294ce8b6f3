"""Folders that the driver and every executor can reach, for tables written between steps."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names; on a local master without any, one temporary folder a session, removed at exit."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    session = spark.sparkContext.applicationId
    if session not in _local:
        _local[session] = tempfile.mkdtemp(prefix="tallyloom-")
        atexit.register(shutil.rmtree, _local[session], ignore_errors=True)
    return _local[session]


def new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` written to a shared folder and read back: its plan is a scan, and a lost executor loses none of it."""
    folder = new_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
