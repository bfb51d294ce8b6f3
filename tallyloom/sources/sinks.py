"""Prepared levels, fitted state, submissions and run summaries on shared storage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import col
from ..plans.levels import PreparedState
from .shared import new_folder, shared_folder  # noqa: F401  (part of this module's interface)


def save_level(train: DataFrame, test: DataFrame, state: PreparedState, folder: str, file_format: str = "parquet",
               digits: int = 6) -> None:
    """Write both prepared tables (features at ``digits`` decimals) and the complete fitted state."""
    for name, df in (("train", train), ("test", test)):
        numbers = [c for c, kind in df.dtypes if kind == "double"]
        rounded = df.withColumns({c: F.round(col(c), digits) for c in numbers}) if numbers else df
        writer = rounded.write.mode("errorifexists")
        (writer.option("header", True).csv(f"{folder}/{name}") if file_format == "csv"
         else writer.parquet(f"{folder}/{name}"))
    state.to_frame(train.sparkSession).write.mode("errorifexists").parquet(f"{folder}/state")


def load_level(spark: SparkSession, folder: str, file_format: str = "parquet") -> tuple[DataFrame, DataFrame, PreparedState]:
    state = PreparedState.from_frame(spark.read.parquet(f"{folder}/state"))
    if file_format == "csv":
        read = spark.read.option("header", True).option("inferSchema", True).csv
    else:
        read = spark.read.parquet
    return read(f"{folder}/train"), read(f"{folder}/test"), state


def checked_sign(prediction: Column) -> Column:
    """The prediction itself, or an error for anything but -1 and 1."""
    bad = F.raise_error(F.concat(F.lit("prediction is neither -1 nor 1: "), F.coalesce(prediction.cast("string"), F.lit("missing"))))
    return F.when(prediction.isin(-1, 1), prediction).otherwise(bad).cast("int")


def submission(df: DataFrame, prediction: str = "y_hat", key: str = "id") -> DataFrame:
    return df.select(F.col(key).cast("bigint").alias("Id"), checked_sign(F.col(prediction)).alias("Prediction"))


def write_submission(df: DataFrame, path: str, prediction: str = "y_hat", key: str = "id") -> None:
    submission(df, prediction, key).write.mode("errorifexists").option("header", True).csv(path)


def write_summary(parts: Sequence[DataFrame], path: str) -> None:
    """Write run facts, one JSON file set; each part has ``section, item, number``."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    out.write.mode("errorifexists").json(path)
