"""Feature tables and labels as DataFrames keyed by row id; missing is always null, never NaN."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import col
from ..operators.ranks import range_index


def nan_to_null(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(col(c)), col(c)) for c in floats}) if floats else df


def read_feature_csv(spark: SparkSession, path: str, id_type: T.DataType = T.LongType()) -> DataFrame:
    """CSV with a header: the first column is the row id, all others are numbers, empty means missing."""
    names = spark.read.option("header", True).csv(path).columns
    fields = [T.StructField("id", id_type)] + [T.StructField(n, T.DoubleType()) for n in names[1:]]
    return nan_to_null(spark.read.schema(T.StructType(fields)).option("header", True)
                       .option("enforceSchema", True).csv(path))


def read_label_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header: row id, then the label."""
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("y", T.IntegerType())])
    return spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(path)


def labelled(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of the feature table that have a label, with the label after the id."""
    rest = [col(c) for c in features.columns if c != "id"]
    return features.join(labels.select("id", "y"), "id").select("id", "y", *rest)


def read_dataset(spark: SparkSession, folder: str, every: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Labelled training table and unlabelled test table; ``every`` thins the training table."""
    train = labelled(read_feature_csv(spark, f"{folder}/x_train.csv"), read_label_csv(spark, f"{folder}/y_train.csv"))
    if every:
        train = every_nth(train, every)
    return train, read_feature_csv(spark, f"{folder}/x_test.csv")


def every_nth(df: DataFrame, n: int, key: str = "id") -> DataFrame:
    """Rows 0, n, 2n, ... of the table sorted by its key."""
    return range_index(df, key, "_at").where(F.col("_at") % n == 0).drop("_at")


def with_row_ids(df: DataFrame, order: str, output: str = "id") -> DataFrame:
    """Ids 1..n in key order, for tables whose own ids are not available."""
    return range_index(df, order, "_at").withColumn(output, F.col("_at") + 1).drop("_at")


def feature_columns(df: DataFrame, keys: Sequence[str] = ("id", "y")) -> list[str]:
    return [c for c in df.columns if c not in keys]
