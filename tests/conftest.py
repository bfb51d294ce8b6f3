import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession
    session = (SparkSession.builder.master("local[4]").appName("tests")
               .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
               .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def orders(spark):
    """The derived orders table at the smallest scale, read once."""
    from tallyloom.catalog.base import f_orders
    df = f_orders(spark, "/root/testdata/sf0.001").cache()
    df.count()
    return df


@pytest.fixture(scope="session")
def model_table(spark):
    from tallyloom.catalog.base import f_model
    df = f_model(spark, "/root/testdata/sf0.001").cache()
    df.count()
    return df


def frame(spark, columns: dict, partitions: int = 3):
    """A DataFrame of nullable doubles (``id`` and ``y`` as integers) from equal-length lists."""
    names = list(columns)
    kinds = {"id": "bigint", "y": "int"}
    schema = ", ".join(f"`{n}` {kinds.get(n, 'double')}" for n in names)
    rows = [tuple(None if v is None else (int(v) if n in kinds else float(v)) for n, v in zip(names, row))
            for row in zip(*columns.values())]
    return spark.createDataFrame(rows, schema).repartition(partitions)
