"""Every registered query against its SQL statement at the smallest scale, and the driver contract."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry  # noqa: E402
from check import TABLES, canonical  # noqa: E402

SF = "/root/testdata/sf0.001"

# Statements that spell out the columns or values a level keeps, which holds from the next scale on.
LARGER_SCALE = {"level0", "level1", "level2", "level2_unbalanced", "level3", "level4", "level5", "level5_test_split", "preset_transform",
                "preset_train_test", "fit_preset", "load_level", "save_level", "drop_low_variance_95", "drop_missing", "drop_low_variance"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_every_statement_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - LARGER_SCALE))
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    got = duck.execute(entry.oracle_sql()[name])
    assert canonical(df.columns, df.collect()) == canonical([d[0] for d in got.description], got.fetchall())
