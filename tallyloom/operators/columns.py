"""Per-column aggregates.

Two shapes serve every profiler and every fit:

* ``per_column`` aggregates the wide table once per batch of columns. Each batch reads only its own columns, keeps
  one row of partial state per task and shuffles nothing but that row.
* ``value_counts`` is the long ``(feature, value, n, n_pos)`` table. Counting is combined map-side, so a value that
  holds a third of the rows costs one record per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import quoted, text

BATCH = 64

# Aggregates of a column, as SQL text with {c} for the column.
ROWS = "count(1)"
MISSING = "count_if({c} IS NULL)"
MISSING_SHARE = "avg(CASE WHEN {c} IS NULL THEN 1D ELSE 0D END)"
WHOLE = "bool_and({c} % 1 = 0)"
LOW, HIGH, MEAN, STD, KNOWN = "min({c})", "max({c})", "avg({c})", "stddev_pop({c})", "count({c})"
# The most frequent value, if it holds more than half of all rows by 0.002; else any value or null. Merged sketches stay as short
# as one task's, where quantile sketches grow with every merge. Adding zero makes -0.0 and 0.0 one value.
MAJORITY_VALUE = "try_element_at(approx_top_k(CAST({c} AS DOUBLE) + 0D, 1, 1000), 1).item"


def per_column(df: DataFrame, features: Sequence[str], measures: Mapping[str, str],
               shared: Mapping[str, str] | None = None, batch: int = BATCH) -> DataFrame:
    """One row per feature with the given aggregates: ``feature, *measures, *shared``.

    ``shared`` aggregates belong to the table, not to a column; they are computed once per batch.
    """
    shared = shared or {}
    parts = []
    for start in range(0, len(features), batch):
        chunk = features[start:start + batch]
        structs = []
        for i, name in enumerate(chunk):
            fields = ", ".join(f"'{key}', {sql.replace('{c}', quoted(name))}" for key, sql in measures.items())
            structs.append(f"named_struct('feature', {text(name)}, {fields}) AS c{i}")
        facts = df.selectExpr(*structs, *[f"{sql} AS {quoted(key)}" for key, sql in shared.items()])
        listed = ", ".join(f"c{i}" for i in range(len(chunk)))
        parts.append(facts.selectExpr(f"inline(array({listed}))", *[quoted(k) for k in shared]))
    return reduce(DataFrame.union, parts)


def value_counts(df: DataFrame, features: Sequence[str], label: str | None = None) -> DataFrame:
    """Rows and positive rows per distinct value: ``feature, value, n[, n_pos]``; missing is the null value.

    The long form carries a short column number, not the column name, through the shuffle.
    """
    ids = [] if label is None else ["_pos"]
    keyed = df.selectExpr(*([f"CAST({quoted(label)} = 1 AS INT) AS _pos"] if ids else []),
                          *[f"CAST({quoted(name)} AS DOUBLE) AS `{i}`" for i, name in enumerate(features)])
    # The id column takes a new name on the way: an id passed on unchanged makes two uses of the counts in one query
    # look different to the planner, which would then count twice instead of sharing one exchange.
    long = keyed.unpivot([F.expr("_pos AS _p")] if ids else [], [str(i) for i in range(len(features))], "_k", "value")
    counts = [F.expr("count(1) AS n"), *([F.expr("sum(_p) AS n_pos")] if ids else [])]
    names = ", ".join(text(name) for name in features)
    return (long.groupBy("_k", "value").agg(*counts)
            .selectExpr(f"element_at(array({names}), CAST(_k AS INT) + 1) AS feature", "value", "n", *(["n_pos"] if ids else [])))


def distinct_counts(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Exact number of distinct non-missing values: ``feature, distinct``."""
    return value_counts(df, features).groupBy("feature").agg(F.count("value").alias("distinct"))
