"""Fill values for missing cells."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import number, quoted
from .columns import per_column, value_counts
from .quantiles import IN_TASK_VALUES, exact_quantiles

CONTINUOUS_STRATEGIES = ("mean", "median")


def mean_fill(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return per_column(df, features, {"fill": "coalesce(avg({c}), 0D)"})


def median_fill(df: DataFrame, features: Sequence[str], in_task_values: int = IN_TASK_VALUES) -> DataFrame:
    medians = exact_quantiles(df, features, [0.5], in_task_values=in_task_values)
    names = df.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    return names.join(medians, "feature", "left").select(
        "feature", F.coalesce(F.col("quantiles")[0], F.lit(0.0)).alias("fill"))


def mode_fill(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Most frequent value, the lowest one on ties, 0 for an empty column."""
    counts = value_counts(df, features)
    rank = F.when(F.col("value").isNotNull(), F.struct("n", -F.col("value")))
    return counts.groupBy("feature").agg(F.coalesce(F.max_by("value", rank), F.lit(0.0)).alias("fill"))


def fit_fill(df: DataFrame, continuous: Sequence[str], others: Sequence[str], strategy: str = "mean",
             other_strategy: str = "mode") -> dict[str, float]:
    """Fill value per feature; one number per column comes back to the driver."""
    if strategy not in CONTINUOUS_STRATEGIES:
        raise ValueError(f"unknown strategy for continuous features: {strategy!r}")
    if other_strategy != "mode":
        raise ValueError(f"unknown strategy for other features: {other_strategy!r}")
    fill: dict[str, float] = {}
    if continuous:
        fitted = mean_fill(df, continuous) if strategy == "mean" else median_fill(df, continuous)
        fill.update({r["feature"]: r["fill"] for r in fitted.collect()})
    if others:
        fill.update({r["feature"]: r["fill"] for r in mode_fill(df, others).collect()})
    return fill


def filled_text(feature: str, fill: Mapping[str, float]) -> str:
    return f"coalesce(CAST({quoted(feature)} AS DOUBLE), {number(fill.get(feature, 0.0))})"


def apply_fill(df: DataFrame, features: Sequence[str], fill: Mapping[str, float]) -> DataFrame:
    """Replace missing cells; a feature without a fitted value gets 0."""
    return df.withColumns({f: F.expr(filled_text(f, fill)) for f in features})
