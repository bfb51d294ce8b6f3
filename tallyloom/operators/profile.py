"""Descriptive reports over columns, labels and values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import col, number, quoted, text
from .columns import (
    BATCH, HIGH, LOW, MAJORITY_VALUE, MEAN, MISSING, MISSING_SHARE, STD, distinct_counts, per_column, value_counts,
)
from .quantiles import IN_TASK_VALUES, exact_quantiles

# Above this share a most frequent value is certain to be the one that the sketch returns.
MAJORITY = 0.51

MISSING_EDGES = (0.0, 0.05, 0.2, 0.5, 1.0)


def dataset_overview(df: DataFrame, features: Sequence[str], label: str = "y") -> DataFrame:
    """One row per class with the table's row and feature counts."""
    classes = df.groupBy(F.col(label).alias("y")).agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy()
    return classes.select(F.sum("n").over(whole).alias("rows"), F.lit(len(features)).alias("features"), "y", "n")


def label_counts(df: DataFrame, label: str = "y") -> DataFrame:
    return df.groupBy(F.col(label).alias("y")).agg(F.count(F.lit(1)).alias("n"))


def summarize(df: DataFrame, features: Sequence[str], in_task_values: int = IN_TASK_VALUES) -> DataFrame:
    """``feature, min, max, mean, median, std, missing, distinct`` with missing values left out of the statistics."""
    rows = df.count()
    measures = {"min": LOW, "max": HIGH, "mean": MEAN, "std": STD, "missing": MISSING}
    if rows * min(len(features), BATCH) <= in_task_values:
        facts = per_column(df, features, {**measures, "median": "percentile({c}, 0.5D)"})
    else:
        medians = exact_quantiles(df, features, [0.5], rows, in_task_values)
        facts = (per_column(df, features, measures)
                 .join(medians.select("feature", F.col("quantiles")[0].alias("median")), "feature", "left"))
    return (facts.join(distinct_counts(df, features), "feature")
            .select("feature", "min", "max", "mean", "median", "std", "missing", "distinct"))


def missing_shares(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return per_column(df, features, {"missing_share": MISSING_SHARE})


def missing_overview(shares: DataFrame) -> DataFrame:
    s = F.col("missing_share")
    return shares.agg(F.count_if(s == 0).alias("complete"), F.count_if(s > 0).alias("incomplete"), F.max(s).alias("worst"))


def missing_bins(shares: DataFrame, edges: Sequence[float] = MISSING_EDGES) -> DataFrame:
    """Features per missing-share bin; bins are closed on the left and the last one on both sides."""
    s = F.col("missing_share")
    last = len(edges) - 2
    inside = [(s >= edges[i]) & ((s <= edges[i + 1]) if i == last else (s < edges[i + 1])) for i in range(last + 1)]
    one_row = shares.agg(*[F.count_if(cond).alias(f"b{i}") for i, cond in enumerate(inside)])
    return one_row.select(F.inline(F.array(*[
        F.struct(F.lit(edges[i]).alias("low"), F.lit(edges[i + 1]).alias("high"), F.col(f"b{i}").alias("features"))
        for i in range(last + 1)])))


def constant_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Features with a single distinct value; equal extremes say so without counting values."""
    facts = per_column(df, features, {"low": LOW, "high": HIGH})
    return facts.where(F.col("low") == F.col("high")).select("feature", F.col("low").alias("value"))


def top_value_shares(df: DataFrame, features: Sequence[str], threshold: float) -> DataFrame:
    """``feature, value, share`` of the features whose most frequent value reaches the threshold.

    The share is of all rows, missing ones too. A value held by more than half of the rows is what a short sketch finds, so for
    such thresholds two column scans (sketch, count the rows equal to its value) replace the count of every value.
    """
    if threshold > MAJORITY:
        sketch = per_column(df, features, {"value": MAJORITY_VALUE})
        candidate = {r["feature"]: r["value"] for r in sketch.collect()}
        known = {f: v for f, v in candidate.items() if v is not None}
        if not known:
            return df.sparkSession.createDataFrame([], "feature string, value double, share double")
        hits = [f"named_struct('feature', {text(f)}, 'value', {number(v)}, 'share', "
                f"count_if(CAST({quoted(f)} AS DOUBLE) = {number(v)}) / count(1)) AS c{i}" for i, (f, v) in enumerate(known.items())]
        shares = df.selectExpr(*hits).selectExpr(f"inline(array({', '.join(f'c{i}' for i in range(len(hits)))}))")
    else:
        counts = value_counts(df, features)
        known = F.col("value").isNotNull()
        shares = counts.groupBy("feature").agg(
            F.max_by("value", F.when(known, F.struct("n", -F.col("value")))).alias("value"),
            (F.max(F.when(known, F.col("n"))) / F.sum("n")).alias("share"))
    return shares.where(F.col("share") >= threshold)


def value_detail(df: DataFrame, features: Sequence[str], label: str, top_n: int = 5) -> DataFrame:
    """The first ``top_n`` values of each feature in value order, with positives and positive rate."""
    counts = value_counts(df, features, label).where(F.col("value").isNotNull())
    order = Window.partitionBy("feature").orderBy("value")
    return (counts.withColumn("position", F.row_number().over(order)).where(F.col("position") <= top_n)
            .withColumn("rate", F.col("n_pos") / F.col("n")))


def positive_rate_by_value(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    counts = value_counts(df, features, label).where(F.col("value").isNotNull())
    return counts.select("feature", "value", "n", (F.col("n_pos") / F.col("n")).alias("rate"))


def scales(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return per_column(df, features, {"min": LOW, "max": HIGH, "std": STD})


def scale_summary(stats: DataFrame, low: float = 1e-6, high: float = 1e3) -> DataFrame:
    """One row over the per-feature scales (there are as many of those as columns)."""
    return stats.agg(F.min("min").alias("global_min"), F.max("max").alias("global_max"),
                     F.median("std").alias("median_std"), F.count_if(F.col("std") < low).alias("tiny"),
                     F.count_if(F.col("std") > high).alias("huge"))


def extreme_scales(stats: DataFrame, low: float = 1e-6, high: float = 1e3) -> DataFrame:
    side = F.when(F.col("std") < low, "small").when(F.col("std") > high, "large")
    return stats.select("feature", "std", side.alias("side")).where(F.col("side").isNotNull())


def equal_width_histogram(df: DataFrame, value: Column, bins: int) -> DataFrame:
    """``bin, low, high, n`` over the non-empty bins; the top edge belongs to the last bin."""
    data = df.select(value.cast("double").alias("v")).where(F.col("v").isNotNull())
    span = data.agg(F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    lo, hi = span["lo"], span["hi"]
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, low double, high double, n bigint")
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    place = F.least(F.floor((F.col("v") - lo) * bins / (hi - lo)), F.lit(bins - 1)).cast("int")
    return (data.groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
            .select("bin", (lo + F.col("bin") * width).alias("low"), (lo + (F.col("bin") + 1) * width).alias("high"), "n"))


def drilldown(df: DataFrame, feature: str) -> DataFrame:
    """Every value of one feature with its count, next to the feature's own facts."""
    facts = per_column(df, [feature], {
        "missing": MISSING, "missing_share": MISSING_SHARE, "min": LOW, "max": HIGH, "mean": MEAN})
    counts = value_counts(df, [feature]).where(F.col("value").isNotNull())
    return counts.join(facts, "feature").select("feature", "value", "n", "missing", "missing_share", "min", "max", "mean")


def discrete_features(df: DataFrame, features: Sequence[str], below: int = 10) -> DataFrame:
    """Features with fewer than ``below`` distinct values, with the exact number."""
    short = short_features(df, features, below)
    if not short:
        return df.sparkSession.createDataFrame([], "feature string, distinct bigint")
    return distinct_counts(df, short).where(F.col("distinct") < below)


DISTINCT_SKETCH = "approx_count_distinct({c})"


def may_be_short(estimate: int, limit: int) -> bool:
    """False only if the column has more than ``limit`` distinct values.

    A sketch of 512 registers that saw ``limit`` values has at most that many registers set, and its estimate then
    stays near ``limit``; an estimate above four times the limit therefore rules the column out, and only the few
    remaining columns need an exact count.
    """
    return estimate <= 4 * limit + 16


def short_features(df: DataFrame, features: Sequence[str], limit: int) -> list[str]:
    """Features that may have at most ``limit`` distinct values."""
    sketch = per_column(df, features, {"distinct": DISTINCT_SKETCH})
    return [r["feature"] for r in sketch.collect() if may_be_short(r["distinct"], limit)]


def outlier_report(df: DataFrame, features: Sequence[str], low: float = 0.01, high: float = 0.99,
                   in_task_values: int = IN_TASK_VALUES) -> DataFrame:
    """Complete features whose extremes lie outside their ``low``/``high`` quantiles."""
    extremes = per_column(df, features, {"min": LOW, "max": HIGH, "missing": MISSING})
    bounds = exact_quantiles(df, features, [low, high], in_task_values=in_task_values)
    bounds = bounds.select("feature", F.col("quantiles")[0].alias("q_low"), F.col("quantiles")[1].alias("q_high"))
    return (extremes.join(bounds, "feature").where(F.col("missing") == 0)
            .where((F.col("min") < F.col("q_low")) | (F.col("max") > F.col("q_high")))
            .select("feature", "min", "max", "q_low", "q_high"))


def outlier_label_split(df: DataFrame, report: DataFrame, label: str = "y") -> DataFrame:
    """Class counts of rows inside all reported ranges and of rows outside at least one."""
    outside = F.lit(False)
    for r in report.collect():
        v = col(r["feature"])
        outside = outside | F.coalesce((v < r["q_low"]) | (v > r["q_high"]), F.lit(False))
    return (df.groupBy(F.when(outside, "outlier").otherwise("clean").alias("part"), F.col(label).alias("y"))
            .agg(F.count(F.lit(1)).alias("n")))
