"""Standardisation with training statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import col, number, quoted
from .columns import MEAN, MISSING, STD, per_column

FLAT = 1e-12


def fit_scale(df: DataFrame, features: Sequence[str], flat: float = FLAT) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per feature; a flat feature is divided by 1."""
    if not features:
        return {}
    stats = per_column(df, features, {"mean": "coalesce(avg({c}), 0D)", "std": STD})
    return {r["feature"]: (r["mean"], r["std"] if r["std"] is not None and r["std"] > flat else 1.0)
            for r in stats.collect()}


def apply_scale(df: DataFrame, features: Sequence[str], scale: Mapping[str, tuple[float, float]]) -> DataFrame:
    out = {}
    for f in features:
        mean, std = scale.get(f, (0.0, 1.0))
        out[f] = F.expr(f"({quoted(f)} - {number(mean)}) / {number(std)}")
    return df.withColumns(out) if out else df


def standardize_all(train: DataFrame, other: DataFrame, features: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Scale two tables by the first one's statistics; a column with a missing training cell becomes missing."""
    stats = per_column(train, features, {
        "mean": MEAN, "std": STD, "missing": MISSING}).collect()
    out = {}
    for r in stats:
        name = r["feature"]
        known = r["missing"] == 0
        out[name] = ((col(name) - F.lit(r["mean"])) / F.lit(r["std"] or 1.0)) if known else F.lit(None).cast("double")
    return train.withColumns(out), other.withColumns(out)
