"""What kind of column is it: type roles, date- or id-like columns, survey codes, dependent columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import col, is_survey_code, quoted, survey_code_text
from .columns import HIGH, KNOWN, LOW, MEAN, MISSING, ROWS, STD, WHOLE, distinct_counts, per_column, value_counts
from .profile import DISTINCT_SKETCH, may_be_short
from .quantiles import exact_quantiles

# Limits of the type rules.
MAX_CATEGORIES = 15
MAX_CATEGORY_VALUE = 20
MAX_MISSING_SHARE = 0.95


def feature_roles(df: DataFrame, features: Sequence[str], max_categories: int = MAX_CATEGORIES,
                  max_missing: float = MAX_MISSING_SHARE) -> DataFrame:
    """``feature, role``: ignored, binary, pseudo_binary, categorical or continuous; the first rule that fits wins."""
    limit = max(2, max_categories)
    facts = per_column(df, features, {
        "rows": ROWS, "missing": MISSING, "low": LOW, "high": HIGH, "whole": WHOLE, "sketch": DISTINCT_SKETCH}).collect()
    few = [r["feature"] for r in facts if may_be_short(r["sketch"], limit)]
    distinct = {r["feature"]: r["distinct"] for r in distinct_counts(df, few).collect()} if few else {}
    facts = df.sparkSession.createDataFrame(
        [(r["feature"], r["rows"], r["missing"], _double(r["low"]), _double(r["high"]), r["whole"], distinct.get(r["feature"]))
         for r in facts],
        "feature string, rows bigint, missing bigint, low double, high double, whole boolean, distinct bigint")
    # Features without an exact count have more values than any rule asks about.
    distinct = F.coalesce("distinct", F.lit(max_categories + 1))
    share = F.col("missing") / F.col("rows")
    role = (
        F.when((F.col("missing") == F.col("rows")) | (share > max_missing), "ignored")
        .when(distinct == 2, "binary")
        .when((distinct == 1) & (share > 0.5 + 0.1 * F.log1p(F.col("rows"))), "pseudo_binary")
        .when(F.col("whole") & (distinct <= max_categories) & (F.col("high") <= MAX_CATEGORY_VALUE)
              & (F.col("high") - F.col("low") <= MAX_CATEGORY_VALUE), "categorical")
        .when((distinct > max_categories) | (F.col("high") > MAX_CATEGORY_VALUE) | ~F.col("whole"), "continuous")
        .otherwise("categorical"))
    return facts.select("feature", role.alias("role"))


def _double(value) -> float | None:
    return None if value is None else float(value)


def override_roles(roles: DataFrame, continuous: Sequence[str]) -> DataFrame:
    """Force the listed features to be continuous."""
    return roles.select("feature", F.when(F.col("feature").isin(list(continuous)), "continuous")
                        .otherwise(F.col("role")).alias("role"))


def date_or_id_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``feature, kind`` for year-like, month- or day-like and id-like features.

    Value counts are needed only for the features that range and integrality leave open.
    """
    facts = {r["feature"]: r for r in per_column(df, features, {
        "rows": ROWS, "low": LOW, "high": HIGH, "std": STD, "whole": WHOLE}).collect()}
    year, month, ident = [], [], []
    for name, r in facts.items():
        if r["low"] is None:
            continue
        if 1900 <= r["low"] <= 2100 and r["high"] <= 2100:
            year.append(name)
            continue
        if 1 <= r["low"] <= 31 and r["std"] < 10:
            month.append(name)
        if r["whole"] and r["high"] > 9999:
            ident.append(name)
    spark = df.sparkSession
    found = [(name, "year") for name in year]
    open_features = sorted(set(month) | set(ident))
    if open_features:
        rows = next(iter(facts.values()))["rows"]
        distinct = {r["feature"]: r["distinct"] for r in distinct_counts(df, open_features).collect()}
        calendar = [f for f in month if distinct[f] <= 31 and distinct[f] / rows < 0.05]
        medians = {}
        if calendar:
            medians = {r["feature"]: r["quantiles"][0] for r in exact_quantiles(df, calendar, [0.5], rows).collect()}
        for name in open_features:
            if name in calendar and medians[name] <= 12:
                found.append((name, "month_or_day"))
            elif name in ident and distinct[name] / rows < 0.1:
                found.append((name, "id"))
    return spark.createDataFrame(found, "feature string, kind string")


def survey_codes(df: DataFrame, features: Sequence[str], gap_ratio: float = 2.0) -> DataFrame:
    """``feature, code``: the top one or two values that stand apart and are written like survey codes.

    The mean gap below the last two follows from the smallest and the third largest value, so three top values and
    the number of values per feature are all the rule needs. Features whose maximum is no code are never counted.
    """
    tops = per_column(df, features, {"code": survey_code_text(HIGH)})
    candidates = [r["feature"] for r in tops.where("code").collect()]
    if not candidates:
        return df.sparkSession.createDataFrame([], "feature string, code double")
    counts = value_counts(df, candidates).where(F.col("value").isNotNull())
    spread = counts.groupBy("feature").agg(F.count(F.lit(1)).alias("k"), F.min("value").alias("low"))
    top_down = Window.partitionBy("feature").orderBy(F.col("value").desc())
    top = (counts.select("feature", "value").withColumn("place", F.row_number().over(top_down))
           .where(F.col("place") <= 3)
           .groupBy("feature").agg(*[F.max(F.when(F.col("place") == p, F.col("value"))).alias(f"v{p}") for p in (1, 2, 3)]))
    mean_gap = (F.col("v3") - F.col("low")) / (F.col("k") - 3)
    far1 = F.col("v1") - F.col("v2") >= gap_ratio * mean_gap
    far2 = F.col("v2") - F.col("v3") >= gap_ratio * mean_gap
    both = far1 & far2 & is_survey_code("v1") & is_survey_code("v2")
    codes = (F.when(both, F.array("v2", "v1"))
             .when(far1 & is_survey_code("v1"), F.array("v1")))
    return (spread.where(F.col("k") >= 4).join(top, "feature")
            .select("feature", F.explode(codes).alias("code")))


def clear_survey_codes(df: DataFrame, codes: DataFrame) -> DataFrame:
    """Set the listed codes to missing (at most two literals per feature)."""
    found: dict[str, list[float]] = {}
    for r in codes.collect():
        found.setdefault(r["feature"], []).append(r["code"])
    return df.withColumns({f: F.when(~col(f).isin(v), col(f)) for f, v in found.items()}) if found else df


def dependent_features(df: DataFrame, parent: str, candidates: Sequence[str], threshold: float = 0.95,
                       missing_is_zero: bool = True) -> DataFrame:
    """``feature, missing_share`` of candidates mostly missing where the parent is zero."""
    zero = f"coalesce({quoted(parent)} = 0, {'true' if missing_is_zero else 'false'})"
    facts = per_column(df, [c for c in candidates if c != parent], {
        "known": KNOWN, "missing_share": f"avg(CASE WHEN {zero} THEN CAST({{c}} IS NULL AS DOUBLE) END)"})
    return (facts.where((F.col("known") > 0) & (F.col("missing_share") > threshold))
            .select("feature", "missing_share"))


def suspicious_features(df: DataFrame, features: Sequence[str], label: str, threshold: float = 0.3,
                        wide_range: float = 1e6) -> DataFrame:
    """``feature, reason, amount``: strongly tied to the label, or spanning a huge range; complete columns only."""
    y = f"CAST({quoted(label)} AS DOUBLE)"
    facts = per_column(df, features, {
        "missing": MISSING, "low": LOW, "high": HIGH,
        "r": f"try_divide(covar_pop(CAST({{c}} AS DOUBLE), {y}), {STD} * stddev_pop({y}))"})
    span = F.col("high") - F.col("low")
    reason = (F.when(F.abs("r") > threshold, "High correlation")
              .when(span > wide_range, "Large range"))
    return (facts.where((F.col("missing") == 0) & (span > 0)).select(
        "feature", reason.alias("reason"),
        F.when(F.abs("r") > threshold, F.col("r")).otherwise(span).alias("amount"))
        .where(F.col("reason").isNotNull()))


def suspect_report(df: DataFrame, suspects: Sequence[str]) -> DataFrame:
    facts = per_column(df, suspects, {"mean": MEAN, "min": LOW, "max": HIGH})
    return facts.join(distinct_counts(df, suspects), "feature")
