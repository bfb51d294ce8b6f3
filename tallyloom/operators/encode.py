"""Encodings of categorical columns, learned from value counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import col, number, quoted
from .columns import value_counts
from .profile import short_features


def value_name(value: float) -> str:
    return str(int(value)) if float(value).is_integer() else str(value).replace(".", "_")


# --- plain one-hot: every distinct value of short columns -----------------------------------------------------------


def one_hot_all(df: DataFrame, features: Sequence[str], max_categories: int = 30, keep: Sequence[str] = ("id",)
                ) -> tuple[DataFrame, list[str]]:
    """One 0/1 column per distinct value; features with more values than the cap are skipped and returned."""
    short = short_features(df, features, max_categories)
    values: dict[str, list[float]] = {f: [] for f in features}
    if short:
        rows = (value_counts(df, short).where(F.col("value").isNotNull())
                .groupBy("feature").agg(F.sort_array(F.collect_list("value")).alias("values")))
        for r in rows.where(F.size("values") <= max_categories).collect():
            values[r["feature"]] = r["values"]
    filled = {f for f in features if values[f]}
    columns = [F.expr(f"CAST({quoted(f)} <=> {number(v)} AS DOUBLE) AS {quoted(f'{f}={value_name(v)}')}")
               for f in features for v in values[f]]
    empty = set()
    rest = [f for f in features if f not in filled]
    if rest:
        known = df.agg(*[F.count(col(f)).alias(str(i)) for i, f in enumerate(rest)]).first()
        empty = {f for f, n in zip(rest, known) if n == 0}
    return df.select(*keep, *columns), [f for f in rest if f not in empty]


# --- frequent values and the pooled rest ----------------------------------------------------------------------------


def frequent_values(counts: DataFrame, min_count: int, max_categories: int) -> DataFrame:
    """``feature, value, n, n_pos, place`` of the kept values, most frequent first, higher value first on ties.

    The place filter is a ranking limit: Spark keeps at most ``max_categories`` rows per feature and task before the
    exchange, so a long column does not pile up in one task.
    """
    order = Window.partitionBy("feature").orderBy(F.col("n").desc(), F.col("value").desc())
    return (counts.where(F.col("n") >= min_count)
            .withColumn("place", F.row_number().over(order)).where(F.col("place") <= max_categories))


def count_totals(counts: DataFrame) -> DataFrame:
    sums = [F.count(F.lit(1)).alias("values"), F.sum("n").alias("rows")]
    if "n_pos" in counts.columns:
        sums.append(F.sum("n_pos").alias("rows_pos"))
    return counts.groupBy("feature").agg(*sums)


def fit_one_hot(counts: DataFrame, min_count: int = 50, max_categories: int = 50) -> DataFrame:
    """``feature, place, value, other``; place 0 carries the flag alone for a feature that keeps no value."""
    kept = frequent_values(counts, min_count, max_categories)
    size = kept.groupBy("feature").agg(F.count(F.lit(1)).alias("kept"))
    flags = (count_totals(counts).join(size, "feature", "left")
             .select("feature", (F.coalesce("kept", F.lit(0)) < F.col("values")).alias("other"),
                     F.coalesce("kept", F.lit(0)).alias("kept")))
    return (flags.join(kept.select("feature", "value", "place"), "feature", "left")
            .select("feature", F.coalesce("place", F.lit(0)).alias("place"), "value", "other"))


@dataclass
class OneHotSpec:
    values: list[float] = field(default_factory=list)
    other: bool = False


def collect_one_hot(spec: DataFrame) -> dict[str, OneHotSpec]:
    out: dict[str, OneHotSpec] = {}
    for r in spec.orderBy("feature", "place").collect():
        s = out.setdefault(r["feature"], OneHotSpec(other=r["other"]))
        if r["value"] is not None:
            s.values.append(r["value"])
    return out


def one_hot_columns(feature: str, value: str, spec: OneHotSpec) -> list[Column]:
    """Kept values in order, then OTHER for every row that matches none of them (if the fit left values out).

    ``value`` is the SQL text of the (filled) feature.
    """
    out = [F.expr(f"CAST({value} <=> {number(v)} AS DOUBLE) AS {quoted(f'{feature}={value_name(v)}')}") for v in spec.values]
    if spec.other:
        kept = ", ".join(number(v) for v in spec.values)
        hit = f"coalesce({value} IN ({kept}), false)" if spec.values else "false"
        out.append(F.expr(f"CAST(NOT {hit} AS DOUBLE) AS {quoted(f'{feature}=OTHER')}"))
    return out


def apply_one_hot(df: DataFrame, features: Sequence[str], specs: Mapping[str, OneHotSpec],
                  keep: Sequence[str] = ("id",)) -> DataFrame:
    return df.select(*keep, *[c for f in features for c in one_hot_columns(f, quoted(f), specs[f])])


# --- target encoding ------------------------------------------------------------------------------------------------


def fit_target_encoding(counts: DataFrame, global_mean: float, min_count: int = 50, max_categories: int = 50,
                        smoothing: float = 1.0) -> DataFrame:
    """``feature, place, value, n, encoding, other_encoding, has_other`` for labels in {-1, 1}.

    Place 0 is the feature's own row: no value, the pooled encoding of what was left out, and the flag.
    """
    prior = F.lit(float(global_mean)) * F.lit(float(smoothing))

    def smoothed(n: Column, positives: Column) -> Column:
        return ((2 * positives - n) + prior) / (n + F.lit(float(smoothing)))

    kept = frequent_values(counts, min_count, max_categories)
    pooled = kept.groupBy("feature").agg(F.count(F.lit(1)).alias("kept"), F.sum("n").alias("kept_rows"),
                                         F.sum("n_pos").alias("kept_pos"))
    facts = count_totals(counts).join(pooled, "feature", "left").na.fill(0, ["kept", "kept_rows", "kept_pos"])
    rest, rest_pos = F.col("rows") - F.col("kept_rows"), F.col("rows_pos") - F.col("kept_pos")
    heads = facts.select(
        "feature", F.lit(0).alias("place"), F.lit(None).cast("double").alias("value"), rest.alias("n"),
        F.when(rest > 0, smoothed(rest, rest_pos)).otherwise(F.lit(float(global_mean))).alias("encoding"),
        (F.col("kept") < F.col("values")).alias("has_other"))
    values = kept.select("feature", "place", "value", "n", smoothed(F.col("n"), F.col("n_pos")).alias("encoding"),
                         F.lit(None).cast("boolean").alias("has_other"))
    return heads.unionByName(values)


@dataclass
class TargetSpec:
    encodings: dict[float, float] = field(default_factory=dict)
    other: float = 0.0
    has_other: bool = False


def collect_target_encoding(spec: DataFrame) -> dict[str, TargetSpec]:
    out: dict[str, TargetSpec] = {}
    for r in spec.orderBy("feature", "place").collect():
        s = out.setdefault(r["feature"], TargetSpec())
        if r["place"] == 0:
            s.other, s.has_other = r["encoding"], r["has_other"]
        else:
            s.encodings[r["value"]] = r["encoding"]
    return out


def target_encoded(value: str, spec: TargetSpec, global_mean: float) -> Column:
    """Encoding of a kept value, else the pooled one when the fit left values out, else the global mean."""
    fallback = number(spec.other if spec.has_other else global_mean)
    if not spec.encodings:
        return F.expr(fallback)
    table = ", ".join(f"{number(k)}, {number(v)}" for k, v in spec.encodings.items())
    return F.expr(f"coalesce(try_element_at(map({table}), {value}), {fallback})")


def apply_target_encoding(df: DataFrame, features: Sequence[str], specs: Mapping[str, TargetSpec], global_mean: float,
                          keep: Sequence[str] = ("id",)) -> DataFrame:
    return df.select(*keep, *[target_encoded(quoted(f), specs[f], global_mean).alias(f) for f in features])


def impute_counts(counts: DataFrame) -> DataFrame:
    """Value counts of the table as it looks once missing cells carry the feature's most frequent value."""
    rank = F.when(F.col("value").isNotNull(), F.struct("n", -F.col("value")))
    modes = counts.groupBy("feature").agg(F.coalesce(F.max_by("value", rank), F.lit(0.0)).alias("mode"))
    sums = [F.sum(c).alias(c) for c in ("n", "n_pos") if c in counts.columns]
    return (counts.join(modes, "feature")
            .groupBy("feature", F.coalesce("value", "mode").alias("value")).agg(*sums))


def cross_fit_counts(df: DataFrame, features: Sequence[str], fold: str, label: str = "y") -> DataFrame:
    """Value counts of the rows outside each fold, ``<fold>#<feature>`` as the feature: one pass, then small tables only."""
    keyed = df.select(F.col(fold).cast("string").alias("_fold"), (F.col(label) == 1).cast("int").alias("_pos"),
                      *[F.col(f"`{f}`").cast("double").alias(f) for f in features])
    own = (keyed.unpivot(["_fold", "_pos"], list(features), "feature", "value").groupBy("_fold", "feature", "value")
           .agg(F.count(F.lit(1)).alias("n"), F.sum("_pos").alias("n_pos")))
    folds = sorted(r["_fold"] for r in df.select(F.col(fold).cast("string").alias("_fold")).distinct().collect())
    # Every fold's counts are the totals less its own: its rows enter with a minus sign, all rows once per fold.
    others = own.select(F.explode(F.array(*[F.lit(f) for f in folds])).alias("left_out"), "_fold", "feature", "value", "n", "n_pos")
    return (others.where("left_out <> _fold").groupBy(F.concat_ws("#", "left_out", "feature").alias("feature"), "value")
            .agg(F.sum("n").alias("n"), F.sum("n_pos").alias("n_pos")))


def cross_fit_target_encoding(df: DataFrame, features: Sequence[str], fold: str, global_mean: float, min_count: int = 50,
                              max_categories: int = 50, smoothing: float = 1.0, label: str = "y", keep: Sequence[str] = ("id",)) -> DataFrame:
    """Target encodings of each row from the rows of the other folds only, so that no row's label is in its own features.

    ``fold`` names a column with a few fold numbers (``assign_folds``); the prior is the mean of all training labels.
    """
    counts = cross_fit_counts(df, features, fold, label)
    specs = collect_target_encoding(fit_target_encoding(counts, global_mean, min_count, max_categories, smoothing))
    folds = sorted({name.split("#", 1)[0] for name in specs})
    out = []
    for f in features:
        encoded = F.lit(float(global_mean))
        for k in folds:
            spec = specs.get(f"{k}#{f}", TargetSpec())
            encoded = F.when(F.col(fold).cast("string") == k, target_encoded(quoted(f), spec, global_mean)).otherwise(encoded)
        out.append(encoded.alias(f))
    return df.select(*keep, *out)
