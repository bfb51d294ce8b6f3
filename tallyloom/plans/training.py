"""Cross-validation, grid search and the final fit.

For the logistic family every (parameter combination, fold) pair is one column of the shared weight matrix: a whole
grid with all its folds costs one pass over the data per step. Thresholds need no fit of their own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, fields, replace
from itertools import product

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import col, label_01, linear_score, quoted, sigmoid, signed_label
from ..operators.folds import assign_folds
from ..operators.gradient import Fit, fit_models
from ..operators.linear import logistic_family
from ..operators.metrics import METRICS, areas, curve_points, figures, threshold_counts
from ..operators.tree import Forest, TreeModel, TreeOptions, class_vote, fit_forest, fit_forests, held_out_scores, probability, training_errors

FOREST = "random_forest"
CV_COLUMNS = (*METRICS, "loss_mean", "loss_std", "roc_auc", "pr_auc")


@dataclass(frozen=True)
class Settings:
    """Hyper-parameters of one candidate; every one of them is used where it applies."""

    model: str = "reg_logistic"
    gamma: float = 0.1
    lambda_: float = 1e-3
    threshold: float = 0.5
    max_iters: int = 1000
    class_weight_0: float = 1.0
    class_weight_1: float = 1.0
    early_stopping: bool = True
    patience: int = 10
    tolerance: float = 1e-6
    n_estimators: int = 100
    max_depth: int = 10
    min_samples_split: int = 20
    min_samples_leaf: int = 10
    max_features: str | int = "sqrt"
    categorical: tuple[str, ...] = ()
    seed: int = 1

    def fit_part(self) -> Settings:
        """The settings that decide the fit, so that candidates differing in the threshold alone share one."""
        return replace(self, threshold=0.5)

    def logistic(self, held_out: int = -1):
        return logistic_family(self.model, self.gamma, self.lambda_, self.max_iters,
                               (self.class_weight_0, self.class_weight_1), self.early_stopping, self.patience,
                               self.tolerance, held_out)

    def forest_settings(self, held_out: int = -1) -> Forest:
        return Forest(self.n_estimators, self.max_features, TreeOptions(self.max_depth, self.min_samples_split, self.min_samples_leaf), self.seed, held_out)

    def forest(self, df: DataFrame, features: Sequence[str], y01: str, key: str = "id") -> TreeModel:
        options = TreeOptions(self.max_depth, self.min_samples_split, self.min_samples_leaf)
        return fit_forest(df, features, y01, self.n_estimators, self.max_features, options, self.categorical, self.seed, key)


LOGISTIC_AXES = ("gamma", "lambda_", "threshold", "max_iters")
WEIGHT_AXES = ("class_weight_0", "class_weight_1")
FOREST_AXES = ("n_estimators", "max_depth", "min_samples_split", "min_samples_leaf", "max_features")


def param_grid(base: Settings, axes: Mapping[str, Sequence]) -> list[Settings]:
    """All combinations, first axis slowest; an axis that is not given keeps the base value."""
    names = FOREST_AXES if base.model == FOREST else (
        LOGISTIC_AXES + (WEIGHT_AXES if base.model.endswith("_weighted") else ()))
    unknown = set(axes) - {f.name for f in fields(Settings)}
    if unknown:
        raise ValueError(f"unknown settings: {sorted(unknown)}")
    values = [axes.get(n) or [getattr(base, n)] for n in names]
    return [replace(base, **dict(zip(names, combo))) for combo in product(*values)]


@dataclass
class CrossValidation:
    """Per-candidate means over the folds, and the per-fold figures behind them."""

    candidates: list[Settings]
    per_fold: list[dict] = field(default_factory=list)
    folds: int = 5

    def aggregate(self) -> list[dict]:
        out = []
        for c in range(len(self.candidates)):
            mine = [r for r in self.per_fold if r["candidate"] == c]
            row = {m: float(np.mean([r[m] for r in mine])) for m in (*METRICS, "roc_auc", "pr_auc")}
            losses = [r["loss"] for r in mine]
            out.append({"candidate": c, **row, "loss_mean": float(np.mean(losses)), "loss_std": float(np.std(losses))})
        return out

    def best(self, metric: str = "f1") -> int:
        """First candidate with the highest mean metric."""
        return max(self.aggregate(), key=lambda r: (r[metric], -r["candidate"]))["candidate"]

    def per_fold_frame(self, spark: SparkSession) -> DataFrame:
        names = ("candidate", "fold", *METRICS, "loss", "roc_auc", "pr_auc")
        kinds = {"candidate": "int", "fold": "int", "tp": "bigint", "fp": "bigint", "fn": "bigint", "tn": "bigint"}
        schema = ", ".join(f"{n} {kinds.get(n, 'double')}" for n in names)
        return spark.createDataFrame([tuple(r[n] for n in names) for r in self.per_fold], schema)

    def aggregate_frame(self, spark: SparkSession) -> DataFrame:
        names = ("candidate", "model", "gamma", "lambda_", "threshold", "max_iters", *CV_COLUMNS)
        schema = ("candidate int, model string, gamma double, lambda_ double, threshold double, max_iters int, "
                  + ", ".join(f"{n} double" for n in CV_COLUMNS))
        rows = [(r["candidate"], *[getattr(self.candidates[r["candidate"]], n) for n in names[1:6]],
                 *[r[n] for n in CV_COLUMNS]) for r in self.aggregate()]
        return spark.createDataFrame(rows, schema)


def _fold_scores(folded: DataFrame, features: Sequence[str], weights: list[tuple[int, int, list[float]]]) -> DataFrame:
    """Every row scored by each fit that did not see it: ``fit, fold, y, score``.

    The weight table has one row per fit and fold, so it is broadcast.
    """
    table = folded.sparkSession.createDataFrame(weights, "fit int, fold int, w array<double>")
    z = F.expr(" + ".join(f"{quoted(f)} * w[{i}]" for i, f in enumerate(features)))
    return folded.join(F.broadcast(table), "fold").select("fit", "fold", "y", sigmoid(z).alias("score"))


#: Metrics that need a curve; all others follow from counts at the thresholds.
AREAS = ("roc_auc", "pr_auc")


def _evaluate(scored: DataFrame, candidates: Sequence[Settings], fit_of: Sequence[int]) -> list[dict]:
    """Figures per candidate and fold from every fit's counts at every threshold; the areas are left open (NaN)."""
    thresholds = sorted({c.threshold for c in candidates})
    found = sorted(threshold_counts(scored, thresholds, ["fit", "fold"]).collect(), key=lambda r: (r["fit"], r["fold"]))
    out = []
    for c, settings in enumerate(candidates):
        t = thresholds.index(settings.threshold)
        for r in found:
            if r["fit"] == fit_of[c]:
                tp, fp = r[f"tp{t}"], r[f"fp{t}"]
                out.append({"candidate": c, "fold": r["fold"], **figures(tp, fp, r["pos"] - tp, r["neg"] - fp),
                            **{a: float("nan") for a in AREAS}})
    return out


def cross_validate(df: DataFrame, features: Sequence[str], candidates: Sequence[Settings], k: int = 5, seed: int = 1,
                   label: str = "y", key: str = "id", copies: str | None = None, curves: str = "all", metric: str = "f1") -> CrossValidation:
    """Stratified k-fold figures of every candidate.

    All candidates and folds are fitted together: the logistic family in one descent, forests in one level-wise job whose
    trees each see their own rows. With ``copies`` (the column an oversampled table carries) folds follow the original
    row, so no copy of a held-out row is trained on, and only original rows are scored.

    Counts at the thresholds are plain aggregates. Areas under curves, for which scores are sorted, are computed for all
    candidates (``curves="all"``), for the one with the best ``metric`` (``"best"``) or for none (``"none"``); other areas are NaN.
    """
    if curves not in ("all", "best", "none"):
        raise ValueError(f"unknown choice of curves: {curves!r}")
    spark = df.sparkSession
    narrow = df.select(key, F.col(label).alias("y"), *([copies] if copies else []), *[col(f) for f in features])
    if copies:
        folds = assign_folds(narrow.where(F.col(copies) == 0).select(key, "y"), k, seed, "y", key).select(key, "fold")
        folded = narrow.join(folds, key)
    else:
        folded = assign_folds(narrow, k, seed, "y", key)
    folded = folded.withColumn("y01", label_01(F.col("y"))).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        held = folded.where(F.col(copies) == 0) if copies else folded
        distinct = list(dict.fromkeys(c.fit_part() for c in candidates))
        fit_of = [distinct.index(c.fit_part()) for c in candidates]
        losses: dict[tuple[int, int], float] = {}
        if all(c.model != FOREST for c in candidates):
            models = [c.logistic(fold) for c in distinct for fold in range(k)]
            fits = fit_models(folded, features, "y01", models, "fold")
            weights = []
            for i, fit in enumerate(fits):
                losses[divmod(i, k)] = fit.loss if distinct[i // k].early_stopping else fit.weighted_loss
                weights.append((i // k, i % k, [float(w) for w in fit.weights]))
            scored = _fold_scores(held, features, weights)
        elif all(c.model == FOREST for c in candidates):
            forests: dict[tuple[int, int], TreeModel] = {}
            for categorical in dict.fromkeys(c.categorical for c in distinct):
                places = [(i, fold) for i, c in enumerate(distinct) if c.categorical == categorical for fold in range(k)]
                grown = fit_forests(folded, features, "y01", [distinct[i].forest_settings(fold) for i, fold in places], categorical, key, "fold")
                forests.update(zip(places, grown))
            losses = training_errors(folded, forests, "y01")
            scored = held_out_scores(held, forests)
        else:
            raise ValueError("forests and linear models need separate runs")
        result = CrossValidation(list(candidates), _evaluate(scored, candidates, fit_of), k)
        for r in result.per_fold:
            r["loss"] = float(losses[(fit_of[r["candidate"]], r["fold"])])
        wanted = {"all": range(len(candidates)), "best": [result.best(metric)] if curves == "best" else [], "none": []}[curves]
        if wanted:
            some = scored if curves == "all" else scored.where(F.col("fit").isin([fit_of[c] for c in wanted]))
            found = {(r["fit"], r["fold"]): r for r in areas(curve_points(some, group=["fit", "fold"]), ["fit", "fold"]).collect()}
            for r in result.per_fold:
                if r["candidate"] in wanted:
                    r.update({a: found[(fit_of[r["candidate"]], r["fold"])][a] for a in AREAS})
        return result
    finally:
        folded.unpersist()


@dataclass
class FinalModel:
    settings: Settings
    features: list[str]
    fit: Fit | None = None
    forest: TreeModel | None = None
    loss: float = 0.0

    def score(self) -> Column:
        if self.forest is not None:
            return probability(self.forest)
        return sigmoid(linear_score(dict(zip(self.features, self.fit.weights))))

    def predict(self, df: DataFrame, keep: Sequence[str] = ("id",)) -> DataFrame:
        """``score`` and ``y_hat`` in {-1, 1} next to the kept columns."""
        scored = df.select(*keep, self.score().alias("score"))
        return scored.withColumn("y_hat", signed_label(F.col("score"), self.settings.threshold))


def train(df: DataFrame, features: Sequence[str], settings: Settings, label: str = "y", key: str = "id") -> FinalModel:
    """Fit one candidate on all rows; the loss of a forest is its misclassification rate."""
    ready = df.select(key, label_01(F.col(label)).alias("y01"), *[col(f) for f in features])
    if settings.model == FOREST:
        forest = settings.forest(ready, features, "y01", key)
        wrong = (class_vote(probability(forest)) != F.col("y01")).cast("double")
        return FinalModel(settings, list(features), forest=forest, loss=ready.agg(F.avg(wrong)).first()[0])
    fit = fit_models(ready, features, "y01", [settings.logistic()])[0]
    loss = fit.loss if settings.early_stopping or not settings.model.endswith("_weighted") else fit.weighted_loss
    return FinalModel(settings, list(features), fit=fit, loss=loss)


def search_and_train(df: DataFrame, features: Sequence[str], base: Settings, axes: Mapping[str, Sequence] | None = None,
                     metric: str = "f1", k: int = 5, seed: int = 1, final_max_iters: int | None = None,
                     label: str = "y", key: str = "id", copies: str | None = None) -> tuple[FinalModel, CrossValidation]:
    """Search the grid (if any), then refit the winner on all rows; only a search may replace the iteration count."""
    candidates = param_grid(base, axes) if axes else [base]
    cv = cross_validate(df, features, candidates, k, seed, label, key, copies, "all" if metric in AREAS else "best", metric)
    chosen = candidates[cv.best(metric)]
    if axes and final_max_iters:
        chosen = replace(chosen, max_iters=final_max_iters)
    return train(df, features, chosen, label, key), cv


def run_summary(df: DataFrame, model: FinalModel, cv: CrossValidation, metric: str = "f1", label: str = "y") -> DataFrame:
    """``section, item, number, value``: every setting (as text, too), the search, mean and per-fold figures, training loss and areas."""
    spark, winner = df.sparkSession, cv.best(metric)
    chosen = {f.name: getattr(model.settings, f.name) for f in fields(Settings)}
    rows = [("settings", n, float(v) if isinstance(v, (int, float)) else None, ",".join(v) if isinstance(v, tuple) else str(v)) for n, v in chosen.items()]
    rows += [("search", "metric", None, metric), ("search", "candidates", float(len(cv.aggregate())), None),
             ("search", "winner", float(winner), None), ("search", "best", float(cv.aggregate()[winner][metric]), None)]
    best = cv.aggregate()[winner]
    rows += [("cross_validation", n, float(best[n]), None) for n in CV_COLUMNS]
    rows += [(f"fold_{r['fold']}", n, float(r[n]), None) for r in cv.per_fold if r["candidate"] == winner
             for n in (*METRICS, "loss", "roc_auc", "pr_auc")]
    rows.append(("train", "loss", float(model.loss), None))
    facts = spark.createDataFrame(rows, "section string, item string, number double, value string")
    scored = df.select(F.col(label).alias("y"), model.score().alias("score"))
    found = areas(curve_points(scored))
    for item in ("roc_auc", "pr_auc"):
        facts = facts.unionByName(found.select(F.lit("train").alias("section"), F.lit(item).alias("item"),
                                               F.col(item).alias("number"), F.lit(None).cast("string").alias("value")))
    return facts
