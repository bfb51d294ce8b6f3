"""Labels, metrics, curves, folds, cross-validation, grid search and final predictions."""

from __future__ import annotations

from dataclasses import fields

from pyspark.sql import functions as F

from ..functions import scalar
from ..operators import metrics
from ..operators.folds import assign_folds
from ..operators.gradient import Model
from ..plans import training
from ..plans.training import Settings
from .base import MODEL_FEATURES, f_model, f_orders, model_sql, orders_sql, query, rounded, sigmoid_sql
from .models import TREE_CATEGORIES, TREE_FEATURES, TREE_SOURCE, WEIGHTS, Z, f_tree
from .sqlgen import curve_sql, descent_sql, dot, fold_sql, forest_sql, metrics_sql

MODEL = f"WITH base AS ({model_sql()}) "


@query("label_01", f"SELECT id, CAST((y + 1) / 2 AS DOUBLE) AS y01 FROM ({orders_sql(False)})")
def label_01(spark, sf):
    return f_orders(spark, sf, False).select("id", scalar.label_01(F.col("y")).alias("y01"))


@query("threshold_labels", MODEL + f"SELECT id, CASE WHEN {sigmoid_sql(Z)} >= 0.3 THEN 1 ELSE -1 END AS y_hat FROM base")
def threshold_labels(spark, sf):
    score = scalar.sigmoid(scalar.linear_score(WEIGHTS))
    return f_model(spark, sf).select("id", scalar.signed_label(score, 0.3).alias("y_hat"))


@query("predict_scores", MODEL + f"SELECT id, y, round({sigmoid_sql(Z)}, 6) AS score, CASE WHEN {sigmoid_sql(Z)} >= 0.5 THEN 1 ELSE -1 END AS y_hat FROM base")
def predict_scores(spark, sf):
    from ..operators.gradient import Fit
    import numpy as np
    model = training.FinalModel(Settings(), MODEL_FEATURES, Fit(np.array([WEIGHTS[f] for f in MODEL_FEATURES]), 0.0, 0.0, 0))
    return rounded(model.predict(f_model(spark, sf), ("id", "y")))


@query("class_weights", f"SELECT y, CASE WHEN y = 1 THEN CAST(2.5 AS DOUBLE) ELSE 1 END AS weight, count(*) AS n, "
       f"sum(CASE WHEN y = 1 THEN CAST(2.5 AS DOUBLE) ELSE 1 END) AS total FROM ({orders_sql(False)}) GROUP BY y")
def class_weights(spark, sf):
    weighted = f_orders(spark, sf, False).select("y", scalar.class_weight(F.col("y"), {1: 2.5}).alias("weight"))
    return weighted.groupBy("y", "weight").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("total"))


SCORED = MODEL + f", scored AS (SELECT id, y, {sigmoid_sql(Z)} AS score FROM base) "
# Scores that tie heavily: five steps of a tenth.
TIED = MODEL + f", scored AS (SELECT id, y, floor({sigmoid_sql(Z)} * 20) / 20 AS score FROM base) "


def scored(spark, sf, tied: bool = False):
    score = scalar.sigmoid(scalar.linear_score(WEIGHTS))
    score = F.floor(score * 20) / 20 if tied else score
    return f_model(spark, sf).select("id", "y", score.alias("score"))


@query("classification_metrics", SCORED + ", p AS (SELECT y, CASE WHEN score >= 0.3 THEN 1 ELSE -1 END AS y_hat FROM scored) SELECT tp, fp, fn, tn, "
       "round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, round(accuracy, 6) AS accuracy FROM ("
       + metrics_sql("p") + ")")
def classification_metrics(spark, sf):
    labelled = scored(spark, sf).withColumn("y_hat", scalar.signed_label(F.col("score"), 0.3))
    return rounded(metrics.classification_metrics(labelled))


@query("roc_auc", SCORED + "," + curve_sql("scored") + "SELECT round(roc_auc, 6) AS roc_auc FROM area")
def roc_auc(spark, sf):
    return rounded(metrics.areas(metrics.curve_points(scored(spark, sf))).select("roc_auc"))


@query("pr_auc", SCORED + "," + curve_sql("scored") + "SELECT round(pr_auc, 6) AS pr_auc FROM area")
def pr_auc(spark, sf):
    return rounded(metrics.areas(metrics.curve_points(scored(spark, sf))).select("pr_auc"))


@query("auc_with_ties", TIED + "," + curve_sql("scored") + "SELECT round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc FROM area")
def auc_with_ties(spark, sf):
    return rounded(metrics.areas(metrics.curve_points(scored(spark, sf, True))))


@query("roc_points", TIED + "," + curve_sql("scored") + "SELECT round(score, 6) AS score, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr FROM points")
def roc_points(spark, sf):
    return rounded(metrics.curve_points(scored(spark, sf, True)).select("score", "fpr", "tpr"))


@query("pr_points", SCORED + "," + curve_sql("scored") + "SELECT round(score, 6) AS score, round(tpr, 6) AS recall, round(prec, 6) AS precision FROM points")
def pr_points(spark, sf):
    points = metrics.curve_points(scored(spark, sf))
    return rounded(points.select("score", F.col("tpr").alias("recall"), "precision"))


@query("kfold_stratified", "SELECT id, y, fold FROM (" + fold_sql(f"SELECT id, y FROM ({orders_sql(False)})", 5, 1) + ")")
def kfold_stratified(spark, sf):
    return assign_folds(f_orders(spark, sf, False).select("id", "y"), 5, 1)


@query("kfold_plain", "SELECT id, y, fold FROM (" + fold_sql(f"SELECT id, y FROM ({orders_sql(False)})", 7, 2, None) + ")")
def kfold_plain(spark, sf):
    return assign_folds(f_orders(spark, sf, False).select("id", "y"), 7, 2, None)


# --- cross-validation and search -------------------------------------------------------------------------------------

K, STEPS = 3, 8
BASE_SETTINGS = Settings("reg_logistic_weighted", gamma=0.5, lambda_=0.001, threshold=0.45, max_iters=STEPS, class_weight_1=3.0)
AXES = {"gamma": [0.2, 0.8], "threshold": [0.4, 0.45, 0.5], "class_weight_1": [2.0, 4.0]}


def _cv_sql(candidates: list[Settings], select: str, source: str | None = None) -> str:
    """Fit every distinct candidate and fold step by step, score the held-out rows, and build ``per_fold``."""
    distinct = list(dict.fromkeys(c.fit_part() for c in candidates))
    models = [c.logistic(f) for c in distinct for f in range(K)]
    data = fold_sql(source or model_sql(), K, 1)
    z = dot([f"b.{f}" for f in MODEL_FEATURES], [f"s.w{i}" for i in range(len(MODEL_FEATURES))])
    tried = ", ".join(f"({i}, {distinct.index(c.fit_part())}, CAST({c.threshold} AS DOUBLE))" for i, c in enumerate(candidates))
    return ("WITH " + descent_sql(data, MODEL_FEATURES, "y01", models, STEPS, "fold") + ", "
            f"scored AS (SELECT s.m // {K} AS fit, s.m % {K} AS fold, y, {sigmoid_sql(z)} AS score FROM final s JOIN data b ON b.fold_no = s.held), "
            + curve_sql("scored", ("fit", "fold")) + f", tried AS (SELECT * FROM (VALUES {tried}) t(candidate, fit, threshold)), "
            "labelled AS (SELECT candidate, fit, fold, y, CASE WHEN score >= threshold THEN 1 ELSE -1 END AS y_hat FROM scored JOIN tried USING (fit)), "
            "per_fold AS (SELECT p.*, f.loss, a.roc_auc, a.pr_auc FROM (" + metrics_sql("labelled", ("candidate", "fit", "fold")) + ") p "
            f"JOIN final f ON f.m = p.fit * {K} + p.fold JOIN area a ON a.fit = p.fit AND a.fold = p.fold) " + select)


FIGURES = ("precision", "recall", "f1", "accuracy", "roc_auc", "pr_auc")


@query("cross_validate", _cv_sql([BASE_SETTINGS], "SELECT fold, tp, fp, fn, tn, round(loss, 6) AS loss, "
                                 + ", ".join(f"round({c}, 6) AS {c}" for c in FIGURES) + " FROM per_fold"))
def cross_validate(spark, sf):
    cv = training.cross_validate(f_model(spark, sf), MODEL_FEATURES, [BASE_SETTINGS], K)
    return rounded(cv.per_fold_frame(spark).select("fold", "tp", "fp", "fn", "tn", "loss", *FIGURES))


MEANS = ", ".join(f"round(avg({c}), 6) AS {c}" for c in ("tp", "fp", "fn", "tn", *FIGURES))


@query("cv_aggregate", _cv_sql([BASE_SETTINGS], f"SELECT round(avg(loss), 6) AS loss_mean, round(stddev_pop(loss), 6) AS loss_std, {MEANS} FROM per_fold"))
def cv_aggregate(spark, sf):
    cv = training.cross_validate(f_model(spark, sf), MODEL_FEATURES, [BASE_SETTINGS], K)
    return rounded(cv.aggregate_frame(spark).select("loss_mean", "loss_std", "tp", "fp", "fn", "tn", *FIGURES))


GRID = training.param_grid(BASE_SETTINGS, AXES)


@query("param_grid", _cv_sql(GRID, "SELECT candidate, round(avg(f1), 6) AS f1, round(avg(roc_auc), 6) AS roc_auc, "
                             "round(avg(loss), 6) AS loss_mean FROM per_fold GROUP BY candidate"))
def param_grid(spark, sf):
    cv = training.cross_validate(f_model(spark, sf), MODEL_FEATURES, GRID, K)
    return rounded(cv.aggregate_frame(spark).select("candidate", "f1", "roc_auc", "loss_mean"))


_GRID_ROWS = ", ".join(f"({i}, CAST({g.gamma} AS DOUBLE), CAST({g.threshold} AS DOUBLE), CAST({g.class_weight_1} AS DOUBLE))" for i, g in enumerate(GRID))


@query("grid_best", _cv_sql(GRID, f"SELECT gamma, threshold, class_weight_1, round(f1, 6) AS f1 FROM (SELECT candidate, avg(f1) AS f1 FROM per_fold "
                            f"GROUP BY candidate) JOIN (VALUES {_GRID_ROWS}) g(candidate, gamma, threshold, class_weight_1) USING (candidate) "
                            "ORDER BY f1 DESC, candidate LIMIT 1"))
def grid_best(spark, sf):
    cv = training.cross_validate(f_model(spark, sf), MODEL_FEATURES, GRID, K, curves="none")
    best = cv.best("f1")
    s = cv.candidates[best]
    row = (s.gamma, s.threshold, s.class_weight_1, cv.aggregate()[best]["f1"])
    return rounded(spark.createDataFrame([row], "gamma double, threshold double, class_weight_1 double, f1 double"))


FOREST_SETTINGS = Settings("random_forest", n_estimators=3, max_depth=2, max_features=3, categorical=tuple(TREE_CATEGORIES), seed=5)


def _forest_cv_sql() -> str:
    """Each fold's forest grown without the fold's rows, which it then scores: all figures of the held-out rows."""
    from ..operators.tree import TreeOptions, feature_subset
    subsets = {t: feature_subset(len(TREE_FEATURES), 3, 5, t) for t in range(3)}
    data = fold_sql(TREE_SOURCE, 2, 1)
    votes = []
    for fold in range(2):
        grown = forest_sql(data, TREE_FEATURES, subsets, TreeOptions(2, 20, 10), TREE_CATEGORIES, 5, held_out=f"fold = {fold}")
        votes.append(f"SELECT {fold} AS fold, id, y01, p FROM (WITH {grown} SELECT id, y01, avg(vote) AS p FROM leaf_rows GROUP BY id, y01)")
    return ("WITH votes AS (" + " UNION ALL ".join(votes) + f"), folds AS (SELECT id, y, fold FROM ({data})), "
            "scored AS (SELECT v.fold, y, p AS score FROM votes v JOIN folds f ON f.id = v.id AND f.fold = v.fold), "
            "wrong AS (SELECT v.fold, avg(CASE WHEN (CASE WHEN p > 0.5 THEN 1 ELSE 0 END) <> y01 THEN 1 ELSE 0 END) AS loss "
            "FROM votes v JOIN folds f ON f.id = v.id AND f.fold <> v.fold GROUP BY v.fold), " + curve_sql("scored", ("fold",))
            + f", labelled AS (SELECT fold, y, CASE WHEN score >= {FOREST_SETTINGS.threshold} THEN 1 ELSE -1 END AS y_hat FROM scored) "
            "SELECT fold, tp, fp, fn, tn, round(loss, 6) AS loss, " + ", ".join(f"round({c}, 6) AS {c}" for c in FIGURES)
            + " FROM (" + metrics_sql("labelled", ("fold",)) + ") JOIN wrong USING (fold) JOIN area USING (fold)")


@query("forest_cross_validate", _forest_cv_sql())
def forest_cross_validate(spark, sf):
    cv = training.cross_validate(f_tree(spark, sf), TREE_FEATURES, [FOREST_SETTINGS], 2)
    return rounded(cv.per_fold_frame(spark).select("fold", "tp", "fp", "fn", "tn", "loss", *FIGURES))


# --- final fit -------------------------------------------------------------------------------------------------------

FINAL = Settings("reg_logistic", gamma=0.5, lambda_=0.001, threshold=0.2, max_iters=10)
_FINAL_MODEL = Model(gamma=0.5, penalty=0.001, max_iters=10, patience=0)


@query("final_predictions", "WITH " + descent_sql(f"SELECT * FROM ({model_sql()}) WHERE id % 5 <> 0", MODEL_FEATURES, "y01", [_FINAL_MODEL], 10)
       + f", test AS (SELECT id, {sigmoid_sql(dot([f'b.{f}' for f in MODEL_FEATURES], [f's.w{i}' for i in range(len(MODEL_FEATURES))]))} AS score "
         f"FROM ({model_sql()}) b, s10 s WHERE id % 5 = 0) SELECT id, round(score, 6) AS score, CASE WHEN score >= 0.2 THEN 1 ELSE -1 END AS y_hat FROM test")
def final_predictions(spark, sf):
    df = f_model(spark, sf)
    model = training.train(df.where("id % 5 <> 0"), MODEL_FEATURES, FINAL)
    return rounded(model.predict(df.where("id % 5 = 0")))


SEARCH_AXES = {"gamma": [0.2, 0.8]}


def _searched_sql() -> str:
    """The search on the training rows, the winner's refit over twelve steps, and its scores of the test rows."""
    train = f"SELECT * FROM ({model_sql()}) WHERE id % 5 <> 0"
    candidates = training.param_grid(BASE_SETTINGS, SEARCH_AXES)
    best = _cv_sql(candidates, "SELECT candidate, avg(f1) AS f1 FROM per_fold GROUP BY candidate ORDER BY f1 DESC, candidate LIMIT 1", train)
    z = dot([f"b.{f}" for f in MODEL_FEATURES], [f"s.w{i}" for i in range(len(MODEL_FEATURES))])
    return ("WITH " + descent_sql(train, MODEL_FEATURES, "y01", [c.logistic() for c in candidates], 12)
            + f", best AS (SELECT candidate FROM ({best})), test AS (SELECT id, {sigmoid_sql(z)} AS score FROM ({model_sql()}) b, s12 s "
            "JOIN best ON s.m = best.candidate WHERE id % 5 = 0) SELECT id, round(score, 6) AS score, "
            f"CASE WHEN score >= {BASE_SETTINGS.threshold} THEN 1 ELSE -1 END AS y_hat FROM test")


@query("searched_predictions", _searched_sql())
def searched_predictions(spark, sf):
    df = f_model(spark, sf)
    model, _ = training.search_and_train(df.where("id % 5 <> 0"), MODEL_FEATURES, BASE_SETTINGS, SEARCH_AXES, k=K,
                                         final_max_iters=12)
    return rounded(model.predict(df.where("id % 5 = 0")))


SUMMARY_AXES = {"gamma": [0.2, 0.8], "threshold": [0.4, 0.45]}


def _summary_sql() -> str:
    """The search, its winner's settings and figures per fold, and the refit's loss and areas, as one long table."""
    candidates = training.param_grid(BASE_SETTINGS, SUMMARY_AXES)
    said = []
    for c, s in enumerate(candidates):
        for f in fields(Settings):
            v = getattr(s, f.name)
            number = f"CAST({float(v)} AS DOUBLE)" if isinstance(v, (int, float)) else "CAST(NULL AS DOUBLE)"
            said.append(f"({c}, '{f.name}', {number}, '{','.join(v) if isinstance(v, tuple) else v}')")
    means = ", ".join(f"avg({c}) AS {c}" for c in ("tp", "fp", "fn", "tn", *FIGURES))
    z = dot([f"b.{f}" for f in MODEL_FEATURES], [f"s.w{i}" for i in range(len(MODEL_FEATURES))])
    refit = ("WITH " + descent_sql(model_sql(), MODEL_FEATURES, "y01", [c.logistic() for c in candidates], STEPS)
             + f", scored AS (SELECT s.m, y, {sigmoid_sql(z)} AS score FROM final s, data b), " + curve_sql("scored", ("m",))
             + " SELECT f.m AS candidate, loss, roc_auc, pr_auc FROM final f JOIN area a ON a.m = f.m")

    def long(section: str, source: str, items) -> str:
        casts = ", ".join(f"CAST({i} AS DOUBLE) AS {i}" for i in items)
        return (f"SELECT {section} AS section, item, round(number, 6) AS number, CAST(NULL AS VARCHAR) AS value FROM "
                f"(UNPIVOT (SELECT {casts}{', fold' if 'fold' in section else ''} FROM {source}) ON {', '.join(items)} INTO NAME item VALUE number)")

    return (f"WITH per AS MATERIALIZED ({_cv_sql(candidates, 'SELECT * FROM per_fold')}), refit AS ({refit}), "
            f"means AS (SELECT candidate, {means}, avg(loss) AS loss_mean, stddev_pop(loss) AS loss_std FROM per GROUP BY candidate), "
            "best AS (SELECT * FROM means ORDER BY f1 DESC, candidate LIMIT 1), "
            f"said AS (SELECT * FROM (VALUES {', '.join(said)}) t(candidate, item, number, value)) "
            "SELECT 'settings' AS section, item, round(number, 6) AS number, value FROM said JOIN best USING (candidate) "
            "UNION ALL SELECT 'search', 'metric', NULL, 'f1' "
            f"UNION ALL SELECT 'search', 'candidates', CAST({len(candidates)} AS DOUBLE), NULL "
            "UNION ALL SELECT 'search', 'winner', CAST(candidate AS DOUBLE), NULL FROM best UNION ALL SELECT 'search', 'best', round(f1, 6), NULL FROM best UNION ALL "
            + long("'cross_validation'", "best", training.CV_COLUMNS) + " UNION ALL "
            + long("'fold_' || fold", "(SELECT per.* FROM per JOIN best USING (candidate))", (*training.METRICS, "loss", "roc_auc", "pr_auc")) + " UNION ALL "
            + long("'train'", "(SELECT refit.* FROM refit JOIN best USING (candidate))", ("loss", "roc_auc", "pr_auc")))


@query("run_summary", _summary_sql())
def run_summary(spark, sf):
    df = f_model(spark, sf)
    model, cv = training.search_and_train(df, MODEL_FEATURES, BASE_SETTINGS, SUMMARY_AXES, k=K)
    return rounded(training.run_summary(df, model, cv))
