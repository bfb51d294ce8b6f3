"""Metrics, curves, folds, cross-validation and search."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import balance, metrics
from tallyloom.operators.folds import assign_folds
from tallyloom.plans import training
from tallyloom.plans.training import Settings
from tallyloom.sources import sinks

from conftest import frame


def brute_areas(score, y):
    """Trapezoid areas over groups of equal scores, starting at recall and false-positive rate zero."""
    p, q = max(1, (y == 1).sum()), max(1, (y != 1).sum())
    tpr, fpr, prec = [0.0], [0.0], []
    for s in sorted(set(score), reverse=True):
        top = score >= s
        tp, fp = (y[top] == 1).sum(), (y[top] != 1).sum()
        tpr.append(tp / p)
        fpr.append(fp / q)
        prec.append(tp / (tp + fp))
    prec = [prec[0], *prec]
    return np.trapezoid(tpr, fpr), np.trapezoid(prec, tpr)


@pytest.mark.parametrize("tied", [False, True])
@pytest.mark.parametrize("rows_per_bucket", [10**6, 20])
def test_areas_match_brute_force_and_ignore_row_order(spark, tied, rows_per_bucket):
    rng = np.random.default_rng(5)
    y = np.where(rng.random(300) < 0.25, 1, -1)
    score = rng.random(300) * 0.7 + 0.1 * (y == 1)
    score = np.floor(score * 5) / 5 if tied else score
    df = frame(spark, {"y": y, "score": score})
    want = brute_areas(score, y)
    for layout in (1, 7):
        r = metrics.areas(metrics.curve_points(df.repartition(layout), rows_per_bucket=rows_per_bucket)).first()
        assert (r["roc_auc"], r["pr_auc"]) == pytest.approx(want)


def test_close_scores_of_one_group_are_spread_and_the_input_stands_once(spark):
    """One group holds most rows, with scores a hair apart; its steps are dealt over many ranges."""
    rng = np.random.default_rng(6)
    n = 900
    g = np.where(rng.random(n) < 0.8, 1, rng.integers(2, 5, n))
    score = np.where(g == 1, 0.5 + rng.integers(0, 400, n) * 1e-12, rng.random(n))
    y = np.where(rng.random(n) < 0.3, 1, -1)
    df = frame(spark, {"id": range(n), "g": g, "score": score, "y": y}).withColumn("g", F.col("g").cast("int"))
    calls = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            calls.add(batch.num_rows)
            yield batch

    counted = df.mapInArrow(seen, df.schema)
    points = metrics.curve_points(counted, group=["g"], rows_per_bucket=25)
    got = {r["g"]: r for r in metrics.areas(points, ["g"]).collect()}
    assert calls.value == n
    assert set(got) == set(g.tolist())
    for k, r in got.items():
        assert (r["roc_auc"], r["pr_auc"]) == pytest.approx(brute_areas(score[g == k], y[g == k]))


def test_threshold_counts_exchange_no_scores(spark):
    df = spark.range(40).selectExpr("CASE WHEN id % 2 = 0 THEN 1 ELSE -1 END AS y", "id / 40 AS score")
    counted = metrics.threshold_counts(df, [0.25, 0.5])
    r = counted.first()
    assert (r["pos"], r["neg"], r["tp0"], r["fp0"], r["tp1"], r["fp1"]) == (20, 20, 15, 15, 10, 10)
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert " Sort " not in plan and plan.count("Exchange") == 1 and "SinglePartition" in plan


def test_areas_of_degenerate_classes(spark):
    only = metrics.areas(metrics.curve_points(frame(spark, {"y": [1, 1], "score": [0.2, 0.3]}))).first()
    assert (only["roc_auc"], only["pr_auc"]) == (0.0, 1.0)


def test_metrics_by_hand(spark):
    df = frame(spark, {"y": [1, 1, -1, -1, -1], "y_hat": [1, -1, 1, -1, -1]})
    r = metrics.classification_metrics(df).first()
    assert (r["tp"], r["fp"], r["fn"], r["tn"], r["accuracy"]) == (1, 1, 1, 2, 0.6)
    assert r["precision"] == pytest.approx(0.5) and r["f1"] == pytest.approx(0.5)
    none = metrics.classification_metrics(frame(spark, {"y": [-1], "y_hat": [-1]})).first()
    assert (none["precision"], none["recall"], none["f1"], none["accuracy"]) == (0, 0, 0, 1)


@pytest.mark.parametrize("k", [2, 5, 7])
def test_fold_sizes(spark, k):
    df = frame(spark, {"id": range(233), "y": [1 if i % 6 == 0 else -1 for i in range(233)]})
    folded = assign_folds(df, k, 3)
    for label in (1, -1):
        sizes = [r["count"] for r in folded.where(F.col("y") == label).groupBy("fold").count().orderBy("fold").collect()]
        n = sum(sizes)
        assert sizes == [n // k + (1 if i < n % k else 0) for i in range(k)]
    assert {tuple(r) for r in folded.collect()} == {tuple(r) for r in assign_folds(df.repartition(9), k, 3, slices=3).collect()}
    plain = [r["count"] for r in assign_folds(df, k, 3, None).groupBy("fold").count().orderBy("fold").collect()]
    assert plain == [233 // k + (1 if i < 233 % k else 0) for i in range(k)]


def test_more_folds_than_rows(spark):
    folded = assign_folds(frame(spark, {"id": range(3), "y": [1, 1, 1]}), 5, 1)
    assert sorted(r["fold"] for r in folded.collect()) == [0, 1, 2]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(240, 2))
    y = np.where(x[:, 0] + rng.normal(size=240) > 0.8, 1, -1)
    return frame(spark, {"id": range(240), "y": y, "a": x[:, 0], "b": x[:, 1], "one": np.ones(240)}).cache()


XS = ["a", "b", "one"]
BASE = Settings("reg_logistic", gamma=0.8, lambda_=0.001, threshold=0.4, max_iters=12)


def test_grid_order_and_unknown_axes():
    grid = training.param_grid(BASE, {"gamma": [1, 2], "threshold": [0.3, 0.4]})
    assert [(g.gamma, g.threshold, g.max_iters) for g in grid] == [(1, 0.3, 12), (1, 0.4, 12), (2, 0.3, 12), (2, 0.4, 12)]
    forest = training.param_grid(replace(BASE, model="random_forest"), {"max_depth": [1, 2]})
    assert [g.max_depth for g in forest] == [1, 2]
    with pytest.raises(ValueError):
        training.param_grid(BASE, {"gama": [1]})


def test_cross_validation_matches_brute_force(spark, table):
    k = 4
    candidates = training.param_grid(BASE, {"gamma": [0.3, 0.8], "threshold": [0.3, 0.5]})
    cv = training.cross_validate(table, XS, candidates, k, 2)
    folded = assign_folds(table, k, 2).toPandas()
    for c, s in enumerate(candidates):
        for fold in range(k):
            tr, va = folded[folded.fold != fold], folded[folded.fold == fold]
            x, y = tr[XS].to_numpy(), (tr.y.to_numpy() + 1) / 2
            w = np.zeros(3)
            for _ in range(s.max_iters):
                w = w - s.gamma * (x.T @ (1 / (1 + np.exp(-x @ w)) - y) / len(y) + 2 * s.lambda_ * w)
            p = 1 / (1 + np.exp(-va[XS].to_numpy() @ w))
            row = next(r for r in cv.per_fold if (r["candidate"], r["fold"]) == (c, fold))
            hat, t = p >= s.threshold, va.y.to_numpy() == 1
            assert (row["tp"], row["fp"], row["fn"], row["tn"]) == ((hat & t).sum(), (hat & ~t).sum(), (~hat & t).sum(), (~hat & ~t).sum())
            assert (row["roc_auc"], row["pr_auc"]) == pytest.approx(brute_areas(p, va.y.to_numpy()))
            z = x @ w
            assert row["loss"] == pytest.approx(np.mean(np.logaddexp(0, z) - y * z))
    agg = cv.aggregate()
    assert agg[1]["f1"] == pytest.approx(np.mean([r["f1"] for r in cv.per_fold if r["candidate"] == 1]))
    losses = [r["loss"] for r in cv.per_fold if r["candidate"] == 1]
    assert agg[1]["loss_std"] == pytest.approx(np.std(losses))
    f1 = [a["f1"] for a in agg]
    assert cv.best("f1") == f1.index(max(f1))
    assert cv.aggregate_frame(spark).count() == 4 and cv.per_fold_frame(spark).count() == 16


def test_areas_are_computed_for_all_the_best_or_none(spark, table):
    candidates = training.param_grid(BASE, {"gamma": [0.01, 0.8]})
    every = training.cross_validate(table, XS, candidates, 3, 2)
    best = training.cross_validate(table, XS, candidates, 3, 2, curves="best")
    none = training.cross_validate(table, XS, candidates, 3, 2, curves="none")
    chosen = every.best("f1")
    assert chosen == best.best("f1") == none.best("f1")
    for a, b, c in zip(every.per_fold, best.per_fold, none.per_fold):
        assert {m: a[m] for m in training.METRICS} == {m: b[m] for m in training.METRICS} == {m: c[m] for m in training.METRICS}
        assert a["loss"] == b["loss"] == c["loss"] and np.isnan(c["roc_auc"])
        assert b["roc_auc"] == pytest.approx(a["roc_auc"]) if a["candidate"] == chosen else np.isnan(b["roc_auc"])
    with pytest.raises(ValueError):
        training.cross_validate(table, XS, candidates, 3, curves="some")


def test_forest_jobs_do_not_grow_with_folds_and_candidates(spark, table):
    """Two candidates over two folds, and eight over four, take as many jobs."""
    def jobs(candidates, k):
        spark.sparkContext.setJobGroup(f"forest{len(candidates)}x{k}", "")
        training.cross_validate(table, XS, candidates, k, 1, curves="none")
        done = spark.sparkContext.statusTracker().getJobIdsForGroup(f"forest{len(candidates)}x{k}")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(done)

    s = Settings("random_forest", n_estimators=2, max_depth=2, max_features="all", seed=4)
    few = jobs(training.param_grid(s, {"max_depth": [1, 2]}), 2)
    many = jobs(training.param_grid(s, {"max_depth": [1, 2, 3, 4], "min_samples_leaf": [5, 10]}), 4)
    # Folds are cut by looking up one hash a border; nothing else may depend on them.
    assert many <= few + 4


def test_copies_never_cross_folds(spark, table):
    k = 3
    over = balance.oversample(table, 0.45)
    cv = training.cross_validate(over, XS, [BASE], k, 1, copies="copy")
    scored = sum(r["tp"] + r["fp"] + r["fn"] + r["tn"] for r in cv.per_fold)
    assert scored == table.count()
    plain = training.cross_validate(table, XS, [BASE], k, 1)
    assert [r["tp"] + r["fn"] for r in cv.per_fold] == [r["tp"] + r["fn"] for r in plain.per_fold]


def test_forest_cross_validation_scores_held_out_rows(spark, table):
    from tallyloom.operators import tree
    s = Settings("random_forest", n_estimators=3, max_depth=2, max_features="all", seed=4)
    cv = training.cross_validate(table, XS, [s, replace(s, threshold=0.3)], 2, 1)
    folded = assign_folds(table, 2, 1).withColumn("y01", (F.col("y") + 1) / 2)
    for fold in range(2):
        model = s.forest(folded.where(F.col("fold") != fold), XS, "y01")
        held = folded.where(F.col("fold") == fold).select("y", tree.probability(model).alias("p")).toPandas()
        row = next(r for r in cv.per_fold if (r["candidate"], r["fold"]) == (0, fold))
        assert row["tp"] == ((held.p >= 0.5) & (held.y == 1)).sum()
        assert (row["roc_auc"], row["pr_auc"]) == pytest.approx(brute_areas(held.p.to_numpy(), held.y.to_numpy()))
    with pytest.raises(ValueError):
        training.cross_validate(table, XS, [s, BASE], 2)


def test_search_refits_and_only_then_changes_the_iterations(spark, table, tmp_path):
    model, cv = training.search_and_train(table, XS, BASE, {"gamma": [0.01, 0.8]}, k=3, final_max_iters=5)
    assert model.fit.steps == 5 and model.settings.gamma == cv.candidates[cv.best()].gamma
    alone, _ = training.search_and_train(table, XS, BASE, None, k=3, final_max_iters=5)
    assert alone.fit.steps == 12
    out = model.predict(table).collect()
    assert all(r["y_hat"] == (1 if r["score"] >= 0.4 else -1) for r in out)
    summary = training.run_summary(table, model, cv)
    facts = {(r["section"], r["item"]): r["number"] for r in summary.collect()}
    assert facts[("settings", "gamma")] == model.settings.gamma
    assert facts[("cross_validation", "f1")] == pytest.approx(cv.aggregate()[cv.best()]["f1"])
    assert ("fold_2", "tp") in facts and 0 <= facts[("train", "roc_auc")] <= 1
    sinks.write_summary([summary], str(tmp_path / "summary"))
    assert spark.read.json(str(tmp_path / "summary")).count() == len(facts)


def test_forest_training_loss_is_the_error_rate(spark, table):
    from tallyloom.operators import tree
    model = training.train(table, XS, Settings("random_forest", n_estimators=3, max_depth=2, seed=1))
    wrong = table.select(((tree.class_vote(tree.probability(model.forest)) != (F.col("y") + 1) / 2)).cast("double").alias("w")).agg(F.avg("w")).first()[0]
    assert model.loss == pytest.approx(wrong)
