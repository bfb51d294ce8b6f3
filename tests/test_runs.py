"""Runs from a settings document: every setting is used, and a repeated run takes up where the last one stopped."""

import json

import numpy as np
import pytest

from tallyloom.plans import runs
from tallyloom.plans.levels import prepare
from tallyloom.plans.training import Settings, search_and_train
from tallyloom.sources.sinks import load_level
from tallyloom.sources.tables import feature_columns, read_dataset


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    rng = np.random.default_rng(5)
    x = rng.normal(size=(260, 3))
    y = np.where(x[:, 0] - 0.5 * x[:, 1] + rng.normal(scale=0.7, size=260) > 0.6, 1, -1)
    lines = [f"{i},{a:.4f},{b:.4f},{c:.4f}" for i, (a, b, c) in enumerate(x)]
    (folder / "x_train.csv").write_text("Id,a,b,c\n" + "\n".join(lines[:200]))
    (folder / "x_test.csv").write_text("Id,a,b,c\n" + "\n".join(lines[200:]))
    (folder / "y_train.csv").write_text("Id,_Y\n" + "\n".join(f"{i},{v}" for i, v in enumerate(y[:200])))
    return str(folder)


@pytest.fixture
def document(raw, tmp_path):
    return {"raw_dataset_dir": raw, "data_dir": "/somewhere/level1", "use_preprocessed": False, "model": "reg_logistic", "k": 3, "seed": 2, "metric": "f1",
            "gamma": 0.3, "lambda_": 0.001, "max_iters": 8, "threshold": 0.4, "search": {"gamma": [0.1, 0.6]}, "final_max_iters": 12,
            "results_dir": str(tmp_path / "out"), "tag": "first", "make_submission": True, "n_jobs": 3, "cv_n_jobs": 2}


def test_a_run_equals_its_steps_and_is_not_repeated(spark, raw, document, tmp_path):
    (tmp_path / "run.json").write_text(json.dumps(document, indent=1))
    done = runs.run_document(spark, runs.read_document(spark, str(tmp_path / "run.json")))
    assert done.made == ["prepared", "search", "predictions", "summary", "submission"]

    train, test = read_dataset(spark, raw)
    ready, held, _ = prepare(train, test, feature_columns(train), "level1", seed=2)
    features = feature_columns(ready, runs.NOT_FEATURES)
    model, cv = search_and_train(ready, features, Settings("reg_logistic", gamma=0.3, lambda_=0.001, max_iters=8, threshold=0.4), {"gamma": [0.1, 0.6]},
                                 k=3, seed=2, final_max_iters=12, copies="copy" if "copy" in ready.columns else None)
    want = {r["id"]: r for r in model.predict(held).collect()}
    got = {r["id"]: r for r in runs.predictions(done).collect()}
    assert len(got) == 60 and set(got) == set(want)
    assert all(got[i]["score"] == pytest.approx(want[i]["score"], abs=1e-5) for i in got)
    said = {(r["section"], r["item"]): r for r in spark.read.json(done.folders["summary"]).collect()}
    assert said[("settings", "max_iters")]["number"] == 12 and said[("settings", "threshold")]["number"] == 0.4
    assert said[("search", "candidates")]["number"] == 2 and said[("search", "best")]["number"] == pytest.approx(cv.aggregate()[cv.best()]["f1"], abs=1e-4)
    sent = spark.read.option("header", True).option("inferSchema", True).csv(done.folders["submission"])
    assert sent.columns == ["Id", "Prediction"] and {r["Id"]: r["Prediction"] for r in sent.collect()} == {i: r["y_hat"] for i, r in got.items()}

    again = runs.run_document(spark, document)
    assert again.made == [] and again.folders == done.folders


def test_a_run_that_was_cut_off_goes_on(spark, document, monkeypatch):
    def broken(*_):
        raise RuntimeError("lost")

    whole = runs.write_summary
    monkeypatch.setattr(runs, "write_summary", broken)
    with pytest.raises(RuntimeError, match="lost"):
        runs.run_document(spark, document)
    monkeypatch.setattr(runs, "write_summary", whole)
    assert runs.run_document(spark, document).made == ["summary", "submission"]
    # Another setting repeats the stages it decides, and those after them.
    assert runs.run_document(spark, {**document, "threshold": 0.45}).made == ["search", "predictions", "summary", "submission"]
    assert runs.run_document(spark, {**document, "final_max_iters": 5}).made == ["predictions", "summary", "submission"]
    assert runs.run_document(spark, {**document, "make_submission": False}).made == []


def test_a_written_level_is_read(spark, document, tmp_path):
    first = runs.run_document(spark, document)
    second = {**document, "use_preprocessed": True, "data_dir": first.folders["prepared"], "results_dir": str(tmp_path / "other"), "search": {},
              "model": "random_forest", "n_estimators": 3, "max_depth": 3, "make_submission": False}
    done = runs.run_document(spark, second)
    assert done.made == ["search", "predictions", "summary"] and done.folders["prepared"] == first.folders["prepared"]
    assert runs.predictions(done).count() == load_level(spark, first.folders["prepared"])[1].count() == 60


@pytest.mark.parametrize("change", [{"gama": 1}, {"raw_dataset_dir": None}, {"use_preprocessed": True, "data_dir": ""}])
def test_documents_are_checked(document, change):
    with pytest.raises(ValueError):
        runs.Run.of({**document, **change})
