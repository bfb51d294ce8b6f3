"""Whole runs from a settings document: prepare, search, fit, predict, submit. Finished stages are not repeated."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, fields

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ..sources.sinks import load_level, save_level, write_submission, write_summary
from ..sources.tables import feature_columns, read_dataset
from .levels import prepare
from .training import AREAS, CrossValidation, FinalModel, Settings, cross_validate, param_grid, run_summary, train

#: Keys of a document beside the fields of ``Settings``. Those of process pools are accepted and have no effect.
KEYS = ("raw_dataset_dir", "data_dir", "use_preprocessed", "level", "every", "k", "k_folds", "seed", "metric", "search", "final_max_iters",
        "results_dir", "tag", "make_submission")
POOL_KEYS = ("n_jobs", "cv_n_jobs")
STAGE_SCHEMA = "stage string, fingerprint string, folder string"
NOT_FEATURES = ("id", "y", "copy")


def read_document(spark: SparkSession, path: str) -> dict:
    """The settings document at ``path``, on any file system Spark reads."""
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


@dataclass
class Run:
    """A checked document. Every setting it names is used; unknown ones are refused."""

    base: Settings
    results_dir: str
    level: str = "level0"
    raw_dataset_dir: str | None = None
    data_dir: str | None = None     # a written level, which is read instead of fitting one
    every: int | None = None
    k: int = 5
    seed: int = 1
    metric: str = "f1"
    axes: dict = field(default_factory=dict)
    final_max_iters: int | None = None
    tag: str = ""
    make_submission: bool = True

    @staticmethod
    def of(document: Mapping) -> Run:
        """``search`` maps settings to the values to try. Without ``level`` the last part of ``data_dir`` names it."""
        own = {f.name for f in fields(Settings)}
        unknown = sorted(set(document) - own - set(KEYS) - set(POOL_KEYS))
        if unknown:
            raise ValueError(f"unknown settings: {unknown}")
        written = bool(document.get("use_preprocessed", False))
        folder = document.get("data_dir")
        if written and not folder:
            raise ValueError("use_preprocessed needs data_dir")
        if not written and not document.get("raw_dataset_dir"):
            raise ValueError("raw_dataset_dir is missing")
        chosen = {n: tuple(document[n]) if n == "categorical" else document[n] for n in own if n in document}
        base = Settings(**chosen)
        named = document.get("level") or (folder.rstrip("/").rsplit("/", 1)[-1] if folder else "level0")
        return Run(base, document.get("results_dir", "results").rstrip("/"), named, None if written else document["raw_dataset_dir"],
                   folder if written else None, document.get("every"), int(document.get("k_folds", document.get("k", 5))),
                   int(document.get("seed", 1)), document.get("metric", "f1"), dict(document.get("search") or {}), document.get("final_max_iters"),
                   document.get("tag", base.model), bool(document.get("make_submission", True)))


class Stages:
    """Results of a run's stages. A stage writes to a folder of its own, and its manifest, written last, says where.

    The manifest's place follows from all settings that decide the stage and the ones before it. A run that was cut off finds
    the finished stages of the same settings and repeats only the others; a stage cut off half way leaves no manifest.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.made, self.folders = spark, root, [], {}
        self._above = ""

    def run(self, stage: str, decides: Mapping, make: Callable[[str], None]) -> str:
        """Folder of the stage's results, which ``make(folder)`` writes unless they exist."""
        said = json.dumps({"above": self._above, "stage": stage, **decides}, sort_keys=True, default=list)
        self._above = hashlib.sha256(said.encode()).hexdigest()
        manifest = f"{self.root}/manifests/{stage}-{self._above[:16]}"
        folder = self._finished(manifest)
        if folder is None:
            folder = f"{self.root}/{stage}-{uuid.uuid4().hex}"
            make(folder)
            self.spark.createDataFrame([(stage, self._above, folder)], STAGE_SCHEMA).coalesce(1).write.mode("overwrite").json(manifest)
            self.made.append(stage)
        self.folders[stage] = folder
        return folder

    def _finished(self, manifest: str) -> str | None:
        try:
            row = self.spark.read.schema(STAGE_SCHEMA).json(manifest).first()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return row["folder"] if row is not None and row["fingerprint"] == self._above else None


def _settings_of(candidate: Settings) -> dict:
    return {f.name: getattr(candidate, f.name) for f in fields(Settings)}


def run_document(spark: SparkSession, document: Mapping) -> Stages:
    """Carry out a document. The folders of ``prepared``, ``search``, ``predictions``, ``summary`` and ``submission`` follow
    from the result; ``made`` names the stages this call computed, in order.

    Preparation, search and final fit are as in ``prepare``, ``cross_validate`` and ``train``: with a search the winner by ``metric``
    is refitted, for ``final_max_iters`` steps if given. Folds follow original rows where the level oversamples.
    """
    run = Run.of(document)
    stages = Stages(spark, f"{run.results_dir}/{run.tag}" if run.tag else run.results_dir)

    if run.data_dir:
        prepared = run.data_dir
        stages.folders["prepared"] = prepared
        start = {"data_dir": prepared}
    else:
        start = {}

        def make_prepared(folder: str) -> None:
            train_rows, test_rows = read_dataset(spark, run.raw_dataset_dir, run.every)
            save_level(*prepare(train_rows, test_rows, feature_columns(train_rows), run.level, seed=run.seed), folder)

        prepared = stages.run("prepared", {"raw": run.raw_dataset_dir, "level": run.level, "every": run.every, "seed": run.seed}, make_prepared)
    ready, held, _ = load_level(spark, prepared)
    features = feature_columns(ready, NOT_FEATURES)
    copies = "copy" if "copy" in ready.columns else None
    candidates = param_grid(run.base, run.axes) if run.axes else [run.base]

    def make_search(folder: str) -> None:
        cv = cross_validate(ready, features, candidates, run.k, run.seed, copies=copies,
                            curves="all" if run.metric in AREAS else "best", metric=run.metric)
        cv.per_fold_frame(spark).coalesce(1).write.parquet(folder)

    found = stages.run("search", {**start, "candidates": [_settings_of(c) for c in candidates], "k": run.k, "seed": run.seed, "metric": run.metric}, make_search)
    per_fold = sorted((r.asDict() for r in spark.read.parquet(found).collect()), key=lambda r: (r["candidate"], r["fold"]))
    cv = CrossValidation(candidates, per_fold, run.k)
    chosen = candidates[cv.best(run.metric)]
    if run.axes and run.final_max_iters:
        chosen = Settings(**{**_settings_of(chosen), "max_iters": run.final_max_iters})
    model: list[FinalModel] = []

    def fitted() -> FinalModel:
        if not model:
            model.append(train(ready, features, chosen))
        return model[0]

    decided = {"settings": _settings_of(chosen)}
    predicted = stages.run("predictions", decided, lambda folder: fitted().predict(held).write.parquet(folder))
    stages.run("summary", decided, lambda folder: write_summary([run_summary(ready, fitted(), cv, run.metric)], folder))
    if run.make_submission:
        stages.run("submission", {}, lambda folder: write_submission(spark.read.parquet(predicted), folder))
    return stages


def predictions(stages: Stages) -> DataFrame:
    """``id, score, y_hat`` of the held-out rows of a finished run."""
    return stages.spark.read.parquet(stages.folders["predictions"])
