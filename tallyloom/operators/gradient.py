"""Full-batch gradient descent for many linear models at once.

Rows are packed into array blocks once and cached; each step broadcasts the weight matrix (features x models) inside
the task closure, computes every model's gradient and loss on the local blocks, and returns one small array per
partition. Folds, grid points and class weights are columns of that matrix, so one pass over the data serves all of
them. A lost executor only costs its blocks, which are rebuilt from their input.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import col

# Partial results of more partitions than this are first added up on executors.
DIRECT_PARTIALS = 64

BLOCK_SCHEMA = "n int, x binary, y binary, fold binary"
BLOCK_ROWS = 8192
PARTIAL_SCHEMA = "part binary"


def pack(df: DataFrame, features: Sequence[str], target: str, fold: str | None = None) -> DataFrame:
    """Blocks of rows, however small the Arrow batches: the feature matrix, the target and the fold numbers as raw doubles."""
    names = [f"x{i}" for i in range(len(features))]
    fold_column = F.lit(-1.0) if fold is None else F.col(fold).cast("double")
    narrow = df.select(*[col(f).cast("double").alias(n) for f, n in zip(features, names)],
                       F.col(target).cast("double").alias("_y"), fold_column.alias("_fold"))
    block_rows = BLOCK_ROWS

    def block(table: pa.Table) -> pa.RecordBatch:
        columns = [c.to_numpy() for c in table.columns]
        x = np.ascontiguousarray(np.stack(columns[:-2], axis=1), dtype=np.float64)
        if np.isnan(x).any() or np.isnan(columns[-2].astype(np.float64)).any():
            raise ValueError("missing feature values or labels: impute before training")
        return pa.RecordBatch.from_pydict({
            "n": pa.array([table.num_rows], pa.int32()), "x": pa.array([x.tobytes()], pa.binary()),
            "y": pa.array([columns[-2].astype(np.float64).tobytes()], pa.binary()),
            "fold": pa.array([columns[-1].astype(np.float64).tobytes()], pa.binary())})

    def to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= block_rows:
                yield block(pa.Table.from_batches(held))
                held, rows = [], 0
        if rows:
            yield block(pa.Table.from_batches(held))

    return narrow.mapInArrow(to_blocks, BLOCK_SCHEMA)


def partitions(blocks: DataFrame) -> int:
    return blocks.rdd.getNumPartitions()


def add_up(blocks: DataFrame, partial, size: int, tasks: int | None = None) -> np.ndarray:
    """Sum over all blocks of ``partial(x, y, fold)``, a flat array of ``size`` doubles independent of the row count."""
    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for n, x, y, fold in zip(*[batch.column(i) for i in range(4)]):
                rows = n.as_py()
                total += partial(np.frombuffer(x.as_buffer(), dtype=np.float64).reshape(rows, -1),
                                 np.frombuffer(y.as_buffer(), dtype=np.float64),
                                 np.frombuffer(fold.as_buffer(), dtype=np.float64))
        yield pa.RecordBatch.from_pydict({"part": pa.array([total.tobytes()], pa.binary())})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for part in batch.column(0):
                total += np.frombuffer(part.as_buffer(), dtype=np.float64)
        yield pa.RecordBatch.from_pydict({"part": pa.array([total.tobytes()], pa.binary())})

    parts = blocks.mapInArrow(per_partition, PARTIAL_SCHEMA)
    if (partitions(blocks) if tasks is None else tasks) > DIRECT_PARTIALS:
        parts = parts.repartition(DIRECT_PARTIALS).mapInArrow(merge, PARTIAL_SCHEMA)
    total = np.zeros(size)
    for row in parts.collect():
        total += np.frombuffer(row["part"], dtype=np.float64)
    return total


@dataclass(frozen=True)
class Model:
    """Settings of one column of the weight matrix.

    ``held_out`` names the fold whose rows the model does not see; ``weights`` are the weights of classes 0 and 1.
    ``patience=0`` switches the stop rule off. ``family`` is ``linear`` or ``logistic``.
    """

    gamma: float = 0.1
    penalty: float = 0.0
    max_iters: int = 1000
    weights: tuple[float, float] = (1.0, 1.0)
    held_out: int = -1
    patience: int = 10
    tolerance: float = 1e-6
    check_every: int = 10
    family: str = "logistic"


@dataclass
class Fit:
    """Weights with the final plain and class-weighted loss, and the number of steps taken."""

    weights: np.ndarray
    loss: float
    weighted_loss: float
    steps: int


def _partial(w: np.ndarray, models: Sequence[Model]):
    """Gradient sums (d x m), loss sums, weighted loss sums and row counts of one block for the given models."""
    logistic = np.array([m.family == "logistic" for m in models])
    weight0, weight1 = (np.array([m.weights[i] for m in models]) for i in (0, 1))
    held_out = np.array([m.held_out for m in models])

    # Functions that run on executors refer to NumPy and their own arguments only, so that they travel by value and
    # executors need not have this package.
    def sigmoid(z: np.ndarray) -> np.ndarray:
        small = np.exp(-np.abs(z))
        return np.where(z >= 0, 1.0, small) / (1.0 + small)

    def compute(x: np.ndarray, y: np.ndarray, fold: np.ndarray) -> np.ndarray:
        seen = (fold[:, None] != held_out) | (held_out < 0)
        z, target = x @ w, y[:, None]
        cost = np.where(target == 1, weight1, weight0)
        row_loss = np.where(logistic, np.logaddexp(0.0, z) - target * z, 0.5 * (target - z) ** 2) * seen
        residual = np.where(logistic, sigmoid(z), z) - target
        gradient = x.T @ (residual * np.where(logistic, cost, 1.0) * seen)
        weighted = (row_loss * cost).sum(axis=0)
        return np.concatenate([gradient.ravel(), row_loss.sum(axis=0), weighted, seen.sum(axis=0).astype(float)])

    return compute


def descend(blocks: DataFrame, models: Sequence[Model], width: int, start: np.ndarray | None = None) -> list[Fit]:
    """Run every model from zero (or ``start``) to its own end; finished models leave the weight matrix.

    The loss of a step's result is computed by the next pass over the data, together with that pass's gradient, so
    checking for convergence costs no pass of its own.
    """
    w = np.zeros((width, len(models))) if start is None else np.array(start, dtype=float).reshape(width, -1)
    if w.shape[1] != len(models):
        w = np.repeat(w[:, :1], len(models), axis=1)
    fits: list[Fit | None] = [None] * len(models)
    previous = [float("inf")] * len(models)
    quiet = [0] * len(models)
    live = list(range(len(models)))
    step, tasks = 0, partitions(blocks)
    while live:
        current = [models[i] for i in live]
        m = len(live)
        sums = add_up(blocks, _partial(w[:, live], current), (width + 3) * m, tasks)
        gradient = sums[:width * m].reshape(width, m)
        loss, weighted, rows = sums[width * m:].reshape(3, m)
        rows = np.maximum(rows, 1.0)
        going = []
        for k, i in enumerate(live):
            model, mean_loss = models[i], loss[k] / rows[k]
            stop = step >= model.max_iters
            # The iterate reached by step s (counted from 0) is checked when s is a multiple of check_every.
            if not stop and model.patience and step and (step - 1) % model.check_every == 0:
                quiet[i] = quiet[i] + 1 if abs(previous[i] - mean_loss) < model.tolerance else 0
                previous[i] = mean_loss
                stop = quiet[i] >= model.patience
            if stop:
                fits[i] = Fit(w[:, i].copy(), mean_loss, weighted[k] / rows[k], step)
            else:
                w[:, i] -= model.gamma * (gradient[:, k] / rows[k] + 2.0 * model.penalty * w[:, i])
                going.append(i)
        live = going
        step += 1
    return fits


def fit_models(df: DataFrame, features: Sequence[str], target: str, models: Sequence[Model], fold: str | None = None,
               start: np.ndarray | None = None) -> list[Fit]:
    """Pack, cache, descend, release."""
    blocks = pack(df, features, target, fold).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return descend(blocks, models, len(features), start)
    finally:
        blocks.unpersist()


def gram(df: DataFrame, features: Sequence[str], target: str | None = None, center: Sequence[float] | None = None
         ) -> tuple[np.ndarray, np.ndarray, float]:
    """Sums of products of all feature pairs, of feature and target, and the row count, in one pass.

    With ``center`` the columns are shifted first and their missing cells count as the center.
    """
    width = len(features)
    names = list(features)
    if center is not None:
        df = df.select(*[F.coalesce(col(f).cast("double") - F.lit(float(c)), F.lit(0.0)).alias(f)
                         for f, c in zip(names, center)], *([target] if target else []))
    ready = df.withColumn("_t", F.col(target).cast("double") if target else F.lit(0.0))

    def products(x: np.ndarray, y: np.ndarray, fold: np.ndarray) -> np.ndarray:
        return np.concatenate([(x.T @ x).ravel(), x.T @ y, [float(len(y))]])

    sums = add_up(pack(ready, names, "_t"), products, width * width + width + 1)
    return sums[:width * width].reshape(width, width), sums[width * width:-1], sums[-1]
