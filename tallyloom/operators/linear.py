"""Linear and logistic models on top of the shared gradient pass and the product sums."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import id_hash
from ..functions.scalar import col, linear_score, log_loss, quoted, sigmoid
from ..sources.shared import new_folder, written
from .columns import HIGH, LOW, MEAN, per_column
from .factor import solve_triangle, triangle
from .gradient import BLOCK_ROWS, BLOCK_SCHEMA, Fit, Model, add_up, fit_models, gram, pack, partitions
from .ranks import hashes_at

# Products of up to this many columns are plain SQL aggregates.
NARROW = 32


def mse_loss(df: DataFrame, weights: dict[str, float], target: str = "target") -> DataFrame:
    error = F.col(target) - linear_score(weights)
    return df.agg((F.sum(error * error) / (2 * F.count(F.lit(1)))).alias("loss"))


def logistic_loss(df: DataFrame, weights: dict[str, float], y01: str = "y01") -> DataFrame:
    return df.agg(F.avg(log_loss(F.col(y01), linear_score(weights))).alias("loss"))


def logistic_gradient(df: DataFrame, weights: dict[str, float], y01: str = "y01") -> DataFrame:
    """``feature, gradient`` of the mean log loss."""
    scored = df.withColumn("_residual", sigmoid(linear_score(weights)) - F.col(y01))
    return per_column(scored, list(weights), {"gradient": "avg(_residual * {c})"})


def linear_gd(df: DataFrame, features: Sequence[str], target: str, gamma: float, max_iters: int) -> Fit:
    model = Model(gamma=gamma, max_iters=max_iters, patience=0, family="linear")
    return fit_models(df, features, target, [model])[0]


#: Files of the block store: with more tasks times batches the blocks are first brought together by batch.
STORE_FILES = 20_000


def batch_store(df: DataFrame, features: Sequence[str], target: str, cuts: Sequence[int], key: str, seed: int) -> str:
    """Folder of blocks with one part per batch; a row's batch is the number of cuts its own hash has reached."""
    names = [f"x{i}" for i in range(len(features))]
    rows = df.select(*[col(f).cast("double").alias(n) for f, n in zip(features, names)], F.col(target).cast("double").alias("_y"),
                     id_hash(quoted(key), seed).alias("_h"))
    borders, block_rows = np.array(cuts, np.int64), BLOCK_ROWS

    def to_blocks(batches):
        held, count = {}, {}

        def block(batch: int) -> pa.RecordBatch:
            table = np.concatenate(held.pop(batch))
            count.pop(batch)
            return pa.RecordBatch.from_pydict({
                "n": pa.array([len(table)], pa.int32()), "x": pa.array([np.ascontiguousarray(table[:, :-1]).tobytes()], pa.binary()),
                "y": pa.array([np.ascontiguousarray(table[:, -1]).tobytes()], pa.binary()), "fold": pa.array([np.full(len(table), float(batch)).tobytes()], pa.binary()),
                "batch": pa.array([batch], pa.int32())})

        for arrow in batches:
            if not arrow.num_rows:
                continue
            table = np.stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in arrow.columns[:-1]], axis=1)
            if np.isnan(table).any():
                raise ValueError("missing feature values or labels: impute before training")
            batch = np.searchsorted(borders, arrow.columns[-1].to_numpy(zero_copy_only=False).astype(np.int64), side="right")
            for k in np.unique(batch).tolist():
                held.setdefault(k, []).append(table[batch == k])
                count[k] = count.get(k, 0) + len(held[k][-1])
                if count[k] >= block_rows:
                    yield block(k)
        for k in list(held):
            yield block(k)

    blocks = rows.mapInArrow(to_blocks, BLOCK_SCHEMA + ", batch int")
    if partitions(blocks) * (len(cuts) + 1) > STORE_FILES:
        blocks = blocks.repartition("batch")
    folder = new_folder(df.sparkSession)
    blocks.write.partitionBy("batch").parquet(folder)
    return folder


def linear_minibatch(df: DataFrame, features: Sequence[str], target: str, gamma: float, steps: int, batches: int,
                     key: str = "id", seed: int = 1) -> Fit:
    """Gradient steps on ``batches`` equal parts of a hashed row order, visited in turn.

    The hashes at the borders of the batches are looked up, so a row's batch follows from its own hash and no row is
    numbered or joined. Blocks are stored by batch, and a step reads the blocks of its own batch only.
    """
    spark, width, total = df.sparkSession, len(features), df.count()
    size = max(1, -(-total // batches))
    filled = max(1, -(-total // size))
    cuts = hashes_at(df, key, seed, {(): [k * size for k in range(1, filled)]})[()] if filled > 1 else []
    folder = batch_store(df, features, target, cuts, key, seed)

    def blocks(batch: int | None) -> DataFrame:
        return spark.read.schema(BLOCK_SCHEMA).parquet(folder if batch is None else f"{folder}/batch={batch}")

    def partial(w: np.ndarray):
        def compute(x: np.ndarray, y: np.ndarray, fold: np.ndarray) -> np.ndarray:
            error = y - x @ w
            return np.concatenate([-(x.T @ error), [0.5 * float(error @ error), float(len(y))]])
        return compute

    w = np.zeros(width)
    if not total:
        return Fit(w, 0.0, 0.0, steps)
    for step in range(steps):
        sums = add_up(blocks(step % filled), partial(w), width + 2)
        w = w - gamma * sums[:width] / max(1.0, sums[-1])
    sums = add_up(blocks(None), partial(w), width + 2)
    loss = sums[width] / max(1.0, sums[-1])
    return Fit(w, loss, loss, steps)


def product_sums(df: DataFrame, features: Sequence[str], target: str) -> tuple[np.ndarray, np.ndarray, float]:
    """XtX, Xty and the row count: SQL sums for narrow tables, array blocks for wide ones."""
    if len(features) > NARROW:
        return gram(df, features, target)
    d = len(features)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    x = [f"CAST({quoted(f)} AS DOUBLE)" for f in features]
    row = df.selectExpr(*[f"sum({x[i]} * {x[j]}) AS g{i}_{j}" for i, j in pairs],
                        *[f"sum({x[i]} * {quoted(target)}) AS t{i}" for i in range(d)], "count(1) AS n",
                        "count_if(" + " AND ".join(f"{v} IS NOT NULL AND NOT isnan({v})" for v in [*x, f"CAST({quoted(target)} AS DOUBLE)"])
                        + ") AS whole").first()
    if row["whole"] < row["n"]:
        raise ValueError("missing feature values or labels: impute before training")
    xtx = np.zeros((d, d))
    for i, j in pairs:
        xtx[i, j] = xtx[j, i] = row[f"g{i}_{j}"]
    return xtx, np.array([row[f"t{i}"] for i in range(d)]), float(row["n"])


def least_squares(df: DataFrame, features: Sequence[str], target: str) -> np.ndarray:
    """Solved from the table's triangular factor, not from sums of products; the smallest-norm solution when columns depend
    on each other. Only a (d+1) x (d+1) triangle is on the driver."""
    return solve_triangle(triangle(df, features, target)[0])


def ridge(df: DataFrame, features: Sequence[str], target: str, penalty: float) -> np.ndarray:
    """Least squares with ``penalty * |w|^2`` added to the halved mean squared error."""
    r, n = triangle(df, features, target)
    return solve_triangle(r, 2.0 * n * penalty)


def logistic_family(name: str, gamma: float = 0.1, penalty: float = 1e-3, max_iters: int = 1000,
                    class_weights: tuple[float, float] = (1.0, 1.0), early_stopping: bool = True, patience: int = 10,
                    tolerance: float = 1e-6, held_out: int = -1) -> Model:
    """Settings of a named logistic variant.

    Without early stopping the plain variants run all their steps, and the weighted ones stop at the first small change
    among the losses checked every tenth step.
    """
    if name not in ("logistic", "reg_logistic", "logistic_weighted", "reg_logistic_weighted"):
        raise ValueError(f"unknown model: {name!r}")
    weighted = name.endswith("_weighted")
    rule = patience if early_stopping else (1 if weighted else 0)
    return Model(gamma=gamma, penalty=penalty if name.startswith("reg_") else 0.0, max_iters=max_iters,
                 weights=class_weights if weighted else (1.0, 1.0), patience=rule, tolerance=tolerance, held_out=held_out)


def fit_logistic(df: DataFrame, features: Sequence[str], y01: str, models: Sequence[Model], fold: str | None = None
                 ) -> list[Fit]:
    return fit_models(df, features, y01, models, fold)


def correlation_matrix(df: DataFrame, features: Sequence[str]) -> np.ndarray:
    """Pearson correlations after missing cells took their column's mean; constant columns have none (NaN)."""
    means = {r["feature"]: r["mean"] for r in per_column(df, features, {"mean": MEAN}).collect()}
    centers = [means[f] if means[f] is not None else 0.0 for f in features]
    if len(features) > NARROW:
        products = gram(df, features, center=centers)[0]
    else:
        shifted = df.select(*[F.coalesce(col(f).cast("double") - F.lit(c), F.lit(0.0)).alias(f)
                              for f, c in zip(features, centers)]).withColumn("_zero", F.lit(0.0))
        products = product_sums(shifted, features, "_zero")[0]
    deviation = np.sqrt(np.diag(products))
    with np.errstate(divide="ignore", invalid="ignore"):
        r = products / np.outer(deviation, deviation)
    return np.clip(r, -1.0, 1.0)


#: Columns of a tile, and tiles that one pass over the blocks adds up in a task.
TILE, TILES_AT_ONCE = 256, 64


def correlations(df: DataFrame, features: Sequence[str], threshold: float | None = None) -> DataFrame:
    """Pearson correlations in long form: ``i, j, feature_i, feature_j, r``; with a threshold the pairs i < j beyond it.

    Missing cells take their column's mean; constant columns have no correlation (null).

    Products of columns are summed tile by tile: a task adds up the tiles of its own blocks, equal tiles are brought
    together and added, and the pairs of a tile are written (and filtered) where it is. The driver holds two numbers a column.
    """
    features = list(features)
    width = len(features)
    facts = {r["feature"]: r for r in per_column(df, features, {"mean": MEAN, "low": LOW, "high": HIGH}).collect()}
    centers = [facts[f]["mean"] if facts[f]["mean"] is not None else 0.0 for f in features]
    shifted = df.select(*[F.coalesce(col(f).cast("double") - F.lit(float(c)), F.lit(0.0)).alias(f) for f, c in zip(features, centers)])
    blocks = written(pack(shifted.withColumn("_zero", F.lit(0.0)), features, "_zero"))
    deviation = np.sqrt(add_up(blocks, lambda x, y, fold: (x * x).sum(axis=0), width))
    deviation[deviation == 0] = np.nan
    deviation[[facts[f]["low"] == facts[f]["high"] for f in features]] = np.nan
    tiles = range(0, width, TILE)
    pairs = [(a, b) for a in tiles for b in tiles if a <= b]
    parts = None
    for start in range(0, len(pairs), TILES_AT_ONCE):
        some = blocks.mapInArrow(_tile_products(pairs[start:start + TILES_AT_ONCE], TILE, width), "a int, b int, task int, part binary")
        parts = some if parts is None else parts.unionAll(some)
    dealt = parts.repartition("a", "b").sortWithinPartitions("a", "b", "task")
    return dealt.mapInArrow(_tile_pairs(features, deviation, TILE, threshold), "i int, j int, feature_i string, feature_j string, r double")


def _tile_products(pairs: Sequence[tuple[int, int]], tile: int, width: int):
    def run(batches):
        total = {}
        for batch in batches:
            for n, x in zip(batch.column(0), batch.column(1)):
                x = np.frombuffer(x.as_buffer(), np.float64).reshape(n.as_py(), width)
                for a, b in pairs:
                    part = x[:, a:a + tile].T @ x[:, b:b + tile]
                    total[a, b] = total[a, b] + part if (a, b) in total else part
        task = TaskContext.get().partitionId()
        for (a, b), part in total.items():
            yield pa.RecordBatch.from_pydict({"a": pa.array([a], pa.int32()), "b": pa.array([b], pa.int32()), "task": pa.array([task], pa.int32()),
                                              "part": pa.array([part.tobytes()], pa.binary())})
    return run


def _tile_pairs(features: Sequence[str], deviation: np.ndarray, tile: int, threshold: float | None):
    names = pa.array(features)

    def rows(i, j, r):
        return pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), names.take(pa.array(i)), names.take(pa.array(j)),
                                           pa.array(r, from_pandas=True)], names=["i", "j", "feature_i", "feature_j", "r"])

    def finished(a, b, total):
        with np.errstate(divide="ignore", invalid="ignore"):
            r = np.clip(total / np.outer(deviation[a:a + tile], deviation[b:b + tile]), -1.0, 1.0)
        if threshold is not None:
            i, j = np.nonzero(np.abs(r) > threshold)
            kept = i + a < j + b
            yield rows(i[kept] + a, j[kept] + b, r[i[kept], j[kept]])
            return
        i, j = (m.ravel() for m in np.indices(r.shape))
        yield rows(i + a, j + b, r.ravel())
        if a != b:
            yield rows(j + b, i + a, r.ravel())

    def run(batches):
        key, total = None, None
        for batch in batches:
            for a, b, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3)):
                part = np.frombuffer(part.as_buffer(), np.float64).reshape(min(tile, len(deviation) - a), -1)
                if (a, b) != key:
                    if key is not None:
                        yield from finished(*key, total)
                    key, total = (a, b), part
                else:
                    total = total + part
        if key is not None:
            yield from finished(*key, total)
    return run


def highly_correlated(matrix: DataFrame, threshold: float = 0.95) -> DataFrame:
    """``feature_i, feature_j, r`` of the pairs of a matrix in long form, each once."""
    return (matrix.where((F.col("i") < F.col("j")) & (F.abs("r") > threshold))
            .select("feature_i", "feature_j", "r"))


def correlated_pairs(df: DataFrame, features: Sequence[str], threshold: float = 0.95) -> DataFrame:
    """The same straight from the table: no other pair leaves the task that has its tile."""
    return correlations(df, features, threshold).select("feature_i", "feature_j", "r")
