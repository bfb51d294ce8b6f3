"""Whitening by shifted CholeskyQR: distributed Gram passes, triangular solves, one small decomposition of R."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import grouped, read_table, stored
from .registry import query

COMPONENTS = 8
MAX_DIMENSIONS = 4096          # the driver holds a few matrices of this size
ROWS_AT_ONCE = 2048
LARGEST = 1 << 46              # entries beyond have no exact sums; such rows are left out
ROUNDS, SETTLED = 8, 1e-13
_UNIT = 2.0 ** -53
_NOISE = 2.0 ** -47            # of the largest singular value and per dimension, 16 dimensions at least
_LONG = 1 << 63


@dataclass
class Whitening:
    """What a fit found; all of it is of the size of a few vectors, or of a matrix of ``dim`` columns at most."""

    n: int
    dim: int
    sums: list[int]            # exact sums of the entries
    trace: float               # of the covariance
    values: np.ndarray         # eigenvalues, falling
    vectors: np.ndarray        # unit eigenvectors, one a column, the largest entry positive
    factors: list[np.ndarray]  # triangular factors of the passes, first one first


def _whole_vectors(df: DataFrame, vector: str, dim: int) -> DataFrame:
    good = f"x IS NOT NULL AND size(x) = {dim} AND forall(x, c -> c IS NOT NULL AND abs(c) < {LARGEST})"
    return df.withColumn("x", F.col(vector).cast("array<bigint>")).where(good)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - S`` per entry, exact: as longs where they fit, else as Python integers."""
    most = n * int(np.abs(x).max(initial=0)) + max((abs(s) for s in sums), default=0)
    if most < _LONG:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _rows_of(batches: Iterator[pa.RecordBatch], dim: int):
    for batch in batches:
        for first in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(first, ROWS_AT_ONCE)
            yield part, _matrix(part.column("x"), dim)


def _summer(dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * dim
        for _, x in _rows_of(batches, dim):
            n += len(x)
            total = [a + b for a, b in zip(total, x.sum(0).tolist())]
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([n] * dim, pa.int64()), pa.array(range(dim), pa.int32()), pa.array([str(t) for t in total])], names=["n", "i", "s"])
    return run


def _grams(dim: int, prepare):
    """One symmetric product of a task's prepared rows: row i from its diagonal on, with the task's number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in _rows_of(batches, dim):
            a = prepare(x)
            total = a.T @ a if total is None else total + a.T @ a
        if total is not None:
            task = TaskContext.get().partitionId()
            for i in range(len(total)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i], pa.int32()), pa.array([task], pa.int32()), pa.array([total[i, i:].tolist()], pa.list_(pa.float64()))], names=["i", "task", "row"])
    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the tasks' rows, in the order of the tasks, so that every run adds alike."""
    for (i,), table in grouped(batches, ["i"]):
        rows = table.column("row").combine_chunks()
        total = np.add.accumulate(rows.flatten().to_numpy().reshape(len(rows), -1), axis=0)[-1]
        yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([total.tolist()], pa.list_(pa.float64()))], names=["i", "row"])


def gram(rows: DataFrame, dim: int, prepare, width: int | None = None) -> np.ndarray:
    """Product of the transposed prepared rows with themselves, ``width`` wide.

    At most ``spark.sql.shuffle.partitions`` tasks return one triangle each; the triangles are added row by row on the
    cluster, and the driver gets one.
    """
    width = width or dim
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = rows.coalesce(tasks).mapInArrow(_grams(dim, prepare), "i int, task int, row array<double>")
    summed = parts.repartition("i").sortWithinPartitions("i", "task").mapInArrow(_added, "i int, row array<double>").toArrow()
    out = np.zeros((width, width))
    for i, row in zip(summed.column("i").to_pylist(), summed.column("row").to_pylist()):
        out[i, i:] = row
    return out + np.triu(out, 1).T


def solved(a: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """Rows times the inverses of the triangular factors, one solve after another."""
    for r in factors:
        a = np.linalg.solve(r.T, a.T).T
    return a


def _centred_rows(n: int, sums: list[int], factors: list[np.ndarray]):
    return lambda x: solved(centred(x, n, sums).astype(np.float64) / n, factors)


def shifted_factor(g: np.ndarray, n: int, always: bool) -> np.ndarray:
    """Triangular R with R'R = G, or G plus a shift of the size of its rounding errors where G is not safely definite."""
    d = len(g)
    shift = 11 * (n * d + d * (d + 1)) * _UNIT * np.trace(g)
    shift = min(shift, 0.01 * np.trace(g))
    while True:
        try:
            if not always:
                return np.linalg.cholesky(g).T
            return np.linalg.cholesky(g + shift * np.eye(d)).T
        except np.linalg.LinAlgError:
            always, shift = True, shift * (10 if always else 1)


def fit_whitening(df: DataFrame, vector: str = "x", components: int = COMPONENTS) -> Whitening | None:
    """Principal components of the centred rows of whole numbers; None if no row has a vector.

    A pass sums the entries exactly. The next passes take the centred rows through the triangular factors found so far,
    sum their Gram matrix and factor it: the first one with a shift, which keeps the factor defined for nearly dependent
    columns, the later ones as they are unless they are singular. When the rows are orthonormal up to ``SETTLED``, the
    product R of the factors has the centred rows' singular values and right vectors, which one decomposition of R
    gives: the rows' squared condition number never enters. Directions without variance get no component.

    The commonest length of vectors counts (of equally common ones the longest); rows of another length, null vectors,
    vectors with null entries or entries of 2^46 and more are left out. Reads ``df`` five to ten times.
    """
    sized = df.select(F.size(F.col(vector)).alias("dim")).where("dim > 0").groupBy("dim").count().orderBy(F.desc("count"), F.desc("dim")).first()
    if sized is None:
        return None
    dim = sized["dim"]
    if dim > MAX_DIMENSIONS:
        raise ValueError(f"vectors of {dim} entries; at most {MAX_DIMENSIONS} are supported")
    rows = _whole_vectors(df, vector, dim).select("x")
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sums = rows.coalesce(tasks).mapInArrow(_summer(dim), "n bigint, i int, s string").groupBy("i").agg(
        F.sum("n").alias("n"), F.sum(F.expr("CAST(s AS DECIMAL(38, 0))")).alias("s")).collect()
    if not sums:
        return None
    n, sums = sums[0]["n"], [int(r["s"]) for r in sorted(sums, key=lambda r: r["i"])]
    factors: list[np.ndarray] = []
    trace, known = 0.0, None
    for _ in range(ROUNDS):
        g = gram(rows, dim, _centred_rows(n, sums, factors))
        if not factors:
            trace = float(np.trace(g)) / n
            if trace == 0:
                return Whitening(n, dim, sums, 0.0, np.zeros(0), np.zeros((dim, 0)), [])
        else:
            spread = np.linalg.eigvalsh(g)
            off = float(np.abs(spread[spread > 0.5] - 1).max(initial=0))
            # Settled, or as near as rounding lets it come.
            if off <= SETTLED or (known is not None and off >= known and off < 1e-11):
                break
            known = off
        factors.append(shifted_factor(g, n, always=not factors))
    r = factors[0]
    for later in factors[1:]:
        r = later @ r
    left, sizes, turned = np.linalg.svd(r)
    values = sizes * sizes / n
    # Rounding errors, or a shift without rows behind it, are no component.
    found = int(((sizes > sizes[0] * max(dim, 16) * _NOISE) & ((left * (g @ left)).sum(0) > 0.5)).sum())
    take = min(components, found)
    vectors = turned[:take].T.copy()
    vectors *= np.sign(vectors[np.abs(vectors).argmax(0), np.arange(take)])
    return Whitening(n, dim, sums, trace, values[:take], vectors, factors)


def _whitened_rows(fit: Whitening):
    scaled = fit.vectors / np.sqrt(fit.values)
    return lambda x: (centred(x, fit.n, fit.sums).astype(np.float64) / fit.n) @ scaled


def identity_error(df: DataFrame, fit: Whitening, vector: str = "x") -> float:
    """Largest absolute entry of the whitened fit rows' covariance less the identity, by one more pass over them."""
    width = len(fit.values)
    if not width:
        return 0.0
    prepare = _whitened_rows(fit)
    g = gram(_whole_vectors(df, vector, fit.dim).select("x"), fit.dim, lambda x: np.hstack([prepare(x), np.ones((len(x), 1))]), width + 1)
    means = g[:-1, -1] / fit.n
    return float(np.abs(g[:-1, :-1] / fit.n - np.outer(means, means) - np.eye(width)).max())


def _applier(fit: Whitening):
    prepare = _whitened_rows(fit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _rows_of(batches, fit.dim):
            c, w = centred(x, fit.n, fit.sums), prepare(x)
            most = int(np.abs(c).max(initial=0))
            c = c if c.dtype != object and most * most * fit.dim < _LONG else c.astype(object)
            deviation = [d if d < _LONG else None for d in (c * c).sum(1).tolist()]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * w.shape[1]), pa.array(w.ravel()))
            yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(deviation, pa.int64()), lists], names=["key", "deviation", "whitened"])
    return run


def whiten(df: DataFrame, fit: Whitening, key: str = "vec_id", vector: str = "x") -> DataFrame:
    """``key, deviation, whitened``: the exact sum of squares of ``n * x - S``, and the coordinates on the components.

    Rows that the fit would leave out have no row here; ``deviation`` is null beyond 64 bits; repeated rows and null keys
    are rows of their own; other columns are ignored.
    """
    rows = _whole_vectors(df.select(F.col(key).alias("key"), F.col(vector).alias("_entries")), "_entries", fit.dim).select("key", "x")
    out = rows.mapInArrow(_applier(fit), f"key {dict(rows.dtypes)['key']}, deviation bigint, whitened array<double>")
    return out.select(F.col("key").alias(key), "deviation", "whitened")


def quantised(df: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``key, x``: every entry as floor(1024 c) + 100000; rows whose vector is null or holds null or non-finite entries go."""
    entry = f"CASE WHEN NOT isnan(c) AND abs(c) < {LARGEST >> 11} THEN CAST(floor(1024D * c) AS BIGINT) + 100000L END"
    return df.select(F.col(key).alias(key), F.col(vector).cast("array<double>").alias("v")).select(
        key, F.expr(f"transform(v, c -> {entry})").alias("x")).where("x IS NOT NULL AND forall(x, c -> c IS NOT NULL)")


@query("op11_embedding_whitening")
def op11_embedding_whitening(spark, folder):
    whole = stored(quantised(read_table(spark, folder, "embeddings")))
    fit = fit_whitening(whole)
    if fit is None or not len(fit.values):
        return whole.where("false").selectExpr("vec_id", "1 AS component", "0L AS n", "0L AS deviation", "0D AS whitened", "0D AS explained", "0D AS identity_error")
    error = identity_error(whole, fit)
    explained = F.array(*[F.lit(float(e / fit.trace)) for e in fit.values])
    return whiten(whole, fit).select("vec_id", F.posexplode("whitened").alias("k", "whitened"), "deviation").select(
        "vec_id", F.expr("CAST(k + 1 AS INT) AS component"), F.lit(fit.n).cast("bigint").alias("n"), "deviation", "whitened",
        F.element_at(explained, F.col("k") + 1).alias("explained"), F.lit(error).alias("identity_error"))
