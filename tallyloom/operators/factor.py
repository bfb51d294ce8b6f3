"""Triangular factor of a tall table: blocks are factored where they lie and the factors are combined in a tree."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .gradient import pack, partitions

#: Factors that one task combines.
FAN_IN = 8
FACTOR_SCHEMA = "rows bigint, factor binary"


def triangle(df: DataFrame, features: Sequence[str], target: str) -> tuple[np.ndarray, int]:
    """R of the orthogonal-triangular form of the columns ``features, target``, and the number of rows.

    A task holds one triangle and one block at a time and sends one triangle. Triangles are combined ``FAN_IN`` at a time on
    the executors until one is left, so the driver receives one (d+1) x (d+1) matrix however many tasks there are. Errors grow
    with the condition number of the columns and not, as in sums of products, with its square. Missing cells are refused; an
    empty table has a zero triangle.
    """
    size = len(features) + 1

    def folded(parts: Iterator[tuple[int, np.ndarray]]) -> pa.RecordBatch:
        rows, r = 0, np.zeros((0, size))
        for n, part in parts:
            rows += n
            r = np.linalg.qr(np.concatenate([r, part]), mode="r")
        return pa.RecordBatch.from_arrays([pa.array([rows], pa.int64()), pa.array([r.tobytes()], pa.binary())], names=["rows", "factor"])

    def of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts():
            for batch in batches:
                for n, x, y in zip(*[batch.column(i) for i in range(3)]):
                    rows = n.as_py()
                    yield rows, np.column_stack([np.frombuffer(x.as_buffer(), dtype=np.float64).reshape(rows, -1),
                                                 np.frombuffer(y.as_buffer(), dtype=np.float64)])
        yield folded(parts())

    def of_factors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts():
            for batch in batches:
                for n, factor in zip(*batch.columns):
                    yield n.as_py(), np.frombuffer(factor.as_buffer(), dtype=np.float64).reshape(-1, size)
        yield folded(parts())

    blocks = pack(df, features, target)
    tasks = partitions(blocks)
    factors = blocks.mapInArrow(of_blocks, FACTOR_SCHEMA)
    while tasks > 1:
        tasks = -(-tasks // FAN_IN)
        factors = factors.repartition(tasks, F.spark_partition_id()).mapInArrow(of_factors, FACTOR_SCHEMA)
    total, r = 0, np.zeros((size, size))
    for row in factors.collect():
        part = np.frombuffer(row["factor"], dtype=np.float64).reshape(-1, size)
        total, r = total + row["rows"], np.linalg.qr(np.concatenate([r, part]), mode="r")
    return r, total


def solve_triangle(r: np.ndarray, penalty: float = 0.0) -> np.ndarray:
    """Weights with the smallest ``|target - X w|^2 + penalty * |w|^2``; the shortest ones where several do equally well.

    The last column of ``r`` belongs to the target. Whether columns depend on each other is decided at unit column length,
    so that columns of very different scales are no reason to drop one.
    """
    d = r.shape[1] - 1
    a, b = np.concatenate([r[:, :d], np.sqrt(penalty) * np.eye(d)]), np.concatenate([r[:, d], np.zeros(d)])
    length = np.linalg.norm(a, axis=0)
    tolerance = 64 * np.finfo(float).eps * max(d, 1)
    if d and (length > 0).all() and np.linalg.cond(a / length) < 1 / tolerance:
        return np.linalg.lstsq(a / length, b, rcond=None)[0] / length
    return np.linalg.lstsq(a, b, rcond=tolerance)[0]
