"""Threshold metrics and tie-aware ROC / PR curves."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import number, quoted
from ..sources.shared import written
from .ranks import MAX_BUCKETS, ROWS_PER_BUCKET

TINY = 1e-12
METRICS = ("tp", "fp", "fn", "tn", "precision", "recall", "f1", "accuracy")


def classification_metrics(df: DataFrame, actual: str = "y", predicted: str = "y_hat", group: Sequence[str] = ()
                           ) -> DataFrame:
    """Confusion counts, precision, recall, F1 and accuracy for labels in {-1, 1}."""
    def pairs(a: int, p: int) -> str:
        return f"count_if({quoted(actual)} = {a} AND {quoted(predicted)} = {p})"

    counts = df.groupBy(*group).agg(F.expr(f"{pairs(1, 1)} AS tp"), F.expr(f"{pairs(-1, 1)} AS fp"), F.expr(f"{pairs(1, -1)} AS fn"),
                                    F.expr(f"{pairs(-1, -1)} AS tn"), F.expr("count(1) AS _n"))
    rates = counts.selectExpr("*", f"tp / (tp + fp + {number(TINY)}) AS precision", f"tp / (tp + fn + {number(TINY)}) AS recall",
                              "(tp + tn) / greatest(_n, 1) AS accuracy")
    return (rates.selectExpr("*", f"2 * precision * recall / (precision + recall + {number(TINY)}) AS f1")
            .select(*group, *METRICS))


def figures(tp: int, fp: int, fn: int, tn: int) -> dict[str, float]:
    """The same figures from counts that are already known."""
    precision, recall = tp / (tp + fp + TINY), tp / (tp + fn + TINY)
    return {"tp": tp, "fp": fp, "fn": fn, "tn": tn, "precision": precision, "recall": recall,
            "f1": 2 * precision * recall / (precision + recall + TINY), "accuracy": (tp + tn) / max(1, tp + fp + fn + tn)}


def _running(keys: Sequence[str]):
    """Executor function: positives and negatives up to and including each step of its group, as far as the task holds it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, last, held = TaskContext.get().partitionId(), None, [0, 0]
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            change = np.zeros(n, bool)
            for k in keys:
                values = batch.column(k).to_numpy(zero_copy_only=False)
                change[1:] |= values[1:] != values[:-1]
            if tuple(batch.column(k)[0].as_py() for k in keys) != last:
                held = [0, 0]
            last = tuple(batch.column(k)[n - 1].as_py() for k in keys)
            starts = np.concatenate([[0], np.flatnonzero(change)])
            run_of = np.cumsum(change)
            sums = []
            for i, name in enumerate(("pos", "neg")):
                own = batch.column(name).to_numpy()
                total = np.cumsum(own)
                before = total[starts] - own[starts]
                total = total - before[run_of] + np.where(run_of == 0, held[i], 0)
                held[i] = int(total[-1])
                sums.append(pa.array(total))
            yield pa.RecordBatch.from_arrays([*batch.columns, *sums, pa.array(np.full(n, task, np.int32))], names=[*batch.schema.names, "cum_pos", "cum_neg", "part"])
    return run


def curve_points(df: DataFrame, score: str = "score", label: str = "y", group: Sequence[str] = (), rows_per_bucket: int = ROWS_PER_BUCKET
                 ) -> DataFrame:
    """One point per distinct score, best first: ``score, tpr, fpr, precision`` and the same of the point before it.

    Rows with equal scores form one step, so the curve does not depend on row order. The step before the first has
    tpr = fpr = 0 and the first point's precision.

    The steps are written once, so ``df`` is evaluated once. More than ``rows_per_bucket`` steps are dealt by range of
    (group, score), whatever the groups' sizes or how close their scores lie; every task sums its own steps, and the
    totals per range (one row per group and range) are added.
    """
    group = list(group)
    pos, neg = f"count_if({quoted(label)} = 1)", f"count_if({quoted(label)} <> 1)"
    steps = written(df.groupBy(*group, F.col(score).alias("score")).agg(F.expr(f"{pos} AS pos"), F.expr(f"{neg} AS neg")))
    ranges = min(MAX_BUCKETS, -(-steps.count() // rows_per_bucket))
    by = f"PARTITION BY {', '.join(quoted(g) for g in group)}" if group else ""
    if ranges <= 1:
        running = steps.selectExpr("*", f"sum(pos) OVER ({by} ORDER BY score DESC) AS cum_pos", f"sum(neg) OVER ({by} ORDER BY score DESC) AS cum_neg",
                                   f"greatest(sum(pos) OVER ({by}), 1) AS _p", f"greatest(sum(neg) OVER ({by}), 1) AS _q")
    else:
        order = [*group, F.col("score").desc()]
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in steps.schema.fields)
        summed = written(steps.repartitionByRange(ranges, *order).sortWithinPartitions(*order).mapInArrow(
            _running(group), f"{kinds}, cum_pos bigint, cum_neg bigint, part int"))
        totals = summed.groupBy(*group, "part").agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_q"))
        earlier = f"OVER ({by} ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        offsets = totals.selectExpr(*[quoted(g) for g in group], "part", f"coalesce(sum(_p) {earlier}, 0) AS _op", f"coalesce(sum(_q) {earlier}, 0) AS _oq",
                                    f"greatest(sum(_p) OVER ({by}), 1) AS _p", f"greatest(sum(_q) OVER ({by}), 1) AS _q")
        running = summed.join(offsets, [*group, "part"]).withColumns({"cum_pos": F.expr("cum_pos + _op"), "cum_neg": F.expr("cum_neg + _oq")})
    here = "cum_pos / (cum_pos + cum_neg)"
    return running.selectExpr(
        *[quoted(g) for g in group], "score", "pos", "neg", "cum_pos / _p AS tpr", "cum_neg / _q AS fpr", f"{here} AS precision",
        "(cum_pos - pos) / _p AS tpr_before", "(cum_neg - neg) / _q AS fpr_before",
        f"CASE WHEN cum_pos + cum_neg > pos + neg THEN (cum_pos - pos) / (cum_pos + cum_neg - pos - neg) ELSE {here} END AS precision_before")


ROC_AREA = "sum((fpr - fpr_before) * (tpr + tpr_before) / 2)"
PR_AREA = "sum((tpr - tpr_before) * (precision + precision_before) / 2)"


def areas(points: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Trapezoid areas under both curves; each point carries its own step, so this is one plain aggregate."""
    return points.groupBy(*group).agg(F.expr(f"{ROC_AREA} AS roc_auc"), F.expr(f"{PR_AREA} AS pr_auc"))


def threshold_counts(df: DataFrame, thresholds: Sequence[float], group: Sequence[str] = (), score: str = "score", label: str = "y") -> DataFrame:
    """Class totals and, per threshold i, the true (``tp<i>``) and false (``fp<i>``) positives of each group.

    Plain counts, added up per task before anything is exchanged: no score leaves its task and nothing is sorted.
    """
    counts = [f"count_if({quoted(score)} >= {number(t)} AND {quoted(label)} {sign} 1) AS {name}{i}"
              for i, t in enumerate(thresholds) for name, sign in (("tp", "="), ("fp", "<>"))]
    return df.groupBy(*group).agg(*[F.expr(e) for e in (f"count_if({quoted(label)} = 1) AS pos", f"count_if({quoted(label)} <> 1) AS neg", *counts)])
