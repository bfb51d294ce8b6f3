"""Exact quantiles with linear interpolation, for tables of any length."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import col, number
from .columns import BATCH, per_column

# The built-in exact percentile keeps a column's distinct values in one task: fine up to this many values per task.
IN_TASK_VALUES = 4_000_000

#: A double's 64 bits are read in digits, one scan each, whatever the number of columns.
DIGIT_BITS = 16
SCANS = 64 // DIGIT_BITS
CELL_SCHEMA = "k int, slot int, digit int, n bigint"


def exact_quantiles(df: DataFrame, features: Sequence[str], fractions: Sequence[float], rows: int | None = None,
                    in_task_values: int = IN_TASK_VALUES, rows_per_bucket: int | None = None) -> DataFrame:
    """``feature, quantiles`` (array in the order of ``fractions``), missing values left out.

    Short tables use the built-in percentile, in batches of columns that fit one task, as long as that takes no more scans
    than reading digits. Other tables are searched digit by digit, all columns at once. ``rows_per_bucket`` has no effect:
    no range borders are sampled any more.
    """
    rows = df.count() if rows is None else rows
    batch = min(BATCH, in_task_values // max(1, rows))
    if batch and math.ceil(len(features) / batch) <= SCANS:
        points = ", ".join(number(q) for q in fractions)
        measure = {"quantiles": f"percentile(CAST({{c}} AS DOUBLE), array({points}))"}
        return per_column(df, features, measure, batch=batch)
    return by_digits(df, features, fractions)


def digit_cells(df: DataFrame, features: Sequence[str], scan: int, prefixes: Sequence[np.ndarray]) -> DataFrame:
    """``k, slot, digit, n``: values of column ``k`` by their next digit, below the ``slot``-th of its wanted prefixes.

    Digits are taken from the bits of a double, turned so that unsigned order is the order of values. Each task adds up its
    own cells first, so it sends at most one record per cell and never more than it has values.
    """
    names = [f"_v{i}" for i in range(len(features))]
    shift, digit_bits = 64 - DIGIT_BITS * (scan + 1), DIGIT_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sign, mask = np.uint64(1 << 63), np.uint64((1 << digit_bits) - 1)
        cells: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def merged(parts):
            keys, counts = (np.concatenate(x) for x in zip(*parts))
            keys, where = np.unique(keys, return_inverse=True)
            total = np.zeros(len(keys), np.int64)
            np.add.at(total, where, counts)
            return keys, total

        for batch in batches:
            for k, column in enumerate(batch.columns):
                # Adding zero makes -0.0 and 0.0 one value; NaN, whatever its sign, comes last.
                values = column.drop_null().to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
                values[np.isnan(values)] = np.nan
                bits = np.ascontiguousarray(values).view(np.uint64)
                key = np.where(bits & sign, ~bits, bits | sign)
                upper = key >> np.uint64(shift)
                wanted = prefixes[k]
                if scan:
                    above = upper >> np.uint64(digit_bits)
                    slot = np.searchsorted(wanted, above)
                    hit = (slot < len(wanted)) & (wanted[np.minimum(slot, len(wanted) - 1)] == above) if len(wanted) else np.zeros(len(above), bool)
                    slot, upper = slot[hit].astype(np.int64), upper[hit]
                else:
                    slot = np.zeros(len(upper), np.int64)
                cell = (slot << digit_bits) | (upper & mask).astype(np.int64)
                if len(cell):
                    parts = cells.setdefault(k, [])
                    parts.append(np.unique(cell, return_counts=True))
                    if len(parts) >= 16:
                        cells[k] = [merged(parts)]
        for k, parts in cells.items():
            keys, counts = merged(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(keys), k, np.int32)), pa.array((keys >> digit_bits).astype(np.int32)),
                 pa.array((keys & ((1 << digit_bits) - 1)).astype(np.int32)), pa.array(counts)], names=["k", "slot", "digit", "n"])

    wide = df.select(*[col(f).cast("double").alias(v) for f, v in zip(features, names)])
    return wide.mapInArrow(count, CELL_SCHEMA).groupBy("k", "slot", "digit").agg(F.sum("n").alias("n"))


def by_digits(df: DataFrame, features: Sequence[str], fractions: Sequence[float]) -> DataFrame:
    """Radix selection: every scan counts values by their next digit below the prefixes known so far, and the running counts
    tell which digit holds each wanted rank. The driver holds two prefixes per column and fraction, never values."""
    spark = df.sparkSession
    prefixes: list[np.ndarray] = [np.zeros(0, np.uint64)] * len(features)
    totals: dict[int, int] = {}
    # (column, rank in the column) -> (known prefix, ranks before it)
    known: dict[tuple[int, int], tuple[int, int]] = {}
    inside = Window.partitionBy("k", "slot")
    upto = inside.orderBy("digit").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    positions = [f"{end}((total - 1) * {number(q)})" for q in fractions for end in ("floor", "ceil")]
    for scan in range(SCANS):
        counted = digit_cells(df, features, scan, prefixes).withColumn("last", F.sum("n").over(upto))
        if scan == 0:
            asked = (counted.withColumn("total", F.sum("n").over(inside))
                     .withColumn("rank", F.explode(F.array_distinct(F.expr(f"array({', '.join(positions)})")))))
        else:
            wanted = [(k, int(np.searchsorted(prefixes[k], np.uint64(prefix))), rank - before, rank)
                      for (k, rank), (prefix, before) in known.items()]
            slots = spark.createDataFrame(wanted, "k int, slot int, place bigint, rank bigint")
            asked = counted.join(F.broadcast(slots), ["k", "slot"]).withColumn("total", F.lit(0))
        place = F.col("rank") if scan == 0 else F.col("place")
        found = asked.where((F.col("last") - F.col("n") <= place) & (place < F.col("last"))).select(
            "k", "rank", "digit", (F.col("last") - F.col("n")).alias("before"), "total").collect()
        if not found:
            break
        for r in found:
            prefix, before = known.get((r["k"], r["rank"]), (0, 0))
            known[(r["k"], r["rank"])] = ((prefix << DIGIT_BITS) | r["digit"], before + r["before"])
            if scan == 0:
                totals[r["k"]] = r["total"]
        of: dict[int, set[int]] = {}
        for (k, _), (prefix, _) in known.items():
            of.setdefault(k, set()).add(prefix)
        prefixes = [np.array(sorted(of.get(k, ())), np.uint64) for k in range(len(features))]

    def value(k: int, rank: int) -> float:
        key = np.array([known[(k, rank)][0]], np.uint64)
        sign = np.uint64(1 << 63)
        return float(np.where(key & sign, key ^ sign, ~key).view(np.float64)[0])

    out = []
    for k, total in sorted(totals.items()):
        quantiles = []
        for q in fractions:
            position = (total - 1) * q
            low, high = value(k, math.floor(position)), value(k, math.ceil(position))
            quantiles.append(low if low == high else low + (high - low) * (position - math.floor(position)))
        out.append((features[k], quantiles))
    return spark.createDataFrame(out, "feature string, quantiles array<double>")
