"""Deterministic k-fold assignment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import id_hash
from ..functions.scalar import quoted
from .ranks import hashes_at


def fold_starts(rows: int, k: int) -> list[int]:
    """First rank of folds 1 .. k-1 when ``rows`` ranks are cut into k runs, the first ``rows mod k`` one longer."""
    small, longer = divmod(rows, k)
    return [f * small + min(f, longer) for f in range(1, k)]


def assign_folds(df: DataFrame, k: int, seed: int = 1, label: str | None = "y", key: str = "id", output: str = "fold",
                 slices: int | None = None) -> DataFrame:
    """Cut a hashed order (per class if a label is given) into k runs of equal length, give or take one row.

    The hash values at the cuts are looked up first, at most k - 1 per class; a row's fold then follows from its own
    hash, so the assignment is a projection and the rows stay where they are.
    """
    group = [label] if label else []
    sizes = {tuple(r[g] for g in group): r["_n"] for r in df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).collect()}
    # With fewer rows than folds the last folds stay empty.
    ranks = {which: [s for s in fold_starts(n, k) if s < n] for which, n in sizes.items()}
    cuts = hashes_at(df, key, seed, ranks, group, slices)
    hashed = df.withColumn("_hash", id_hash(quoted(key), seed))
    fold = F.lit(None)
    for which, starts in cuts.items():
        passed = F.expr("int(" + " + ".join(["0", *[f"CASE WHEN _hash >= {h} THEN 1 ELSE 0 END" for h in starts]]) + ")")
        fold = F.when(F.col(label) == which[0], passed).otherwise(fold) if label else passed
    return hashed.withColumn(output, fold).select(*df.columns, output)
