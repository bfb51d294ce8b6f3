"""Random oversampling of the positive class."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import draw_position
from .ranks import hash_index


def copies_needed(positives: int, negatives: int, target: float) -> int:
    """Extra positive rows so that positives make up the target share."""
    if positives == 0 or positives / (positives + negatives) >= target:
        return 0
    return max(0, math.ceil(target * negatives / (1.0 - target)) - positives)


def oversample(df: DataFrame, target: float = 0.5, seed: int = 1, key: str = "id", label: str = "y",
               counts: tuple[int, int] | None = None) -> DataFrame:
    """Add positive rows drawn with replacement until they make up the target share; adds ``copy`` (0 = original).

    Every draw is a hashed position, so draws join the positives' positions on an evenly spread key and the number of
    added rows is exact.
    """
    if counts is None:
        found = df.agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == -1).alias("n")).first()
        counts = (found["p"], found["n"])
    extra = copies_needed(*counts, target)
    originals = df.withColumn("copy", F.lit(0).cast("bigint"))
    if extra == 0:
        return originals
    draws = (df.sparkSession.range(extra)
             .select((F.col("id") + 1).alias("copy"), draw_position("id", seed, counts[0]).alias("_at")))
    # Only keys are numbered and matched with the draws; the wide rows are shuffled once, for the last join.
    positives = df.where(F.col(label) == 1)
    numbered = hash_index(positives.select(key), key, seed, output="_at")
    drawn = draws.join(numbered, "_at").select(key, "copy")
    copies = positives.join(drawn, key).select(*df.columns, "copy")
    return originals.unionByName(copies)
