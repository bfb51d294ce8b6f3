"""Which columns stay: missing share, variance, duplicates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import col, quoted
from .columns import per_column
from .profile import constant_features, missing_shares, top_value_shares


def without_leading(df: DataFrame, count: int, keep: Sequence[str] = ()) -> DataFrame:
    """Drop the first ``count`` columns (survey metadata), except those named in ``keep``."""
    return df.select(*[col(c) for i, c in enumerate(df.columns) if i >= count or c in keep])


def sparse_features(df: DataFrame, features: Sequence[str], threshold: float = 0.5) -> list[str]:
    """Features missing in more than the given share of the rows."""
    over = missing_shares(df, features).where(F.col("missing_share") > threshold)
    found = {r["feature"] for r in over.collect()}
    return [f for f in features if f in found]


def low_variance_features(df: DataFrame, features: Sequence[str], threshold: float = 0.995) -> list[str]:
    """Constant features and those with one value in at least the given share of the rows."""
    if not features:
        return []
    flat = constant_features(df, features).select("feature")
    near = top_value_shares(df, features, threshold).select("feature")
    found = {r["feature"] for r in flat.union(near).collect()}
    return [f for f in features if f in found]


def column_print(key: str = "id") -> str:
    """Order-independent fingerprint of a column's (key, value) pairs, as an aggregate of ``{c}``."""
    return f"bit_xor(xxhash64({quoted(key)}, CAST({{c}} AS DOUBLE)))"


def print_groups(prints: Mapping[str, int]) -> list[list[str]]:
    """Columns with the same fingerprint, in column order."""
    groups: dict[int, list[str]] = {}
    for f, p in prints.items():
        groups.setdefault(p, []).append(f)
    return [g for g in groups.values() if len(g) > 1]


def first_pairs(groups: Sequence[Sequence[str]]) -> list[tuple[str, str]]:
    """Each group's first column with every other one."""
    return [(g[0], f) for g in groups for f in g[1:]]


def unequal_rows(a: str, b: str) -> str:
    """Number of rows in which two columns differ, missing being equal to missing."""
    return f"count_if(NOT (CAST({quoted(a)} AS DOUBLE) <=> CAST({quoted(b)} AS DOUBLE)))"


def settle_equals(df: DataFrame, groups: Sequence[Sequence[str]], unequal: Sequence[int] | None = None) -> dict[str, str]:
    """Map every column of the groups that equals an earlier one to it.

    Columns are compared with the first of their group only; those that differ from it despite their fingerprint form
    the next round's group. ``unequal`` may carry the first round's counts.
    """
    same: dict[str, str] = {}
    groups = [list(g) for g in groups]
    while groups:
        pairs = first_pairs(groups)
        if unequal is None:
            unequal = list(df.selectExpr(*[f"{unequal_rows(a, b)} AS p{i}" for i, (a, b) in enumerate(pairs)]).first())
        differ: dict[str, list[str]] = {}
        for (a, b), n in zip(pairs, unequal):
            if n == 0:
                same[b] = a
            else:
                differ.setdefault(a, []).append(b)
        groups, unequal = [g for g in differ.values() if len(g) > 1], None
    return same


def duplicate_features(df: DataFrame, features: Sequence[str], key: str = "id") -> dict[str, str]:
    """Map each column that equals an earlier one (missing equal to missing) to that column.

    One scan folds every column into a fingerprint; columns with equal fingerprints are then compared row by row.
    """
    if len(features) < 2:
        return {}
    found = {r["feature"]: r["print"] for r in per_column(df, features, {"print": column_print(key)}).collect()}
    return settle_equals(df, print_groups({f: found[f] for f in features}))


def without(features: Sequence[str], dropped: Sequence[str]) -> list[str]:
    gone = set(dropped)
    return [f for f in features if f not in gone]
