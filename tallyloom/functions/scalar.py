"""Row-level expressions: scores, losses, labels, impurities, survey codes.

Expressions that are built for many columns are written as SQL text: one text is parsed in one call, where the same
expression made of Column objects takes a call per operator.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(name: str) -> Column:
    """Column by exact name, also when the name holds dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def quoted(name: str) -> str:
    """A column name as it is written in SQL text."""
    return "`" + name.replace("`", "``") + "`"


def text(value: str) -> str:
    """A string literal in SQL text."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def number(value: float) -> str:
    """A double literal in SQL text."""
    return f"{float(value)!r}D"


def linear_score(weights: Mapping[str, float]) -> Column:
    """Dot product of the named columns with their weights; null as soon as one column is null."""
    return F.expr(" + ".join(f"CAST({quoted(c)} AS DOUBLE) * {number(w)}" for c, w in weights.items()) or "0D")


def sigmoid(z: Column) -> Column:
    """Logistic function that never exponentiates a positive number."""
    small = F.exp(-F.abs(z))
    return F.when(z >= 0, 1.0 / (1.0 + small)).otherwise(small / (1.0 + small))


def log_loss(y01: Column, z: Column) -> Column:
    """Negative log likelihood of one row from its raw score."""
    return F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z))) - y01 * z


def label_01(y: Column) -> Column:
    return (y + 1) / 2


def signed_label(probability: Column, threshold: float) -> Column:
    return F.when(probability >= threshold, 1).otherwise(-1)


def class_weight(y: Column, weights: Mapping[int, float]) -> Column:
    """Weight of a row's class; classes that are not listed weigh 1."""
    out = F.lit(1.0)
    for label, weight in weights.items():
        out = F.when(y == label, float(weight)).otherwise(out)
    return out


def _gini(n0: str, n1: str) -> str:
    n = f"({n0} + {n1})"
    return f"(CASE WHEN {n} > 0 THEN 1D - ({n0} / {n}) * ({n0} / {n}) - ({n1} / {n}) * ({n1} / {n}) ELSE 0D END)"


def _entropy(n0: str, n1: str) -> str:
    n = f"({n0} + {n1})"
    terms = " + ".join(f"({k} / {n}) * log2({k} / {n} + 1e-10D)" for k in (n0, n1))
    return f"(CASE WHEN {n} > 0 THEN -({terms}) ELSE 0D END)"


def _impurity(criterion: str):
    return _gini if criterion == "gini" else _entropy


def gini(n0: str, n1: str) -> Column:
    """Gini impurity from the class counts (column names or SQL text)."""
    return F.expr(_gini(n0, n1))


def entropy(n0: str, n1: str) -> Column:
    return F.expr(_entropy(n0, n1))


def gain_text(n0: str, n1: str, left0: str, left1: str, criterion: str = "gini") -> str:
    """Impurity of a node minus the size-weighted impurity of its two children; anything but gini means entropy."""
    impurity = _impurity(criterion)
    n, left = f"({n0} + {n1})", f"({left0} + {left1})"
    inside = f"{left} / {n} * {impurity(left0, left1)}"
    outside = f"({n} - {left}) / {n} * {impurity(f'({n0} - {left0})', f'({n1} - {left1})')}"
    return f"(CASE WHEN {n} > 0 THEN {impurity(n0, n1)} - ({inside} + {outside}) ELSE 0D END)"


def information_gain(n0: str, n1: str, left0: str, left1: str, criterion: str = "gini") -> Column:
    return F.expr(gain_text(n0, n1, left0, left1, criterion))


def survey_code_text(v: str) -> str:
    return f"CAST(CAST(abs({v}) AS BIGINT) AS STRING) RLIKE '^([70]+|[90]+)$'"


def is_survey_code(v: str) -> Column:
    """True when the integer part is written with 7 and 0 only, or with 9 and 0 only."""
    return F.expr(survey_code_text(v))
