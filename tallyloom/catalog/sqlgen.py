"""SQL statements that spell out iterative operators step by step."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from ..functions.hashing import POISSON_ONE_CDF
from ..operators.gradient import Model
from ..operators.tree import THRESHOLD_POINTS, TreeOptions
from .base import hash_sql, loss_sql, sigmoid_sql


def dot(features: Sequence[str], weights: Sequence[str]) -> str:
    return "(" + " + ".join(f"{f} * {w}" for f, w in zip(features, weights)) + ")"


def descent_sql(source: str, features: Sequence[str], target: str, models: Sequence[Model], steps: int,
                fold: str = "-1") -> str:
    """CTEs ``data`` and ``s0 .. s<steps>`` (one row per model: ``m, w0, w1, ...``) and ``final`` with the losses."""
    d = len(features)
    w = [f"w{i}" for i in range(d)]
    settings = "m, gamma, pen, c0, c1, held"
    rows = ", ".join(f"({i}, CAST({m.gamma} AS DOUBLE), CAST({m.penalty} AS DOUBLE), CAST({m.weights[0]} AS DOUBLE), "
                     f"CAST({m.weights[1]} AS DOUBLE), {m.held_out})" for i, m in enumerate(models))
    linear = models[0].family == "linear"
    z = dot([f"b.{f}" for f in features], [f"s.{x}" for x in w])
    residual = f"({z} - b.{target})" if linear else (
        f"(({sigmoid_sql('z')} - {target}) * CASE WHEN {target} = 1 THEN c1 ELSE c0 END)")
    ctes = [f"data AS MATERIALIZED (SELECT *, {fold} AS fold_no FROM ({source}))",
            f"models AS (SELECT * FROM (VALUES {rows}) t({settings}))",
            f"s0 AS (SELECT {settings}, " + ", ".join(f"CAST(0 AS DOUBLE) AS {x}" for x in w) + " FROM models)"]
    for k in range(1, steps + 1):
        inner = (f"SELECT s.*, {', '.join('b.' + f for f in features)}, b.{target}, {z} AS z FROM s{k - 1} s "
                 f"JOIN data b ON s.held < 0 OR b.fold_no <> s.held")
        r = f"(z - {target})" if linear else residual
        sums = ", ".join(f"{x} - gamma * (sum({r} * {f}) / count(*) + 2 * pen * {x}) AS {x}" for x, f in zip(w, features))
        ctes.append(f"s{k} AS (SELECT {settings}, {sums} FROM ({inner}) GROUP BY {settings}, {', '.join(w)})")
    loss = f"({z} - b.{target}) * ({z} - b.{target}) / 2" if linear else loss_sql(z, f"b.{target}")
    cost = f"CASE WHEN b.{target} = 1 THEN c1 ELSE c0 END"
    ctes.append(f"final AS (SELECT {', '.join('s.' + c for c in [*settings.split(', '), *w])}, avg({loss}) AS loss, "
                f"avg({loss} * {cost}) AS weighted_loss FROM s{steps} s JOIN data b ON s.held < 0 OR b.fold_no <> s.held "
                f"GROUP BY ALL)")
    return ", ".join(ctes)


def fold_sql(source: str, k: int, seed: int, group: str | None = "y") -> str:
    """Rows of ``source`` with their fold."""
    part = f"PARTITION BY {group}" if group else ""
    return (f"SELECT * EXCLUDE (r, n), CAST(CASE WHEN r < (n % {k}) * (n // {k} + 1) THEN r // (n // {k} + 1) "
            f"ELSE n % {k} + (r - (n % {k}) * (n // {k} + 1)) // greatest(n // {k}, 1) END AS INTEGER) AS fold "
            f"FROM (SELECT *, row_number() OVER ({part} ORDER BY {hash_sql('id', seed)}) - 1 AS r, "
            f"count(*) OVER ({part}) AS n FROM ({source}))")


def curve_sql(source: str, group: Sequence[str] = ()) -> str:
    """CTEs ``steps``, ``curve``, ``points`` (one row per distinct score) and ``area`` over ``group..., y, score``."""
    g = "".join(f"{c}, " for c in group)
    part = f"PARTITION BY {', '.join(group)}" if group else ""
    by = f"GROUP BY {', '.join(group)}" if group else ""
    return (f"steps AS (SELECT {g}score, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y <> 1) AS neg FROM {source} GROUP BY ALL), "
            f"curve AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, greatest(sum(pos) OVER ({part}), 1) AS p, "
            f"greatest(sum(neg) OVER ({part}), 1) AS q FROM steps WINDOW w AS ({part} ORDER BY score DESC)), "
            f"points AS (SELECT {g}score, pos, neg, tp / p AS tpr, fp / q AS fpr, tp / (tp + fp) AS prec, "
            "(tp - pos) / p AS tpr0, (fp - neg) / q AS fpr0, "
            "CASE WHEN tp - pos + fp - neg > 0 THEN (tp - pos) / (tp - pos + fp - neg) ELSE tp / (tp + fp) END AS prec0 FROM curve), "
            f"area AS (SELECT {g}sum((fpr - fpr0) * (tpr + tpr0) / 2) AS roc_auc, "
            f"sum((tpr - tpr0) * (prec + prec0) / 2) AS pr_auc FROM points {by})")


def metrics_sql(source: str, group: Sequence[str] = (), actual: str = "y", predicted: str = "y_hat") -> str:
    """Confusion counts and the figures derived from them."""
    g = "".join(f"{c}, " for c in group)
    by = f"GROUP BY {', '.join(group)}" if group else ""

    def n(a: int, p: int) -> str:
        return f"count(*) FILTER ({actual} = {a} AND {predicted} = {p})"

    return (f"SELECT {g}tp, fp, fn, tn, precision, recall, 2 * precision * recall / (precision + recall + 1e-12) AS f1, accuracy FROM ("
            f"SELECT *, tp / (tp + fp + 1e-12) AS precision, tp / (tp + fn + 1e-12) AS recall, (tp + tn) / (tp + fp + fn + tn) AS accuracy FROM ("
            f"SELECT {g}{n(1, 1)} AS tp, {n(-1, 1)} AS fp, {n(1, -1)} AS fn, {n(-1, -1)} AS tn FROM {source} {by}))")


def poisson_sql(key: str, seed: str) -> str:
    u = f"({hash_sql(key, seed)} / CAST(2147483647 AS DOUBLE))"
    return "(" + " + ".join(f"CASE WHEN {u} >= CAST({c} AS DOUBLE) THEN 1 ELSE 0 END" for c in POISSON_ONE_CDF) + ")"


def impurity_sql(n0: str, n1: str, criterion: str = "gini") -> str:
    n = f"(({n0}) + ({n1}))"
    if criterion == "gini":
        body = f"1 - pow(({n0}) / {n}, 2) - pow(({n1}) / {n}, 2)"
    else:
        body = f"-(({n0}) / {n} * log2(({n0}) / {n} + 1e-10) + ({n1}) / {n} * log2(({n1}) / {n} + 1e-10))"
    return f"(CASE WHEN {n} > 0 THEN {body} ELSE 0 END)"


def gain_sql(n: str, p: str, ln: str, lp: str, criterion: str = "gini") -> str:
    """Gain of a split from the node's rows and positives and those of its left side."""
    left = impurity_sql(f"{ln} - {lp}", lp, criterion)
    right = impurity_sql(f"({n} - {ln}) - ({p} - {lp})", f"{p} - {lp}", criterion)
    return f"({impurity_sql(f'{n} - {p}', p, criterion)} - {ln} / {n} * {left} - ({n} - {ln}) / {n} * {right})"


def forest_sql(source: str, features: Sequence[str], subsets: Mapping[int, Sequence[int]], options: TreeOptions,
               categorical: Sequence[str] = (), seed: int | None = None, held_out: str | None = None) -> str:
    """CTEs that grow trees level by level: ``nodes`` is the node table, ``leaf_rows`` has every row's vote per tree.

    Rows that meet the condition ``held_out`` (on the column ``fold``) get votes but no weight.
    """
    points = sorted({q for qs in THRESHOLD_POINTS.values() for q in qs})
    names = "[" + ", ".join(f"'{f}'" for f in features) + "]"
    cat = ", ".join(f"'{f}'" for f in categorical) or "''"
    chosen = ", ".join(f"({t}, '{features[f]}')" for t, fs in subsets.items() for f in fs)
    weight = "1" if seed is None else poisson_sql("id", f"({seed * 1000} + tree)")  # the seed of trees below 1000
    if held_out:
        weight = f"CASE WHEN {held_out} THEN 0 ELSE {weight} END"
    columns = ", ".join(features)
    ctes = [f"data AS MATERIALIZED (SELECT id, CAST(y01 AS INTEGER) AS y01, {columns}{', fold' if held_out else ''} FROM ({source}))",
            f"subsets AS (SELECT * FROM (VALUES {chosen}) t(tree, f))",
            f"rows0 AS MATERIALIZED (SELECT *, {weight} AS w FROM (SELECT DISTINCT tree, CAST(0 AS BIGINT) AS node FROM subsets), data)"]
    leaf = options.min_samples_leaf
    for d in range(options.max_depth + 1):
        ctes.append(f"size{d} AS (SELECT tree, node, CAST(sum(w) AS BIGINT) AS n, CAST(sum(w * y01) AS BIGINT) AS p FROM rows{d} GROUP BY ALL)")
        if d == options.max_depth:
            ctes.append(f"best{d} AS MATERIALIZED (SELECT tree, node, n, p, CAST(NULL AS VARCHAR) AS f, CAST(NULL AS DOUBLE) AS at_v, "
                        f"false AS is_cat, CAST(NULL AS DOUBLE) AS gain FROM size{d} WHERE false)")
            continue
        limit = options.max_rows_in_deep_node
        depth_rule = f"AND n <= {limit}" if limit is not None and d > options.deep else ""
        picks = {k: "[" + ", ".join(f"qs[{points.index(q) + 1}]" for q in qs) + "]" for k, qs in THRESHOLD_POINTS.items()}
        choose = " ".join(f"WHEN k {'>=' if k == 5 else '='} {k} THEN {v}" for k, v in picks.items())
        ctes += [
            f"open{d} AS (SELECT * FROM size{d} WHERE n >= {max(options.min_samples_split, 2 * leaf)} AND p > 0 AND p < n {depth_rule})",
            f"long{d} AS MATERIALIZED (SELECT tree, node, o.n AS size, o.p AS size_p, f, v, w, y01 FROM "
            f"(SELECT * FROM (SELECT tree, node, w, y01, {columns} FROM rows{d} WHERE w > 0) UNPIVOT (v FOR f IN ({columns}))) "
            f"JOIN subsets USING (tree, f) JOIN open{d} o USING (tree, node))",
            f"cnt{d} AS (SELECT tree, node, size, size_p, f, v, sum(w) AS n, sum(w * y01) AS p FROM long{d} GROUP BY ALL)",
            f"thr{d} AS (SELECT tree, node, size, size_p, f, unnest(CASE {choose} END) AS at_v FROM (SELECT tree, node, size, size_p, f, "
            f"count(DISTINCT v) AS k, quantile_cont(v, {points}) AS qs FROM long{d}, unnest(range(w)) WHERE f NOT IN ({cat}) GROUP BY ALL))",
            f"cand{d} AS (SELECT tree, node, size, size_p, f, v AS at_v, true AS is_cat, n AS ln, p AS lp FROM cnt{d} WHERE f IN ({cat}) UNION ALL "
            f"SELECT t.tree, t.node, t.size, t.size_p, t.f, t.at_v, false, sum(c.n), sum(c.p) FROM (SELECT DISTINCT * FROM thr{d}) t JOIN cnt{d} c "
            f"ON c.tree = t.tree AND c.node = t.node AND c.f = t.f AND c.v <= t.at_v GROUP BY ALL)",
            f"gain{d} AS (SELECT *, {gain_sql('size', 'size_p', 'ln', 'lp', options.criterion)} AS gain FROM cand{d} "
            f"WHERE ln >= {leaf} AND size - ln >= {leaf})",
            f"best{d} AS MATERIALIZED (SELECT tree, node, size AS n, size_p AS p, f, at_v, is_cat, gain FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY tree, node ORDER BY round(gain, 12) DESC, list_position({names}, f), at_v) AS place FROM gain{d} "
            f"WHERE round(gain, 12) > 0) WHERE place = 1)",
            f"rows{d + 1} AS MATERIALIZED (SELECT r.* REPLACE (2 * r.node + CASE WHEN CASE WHEN is_cat THEN val = at_v ELSE val <= at_v END "
            f"THEN 1 ELSE 2 END AS node) FROM (SELECT r.*, b.is_cat, b.at_v, CASE b.f "
            + " ".join(f"WHEN '{f}' THEN r.{f}" for f in features)
            + f" END AS val FROM rows{d} r JOIN best{d} b USING (tree, node)) r)".replace("r.* REPLACE", "r.* REPLACE"),
        ]
        ctes[-1] = ctes[-1].replace("SELECT r.* REPLACE", "SELECT r.* EXCLUDE (is_cat, at_v, val) REPLACE")
    levels = range(options.max_depth + 1)
    vote = "CASE WHEN 2 * s.p > s.n THEN 1 ELSE 0 END"
    ctes.append("nodes AS (" + " UNION ALL ".join(
        f"SELECT s.tree, s.node, {d} AS depth, b.f AS feature, b.at_v AS threshold, CASE WHEN b.f IS NOT NULL THEN b.is_cat END AS is_categorical, "
        f"CASE WHEN b.f IS NOT NULL THEN 2 * s.node + 1 END AS left_node, CASE WHEN b.f IS NOT NULL THEN 2 * s.node + 2 END AS right_node, "
        f"CASE WHEN b.f IS NULL THEN {vote} END AS prediction, s.n, s.p AS n_pos, b.gain FROM size{d} s LEFT JOIN best{d} b USING (tree, node)"
        for d in levels) + ")")
    ctes.append("leaf_rows AS (" + " UNION ALL ".join(
        f"SELECT r.id, r.tree, r.w, r.y01, {vote} AS vote FROM rows{d} r JOIN size{d} s USING (tree, node) "
        f"ANTI JOIN best{d} b USING (tree, node)" for d in levels) + ")")
    return ", ".join(ctes)
