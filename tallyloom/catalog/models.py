"""Losses, gradients, linear models, trees and forests."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar
from ..operators import linear, tree
from ..operators.columns import per_column
from ..operators.gradient import Fit
from .base import MODEL_FEATURES, f_model, f_orders, loss_sql, model_sql, orders_sql, query, r6_sql, rounded, sigmoid_sql
from .sqlgen import descent_sql, dot, forest_sql, gain_sql, impurity_sql, poisson_sql

WEIGHTS = {"x_bias": -1.2, "x_price": 0.8, "x_qty": -0.5, "x_disc": 0.3}
Z = dot(MODEL_FEATURES, [f"CAST({w} AS DOUBLE)" for w in WEIGHTS.values()])
MODEL = f"WITH base AS ({model_sql()}) "


@query("mse_loss", MODEL + f"SELECT round(sum(pow(y01 - {Z}, 2)) / (2 * count(*)), 6) AS loss FROM base")
def mse_loss(spark, sf):
    return rounded(linear.mse_loss(f_model(spark, sf), WEIGHTS, "y01"))


@query("sigmoid_score", MODEL + f"SELECT id, round({sigmoid_sql(Z)}, 6) AS score FROM base")
def sigmoid_score(spark, sf):
    return rounded(f_model(spark, sf).select("id", scalar.sigmoid(scalar.linear_score(WEIGHTS)).alias("score")))


@query("logistic_loss", MODEL + f"SELECT round(avg({loss_sql(Z)}), 6) AS loss FROM base")
def logistic_loss(spark, sf):
    return rounded(linear.logistic_loss(f_model(spark, sf), WEIGHTS))


@query("logistic_gradient", MODEL + ", g AS (SELECT " + ", ".join(
    f"avg(({sigmoid_sql(Z)} - y01) * {f}) AS {f}" for f in MODEL_FEATURES) + " FROM base) " + " UNION ALL ".join(
    f"SELECT '{f}' AS feature, {r6_sql(f)} AS gradient FROM g" for f in MODEL_FEATURES))
def logistic_gradient(spark, sf):
    return rounded(linear.logistic_gradient(f_model(spark, sf), WEIGHTS))


# --- gradient descent ------------------------------------------------------------------------------------------------


def weights_frame(spark, fits: list[tuple[str, Fit, bool]], features=MODEL_FEATURES):
    rows = [(name, f, float(w), float(fit.weighted_loss if weighted else fit.loss), fit.steps)
            for name, fit, weighted in fits for f, w in zip(features, fit.weights)]
    return rounded(spark.createDataFrame(rows, "model string, feature string, weight double, loss double, steps int"))


def weights_sql(name: str, models, steps: int, target: str = "y01", loss: str = "loss", features=MODEL_FEATURES) -> str:
    return ("WITH " + descent_sql(model_sql(), features, target, models, steps) + " "
            + " UNION ALL ".join(f"SELECT '{name}' AS model, '{f}' AS feature, {r6_sql(f'w{i}')} AS weight, round({loss}, 6) AS loss, "
                                 f"{steps} AS steps FROM final" for i, f in enumerate(features)))


LINEAR = ["x_bias", "x_qty", "x_disc"]


@query("linear_gd", weights_sql("linear", [linear.Model(gamma=0.2, patience=0, family="linear")], 12, "x_price", features=LINEAR))
def linear_gd(spark, sf):
    fit = linear.linear_gd(f_model(spark, sf), LINEAR, "x_price", 0.2, 12)
    return weights_frame(spark, [("linear", fit, False)], LINEAR)


def _minibatch_sql(steps: int, batches: int) -> str:
    from .base import hash_sql
    w = ["w0", "w1", "w2"]
    ctes = [f"data AS MATERIALIZED (SELECT *, r // greatest(CAST(ceil(n / {batches}) AS BIGINT), 1) AS batch FROM (SELECT *, row_number() OVER "
            f"(ORDER BY {hash_sql('id', 1)}) - 1 AS r, count(*) OVER () AS n FROM ({model_sql()})))",
            "s0 AS (SELECT CAST(0 AS DOUBLE) AS w0, CAST(0 AS DOUBLE) AS w1, CAST(0 AS DOUBLE) AS w2)"]
    error = f"({dot(LINEAR, w)} - x_price)"
    for k in range(1, steps + 1):
        moved = ", ".join(f"any_value({x}) - 0.1 * avg({error} * {f}) AS {x}" for x, f in zip(w, LINEAR))
        ctes.append(f"s{k} AS (SELECT {moved} FROM data, s{k - 1} WHERE batch = {(k - 1) % batches})")
    ctes.append(f"final AS (SELECT w0, w1, w2, avg(pow({error}, 2) / 2) AS loss FROM data, s{steps} GROUP BY ALL)")
    return "WITH " + ", ".join(ctes) + " " + " UNION ALL ".join(
        f"SELECT 'minibatch' AS model, '{f}' AS feature, {r6_sql(f'w{i}')} AS weight, round(loss, 6) AS loss, {steps} AS steps FROM final"
        for i, f in enumerate(LINEAR))


@query("linear_minibatch_sgd", _minibatch_sql(10, 4))
def linear_minibatch_sgd(spark, sf):
    fit = linear.linear_minibatch(f_model(spark, sf), LINEAR, "x_price", 0.1, 10, 4)
    return weights_frame(spark, [("minibatch", fit, False)], LINEAR)


def _solve_sql(penalty: float) -> str:
    return (MODEL + f", g AS (SELECT sum(x_qty * x_qty) + 2 * count(*) * CAST({penalty} AS DOUBLE) AS a, sum(x_qty * x_disc) AS b, "
            f"sum(x_disc * x_disc) + 2 * count(*) * CAST({penalty} AS DOUBLE) AS d, sum(x_qty * x_price) AS u, sum(x_disc * x_price) AS v FROM base) "
            f"SELECT 'x_qty' AS feature, {r6_sql('(d * u - b * v) / (a * d - b * b)')} AS weight FROM g UNION ALL "
            f"SELECT 'x_disc', {r6_sql('(a * v - b * u) / (a * d - b * b)')} FROM g")


@query("least_squares", _solve_sql(0.0))
def least_squares(spark, sf):
    w = linear.least_squares(f_model(spark, sf), ["x_qty", "x_disc"], "x_price")
    return rounded(spark.createDataFrame([("x_qty", float(w[0])), ("x_disc", float(w[1]))], "feature string, weight double"))


@query("ridge", _solve_sql(0.05))
def ridge(spark, sf):
    w = linear.ridge(f_model(spark, sf), ["x_qty", "x_disc"], "x_price", 0.05)
    return rounded(spark.createDataFrame([("x_qty", float(w[0])), ("x_disc", float(w[1]))], "feature string, weight double"))


def _logistic(name: str, model_name: str, steps: int, weighted: bool = False, **settings):
    model = linear.logistic_family(model_name, **settings)

    @query(name, weights_sql(model_name, [model], steps, loss="weighted_loss" if weighted else "loss"))
    def run(spark, sf):
        fit = linear.fit_logistic(f_model(spark, sf), MODEL_FEATURES, "y01", [model])[0]
        return weights_frame(spark, [(model_name, fit, weighted)])

    return run


_logistic("logistic_gd", "logistic", 12, gamma=0.5, max_iters=12, early_stopping=False)
_logistic("reg_logistic_gd", "reg_logistic", 12, gamma=0.5, penalty=0.01, max_iters=12, early_stopping=False)
# The weighted variants stop at the first small change: losses are checked after steps 1 and 11.
_logistic("logistic_weighted", "logistic_weighted", 11, True, gamma=0.3, max_iters=40, class_weights=(1.0, 3.0),
          early_stopping=False, tolerance=1.0)
_logistic("reg_logistic_weighted", "reg_logistic_weighted", 11, True, gamma=0.3, penalty=0.02, max_iters=40,
          class_weights=(0.5, 2.0), early_stopping=False, tolerance=1.0)
# Two small changes in a row, at steps 11 and 21, end the run.
_logistic("early_stopping_fit", "reg_logistic_weighted", 21, gamma=0.3, penalty=0.001, max_iters=60, class_weights=(1.0, 2.0),
          patience=2, tolerance=1.0)


# --- impurities and trees --------------------------------------------------------------------------------------------


@query("gini", f"SELECT custkey, round({impurity_sql('n0', 'n1')}, 6) AS gini FROM (SELECT custkey, count(*) FILTER (y = -1) AS n0, "
       f"count(*) FILTER (y = 1) AS n1 FROM ({orders_sql(False)}) GROUP BY custkey)")
def gini(spark, sf):
    counts = class_counts(f_orders(spark, sf, False), "custkey")
    return rounded(counts.select("custkey", scalar.gini("n0", "n1").alias("gini")))


@query("entropy", f"SELECT custkey, {r6_sql(impurity_sql('n0', 'n1', 'entropy'))} AS entropy FROM (SELECT custkey, count(*) FILTER (y = -1) AS n0, "
       f"count(*) FILTER (y = 1) AS n1 FROM ({orders_sql(False)}) GROUP BY custkey)")
def entropy(spark, sf):
    counts = class_counts(f_orders(spark, sf, False), "custkey")
    return rounded(counts.select("custkey", scalar.entropy("n0", "n1").alias("entropy")))


def class_counts(df, *keys):
    return df.groupBy(*keys).agg(F.count_if(F.col("y") == -1).alias("n0"), F.count_if(F.col("y") == 1).alias("n1"))


@query("information_gain", "SELECT order_month, " + ", ".join(
    f"{r6_sql(gain_sql('n', 'p', 'ln', 'lp', c))} AS {c}" for c in ("gini", "entropy"))
    + " FROM (SELECT order_month, count(*) AS n, count(*) FILTER (y = 1) AS p, count(*) FILTER (totalprice <= 250000) AS ln, "
      f"count(*) FILTER (totalprice <= 250000 AND y = 1) AS lp FROM ({orders_sql(False)}) GROUP BY order_month)")
def information_gain(spark, sf):
    left, y = F.col("totalprice") <= 250000, F.col("y")
    counts = f_orders(spark, sf, False).groupBy("order_month").agg(
        F.count_if(y == -1).alias("n0"), F.count_if(y == 1).alias("n1"),
        F.count_if(left & (y == -1)).alias("l0"), F.count_if(left & (y == 1)).alias("l1"))
    gains = [scalar.information_gain("n0", "n1", "l0", "l1", c).alias(c) for c in ("gini", "entropy")]
    return rounded(counts.select("order_month", *gains))


TREE_FEATURES = ["totalprice", "order_month", "status_code", "survey", "n_lines", "qty"]
TREE_CATEGORIES = ["status_code", "survey"]
TREE_SOURCE = f"SELECT *, (y + 1) / 2 AS y01, coalesce(sum_qty, 0) AS qty FROM ({orders_sql()})"


def f_tree(spark, sf):
    return f_orders(spark, sf).select("id", "y", ((F.col("y") + 1) / 2).alias("y01"), "totalprice", "order_month", "status_code",
                                      "survey", "n_lines", F.coalesce("sum_qty", F.lit(0.0)).alias("qty"))


ONE = {0: list(range(len(TREE_FEATURES)))}
NODES = ("SELECT tree, node, depth, feature, round(threshold, 6) AS threshold, is_categorical, left_node, right_node, prediction, n, n_pos, "
         "round(gain, 6) AS gain FROM nodes")


def single(depth: int, criterion: str = "gini") -> tree.TreeOptions:
    return tree.TreeOptions(depth, 20, 10, criterion)


@query("best_split", "WITH " + forest_sql(TREE_SOURCE, TREE_FEATURES, ONE, single(1, "entropy"), TREE_CATEGORIES)
       + " SELECT feature, round(threshold, 6) AS threshold, is_categorical, round(gain, 6) AS gain FROM nodes WHERE node = 0")
def best_split(spark, sf):
    model = tree.fit_tree(f_tree(spark, sf), TREE_FEATURES, "y01", single(1, "entropy"), TREE_CATEGORIES)
    return rounded(model.to_frame(spark).where("node = 0").select("feature", "threshold", "is_categorical", "gain"))


def _fit_single(spark, sf):
    return tree.fit_tree(f_tree(spark, sf), TREE_FEATURES, "y01", single(4), TREE_CATEGORIES)


SINGLE = "WITH " + forest_sql(TREE_SOURCE, TREE_FEATURES, ONE, single(4), TREE_CATEGORIES) + " "


DEEP, CUT = tree.TreeOptions(6, 20, 10), tree.TreeOptions(6, 20, 10, max_rows_in_deep_node=150)


def _grown(spark, sf, options):
    return rounded(tree.fit_tree(f_tree(spark, sf), TREE_FEATURES, "y01", options, TREE_CATEGORIES).to_frame(spark))


@query("decision_tree_deep", "WITH " + forest_sql(TREE_SOURCE, TREE_FEATURES, ONE, DEEP, TREE_CATEGORIES) + " " + NODES)
def decision_tree_deep(spark, sf):
    return _grown(spark, sf, DEEP)


@query("decision_tree_deep_cut", "WITH " + forest_sql(TREE_SOURCE, TREE_FEATURES, ONE, CUT, TREE_CATEGORIES) + " " + NODES)
def decision_tree_deep_cut(spark, sf):
    return _grown(spark, sf, CUT)


@query("decision_tree", SINGLE + NODES)
def decision_tree(spark, sf):
    return rounded(_fit_single(spark, sf).to_frame(spark))


@query("tree_importance", SINGLE + ", g AS (SELECT feature, sum(gain) AS g FROM nodes WHERE feature IS NOT NULL GROUP BY feature) "
       "SELECT f AS feature, round(coalesce(g, 0) / (SELECT sum(g) FROM g), 6) AS importance FROM subsets LEFT JOIN g ON f = feature")
def tree_importance(spark, sf):
    return rounded(tree.importances(_fit_single(spark, sf), spark).select("feature", "importance"))


@query("tree_predict", SINGLE + "SELECT id, CAST(vote AS DOUBLE) AS probability, vote AS label FROM leaf_rows")
def tree_predict(spark, sf):
    model = _fit_single(spark, sf)
    scored = f_tree(spark, sf).select("id", tree.probability(model).alias("probability"))
    return scored.withColumn("label", tree.class_vote(F.col("probability")))


@query("bootstrap_weights", "SELECT tree, w AS weight, count(*) AS n, sum(o_orderkey) AS ids FROM (SELECT o_orderkey, tree, "
       + poisson_sql("o_orderkey", "(7000 + tree)") + " AS w FROM orders, range(3) t(tree)) GROUP BY ALL")
def bootstrap_weights(spark, sf):
    trees = F.explode(F.array(*[F.lit(t) for t in range(3)])).alias("tree")
    drawn = tree.with_draws(f_orders(spark, sf, False).select("id", trees), 7, "weight", drawn_only=False)
    return (drawn.groupBy("tree", "weight")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids")))


TREES, SEED = 5, 3
SUBSETS = {t: tree.feature_subset(len(TREE_FEATURES), 2, SEED, t) for t in range(TREES)}
FOREST_OPTIONS = tree.TreeOptions(3, 20, 10)
FOREST = "WITH " + forest_sql(TREE_SOURCE, TREE_FEATURES, SUBSETS, FOREST_OPTIONS, TREE_CATEGORIES, SEED) + " "


@query("feature_subsets", f"WITH base AS (SELECT * FROM ({TREE_SOURCE})), s AS (SELECT * FROM (VALUES "
       + ", ".join(f"({t}, '{TREE_FEATURES[f]}')" for t, fs in SUBSETS.items() for f in fs) + ") t(tree, feature)), long AS (SELECT * FROM "
       f"(SELECT id, {', '.join(TREE_FEATURES)} FROM base) UNPIVOT (value FOR feature IN ({', '.join(TREE_FEATURES)}))) "
       f"SELECT tree, feature, CAST(sum(w) AS BIGINT) AS drawn, round(sum(w * value) / sum(w), 4) AS mean FROM (SELECT *, "
       + poisson_sql("id", f"({SEED * 1000} + tree)") + " AS w FROM long JOIN s USING (feature)) GROUP BY tree, feature")
def feature_subsets(spark, sf):
    df, parts = f_tree(spark, sf), []
    for t in range(TREES):
        chosen = [TREE_FEATURES[i] for i in tree.feature_subset(len(TREE_FEATURES), tree.subset_size("sqrt", len(TREE_FEATURES)), SEED, t)]
        parts.append(per_column(tree.with_draws(df.withColumn("tree", F.lit(t)), SEED), chosen, {
            "drawn": "CAST(sum(w) AS BIGINT)", "mean": "sum(w * {c}) / sum(w)"}).withColumn("tree", F.lit(t)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return rounded(out, 4)


def _fit_forest(spark, sf):
    return tree.fit_forest(f_tree(spark, sf), TREE_FEATURES, "y01", TREES, "sqrt", FOREST_OPTIONS, TREE_CATEGORIES, SEED)


@query("random_forest", FOREST + NODES)
def random_forest(spark, sf):
    return rounded(_fit_forest(spark, sf).to_frame(spark))


@query("oob_score", FOREST + ", v AS (SELECT id, y01, count(*) AS n, sum(vote) AS p FROM leaf_rows WHERE w = 0 GROUP BY id, y01) "
       "SELECT count(*) AS rows, round(avg(CASE WHEN (CASE WHEN 2 * p > n THEN 1 ELSE 0 END) = y01 THEN 1 ELSE 0 END), 6) AS oob_score FROM v")
def oob_score(spark, sf):
    return rounded(tree.oob_score(f_tree(spark, sf), _fit_forest(spark, sf), "y01"))


@query("forest_importance", FOREST + ", g AS (SELECT tree, feature, sum(gain) AS g FROM nodes WHERE feature IS NOT NULL GROUP BY ALL), "
       "t AS (SELECT tree, sum(g) AS g FROM g GROUP BY tree), i AS (SELECT feature, sum(g.g / t.g) AS g FROM g JOIN t USING (tree) GROUP BY feature) "
       "SELECT name AS feature, round(coalesce(g, 0) / (SELECT sum(g) FROM i), 6) AS importance FROM (SELECT unnest(["
       + ", ".join(f"'{f}'" for f in TREE_FEATURES) + "]) AS name) LEFT JOIN i ON name = feature")
def forest_importance(spark, sf):
    return rounded(tree.forest_importances(_fit_forest(spark, sf), spark))


@query("forest_predict", FOREST + "SELECT id, round(avg(vote), 6) AS probability, CASE WHEN avg(vote) > 0.5 THEN 1 ELSE 0 END AS label FROM leaf_rows GROUP BY id")
def forest_predict(spark, sf):
    scored = f_tree(spark, sf).select("id", tree.probability(_fit_forest(spark, sf)).alias("probability"))
    return rounded(scored.withColumn("label", tree.class_vote(F.col("probability"))))
