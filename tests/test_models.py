"""Gradient models and trees against small NumPy restatements of their formulas."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.functions import scalar
from tallyloom.functions.hashing import POISSON_ONE_CDF, PRIME, hash_number
from tallyloom.operators import gradient, linear, tree

from conftest import frame

N = None


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(160, 3))
    y = (x[:, 0] - 0.5 * x[:, 1] + rng.normal(size=160) > 0.7).astype(float)
    return x, y, np.arange(160) % 4


@pytest.fixture(scope="module")
def df(spark, data):
    x, y, fold = data
    return frame(spark, {"id": range(160), "a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "y01": y, "fold": fold}).cache()


XS = ["a", "b", "c"]


def sig(z):
    return 1 / (1 + np.exp(-z))


def nll(x, y, w):
    z = x @ w
    return np.mean(np.logaddexp(0, z) - y * z)


def descend(x, y, m: gradient.Model):
    """One model, one step at a time."""
    w, previous, quiet, steps = np.zeros(x.shape[1]), np.inf, 0, 0
    cost = np.where(y == 1, m.weights[1], m.weights[0])
    for i in range(m.max_iters):
        r = sig(x @ w) - y if m.family == "logistic" else x @ w - y
        w = w - m.gamma * (x.T @ (r * (cost if m.family == "logistic" else 1)) / len(y) + 2 * m.penalty * w)
        steps += 1
        if m.patience and i % m.check_every == 0:
            now = nll(x, y, w)
            quiet = quiet + 1 if abs(previous - now) < m.tolerance else 0
            previous = now
            if quiet >= m.patience:
                break
    return w, steps, cost


def test_many_models_in_one_pass_equal_separate_fits(df, data):
    x, y, fold = data
    models = [
        linear.logistic_family("logistic", 0.5, max_iters=15, early_stopping=False),
        linear.logistic_family("reg_logistic", 0.3, 0.02, 25, early_stopping=False, held_out=1),
        linear.logistic_family("logistic_weighted", 0.4, max_iters=40, class_weights=(0.7, 2.0), early_stopping=False, tolerance=0.1),
        linear.logistic_family("reg_logistic_weighted", 0.4, 0.01, 80, (1.0, 3.0), patience=2, tolerance=2e-3, held_out=2),
        linear.logistic_family("reg_logistic", 0.2, 0.01, 0),
    ]
    fits = linear.fit_logistic(df, XS, "y01", models, "fold")
    stopped_early = 0
    for m, fit in zip(models, fits):
        seen = fold != m.held_out if m.held_out >= 0 else np.ones(len(y), bool)
        w, steps, cost = descend(x[seen], y[seen], m)
        np.testing.assert_allclose(fit.weights, w, atol=1e-12)
        assert fit.steps == steps
        assert fit.loss == pytest.approx(nll(x[seen], y[seen], w))
        z = x[seen] @ w
        assert fit.weighted_loss == pytest.approx(np.mean(cost * (np.logaddexp(0, z) - y[seen] * z)))
        stopped_early += steps < m.max_iters
    assert stopped_early == 2


def test_partial_sums_merge_over_many_partitions(spark, df, data, monkeypatch):
    x, y, _ = data
    monkeypatch.setattr(gradient, "DIRECT_PARTIALS", 2)
    fit = gradient.fit_models(df.repartition(9), XS, "y01", [gradient.Model(gamma=0.5, max_iters=3, patience=0)])[0]
    np.testing.assert_allclose(fit.weights, descend(x, y, gradient.Model(gamma=0.5, max_iters=3, patience=0))[0], atol=1e-12)


def test_linear_models(df, data):
    x, y, _ = data
    fit = linear.linear_gd(df, XS, "y01", 0.3, 9)
    w = descend(x, y, gradient.Model(gamma=0.3, max_iters=9, patience=0, family="linear"))[0]
    np.testing.assert_allclose(fit.weights, w, atol=1e-12)
    assert fit.loss == pytest.approx(np.sum((y - x @ w) ** 2) / (2 * len(y)))
    np.testing.assert_allclose(linear.least_squares(df, XS, "y01"), np.linalg.lstsq(x, y, rcond=None)[0], atol=1e-10)
    want = np.linalg.solve(x.T @ x + 2 * len(y) * 0.1 * np.eye(3), x.T @ y)
    np.testing.assert_allclose(linear.ridge(df, XS, "y01", 0.1), want, atol=1e-10)
    xtx, xty, n = gradient.gram(df, XS, "y01")
    np.testing.assert_allclose(xtx, x.T @ x, atol=1e-10)
    np.testing.assert_allclose(xty, x.T @ y, atol=1e-10)
    assert n == len(y)


def test_singular_least_squares_gives_the_smallest_solution(spark, data):
    x, y, _ = data
    df = frame(spark, {"a": x[:, 0], "twin": x[:, 0], "t": y})
    want = np.linalg.pinv(np.c_[x[:, 0], x[:, 0]]) @ y
    np.testing.assert_allclose(linear.least_squares(df, ["a", "twin"], "t"), want, atol=1e-8)


@pytest.mark.parametrize("partitions", [1, 5, 20])
def test_least_squares_of_nearly_dependent_columns(spark, partitions):
    rng = np.random.default_rng(11)
    left, right = np.linalg.qr(rng.normal(size=(4000, 6)))[0], np.linalg.qr(rng.normal(size=(6, 6)))[0]
    x = left @ np.diag(np.logspace(0, -9, 6)) @ right
    assert np.linalg.cond(x) > 9e8
    w = np.array([1.0, -2.0, 3.0, 0.5, -1.5, 2.5])
    y = x @ w
    names = [f"x{i}" for i in range(6)]
    df = frame(spark, {**{n: x[:, i].tolist() for i, n in enumerate(names)}, "t": y.tolist()}, partitions)
    np.testing.assert_allclose(linear.least_squares(df, names, "t"), np.linalg.lstsq(x, y, rcond=None)[0], rtol=1e-6)
    np.testing.assert_allclose(linear.least_squares(df, names, "t"), w, rtol=1e-6)
    # Products of these columns have lost the smallest direction altogether.
    assert np.abs(np.linalg.lstsq(x.T @ x, x.T @ y, rcond=None)[0] - w).max() > 1e-3


def test_factors_are_combined_on_executors(spark):
    from tallyloom.operators import factor
    rng = np.random.default_rng(12)
    x = rng.normal(size=(300, 3)) * [1.0, 1e9, 1e-9]
    df = frame(spark, {"a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "t": x @ [1.0, 1e-9, 1e9]}, 70)
    r, rows = factor.triangle(df, ["a", "b", "c"], "t")
    table = np.c_[x, x @ [1.0, 1e-9, 1e9]]
    assert rows == 300 and r.shape == (4, 4)
    np.testing.assert_allclose(r.T @ r, table.T @ table, rtol=1e-9)
    np.testing.assert_allclose(factor.solve_triangle(r), [1.0, 1e-9, 1e9], rtol=1e-9)
    empty, none = factor.triangle(df.limit(0), ["a", "b", "c"], "t")
    assert none == 0 and not empty.any() and not factor.solve_triangle(empty).any() and not factor.solve_triangle(empty, 1.0).any()


def test_minibatch_steps(df, data):
    x, y, _ = data
    order = sorted(range(160), key=lambda i: hash_number(i, 1))
    w = np.zeros(3)
    for step in range(7):
        rows = order[(step % 3) * 54:(step % 3 + 1) * 54]
        w = w + 0.1 * x[rows].T @ (y[rows] - x[rows] @ w) / len(rows)
    fit = linear.linear_minibatch(df, XS, "y01", 0.1, 7, 3)
    np.testing.assert_allclose(fit.weights, w, atol=1e-12)


def test_a_minibatch_step_reads_its_own_batch(spark, df, monkeypatch):
    read, add_up = [], linear.add_up

    def counting(blocks, partial, size, tasks=None):
        read.append(sum(r["n"] for r in blocks.collect()))
        return add_up(blocks, partial, size, tasks)

    monkeypatch.setattr(linear, "add_up", counting)
    one = linear.linear_minibatch(df, XS, "y01", 0.1, 4, 3)
    assert read == [54, 54, 52, 54, 160]
    monkeypatch.setattr(linear, "STORE_FILES", 1)
    monkeypatch.setattr(linear, "BLOCK_ROWS", 7)
    np.testing.assert_allclose(linear.linear_minibatch(df, XS, "y01", 0.1, 4, 3).weights, one.weights, atol=1e-13)
    alone = linear.linear_minibatch(df, XS, "y01", 0.1, 2, 500)
    assert alone.steps == 2 and linear.linear_minibatch(df.where("false"), XS, "y01", 0.1, 2, 3).weights.tolist() == [0, 0, 0]


def test_missing_features_are_refused(spark):
    with pytest.raises(Exception, match="impute before training"):
        linear.linear_gd(frame(spark, {"a": [1, N], "t": [1, 2]}), ["a"], "t", 0.1, 1)


def test_sigmoid_at_the_extremes(spark):
    got = [r["p"] for r in frame(spark, {"z": [-800, 0, 800]}, 1).orderBy("z").select(scalar.sigmoid(F.col("z")).alias("p")).collect()]
    assert got == [0.0, 0.5, 1.0]
    assert frame(spark, {"z": [-800]}).select(scalar.log_loss(F.lit(1.0), F.col("z")).alias("l")).first()["l"] == 800


def test_impurities(spark):
    df = frame(spark, {"n0": [0, 5, 3], "n1": [0, 0, 3]}, 1)
    got = df.select(scalar.gini("n0", "n1").alias("g"), scalar.entropy("n0", "n1").alias("e")).collect()
    assert [r["g"] for r in got] == [0.0, 0.0, 0.5]
    assert [r["e"] for r in got] == pytest.approx([0.0, 0.0, 1.0], abs=1e-9)


# --- trees -----------------------------------------------------------------------------------------------------------


def impurity(y, criterion):
    if not len(y):
        return 0.0
    p = np.unique(y, return_counts=True)[1] / len(y)
    return 1 - np.sum(p ** 2) if criterion == "gini" else -np.sum(p * np.log2(p + 1e-10))


def brute_tree(x, y, cat, o, node=0, depth=0, features=None):
    """Node table of a single tree, grown recursively."""
    here = {"node": node, "n": len(y), "n_pos": int(y.sum())}
    done = (depth >= o.max_depth or len(y) < o.min_samples_split or len(np.unique(y)) < 2
            or len(y) < 2 * o.min_samples_leaf or o.cuts_off(depth, len(y)))
    best = (0.0, None, None)
    if not done:
        for f in features if features is not None else range(x.shape[1]):
            values = np.unique(x[:, f])
            if len(values) < 2:
                continue
            tried = values if f in cat else np.unique(np.percentile(x[:, f], np.linspace(25, 75, min(5, len(values)))))
            for t in tried:
                left = x[:, f] == t if f in cat else x[:, f] <= t
                if min(left.sum(), (~left).sum()) < o.min_samples_leaf:
                    continue
                g = impurity(y, o.criterion) - (left.mean() * impurity(y[left], o.criterion) + (~left).mean() * impurity(y[~left], o.criterion))
                if round(g, 12) > round(best[0], 12):
                    best = (g, f, t)
    if best[1] is None:
        return [{**here, "prediction": int(2 * y.sum() > len(y))}]
    g, f, t = best
    left = x[:, f] == t if f in cat else x[:, f] <= t
    return ([{**here, "f": f, "t": t, "g": g}] + brute_tree(x[left], y[left], cat, o, 2 * node + 1, depth + 1, features)
            + brute_tree(x[~left], y[~left], cat, o, 2 * node + 2, depth + 1, features))


def assert_same_tree(nodes, want):
    got = {n.node: n for n in nodes}
    assert set(got) == {w["node"] for w in want}
    for w in want:
        n = got[w["node"]]
        assert (n.n, n.n_pos) == (w["n"], w["n_pos"])
        if "f" in w:
            assert n.feature == w["f"] and n.threshold == pytest.approx(w["t"]) and n.gain == pytest.approx(w["g"])
        else:
            assert n.feature is None and n.prediction == w["prediction"]


@pytest.fixture(scope="module")
def grown():
    rng = np.random.default_rng(11)
    n = 500
    x = np.c_[rng.normal(size=n), rng.integers(0, 4, n), rng.integers(0, 3, n), np.where(rng.random(n) < 0.4, 2.0, rng.normal(size=n))]
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] == 2) | (rng.random(n) < 0.15)).astype(int)
    return x, y


def tree_frame(spark, x, y):
    return frame(spark, {"id": range(len(y)), **{f"f{j}": x[:, j] for j in range(x.shape[1])}, "y01": y})


@pytest.mark.parametrize("criterion,rows_per_bucket", [("gini", 10**6), ("entropy", 10**6), ("gini", 40)])
def test_tree_matches_brute_force(spark, grown, criterion, rows_per_bucket):
    x, y = grown
    o = tree.TreeOptions(4, 20, 10, criterion)
    model = tree.fit_tree(tree_frame(spark, x, y), ["f0", "f1", "f2", "f3"], "y01", o, ["f1"], rows_per_bucket=rows_per_bucket)
    assert_same_tree(model.nodes, brute_tree(x, y, {1}, o))


@pytest.fixture(scope="module")
def uneven():
    """Columns whose values lie close together, far apart, in few kinds and in kinds hidden in one cell."""
    rng = np.random.default_rng(5)
    n = 1500
    x = np.c_[np.exp(rng.normal(size=n) * 40), np.where(rng.random(n) < 0.999, 1 + rng.integers(0, 3, n) * 1e-13, 1e9), rng.integers(0, 5, n) * 1e300 * rng.choice([-1, 1], n),
              rng.choice([0.0, -0.0, 5e-324, 1.0], n), rng.integers(0, 12, n)]
    y = ((np.log(x[:, 0]) > 3) ^ (x[:, 4] == 7) ^ (x[:, 1] > 1) | (rng.random(n) < 0.1)).astype(int)
    return x, y


@pytest.mark.parametrize("rows_per_task,rows_per_cell,pairs", [(10**6, 10**6, 10**6), (300, 10**6, 10**6), (300, 40, 4), (60, 1, 7)])
def test_cells_and_tasks_of_any_size_give_the_same_tree(spark, uneven, monkeypatch, rows_per_task, rows_per_cell, pairs):
    x, y = uneven
    monkeypatch.setattr(tree, "PAIRS_AT_ONCE", pairs)
    o = tree.TreeOptions(4, 20, 10, "entropy")
    names = [f"f{j}" for j in range(x.shape[1])]
    model = tree.fit_tree(tree_frame(spark, x, y), names, "y01", o, ["f4"], rows_per_bucket=rows_per_task, rows_per_cell=rows_per_cell)
    assert_same_tree(model.nodes, brute_tree(x, y, {4}, o))


def test_few_kinds_beside_a_crowded_range(spark):
    """Two to six distinct values, most of them in one cell of the first cut."""
    rng = np.random.default_rng(8)
    for kinds in range(2, 7):
        values = np.r_[np.arange(kinds - 1) * 1e-9, 1.0]
        x = np.c_[rng.choice(values, 900), rng.normal(size=900)]
        y = ((x[:, 0] > values[kinds // 2 - 1]) ^ (rng.random(900) < 0.2)).astype(int)
        o = tree.TreeOptions(2, 20, 10)
        model = tree.fit_tree(tree_frame(spark, x, y), ["f0", "f1"], "y01", o, rows_per_bucket=100, rows_per_cell=5)
        assert_same_tree(model.nodes, brute_tree(x, y, set(), o))


def test_exchanged_records_do_not_grow_with_the_rows(spark, monkeypatch):
    """Counts of cells leave a task, so four times the rows are no more records."""
    sent = []
    summed = tree._Grower._summed

    def counting(self, counter):
        sent.append(self.blocks.coalesce(1).mapInArrow(counter, tree.splits.CELL_SCHEMA).count())
        return summed(self, counter)

    monkeypatch.setattr(tree._Grower, "_summed", counting)
    records = []
    for n in (3000, 12000):
        rng = np.random.default_rng(2)
        x = rng.random((n, 3))
        df = tree_frame(spark, x, (x[:, 0] + rng.random(n) > 1).astype(int))
        tree.fit_tree(df, ["f0", "f1", "f2"], "y01", tree.TreeOptions(1), rows_per_bucket=100, rows_per_cell=30)
        records.append(max(sent))
        sent.clear()
    assert records[1] <= 1.3 * records[0] <= 1.3 * 3 * (tree.splits.CELLS + 1)


def test_folds_and_candidates_grow_together(spark, grown):
    """Forests of several settings and held-out folds in one job equal those grown alone on the rows they see."""
    x, y = grown
    names = ["f0", "f1", "f2", "f3"]
    df = tree_frame(spark, x, y).withColumn("fold", (F.col("id") % 3).cast("int"))
    forests = [tree.Forest(3, m, tree.TreeOptions(d), 4, out) for m, d in ((2, 2), ("all", 4)) for out in (-1, 0, 2)]
    together = tree.fit_forests(df, names, "y01", forests, ["f1"], fold="fold", rows_per_bucket=120, rows_per_cell=20)
    for f, model in zip(forests, together):
        alone = tree.fit_forest(df.where(F.col("fold") != f.held_out), names, "y01", f.trees, f.max_features, f.options, ["f1"], f.seed)
        assert alone.nodes == model.nodes and alone.subsets == model.subsets


def test_draws_in_blocks_equal_the_column_function(spark):
    ids = [0, 1, 2, 77, 2147483646, 2147483647, 10**12, 9 * 10**17, -1, -5 * 10**11]
    df = spark.createDataFrame([(i, 1.0, float(k % 2)) for k, i in enumerate(ids)], "id long, a double, y01 double")
    pack = tree.splits.packer(1, [tree.tree_seed(3, 1), tree.tree_seed(3, 2500)], [0, 1], [-1, -1])
    block = df.coalesce(1).selectExpr("id", "y01", "-1 AS fold", "a").mapInArrow(pack, tree.splits.BLOCK_SCHEMA).first()
    got = np.frombuffer(block["w"], np.uint8).reshape(2, -1)
    for row, t in zip(got, (1, 2500)):
        want = {r["id"]: r["w"] for r in tree.with_draws(df.withColumn("tree", F.lit(t)), 3, drawn_only=False).collect()}
        assert row.tolist() == [want[i] for i in ids]


def test_large_deep_nodes_become_leaves_on_request(spark, grown):
    x, y = grown
    o = tree.TreeOptions(7, 2, 1, max_rows_in_deep_node=30)
    model = tree.fit_tree(tree_frame(spark, x, y), ["f0", "f1", "f2", "f3"], "y01", o)
    want = brute_tree(x, y, set(), o)
    assert_same_tree(model.nodes, want)
    assert any(w["n"] > 30 and "prediction" in w and 0 < w["n_pos"] < w["n"] for w in want)
    free = tree.fit_tree(tree_frame(spark, x, y), ["f0", "f1", "f2", "f3"], "y01", tree.TreeOptions(7, 2, 1))
    assert_same_tree(free.nodes, brute_tree(x, y, set(), tree.TreeOptions(7, 2, 1)))
    assert len(free.nodes) > len(model.nodes)


def test_pure_and_small_tables_are_one_leaf(spark):
    pure = tree.fit_tree(frame(spark, {"id": range(50), "a": range(50), "y01": [1] * 50}), ["a"], "y01")
    assert [(n.n, n.prediction) for n in pure.nodes] == [(50, 1)]
    # A tie goes to the lower label.
    small = tree.fit_tree(frame(spark, {"id": range(4), "a": range(4), "y01": [0, 1, 0, 1]}), ["a"], "y01")
    assert [(n.n, n.prediction) for n in small.nodes] == [(4, 0)]


def test_predictions_and_importances(spark, grown):
    x, y = grown
    o = tree.TreeOptions(3, 20, 10)
    df = tree_frame(spark, x, y)
    model = tree.fit_tree(df, ["f0", "f1", "f2", "f3"], "y01", o, ["f1"])
    table = {w["node"]: w for w in brute_tree(x, y, {1}, o)}

    def walk(row):
        w = table[0]
        while "f" in w:
            left = row[w["f"]] == w["t"] if w["f"] == 1 else row[w["f"]] <= w["t"]
            w = table[2 * w["node"] + (1 if left else 2)]
        return w["prediction"]

    got = {r["id"]: r["p"] for r in df.select("id", tree.probability(model).alias("p")).collect()}
    assert got == {i: float(walk(x[i])) for i in range(len(y))}
    gains = np.zeros(4)
    for w in table.values():
        if "f" in w:
            gains[w["f"]] += w["g"]
    imp = {r["feature"]: r["importance"] for r in tree.importances(model, spark).collect()}
    np.testing.assert_allclose([imp[f"f{j}"] for j in range(4)], gains / gains.sum(), atol=1e-9)
    nodes = model.to_frame(spark)
    assert nodes.where("prediction IS NULL").count() == sum("f" in w for w in table.values())


def draws(i, seed, t):
    u = hash_number(i, seed * 1000 + t) / PRIME
    return sum(u >= c for c in POISSON_ONE_CDF)


def test_forest_matches_brute_force(spark, grown):
    x, y = grown
    n, seed, o = len(y), 5, tree.TreeOptions(3, 20, 10)
    df = tree_frame(spark, x, y)
    names = ["f0", "f1", "f2", "f3"]
    model = tree.fit_forest(df, names, "y01", 4, "sqrt", o, ["f1"], seed)
    oob = np.zeros((n, 2))
    for t in range(4):
        w = np.array([draws(i, seed, t) for i in range(n)])
        sample = np.repeat(np.arange(n), w)
        chosen = model.subsets[t]
        assert len(chosen) == 2
        assert_same_tree([m for m in model.nodes if m.tree == t], brute_tree(x[sample], y[sample], {1}, o, features=chosen))
    votes = np.array([r["v"] for r in df.select("id", tree.votes(model).alias("v")).orderBy("id").collect()])
    for t in range(4):
        out = np.array([draws(i, seed, t) == 0 for i in range(n)])
        oob[out, 0] += 1 - votes[out, t]
        oob[out, 1] += votes[out, t]
    voted = oob.sum(axis=1) > 0
    r = tree.oob_score(df, model, "y01").first()
    assert r["rows"] == voted.sum()
    assert r["oob_score"] == pytest.approx(np.mean(np.argmax(oob[voted], axis=1) == y[voted]))
    p = np.array([r["p"] for r in df.select("id", tree.probability(model).alias("p")).orderBy("id").collect()])
    np.testing.assert_allclose(p, votes.mean(axis=1))
    total = sum(r["importance"] for r in tree.forest_importances(model, spark).collect())
    assert total == pytest.approx(1.0)


def test_forest_does_not_depend_on_partitioning(spark, grown):
    x, y = grown
    df = tree_frame(spark, x, y)
    one = tree.fit_forest(df.repartition(1), ["f0", "f1", "f2", "f3"], "y01", 3, 2, tree.TreeOptions(3), seed=2)
    many = tree.fit_forest(df.repartition(8), ["f0", "f1", "f2", "f3"], "y01", 3, 2, tree.TreeOptions(3), seed=2, rows_per_bucket=60)
    assert one.nodes == many.nodes


@pytest.mark.parametrize("rule,size", [("sqrt", 4), ("log2", 4), ("all", 17), (5, 5), ("40", 17)])
def test_subset_sizes(rule, size):
    assert tree.subset_size(rule, 17) == size
    chosen = tree.feature_subset(17, size, 3, 1)
    assert len(set(chosen)) == size and all(0 <= f < 17 for f in chosen)


def test_bootstrap_weights_are_close_to_poisson(spark):
    rows = tree.with_draws(spark.range(20000).withColumn("tree", F.lit(0)), 4, drawn_only=False).groupBy("w").count().collect()
    share = {r["w"]: r["count"] / 20000 for r in rows}
    assert share[0] == pytest.approx(0.3679, abs=0.01) and share[1] == pytest.approx(0.3679, abs=0.01)
    assert sum(w * s for w, s in share.items()) == pytest.approx(1.0, abs=0.02)


def test_a_half_vote_is_negative_for_the_class_and_positive_for_the_sign(spark):
    r = frame(spark, {"p": [0.5]}).select(tree.class_vote(F.col("p")).alias("c"), scalar.signed_label(F.col("p"), 0.5).alias("s")).first()
    assert (r["c"], r["s"]) == (0, 1)


def test_executor_functions_do_not_need_the_package(tmp_path):
    import subprocess
    import sys

    from pyspark import cloudpickle
    compute = gradient._partial(np.zeros((2, 1)), [gradient.Model()])
    (tmp_path / "f.bin").write_bytes(cloudpickle.dumps(compute))
    code = ("import pickle, numpy as np; f = pickle.load(open('f.bin', 'rb')); "
            "print(f(np.ones((4, 2)), np.ones(4), np.zeros(4))[-1])")
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.stdout.strip() == "4.0", done.stderr


@pytest.mark.parametrize("width", [2, 33])
@pytest.mark.parametrize("gap", ["feature", "label"])
def test_every_fit_refuses_missing_cells(spark, width, gap):
    features = [f"x{i}" for i in range(width)]
    columns = {"id": range(60), **{f: [float((i * 7 + k) % 13) for i in range(60)] for k, f in enumerate(features)}, "t": [float(i % 2) for i in range(60)]}
    columns["x1" if gap == "feature" else "t"][5] = None
    df = frame(spark, columns)
    fits = [lambda: linear.least_squares(df, features, "t"), lambda: linear.ridge(df, features, "t", 0.1), lambda: linear.linear_gd(df, features, "t", 0.01, 2),
            lambda: linear.fit_logistic(df, features, "t", [linear.logistic_family("logistic", max_iters=2)]), lambda: tree.fit_tree(df, features, "t")]
    for fit in fits:
        with pytest.raises(Exception, match="missing feature values"):
            fit()


def test_seeds_of_trees_do_not_meet_the_next_seed():
    numbers = {tree.tree_seed(s, t) for s in range(5) for t in range(3000)}
    assert len(numbers) == 15_000


def test_workers_are_handed_few_blocks_at_once(spark, monkeypatch):
    """A long partition reaches a Python worker block by block, and the last step down needs no worker of its own."""
    from tallyloom.operators import splits, tree
    largest, chunker, rows = spark.sparkContext.accumulator(0), splits.chunker, 3 * splits.BLOCK_ROWS

    def watched(*args):
        inner = chunker(*args)

        def run(batches):
            def passing():
                for batch in batches:
                    largest.add(max(0, batch.num_rows - 1))
                    yield batch
            yield from inner(passing())
        return run

    names = [f"x{i}" for i in range(40)]
    df = spark.range(0, rows, 1, 1).selectExpr("id", "CAST(pmod(xxhash64(id), 10) < 3 + id % 2 AS DOUBLE) AS y", *[f"CAST(pmod(xxhash64(id, {i}), 1000) AS DOUBLE) AS {n}" for i, n in enumerate(names)])
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    options = tree.TreeOptions(3, 20, 10)
    plain = tree.fit_tree(df, names, "y", options, rows_per_bucket=1 << 20)
    monkeypatch.setattr(splits, "chunker", watched)
    model = tree.fit_tree(df, names, "y", options, rows_per_bucket=rows // 2)
    assert largest.value == 0 and spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before
    assert model.nodes == plain.nodes and len(model.nodes) > 3
