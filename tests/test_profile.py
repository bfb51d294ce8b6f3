"""Profiling rules on small tables with answers worked out by hand or by NumPy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import linear, profile, roles, scale
from tallyloom.operators.encode import one_hot_all
from tallyloom.operators.gradient import gram

from conftest import frame

N = None


def rows(df, key="feature"):
    return {r[key]: r for r in df.collect()}


def test_summary_ignores_missing(spark):
    df = frame(spark, {"a": [1, 2, N, 4], "b": [N, N, N, 7], "c": [N, N, N, N]})
    for limit in (10**6, 0):
        got = rows(profile.summarize(df, ["a", "b", "c"], limit))
        a = got["a"]
        assert (a["min"], a["max"], a["median"], a["missing"], a["distinct"]) == (1, 4, 2, 1, 3)
        assert a["mean"] == pytest.approx(7 / 3) and a["std"] == pytest.approx(np.std([1, 2, 4]))
        assert got["b"]["std"] == 0 and got["b"]["missing"] == 3
        assert got["c"]["distinct"] == 0 and got["c"]["median"] is None


def test_missing_bins_close_the_last_edge(spark):
    df = frame(spark, {"full": [1] * 20, "one": [N] + [1] * 19, "quarter": [N] * 5 + [1] * 15, "none": [N] * 20})
    shares = profile.missing_shares(df, df.columns)
    assert [(r["low"], r["features"]) for r in profile.missing_bins(shares).orderBy("low").collect()] == [
        (0.0, 1), (0.05, 1), (0.2, 1), (0.5, 1)]
    r = profile.missing_overview(shares).first()
    assert (r["complete"], r["incomplete"], r["worst"]) == (1, 3, 1.0)


def test_constant_and_near_constant_count_missing_rows(spark):
    df = frame(spark, {"flat": [3] * 10, "flat_gap": [3] * 5 + [N] * 5, "near": [1] * 9 + [2], "empty": [N] * 10, "mix": range(10)})
    assert set(rows(profile.constant_features(df, df.columns))) == {"flat", "flat_gap"}
    near = rows(profile.top_value_shares(df, df.columns, 0.9))
    assert {k: r["share"] for k, r in near.items()} == {"flat": 1.0, "near": 0.9}
    assert near["near"]["value"] == 1
    # Below one half the share is found by counting every value.
    assert {k: r["share"] for k, r in rows(profile.top_value_shares(df, df.columns, 0.5)).items()} == {
        "flat": 1.0, "flat_gap": 0.5, "near": 0.9}


def test_short_features_never_lose_a_short_column(spark):
    df = spark.range(20000).selectExpr(*[f"CAST(hash(id) % {k} AS DOUBLE) AS c{k}" for k in (2, 8, 15, 31)], "CAST(id AS DOUBLE) AS wide")
    assert set(profile.short_features(df, df.columns, 31)) >= {"c2", "c8", "c15"}
    assert "wide" not in profile.short_features(df, df.columns, 31)


def test_histogram_top_edge_and_flat_column(spark):
    df = frame(spark, {"a": [0, 1, 2, 3, 4, N], "b": [2] * 6})
    assert {r["bin"]: r["n"] for r in profile.equal_width_histogram(df, F.col("a"), 4).collect()} == {0: 1, 1: 1, 2: 1, 3: 2}
    flat = profile.equal_width_histogram(df, F.col("b"), 4).collect()
    assert [(r["bin"], r["n"], r["low"]) for r in flat] == [(2, 6, 2.0)]


@pytest.mark.parametrize("values,role", [
    ([1, 2] * 3, "binary"), ([1, 1, N, N, N, N], "categorical"), ([1, 2, 3, 4, 5, 6], "categorical"),
    ([1, 2, 3, 4, 5, 21], "continuous"), ([0.5, 1, 2, 3, 4, 5], "continuous"), ([-10, 0, 11, 3, 4, 5], "categorical"),
    ([N] * 6, "ignored"), ([5] * 6, "categorical"), ([50] * 6, "continuous"),
])
def test_role_rules(spark, values, role):
    assert rows(roles.feature_roles(frame(spark, {"a": values}), ["a"]))["a"]["role"] == role


def test_pseudo_binary_needs_a_tiny_table(spark):
    # Missing share 0.75 against 0.5 + 0.1 * ln(1 + 4) = 0.66.
    assert rows(roles.feature_roles(frame(spark, {"a": [1, N, N, N]}), ["a"]))["a"]["role"] == "pseudo_binary"
    # 0.94 against 0.5 + 0.1 * ln(101) = 0.96: never reached on longer tables.
    long = frame(spark, {"a": [1] * 6 + [N] * 94})
    assert rows(roles.feature_roles(long, ["a"]))["a"]["role"] == "categorical"


def test_survey_codes(spark):
    two = frame(spark, {"a": [1, 2, 3, 4, 5, 7, 9]})
    assert sorted(r["code"] for r in roles.survey_codes(two, ["a"]).collect()) == [7, 9]
    cleaned = roles.clear_survey_codes(two, roles.survey_codes(two, ["a"]))
    assert sorted(r["a"] for r in cleaned.where("a IS NOT NULL").collect()) == [1, 2, 3, 4, 5]
    cases = {"one": [1, 2, 3, 4, 5, 6, 99], "mixed": [1, 2, 3, 4, 5, 6, 79], "few": [1, 2, 99, 99, 1, 2, 2],
             "neg": [-900, 0, 1, 2, 3, 4, 5], "not_far": [1, 2, 3, 4, 5, 6, 7]}
    got = {(r["feature"], r["code"]) for r in roles.survey_codes(frame(spark, cases), list(cases)).collect()}
    assert got == {("one", 99.0)}


@pytest.mark.parametrize("value,hit", [(0, True), (7, True), (-77, True), (700, True), (9.9, True), (79, False), (8, False)])
def test_survey_code_pattern(spark, value, hit):
    from tallyloom.functions.scalar import is_survey_code
    assert frame(spark, {"a": [value]}).select(is_survey_code("a").alias("h")).first()["h"] is hit


def test_dependent_features_are_strictly_above_the_threshold(spark):
    df = frame(spark, {"p": [0, 0, N, N, 1, 1], "all": [N, N, N, N, 5, 5], "half": [N, N, 3, 3, 5, 5], "void": [N] * 6})
    assert set(rows(roles.dependent_features(df, "p", df.columns, 0.5))) == {"all"}
    assert set(rows(roles.dependent_features(df, "p", df.columns, 0.5, missing_is_zero=False))) == {"all", "half"}
    none = frame(spark, {"p": [1, 1], "a": [N, 1]})
    assert roles.dependent_features(none, "p", ["a"], 0.5).count() == 0


def test_date_and_id_rules(spark):
    n = 400
    df = frame(spark, {"year": [1990 + i % 20 for i in range(n)], "month": [1 + i % 12 for i in range(n)], "day": [1 + i % 31 for i in range(n)],
                       "ident": [20000 + i % 30 for i in range(n)], "unique": [20000 + i for i in range(n)], "void": [N] * n})
    got = {k: r["kind"] for k, r in rows(roles.date_or_id_features(df, df.columns)).items()}
    # The day column's median is above 12 and 31 values in 400 rows are more than a twentieth.
    assert got == {"year": "year", "month": "month_or_day", "ident": "id"}


def test_correlation_matches_numpy_on_both_paths(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(120, 4))
    x[:, 1] = x[:, 0] * 2 + 0.01 * x[:, 1]
    gaps = rng.random((120, 4)) < 0.1
    filled = np.where(gaps, np.nan, x)
    filled = np.where(np.isnan(filled), np.nanmean(filled, axis=0), filled)
    df = frame(spark, {f"c{j}": [N if g else v for v, g in zip(x[:, j], gaps[:, j])] for j in range(4)})
    want = np.corrcoef(filled, rowvar=False)
    np.testing.assert_allclose(linear.correlation_matrix(df, df.columns), want, atol=1e-10)
    means = [np.nanmean(np.where(gaps[:, j], np.nan, x[:, j])) for j in range(4)]
    products = gram(df, df.columns, center=means)[0]
    d = np.sqrt(np.diag(products))
    np.testing.assert_allclose(products / np.outer(d, d), want, atol=1e-10)
    pairs = linear.highly_correlated(linear.correlations(df, df.columns)).collect()
    expected = {(f"c{i}", f"c{j}") for i in range(4) for j in range(i + 1, 4) if abs(want[i, j]) > 0.95}
    assert {(r["feature_i"], r["feature_j"]) for r in pairs} == expected


@pytest.mark.parametrize("tile,at_once", [(256, 64), (3, 2)])
def test_tiles_of_any_size_give_all_pairs(spark, monkeypatch, tile, at_once):
    rng = np.random.default_rng(14)
    x = rng.normal(size=(150, 8))
    x[:, 5] = -x[:, 2] + 0.01 * x[:, 5]
    x[:, 6] = 0.1
    gaps = rng.random(x.shape) < 0.1
    df = frame(spark, {f"c{j}": [N if g else v for v, g in zip(x[:, j], gaps[:, j])] for j in range(8)})
    filled = np.where(gaps, np.nan, x)
    filled = np.where(np.isnan(filled), np.nanmean(filled, axis=0), filled)
    monkeypatch.setattr(linear, "TILE", tile)
    monkeypatch.setattr(linear, "TILES_AT_ONCE", at_once)
    with np.errstate(invalid="ignore"):
        want = np.corrcoef(filled, rowvar=False)
    want[6, :] = want[:, 6] = np.nan
    got = np.full((8, 8), 9.0)
    for r in linear.correlations(df, df.columns).collect():
        got[r["i"], r["j"]] = np.nan if r["r"] is None else r["r"]
        assert (r["feature_i"], r["feature_j"]) == (f"c{r['i']}", f"c{r['j']}")
    np.testing.assert_allclose(got, want, atol=1e-10)
    pairs = {(r["feature_i"], r["feature_j"]) for r in linear.correlated_pairs(df, df.columns, 0.1).collect()}
    assert ("c2", "c5") in pairs and pairs == {(f"c{i}", f"c{j}") for i in range(8) for j in range(i + 1, 8) if abs(want[i, j]) > 0.1}


def test_correlated_pairs_of_wide_tables(spark):
    """Three tiles a side: only the planted pairs of 180 thousand come back. (The same test took 5,000 columns once.)"""
    import pandas as pd
    width = 600
    names = [f"c{j}" for j in range(width)]
    table = np.random.default_rng(3).random((40, width))
    table[:, 532] = table[:, 17] * 2 + 1
    table[:, 299] = -table[:, 400]
    df = spark.createDataFrame(pd.DataFrame(table, columns=names))
    got = {(r["feature_i"], r["feature_j"]) for r in linear.correlated_pairs(df, names, 0.95).collect()}
    assert got == {("c17", "c532"), ("c299", "c400")}


def test_outliers_skip_incomplete_columns(spark):
    base = list(range(200))
    df = frame(spark, {"id": base, "y": [1 if i % 2 else -1 for i in base], "a": [float(i) for i in base],
                       "gap": [N] + [float(i) for i in base[1:]], "flat": [1.0] * 200})
    report = profile.outlier_report(df, ["a", "gap", "flat"])
    r = rows(report)
    assert set(r) == {"a"} and r["a"]["q_low"] == pytest.approx(1.99) and r["a"]["q_high"] == pytest.approx(197.01)
    split = {(x["part"], x["y"]): x["n"] for x in profile.outlier_label_split(df, report).collect()}
    assert split == {("clean", -1): 98, ("clean", 1): 98, ("outlier", -1): 2, ("outlier", 1): 2}


def test_standardize_all_spreads_missing_and_keeps_flat(spark):
    train = frame(spark, {"a": [1, 2, 3], "flat": [4, 4, 4], "gap": [1, N, 3]})
    other = frame(spark, {"a": [2], "flat": [5], "gap": [1]})
    _, out = scale.standardize_all(train, other, ["a", "flat", "gap"])
    r = out.first()
    assert (r["a"], r["flat"], r["gap"]) == (0.0, 1.0, None)


def test_one_hot_example(spark):
    df = frame(spark, {"id": [0, 1, 2, 3], "Q1": [1, 2, 1, 3], "Q2": [2, 2, 1, 2], "Q3": [N, 1, 2, 1], "wide": [1, 2, 3, 4]})
    out, skipped = one_hot_all(df, ["Q1", "Q2", "Q3"], 5)
    assert out.columns == ["id", "Q1=1", "Q1=2", "Q1=3", "Q2=1", "Q2=2", "Q3=1", "Q3=2"] and skipped == []
    first = out.where("id = 0").first()
    assert (first["Q3=1"], first["Q3=2"], first["Q1=1"]) == (0, 0, 1)
    assert one_hot_all(df, ["Q1", "wide"], 3)[1] == ["wide"]


def test_suspicious_features(spark):
    df = frame(spark, {"y": [1, 1, -1, -1], "leak": [1, 1, 0, 0], "far": [0, 5e6, 0, 5e6], "gap": [1, 1, 0, N], "flat": [1] * 4, "fine": [1, 2, 1, 2]})
    got = {k: r["reason"] for k, r in rows(roles.suspicious_features(df, ["leak", "far", "gap", "flat", "fine"], "y")).items()}
    assert got == {"leak": "High correlation", "far": "Large range"}


def test_discrete_and_drilldown(spark):
    df = frame(spark, {"a": [1, 1, N, 2], "b": [1, 2, 3, 4]})
    assert {k: r["distinct"] for k, r in rows(profile.discrete_features(df, ["a", "b"], 3)).items()} == {"a": 2}
    d = rows(profile.drilldown(df, "a"), "value")
    assert (d[1.0]["n"], d[1.0]["missing"], d[1.0]["missing_share"]) == (2, 1, 0.25)
