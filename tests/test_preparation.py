"""Selection, imputation, encoding, scaling, balancing, levels, sources and sinks."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import balance, encode, impute, scale, select
from tallyloom.operators.columns import value_counts
from tallyloom.plans import levels
from tallyloom.sources import sinks, tables

from conftest import frame

N = None


def test_missing_threshold_is_inclusive(spark):
    df = frame(spark, {"half": [1, N], "most": [1, 2], "none": [N, N]})
    assert select.sparse_features(df, df.columns, 0.5) == ["none"]


def test_duplicates_keep_the_first_and_treat_missing_as_equal(spark):
    df = frame(spark, {"id": [1, 2, 3], "a": [1, N, 3], "b": [1, N, 3], "c": [1, 2, 3], "d": [1, N, 4], "e": [1, N, 3]})
    assert select.duplicate_features(df, ["a", "b", "c", "d", "e"]) == {"b": "a", "e": "a"}
    # A rearranged column is no duplicate.
    df = frame(spark, {"id": [1, 2, 3], "a": [1, 2, 3], "b": [3, 2, 1]})
    assert select.duplicate_features(df, ["a", "b"]) == {}


def test_leading_columns(spark):
    df = frame(spark, {"id": [1], "m1": [1], "m2": [1], "x": [1]})
    assert select.without_leading(df, 3, ("id",)).columns == ["id", "x"]


def test_fill_values(spark):
    df = frame(spark, {"m": [1, 2, 6, N], "tie": [5, 3, 5, 3], "void": [N] * 4, "mode": [2, 2, N, N]})
    assert impute.fit_fill(df, ["m", "void"], ["tie", "mode"]) == {"m": 3.0, "void": 0.0, "tie": 3.0, "mode": 2.0}
    assert impute.fit_fill(df, ["m", "void"], [], "median") == {"m": 2.0, "void": 0.0}
    # The median is honoured although the column has no missing cell.
    assert impute.fit_fill(df, ["tie"], [], "median") == {"tie": 4.0}
    assert impute.fit_fill(df, [], ["void"]) == {"void": 0.0}
    with pytest.raises(ValueError):
        impute.fit_fill(df, ["m"], [], "max")
    with pytest.raises(ValueError):
        impute.fit_fill(df, [], ["m"], other_strategy="mean")


def test_unknown_feature_is_filled_with_zero(spark):
    df = frame(spark, {"a": [N, 2], "b": [N, 2]})
    got = impute.apply_fill(df, ["a", "b"], {"a": 7.0}).where("b = 0").first()
    assert (got["a"], got["b"]) == (7.0, 0.0)


def test_scaling_of_flat_and_unknown_columns(spark):
    df = frame(spark, {"a": [1, 3], "flat": [5, 5], "other": [2, 2]})
    fitted = scale.fit_scale(df, ["a", "flat"])
    assert fitted == {"a": (2.0, 1.0), "flat": (5.0, 1.0)}
    got = scale.apply_scale(df, ["a", "flat", "other"], fitted).orderBy("a").first()
    assert (got["a"], got["flat"], got["other"]) == (-1.0, 0.0, 2.0)


def counts_of(spark, values, labels=None):
    cols = {"c": values, **({"y": labels} if labels else {})}
    return value_counts(frame(spark, cols), ["c"], "y" if labels else None)


def test_one_hot_keeps_frequent_values_and_breaks_ties_upwards(spark):
    counts = counts_of(spark, [1] * 3 + [2] * 3 + [3] * 2 + [4])
    spec = encode.collect_one_hot(encode.fit_one_hot(counts, 2, 2))["c"]
    assert (spec.values, spec.other) == ([2.0, 1.0], True)
    assert encode.collect_one_hot(encode.fit_one_hot(counts, 1, 9))["c"].other is False
    nothing = encode.collect_one_hot(encode.fit_one_hot(counts, 100, 9))["c"]
    assert (nothing.values, nothing.other) == ([], True)
    df = frame(spark, {"id": [1, 2, 3], "c": [2, 4, N]})
    out = {r["id"]: r for r in encode.apply_one_hot(df, ["c"], {"c": spec}).collect()}
    assert [out[1]["c=2"], out[1]["c=1"], out[1]["c=OTHER"]] == [1, 0, 0]
    assert out[2]["c=OTHER"] == 1 and out[3]["c=OTHER"] == 1
    unflagged = encode.OneHotSpec([2.0], False)
    assert {r["id"]: r["c=2"] for r in encode.apply_one_hot(df, ["c"], {"c": unflagged}).collect()} == {1: 1, 2: 0, 3: 0}


def test_target_encoding_by_hand(spark):
    values = [1] * 4 + [2] * 3 + [3] * 2
    labels = [1, 1, 1, -1, 1, -1, -1, -1, 1]
    mean = np.mean(labels)
    spec = encode.collect_target_encoding(encode.fit_target_encoding(counts_of(spark, values, labels), mean, 3, 9, 2.0))["c"]
    assert spec.encodings == pytest.approx({1.0: (2 + 2 * mean) / 6, 2.0: (-1 + 2 * mean) / 5})
    assert spec.other == pytest.approx((0 + 2 * mean) / 4) and spec.has_other
    df = frame(spark, {"id": [1, 2, 3], "c": [1, 3, 8]})
    out = {r["id"]: r["c"] for r in encode.apply_target_encoding(df, ["c"], {"c": spec}, mean).collect()}
    assert out == pytest.approx({1: spec.encodings[1.0], 2: spec.other, 3: spec.other})
    # Without left-out values an unseen one gets the global mean.
    whole = encode.collect_target_encoding(encode.fit_target_encoding(counts_of(spark, values, labels), mean, 1, 9, 2.0))["c"]
    assert not whole.has_other
    out = {r["id"]: r["c"] for r in encode.apply_target_encoding(df, ["c"], {"c": whole}, mean).collect()}
    assert out[3] == pytest.approx(mean)


def test_no_categories_kept_means_pooled_encoding(spark):
    spec = encode.collect_target_encoding(encode.fit_target_encoding(counts_of(spark, [1, 2, 3, 4], [1, -1, -1, -1]), -0.5, 0, 0))["c"]
    assert spec.encodings == {} and spec.has_other and spec.other == pytest.approx(-0.5)


def test_counts_after_imputation(spark):
    got = {r["value"]: (r["n"], r["n_pos"]) for r in encode.impute_counts(counts_of(spark, [1, 1, 2, N, N], [1, -1, 1, 1, -1])).collect()}
    assert got == {1.0: (4, 2), 2.0: (1, 1)}


@pytest.mark.parametrize("pos,neg,target", [(10, 90, 0.35), (1, 7, 0.5), (50, 50, 0.4), (0, 9, 0.5), (3, 100, 0.2)])
def test_oversampling_adds_the_exact_number(spark, pos, neg, target):
    df = frame(spark, {"id": range(pos + neg), "y": [1] * pos + [-1] * neg, "x": range(pos + neg)})
    out = balance.oversample(df, target, seed=3).collect()
    extra = 0 if pos == 0 or pos / (pos + neg) >= target else max(0, math.ceil(target * neg / (1 - target)) - pos)
    assert len(out) == pos + neg + extra
    assert sum(r["copy"] > 0 for r in out) == extra
    assert all(r["y"] == 1 and r["id"] < pos and r["x"] == r["id"] for r in out if r["copy"])
    again = balance.oversample(df.repartition(1), target, seed=3).collect()
    assert sorted(map(tuple, out)) == sorted(map(tuple, again))


def reference_level(x, y, continuous, p):
    """The level formulas restated for NumPy arrays keyed by column name; returns the transformed columns."""
    n = len(y)
    kept = [c for c in x if np.isnan(x[c]).sum() / n <= p.missing]
    if p.low_variance is not None:
        def flat(c):
            _, k = np.unique(x[c][~np.isnan(x[c])], return_counts=True)
            return len(k) == 1 or k.max() / n >= p.low_variance
        kept = [c for c in kept if not flat(c)]
    if p.deduplicate:
        seen, unique = set(), []
        for c in kept:
            key = np.nan_to_num(x[c], nan=-1.5e300).tobytes()
            if key not in seen:
                seen.add(key)
                unique.append(c)
        kept = unique
    out, mean = {}, np.mean(y)
    for c in kept:
        v, gone = x[c].copy(), np.isnan(x[c])
        if c in continuous:
            v[gone] = np.nanmedian(v) if p.strategy == "median" else np.nanmean(v)
            s = np.std(v)
            out[c] = (v - v.mean()) / (s if s > 1e-12 else 1.0)
        else:
            u, k = np.unique(v[~gone], return_counts=True)
            v[gone] = u[np.argmax(k)]
            u, k = np.unique(v, return_counts=True)
            order = sorted(range(len(u)), key=lambda i: (-k[i], -u[i]))
            keep = [u[i] for i in order if k[i] >= p.min_count][:p.max_categories]
            enc = np.full(n, mean)
            rest = ~np.isin(v, keep)
            if len(keep) < len(u):
                enc[rest] = (y[rest].sum() + mean * p.smoothing) / (rest.sum() + p.smoothing)
            for value in keep:
                hit = v == value
                enc[hit] = (y[hit].sum() + mean * p.smoothing) / (hit.sum() + p.smoothing)
            out[c] = enc
    return out


@pytest.mark.parametrize("level", ["level0", "level1", "level2_unbalanced", "level3", "level4"])
def test_levels_match_the_formulas(spark, orders, level):
    from tallyloom.catalog.base import FEATURES
    table = orders.orderBy("id").toPandas()
    x = {c: table[c].to_numpy(dtype=float) for c in FEATURES}
    y = table["y"].to_numpy(dtype=float)
    continuous = ["totalprice", "price_gap", "price_copy", "price_near", "sum_qty", "mean_disc"]
    want = reference_level(x, y, continuous, levels.LEVELS[level])
    state = levels.fit_preset(orders, FEATURES, continuous, levels.LEVELS[level])
    got = levels.transform(orders, state).orderBy("id").toPandas()
    assert set(got.columns) - {"id"} == set(want)
    for c, v in want.items():
        np.testing.assert_allclose(got[c].to_numpy(), v, atol=1e-9, err_msg=c)
    # The fitted state survives a round trip through a table.
    again = levels.PreparedState.from_frame(state.to_frame(spark).repartition(3))
    assert again == state


def test_level5_parity_options(spark, orders):
    from tallyloom.catalog.base import FEATURES
    effective = levels.fit_level5(orders, FEATURES)
    documented = levels.fit_level5(orders, FEATURES, parity="documented", include_binary=True, forced_continuous=["survey", "status_code"])
    assert effective.fill.get("child") is None and effective.passed == []
    assert documented.fill["child"] == impute.fit_fill(orders, [], ["child"])["child"]
    assert "parent" in documented.passed and "status_code" in documented.continuous
    assert "status_code=0" in levels.transform(orders, effective).columns
    with pytest.raises(ValueError):
        levels.fit_level5(orders, FEATURES, parity="other")


def test_only_balanced_levels_gain_rows(orders):
    from tallyloom.catalog.base import FEATURES
    train, test = orders.where("id % 5 <> 0"), orders.where("id % 5 = 0")
    ready, _, state = levels.prepare(train, test, FEATURES, "level4", ["totalprice"])
    pos, neg = state.counts
    assert ready.count() == pos + neg + balance.copies_needed(pos, neg, 0.35)
    ready, held, _ = levels.prepare(train, test, FEATURES, "level2_unbalanced", ["totalprice"])
    assert ready.count() == pos + neg and held.count() == test.count()


def write(path, text):
    path.write_text(text)
    return str(path)


def test_csv_sources(spark, tmp_path):
    write(tmp_path / "x_train.csv", "Id,a,b\n" + "".join(f"{i},{i / 2},{'' if i % 2 else i}\n" for i in range(1, 121)))
    write(tmp_path / "y_train.csv", "Id,label\n" + "".join(f"{i},{1 if i % 3 else -1}\n" for i in range(1, 121)))
    write(tmp_path / "x_test.csv", "Id,a,b\n500,nan,2\n")
    train, test = tables.read_dataset(spark, str(tmp_path))
    assert train.columns == ["id", "y", "a", "b"] and train.count() == 120
    r = train.where("id = 3").first()
    assert (r["y"], r["a"], r["b"]) == (-1, 1.5, None)
    assert test.first()["a"] is None
    thin, _ = tables.read_dataset(spark, str(tmp_path), every=50)
    assert sorted(r["id"] for r in thin.collect()) == [1, 51, 101]
    assert tables.feature_columns(train) == ["a", "b"]


def test_submission(spark, tmp_path):
    df = frame(spark, {"id": [2, 1], "y_hat": [1, -1]})
    path = str(tmp_path / "sub")
    sinks.write_submission(df, path)
    back = spark.read.option("header", True).csv(path)
    assert back.columns == ["Id", "Prediction"] and sorted(map(tuple, back.collect())) == [("1", "-1"), ("2", "1")]
    for bad in (0, N, 0.5):
        with pytest.raises(Exception, match="neither"):
            sinks.submission(frame(spark, {"id": [1], "y_hat": [bad]})).collect()


@pytest.mark.parametrize("kind", ["parquet", "csv"])
def test_level_round_trip(spark, orders, kind):
    from tallyloom.catalog.base import FEATURES
    train, test = orders.where("id % 5 <> 0"), orders.where("id % 5 = 0")
    ready, held, state = levels.prepare(train, test, FEATURES, "level1", ["totalprice", "sum_qty"])
    folder = sinks.new_folder(spark)
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir"))
    sinks.save_level(ready, held, state, folder, kind)
    a, b, again = sinks.load_level(spark, folder, kind)
    assert again == state and a.count() == ready.count()
    x = held.select("id", F.round("totalprice", 6).alias("t")).orderBy("id").collect()
    assert [tuple(r) for r in b.select("id", "totalprice").orderBy("id").collect()] == [tuple(r) for r in x]


def test_a_fit_counts_values_once(spark, orders, monkeypatch):
    """The counts' rows pass a counter; every further use of them in the fit must read them, not count again."""
    from tallyloom.catalog.base import FEATURES
    from tallyloom.operators.columns import value_counts
    seen = spark.sparkContext.accumulator(0)
    made = []

    def counted(df, features, label=None):
        counts = value_counts(df, features, label)

        def passing(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        made.append(counts)
        return counts.mapInArrow(passing, counts.schema)

    plain = levels.fit_preset(orders, FEATURES, ["totalprice"], levels.LEVELS["level2"])
    monkeypatch.setattr(levels, "value_counts", counted)
    state = levels.fit_preset(orders, FEATURES, ["totalprice"], levels.LEVELS["level2"])
    assert seen.value == made[0].count() > 0
    assert state.target == plain.target and state.fill == plain.fill


def test_majority_of_many_tasks(spark):
    """Found from sketches that do not grow as they are merged; zero of either sign is one value, and missing cells count."""
    from tallyloom.operators.columns import MAJORITY_VALUE, per_column
    df = spark.range(0, 60_000, 1, 300).selectExpr(
        "CASE WHEN id % 100 < 53 THEN 7D ELSE CAST(id AS DOUBLE) END AS often", "CASE WHEN id % 2 = 0 THEN 0D WHEN id % 20 > 1 THEN -0D ELSE id / 3D END AS zero",
        "CASE WHEN id < 40000 THEN CAST('NaN' AS DOUBLE) ELSE CAST(id AS DOUBLE) END AS nan", "CASE WHEN id % 10 = 0 THEN 1D END AS gaps")
    found = {r["feature"]: r["value"] for r in per_column(df, df.columns, {"value": MAJORITY_VALUE}).collect()}
    assert found["often"] == 7 and found["zero"] == 0 and found["nan"] != found["nan"] and found["gaps"] is None
    assert per_column(df.where("false"), ["often"], {"value": MAJORITY_VALUE}).first()["value"] is None
    sizes = df.groupBy(F.expr("spark_partition_id() % 2")).agg(F.expr("length(approx_top_k_accumulate(often, 1000).sketch)").alias("n")).collect()
    assert all(r["n"] < 60_000 for r in sizes)
