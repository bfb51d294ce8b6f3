"""Exact ranks, running totals and quantiles across buckets and partitions."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyloom.functions.hashing import PRIME, hash_number, id_hash
from tallyloom.operators.quantiles import SCANS, by_digits, exact_quantiles
from tallyloom.operators.ranks import bucket_cuts, hash_index, hash_sample, range_index, running_totals

from conftest import frame


def test_hash_matches_plain_arithmetic_and_has_no_collisions(spark):
    rows = spark.range(5000).select("id", id_hash("id", 3).alias("h")).collect()
    assert all(r["h"] == hash_number(r["id"], 3) for r in rows)
    assert len({r["h"] for r in rows}) == 5000
    assert all(0 <= r["h"] < PRIME for r in rows)


@pytest.mark.parametrize("rows_per_bucket,partitions", [(10**6, 1), (50, 1), (50, 8), (7, 5)])
def test_range_index_matches_a_sort(spark, rows_per_bucket, partitions):
    rng = np.random.default_rng(1)
    keys = rng.choice(10**9, 700, replace=False)
    df = spark.createDataFrame([(int(k),) for k in keys], "key bigint").repartition(partitions)
    got = {r["key"]: r["row_index"] for r in range_index(df, "key", rows_per_bucket=rows_per_bucket).collect()}
    assert got == {int(k): i for i, k in enumerate(sorted(keys))}


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_over_buckets(spark, descending):
    rng = np.random.default_rng(2)
    v = rng.choice(10**6, 400, replace=False)
    # One group holds most of the rows.
    g = np.where(rng.random(400) < 0.8, 0, rng.integers(1, 4, 400))
    n = rng.integers(1, 9, 400)
    df = spark.createDataFrame([(int(a), float(b), int(c)) for a, b, c in zip(g, v, n)], "g int, v double, n bigint")
    cuts = bucket_cuts(df, ["v"], 400, 30)["v"]
    assert len(cuts) > 5
    got = {(r["g"], r["v"]): r["cum_n"] for r in running_totals(df, "v", ["n"], ["g"], cuts, descending).collect()}
    for group in set(g):
        total = 0
        order = sorted(np.where(g == group)[0], key=lambda i: v[i], reverse=descending)
        for i in order:
            total += n[i]
            assert got[(group, float(v[i]))] == total


def test_hash_index_is_dense_per_group_and_independent_of_layout(spark):
    df = spark.range(997).withColumn("g", F.col("id") % 3)
    one = {r["id"]: r["hash_index"] for r in hash_index(df.repartition(1), "id", 5, ["g"], buckets=1).collect()}
    many = {r["id"]: r["hash_index"] for r in hash_index(df.repartition(9), "id", 5, ["g"], buckets=64).collect()}
    assert one == many
    for g in range(3):
        assert sorted(i for k, i in one.items() if k % 3 == g) == list(range(len([k for k in one if k % 3 == g])))


def test_hash_sample_is_exact_and_repeatable(spark):
    df = spark.range(3000)
    for size in (1, 100, 2999, 3000, 9999):
        a = {r["id"] for r in hash_sample(df.repartition(2), "id", size, 4).collect()}
        b = {r["id"] for r in hash_sample(df.repartition(7), "id", size, 4, slices=3, sort_rows=20).collect()}
        assert a == b and len(a) == min(size, 3000)


@pytest.mark.parametrize("in_task_values", [10**6, 0])
def test_quantiles_match_numpy(spark, in_task_values):
    rng = np.random.default_rng(3)
    cols = {"a": rng.normal(size=900), "b": rng.integers(0, 4, 900).astype(float), "c": np.full(900, 5.0),
            "d": np.where(rng.random(900) < 0.4, np.nan, rng.exponential(size=900)), "e": np.where(rng.random(900) < 0.7, 1.0, rng.normal(size=900))}
    df = frame(spark, {k: [None if np.isnan(x) else x for x in v] for k, v in cols.items()})
    qs = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]
    got = {r["feature"]: r["quantiles"] for r in exact_quantiles(df, list(cols), qs, in_task_values=in_task_values, rows_per_bucket=40).collect()}
    for k, v in cols.items():
        np.testing.assert_allclose(got[k], np.nanpercentile(v, [q * 100 for q in qs]), rtol=1e-12)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.sampled_from([None, -1.0, 0.0, 0.5, 2.0, 7.0]), min_size=1, max_size=40))
def test_bucketed_median_property(spark, values):
    df = frame(spark, {"a": values}, 2)
    got = [r["quantiles"][0] for r in exact_quantiles(df, ["a"], [0.5], in_task_values=0, rows_per_bucket=3).collect()]
    known = [v for v in values if v is not None]
    assert got == ([] if not known else [pytest.approx(float(np.median(known)))])


def test_keys_beyond_the_modulus_are_hashed_by_both_words(spark):
    from tallyloom.functions.hashing import draw_position
    from tallyloom.operators.folds import assign_folds
    ids = spark.range(200).selectExpr(f"id % 40 + id DIV 40 * {PRIME}L AS id")
    rows = ids.select("id", id_hash("id", 3).alias("h")).collect()
    assert len({r["h"] for r in rows}) == len(rows) and all(r["h"] == hash_number(r["id"], 3) for r in rows)
    folds = assign_folds(ids, 3, label=None).groupBy("fold").count().collect()
    assert sorted(r["count"] for r in folds) == [66, 67, 67]
    far = spark.range(2000).select(draw_position("id", 1, 1 << 40).alias("p")).collect()
    assert abs(sum(r["p"] >= 1 << 39 for r in far) - 1000) < 120


def test_digits_find_quantiles_of_awkward_values(spark):
    tiny = np.nextafter(0, 1)
    values = [-np.inf, -1e308, -7.0, -1.0, -1.0 - 2**-52, -tiny, -0.0, 0.0, tiny, 5e-310, 1.0, 1.0 + 2**-52, 2.0, 1e308, np.inf, 3.0, 3.0, None, None]
    df = frame(spark, {"a": values, "none": [None] * len(values), "one": [None] * (len(values) - 1) + [7.25]}, 5)
    qs = [i / 16 for i in range(17)]
    got = {r["feature"]: r["quantiles"] for r in by_digits(df, ["a", "none", "one"], qs).collect()}
    assert got == {"a": sorted(v for v in values if v is not None), "one": [7.25] * 17}


@pytest.mark.parametrize("width", [2, 150])
def test_digits_take_a_fixed_number_of_scans(spark, width):
    seen = spark.sparkContext.accumulator(0)
    rows = 120
    df = frame(spark, {f"c{i}": [float((r * (i + 3)) % 31) / 7 for r in range(rows)] for i in range(width)}, 4)

    def passed(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    watched = df.mapInArrow(passed, df.schema)
    got = {r["feature"]: r["quantiles"] for r in exact_quantiles(watched, df.columns, [0.25, 0.5], rows, in_task_values=0).collect()}
    assert seen.value == SCANS * rows
    assert all(got[f"c{i}"] == pytest.approx(list(np.percentile([float((r * (i + 3)) % 31) / 7 for r in range(rows)], [25, 50]))) for i in range(width))
