"""Sources, selection, imputation, encoding, scaling, balancing and the named levels."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import balance, encode, impute, scale, select
from ..operators.columns import MISSING, per_column, value_counts
from ..plans import levels
from ..sources import sinks, tables
from .base import (
    FEATURES, ORDER_FEATURES, f_orders, hash_sql, orders_sql, query, r6_sql, rounded, table, unpivot_sql,
)

BASE = f"WITH base AS ({orders_sql()}) "
PLAIN = f"WITH base AS ({orders_sql(False)}) "

# --- sources ---------------------------------------------------------------------------------------------------------


@query("load_labelled", """
SELECT d.doc_id AS id, CASE WHEN toxic = 1 THEN 1 ELSE -1 END AS y, CAST(n_chars AS DOUBLE) AS n_chars,
CASE WHEN d.doc_id % 7 <> 0 THEN CAST(n_chars AS DOUBLE) END AS gap FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def load_labelled(spark, sf):
    chars = F.col("n_chars").cast("double")
    features = table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), chars.alias("n_chars"),
        F.when(F.col("doc_id") % 7 == 0, F.lit(float("nan"))).otherwise(chars).alias("gap"))
    labels = table(spark, sf, "labels").select(F.col("doc_id").alias("id"), F.expr("CASE WHEN toxic = 1 THEN 1 ELSE -1 END").alias("y"))
    return tables.labelled(tables.nan_to_null(features), labels)


@query("subsample_every_n", """SELECT id, y, totalprice FROM (
SELECT *, row_number() OVER (ORDER BY id) - 1 AS pos_no FROM (""" + orders_sql(False) + ")) WHERE pos_no % 50 = 0")
def subsample_every_n(spark, sf):
    return tables.every_nth(f_orders(spark, sf, False).select("id", "y", "totalprice"), 50)


@query("select_features", "SELECT o_orderkey AS id, order_month, status_code, price_gap FROM (SELECT * FROM ("
       + orders_sql(False) + ") b JOIN (SELECT o_orderkey FROM orders) o ON b.id = o.o_orderkey)")
def select_features(spark, sf):
    df = f_orders(spark, sf, False).select("id", "y", "totalprice", "custkey", "order_year", "order_month", "status_code", "price_gap")
    return select.without_leading(df, 5, keep=("id",))


# --- selection -------------------------------------------------------------------------------------------------------


@query("drop_missing", BASE + "SELECT id, " + ", ".join(f for f in FEATURES if f not in ("rare", "sparse")) + " FROM base")
def drop_missing(spark, sf):
    df = f_orders(spark, sf)
    return df.select("id", *select.without(FEATURES, select.sparse_features(df, FEATURES, 0.6)))


@query("drop_low_variance", PLAIN + "SELECT id, " + ", ".join(
    f for f in ORDER_FEATURES if f not in ("const_one", "near_const")) + " FROM base")
def drop_low_variance(spark, sf):
    df = f_orders(spark, sf, False)
    return df.select("id", *select.without(ORDER_FEATURES, select.low_variance_features(df, ORDER_FEATURES, 0.995)))


FLAT_95 = PLAIN + ", long AS (" + unpivot_sql("base", ORDER_FEATURES) + """), counts AS (
SELECT feature, value, count(*) AS n FROM long WHERE value IS NOT NULL GROUP BY feature, value)
SELECT feature FROM counts GROUP BY feature HAVING count(*) > 1 AND max(n) < 0.95 * (SELECT count(*) FROM base)"""


@query("drop_low_variance_95", FLAT_95)
def drop_low_variance_95(spark, sf):
    df = f_orders(spark, sf, False)
    kept = select.without(ORDER_FEATURES, select.low_variance_features(df, ORDER_FEATURES, 0.95))
    return spark.createDataFrame([(f,) for f in kept], "feature string")


@query("drop_duplicates", PLAIN + "SELECT id, " + ", ".join(f for f in ORDER_FEATURES if f != "price_copy") + " FROM base")
def drop_duplicates(spark, sf):
    df = f_orders(spark, sf, False)
    return df.select("id", *select.without(ORDER_FEATURES, list(select.duplicate_features(df, ORDER_FEATURES))))


# --- imputation and scaling ------------------------------------------------------------------------------------------

GAPPED = ["totalprice", "price_gap", "rare", "child", "survey", "sum_qty", "mean_disc"]
LONG = BASE + ", long AS (" + unpivot_sql("base", GAPPED) + ") "


@query("fit_impute_mean", LONG + "SELECT feature, round(coalesce(avg(value), 0), 6) AS fill FROM long GROUP BY feature")
def fit_impute_mean(spark, sf):
    return rounded(impute.mean_fill(f_orders(spark, sf), GAPPED))


@query("fit_impute_median", LONG + "SELECT feature, round(coalesce(median(value), 0), 6) AS fill FROM long GROUP BY feature")
def fit_impute_median(spark, sf):
    return rounded(impute.median_fill(f_orders(spark, sf), GAPPED))


@query("fit_impute_mode", LONG + """, ranked AS (SELECT feature, value, row_number() OVER (PARTITION BY feature
ORDER BY count(*) DESC, value) AS p FROM long WHERE value IS NOT NULL GROUP BY feature, value)
SELECT feature, value AS fill FROM ranked WHERE p = 1""")
def fit_impute_mode(spark, sf):
    return impute.mode_fill(f_orders(spark, sf), GAPPED)


@query("apply_impute", BASE + """, m AS (SELECT avg(price_gap) AS price_gap, avg(sum_qty) AS sum_qty FROM base),
c AS (SELECT child FROM base WHERE child IS NOT NULL GROUP BY child ORDER BY count(*) DESC, child LIMIT 1)
SELECT id, round(coalesce(b.price_gap, m.price_gap), 6) AS price_gap, round(coalesce(b.sum_qty, m.sum_qty), 6) AS sum_qty,
coalesce(b.child, c.child) AS child, coalesce(rare, 0) AS rare FROM base b, m, c""")
def apply_impute(spark, sf):
    df = f_orders(spark, sf).select("id", "price_gap", "sum_qty", "child", "rare")
    fill = impute.fit_fill(df, ["price_gap", "sum_qty"], ["child"])
    return rounded(impute.apply_fill(df, ["price_gap", "sum_qty", "child", "rare"], fill))


SCALED = ["totalprice", "custkey", "const_one", "order_month", "n_lines"]


@query("standardize", BASE + ", s AS (SELECT " + ", ".join(
    f"avg({f}) AS m_{f}, stddev_pop({f}) AS s_{f}" for f in SCALED) + " FROM base WHERE id % 5 <> 0) SELECT id, " + ", ".join(
    r6_sql("({0} - m_{0}) / CASE WHEN s_{0} > 1e-12 THEN s_{0} ELSE 1 END".format(f)) + f" AS {f}" for f in SCALED) + " FROM base, s")
def standardize(spark, sf):
    df = f_orders(spark, sf).select("id", *SCALED)
    return rounded(scale.apply_scale(df, SCALED, scale.fit_scale(df.where("id % 5 <> 0"), SCALED)))


# --- encodings -------------------------------------------------------------------------------------------------------

CATEGORICAL = ["status_code", "order_month", "survey", "custkey", "child"]


def kept_sql(min_count: int, cap: int, source: str = "base", features=tuple(CATEGORICAL)) -> str:
    """CTEs ``counts``, ``kept`` (with place) and ``totals`` over the long form of ``source``."""
    return (f"long AS ({unpivot_sql(source, list(features))}), counts AS (SELECT feature, value, count(*) AS n, "
            "sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS n_pos FROM long GROUP BY feature, value), "
            f"kept AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY n DESC, value DESC) AS place "
            f"FROM counts WHERE n >= {min_count}) WHERE place <= {cap}), "
            "totals AS (SELECT feature, count(*) AS k, sum(n) AS n, sum(n_pos) AS n_pos FROM counts GROUP BY feature), "
            "sizes AS (SELECT feature, count(*) AS k, sum(n) AS n, sum(n_pos) AS n_pos FROM kept GROUP BY feature)")


FILLED = BASE + ", filled AS (SELECT id, y, status_code, order_month, survey, custkey, coalesce(child, 0) AS child FROM base) "


@query("fit_one_hot", FILLED + "," + kept_sql(50, 8, "filled") + """
SELECT t.feature, CAST(coalesce(place, 0) AS INTEGER) AS place, value, coalesce(s.k, 0) < t.k AS other
FROM totals t LEFT JOIN sizes s USING (feature) LEFT JOIN kept USING (feature)""")
def fit_one_hot(spark, sf):
    df = impute.apply_fill(f_orders(spark, sf), CATEGORICAL, {})
    return encode.fit_one_hot(value_counts(df, CATEGORICAL), 50, 8)


HOT = ["status_code", "survey"]


@query("one_hot", PLAIN + "," + kept_sql(50, 2, "base", HOT) + " SELECT b.id, u.feature || '=' || CASE WHEN k.value IS NULL THEN 'OTHER' "
       "ELSE CAST(CAST(k.value AS BIGINT) AS VARCHAR) END AS hot FROM base b, LATERAL (SELECT 'status_code' AS feature, b.status_code AS value "
       "UNION ALL SELECT 'survey', b.survey) u LEFT JOIN kept k ON k.feature = u.feature AND k.value = u.value")
def one_hot(spark, sf):
    df = f_orders(spark, sf, False).select("id", *HOT)
    specs = encode.collect_one_hot(encode.fit_one_hot(value_counts(df, HOT), 50, 2))
    coded = encode.apply_one_hot(df, HOT, specs)
    return coded.unpivot(["id"], [c for c in coded.columns if c != "id"], "hot", "value").where("value = 1").select("id", "hot")


ENCODED = """, g AS (SELECT avg(y) AS mean FROM base), enc AS (
SELECT k.feature, place, value, k.n, (2 * k.n_pos - k.n + mean) / (k.n + 1) AS encoding FROM kept k, g),
others AS (SELECT t.feature, t.n - coalesce(s.n, 0) AS n, CASE WHEN t.n > coalesce(s.n, 0) THEN
(2 * (t.n_pos - coalesce(s.n_pos, 0)) - (t.n - coalesce(s.n, 0)) + mean) / (t.n - coalesce(s.n, 0) + 1) ELSE mean END AS encoding,
coalesce(s.k, 0) < t.k AS has_other FROM totals t LEFT JOIN sizes s USING (feature), g) """


@query("fit_target_encoding", FILLED + "," + kept_sql(50, 8, "filled") + ENCODED + f"""
SELECT feature, CAST(place AS INTEGER) AS place, value, CAST(n AS BIGINT) AS n, {r6_sql('encoding')} AS encoding, NULL AS has_other FROM enc
UNION ALL SELECT feature, 0, NULL, n, {r6_sql('encoding')}, has_other FROM others""")
def fit_target_encoding(spark, sf):
    df = impute.apply_fill(f_orders(spark, sf), CATEGORICAL, {})
    mean = df.agg(F.avg("y")).first()[0]
    return rounded(encode.fit_target_encoding(value_counts(df, CATEGORICAL, "y"), mean, 50, 8))


@query("target_encoding", FILLED + "," + kept_sql(50, 8, "filled") + ENCODED + "SELECT id, " + ", ".join(
    r6_sql(f"coalesce(e_{f}.encoding, CASE WHEN o_{f}.has_other THEN o_{f}.encoding ELSE g.mean END)") + f" AS {f}"
    for f in CATEGORICAL) + " FROM filled b JOIN g ON true " + " ".join(
    f"LEFT JOIN enc e_{f} ON e_{f}.feature = '{f}' AND e_{f}.value = b.{f} LEFT JOIN others o_{f} ON o_{f}.feature = '{f}'"
    for f in CATEGORICAL))
def target_encoding(spark, sf):
    df = impute.apply_fill(f_orders(spark, sf), CATEGORICAL, {})
    mean = df.agg(F.avg("y")).first()[0]
    spec = encode.fit_target_encoding(value_counts(df, CATEGORICAL, "y"), mean, 50, 8)
    return rounded(encode.apply_target_encoding(df, CATEGORICAL, encode.collect_target_encoding(spec), mean))


def cross_fit_sql() -> str:
    kept = kept_sql(50, 8, "filled")
    inside = kept[len("long AS ("):kept.index("), counts AS")]
    outside = (f"long AS (SELECT CAST(f AS VARCHAR) || '#' || feature AS feature, value, y FROM ({unpivot_sql('filled', CATEGORICAL, ('y', 'id'))}) "
               "JOIN range(5) r(f) ON id % 5 <> f")
    columns = ", ".join(r6_sql(f"coalesce(e_{f}.encoding, CASE WHEN o_{f}.has_other THEN o_{f}.encoding ELSE g.mean END)") + f" AS {f}" for f in CATEGORICAL)
    joins = " ".join(f"LEFT JOIN enc e_{f} ON e_{f}.feature = CAST(b.id % 5 AS VARCHAR) || '#{f}' AND e_{f}.value = b.{f} "
                     f"LEFT JOIN others o_{f} ON o_{f}.feature = CAST(b.id % 5 AS VARCHAR) || '#{f}'" for f in CATEGORICAL)
    return f"{FILLED},{kept.replace('long AS (' + inside, outside)}{ENCODED} SELECT id, {columns} FROM filled b JOIN g ON true {joins}"


@query("target_encoding_cross_fit", cross_fit_sql())
def target_encoding_cross_fit(spark, sf):
    df = impute.apply_fill(f_orders(spark, sf), CATEGORICAL, {}).withColumn("fold", F.expr("id % 5"))
    mean = df.agg(F.avg("y")).first()[0]
    return rounded(encode.cross_fit_target_encoding(df, CATEGORICAL, "fold", mean, 50, 8))


# --- balancing -------------------------------------------------------------------------------------------------------


def oversample_sql(source: str, columns: str, target: float, seed: int = 1) -> str:
    """Original rows and drawn copies of ``source``; the statement itself holds the CTEs ``pos``, ``need``, ``draws``."""
    return (f"pos AS (SELECT *, row_number() OVER (ORDER BY {hash_sql('id', seed)}) - 1 AS pos_no FROM {source} WHERE y = 1), "
            f"need AS (SELECT greatest(0, CAST(ceil(CAST({target} AS DOUBLE) * count(*) FILTER (y = -1) / (1 - CAST({target} AS DOUBLE))) AS BIGINT) "
            f"- count(*) FILTER (y = 1)) AS extra, count(*) FILTER (y = 1) AS n_pos FROM {source}), "
            f"draws AS (SELECT i + 1 AS copy, ({hash_sql('i', seed)} * 2147483647 + {hash_sql('i', seed + 500000)}) % n_pos AS pos_no FROM need, unnest(range(extra)) r(i)) "
            f"SELECT {columns}, 0 AS copy FROM {source} UNION ALL SELECT {columns}, copy FROM draws JOIN pos USING (pos_no)")


@query("oversample", PLAIN + "," + oversample_sql("base", "id, y, totalprice", 0.35))
def oversample(spark, sf):
    return balance.oversample(f_orders(spark, sf, False).select("id", "y", "totalprice"), 0.35)


# --- levels ----------------------------------------------------------------------------------------------------------

TRAIN, TEST = "id % 5 <> 0", "id % 5 = 0"


def level_sql(preset: levels.Preset, continuous: list[str], categorical: list[str], target: float | None,
              split: str = "train") -> str:
    """A level over known column groups: fill, scale, target-encode, oversample."""
    center = "median" if preset.strategy == "median" else "avg"
    fills = ", ".join(f"coalesce({center}({f}), 0) AS {f}" for f in continuous)
    mode_columns = ", ".join(
        f"(SELECT {f} FROM train WHERE {f} IS NOT NULL GROUP BY {f} ORDER BY count(*) DESC, {f} LIMIT 1) AS {f}" for f in categorical)
    filled = ", ".join([f"coalesce(b.{f}, fills.{f}) AS {f}" for f in continuous]
                       + [f"coalesce(b.{f}, modes.{f}, 0) AS {f}" for f in categorical])
    moments = ", ".join(f"avg({f}) AS m_{f}, CASE WHEN stddev_pop({f}) > 1e-12 THEN stddev_pop({f}) ELSE 1 END AS s_{f}" for f in continuous)
    smooth = f"CAST({preset.smoothing} AS DOUBLE)"
    kept = kept_sql(preset.min_count, preset.max_categories, "filled", categorical)
    encoded = (f"g AS (SELECT avg(y) AS mean FROM train), enc AS (SELECT k.feature, value, (2 * k.n_pos - k.n + mean * {smooth}) "
               f"/ (k.n + {smooth}) AS encoding FROM kept k, g), others AS (SELECT t.feature, CASE WHEN t.n > coalesce(s.n, 0) THEN "
               f"(2 * (t.n_pos - coalesce(s.n_pos, 0)) - (t.n - coalesce(s.n, 0)) + mean * {smooth}) / (t.n - coalesce(s.n, 0) + {smooth}) "
               "ELSE mean END AS encoding, coalesce(s.k, 0) < t.k AS has_other FROM totals t LEFT JOIN sizes s USING (feature), g)")
    scaled = [r6_sql(f"(b.{f} - m_{f}) / s_{f}") + f" AS {f}" for f in continuous]
    codes = [r6_sql(f"coalesce(e_{f}.encoding, CASE WHEN o_{f}.has_other THEN o_{f}.encoding ELSE g.mean END)") + f" AS {f}"
             for f in categorical]
    joins = " ".join(f"LEFT JOIN enc e_{f} ON e_{f}.feature = '{f}' AND e_{f}.value = b.{f} "
                     f"LEFT JOIN others o_{f} ON o_{f}.feature = '{f}'" for f in categorical)
    head = (f"WITH base AS ({orders_sql()}), train AS (SELECT * FROM base WHERE {TRAIN}), fills AS (SELECT {fills} FROM train), "
            f"modes AS (SELECT {mode_columns}), filled AS (SELECT id, y, {filled} FROM train b, fills, modes), "
            f"moments AS (SELECT {moments} FROM filled), {kept}, {encoded}, "
            f"asked AS (SELECT id, y, {filled} FROM base b, fills, modes WHERE {TRAIN if split == 'train' else TEST}), "
            f"ready AS (SELECT b.id, b.y, {', '.join(scaled + codes)} FROM asked b JOIN moments ON true JOIN g ON true {joins})")
    columns = ", ".join(["id", "y", *continuous, *categorical] if split == "train" else ["id", *continuous, *categorical])
    if split == "train" and target:
        return f"{head}, {oversample_sql('ready', columns, target)}"
    return f"{head} SELECT {columns} FROM ready"


# Columns each level keeps on the orders table, as the SQL statements spell them out.
CONTINUOUS = ["totalprice", "price_gap", "price_copy", "price_near", "sum_qty", "mean_disc"]
COMMON = ["custkey", "order_year", "order_month", "status_code", "survey", "parent", "child", "date_like", "year_like", "n_lines"]


def level_columns(level: str) -> tuple[list[str], list[str]]:
    continuous, categorical = list(CONTINUOUS), list(COMMON)
    if level == "level0":
        categorical += ["rare", "sparse", "const_one", "near_const"]
    if level == "level1":
        categorical.append("near_const")
    if level in ("level3", "level4"):
        continuous.remove("price_copy")
    if level == "level3":
        categorical.remove("child")
    return continuous, categorical


CHOSEN = [*CONTINUOUS]


def _level(level: str):
    continuous, categorical = level_columns(level)
    preset = levels.LEVELS[level]

    @query(level, level_sql(preset, continuous, categorical, preset.oversample))
    def run(spark, sf):
        df = f_orders(spark, sf)
        train, _, _ = levels.prepare(df.where(TRAIN), df.where(TEST), FEATURES, level, CHOSEN)
        return rounded(train)

    return run


for _name in levels.LEVELS:
    _level(_name)


@query("preset_transform", level_sql(levels.LEVELS["level1"], *level_columns("level1"), None, "test"))
def preset_transform(spark, sf):
    df = f_orders(spark, sf)
    state = levels.fit_preset(df.where(TRAIN), FEATURES, CHOSEN, levels.LEVELS["level1"])
    return rounded(levels.transform(df.where(TEST), state))


@query("preset_train_test", level_sql(levels.LEVELS["level3"], *level_columns("level3"), None, "test"))
def preset_train_test(spark, sf):
    df = f_orders(spark, sf)
    _, test, _ = levels.prepare(df.where(TRAIN), df.where(TEST), FEATURES, "level3", CHOSEN)
    return rounded(test)


LEVEL2 = levels.LEVELS["level2_unbalanced"]
_CONT, _CAT = level_columns("level2_unbalanced")


@query("fit_preset", f"WITH base AS ({orders_sql()}), train AS (SELECT * FROM base WHERE {TRAIN}) "
       + " UNION ALL ".join(f"SELECT '{f}' AS feature, 'continuous' AS part, round(avg({f}), 3) AS fill, "
                            f"count(*) - count({f}) AS missing FROM train" for f in _CONT) + " UNION ALL "
       + " UNION ALL ".join(f"SELECT '{f}', 'categorical', (SELECT {f} FROM train WHERE {f} IS NOT NULL GROUP BY {f} "
                            f"ORDER BY count(*) DESC, {f} LIMIT 1), count(*) - count({f}) FROM train" for f in _CAT) + " UNION ALL "
       + " UNION ALL ".join(f"SELECT '{f}', 'dropped', NULL, count(*) - count({f}) FROM train"
                            for f in FEATURES if f not in _CONT + _CAT))
def fit_preset(spark, sf):
    train = f_orders(spark, sf).where(TRAIN)
    state = levels.fit_preset(train, FEATURES, CHOSEN, LEVEL2)
    part = {**{f: "continuous" for f in state.continuous}, **{f: "categorical" for f in state.categorical},
            **{f: "dropped" for f in state.dropped}}
    learned = spark.createDataFrame([(f, p, state.fill.get(f)) for f, p in part.items()], "feature string, part string, fill double")
    gaps = per_column(train, FEATURES, {"missing": MISSING})
    return rounded(learned.join(gaps, "feature"), 3)


# --- level 5 ---------------------------------------------------------------------------------------------------------

L5_CONTINUOUS = ["totalprice", "custkey", "order_year", "price_gap", "price_copy", "price_near", "survey", "date_like",
                 "year_like", "n_lines", "sum_qty", "mean_disc"]
L5_VALUES = {"order_month": range(1, 13), "status_code": range(3), "child": range(10)}
# Line counts have more values on larger tables; forcing the role keeps the columns the same at every scale.
L5_FORCED = ["n_lines", "survey"]


def level5_sql(split: str) -> str:
    means = ", ".join(f"coalesce(avg({f}), 0) AS {f}" for f in L5_CONTINUOUS)
    filled = ", ".join([f"coalesce(b.{f}, means.{f}) AS {f}" for f in L5_CONTINUOUS] + [f"coalesce(b.{f}, 0) AS {f}" for f in L5_VALUES])
    moments = ", ".join(f"avg({f}) AS m_{f}, CASE WHEN stddev_pop({f}) > 1e-12 THEN stddev_pop({f}) ELSE 1 END AS s_{f}" for f in L5_CONTINUOUS)
    scaled = ", ".join(r6_sql(f"({f} - m_{f}) / s_{f}") + f" AS {f}" for f in L5_CONTINUOUS)
    # const_one has one value and counts as a categorical column of its own.
    hot = ", ".join(f'CAST({f} = {v} AS DOUBLE) AS "{f}={v}"' for f, vs in L5_VALUES.items() for v in vs)
    hot += ', CAST(1 AS DOUBLE) AS "const_one=1"'
    names = [*L5_CONTINUOUS, *[f'"{f}={v}"' for f, vs in L5_VALUES.items() for v in vs], '"const_one=1"']
    head = (f"WITH base AS ({orders_sql()}), train AS (SELECT * FROM base WHERE {TRAIN}), means AS (SELECT {means} FROM train), "
            f"moments AS (SELECT {moments} FROM (SELECT {filled} FROM train b, means)), "
            f"ready AS (SELECT id, y, {scaled}, {hot} FROM (SELECT id, y, {filled} FROM base b, means "
            f"WHERE {TRAIN if split == 'train' else TEST}), moments)")
    if split == "train":
        return f"{head}, {oversample_sql('ready', ', '.join(['id', 'y', *names]), 0.35)}"
    return f"{head} SELECT id, {', '.join(names)} FROM ready"


@query("level5", level5_sql("train"))
def level5(spark, sf):
    df = f_orders(spark, sf)
    train, _, _ = levels.prepare(df.where(TRAIN), df.where(TEST), FEATURES, "level5", forced_continuous=L5_FORCED)
    return rounded(train)


@query("level5_test_split", level5_sql("test"))
def level5_test_split(spark, sf):
    df = f_orders(spark, sf)
    _, test, _ = levels.prepare(df.where(TRAIN), df.where(TEST), FEATURES, "level5", balanced=False, forced_continuous=L5_FORCED)
    return rounded(test)


# --- sinks -----------------------------------------------------------------------------------------------------------


def _written_level(spark, sf):
    """Level 1 written to a folder of its own in the shared folder, and read back."""
    df = f_orders(spark, sf)
    train, test, state = levels.prepare(df.where(TRAIN), df.where(TEST), FEATURES, "level1", CHOSEN)
    folder = sinks.new_folder(spark)
    sinks.save_level(train, test, state, folder)
    return sinks.load_level(spark, folder)


@query("save_level", level_sql(levels.LEVELS["level1"], *level_columns("level1"), levels.LEVELS["level1"].oversample))
def save_level(spark, sf):
    return rounded(_written_level(spark, sf)[0])


@query("load_level", level_sql(levels.LEVELS["level1"], *level_columns("level1"), None, "test"))
def load_level(spark, sf):
    return rounded(_written_level(spark, sf)[1])


@query("submission", "SELECT o_orderkey AS \"Id\", CASE WHEN o_totalprice / 500000 >= 0.5 THEN 1 ELSE -1 END AS \"Prediction\" FROM orders")
def submission(spark, sf):
    from ..functions.scalar import signed_label
    df = f_orders(spark, sf, False)
    return sinks.submission(df.select("id", signed_label(F.col("totalprice") / 500000, 0.5).alias("y_hat")))


@query("numbered_rows", "SELECT row_number() OVER (ORDER BY o_orderkey) AS id, o_totalprice AS totalprice FROM orders")
def numbered_rows(spark, sf):
    df = f_orders(spark, sf, False).select(F.col("id").alias("orderkey"), "totalprice")
    return tables.with_row_ids(df, "orderkey").select("id", "totalprice")
