"""Profiling reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import linear, profile, roles, scale
from ..operators.encode import one_hot_all
from ..operators.ranks import hash_sample
from .base import (
    FEATURES, LINEITEM_FEATURES, ORDER_FEATURES, f_lineitem, f_orders, hash_sql, lineitem_sql, orders_sql, query,
    r6_sql, rounded, unpivot_sql,
)

BASE = f"WITH base AS ({orders_sql()}), long AS ({unpivot_sql('base', FEATURES)}) "
PLAIN = f"WITH base AS ({orders_sql(False)}), long AS ({unpivot_sql('base', ORDER_FEATURES)}) "
LINES = f"WITH base AS ({lineitem_sql()}), long AS ({unpivot_sql('base', LINEITEM_FEATURES)}) "
FACTS = ("facts AS (SELECT feature, min(value) AS lo, max(value) AS hi, avg(value) AS mean, median(value) AS med, "
         "stddev_pop(value) AS std, count(*) AS n, count(*) - count(value) AS missing, count(DISTINCT value) AS k, "
         "bool_and(value % 1 = 0) AS whole FROM long GROUP BY feature) ")
COUNTS = ("counts AS (SELECT feature, value, count(*) AS n, CAST(sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_pos "
          "FROM long WHERE value IS NOT NULL GROUP BY feature, value) ")


@query("dataset_overview", BASE + f"""
SELECT CAST(sum(count(*)) OVER () AS BIGINT) AS rows, {len(FEATURES)} AS features, y, count(*) AS n FROM base GROUP BY y""")
def dataset_overview(spark, sf):
    return profile.dataset_overview(f_orders(spark, sf), FEATURES)


SUMMARY = ("SELECT feature, " + ", ".join(f"{r6_sql(c)} AS \"{n}\"" for c, n in (
    ("lo", "min"), ("hi", "max"), ("mean", "mean"), ("med", "median"), ("std", "std")))
    + ", missing, k AS \"distinct\" FROM facts")


@query("summarize_features", BASE + "," + FACTS + SUMMARY)
def summarize_features(spark, sf):
    return rounded(profile.summarize(f_orders(spark, sf), FEATURES))


@query("summarize_lineitem", LINES + "," + FACTS + SUMMARY)
def summarize_lineitem(spark, sf):
    return rounded(profile.summarize(f_lineitem(spark, sf), LINEITEM_FEATURES))


@query("summary_head", LINES + "," + FACTS + """
SELECT feature, round(lo, 2) AS "min", round(hi, 2) AS "max", round(mean, 2) AS mean, round(med, 2) AS median,
       round(std, 2) AS std, missing, k AS "distinct" FROM facts ORDER BY feature LIMIT 5""")
def summary_head(spark, sf):
    return rounded(profile.summarize(f_lineitem(spark, sf), LINEITEM_FEATURES).orderBy("feature").limit(5), 2)


SHARES = "shares AS (SELECT feature, (count(*) - count(value)) / count(*) AS s FROM long GROUP BY feature) "


@query("missingness", BASE + "," + SHARES + "SELECT feature, round(s, 6) AS missing_share FROM shares")
def missingness(spark, sf):
    return rounded(profile.missing_shares(f_orders(spark, sf), FEATURES))


@query("missingness_overview", BASE + "," + SHARES + """
SELECT count(*) FILTER (s = 0) AS complete, count(*) FILTER (s > 0) AS incomplete, round(max(s), 6) AS worst FROM shares""")
def missingness_overview(spark, sf):
    return rounded(profile.missing_overview(profile.missing_shares(f_orders(spark, sf), FEATURES)))


@query("missingness_bins", BASE + "," + SHARES + """, bins AS (
SELECT * FROM (VALUES (CAST(0 AS DOUBLE), CAST(0.05 AS DOUBLE)), (0.05, 0.2), (0.2, 0.5), (0.5, 1.0)) b(low, high))
SELECT low, high, count(feature) AS features FROM bins
LEFT JOIN shares ON s >= low AND (s < high OR (high = 1 AND s = 1)) GROUP BY low, high""")
def missingness_bins(spark, sf):
    return profile.missing_bins(profile.missing_shares(f_orders(spark, sf), FEATURES))


@query("target_distribution", "SELECT y, count(*) AS n FROM (" + lineitem_sql() + ") GROUP BY y")
def target_distribution(spark, sf):
    return profile.label_counts(f_lineitem(spark, sf))


@query("constant_features", PLAIN + "," + COUNTS + """
SELECT feature, max(value) AS value FROM counts GROUP BY feature HAVING count(*) = 1""")
def constant_features(spark, sf):
    return profile.constant_features(f_orders(spark, sf, False), ORDER_FEATURES)


@query("near_constant_features", PLAIN + "," + COUNTS + """
SELECT feature, arg_max(value, n) AS value, round(max(n) / (SELECT count(*) FROM base), 6) AS share FROM counts
GROUP BY feature HAVING max(n) / (SELECT count(*) FROM base) >= 0.99""")
def near_constant_features(spark, sf):
    return rounded(profile.top_value_shares(f_orders(spark, sf, False), ORDER_FEATURES, 0.99))


@query("frequent_value_features", PLAIN + "," + COUNTS + """
SELECT feature, max(n) / (SELECT count(*) FROM base) >= 0.45 AS reached, round(max(n) / (SELECT count(*) FROM base), 6) AS share
FROM counts GROUP BY feature HAVING max(n) / (SELECT count(*) FROM base) >= 0.3""")
def frequent_value_features(spark, sf):
    shares = profile.top_value_shares(f_orders(spark, sf, False), ORDER_FEATURES, 0.3)
    return rounded(shares.select("feature", (F.col("share") >= 0.45).alias("reached"), "share"))


@query("near_constant_detail", PLAIN + "," + COUNTS + """, ranked AS (
SELECT *, row_number() OVER (PARTITION BY feature ORDER BY value) AS position FROM counts
WHERE feature IN (SELECT feature FROM counts GROUP BY feature HAVING max(n) / (SELECT count(*) FROM base) >= 0.99))
SELECT feature, value, n, n_pos, CAST(position AS INTEGER) AS position, round(n_pos / n, 6) AS rate FROM ranked WHERE position <= 5""")
def near_constant_detail(spark, sf):
    df = f_orders(spark, sf, False)
    flat = [r["feature"] for r in profile.top_value_shares(df, ORDER_FEATURES, 0.99).collect()]
    return rounded(profile.value_detail(df, flat, "y"))


@query("value_detail_lineitem", LINES + "," + COUNTS + """, ranked AS (
SELECT *, row_number() OVER (PARTITION BY feature ORDER BY value) AS position FROM counts)
SELECT feature, value, n, n_pos, CAST(position AS INTEGER) AS position, round(n_pos / n, 6) AS rate FROM ranked WHERE position <= 5""")
def value_detail_lineitem(spark, sf):
    return rounded(profile.value_detail(f_lineitem(spark, sf), LINEITEM_FEATURES, "y"))


@query("feature_scale_summary", BASE + "," + FACTS + """
SELECT round(min(lo), 6) AS global_min, round(max(hi), 6) AS global_max, round(median(std), 6) AS median_std,
       count(*) FILTER (std < 1e-6) AS tiny, count(*) FILTER (std > 1e3) AS huge FROM facts""")
def feature_scale_summary(spark, sf):
    return rounded(profile.scale_summary(profile.scales(f_orders(spark, sf), FEATURES)))


@query("std_histogram", BASE + "," + FACTS + """, span AS (SELECT min(std) AS lo, max(std) AS hi FROM facts),
placed AS (SELECT CAST(least(floor((std - span.lo) * 50 / (span.hi - span.lo)), 49) AS INTEGER) AS bin, span.lo, span.hi FROM facts, span)
SELECT bin, round(lo + bin * ((hi - lo) / 50), 6) AS low, round(lo + (bin + 1) * ((hi - lo) / 50), 6) AS high, count(*) AS n
FROM placed GROUP BY bin, lo, hi""")
def std_histogram(spark, sf):
    return rounded(profile.equal_width_histogram(profile.scales(f_orders(spark, sf), FEATURES), F.col("std"), 50))


@query("extreme_scale_features", BASE + "," + FACTS + """
SELECT feature, round(std, 6) AS std, CASE WHEN std < 1e-6 THEN 'small' ELSE 'large' END AS side FROM facts
WHERE std < 1e-6 OR std > 1e3""")
def extreme_scale_features(spark, sf):
    return rounded(profile.extreme_scales(profile.scales(f_orders(spark, sf), FEATURES)))


@query("feature_histogram", LINES + """, span AS (SELECT min(extendedprice) AS lo, max(extendedprice) AS hi FROM base),
placed AS (SELECT CAST(least(floor((extendedprice - lo) * 30 / (hi - lo)), 29) AS INTEGER) AS bin, lo, hi FROM base, span
WHERE extendedprice IS NOT NULL)
SELECT bin, round(lo + bin * ((hi - lo) / 30), 6) AS low, round(lo + (bin + 1) * ((hi - lo) / 30), 6) AS high, count(*) AS n
FROM placed GROUP BY bin, lo, hi""")
def feature_histogram(spark, sf):
    return rounded(profile.equal_width_histogram(f_lineitem(spark, sf), F.col("extendedprice"), 30))


ROLE = """CASE WHEN missing = n OR missing / n > 0.95 THEN 'ignored' WHEN k = 2 THEN 'binary'
WHEN k = 1 AND missing / n > 0.5 + 0.1 * ln(1 + n) THEN 'pseudo_binary'
WHEN whole AND k <= 15 AND hi <= 20 AND hi - lo <= 20 THEN 'categorical'
WHEN k > 15 OR hi > 20 OR NOT whole THEN 'continuous' ELSE 'categorical' END"""


@query("feature_types", BASE + "," + FACTS + f"SELECT feature, {ROLE} AS role FROM facts")
def feature_types(spark, sf):
    return roles.feature_roles(f_orders(spark, sf), FEATURES)


@query("role_override", BASE + "," + FACTS + f"""
SELECT feature, CASE WHEN feature IN ('survey', 'order_month', 'parent') THEN 'continuous' ELSE {ROLE} END AS role FROM facts""")
def role_override(spark, sf):
    return roles.override_roles(roles.feature_roles(f_orders(spark, sf), FEATURES), ["survey", "order_month", "parent"])


@query("survey_code_flag", """
SELECT l_suppkey, regexp_matches(CAST(CAST(trunc(abs(l_suppkey)) AS BIGINT) AS VARCHAR), '^([70]+|[90]+)$') AS is_code, count(*) AS n
FROM lineitem GROUP BY l_suppkey""")
def survey_code_flag(spark, sf):
    from ..functions.scalar import is_survey_code
    from .base import table
    lines = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    return lines.select("l_suppkey", is_survey_code("l_suppkey").alias("is_code"), "n")


CODES = """, ranked AS (SELECT feature, value, row_number() OVER (PARTITION BY feature ORDER BY value DESC) AS p,
count(*) OVER (PARTITION BY feature) AS k, min(value) OVER (PARTITION BY feature) AS lo FROM counts),
tops AS (SELECT feature, max(k) AS k, max(lo) AS lo, max(value) FILTER (p = 1) AS v1, max(value) FILTER (p = 2) AS v2,
max(value) FILTER (p = 3) AS v3 FROM ranked GROUP BY feature HAVING max(k) >= 4),
gaps AS (SELECT *, (v3 - lo) / (k - 3) AS gap,
regexp_matches(CAST(CAST(trunc(abs(v1)) AS BIGINT) AS VARCHAR), '^([70]+|[90]+)$') AS c1,
regexp_matches(CAST(CAST(trunc(abs(v2)) AS BIGINT) AS VARCHAR), '^([70]+|[90]+)$') AS c2 FROM tops),
codes AS (SELECT feature, v1 AS code FROM gaps WHERE v1 - v2 >= 2 * gap AND c1
UNION ALL SELECT feature, v2 FROM gaps WHERE v1 - v2 >= 2 * gap AND v2 - v3 >= 2 * gap AND c1 AND c2) """


@query("survey_codes", BASE + "," + COUNTS + CODES + "SELECT feature, code FROM codes")
def survey_codes(spark, sf):
    return roles.survey_codes(f_orders(spark, sf), FEATURES)


@query("clean_survey_codes", PLAIN + "," + COUNTS + CODES + """
SELECT id, CASE WHEN survey NOT IN (SELECT code FROM codes WHERE feature = 'survey') THEN survey END AS survey,
totalprice, order_month FROM base""")
def clean_survey_codes(spark, sf):
    df = f_orders(spark, sf, False)
    return roles.clear_survey_codes(df, roles.survey_codes(df, ORDER_FEATURES)).select("id", "survey", "totalprice", "order_month")


@query("dependent_features", f"WITH base AS ({orders_sql()}), pl AS ("
       + unpivot_sql("base", [f for f in FEATURES if f != "parent"], ("parent",)) + """)
SELECT feature, round(avg(CASE WHEN value IS NULL THEN 1 ELSE 0 END) FILTER (parent IS NULL OR parent = 0), 6) AS missing_share
FROM pl GROUP BY feature HAVING count(value) > 0
AND avg(CASE WHEN value IS NULL THEN 1 ELSE 0 END) FILTER (parent IS NULL OR parent = 0) > 0.95""")
def dependent_features(spark, sf):
    return rounded(roles.dependent_features(f_orders(spark, sf), "parent", FEATURES))


SUSPECT = """, suspects AS (SELECT feature, CASE WHEN lo BETWEEN 1900 AND 2100 AND hi <= 2100 THEN 'year'
WHEN lo BETWEEN 1 AND 31 AND k <= 31 AND std < 10 AND k / n < 0.05 AND med <= 12 THEN 'month_or_day'
WHEN whole AND hi > 9999 AND k / n < 0.1 THEN 'id' END AS kind FROM facts WHERE k > 0) """


@query("date_or_id_features", BASE + "," + FACTS + SUSPECT + "SELECT feature, kind FROM suspects WHERE kind IS NOT NULL")
def date_or_id_features(spark, sf):
    return roles.date_or_id_features(f_orders(spark, sf), FEATURES)


@query("continuous_minus_suspects", BASE + "," + FACTS + SUSPECT + f"""
SELECT feature FROM facts WHERE {ROLE} = 'continuous' AND feature NOT IN (SELECT feature FROM suspects WHERE kind IS NOT NULL)""")
def continuous_minus_suspects(spark, sf):
    from ..plans.levels import continuous_candidates
    names = continuous_candidates(f_orders(spark, sf), FEATURES)
    return spark.createDataFrame([(n,) for n in names], "feature string")


@query("suspect_report", BASE + "," + FACTS + SUSPECT + """
SELECT feature, round(mean, 6) AS mean, lo AS "min", hi AS "max", k AS "distinct" FROM facts
WHERE feature IN (SELECT feature FROM suspects WHERE kind IS NOT NULL)""")
def suspect_report(spark, sf):
    df = f_orders(spark, sf)
    found = [r["feature"] for r in roles.date_or_id_features(df, FEATURES).collect()]
    return rounded(roles.suspect_report(df, found))


CORRELATED = ["totalprice", "custkey", "order_month", "status_code", "price_gap", "price_near", "survey", "sum_qty", "mean_disc"]


def _pair_sql(condition: str) -> str:
    means = ", ".join(f"avg({f}) AS {f}" for f in CORRELATED)
    filled = ", ".join(f"coalesce(b.{f}, m.{f}) AS {f}" for f in CORRELATED)
    pairs = " UNION ALL ".join(
        f"SELECT {i} AS i, {j} AS j, '{a}' AS feature_i, '{b}' AS feature_j, corr({a}, {b}) AS r FROM filled"
        for i, a in enumerate(CORRELATED) for j, b in enumerate(CORRELATED))
    return (f"WITH base AS ({orders_sql()}), m AS (SELECT {means} FROM base), filled AS (SELECT {filled} FROM base b, m), "
            f"pairs AS ({pairs}) {condition}")


@query("correlation_matrix", _pair_sql(f"SELECT i, j, feature_i, feature_j, {r6_sql('r')} AS r FROM pairs"))
def correlation_matrix(spark, sf):
    return rounded(linear.correlations(f_orders(spark, sf), CORRELATED))


@query("highly_correlated", _pair_sql("SELECT feature_i, feature_j, round(r, 6) AS r FROM pairs WHERE i < j AND abs(r) > 0.9"))
def highly_correlated(spark, sf):
    return rounded(linear.correlated_pairs(f_orders(spark, sf), CORRELATED, 0.9))


REPORT = """, report AS (SELECT feature, min(value) AS lo, max(value) AS hi, quantile_cont(value, 0.01) AS q_low,
quantile_cont(value, 0.99) AS q_high FROM long GROUP BY feature HAVING count(*) = count(value)
AND (min(value) < quantile_cont(value, 0.01) OR max(value) > quantile_cont(value, 0.99))) """


@query("outlier_report", LINES + REPORT + """
SELECT feature, lo AS "min", hi AS "max", round(q_low, 6) AS q_low, round(q_high, 6) AS q_high FROM report""")
def outlier_report(spark, sf):
    return rounded(profile.outlier_report(f_lineitem(spark, sf), LINEITEM_FEATURES))


@query("outlier_label_split", f"WITH base AS ({orders_sql(False)}), long AS ({unpivot_sql('base', ORDER_FEATURES, ('id', 'y'))})"
       + REPORT + """, flags AS (SELECT id, max(y) AS y, bool_or(coalesce(value < q_low OR value > q_high, false)) AS hit
FROM long LEFT JOIN report USING (feature) GROUP BY id)
SELECT CASE WHEN hit THEN 'outlier' ELSE 'clean' END AS part, y, count(*) AS n FROM flags GROUP BY ALL""")
def outlier_label_split(spark, sf):
    df = f_orders(spark, sf, False)
    return profile.outlier_label_split(df, profile.outlier_report(df, ORDER_FEATURES))


STANDARD = ["totalprice", "custkey", "const_one", "price_gap", "order_month"]


@query("standardize_all", f"WITH base AS ({orders_sql(False)}), " + "s AS (SELECT " + ", ".join(
    f"avg({f}) AS m_{f}, stddev_pop({f}) AS s_{f}, count(*) - count({f}) AS n_{f}" for f in STANDARD)
    + " FROM base WHERE id % 5 <> 0) SELECT CASE WHEN id % 5 <> 0 THEN 'train' ELSE 'test' END AS split, id, " + ", ".join(
    "CASE WHEN n_{0} = 0 THEN {1} END AS {0}".format(f, r6_sql(f"(({f} - m_{f}) / CASE WHEN s_{f} = 0 THEN 1 ELSE s_{f} END)"))
    for f in STANDARD) + " FROM base, s")
def standardize_all(spark, sf):
    df = f_orders(spark, sf, False)
    train, test = scale.standardize_all(df.where("id % 5 <> 0"), df.where("id % 5 = 0"), STANDARD)
    both = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    return rounded(both.select("split", "id", *STANDARD))


ONE_HOT = {"status_code": (0, 1, 2), "order_month": tuple(range(1, 13)), "child": tuple(range(10))}


@query("one_hot_simple", f"WITH base AS ({orders_sql(False)}) SELECT id, " + ", ".join(
    f'CAST(coalesce({f} = {v}, false) AS DOUBLE) AS "{f}={v}"' for f, vs in ONE_HOT.items() for v in vs) + " FROM base")
def one_hot_simple(spark, sf):
    return one_hot_all(f_orders(spark, sf, False), [*ONE_HOT, "date_like"], 30)[0]


@query("suspicious_features", BASE + """, facts AS (SELECT feature, corr(value, y) AS r, max(value) - min(value) AS span,
count(*) - count(value) AS missing FROM long GROUP BY feature)
SELECT feature, CASE WHEN abs(r) > 0.01 THEN 'High correlation' ELSE 'Large range' END AS reason,
round(CASE WHEN abs(r) > 0.01 THEN r ELSE span END, 6) AS amount FROM facts
WHERE missing = 0 AND span > 0 AND (abs(r) > 0.01 OR span > 400000)""")
def suspicious_features(spark, sf):
    return rounded(roles.suspicious_features(f_orders(spark, sf), FEATURES, "y", 0.01, 400000))


@query("positive_rate_by_value", LINES + "," + COUNTS + """
SELECT feature, value, n, round(n_pos / n, 6) AS rate FROM counts WHERE feature IN ('quantity', 'discount', 'tax', 'linenumber')""")
def positive_rate_by_value(spark, sf):
    return rounded(profile.positive_rate_by_value(f_lineitem(spark, sf), ["quantity", "discount", "tax", "linenumber"], "y"))


@query("feature_drilldown", PLAIN + "," + COUNTS + "," + FACTS + """
SELECT feature, value, c.n, missing, round(missing / f.n, 6) AS missing_share, lo AS "min", hi AS "max", round(mean, 6) AS mean
FROM counts c JOIN facts f USING (feature) WHERE feature = 'child'""")
def feature_drilldown(spark, sf):
    return rounded(profile.drilldown(f_orders(spark, sf, False), "child"))


@query("discrete_features", BASE + "," + FACTS + 'SELECT feature, k AS "distinct" FROM facts WHERE k < 10')
def discrete_features(spark, sf):
    return profile.discrete_features(f_orders(spark, sf), FEATURES)


@query("sample_n", f"SELECT o_orderkey AS id, o_totalprice AS totalprice FROM orders ORDER BY {hash_sql('o_orderkey', 7)} LIMIT 5000")
def sample_n(spark, sf):
    return hash_sample(f_orders(spark, sf, False).select("id", "totalprice"), "id", 5000, 7)
