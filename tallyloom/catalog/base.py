"""Feature tables derived from the test tables, and helpers shared by the registered queries.

A derived column is written once, as an expression both engines read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, and its SQL statement if there is one."""
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def gap(column: str, kept: str) -> str:
    return f"CASE WHEN {kept} THEN {column} END"


def number(value: str) -> str:
    return f"CAST({value} AS DOUBLE)"


ORDER_COLUMNS = {
    "totalprice": "o_totalprice",
    "custkey": number("o_custkey"),
    "order_year": number("year(o_orderdate)"),
    "order_month": number("month(o_orderdate)"),
    "status_code": f"CASE o_orderstatus WHEN 'F' THEN {number(0)} WHEN 'O' THEN {number(1)} ELSE {number(2)} END",
    "price_gap": gap("o_totalprice", "o_orderkey % 7 <> 0"),
    "rare": gap(number("o_custkey % 5"), "o_orderkey % 20 = 19"),
    "sparse": gap(number("o_custkey % 5"), "o_orderkey % 50 = 49"),
    "const_one": number(1),
    "near_const": f"CASE WHEN o_orderkey % 1000 = 1 THEN {number(1)} ELSE {number(0)} END",
    "price_copy": "o_totalprice",
    "price_near": f"CASE WHEN o_orderkey = 1 THEN o_totalprice + {number(1)} ELSE o_totalprice END",
    "survey": f"CASE o_orderkey % 9 WHEN 7 THEN {number(77)} WHEN 8 THEN {number(99)} ELSE {number('o_orderkey % 9 + 1')} END",
    "parent": number("o_orderkey % 2"),
    "child": gap(number("o_custkey % 10"), "o_orderkey % 2 <> 0"),
    "date_like": number("20240000 + o_orderkey % 50"),
    "year_like": number("1990 + o_orderkey % 20"),
}
LINE_COLUMNS = {
    "n_lines": f"coalesce(lines, {number(0)})",
    "sum_qty": "qty",
    "mean_disc": "disc",
}
ORDER_FEATURES = list(ORDER_COLUMNS)
FEATURES = ORDER_FEATURES + list(LINE_COLUMNS)
LABEL = "CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE -1 END"


def f_orders(spark: SparkSession, sf: str, lines: bool = True) -> DataFrame:
    """One row per order: ``id, y`` and the derived features, with line totals joined in on demand."""
    orders = table(spark, sf, "orders")
    columns = dict(ORDER_COLUMNS)
    if lines:
        totals = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
            F.count(F.lit(1)).cast("double").alias("lines"), F.sum("l_quantity").alias("qty"),
            F.round(F.avg("l_discount"), 6).alias("disc"))
        orders = orders.join(totals, orders.o_orderkey == totals.l_orderkey, "left")
        columns.update(LINE_COLUMNS)
    return orders.select(F.col("o_orderkey").alias("id"), F.expr(LABEL).alias("y"),
                         *[F.expr(text).alias(name) for name, text in columns.items()])


def orders_sql(lines: bool = True) -> str:
    """The same table as a SQL subquery."""
    columns = {**ORDER_COLUMNS, **(LINE_COLUMNS if lines else {})}
    source = "orders"
    if lines:
        source += (" LEFT JOIN (SELECT l_orderkey, CAST(count(*) AS DOUBLE) AS lines, sum(l_quantity) AS qty, "
                   "round(avg(l_discount), 6) AS disc FROM lineitem GROUP BY l_orderkey) t ON o_orderkey = l_orderkey")
    listed = ", ".join(f"{text} AS {name}" for name, text in columns.items())
    return f"SELECT o_orderkey AS id, {LABEL} AS y, {listed} FROM {source}"


LINEITEM_COLUMNS = {
    "quantity": "l_quantity", "extendedprice": "l_extendedprice", "discount": "l_discount", "tax": "l_tax",
    "linenumber": number("l_linenumber"), "suppkey": number("l_suppkey"),
    "linestatus": f"CASE WHEN l_linestatus = 'O' THEN {number(1)} ELSE {number(0)} END",
}
LINEITEM_FEATURES = list(LINEITEM_COLUMNS)
LINEITEM_LABEL = "CASE WHEN l_returnflag = 'R' THEN 1 ELSE -1 END"


def f_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as a feature table without a key, for per-feature and per-value reports."""
    return table(spark, sf, "lineitem").select(F.expr(LINEITEM_LABEL).alias("y"),
                                               *[F.expr(t).alias(n) for n, t in LINEITEM_COLUMNS.items()])


def lineitem_sql() -> str:
    listed = ", ".join(f"{t} AS {n}" for n, t in LINEITEM_COLUMNS.items())
    return f"SELECT {LINEITEM_LABEL} AS y, {listed} FROM lineitem"


def unpivot_sql(source: str, features: Sequence[str], keep: Sequence[str] = ("y",)) -> str:
    """Long form ``keep..., feature, value`` with missing values kept."""
    listed = ", ".join(features)
    return (f"SELECT * FROM (SELECT {', '.join(keep)}, {listed} FROM {source}) "
            f"UNPIVOT INCLUDE NULLS (value FOR feature IN ({listed}))")


def r6(c: Column | str) -> Column:
    return F.round(c, 6)


def r6_sql(text: str) -> str:
    """Round to six decimals without a negative zero."""
    return f"(CASE WHEN abs({text}) < 5e-7 THEN CAST(0 AS DOUBLE) ELSE round(CAST({text} AS DOUBLE), 6) END)"


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Every double column rounded, for comparison across engines."""
    numbers = [n for n, kind in df.dtypes if kind == "double"]
    return df.withColumns({n: F.round(F.col(f"`{n}`"), digits) for n in numbers}) if numbers else df


def hash_sql(key: str, seed: str | int) -> str:
    """The seeded hash of an integer key, as SQL over BIGINT."""
    x = f"((({key} + 1) % 2147483647 * 1103515245 % 2147483647 + CAST({seed} AS BIGINT) * 1299709) % 2147483647)"
    squared = f"({x} * {x} % 2147483647)"
    return f"({squared} * {squared} % 2147483647 * {x} % 2147483647)"


# --- model inputs ----------------------------------------------------------------------------------------------------

MODEL_COLUMNS = {
    "x_bias": number(1),
    "x_price": "(o_totalprice - 250000) / 150000",
    "x_qty": f"(coalesce(qty, {number(0)}) - 100) / 60",
    "x_disc": f"coalesce(disc, {number(0.05)}) * 10",
}
MODEL_FEATURES = list(MODEL_COLUMNS)


def f_model(spark: SparkSession, sf: str) -> DataFrame:
    """``id, y, y01`` and four complete, scaled features per order."""
    totals = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("qty"), F.round(F.avg("l_discount"), 6).alias("disc"))
    orders = table(spark, sf, "orders")
    return orders.join(totals, orders.o_orderkey == totals.l_orderkey, "left").select(
        F.col("o_orderkey").alias("id"), F.expr(LABEL).alias("y"), F.expr(f"({LABEL} + 1) / 2").cast("double").alias("y01"),
        *[F.expr(text).alias(name) for name, text in MODEL_COLUMNS.items()])


def model_sql() -> str:
    listed = ", ".join(f"{text} AS {name}" for name, text in MODEL_COLUMNS.items())
    return (f"SELECT o_orderkey AS id, {LABEL} AS y, CAST(({LABEL} + 1) / 2 AS DOUBLE) AS y01, {listed} FROM orders "
            "LEFT JOIN (SELECT l_orderkey, sum(l_quantity) AS qty, round(avg(l_discount), 6) AS disc FROM lineitem "
            "GROUP BY l_orderkey) t ON o_orderkey = l_orderkey")


def sigmoid_sql(z: str) -> str:
    return f"(CASE WHEN {z} >= 0 THEN 1 / (1 + exp(-abs({z}))) ELSE exp(-abs({z})) / (1 + exp(-abs({z}))) END)"


def loss_sql(z: str, y: str = "y01") -> str:
    return f"(greatest({z}, 0) + ln(1 + exp(-abs({z}))) - {y} * ({z}))"
