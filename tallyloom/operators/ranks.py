"""Exact global ranks and running totals without a single-task sort.

A window over the whole table would put every row in one task. Here the rows are first cut into ordered buckets, the
bucket sums (a few thousand rows) are accumulated, and a window inside each bucket adds the bucket's offset. Bucket
borders come from a sample, so they only steer the balance of the work and never the result; they are constants of the
plan, so a recomputed task sees the same buckets.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.hashing import PRIME, id_hash
from ..functions.scalar import col, quoted

ROWS_PER_BUCKET = 1_000_000
MAX_BUCKETS = 10_000
SAMPLE_PER_BUCKET = 200
# Slices of the hash range: a hundred billion rows leave under two million keys to rank in each.
KEYS_PER_SLICE = 20_000
MAX_SLICES = 65_536


def session_buckets(spark: SparkSession) -> int:
    """Hash buckets follow the session's shuffle width, as any exchange would."""
    return max(1, min(MAX_BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def bucket_cuts(df: DataFrame, columns: Sequence[str], rows: int, rows_per_bucket: int = ROWS_PER_BUCKET
                ) -> dict[str, list[float]]:
    """Sampled borders of roughly equal buckets per column; empty lists when one bucket is enough."""
    buckets = min(MAX_BUCKETS, math.ceil(rows / rows_per_bucket))
    if buckets <= 1:
        return {c: [] for c in columns}
    source = df.select(*[col(c).cast("double").alias(c) for c in columns])
    fraction = min(1.0, buckets * SAMPLE_PER_BUCKET / rows)
    if fraction < 1.0:
        source = source.sample(fraction, seed=17)
    steps = [i / buckets for i in range(1, buckets)]
    found = source.approxQuantile(list(columns), steps, 0.25 / buckets)
    return {c: sorted(set(borders)) for c, borders in zip(columns, found)}


def with_bucket(df: DataFrame, column: str, cuts: Sequence[float], output: str) -> DataFrame:
    """Add the number of the range bucket a value falls in."""
    if not cuts:
        return df.withColumn(output, F.lit(0))
    edges = [-math.inf, *cuts, math.inf]
    source = df.withColumn("_cut", col(column).cast("double"))
    cutter = Bucketizer(splits=edges, inputCol="_cut", outputCol=output, handleInvalid="keep")
    return cutter.transform(source).withColumn(output, F.col(output).cast("int")).drop("_cut")


def running_totals(df: DataFrame, order: str, measures: Sequence[str], group: Sequence[str] = (),
                   cuts: Sequence[float] = (), descending: bool = False, bucket: str | None = None) -> DataFrame:
    """Add ``cum_<measure>``, the inclusive running sum of each measure by ``order`` within each group.

    ``order`` must be unique inside a group. With cuts, or with a ``bucket`` column that already follows ``order``, a
    group is spread over as many tasks as it has buckets.
    """
    def ordered(name: str) -> Column:
        return F.col(name).desc() if descending else F.col(name).asc()

    upto_here = (Window.partitionBy(*group, "_bucket").orderBy(ordered(order))
                 .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cut = df.withColumn("_bucket", F.col(bucket)) if bucket else with_bucket(df, order, cuts, "_bucket")
    inside = cut.select("*", *[F.sum(m).over(upto_here).alias(f"cum_{m}") for m in measures])
    if not cuts and not bucket:
        return inside.drop("_bucket")
    before = (Window.partitionBy(*group).orderBy(ordered("_bucket"))
              .rowsBetween(Window.unboundedPreceding, -1))
    sums = cut.groupBy(*group, "_bucket").agg(*[F.sum(m).alias(f"_sum_{m}") for m in measures])
    offsets = sums.select(*group, "_bucket", *[
        F.coalesce(F.sum(f"_sum_{m}").over(before), F.lit(0)).alias(f"_off_{m}") for m in measures])
    joined = inside.join(offsets, [*group, "_bucket"])
    return joined.select(*df.columns, *[(F.col(f"cum_{m}") + F.col(f"_off_{m}")).alias(f"cum_{m}") for m in measures])


def range_index(df: DataFrame, key: str, output: str = "row_index", rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Zero-based position of every row when the table is sorted by a unique numeric key."""
    rows = df.count()
    cuts = bucket_cuts(df, [key], rows, rows_per_bucket)[key]
    numbered = running_totals(df.withColumn("_one", F.lit(1).cast("bigint")), key, ["_one"], cuts=cuts)
    return numbered.withColumn(output, F.col("cum__one") - 1).drop("_one", "cum__one")


def hash_index(df: DataFrame, key: str, seed: int, group: Sequence[str] = (), output: str = "hash_index",
               buckets: int | None = None) -> DataFrame:
    """Zero-based position of every row in a seeded pseudo-random order, within each group.

    The hash is uniform, so equal-width hash ranges are balanced buckets and no sample is needed.
    """
    buckets = buckets or session_buckets(df.sparkSession)
    keyed = (df.withColumn("_hash", id_hash(quoted(key), seed))
             .withColumn("_bucket", F.floor(F.col("_hash") * buckets / F.lit(float(PRIME))).cast("int")))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (keyed.groupBy(*group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
               .select(*group, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")))
    inside = Window.partitionBy(*group, "_bucket").orderBy("_hash", key)
    ranked = keyed.withColumn("_rn", F.row_number().over(inside))
    return (ranked.join(offsets, [*group, "_bucket"])
            .withColumn(output, F.col("_off") + F.col("_rn") - 1)
            .select(*df.columns, output))


def hashes_at(df: DataFrame, key: str, seed: int, ranks: Mapping[tuple, Sequence[int]], group: Sequence[str] = (),
              slices: int | None = None) -> dict[tuple, list[int]]:
    """The hash values found at the given zero-based ranks of the hashed order, per group (ranks must exist).

    Slice counts tell which slice of the hash range holds each rank; only those slices' hashes are ranked. Nothing
    but keys and group columns is read, and no row moves.
    """
    if slices is None:
        last = max((r for asked in ranks.values() for r in asked), default=0)
        slices = min(MAX_SLICES, max(64, last // KEYS_PER_SLICE))
    width = PRIME // slices + 1
    hashed = df.select(*group, id_hash(quoted(key), seed).alias("_h")).withColumn("_s", F.floor(F.col("_h") / width))
    counts: dict[tuple, list[tuple[int, int]]] = {}
    for r in hashed.groupBy(*group, "_s").count().collect():
        counts.setdefault(tuple(r[g] for g in group), []).append((r["_s"], r["count"]))
    wanted = []
    for which, asked in ranks.items():
        slots, before = sorted(counts[which]), 0
        todo = sorted(set(asked))
        for s, n in slots:
            while todo and todo[0] < before + n:
                wanted.append((*which, s, todo[0] - before + 1, todo[0]))
                todo.pop(0)
            before += n
    if not wanted:
        return {which: [] for which in ranks}
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in hashed.schema.fields if f.name in group]
    asked_frame = df.sparkSession.createDataFrame(wanted, ", ".join([*kinds, "_s bigint", "_rn int", "_rank bigint"]))
    inside = Window.partitionBy(*group, "_s").orderBy("_h")
    slots = asked_frame.select(*group, "_s").distinct()
    found = (hashed.join(F.broadcast(slots), [*group, "_s"]).withColumn("_rn", F.row_number().over(inside))
             .join(F.broadcast(asked_frame), [*group, "_s", "_rn"]).collect())
    at = {(*(r[g] for g in group), r["_rank"]): r["_h"] for r in found}
    return {which: [at[(*which, r)] for r in asked] for which, asked in ranks.items()}


def hash_sample(df: DataFrame, key: str, size: int, seed: int, slices: int = 4096, sort_rows: int = ROWS_PER_BUCKET
                ) -> DataFrame:
    """Exactly ``size`` rows drawn uniformly without replacement (all rows when there are fewer).

    Counts per slice of the hash range tell how far the sample reaches; the slice it ends in is cut again until few
    enough rows are left to sort. Rows below that slice are taken as they are.
    """
    h = id_hash(quoted(key), seed)
    low, high, missing = 0, PRIME, size
    while True:
        width = max(1, -(-(high - low) // slices))
        inside = df.select(h.alias("h")).where((F.col("h") >= low) & (F.col("h") < high))
        counts = inside.groupBy(F.floor((F.col("h") - low) / width).alias("s")).count().orderBy("s").collect()
        ending = None
        for row in counts:
            if row["count"] >= missing:
                ending = row
                break
            missing -= row["count"]
        if ending is None:
            return df
        low = low + int(ending["s"]) * width
        high = low + width
        if width == 1 or ending["count"] <= sort_rows:
            break
    hashed = df.withColumn("_hash", h)
    rest = hashed.where((F.col("_hash") >= low) & (F.col("_hash") < high)).orderBy("_hash", key).limit(missing)
    return hashed.where(F.col("_hash") < low).unionByName(rest).drop("_hash")
