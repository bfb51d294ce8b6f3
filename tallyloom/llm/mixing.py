"""Mixing sources to target weights (Efraimidis-Spirakis sampling to word budgets)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored
from .registry import query

COARSE = 64      # buckets per e-fold of the exponential key, first pass
FINE = 1 << 18   # second pass, inside the bucket that holds the cut

SIZE = r"regexp_count(text, '[^\\x20\\x09-\\x0D]+')"
#: Share of characters that are no ASCII punctuation or digit, kept between 0.1 and 1: the quality weight of a text.
QUALITY = (r"greatest(0.1D, CAST(length(regexp_replace(text, '[\\x21-\\x40\\x5B-\\x60\\x7B-\\x7E]+', '')) AS DOUBLE) "
           r"/ greatest(length(text), 1))")


def mix(df: DataFrame, size: str, quality: str = "1.0D", key: str = "doc_id", source: str = "source",
        weights: Sequence[int] = (5, 2, 1), repeats: int = 3, seed: int = 7) -> DataFrame:
    """Words each document gives to a mix of the sources: ``key, source, size, source_size, epochs, target, taken``.

    ``size`` and ``quality`` are SQL expressions over ``df``: a document's words and its weight in (0, 1]. The sources,
    by code point with null last, weigh ``weights`` in turn and share the words of all sources; a target stops at
    ``repeats`` times its source, and the excess is shared by weight until no target is above.

    A source is first taken as often as it fits whole into its target (complete epochs). The rest of the target goes to
    the documents with the smallest keys -ln(u) / quality, u being hashed from the key: Efraimidis-Spirakis sampling. The
    document on which the budget ends gives just the words that still fit, so a source gives its target, rounded down.

    Prefix sums never sort a source in one task: key ranges are summed first, the range with the cut is summed again in
    finer ranges, and only documents inside the finest range with the cut are put in order.

    Null text counts 0 words, null quality as the lowest; a null source is a source; rows without words take 0; repeated
    rows are documents of their own, taken one after another; an empty table gives an empty result; other columns of
    ``df`` are ignored.
    """
    scored = df.select(F.col(key).alias("id"), F.col(source).alias("src"), F.expr(f"CAST(coalesce({size}, 0) AS BIGINT)").alias("size"),
                       F.expr(f"coalesce({quality}, 0.1D)").alias("q"))
    # 52 bits of a hash as u in (0, 1); both engines of the SQL check can compute it.
    unit = f"(CAST(conv(substr(md5(concat(coalesce(CAST(id AS STRING), ''), ':{seed}')), 1, 13), 16, 10) AS BIGINT) + 0.5D) / 4503599627370496D"
    scored = stored(scored.withColumn("e", F.expr(f"-ln({unit}) / greatest(q, 0.001D)")).drop("q"))
    at = "floor(ln(e) * {})"
    scored = scored.withColumns({"b1": F.expr(at.format(COARSE)), "b2": F.expr(at.format(FINE))})

    plan = _targets(scored, weights, repeats).withColumns({
        "epochs": F.expr("CASE WHEN source_size = 0 THEN 0 ELSE least(CAST(floor(target / source_size) AS INT), repeats) END"),
    }).withColumn("budget", F.expr("CASE WHEN epochs = repeats THEN 0 ELSE CAST(floor(target) AS BIGINT) - epochs * source_size END"))
    plan = stored(plan.drop("repeats"))
    plan = _cut(scored, plan, "b1", "budget", "cut1", "left1")
    plan = stored(_cut(scored.join(plan, F.expr("src <=> source_name AND b1 = cut1"), "left_semi"), plan, "b2", "left1", "cut2", "left2"))

    rows = scored.join(plan, F.expr("src <=> source_name"))
    inside = "b1 = cut1 AND b2 = cut2"
    sure = rows.where(f"NOT coalesce({inside}, false)").withColumn("more", F.expr(
        "CASE WHEN b1 < cut1 OR (b1 = cut1 AND b2 < cut2) THEN size ELSE 0 END"))
    order = Window.partitionBy("src", "b2").orderBy("e", "id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ordered = rows.where(inside).withColumn("upto", F.sum("size").over(order)).withColumn(
        "more", F.expr("greatest(least(left2 - (upto - size), size), 0)")).drop("upto")
    return sure.unionByName(ordered).select(
        F.col("id").alias(key), F.col("src").alias(source), "size", "source_size", F.expr("CAST(epochs AS BIGINT)").alias("epochs"), "target",
        F.expr("CAST(epochs * size + more AS BIGINT)").alias("taken"))


def _targets(scored: DataFrame, weights: Sequence[int], repeats: int) -> DataFrame:
    """One row per source: its target by the level at which weight times level, cut at the caps, adds up to all words."""
    step = ", ".join(str(int(w)) for w in weights)
    sources = scored.groupBy("src").agg(F.sum("size").alias("source_size"))
    # One row per source from here on; the windows below order sources, not documents.
    ranked = sources.withColumn("turn", F.expr("row_number() OVER (ORDER BY src ASC NULLS LAST)")).withColumn(
        "weight", F.expr(f"array({step})[(turn - 1) % {len(weights)}]"))
    level = ranked.withColumn("cap", F.expr(f"source_size * {repeats}")).withColumns({
        "rest": F.expr("sum(weight) OVER (ORDER BY cap / weight, turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"),
        "capped": F.expr("coalesce(sum(cap) OVER (ORDER BY cap / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"),
        "all_words": F.expr("sum(source_size) OVER ()"),
    }).withColumn("level", F.expr("CASE WHEN (all_words - capped) / rest < cap / weight THEN (all_words - capped) / rest END"))
    return level.withColumn("level", F.expr("max(level) OVER ()")).select(
        F.col("src").alias("source_name"), "source_size", F.lit(repeats).alias("repeats"),
        F.expr("CAST(least(cap, coalesce(weight * level, cap)) AS DOUBLE)").alias("target"))


def _cut(scored: DataFrame, plan: DataFrame, bucket: str, budget: str, cut: str, left: str) -> DataFrame:
    """Adds the bucket in which each source's budget ends, and the words left when that bucket begins."""
    sums = scored.groupBy("src", bucket).agg(F.sum("size").alias("words"))
    before = F.sum("words").over(Window.partitionBy("src").orderBy(bucket)) - F.col("words")
    need = plan.select("source_name", F.col(budget).alias("need"))
    ends = sums.withColumn("before", before).join(need, F.expr("src <=> source_name")).where(
        "before < need AND need <= before + words").select(
        F.col("src").alias("cut_source"), F.col(bucket).alias(cut), (F.col("need") - F.col("before")).alias(left))
    return plan.join(ends, F.expr("source_name <=> cut_source"), "left").drop("cut_source")


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         coalesce(greatest(0.1::DOUBLE, CAST(length(regexp_replace(text, '[\x21-\x40\x5B-\x60\x7B-\x7E]+', '', 'g')) AS DOUBLE)
                  / greatest(length(text), 1)), 0.1::DOUBLE) AS q,
         (CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':7'), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(sum(size) * 3 AS BIGINT) AS cap FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS turn FROM s),
w AS (SELECT *, CASE (turn - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM r),
l AS (SELECT *, CAST(sum(weight) OVER (ORDER BY cap / weight, turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS rest,
             CAST(coalesce(sum(cap) OVER (ORDER BY cap / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS capped,
             CAST(sum(source_size) OVER () AS DOUBLE) AS all_words FROM w),
m AS (SELECT *, max(CASE WHEN (all_words - capped) / rest < cap / weight THEN (all_words - capped) / rest END) OVER () AS level FROM l),
t AS (SELECT source, source_size, CAST(least(cap, coalesce(weight * level, cap)) AS DOUBLE) AS target FROM m),
p AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE least(CAST(floor(target / source_size) AS BIGINT), 3) END AS epochs FROM t),
o AS (SELECT d.doc_id, d.size, p.source_size, p.target, p.epochs,
             CASE WHEN p.epochs = 3 THEN 0 ELSE CAST(floor(p.target) AS BIGINT) - p.epochs * p.source_size END AS budget,
             CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY -ln(d.u) / greatest(d.q, 0.001::DOUBLE), d.doc_id, d.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS upto
      FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, CAST(epochs * size + greatest(least(budget - (upto - size), size), 0) AS BIGINT) AS taken FROM o
"""


@query("op1_mix_sources", OP1_SQL)
def op1_mix_sources(spark, folder):
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    return mix(documents, SIZE, QUALITY).select("doc_id", "size", "source_size", "target", "taken")
