"""Embedding near-dedup: inverted multi-index with multi-sequence traversal, verified by cosine."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, forest, grouped, joined_small, read_table, stored
from .registry import query

SAMPLE_VALUES = 1 << 20    # numbers in the sample the codebooks are fitted on
CELL_ROWS = 32             # rows of the largest label per cell, which sets the codebooks' size
MAX_CODES = 1024
PROBES = 400               # sampled vectors that measure the traversal's recall
BLOCK, QUERIES_PER_BLOCK = 1024, 8192


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centres."""
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1)[None], 0)


def codebook(x: np.ndarray, k: int, rng, rounds: int = 12) -> np.ndarray:
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        own = nearest(x, centres).argmin(1)
        for c in range(len(centres)):
            members = x[own == c]
            if len(members):
                centres[c] = members.mean(0)
    return centres


class MultiIndex:
    """Two codebooks, one on each half of a unit vector; a cell is a pair of their codes."""

    def __init__(self, sample: np.ndarray, codes: int, threshold: float, recall: float, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.half = sample.shape[1] // 2
        self.books = [codebook(h, codes, rng) for h in (sample[:, :self.half], sample[:, self.half:])]
        probes = sample[rng.choice(len(sample), min(PROBES, len(sample)), replace=False)]
        noise = rng.standard_normal(probes.shape)
        noise -= (noise * probes).sum(1, keepdims=True) * probes
        noise /= np.linalg.norm(noise, axis=1, keepdims=True) + 1e-300
        # The least similar partners that must be found, in random directions.
        partners = threshold * probes + np.sqrt(1 - threshold * threshold) * noise
        rank = np.minimum(self._rank(probes, partners), self._rank(partners, probes))
        self.visits = int(np.quantile(rank, recall, method="higher")) + 1

    def _distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return nearest(x[:, :self.half], self.books[0]), nearest(x[:, self.half:], self.books[1])

    def _rank(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many cells are nearer to each x than the cell of its y."""
        (a, b), (c, d) = self._distances(x), self._distances(y)
        out = np.empty(len(x), np.int64)
        for r in range(len(x)):
            total = a[r][:, None] + b[r][None]
            out[r] = (total < total[c[r].argmin(), d[r].argmin()]).sum()
        return out

    def traverse(self, x: np.ndarray) -> np.ndarray:
        """The ``visits`` nearest cells of every row, its own first.

        Multi-sequence traversal for all rows at once: with both codebooks in order of distance, the n nearest cells are
        among the pairs (i, j) with (i + 1)(j + 1) <= n, because every pair below such a one is at least as near.
        """
        a, b = self._distances(x)
        first, second = np.argsort(a, axis=1, kind="stable"), np.argsort(b, axis=1, kind="stable")
        n = min(self.visits, a.shape[1] * b.shape[1])
        pairs = np.array([(i, j) for i in range(min(n, a.shape[1])) for j in range(min(n // (i + 1), b.shape[1]))])
        i, j = first[:, pairs[:, 0]], second[:, pairs[:, 1]]
        total = np.take_along_axis(a, i, 1) + np.take_along_axis(b, j, 1)
        cells = i * b.shape[1] + j
        order = np.lexsort((cells, total), axis=1)[:, :n]
        return np.take_along_axis(cells, order, 1)


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _traverser(shared):
    """Executor function: vectors to their cell and the cells to visit; a length without an index has the one cell 0."""
    def traverse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indexes = shared.value
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                for start in range(0, part.num_rows, 2000):
                    piece = part.slice(start, 2000)
                    if dim in indexes:
                        x = _matrix(piece.column("vector"))
                        cells = indexes[dim].traverse(x / np.linalg.norm(x, axis=1, keepdims=True))
                    else:
                        cells = np.zeros((piece.num_rows, 1), np.int64)
                    flat = pa.array(cells[:, 1:].astype(np.int32).ravel())
                    visited = pa.ListArray.from_arrays(pa.array(np.arange(len(cells) + 1, dtype=np.int32) * (cells.shape[1] - 1)), flat)
                    yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(cells[:, 0].astype(np.int32)), visited],
                                                     names=[*piece.schema.names, "cell", "visited"])
    return traverse


def _verifier(threshold: float):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, table in grouped(batches, ["place", "i", "j", "q"]):
            _, i, j, q = key
            ids, copies, cell = (table.column(c).to_numpy() for c in ("rep", "copies", "cell"))
            side, asks = table.column("side").to_numpy(), table.column("asks").to_numpy()
            x = _matrix(table.column("vector"))
            norms = np.sqrt((x * x).sum(1))
            if q == 0:
                a, b = np.flatnonzero(side == i), np.flatnonzero(side == j)
            else:
                a, b = np.flatnonzero(asks), np.flatnonzero(~asks)
            if not len(a) or not len(b):
                continue
            linked = (x[a] @ x[b].T) / (norms[a][:, None] * norms[b][None]) >= threshold
            if q == 0 and i == j:
                linked = np.triu(linked, 1)
            r, c = np.nonzero(linked)
            if q:
                # A pair whose cells visit each other is met in both; it counts in the larger one.
                visited = table.column("visited").to_pylist()
                once = [cell[b[y]] > cell[a[z]] or cell[a[z]] not in (visited[b[y]] or ()) for z, y in zip(r, c)]
                r, c = r[once], c[once]
            links = np.zeros(len(ids), np.int64)
            np.add.at(links, a[r], copies[b[c]])
            np.add.at(links, b[c], copies[a[r]])
            roots = dict(forest(zip(ids[a[r]].tolist(), ids[b[c]].tolist())))
            at = np.flatnonzero(links)
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at]), pa.array([roots.get(k, k) for k in ids[at].tolist()], pa.int64()), pa.array(links[at])],
                    names=["id", "root", "links"])
    return verify


def near_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = 0.93,
                 recall: float = 0.99) -> DataFrame:
    """``key, n_links, component_id, kept``: vectors of one label linked by cosine >= ``threshold`` in double precision.

    Equal vectors of a label are one representative with a number of copies. Each half of the unit vectors has a codebook
    (fitted on ``SAMPLE_VALUES`` numbers of sampled vectors); the pairs of codes are the cells of the index, which holds every
    vector. A vector visits its nearest cells, in as many steps as find a share ``recall`` of sampled partners at the
    threshold from either side; vectors met in a cell are verified. Cells with many rows are cut into blocks, queries too.
    Tasks return counts and spanning forests, never pairs.

    ``n_links`` counts the vectors linked directly, copies included; ``component_id`` is the smallest key connected by
    links. Vectors that are null, empty, zero or hold null or non-finite numbers, and null labels, link with nothing; vectors
    of different length do not link; a null key has a null component and is not kept; repeated rows are vectors of their
    own; an empty table gives an empty result; other columns are ignored.
    """
    spark = df.sparkSession
    kind = dict(df.dtypes)[vector]
    kind = kind if kind in ("array<float>", "array<double>") else "array<double>"
    rows = df.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast(kind).alias("vector"), F.col(label).alias("label"))
    good = ("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL AND size(vector) > 0 AND exists(vector, x -> x <> 0) AND "
            "forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) <> CAST('Infinity' AS DOUBLE))")
    rows = rows.withColumn("good", F.expr(f"coalesce({good}, false)"))
    marks = {"h1": F.expr("CASE WHEN good THEN xxhash64(label, vector) END"), "h2": F.expr("CASE WHEN good THEN xxhash64(vector, label, 17) END")}
    same = stored(rows.where("good").withColumns(marks).groupBy("h1", "h2").agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"), F.first("vector").alias("vector")).withColumn(
        "dim", F.size("vector")))
    indexes = {}
    # One index for the commonest length; another length's vectors are compared label by label.
    common = same.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    if common and common["dim"] > 1:
        dim = common["dim"]
        own = same.where(F.col("dim") == dim)
        largest = own.groupBy("label").count().agg(F.max("count")).first()[0]
        codes = int(np.clip(np.sqrt(largest / CELL_ROWS), 1, MAX_CODES))
        sample = own.orderBy(F.xxhash64("rep", "h1"), "rep").limit(max(SAMPLE_VALUES // dim, 100)).select("vector").toArrow()
        x = _matrix(sample.column("vector"))
        indexes[dim] = MultiIndex(x / np.linalg.norm(x, axis=1, keepdims=True), codes, threshold, recall)
    shared = spark.sparkContext.broadcast(indexes)
    label_kind = dict(rows.dtypes)["label"]
    placed = stored(same.select("rep", "copies", "label", "dim", "vector").mapInArrow(
        _traverser(shared), f"rep bigint, copies bigint, label {label_kind}, dim int, vector {kind}, cell int, visited array<int>"))

    spot = "xxhash64(label, dim, {})"
    base = placed.withColumn("place", F.expr(spot.format("cell")))
    asking = placed.withColumn("to", F.explode("visited")).withColumn("place", F.expr(spot.format("to"))).drop("to", "visited")
    blocks = base.groupBy("place").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("chunks"))
    asked = asking.groupBy("place").agg(F.ceil(F.count(F.lit(1)) / QUERIES_PER_BLOCK).cast("int").alias("lots"))
    sizes = stored(blocks.join(asked, "place", "left").na.fill(0, ["lots"]))
    own = F.expr("CAST(pmod(xxhash64(rep), chunks) AS INT)")
    base = joined_small(base, sizes, "place").withColumn("side", own).withColumn("block", F.explode(F.expr(
        "concat(transform(sequence(0, chunks - 1), k -> struct(least(k, side) AS i, greatest(k, side) AS j, 0 AS q)), "
        "CASE WHEN lots > 0 THEN transform(sequence(1, lots), k -> struct(side AS i, side AS j, k AS q)) ELSE CAST(array() AS ARRAY<STRUCT<i: INT, j: INT, q: INT>>) END)"))).withColumn(
        "asks", F.lit(False))
    asking = joined_small(asking, sizes, "place").withColumn("side", F.lit(-1)).withColumn("block", F.explode(F.expr(
        "transform(sequence(0, chunks - 1), k -> struct(k AS i, k AS j, CAST(1 + pmod(xxhash64(rep), lots) AS INT) AS q))"))).withColumn(
        "asks", F.lit(True)).withColumn("visited", F.lit(None).cast("array<int>"))
    columns = ["place", "block.i", "block.j", "block.q", "rep", "copies", "cell", "side", "asks", "vector", "visited"]
    met = base.select(columns).unionByName(asking.select(columns))
    links = stored(met.repartition("place", "i", "j", "q").sortWithinPartitions("place", "i", "j", "q", "rep").mapInArrow(
        _verifier(threshold), "id bigint, root bigint, links bigint"))
    classes = components(links.selectExpr("id AS src", "root AS dst"))
    found = stored(links.groupBy("id").agg(F.sum("links").alias("links")).join(
        classes.withColumnRenamed("node", "id"), "id", "left").selectExpr("id AS rep", "links", "coalesce(component, id) AS component"))
    reps = stored(joined_small(same.select("h1", "h2", "rep", "copies"), found, "rep", "left"))
    return rows.select("id", *[m.alias(n) for n, m in marks.items()]).join(reps, ["h1", "h2"], "left").select(
        F.col("id").alias(key), F.expr("CAST(coalesce(copies - 1 + coalesce(links, 0), 0) AS BIGINT) AS n_links"),
        F.expr("coalesce(component, rep, id) AS component_id"), F.expr("coalesce(id = coalesce(component, rep, id), false) AS kept"))


OP10_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[64] AS e FROM embeddings),
p AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND array_cosine_similarity(a.e, b.e) >= 0.93),
r AS (SELECT x AS node, x AS seen FROM p UNION SELECT r.node, p.y FROM r JOIN p ON p.x = r.seen)
SELECT d.vec_id, CAST(coalesce(any_value(k.n), 0) AS BIGINT) AS n_links, coalesce(min(r.seen), d.vec_id) AS component_id,
       coalesce(min(r.seen), d.vec_id) = d.vec_id AS kept
FROM embeddings d LEFT JOIN r ON r.node = d.vec_id LEFT JOIN (SELECT x, count(*) AS n FROM p GROUP BY x) k ON k.x = d.vec_id
GROUP BY d.vec_id
"""


@query("op10_embedding_dedup", OP10_SQL)
def op10_embedding_dedup(spark, folder):
    return near_vectors(read_table(spark, folder, "embeddings"))
