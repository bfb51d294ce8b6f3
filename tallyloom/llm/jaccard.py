"""N-gram Jaccard join by MinHash banding, verified on whole shingle sets."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import block_pairs, components, forest, grouped, joined_small, mixed, read_table, shingle_hashes, small_batches, stored, text_slices, word_hashes
from .registry import query

BLOCK = 512      # documents of one side of a verified block
COLUMNS = 1024   # shared shingles multiplied at once


def banding(threshold: float, recall: float, max_hashes: int) -> tuple[int, int]:
    """Bands and rows per band: as many rows as ``max_hashes`` allows while a pair at ``threshold`` is met with ``recall``."""
    best = (1, 1)
    for rows in range(1, 33):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows)) if threshold < 1 else 1
        if bands * rows <= max_hashes:
            best = (bands, rows)
    return best


def _sets(shingles: np.ndarray, firsts: np.ndarray) -> list[np.ndarray]:
    return [np.unique(shingles[a:b]) for a, b in zip(firsts[:-1], firsts[1:])]


def _fingerprints(sets: list[np.ndarray]) -> tuple[pa.Array, pa.Array]:
    """Two words of hash of every shingle set, null where a text has no word."""
    one, two = np.zeros(len(sets), np.uint64), np.zeros(len(sets), np.uint64)
    for i, own in enumerate(sets):
        one[i] = own.sum(dtype=np.uint64)
        two[i] = mixed(own ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    none = np.array([not len(own) for own in sets], bool)
    return pa.array(one.view(np.int64), mask=none), pa.array(two.view(np.int64), mask=none)


def fingerprinted(df: DataFrame, text: str = "text", width: int = 5) -> DataFrame:
    """``df`` with ``f1, f2``: the fingerprint of every row's shingle set, as in ``near_duplicates``; null for a text without words."""
    small_batches(df.sparkSession)
    at = df.columns.index(text)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in text_slices(batch.column(at)):
                prints = _fingerprints(_sets(*shingle_hashes(*word_hashes(data, offsets), width)))
                yield pa.RecordBatch.from_arrays([*(c.slice(first, last - first) for c in batch.columns), *prints], names=[*batch.schema.names, "f1", "f2"])
    return df.mapInArrow(add, StructType([*df.schema, *StructType.fromDDL("f1 bigint, f2 bigint")]))


def _signer(width: int, bands: int, rows: int):
    """Executor function: ids and texts to the fingerprint of the shingle set and one key per band."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salts = mixed(np.arange(1, 2 * bands * rows + 1, dtype=np.uint64))
        factor = (salts[::2] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
        shift = (salts[1::2] >> np.uint64(32)).astype(np.uint32)
        for batch in batches:
            for first, last, data, offsets in text_slices(batch.column(1)):
                shingles, firsts = shingle_hashes(*word_hashes(data, offsets), width)
                n, full = last - first, np.flatnonzero(np.diff(firsts))
                one, two = _fingerprints(_sets(shingles, firsts))
                keys = np.zeros((n, bands), np.uint64)
                if len(full):
                    low = (shingles >> np.uint64(32)).astype(np.uint32)
                    starts, work = firsts[:-1][full], np.empty_like(low)
                    for k in range(bands * rows):
                        np.multiply(low, factor[k], out=work)
                        np.add(work, shift[k], out=work)
                        band = k // rows
                        keys[full, band] = mixed(keys[full, band] + np.uint64(band + 1)) ^ np.minimum.reduceat(work, starts)
                flat = pa.array(mixed(keys).view(np.int64).ravel())
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, n), one, two,
                    pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * bands), flat)],
                    names=["id", "f1", "f2", "bands"])
    return sign


def _shingler(width: int):
    """Executor function: every row's text replaced by its shingle set."""
    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in text_slices(batch.column("text")):
                sets = _sets(*shingle_hashes(*word_hashes(data, offsets), width))
                ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                rest = [batch.column(c).slice(first, last - first) for c in ("id", "copies", "component", "chunks")]
                yield pa.RecordBatch.from_arrays(
                    [*rest, pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets).view(np.int64)))],
                    names=["id", "copies", "component", "chunks", "shingles"])
    return shingle


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Common elements of every two sets, from the columns that at least two of them share."""
    sizes = [len(s) for s in sets]
    values, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    number = np.cumsum(counts > 1) - 1
    keep = counts[inverse] > 1
    row, column = row[keep], number[inverse[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total = np.zeros((len(sets), len(sets)), np.float32)
    for start in range(0, int(number[-1]) + 1 if len(number) else 0, COLUMNS):
        a, b = np.searchsorted(column, [start, start + COLUMNS])
        block = np.zeros((len(sets), COLUMNS), np.float32)
        block[row[a:b], column[a:b] - start] = 1
        total += block @ block.T
    return total


def _verifier(threshold: float):
    """Executor function: blocks of candidate documents to their links: id, smallest linked id here, linked documents."""
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, table in grouped(batches, ["component", "i", "j"]):
            ids, copies = table.column("id").to_numpy(), table.column("copies").to_numpy()
            side = table.column("side").to_numpy()
            shingles = table.column("shingles").combine_chunks()
            values, ends = shingles.flatten().to_numpy().view(np.uint64), np.concatenate([[0], np.cumsum(shingles.value_lengths().to_numpy())])
            sets = [values[a:b] for a, b in zip(ends[:-1], ends[1:])]
            # A repeated row is in the number of copies already.
            own = [k for k in range(len(sets)) if k == 0 or ids[k] != ids[k - 1] or not np.array_equal(sets[k], sets[k - 1])]
            ids, copies, side, sets = ids[own], copies[own], side[own], [sets[k] for k in own]
            sizes = np.array([len(s) for s in sets])
            common = overlaps(sets)
            # Jaccard >= threshold as common >= threshold * union, without a division.
            linked = common >= threshold * (sizes[:, None] + sizes[None] - common) - 1e-6
            linked &= (ids[:, None] != ids[None]) & (side[:, None] != side[None] if key[1] != key[2] else True)
            counts = linked @ copies
            a, b = np.nonzero(np.triu(linked))
            roots = dict(forest(zip(ids[a].tolist(), ids[b].tolist())))
            at = np.flatnonzero(counts)
            if len(at):
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids[at]), pa.array([roots.get(x, x) for x in ids[at].tolist()], pa.int64()),
                    pa.array(counts[at].astype(np.int64))], names=["id", "root", "links"])
    return verify


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, threshold: float = 0.8,
                    recall: float = 0.9995, max_hashes: int = 256, prints: bool = False) -> DataFrame:
    """``key, class_id, n_links``: documents whose sets of ``width``-word shingles have Jaccard >= ``threshold``.

    Words are runs of characters other than ASCII white space, A-Z lower-cased; a text of fewer than ``width`` words is one
    shingle. Documents with the same shingle set are one representative (the smallest id) with a number of copies.
    Representatives that agree on any band's hash become candidates: each is tied to the smallest id of the bucket, and
    the connected candidates are verified on their whole shingle sets, every one shipped once, or once per block pair
    where they are more than ``BLOCK``. A task returns counts and a spanning forest, never pairs.

    ``n_links`` counts the other documents linked directly, copies included; ``class_id`` is the smallest id connected by
    links. Bands and rows follow from ``recall`` at the threshold (more similar pairs are missed far less often).
    With ``prints`` the rows' fingerprints ``f1, f2`` are returned too.

    A text that is null or has no word links with nothing; a null key keeps its row with null class and 0 links; repeated
    rows are documents of their own, rows that share a key share a class; an empty table gives an empty result; other columns are ignored.
    """
    small_batches(df.sparkSession)
    bands, rows = banding(threshold, recall, max_hashes)
    docs = df.select(F.col(key).cast("bigint").alias("id"), F.col(text).cast("string").alias("text"))
    signed = stored(docs.mapInArrow(_signer(width, bands, rows), "id bigint, f1 bigint, f2 bigint, bands array<bigint>"))
    # All copies have equal bands, so any copy's serve.
    same = stored(signed.where("id IS NOT NULL AND f1 IS NOT NULL").groupBy("f1", "f2").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.min("bands").alias("bands")))
    cells = same.select("rep", F.explode("bands").alias("band"))
    buckets = stored(cells.groupBy("band").agg(F.min("rep").alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    ties = joined_small(cells, buckets, "band").where("rep <> leader").select(
        F.col("rep").alias("src"), F.col("leader").alias("dst")).distinct()
    candidates = components(ties)
    sizes = candidates.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("chunks"))
    candidates = stored(candidates.join(sizes, "component").join(same.select("rep", "copies"), F.col("node") == F.col("rep")).select(
        F.col("node").alias("id"), "copies", "component", "chunks"))
    sets = joined_small(docs, candidates, "id").select("id", "copies", "component", "chunks", "text").mapInArrow(
        _shingler(width), "id bigint, copies bigint, component bigint, chunks int, shingles array<bigint>")
    links = stored(block_pairs(sets, "component", "id").mapInArrow(_verifier(threshold), "id bigint, root bigint, links bigint"))
    classes = components(links.selectExpr("id AS src", "root AS dst"))
    found = stored(links.groupBy("id").agg(F.sum("links").alias("links")).join(
        classes.withColumnRenamed("node", "id"), "id", "left").selectExpr("id AS rep", "links", "coalesce(component, id) AS component"))
    reps = joined_small(same.select("f1", "f2", "rep", "copies"), found, "rep", "left")
    # A null id takes no part: its row keeps a null class.
    row = signed.select("id", F.expr("CASE WHEN id IS NOT NULL THEN f1 END AS f1"), "f2", F.col("f1").alias("print"))
    return row.join(stored(reps), ["f1", "f2"], "left").select(
        F.col("id").alias(key), F.expr("coalesce(component, rep, id) AS class_id"),
        F.expr("coalesce(copies - 1 + coalesce(links, 0), 0) AS n_links"), *([F.col("print").alias("f1"), "f2"] if prints else []))


OP4_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(words) < 5 THEN array_to_string(words, ' ')
             ELSE array_to_string(list_slice(words, k, k + 4), ' ') END AS shingle
      FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS k FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
p AS (SELECT x, y FROM c JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE common >= 0.8 * (a.size + b.size - common) - 1e-6),
r AS (SELECT x AS node, x AS seen FROM p UNION SELECT r.node, p.y FROM r JOIN p ON p.x = r.seen)
SELECT d.doc_id, coalesce(min(r.seen), d.doc_id) AS class_id, coalesce(any_value(k.n), 0) AS n_links
FROM documents d LEFT JOIN r ON r.node = d.doc_id LEFT JOIN (SELECT x, count(*) AS n FROM p GROUP BY x) k ON k.x = d.doc_id
GROUP BY d.doc_id
"""


@query("op4_jaccard_join", OP4_SQL)
def op4_jaccard_join(spark, folder):
    return near_duplicates(read_table(spark, folder, "documents"))
