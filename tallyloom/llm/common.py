"""Helpers shared by the corpus operators: tables in the shared folder, word hashes, connected components."""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.sinks import new_folder

SLICE_BYTES = 1 << 19  # text bytes handled at once inside a task

_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[str, np.ndarray] = {}


@contextmanager
def setting(spark: SparkSession, name: str, value: str):
    """A session setting for as long as a table is written."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def stored(*parts: DataFrame, codec: str | None = None) -> DataFrame:
    """The rows of ``parts``, written one after another as Parquet to the folder all executors share, and read back: lineage ends here.

    The shuffle files of a part go when it is written, not when the driver happens to collect its garbage.
    """
    spark = parts[0].sparkSession
    folder = new_folder(spark)
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        for df in parts:
            writer = df.select("*").write.mode("append")  # a new frame takes the setting
            (writer.option("compression", codec) if codec else writer).parquet(folder)
    out = spark.read.schema(parts[0].schema).parquet(folder)
    out.stored_in = folder
    return out


def removed(*tables: DataFrame) -> None:
    """Removes what ``stored`` (or ``components``) wrote for these tables and nothing reads any more."""
    for table in tables:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table.stored_in)
        path.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Rows of one Arrow batch of whole texts, so that a Python worker holds a few megabytes of them.
TEXT_ROWS = 250


def small_batches(spark: SparkSession) -> None:
    """Lets the session pass rows to Python workers in batches of at most ``TEXT_ROWS``."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= TEXT_ROWS:
        spark.conf.set(name, str(TEXT_ROWS))


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit words (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers["up"]) < n:
        size = max(n, SLICE_BYTES + 1)
        for name, base in (("up", _ODD), ("down", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def hashed_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every byte span of ``data``, equal for equal bytes wherever they stand."""
    up, down = _power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=total[1:])
    return mixed((total[ends] - total[starts]) * down[starts])


def text_slices(column: pa.Array):
    """Rows ``first:last`` with their bytes and row offsets, a bounded number of bytes at once (one row at least).

    A null row counts as empty.
    """
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    column = column.fill_null("") if column.null_count else column
    n = len(column)
    if n == 0:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def spans_of(marked: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True in ``marked``; a run never crosses a row offset."""
    n = len(marked)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(n + 1, bool)
    edge[rows] = True
    before = np.concatenate([[False], marked[:-1]])
    starts = np.flatnonzero(marked & (~before | edge[:-1]))
    after = np.concatenate([marked[1:], [False]])
    ends = np.flatnonzero(marked & (~after | edge[1:])) + 1
    return starts, ends


def word_hashes(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the white-space separated words (A-Z lower-cased), and the first word of every row plus the total."""
    data = _LOWER[data]
    starts, ends = spans_of(~_SPACE[data], rows)
    return hashed_spans(data, starts, ends), np.searchsorted(starts, rows)


def shingle_hashes(words: np.ndarray, firsts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words inside each row; a row with fewer words has one shingle of all its words.

    Returns the hashes and the first shingle of every row plus the total; a row without words has none.
    """
    counts = np.diff(firsts)
    n = len(words)
    factors = mixed(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    full = np.zeros(max(n - width + 1, 0), np.uint64)
    for k in range(width):
        full += words[k:k + len(full)] * factors[k]
    sizes = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    out_first = np.concatenate([[0], np.cumsum(sizes)])
    out = np.empty(out_first[-1], np.uint64)
    row = np.repeat(np.arange(len(counts)), sizes)
    at = np.arange(len(out)) - out_first[:-1][row] + firsts[:-1][row]
    long_row = (counts >= width)[row]
    out[long_row] = full[at[long_row]]
    for i in np.flatnonzero((counts > 0) & (counts < width)):
        own = words[firsts[i]:firsts[i + 1]]
        out[out_first[i]] = (own * factors[:len(own)]).sum(dtype=np.uint64) + np.uint64(len(own))
    return mixed(out), out_first


def forest(pairs) -> list[tuple[int, int]]:
    """(node, smallest node of its component) for every node that is not the smallest; ``pairs`` fit in one task."""
    parent: dict = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    return [(x, root(x)) for x in list(parent) if root(x) != x]


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, component`` for every node of ``links`` (``src``, ``dst`` bigint), component being its smallest node.

    Large-star and small-star rounds (Kiveris et al.): every node hooks its neighbours onto the smallest one it knows,
    so a component of n nodes becomes a star in about log n rounds. The minima are pre-aggregated per task and written to
    the shared folder before they are joined back, so a hub's links are one skewed join that Spark can split. Nothing but
    two totals a round reaches the driver. What a round has read is removed; ``removed`` of the result removes the last round.
    """
    def directed(df: DataFrame) -> DataFrame:
        return df.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def star(edges: DataFrame, large: bool) -> DataFrame:
        """The moved links, stored; ``edges`` is removed."""
        seen = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
        lowest = stored(seen.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low")))
        moved = seen.join(lowest, "a")
        if large:
            out = moved.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        else:
            out = moved.select(F.col("b").alias("a"), F.col("low").alias("b")).unionAll(lowest.select("a", F.col("low").alias("b")))
        out = stored(directed(out))
        removed(edges, lowest)
        return out

    def total(df: DataFrame):
        return tuple(df.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first())

    edges = stored(directed(links.select(F.col("src").alias("a"), F.col("dst").alias("b"))))
    known = total(edges)
    for _ in range(max_rounds):
        if not known[0]:
            break
        edges = star(star(edges, True), False)
        now = total(edges)
        if now == known:
            break
        known = now
    else:
        raise RuntimeError("components did not settle")
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = nodes.unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
    found.stored_in = edges.stored_in
    return found


def grouped(batches, keys: list[str]):
    """(key values, table) of each run of equal keys in Arrow batches that arrive sorted by ``keys``."""
    held, held_key = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        change[0] = True
        for c in columns:
            values = c.to_numpy(zero_copy_only=False)
            change[1:] |= values[1:] != values[:-1]
        cuts = [*np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            now = tuple(c[a].as_py() for c in columns)
            if held and now != held_key:
                yield held_key, pa.Table.from_batches(held)
                held = []
            held_key = now
            held.append(batch.slice(a, b - a))
    if held:
        yield held_key, pa.Table.from_batches(held)


SMALL_ROWS = 1_000_000


def joined_small(large: DataFrame, small: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join with a stored table of few narrow columns, broadcast when a count shows it below ``SMALL_ROWS`` rows."""
    few = small.count() <= SMALL_ROWS
    return large.join(F.broadcast(small) if few else small, on, how)


def block_pairs(df: DataFrame, group: str, item: str) -> DataFrame:
    """Rows dealt to the block pairs (i, j), i <= j, of their group, grouped and sorted for ``mapInArrow``.

    ``chunks`` says into how many blocks the group is cut by a hash of ``item``; ``side`` is the row's own block. Any two
    rows of a group meet in exactly one block pair.
    """
    rest = [c for c in df.columns if c not in (group, "chunks")]
    placed = df.withColumn("_own", F.expr(f"CAST(pmod(xxhash64({item}), chunks) AS INT)")).withColumn(
        "_other", F.explode(F.expr("sequence(0, chunks - 1)"))).select(
        group, F.least("_own", "_other").alias("i"), F.greatest("_own", "_other").alias("j"), F.col("_own").alias("side"), *rest)
    return placed.repartition(group, "i", "j").sortWithinPartitions(group, "i", "j", item)
