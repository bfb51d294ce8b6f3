"""Decision trees and forests, grown level by level for all trees, folds and candidates at once.

Rows are packed into held blocks that carry every tree's open node of the row. A level's large nodes are split from order
statistics: a pass over the blocks counts rows per cell of each (node, feature), the few cells that hold a wanted rank
are cut again or counted by exact value in the next pass, and thresholds are read off the counts. What is exchanged has
the size of cells, not of rows. A node that one task can hold is not split level by level: its rows go to a task once,
which grows the rest of it. Only node tables come back to the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import hash_number, left_out, poisson_draws, unit_hash
from ..functions.scalar import col, gain_text
from . import splits
from .splits import GAIN_DIGITS, THRESHOLD_POINTS  # noqa: F401  (part of this module's interface)

#: Rows of a node that one task may hold and finish alone.
ROWS_PER_TASK = 65_536
#: Rows of a cell whose values are counted one by one.
ROWS_PER_CELL = 4096
#: (node, feature) pairs that are split together; more take further passes over the blocks.
PAIRS_AT_ONCE = 20_000
#: Bytes of blocks that a Python worker is handed at once (one block at least), however long its partition is.
BYTES_AT_ONCE = 4 << 20
#: Trees grown together: each one costs four bytes a held row.
TREES_AT_ONCE = 1024

NODE_SCHEMA = ("tree int, node bigint, depth int, feature string, threshold double, is_categorical boolean, "
               "left_node bigint, right_node bigint, prediction int, n bigint, n_pos bigint, gain double")


@dataclass(frozen=True)
class TreeOptions:
    max_depth: int = 10
    min_samples_split: int = 20
    min_samples_leaf: int = 10
    criterion: str = "gini"
    #: Nodes deeper than ``deep`` with more rows than this become leaves; no such cut unless it is set.
    max_rows_in_deep_node: int | None = None
    deep: int = 3

    def cuts_off(self, depth: int, rows: int) -> bool:
        return self.max_rows_in_deep_node is not None and depth > self.deep and rows > self.max_rows_in_deep_node


@dataclass
class Node:
    tree: int
    node: int
    depth: int
    n: int
    n_pos: int
    feature: int | None = None
    threshold: float | None = None
    is_categorical: bool = False
    gain: float = 0.0

    @property
    def prediction(self) -> int:
        return int(2 * self.n_pos > self.n)

    def may_split(self, o: TreeOptions) -> bool:
        return (self.depth < o.max_depth and self.n >= max(o.min_samples_split, 2 * o.min_samples_leaf)
                and 0 < self.n_pos < self.n and not o.cuts_off(self.depth, self.n))


@dataclass
class TreeModel:
    """Node table of one or more trees over the named features."""

    features: list[str]
    nodes: list[Node]
    subsets: dict[int, list[int]]
    bootstrap_seed: int | None = None

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = []
        for n in self.nodes:
            leaf = n.feature is None
            rows.append((n.tree, n.node, n.depth, None if leaf else self.features[n.feature], n.threshold,
                         None if leaf else n.is_categorical, None if leaf else 2 * n.node + 1,
                         None if leaf else 2 * n.node + 2, n.prediction if leaf else None, n.n, n.n_pos,
                         None if leaf else n.gain))
        return spark.createDataFrame(rows, NODE_SCHEMA)

    @property
    def trees(self) -> list[int]:
        return sorted(self.subsets)


def tree_seed(seed: int, tree: int) -> int:
    """A number of its own for every tree of seeds below a million, however many trees."""
    return seed * 1000 + tree % 1000 + tree // 1000 * 1_000_000_007


def subset_size(max_features: str | int, count: int) -> int:
    if max_features == "sqrt":
        size = int(math.sqrt(count))
    elif max_features == "log2":
        size = int(math.log2(count))
    elif max_features == "all":
        size = count
    else:
        size = int(max_features)
    return min(size, count)


def feature_subset(count: int, size: int, seed: int, tree: int) -> list[int]:
    """The features with the smallest hashes for this tree."""
    order = sorted(range(count), key=lambda f: hash_number(f, tree_seed(seed, tree)))
    return sorted(order[:size])


def with_draws(rows: DataFrame, seed: int | None, output: str = "w", drawn_only: bool = True) -> DataFrame:
    """Add how often the row's ``tree`` draws it; every tree draws each row once without a seed."""
    if seed is None:
        return rows.withColumn(output, F.lit(1))
    # The uniform number is a column of its own and the filter looks at it alone: a filter on the weight would be
    # pushed down with the whole weight expression inside it.
    hashed = rows.withColumn("_u", unit_hash("id", f"({seed * 1000} + tree % 1000 + tree DIV 1000 * 1000000007L)"))
    if drawn_only:
        hashed = hashed.where(~left_out(F.col("_u")))
    return hashed.withColumn(output, poisson_draws("_u")).drop("_u")


@dataclass(frozen=True)
class TreeSpec:
    """A tree to grow: its number decides its draws; rows of fold ``held_out`` are not seen."""

    tree: int
    features: tuple[int, ...]
    options: TreeOptions
    seed: int | None = None
    held_out: int = -1

    def rules(self, categorical: set[int]) -> tuple:
        o = self.options
        return (self.features, tuple(f in categorical for f in self.features), o.criterion != "gini", o.min_samples_leaf,
                o.min_samples_split, o.max_depth, o.max_rows_in_deep_node, o.deep)


class _Grower:
    """One job's blocks, the trees on them and their node tables."""

    def __init__(self, blocks: DataFrame, width: int, specs: Sequence[TreeSpec], samples: Sequence[tuple], categorical: set[int],
                 rows_per_task: int, rows_per_cell: int):
        self.blocks, self.width, self.specs, self.categorical = blocks, width, list(specs), categorical
        self.spark = blocks.sparkSession
        self.draws, self.sample_of = len(samples), [samples.index((s.seed, s.tree if s.seed is not None else 0)) for s in specs]
        self.features = [s.features for s in specs]
        self.rows_per_task, self.rows_per_cell = rows_per_task, rows_per_cell
        self.nodes: list[list[Node]] = [[] for _ in specs]

    def _summed(self, counter) -> DataFrame:
        """Cells of all tasks, added up; a range's cells are in one task."""
        parts = self.blocks.mapInArrow(counter, splits.CELL_SCHEMA).repartition("p")
        return parts.groupBy("p", "c").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))

    def totals(self) -> list[Node]:
        rows = self._summed(splits.totaller(self.width, self.draws, self.sample_of)).collect()
        found = {r["p"]: r for r in rows}
        self.lows = np.array([found[-1 - f]["lo"] for f in range(self.width)] if rows else [0.0] * self.width)
        self.highs = np.array([found[-1 - f]["hi"] for f in range(self.width)] if rows else [0.0] * self.width)
        roots = [Node(s.tree, 0, 0, found[t]["n"], found[t]["pos"]) if rows else Node(s.tree, 0, 0, 0, 0) for t, s in enumerate(self.specs)]
        for nodes, root in zip(self.nodes, roots):
            # A tree that drew no row has no node, as in an aggregate without rows.
            nodes += [root] if root.n else []
        return roots

    def grow(self) -> None:
        now = list(enumerate(self.totals()))
        parts: list[tuple[int, Node]] = []
        held, steps = self.blocks, []
        while True:
            # The k-th open node of the level is the one whose rows have state k.
            large, left, right = [], np.full(len(now), -1), np.full(len(now), -1)
            for k, (t, node) in enumerate(now):
                if not node.may_split(self.specs[t].options):
                    continue
                if node.n <= self.rows_per_task:
                    left[k] = right[k] = -2 - len(parts)
                    parts.append((t, node))
                else:
                    large.append(k)
            if not large:
                part_of = np.where(left <= -2, -2 - left, -1)
                break
            chosen = self._split(now, large)
            feature, at, category = np.full(len(now), -1), np.zeros(len(now)), np.zeros(len(now), bool)
            following: list[tuple[int, Node]] = []
            for k, (f, threshold, is_category, gain, n, n_pos) in chosen.items():
                t, node = now[k]
                node.feature, node.threshold, node.is_categorical, node.gain = f, threshold, is_category, gain
                feature[k], at[k], category[k] = f, threshold, is_category
                pair = (Node(node.tree, 2 * node.node + 1, node.depth + 1, n, n_pos),
                        Node(node.tree, 2 * node.node + 2, node.depth + 1, node.n - n, node.n_pos - n_pos))
                self.nodes[t] += pair
                left[k], right[k] = len(following), len(following) + 1
                following += [(t, child) for child in pair]
            step = splits.advancer(self.width, self.draws, len(self.specs), feature, at, category, left, right)
            now = following
            if any(n.may_split(self.specs[t].options) and n.n > self.rows_per_task for t, n in now):
                before, self.blocks = self.blocks, self.blocks.mapInArrow(step, splits.BLOCK_SCHEMA).persist(StorageLevel.MEMORY_AND_DISK)
                self.blocks.count()
                if before is not held:
                    before.unpersist()
            else:
                # The last step is taken by the tasks that hand out the rows.
                steps = [step]
        if parts:
            self._finish(parts, part_of, steps)

    def _split(self, now, large: list[int]) -> dict[int, tuple]:
        """Best split of each large open node: feature, threshold, kind, gain, rows and positives on the left."""
        out, wave, pairs = {}, [], 0
        for k in large:
            count = len(self.features[now[k][0]])
            if wave and pairs + count > PAIRS_AT_ONCE:
                out.update(self._wave(now, wave))
                wave, pairs = [], 0
            wave.append(k)
            pairs += count
        out.update(self._wave(now, wave))
        return out

    def _wave(self, now, wave: list[int]) -> dict[int, tuple]:
        counts = [len(self.features[now[k][0]]) for k in wave]
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
        base = np.full(wave[-1] - wave[0] + 1, -1)
        base[np.array(wave) - wave[0]] = starts
        # Per pair of node and feature.
        node = np.repeat(wave, counts)
        feature = np.concatenate([self.features[now[k][0]] for k in wave]).astype(np.int64)
        size, size_pos = (np.repeat([getattr(now[k][1], a) for k in wave], counts) for a in ("n", "n_pos"))
        options = [self.specs[now[k][0]].options for k in node]
        entropy, leaf = np.array([o.criterion != "gini" for o in options]), np.array([o.min_samples_leaf for o in options])
        category = np.isin(feature, sorted(self.categorical))
        lo, hi = self.lows[feature], self.highs[feature]
        # Ranges that the current pass cuts, with the rows and positives before them.
        slot, rows, before, before_pos = np.arange(len(node)), size, np.zeros(len(node), np.int64), np.zeros(len(node), np.int64)
        # Distinct values known so far, and whether a pair's may still be fewer than five.
        kinds, unsure = np.zeros(len(node), np.int64), np.ones(len(node), bool)
        stages: list[splits.Stage] = []
        codes, values, categories = np.zeros(0, np.int64), [], {}
        while len(slot):
            mode = self._modes(rows, lo, hi, len(stages), category[slot] if not stages else None)
            stages.append(splits.Stage(mode, lo, hi, codes))
            counter = splits.cell_counter(self.width, self.draws, self.features, self.sample_of, wave[0], base, stages)
            table = {"p": np.arange(len(slot)), "size": size[slot], "size_pos": size_pos[slot], "before": before, "before_pos": before_pos,
                     "category": category[slot], "entropy": entropy[slot], "leaf": leaf[slot], "unsure": unsure[slot]}
            found = self._cells(self._summed(counter), table, not stages[1:] and category.any())
            for r in range(len(found["p"])) if found["category"].any() else ():
                if found["category"][r]:
                    categories[int(slot[found["p"][r]])] = (found["gain"][r], found["c"][r], found["n"][r], found["pos"][r])
            found = {name: column[~found["category"]] for name, column in found.items()}
            of = slot[found["p"]]
            single = found["lo"] == found["hi"]
            values.append((of[single], found["lo"][single], found["b"][single], found["n"][single], found["bp"][single], found["pos"][single]))
            # Every unsure range returned all its cells, or says that it has five kinds at least.
            firsts = np.unique(found["p"], return_index=True)[1]
            seen = kinds.copy()
            np.add.at(seen, of[firsts], found["kinds"][firsts])
            unsure &= seen < splits.MANY
            kinds = np.where(unsure, kinds, splits.MANY)
            np.add.at(kinds, of[single & unsure[of]], 1)
            held = mode[found["p"]] > splits.EXACT
            wanted = ~single & held & (found["wanted"] | unsure[of])
            codes = found["p"][wanted] * splits.CELLS + found["c"][wanted].astype(np.int64)
            order = np.argsort(codes)
            codes = codes[order]
            slot, rows, before, before_pos, lo, hi = (a[order] for a in (
                of[wanted], found["n"][wanted], found["b"][wanted], found["bp"][wanted], found["lo"][wanted], found["hi"][wanted]))
        merged = [np.concatenate(c) for c in zip(*values)]
        pair, at, left, left_pos = splits.numeric_candidates(size, size_pos, np.where(category, 0, kinds), *merged)
        kind = np.zeros(len(pair), bool)
        if categories:
            own = [(s, c, n, p) for s, (_, c, n, p) in categories.items()]
            pair, at, left, left_pos = (np.concatenate([a, [o[i] for o in own]]) for i, a in enumerate((pair, at, left, left_pos)))
            pair, kind = pair.astype(np.int64), np.concatenate([kind, np.ones(len(own), bool)])
        gain = splits.split_maths()[0](size[pair], size_pos[pair], left, left_pos, entropy[pair])
        rounded = np.round(gain, GAIN_DIGITS)
        fit = np.flatnonzero((left >= leaf[pair]) & (size[pair] - left >= leaf[pair]) & (rounded > 0))
        # Highest gain per node; the first feature and the lowest threshold win ties.
        fit = fit[np.lexsort((at[fit], feature[pair[fit]], -rounded[fit], node[pair[fit]]))]
        fit = fit[np.unique(node[pair[fit]], return_index=True)[1]]
        return {int(node[pair[i]]): (int(feature[pair[i]]), float(at[i]), bool(kind[i]), float(gain[i]), int(left[i]), int(left_pos[i])) for i in fit}

    def _modes(self, rows, lo, hi, depth: int, category) -> np.ndarray:
        """Small ranges are counted by value; large ones are cut evenly, every second time by the bits of their values."""
        with np.errstate(over="ignore"):
            even = np.isfinite(hi - lo) & (depth % 2 == 0)
            even &= np.isfinite(splits.CELLS / np.where(hi > lo, hi - lo, 1.0))
        mode = np.where(rows <= self.rows_per_cell, splits.EXACT, np.where(even, splits.BY_VALUE, splits.BY_BITS))
        if category is not None:
            mode = np.where(category, splits.EXACT, np.where(lo == hi, splits.DROPPED, mode))
        return mode

    def _cells(self, cells: DataFrame, table: dict, categories: bool) -> dict[str, np.ndarray]:
        """The cells that hold a wanted rank, all cells of ranges with few kinds, and each category column's best value."""
        ranges = self.spark.createDataFrame(pa.table(table))
        joined = cells.join(F.broadcast(ranges), "p")
        upto = "OVER (PARTITION BY p ORDER BY c ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        out = (joined.where("NOT category").selectExpr(
            "p", "c", "n", "pos", "lo", "hi", f"before + sum(n) {upto} - n AS b", f"before_pos + sum(pos) {upto} - pos AS bp", "category", "0D AS gain",
            "size", "before", "unsure", "sum(CASE WHEN lo = hi THEN 1 ELSE 2 END) OVER (PARTITION BY p) AS kinds")
            .withColumn("wanted", F.expr(f"exists({splits.wanted_ranks('size')}, r -> r >= b AND r < b + n)"))
            # A range whose kinds count says so with its first cell.
            .where(f"wanted OR (unsure AND (kinds < {splits.MANY} OR b = before))"))
        names = ["p", "c", "n", "pos", "lo", "hi", "b", "bp", "category", "gain", "kinds", "wanted"]
        out = out.select(names)
        if categories:
            own = " ".join(f"WHEN {'NOT ' if c == 'gini' else ''}entropy THEN round({_gain('n', 'pos', c)}, {GAIN_DIGITS})" for c in ("gini", "entropy"))
            best = (joined.where("category AND n >= leaf AND size - n >= leaf").withColumn("gain", F.expr(f"CASE {own} END"))
                    .groupBy("p").agg(F.max(F.struct("gain", (-F.col("c")).alias("c"), "n", "pos")).alias("s"))
                    .selectExpr("p", "-s.c AS c", "s.n AS n", "s.pos AS pos", "-s.c AS lo", "-s.c AS hi", "0L AS b", "0L AS bp", "true AS category",
                                "s.gain AS gain", "0L AS kinds", "true AS wanted"))
            out = out.unionByName(best)
        rows = out.toArrow()
        return {n: rows.column(n).to_numpy() for n in names}

    def _finish(self, parts: list[tuple[int, Node]], part_of: np.ndarray, steps: list) -> None:
        """The nodes that fit a task, each grown to its end where its rows are brought together."""
        chunker = splits.chunker(self.width, self.draws, self.features, self.sample_of, part_of)
        chunks = self.blocks.mapInArrow(splits.chained(*steps, chunker), splits.CHUNK_SCHEMA)
        rules = [s.rules(self.categorical) for s in self.specs]
        grower = splits.node_grower(rules, np.array([t for t, _ in parts]), np.array([n.node for _, n in parts]), np.array([n.depth for _, n in parts]))
        rows = chunks.repartition("part").sortWithinPartitions("part").mapInArrow(grower, splits.GROWN_SCHEMA).toArrow().to_pylist()
        tops = {(t, n.node): n for t, n in parts}
        for r in rows:
            t, _ = parts[r["part"]]
            node = tops.get((t, r["node"]))
            if node is None:
                node = Node(self.specs[t].tree, r["node"], r["depth"], r["n"], r["n_pos"])
                self.nodes[t].append(node)
            if r["feature"] >= 0:
                node.feature, node.threshold, node.is_categorical, node.gain = r["feature"], r["at"], r["category"], r["gain"]


def _gain(left_n: str, left_pos: str, criterion: str) -> str:
    return gain_text("(size - size_pos)", "size_pos", f"({left_n} - {left_pos})", left_pos, criterion)


@contextmanager
def short_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of a few blocks inside, the session's setting afterwards."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(BYTES_AT_ONCE))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def grow_trees(df: DataFrame, features: Sequence[str], y01: str, specs: Sequence[TreeSpec], categorical: Sequence[str] = (),
               key: str = "id", fold: str | None = None, rows_per_bucket: int = ROWS_PER_TASK, rows_per_cell: int = ROWS_PER_CELL
               ) -> list[list[Node]]:
    """The node table of every spec, in order, from one set of held blocks (one per ``TREES_AT_ONCE`` trees).

    Jobs grow with the depth of the large nodes, not with the number of trees, folds or candidates. ``rows_per_bucket`` is
    the number of rows of a node that one task finishes alone; it and ``rows_per_cell`` never change the result.
    """
    features = list(features)
    cat = {i for i, f in enumerate(features) if f in set(categorical)}
    out: list[list[Node]] = []
    for start in range(0, len(specs), TREES_AT_ONCE):
        some = list(specs[start:start + TREES_AT_ONCE])
        samples = list(dict.fromkeys((s.seed, s.tree if s.seed is not None else 0) for s in some))
        sample_of = [samples.index((s.seed, s.tree if s.seed is not None else 0)) for s in some]
        narrow = df.select(F.col(key).cast("bigint").alias("id"), F.col(y01).cast("double").alias("y"),
                           (F.col(fold) if fold else F.lit(-1)).cast("int").alias("fold"),
                           *[col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)])
        pack = splits.packer(len(features), [None if seed is None else tree_seed(seed, t) for seed, t in samples], sample_of, [s.held_out for s in some])
        blocks = narrow.mapInArrow(pack, splits.BLOCK_SCHEMA).persist(StorageLevel.MEMORY_AND_DISK)
        grower = _Grower(blocks, len(features), some, samples, cat, rows_per_bucket, rows_per_cell)
        try:
            with short_batches(df.sparkSession):
                grower.grow()
        finally:
            grower.blocks.unpersist()
            blocks.unpersist()
        out += [sorted(nodes, key=lambda n: n.node) for nodes in grower.nodes]
    return out


def fit_tree(df: DataFrame, features: Sequence[str], y01: str, options: TreeOptions = TreeOptions(),
             categorical: Sequence[str] = (), key: str = "id", **grow_options) -> TreeModel:
    spec = TreeSpec(0, tuple(range(len(features))), options)
    return TreeModel(list(features), grow_trees(df, features, y01, [spec], categorical, key, **grow_options)[0], {0: list(spec.features)})


@dataclass(frozen=True)
class Forest:
    """Settings of a forest: trees on Poisson bootstrap samples and per-tree feature subsets, split by Gini impurity."""

    trees: int = 100
    max_features: str | int = "sqrt"
    options: TreeOptions = TreeOptions()
    seed: int = 1
    held_out: int = -1

    def specs(self, count: int) -> list[TreeSpec]:
        size, plain = subset_size(self.max_features, count), replace(self.options, criterion="gini")
        return [TreeSpec(t, tuple(feature_subset(count, size, self.seed, t)), plain, self.seed, self.held_out) for t in range(self.trees)]


def fit_forests(df: DataFrame, features: Sequence[str], y01: str, forests: Sequence[Forest], categorical: Sequence[str] = (),
                key: str = "id", fold: str | None = None, **grow_options) -> list[TreeModel]:
    """Many forests grown together: candidates, and folds whose rows (``held_out``) a forest does not see."""
    specs = [f.specs(len(features)) for f in forests]
    grown = iter(grow_trees(df, features, y01, [s for own in specs for s in own], categorical, key, fold, **grow_options))
    return [TreeModel(list(features), [n for _ in own for n in next(grown)], {s.tree: list(s.features) for s in own}, f.seed)
            for f, own in zip(forests, specs)]


def fit_forest(df: DataFrame, features: Sequence[str], y01: str, trees: int = 100, max_features: str | int = "sqrt",
               options: TreeOptions = TreeOptions(), categorical: Sequence[str] = (), seed: int = 1, key: str = "id",
               **grow_options) -> TreeModel:
    """Trees on Poisson bootstrap samples and per-tree feature subsets; forests always split by Gini impurity."""
    return fit_forests(df, features, y01, [Forest(trees, max_features, options, seed)], categorical, key, **grow_options)[0]


def voter(model: TreeModel):
    """Every tree's 0/1 vote for a matrix of rows x features, as an executor function that travels by value."""
    own: dict[int, list[Node]] = {t: [] for t in model.trees}
    for n in model.nodes:
        own[n.tree].append(n)
    tables = []
    for t in model.trees:
        mine = own[t]
        place = {n.node: i for i, n in enumerate(mine)}
        inner = [n.feature is not None for n in mine]
        tables.append((
            np.array([n.feature if s else 0 for n, s in zip(mine, inner)]),
            np.array([n.threshold if s else 0.0 for n, s in zip(mine, inner)], dtype=float),
            np.array([n.is_categorical for n in mine]),
            np.array([place[2 * n.node + 1] if s else i for i, (n, s) in enumerate(zip(mine, inner))]),
            np.array([place[2 * n.node + 2] if s else i for i, (n, s) in enumerate(zip(mine, inner))]),
            np.array([float(n.prediction) for n in mine]),
            max((n.depth for n in mine), default=0)))

    def vote(x: np.ndarray) -> np.ndarray:
        rows = np.arange(len(x))
        out = np.zeros((len(x), len(tables)))
        for t, (feature, threshold, category, left, right, prediction, depth) in enumerate(tables):
            if not len(prediction):
                continue
            at = np.zeros(len(x), dtype=int)
            for _ in range(depth):
                v = x[rows, feature[at]]
                go_left = np.where(category[at], v == threshold[at], v <= threshold[at])
                at = np.where(go_left, left[at], right[at])
            out[:, t] = prediction[at]
        return out
    return vote


def votes(model: TreeModel, share: bool = False) -> Column:
    """Array column with every tree's 0/1 vote, in tree order; with ``share`` the share of 1 as one number."""
    count, each = len(model.trees), voter(model)

    @F.pandas_udf("double" if share else "array<double>")
    def vote(*columns: pd.Series) -> pd.Series:
        out = each(np.stack([c.to_numpy(dtype=float) for c in columns], axis=1))
        # A sum of whole numbers over their count, as an average in SQL.
        return pd.Series(out.sum(axis=1) / count) if share else pd.Series(list(out))

    return vote(*[col(f).cast("double") for f in model.features])


def held_out_scores(df: DataFrame, models: dict[tuple[int, int], TreeModel], fold: str = "fold", label: str = "y") -> DataFrame:
    """``fit, fold, y, score``: every row scored by each fit's forest of its own fold, in one pass over the rows."""
    features = next(iter(models.values())).features
    voters = {place: (voter(m), len(m.trees)) for place, m in models.items()}

    def score(batches):
        for batch in batches:
            x = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(2, batch.num_columns)], axis=1)
            folds = batch.column(0).to_numpy(zero_copy_only=False)
            for (fit, fold_number), (each, count) in voters.items():
                at = np.flatnonzero(folds == fold_number)
                if len(at):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), fit, np.int32)), pa.array(np.full(len(at), fold_number, np.int32)),
                         batch.column(1).take(pa.array(at)), pa.array(each(x[at]).sum(axis=1) / count)], names=["fit", "fold", "y", "score"])

    rows = df.select(F.col(fold).cast("int"), F.col(label).cast("int").alias("y"), *[col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)])
    return rows.mapInArrow(score, "fit int, fold int, y int, score double")


def training_errors(df: DataFrame, models: dict[tuple[int, int], TreeModel], y01: str, fold: str = "fold") -> dict[tuple[int, int], float]:
    """Share of the rows outside a forest's held-out fold that its majority gets wrong, for all forests in one pass."""
    features = next(iter(models.values())).features
    voters = {place: (voter(m), len(m.trees)) for place, m in models.items()}

    def errors(batches):
        total = {place: [0, 0] for place in voters}
        for batch in batches:
            x = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(2, batch.num_columns)], axis=1)
            folds, y = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for place, (each, count) in voters.items():
                at = np.flatnonzero(folds != place[1])
                wrong = (each(x[at]).sum(axis=1) / count > 0.5) != (y[at] > 0.5)
                total[place][0] += int(wrong.sum())
                total[place][1] += len(at)
        yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in total], pa.int32()), pa.array([p[1] for p in total], pa.int32()),
                                          pa.array([t[0] for t in total.values()], pa.int64()), pa.array([t[1] for t in total.values()], pa.int64())],
                                         names=["fit", "fold", "wrong", "n"])

    rows = df.select(F.col(fold).cast("int"), F.col(y01).cast("double").alias("y"), *[col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)])
    summed = rows.mapInArrow(errors, "fit int, fold int, wrong bigint, n bigint").groupBy("fit", "fold").agg(F.sum("wrong").alias("wrong"), F.sum("n").alias("n"))
    return {(r["fit"], r["fold"]): r["wrong"] / r["n"] if r["n"] else float("nan") for r in summed.collect()}


def probability(model: TreeModel) -> Column:
    """Share of the trees that vote for the positive class (0 or 1 for a single tree)."""
    return votes(model, share=True)


def class_vote(p: Column) -> Column:
    """Majority class in {0, 1}; a tie goes to 0."""
    return F.when(p > 0.5, 1).otherwise(0)


def oob_votes(df: DataFrame, model: TreeModel, y01: str, key: str = "id") -> DataFrame:
    """``id, y01, n_votes, n_pos_votes`` over the trees that did not draw the row."""
    voted = df.select(F.col(key).alias("id"), F.col(y01).alias("y01"), votes(model).alias("v"))
    out_of_bag = [left_out(unit_hash("id", tree_seed(model.bootstrap_seed, t))) for t in model.trees]
    count, positive = F.lit(0), F.lit(0.0)
    for i, out in enumerate(out_of_bag):
        count = count + F.when(out, 1).otherwise(0)
        positive = positive + F.when(out, F.col("v")[i]).otherwise(0.0)
    return voted.select("id", "y01", count.alias("n_votes"), positive.alias("n_pos_votes"))


def oob_score(df: DataFrame, model: TreeModel, y01: str, key: str = "id") -> DataFrame:
    """Accuracy over the rows with at least one out-of-bag vote."""
    counted = oob_votes(df, model, y01, key).where(F.col("n_votes") > 0)
    hit = F.when(F.col("n_pos_votes") * 2 > F.col("n_votes"), 1).otherwise(0) == F.col("y01")
    return counted.agg(F.count(F.lit(1)).alias("rows"), F.avg(hit.cast("double")).alias("oob_score"))


def importances(model: TreeModel, spark: SparkSession) -> DataFrame:
    """``tree, feature, importance``: gains summed per feature, normalised within each tree; unused features get 0."""
    rows = []
    for t, chosen in model.subsets.items():
        gains = {f: 0.0 for f in chosen}
        for n in model.nodes:
            if n.tree == t and n.feature is not None:
                gains[n.feature] += n.gain
        total = sum(gains.values())
        rows += [(t, model.features[f], g / total if total > 0 else 0.0) for f, g in gains.items()]
    return spark.createDataFrame(rows, "tree int, feature string, importance double")


def forest_importances(model: TreeModel, spark: SparkSession) -> DataFrame:
    """Tree importances summed per feature and normalised."""
    per_tree = importances(model, spark).groupBy("feature").agg(F.sum("importance").alias("g"))
    names = spark.createDataFrame([(f,) for f in model.features], "feature string")
    summed = names.join(per_tree, "feature", "left").na.fill(0.0, ["g"])
    total = summed.agg(F.sum("g")).first()[0]
    return summed.select("feature", (F.col("g") / F.lit(total) if total else F.lit(0.0)).alias("importance"))
