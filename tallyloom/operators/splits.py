"""Executor functions of the tree grower, and the choice of splits from order statistics.

Rows lie in blocks: a feature-major matrix, labels, draws per bootstrap sample, and for every tree the number of the row's
open node (``state``: -1 when it reached a leaf, -2 - k when it belongs to the k-th node that one task finishes).
The functions are nested and use NumPy and Arrow only, so they travel by value.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

from ..functions.hashing import HIGH_MULTIPLIER, MULTIPLIER, POISSON_ONE_CDF, PRIME, SEED_STEP

# Percentiles tried as thresholds, by number of distinct values (five stands for five or more).
THRESHOLD_POINTS = {
    2: (0.25, 0.75),
    3: (0.25, 0.5, 0.75),
    4: (0.25, 0.25 + 0.5 / 3, 0.25 + 1.0 / 3, 0.75),
    5: (0.25, 0.375, 0.5, 0.625, 0.75),
}
POINTS = sorted({q for qs in THRESHOLD_POINTS.values() for q in qs})
MANY = max(THRESHOLD_POINTS)

# Gains are compared at this many decimals, so that ties do not hang on the order of a floating-point sum.
GAIN_DIGITS = 12

CELLS = 256             # cells that a range of values is cut into
BLOCK_ROWS = 16_384
TASK_RECORDS = 1 << 20  # records a task holds before it adds up or passes on

BLOCK_SCHEMA = "n int, x binary, y binary, w binary, state binary"
CELL_SCHEMA = "p bigint, c double, n bigint, pos bigint, lo double, hi double"
CHUNK_SCHEMA = "part int, m int, x binary, y binary, w binary"
GROWN_SCHEMA = "part int, node bigint, depth int, n bigint, n_pos bigint, feature int, at double, category boolean, gain double"

# How a range of values is cut: not at all, by value, by the bits of the value, or dropped.
EXACT, BY_VALUE, BY_BITS, DROPPED = 0, 1, 2, -1


def block_reader(width: int, draws: int, trees: int):
    """``x`` (features x rows), ``y``, ``w`` (samples x rows) and ``state`` (trees x rows) of every block of a batch."""
    def read(batch: pa.RecordBatch):
        for n, x, y, w, state in zip(*[batch.column(i) for i in range(5)]):
            rows = n.as_py()
            yield (np.frombuffer(x.as_buffer(), np.float64).reshape(width, rows), np.frombuffer(y.as_buffer(), np.uint8),
                   np.frombuffer(w.as_buffer(), np.uint8).reshape(draws, rows), np.frombuffer(state.as_buffer(), np.int32).reshape(trees, rows))
    return read


def packer(width: int, seeds: Sequence[int | None], sample_of: Sequence[int], held_out: Sequence[int]):
    """Batches of ``id, y, fold, features...`` to blocks; draws are the same hash that the column functions use."""
    bounds, block_rows = POISSON_ONE_CDF, BLOCK_ROWS
    prime, multiplier, high, step = PRIME, MULTIPLIER, HIGH_MULTIPLIER, SEED_STEP

    def drawn(ids: np.ndarray, known: np.ndarray, seed: int | None) -> np.ndarray:
        if seed is None:
            return np.ones(len(ids), np.uint8)
        key = ids + 1
        words = np.sign(key) * (np.abs(key) // prime)
        start = (key % prime * multiplier % prime + words % prime * high % prime + seed * step % prime) % prime
        square = start * start % prime
        unit = square * square % prime * start % prime / float(prime)
        return np.where(known, sum((unit >= b).astype(np.uint8) for b in bounds), 0).astype(np.uint8)

    def block(table: pa.Table) -> pa.RecordBatch:
        columns = [c.to_numpy() for c in table.columns[3:]]
        x = np.stack(columns).astype(np.float64) + 0.0  # no negative zero
        y = table.column(1).to_numpy().astype(np.float64)
        if np.isnan(x).any() or np.isnan(y).any():
            raise ValueError("missing feature values or labels: impute before training")
        ids, fold = table.column(0), table.column(2).to_numpy()
        known = ~np.asarray(ids.is_null().to_numpy(), bool)
        numbers = ids.fill_null(0).to_numpy().astype(np.int64)
        w = np.stack([drawn(numbers, known, s) for s in seeds])
        state = np.stack([np.where((w[s] > 0) & ((out < 0) | (fold != out)), t, -1) for t, (s, out) in enumerate(zip(sample_of, held_out))])
        return pa.RecordBatch.from_pydict({
            "n": pa.array([table.num_rows], pa.int32()), "x": pa.array([x.tobytes()], pa.binary()), "y": pa.array([y.astype(np.uint8).tobytes()], pa.binary()),
            "w": pa.array([w.tobytes()], pa.binary()), "state": pa.array([state.astype(np.int32).tobytes()], pa.binary())})

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, block_rows - rows)
                batch = batch.slice(part.num_rows)
                held.append(part)
                rows += part.num_rows
                if rows == block_rows:
                    yield block(pa.Table.from_batches(held))
                    held, rows = [], 0
        if rows:
            yield block(pa.Table.from_batches(held))
    return pack


def totaller(width: int, draws: int, sample_of: Sequence[int]):
    """Per tree its drawn rows and positives, and per feature its least and greatest value, as ``p, c, n, pos, lo, hi``."""
    read, trees = block_reader(width, draws, len(sample_of)), len(sample_of)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, pos = np.zeros(trees, np.int64), np.zeros(trees, np.int64)
        lo, hi = np.full(width, np.inf), np.full(width, -np.inf)
        for batch in batches:
            for x, y, w, state in read(batch):
                lo, hi = np.minimum(lo, x.min(1)), np.maximum(hi, x.max(1))
                for t, s in enumerate(sample_of):
                    mine = w[s].astype(np.int64) * (state[t] >= 0)
                    n[t] += mine.sum()
                    pos[t] += (mine * y).sum()
        yield pa.RecordBatch.from_pydict({
            "p": pa.array([*range(trees), *range(-1, -width - 1, -1)], pa.int64()), "c": pa.array(np.zeros(trees + width)),
            "n": pa.array(np.concatenate([n, np.zeros(width, np.int64)])), "pos": pa.array(np.concatenate([pos, np.zeros(width, np.int64)])),
            "lo": pa.array(np.concatenate([np.zeros(trees), lo])), "hi": pa.array(np.concatenate([np.zeros(trees), hi]))})
    return total


@dataclass
class Stage:
    """Ranges of values that one pass cuts into cells; ``codes`` are the cells of the stage before that they lie in."""

    mode: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    codes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def arrays(self) -> tuple:
        with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
            scale = np.where(self.mode == BY_VALUE, CELLS / (self.hi - self.lo), 0.0)
        first, last = sortable(self.lo), sortable(self.hi)
        width = (last - first).view(np.uint64) // np.uint64(CELLS) + np.uint64(1)
        return self.mode, self.lo, scale, first, width, self.codes


def sortable(v: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the doubles."""
    bits = np.ascontiguousarray(v, np.float64).view(np.int64)
    return bits ^ ((bits >> np.int64(63)) & np.int64(0x7FFFFFFFFFFFFFFF))


def cell_counter(width: int, draws: int, features: Sequence[Sequence[int]], sample_of: Sequence[int], first: int, base: np.ndarray,
                 stages: Sequence[Stage]):
    """Rows and positives per cell of the last stage, and the cell's least and greatest value, added up per task.

    ``base`` has the number of the first range (one a feature of the tree) of the open nodes from ``first`` on, or -1.
    """
    read, chain = block_reader(width, draws, len(sample_of)), [s.arrays() for s in stages]
    cells, most, exact, by_value, by_bits = CELLS, TASK_RECORDS, EXACT, BY_VALUE, BY_BITS
    last_node = first + len(base)

    def key(v):
        bits = np.ascontiguousarray(v, np.float64).view(np.int64)
        return bits ^ ((bits >> np.int64(63)) & np.int64(0x7FFFFFFFFFFFFFFF))

    def down(p, v, w, wy):
        c = v
        for k, (mode, lo, scale, least, span, codes) in enumerate(chain):
            if k:
                code = p * cells + c.astype(np.int64)
                at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
                kept = np.flatnonzero(codes[at] == code)
                p, v, w, wy = at[kept], v[kept], w[kept], wy[kept]
            how = mode[p]
            kept = np.flatnonzero(how == exact) if k == len(chain) - 1 else np.zeros(0, np.int64)
            kept = np.concatenate([kept, np.flatnonzero(how > exact)])
            if len(kept) < len(p):
                p, v, w, wy, how = p[kept], v[kept], w[kept], wy[kept], how[kept]
            c = v.copy()
            at = how == by_value
            if at.any():
                c[at] = np.clip(np.floor((v[at] - lo[p[at]]) * scale[p[at]]), 0, cells - 1)
            at = how == by_bits
            if at.any():
                c[at] = ((key(v[at]) - least[p[at]]).view(np.uint64) // span[p[at]]).astype(np.float64)
        return p, c, w, wy, v, v

    def added(parts):
        p, c, n, pos, lo, hi = (np.concatenate(columns) for columns in zip(*parts))
        if not len(p):
            return p, c, n, pos, lo, hi
        order = np.lexsort((c, p))
        p, c = p[order], c[order]
        cut = np.flatnonzero(np.concatenate([[True], (p[1:] != p[:-1]) | (c[1:] != c[:-1])]))
        return (p[cut], c[cut], np.add.reduceat(n[order], cut), np.add.reduceat(pos[order], cut),
                np.minimum.reduceat(lo[order], cut), np.maximum.reduceat(hi[order], cut))

    def batch_of(parts) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a) for a in parts], names=["p", "c", "n", "pos", "lo", "hi"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, records = [], 0
        for batch in batches:
            for x, y, w, state in read(batch):
                for t, s in enumerate(sample_of):
                    at = np.flatnonzero((state[t] >= first) & (state[t] < last_node))
                    start = base[state[t][at] - first]
                    at, start = at[start >= 0], start[start >= 0]
                    if not len(at):
                        continue
                    n = w[s][at].astype(np.int64)
                    pos = n * y[at]
                    held.append(added([down(start + j, x[f][at], n, pos) for j, f in enumerate(features[t])]))
                    records += len(held[-1][0])
                    if records > most:
                        held = [added(held)]
                        records = len(held[0][0])
                        if records > most // 2:
                            yield batch_of(held[0])
                            held, records = [], 0
        if held:
            yield batch_of(added(held))
    return count


def advancer(width: int, draws: int, trees: int, feature: np.ndarray, at: np.ndarray, category: np.ndarray, left: np.ndarray, right: np.ndarray):
    """Rows to the next states: through their node's split, or to ``left`` where the node has none."""
    read = block_reader(width, draws, trees)

    def advance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            states = []
            for x, _, _, state in read(batch):
                state = state.copy()
                for t in range(trees):
                    rows = np.flatnonzero(state[t] >= 0)
                    node = state[t][rows]
                    f = feature[node]
                    v = x[np.maximum(f, 0), rows]
                    goes = np.where(category[node], v == at[node], v <= at[node]) | (f < 0)
                    state[t][rows] = np.where(goes, left[node], right[node])
                states.append(state.tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(states, pa.binary())], names=batch.schema.names)
    return advance


def chained(*steps):
    """Several functions on batches as one, so that a task needs one Python worker for them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps:
            batches = step(batches)
        return batches
    return run


def chunker(width: int, draws: int, features: Sequence[Sequence[int]], sample_of: Sequence[int], part_of: np.ndarray):
    """The rows of the nodes that one task finishes, a chunk per block and node; ``part_of`` numbers such open nodes."""
    read = block_reader(width, draws, len(sample_of))

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y, w, state in read(batch):
                parts, sizes, xs, ys, ws = [], [], [], [], []
                for t, s in enumerate(sample_of):
                    now = state[t]
                    part = np.where(now <= -2, -2 - now, np.where(now >= 0, part_of[np.maximum(now, 0)], -1))
                    rows = np.flatnonzero(part >= 0)
                    rows = rows[np.argsort(part[rows], kind="stable")]
                    found, starts = np.unique(part[rows], return_index=True)
                    for k, mine in zip(found, np.split(rows, starts[1:]) if len(found) else []):
                        parts.append(k)
                        sizes.append(len(mine))
                        xs.append(x[np.ix_(list(features[t]), mine)].tobytes())
                        ys.append(y[mine].tobytes())
                        ws.append(w[s][mine].tobytes())
                if parts:
                    yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(sizes, pa.int32()), pa.array(xs, pa.binary()),
                                                      pa.array(ys, pa.binary()), pa.array(ws, pa.binary())], names=["part", "m", "x", "y", "w"])
    return chunks


def split_maths():
    """Gain of a split from counts, and the threshold between two neighbouring order statistics."""
    def impurity(n0, n1, entropy):
        n = n0 + n1
        with np.errstate(divide="ignore", invalid="ignore"):
            a, b = n0 / n, n1 / n
            gini = 1.0 - a * a - b * b
            bits = -(a * np.log2(a + 1e-10) + b * np.log2(b + 1e-10))
        return np.where(n > 0, np.where(entropy, bits, gini), 0.0)

    def gain(size, pos, left, left_pos, entropy):
        n0, l0, right = size - pos, left - left_pos, size - left
        inside = left / size * impurity(l0, left_pos, entropy)
        outside = right / size * impurity(n0 - l0, pos - left_pos, entropy)
        return impurity(n0, pos, entropy) - (inside + outside)

    def between(lo, hi, share):
        # Rows up to an interpolated threshold are the rows up to the value below it.
        with np.errstate(over="ignore", invalid="ignore"):
            at = lo + (hi - lo) * share
        return np.where((hi > lo) & ~(at < hi), lo, at)
    return gain, between


@dataclass(frozen=True)
class Rules:
    """What decides a tree's splits, as plain values."""

    features: tuple[int, ...]
    category: tuple[bool, ...]
    entropy: bool
    leaf: int
    least: int        # rows a node needs to split
    depth: int
    cut: int | None   # nodes of more rows become leaves below ``deep``
    deep: int


def node_grower(rules: Sequence[tuple], tree_of: np.ndarray, node_of: np.ndarray, depth_of: np.ndarray):
    """Finishes the nodes whose chunks arrive in order of ``part``: one row per node below and including them."""
    gain, between = split_maths()
    points = {k: np.array(qs) for k, qs in THRESHOLD_POINTS.items()}
    many, digits = MANY, GAIN_DIGITS

    def best(x, y, w, categories, entropy, leaf):
        size, pos = int(w.sum()), int((w * y).sum())
        found = None
        for j, v in enumerate(x):
            order = np.argsort(v, kind="stable")
            v, n, p = v[order], np.cumsum(w[order]), np.cumsum((w * y)[order])
            ends = np.flatnonzero(np.append(v[1:] != v[:-1], True))
            v, n, p = v[ends], n[ends], p[ends]
            if categories[j]:
                at, left, left_pos = v, np.diff(n, prepend=0), np.diff(p, prepend=0)
            else:
                if len(v) < 2:
                    continue
                place = (size - 1) * points[min(len(v), many)]
                low = np.searchsorted(n, np.floor(place), side="right")
                high = np.searchsorted(n, np.ceil(place), side="right")
                at, left, left_pos = between(v[low], v[high], place - np.floor(place)), n[low], p[low]
            g = gain(size, pos, left, left_pos, entropy)
            r = np.where((left >= leaf) & (size - left >= leaf), np.round(g, digits), 0.0)
            k = np.lexsort((at, -r))[0]
            if r[k] > (found[0] if found else 0.0):
                found = (r[k], j, float(at[k]), bool(categories[j]), float(g[k]), int(left[k]), int(left_pos[k]))
        return found

    def grow(part, x, y, w):
        features, categories, entropy, leaf, least, deepest, cut, deep = rules[tree_of[part]]
        todo = [(int(node_of[part]), int(depth_of[part]), np.arange(len(y)))]
        out = []
        while todo:
            node, depth, rows = todo.pop()
            n, pos = int(w[rows].sum()), int((w[rows] * y[rows]).sum())
            open_node = depth < deepest and n >= max(least, 2 * leaf) and 0 < pos < n and not (cut is not None and depth > deep and n > cut)
            split = best(x[:, rows], y[rows], w[rows], categories, entropy, leaf) if open_node else None
            if split is None:
                out.append((part, node, depth, n, pos, -1, 0.0, False, 0.0))
                continue
            _, j, at, category, g, _, _ = split
            out.append((part, node, depth, n, pos, features[j], at, category, g))
            goes = x[j, rows] == at if category else x[j, rows] <= at
            todo += [(2 * node + 1, depth + 1, rows[goes]), (2 * node + 2, depth + 1, rows[~goes])]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, chunks = None, []

        def finished():
            width = len(rules[tree_of[part]][0])
            x = np.concatenate([np.frombuffer(c[1], np.float64).reshape(width, c[0]) for c in chunks], axis=1)
            y, w = (np.concatenate([np.frombuffer(c[k], np.uint8) for c in chunks]).astype(np.int64) for k in (2, 3))
            kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.bool_(), pa.float64()]
            names = ["part", "node", "depth", "n", "n_pos", "feature", "at", "category", "gain"]
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*grow(part, x, y, w)), kinds)], names=names)

        for batch in batches:
            for k, m, x, y, w in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if part is not None and k != part:
                    yield finished()
                    chunks = []
                part = k
                chunks.append((m, x, y, w))
        if part is not None:
            yield finished()
    return run


def wanted_ranks(size: str) -> str:
    """SQL array of the zero-based ranks that thresholds are read at, for a number of rows."""
    places = [f"(({size} - 1) * {q!r}D)" for q in POINTS]
    return "array(" + ", ".join(f"floor({p}), ceil({p})" for p in places) + ")"


def numeric_candidates(size: np.ndarray, size_pos: np.ndarray, kinds: np.ndarray, slot: np.ndarray, value: np.ndarray,
                       before: np.ndarray, n: np.ndarray, before_pos: np.ndarray, pos: np.ndarray):
    """``slot, at, left, left_pos`` of every threshold tried, from the values found at the wanted ranks.

    ``size``, ``size_pos`` and ``kinds`` (distinct values, five at most) are per slot; the other arrays have one entry per
    value found: its slot, the rows before it and its own.
    """
    _, between = split_maths()
    step = int(size.max(initial=0)) + 1
    order = np.argsort(slot * step + before, kind="stable")
    slot, value, before, n, before_pos, pos = (a[order] for a in (slot, value, before, n, before_pos, pos))
    keys = slot * step + before
    out = []
    for k, qs in THRESHOLD_POINTS.items():
        mine = np.flatnonzero(kinds == k)
        for q in qs:
            place = (size[mine] - 1) * q
            low = np.searchsorted(keys, mine * step + np.floor(place).astype(np.int64), side="right") - 1
            high = np.searchsorted(keys, mine * step + np.ceil(place).astype(np.int64), side="right") - 1
            at = between(value[low], value[high], place - np.floor(place))
            out.append((mine, at, before[low] + n[low], before_pos[low] + pos[low]))
    return tuple(np.concatenate(c) for c in zip(*out))
