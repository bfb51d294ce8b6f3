"""Conversation repair: Hirschberg's divide and conquer over four states, spread over ranges of a conversation."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import grouped, joined_small, read_table, small_batches, stored
from .registry import query

# States: nothing yet, after the system turn, after a user turn, after an assistant turn (which may end).
STATES, ENDS = 4, (0, 3)
MOVES = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
NEXT_ROLE = ("u", "u", "a", "u")            # the role that an inserted or renamed turn takes in each state
NAMES = {"u": "user", "a": "assistant"}
RENAME, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
INITIALS, FAULTS = ("s", "u", "a", ""), ("", "truncated", "blank", "duplicate")
FAR = 1 << 40
_NULL_CONVERSATION = -(1 << 63)


def _step(state: int, role: str) -> int | None:
    return MOVES[role].get(state)


def _single(initial: str, fault: str) -> tuple[np.ndarray, list[list[str | None]]]:
    """Cheapest edits of one turn between two states, the ASCII-least of equally cheap ones; insertions stand before it."""
    cost, text = np.full((STATES, STATES), FAR, np.int64), [[None] * STATES for _ in range(STATES)]
    for start in range(STATES):
        state = start
        for inserted in range(STATES):
            options = [("D", DELETE, state)]
            if fault not in ("blank", "duplicate"):
                extra = TRUNCATED if fault == "truncated" else 0
                if initial and _step(state, initial) is not None:
                    options.append(("K", extra, _step(state, initial)))
                options.append(("R", RENAME + extra, _step(state, NEXT_ROLE[state])))
            for letter, price, to in options:
                now = (INSERT * inserted + price, "I" * inserted + letter)
                if text[start][to] is None or now < (int(cost[start][to]), text[start][to]):
                    cost[start][to], text[start][to] = now
            state = _step(state, NEXT_ROLE[state])
    return cost, text


def _ranked(text) -> np.ndarray:
    """Per start state, the order of the strings that lead to the end states."""
    out = np.zeros((STATES, STATES), np.int64)
    for p in range(STATES):
        order = sorted((q for q in range(STATES) if text[p][q] is not None), key=lambda q: text[p][q])
        for k, q in enumerate(order):
            out[p][q] = k
    return out


#: Per kind of turn (initial, fault): costs, edits and their order.
KINDS = [(i, f) for i in INITIALS for f in FAULTS]
COSTS, EDITS, ORDERS = [], [], []
for _kind in KINDS:
    _cost, _edits = _single(*_kind)
    COSTS.append(_cost.tolist())
    EDITS.append(_edits)
    ORDERS.append(_ranked(_edits).tolist())
REPEATED = KINDS.index(("", "duplicate"))
#: Edits that lead from each state to an end.
TAILS = ["", "II", "I", ""]


def forward(cost: list[int], order: list[int], kind: int) -> tuple[list[int], list[int]]:
    """Cost vector and order of the audits after one more turn.

    No audit that ends in a turn's edit is the beginning of another one over as many turns. So of two audits the one whose
    earlier part is smaller is smaller, and audits with one earlier part compare by their last edits: the order of the
    least audits per state is all that has to be carried on.
    """
    step, ranks = COSTS[kind], ORDERS[kind]
    best = []
    for q in range(STATES):
        price, first, last, of = FAR, 0, 0, -1
        for p in range(STATES):
            c = cost[p] + step[p][q]
            if c < price or (c == price and c < FAR and (order[p], ranks[p][q]) < (first, last)):
                price, first, last, of = c, order[p], ranks[p][q], p
        best.append((price, first, last, of))
    ranked = sorted(range(STATES), key=lambda q: best[q][1:3] if best[q][0] < FAR else (FAR, 0))
    out = [0] * STATES
    for k, q in enumerate(ranked):
        out[q] = k
    return [min(b[0], FAR) for b in best], out


def backward(cost: list[int], kind: int) -> list[int]:
    step = COSTS[kind]
    return [min(min(step[p][q] + cost[q] for q in range(STATES)), FAR) for p in range(STATES)]


def _only(state: int) -> list[int]:
    return [0 if q == state else FAR for q in range(STATES)]


def hirschberg(kinds, start: int, end: int) -> list[str]:
    """The least audit of the cheapest edits that lead from ``start`` to ``end``, one string per turn.

    A forward and a backward cost vector meet in the middle; of the optimal crossings the one whose first half has the
    least audit is taken, and both halves are solved alike. Besides the answer, two vectors are held at a time.
    """
    out: list[str] = []
    todo = [(0, len(kinds), start, end)]
    while todo:
        low, high, p, q = todo.pop()
        if high - low == 0:
            continue
        if high - low == 1:
            out.append(EDITS[kinds[low]][p][q])
            continue
        middle = (low + high) // 2
        cost, order = _only(p), [0] * STATES
        for k in range(low, middle):
            cost, order = forward(cost, order, kinds[k])
        rest = _only(q)
        for k in range(high - 1, middle - 1, -1):
            rest = backward(rest, kinds[k])
        at = min(range(STATES), key=lambda s: (cost[s] + rest[s], order[s]))
        todo.append((middle, high, at, q))
        todo.append((low, middle, p, at))
    return out


def summary(kinds) -> tuple[list[int], list[int]]:
    """Costs between all states over many turns, and per start state the order of the audits."""
    costs, orders = [], []
    for p in range(STATES):
        cost, order = _only(p), [0] * STATES
        for k in kinds:
            cost, order = forward(cost, order, k)
        costs += cost
        orders += order
    return costs, orders


def crossings(parts: list[tuple[list[int], list[int]]]) -> list[int]:
    """The states at the borders of a conversation's parts, 0 first: the optimal ones with the least audit."""
    cost, order, states = _only(0), [0] * STATES, []
    steps = []
    for costs, orders in parts:
        best = []
        for q in range(STATES):
            best.append(min((cost[p] + costs[p * STATES + q], order[p], orders[p * STATES + q], p) for p in range(STATES)))
        steps.append([b[3] for b in best])
        ranked = sorted(range(STATES), key=lambda q: best[q][1:3] if best[q][0] < FAR else (FAR, 0))
        cost, order = [min(b[0], FAR) for b in best], [ranked.index(q) for q in range(STATES)]
    state = min(range(STATES), key=lambda s: (cost[s] + INSERT * len(TAILS[s]), order[s]))
    states = [state]
    for origin in reversed(steps):
        state = origin[state]
        states.append(state)
    return states[::-1]


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, seq = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(np.arange(seq, seq + n, dtype=np.int64))],
                                         names=[*batch.schema.names, "part", "seq"])
        seq += n


def _runs(table) -> tuple[list[int], list[int], list[int]]:
    """Kinds of the turns with the copies after the first as one run each, the runs' lengths, and their rows."""
    kinds, lengths, rows = [], [], []
    for row, (initial, fault, copies) in enumerate(zip(*(table.column(c).to_pylist() for c in ("initial", "fault", "copies")))):
        kinds.append(KINDS.index((initial if initial in ("s", "u", "a") else "", fault)))
        lengths.append(1)
        rows.append(row)
        if copies > 1:
            kinds.append(REPEATED)
            lengths.append(copies - 1)
            rows.append(row)
    return kinds, lengths, rows


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[tuple, tuple] = {}
    out = []

    def batch():
        return pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int32()),
                                           pa.array([o[2][0] for o in out], pa.list_(pa.int64())), pa.array([o[2][1] for o in out], pa.list_(pa.int64()))],
                                          names=["conv", "part", "costs", "orders"])

    for (conv, part), table in grouped(batches, ["conv", "part"]):
        kinds, lengths, _ = _runs(table)
        # Further turns that must go cost alike in every state, and the order of the audits stays.
        more = DELETE * (sum(lengths) - len(lengths))
        short = tuple(kinds) if len(kinds) <= 16 else None
        if short in known:
            costs, orders = known[short]
        else:
            costs, orders = summary(kinds)
            if short is not None and len(known) < 50_000:
                known[short] = (costs, orders)
        out.append((conv, part, ([c + more if c < FAR else FAR for c in costs], orders)))
        if len(out) >= 4096:
            yield batch()
            out.clear()
    if out:
        yield batch()


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        conv, part, start, end, last = [], [], [], [], []
        for c, parts in zip(batch.column("conv").to_pylist(), batch.column("parts").to_pylist()):
            states = crossings([(p["costs"], p["orders"]) for p in parts])
            conv += [c] * len(parts)
            part += [p["part"] for p in parts]
            start += states[:-1]
            end += states[1:]
            last += [False] * (len(parts) - 1) + [True]
        yield pa.RecordBatch.from_arrays([pa.array(conv, pa.int64()), pa.array(part, pa.int32()), pa.array(start, pa.int32()), pa.array(end, pa.int32()),
                                          pa.array(last, pa.bool_())], names=["conv", "part", "start", "end", "last"])


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[tuple, list[str]] = {}
    for (conv, part), table in grouped(batches, ["conv", "part"]):
        kinds, lengths, rows = _runs(table)
        state, last = table.column("start")[0].as_py(), table.column("last")[0].as_py()
        end = table.column("end")[0].as_py()
        edits, states = [""] * table.num_rows, [0] * table.num_rows
        short = (state, end, *kinds) if len(kinds) <= 16 else None
        solution = known.get(short) or hirschberg(kinds, state, end)
        if short is not None and len(known) < 50_000:
            known[short] = solution
        for k, (row, length, edit) in enumerate(zip(rows, lengths, solution)):
            if k == 0 or rows[k - 1] != row:
                states[row] = state
            # In a run the insertions come as late as they can: a deletion is the smaller letter.
            edits[row] += "D" * (length - 1) + edit
            for letter in edit:
                if letter in "IR":
                    state = _step(state, NEXT_ROLE[state])
                elif letter == "K":
                    state = _step(state, KINDS[kinds[k]][0])
        if last:
            edits[-1] += TAILS[end]
        n = table.num_rows
        yield pa.RecordBatch.from_arrays([pa.array([conv] * n, pa.int64()), pa.array([part] * n, pa.int32()), table.column("seq").combine_chunks().cast(pa.int64()),
                                          pa.array(edits, pa.string()), pa.array(states, pa.int32())], names=["conv", "part", "seq", "edit", "state"])


def repair(df: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, part, seq, turn, role, text, copies, fault, edit, state``: the turns in order with the edits that repair them.

    Turns are in order of ``turn`` (nulls first), then role and text; equal turns are one row with a number of ``copies``.
    A turn's first fault is ``blank`` (nothing but white space), ``duplicate`` (role and text stand earlier) or ``truncated``
    (the last sign is none of ``.!?``); further copies are duplicates. The edits are the cheapest ones that leave role initials
    of the form ``(s?(ua)+)?``, the ASCII-least of those: Keep 0, Rerole 2, Delete 3 (the only one for blank and
    duplicate turns), Insert 2, and 1 more for a truncated turn that stays. ``edit`` has the letters of a row's copies in order,
    insertions before the turn they stand before (at the end after the last turn), ``state`` is the state before the row.

    Rows are dealt by range of (key, turn, role, text), so a very long conversation is spread over tasks. Every task sums
    its part of a conversation up in the costs between the four states and the order of their audits; the parts' few figures
    are chained to the crossings at the borders, and each part is solved between its crossings (``hirschberg``).

    Null roles and texts count as one space; null keys are one conversation (``conv`` is the smallest bigint); an empty
    table gives an empty result; other columns are ignored.
    """
    small_batches(df.sparkSession)
    space = F.lit(" ")
    rows = df.select(F.coalesce(F.col(key).cast("bigint"), F.lit(_NULL_CONVERSATION)).alias("conv"), F.col(turn).cast("bigint").alias("turn"),
                     F.coalesce(F.col(role).cast("string"), space).alias("role"), F.coalesce(F.col(text).cast("string"), space).alias("text"))
    order = ["conv", "turn", "role", "text"]
    merged = stored(rows.groupBy(*order).agg(F.count(F.lit(1)).alias("copies")).withColumns(
        {"h1": F.xxhash64("role", "text"), "h2": F.xxhash64("text", "role", F.lit(5))}))
    said = ["conv", "h1", "h2"]
    earliest = stored(merged.groupBy(*said).agg(F.min(F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))).alias("first"),
                                                F.count(F.lit(1)).alias("places")).where("places > 1").select(*said, F.col("first.turn").alias("first")))
    again = joined_small(merged, earliest.withColumn("repeated", F.lit(True)), said, "left")
    last = F.right(F.rtrim("text", F.lit(" \t\n\x0b\x0c\r")), F.lit(1))
    fault = F.when(last == "", "blank").when(F.expr("repeated AND NOT (turn <=> first)"), "duplicate").when(
        ~last.isin(".", "!", "?"), "truncated").otherwise("")
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kept = again.select(*order, "copies", fault.alias("fault")).repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    turns = stored(kept.mapInArrow(_placed, "conv bigint, turn bigint, role string, text string, copies bigint, fault string, part int, seq bigint"))
    narrow = turns.select("conv", "part", "seq", F.substring("role", 1, 1).alias("initial"), "fault", "copies")
    sums = narrow.repartition("conv", "part").sortWithinPartitions("conv", "part", "seq").mapInArrow(
        _summaries, "conv bigint, part int, costs array<bigint>, orders array<bigint>")
    # A conversation has one row per range at most.
    plans = stored(sums.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("part", "costs", "orders"))).alias("parts")).mapInArrow(
        _chained, "conv bigint, part int, start int, end int, last boolean"))
    edits = narrow.join(plans, ["conv", "part"]).repartition("conv", "part").sortWithinPartitions("conv", "part", "seq").mapInArrow(
        _edited, "conv bigint, part int, seq bigint, edit string, state int")
    # Every place has one row on either side, and a sort brings them together.
    nothing = {c: F.lit(None).cast(t) for c, t in (("turn", "bigint"), ("role", "string"), ("text", "string"), ("copies", "bigint"), ("fault", "string"))}
    sides = turns.withColumns({"edit": F.lit(None).cast("string"), "state": F.lit(None).cast("int")}).unionByName(edits.withColumns(nothing))
    return sides.repartition("conv", "part").sortWithinPartitions("conv", "part", "seq", F.col("edit").isNull()).mapInArrow(
        _together, "conv bigint, part int, seq bigint, turn bigint, role string, text string, copies bigint, fault string, edit string, state int")


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """An edit and, next, its turn become one row."""
    edit = state = None
    names = ["conv", "part", "seq", "turn", "role", "text", "copies", "fault"]
    for batch in batches:
        is_edit = batch.column("edit").is_valid().to_pylist()
        given, states = batch.column("edit").to_pylist(), batch.column("state").to_pylist()
        edits, before = [], []
        for k, edits_only in enumerate(is_edit):
            if edits_only:
                edit, state = given[k], states[k]
            else:
                edits.append(edit)
                before.append(state)
        turns = batch.filter(pa.array([not e for e in is_edit]))
        yield pa.RecordBatch.from_arrays([*[turns.column(c) for c in names], pa.array(edits, pa.string()), pa.array(before, pa.int32())], names=[*names, "edit", "state"])


def _lines(role: str, text: str, edit: str, state: int):
    """(role, text) of the turns that an edited row leaves."""
    for letter in edit:
        if letter == "K":
            state = _step(state, role[:1])
            yield role, text
        elif letter in "IR":
            name = NEXT_ROLE[state]
            state = _step(state, name)
            yield NAMES[name], text if letter == "R" else ""


def _turns_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv_now, number = None, 0
    for batch in batches:
        conv, numbers, roles, texts = [], [], [], []
        for c, role, text, edit, state in zip(*(batch.column(n).to_pylist() for n in ("conv", "role", "text", "edit", "state"))):
            if c != conv_now:
                conv_now, number = c, 0
            for name, said in _lines(role, text, edit, state):
                conv.append(c)
                numbers.append(number)
                roles.append(name)
                texts.append(said)
                number += 1
        yield pa.RecordBatch.from_arrays([pa.array(conv, pa.int64()), pa.array(numbers, pa.int64()), pa.array(roles, pa.string()), pa.array(texts, pa.string())],
                                         names=["conv", "turn", "role", "text"])


def repaired_turns(edits: DataFrame) -> DataFrame:
    """``conv, turn, role, text``: the conversations after the edits of ``repair``, turns numbered from 0.

    A task streams its conversations in order and holds one row at a time.
    """
    return edits.repartition("conv").sortWithinPartitions("conv", "part", "seq").mapInArrow(_turns_out, "conv bigint, turn bigint, role string, text string")


REPORT = ("conv bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string")
_LEGAL = {"su", "ua", "au"}


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    s, out = None, []

    def closed(s):
        gaps = s["high"] - s["low"] + 1 - s["distinct"] if s["distinct"] else 0
        return (s["conv"], gaps if gaps < 1 << 63 else None, s["blank"], s["duplicate"], s["truncated"], s["illegal"], s["cost"], "".join(s["audit"]), s["hash"].hexdigest())

    def batch(rows):
        kinds = [pa.int64()] * 7 + [pa.string()] * 2
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=[f.split()[0] for f in REPORT.split(", ")])

    for rows in batches:
        for conv, turn, role, text, copies, fault, edit, state in zip(
                *(rows.column(c).to_pylist() for c in ("conv", "turn", "role", "text", "copies", "fault", "edit", "state"))):
            if s is None or s["conv"] != conv:
                if s is not None:
                    out.append(closed(s))
                    if len(out) >= 2000:
                        yield batch(out)
                        out.clear()
                s = {"conv": conv, "low": 0, "high": 0, "distinct": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0,
                     "audit": [], "hash": hashlib.sha256(), "before": None, "lines": 0}
            if copies is None:  # marks a conversation that is to be reported
                continue
            if turn is not None and (not s["distinct"] or turn != s["high"]):
                s["low"] = turn if not s["distinct"] else s["low"]
                s["high"], s["distinct"] = turn, s["distinct"] + 1
            if fault:
                s[fault] += 1
            if copies > 1:
                s["blank" if fault == "blank" else "duplicate"] += copies - 1
            initial = role[:1]
            if s["before"] is not None and s["before"] + initial not in _LEGAL:
                s["illegal"] += 1
            if initial + initial not in _LEGAL:
                s["illegal"] += copies - 1
            s["before"] = initial
            s["audit"].append(edit)
            first = edit.lstrip("I")[0]
            s["cost"] += DELETE * edit.count("D") + INSERT * edit.count("I") + RENAME * edit.count("R") + (TRUNCATED if fault == "truncated" and first != "D" else 0)
            for name, said in _lines(role, text, edit, state):
                s["hash"].update(f"{chr(10) if s['lines'] else ''}{name}:{said}".encode())
                s["lines"] += 1
    if s is not None:
        out.append(closed(s))
    if out:
        yield batch(out)


def repair_report(edits: DataFrame, keys: DataFrame, key: str = "conv_id") -> DataFrame:
    """One row per conversation of ``keys`` (column ``key``): counts of faults, cost, audit and digest of the repaired turns.

    The digest is sequential, so a conversation is streamed through one task, which holds its audit and one batch of turns.
    Conversations without a turn left have zeros, an empty audit and the digest of nothing; a null key comes back as null;
    ``gaps`` is null beyond 64 bits.
    """
    marks = keys.select(F.coalesce(F.col(key).cast("bigint"), F.lit(_NULL_CONVERSATION)).alias("conv")).distinct()
    empty = {f: F.lit(None).cast(t) for f, t in (("part", "int"), ("seq", "bigint"), ("turn", "bigint"), ("role", "string"), ("text", "string"),
                                                 ("copies", "bigint"), ("fault", "string"), ("edit", "string"), ("state", "int"))}
    rows = edits.unionByName(marks.withColumns(empty)).repartition("conv").sortWithinPartitions("conv", "part", "seq")
    return rows.mapInArrow(_reports, REPORT).withColumn(key, F.expr(f"nullif(conv, {_NULL_CONVERSATION + 1} - 1)")).select(
        key, *[f.split()[0] for f in REPORT.split(", ")[1:]])


def damaged(df: DataFrame) -> DataFrame:
    """Conversations with faults set by a checksum of conversation and turn: dropped, emptied, unended, repeated, reroled."""
    place = "concat(coalesce(CAST(conv_id AS STRING), ' '), ':', coalesce(CAST(turn AS STRING), ' '))"
    rows = df.select("conv_id", "turn", F.expr("coalesce(role, ' ') AS role"), F.expr("coalesce(text, ' ') AS text"), F.expr(f"crc32({place}) % 20 AS kind"))
    return rows.where("kind <> 0").select(
        "conv_id", "turn", F.expr("CASE WHEN kind = 4 THEN 'user' ELSE role END").alias("role"),
        F.expr("CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '') ELSE text END").alias("text"),
        F.explode(F.expr("CASE WHEN kind = 3 THEN array(0, 1) ELSE array(0) END")).alias("copy")).drop("copy")


OP12_SQL = r"""
WITH RECURSIVE
given AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS place FROM conversations),
kinds AS (SELECT *, xor(list_reduce([4294967295] || list_transform(string_split(place, ''), lambda c: CAST(ascii(c) AS BIGINT)),
  lambda x, b: list_reduce([xor(x, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda r, z: xor(r >> 1, 3988292384 * (r & 1)))), 4294967295) % 20 AS kind FROM given),
damaged AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
  CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM kinds WHERE kind <> 0),
places AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n FROM damaged),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) AS seen FROM places),
turns AS (SELECT conv_id, n, turn, role, text, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY n) AS earlier,
  CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN seen > 1 THEN 'duplicate'
       WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault FROM numbered),
inserted AS (SELECT * FROM (VALUES (0, 0, 0, []), (0, 1, 2, ['user:']), (0, 2, 3, ['user:', 'assistant:']), (1, 0, 1, []), (1, 1, 2, ['user:']),
  (1, 2, 3, ['user:', 'assistant:']), (2, 0, 2, []), (2, 1, 3, ['assistant:']), (2, 2, 2, ['assistant:', 'user:']), (3, 0, 3, []), (3, 1, 2, ['user:']),
  (3, 2, 3, ['user:', 'assistant:'])) v(p, i, mid, new)),
moves AS (
  SELECT p, i, new, 'D' AS letter, mid AS q, NULL AS needs, NULL AS name FROM inserted
  UNION ALL SELECT p, i, new, 'R', CASE mid WHEN 2 THEN 3 ELSE 2 END, NULL, CASE mid WHEN 2 THEN 'assistant' ELSE 'user' END FROM inserted
  UNION ALL SELECT p, i, new, 'K', 1, 's', NULL FROM inserted WHERE mid = 0
  UNION ALL SELECT p, i, new, 'K', 2, 'u', NULL FROM inserted WHERE mid <> 2
  UNION ALL SELECT p, i, new, 'K', 3, 'a', NULL FROM inserted WHERE mid = 2),
convs AS (SELECT DISTINCT conv_id FROM conversations),
steps AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS n, 0 AS state, CAST(0 AS BIGINT) AS cost, '' AS audit, CAST([] AS VARCHAR[]) AS lines FROM convs
  UNION ALL
  SELECT conv_id, n, state, cost, audit, lines FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id, state ORDER BY cost, audit) AS place FROM (
      SELECT s.conv_id, s.n + 1 AS n, m.q AS state,
        s.cost + 2 * m.i + CASE m.letter WHEN 'D' THEN 3 WHEN 'R' THEN 2 ELSE 0 END + CASE WHEN t.fault = 'truncated' AND m.letter <> 'D' THEN 1 ELSE 0 END AS cost,
        s.audit || repeat('I', m.i) || m.letter AS audit,
        s.lines || m.new || CASE WHEN m.letter = 'D' THEN CAST([] AS VARCHAR[]) ELSE [coalesce(m.name, t.role) || ':' || t.text] END AS lines
      FROM steps s JOIN turns t ON t.conv_id IS NOT DISTINCT FROM s.conv_id AND t.n = s.n + 1
      JOIN moves m ON m.p = s.state AND (m.needs IS NULL OR m.needs = t.initial) AND (m.letter = 'D' OR t.fault NOT IN ('blank', 'duplicate')))) WHERE place = 1),
ends AS (SELECT conv_id, cost + CASE state WHEN 1 THEN 4 WHEN 2 THEN 2 ELSE 0 END AS cost, audit || CASE state WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END AS audit,
  lines || CASE state WHEN 1 THEN ['user:', 'assistant:'] WHEN 2 THEN ['assistant:'] ELSE CAST([] AS VARCHAR[]) END AS lines
  FROM steps s WHERE n = (SELECT count(*) FROM turns t WHERE t.conv_id IS NOT DISTINCT FROM s.conv_id)),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY cost, audit) AS place FROM ends) WHERE place = 1),
counts AS (SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
  count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (earlier IS NOT NULL AND earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM turns GROUP BY conv_id)
SELECT b.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate, coalesce(c.truncated, 0) AS truncated,
  coalesce(c.illegal, 0) AS illegal, b.cost, b.audit, sha256(array_to_string(b.lines, chr(10))) AS repaired_sha256
FROM best b LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM b.conv_id
"""


@query("op12_conversation_repair", OP12_SQL)
def op12_conversation_repair(spark, folder):
    chats = read_table(spark, folder, "conversations")
    return repair_report(repair(damaged(chats)), chats)
