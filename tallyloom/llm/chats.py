"""Chat formatting: budgeted, turn-aligned windows from prefix sums of turn tokens, with a loss mask."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import grouped, joined_small, read_table, stored
from .registry import query

BUDGET, HISTORY = 512, 128   # tokens of new turns per window, and of repeated ones
TOKENS = "size(split(trim(text), '[ \\\\t\\\\n\\\\r]+')) + 4"

# Control strings of the template, and of common chat templates that texts may hold.
TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"
CONTROLS = [TURN, SAYS, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>"]

_CONTROL = re.compile("|".join(re.escape(c) for c in CONTROLS))
_ESCAPE = re.compile(r"\\(.)", re.S)


def escaped(text: str) -> str:
    """Backslashes doubled and a backslash set inside every control string, so that none is left."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescaped(text: str) -> str:
    return _ESCAPE.sub(r"\1", text)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted window."""
    turns = []
    for part in formatted.split(TURN)[1:]:
        role, _, text = part.partition(SAYS)
        turns.append((unescaped(role), unescaped(text.removesuffix(END))))
    return turns


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens and turns of the conversation before each row, as far as this task holds it; rows come in order."""
    part, conv, tokens, turns = TaskContext.get().partitionId(), None, 0, 0
    for batch in batches:
        before, number = [], []
        for c, n in zip(batch.column("conv").to_pylist(), batch.column("tokens").to_pylist()):
            if c != conv:
                conv, tokens, turns = c, 0, 0
            before.append(tokens)
            number.append(turns)
            tokens, turns = tokens + n, turns + 1
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([part] * len(before), pa.int32()), pa.array(before, pa.int64()), pa.array(number, pa.int64())],
            names=[*batch.schema.names, "part", "before", "number"])


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The turns of each window, in order, to one text with the spans of code points that carry loss."""
    for (conv, window), table in grouped(batches, ["conv", "window"]):
        out, at, spans, repeated = [], 0, [], 0
        for role, text, again in zip(table.column("role").to_pylist(), table.column("text").to_pylist(), table.column("again").to_pylist()):
            head, body = TURN + escaped(role) + SAYS, escaped(text)
            if role == "assistant" and not again:
                spans.append({"start": at + len(head), "end": at + len(head) + len(body)})
            repeated += again
            out.append(head + body + END)
            at += len(out[-1])
        yield pa.RecordBatch.from_arrays(
            [pa.array([conv], pa.int64()), pa.array([window], pa.int64()), pa.array([repeated], pa.int64()), pa.array(["".join(out)], pa.string()),
             pa.array([spans], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))],
            names=["conv", "window", "repeated", "formatted", "loss"])


_NULL_CONVERSATION = -(1 << 63)


def format_chats(df: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", tokens: str = TOKENS,
                 budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """``key, window, repeated, formatted, loss``: the training windows of every conversation, in order of ``window``.

    Turns are in order of ``turn``, ties by role and text. A window has at most ``budget`` tokens (a SQL expression over
    ``text``) with everything in it, unless it is a single turn that is longer by itself. Prefix sums of the turns' tokens
    choose the windows: the budget less the system turn and the history is the room of a window, a turn belongs to the
    stretch of so many tokens in which it begins, and a turn that ends beyond its stretch is a window of its own. So
    windows are aligned to turns, a turn is never cut, and no window waits for an earlier one.

    Every later window begins with the conversation's system turn (its first turn, if its role is ``system``), unless the
    two do not fit together, and then the last turns before it that begin within ``history`` tokens and fit the budget:
    these ``repeated`` turns are masked. ``loss`` has the spans of the assistant's texts that are new, so each is a target once.

    The template is ``<|turn|>role<|says|>text<|end|>``; control strings in roles and texts are escaped reversibly.

    Rows are dealt by range of (key, turn), so a very long conversation is spread over tasks: each task sums its own turns,
    and only the conversations that cross a range border (one per border at most) get an offset. Windows are built one by one.

    Null roles and texts count as empty; null turns come first; rows with a null key are one conversation (whose key is null);
    repeated rows are turns of their own; an empty table gives an empty result; other columns are ignored.
    """
    rows = df.select(F.coalesce(F.col(key).cast("bigint"), F.lit(_NULL_CONVERSATION)).alias("conv"), F.col(turn).cast("bigint").alias("turn"),
                     F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("tokens", F.expr(f"CAST({tokens} AS BIGINT)"))
    order = ["conv", "turn", "role", "text"]
    spark = df.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    summed = stored(rows.repartitionByRange(ranges, "conv", "turn").sortWithinPartitions(*order).mapInArrow(
        _running, "conv bigint, turn bigint, role string, text string, tokens bigint, part int, before bigint, number bigint"))
    parts = summed.groupBy("conv", "part").agg(F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("n"))
    crossing = parts.groupBy("conv").agg(F.count(F.lit(1)).alias("parts")).where("parts > 1").select("conv")
    earlier = "OVER (PARTITION BY conv ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    # At most one conversation crosses each range border: bounded by the number of ranges.
    offsets = stored(parts.join(F.broadcast(crossing), "conv").withColumns({"t0": F.expr(f"sum(t) {earlier}"), "n0": F.expr(f"sum(n) {earlier}")}).where(
        "t0 IS NOT NULL").select("conv", "part", "t0", "n0"))
    placed = summed.join(F.broadcast(offsets), ["conv", "part"], "left").select(
        "conv", "role", "text", "tokens", F.expr("before + coalesce(t0, 0)").alias("before"), F.expr("number + coalesce(n0, 0)").alias("number"))
    system = "(number = 0 AND role = 'system')"
    # A system turn that fills a budget by itself cannot be retained.
    systems = stored(placed.where(f"{system} AND tokens < {budget}").select("conv", F.col("tokens").alias("s")))
    room = f"greatest({budget} - {history} - s, 1)"
    placed = joined_small(placed, systems, "conv", "left").withColumn("s", F.expr("coalesce(s, 0)")).withColumn(
        "window", F.expr(f"2 * (before DIV {room}) + CASE WHEN before % {room} + tokens > {room} THEN 1 ELSE 0 END"))
    starts = placed.groupBy("conv", "window").agg(F.min("before").alias("start"), F.sum("tokens").alias("new"), F.first("s").alias("s")).withColumn(
        "retains", F.expr(f"start > 0 AND s > 0 AND s + new <= {budget}"))
    free = f"CASE WHEN start = 0 OR (s > 0 AND NOT retains) THEN 0 ELSE greatest(least({budget} - new - s, {history}), 0) END"
    starts = stored(starts.withColumn("free", F.expr(free)).select("conv", "window", "start", "retains", "free"))
    # Windows that a turn is repeated in begin within the history behind it: in its own stretch of that length or the next.
    step = max(history, 1)
    begun = starts.where("free > 0").select("conv", F.col("window").alias("later"), "start", "free", F.expr(f"start DIV {step}").alias("stretch"))
    again = placed.where(f"NOT {system}").select("conv", "number", "before", F.explode(F.expr(
        f"array(before DIV {step}, before DIV {step} + 1)")).alias("stretch")).join(begun, ["conv", "stretch"]).where(
        "start > before AND start - before <= free").groupBy("conv", "number").agg(F.collect_list("later").alias("later"))
    seats = placed.join(again, ["conv", "number"], "left").withColumn("seat", F.explode(F.expr(
        "concat(array(struct(window, 0 AS again)), transform(coalesce(later, CAST(array() AS ARRAY<BIGINT>)), w -> struct(w AS window, 1 AS again)))"))).select(
        "conv", "seat.window", "seat.again", "number", "role", "text")
    first = placed.where(system).select("conv", "number", "role", "text")
    retained = starts.where("retains").select("conv", "window").join(first, "conv").select("conv", "window", F.lit(1).alias("again"), "number", "role", "text")
    turns = seats.unionByName(retained).repartition("conv", "window").sortWithinPartitions("conv", "window", "number")
    done = turns.mapInArrow(_format, "conv bigint, window bigint, repeated bigint, formatted string, loss array<struct<start: int, end: int>>")
    return done.select(F.expr(f"nullif(conv, {_NULL_CONVERSATION + 1} - 1)").alias(key), "window", "repeated", "formatted", "loss")


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of a conversation's turns and masked texts from its windows, which come in order; one window in memory at once."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_windows"]
    state = None

    def row(s):
        return pa.RecordBatch.from_arrays([pa.array([x]) if not isinstance(x, int) and x is not None else pa.array([x], pa.int64()) for x in (
            s["conv"], s["turns"], s["all"].hexdigest(), s["loss"], s["masked"].hexdigest(), s["chars"], s["windows"])], names=names)

    for batch in batches:
        for conv, repeated, formatted, loss in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "repeated", "formatted", "loss"))):
            if state is None or state["conv"] != conv:
                if state is not None:
                    yield row(state)
                state = {"conv": conv, "turns": 0, "all": hashlib.sha256(), "loss": 0, "masked": hashlib.sha256(), "chars": 0, "windows": 0}
            for role, text in read_turns(formatted)[repeated:]:
                state["turns"] += 1
                state["all"].update(f"{role}\n{text}\n".encode())
            for span in loss:
                text = unescaped(formatted[span["start"]:span["end"]])
                state["loss"] += len(text)
                state["masked"].update(text.encode())
            state["chars"] += len(formatted)
            state["windows"] += 1
    if state is not None:
        yield row(state)


def read_back(windows: DataFrame) -> DataFrame:
    """One row per ``conv_id`` of formatted windows, read back from their text and mask."""
    return windows.repartition("conv_id").sortWithinPartitions("conv_id", "window").mapInArrow(
        _read_back, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, n_windows bigint")


def _with_marked_conversation(spark: SparkSession, folder: str) -> DataFrame:
    said = "'</s>[INST] ok [/INST]' AS text"
    extra = spark.range(1).selectExpr(f"inline(array(struct(-1L AS conv_id, 0L AS turn, 'user' AS role, {said}), "
                                      f"struct(-1L AS conv_id, 1L AS turn, 'assistant' AS role, {said})))")
    return read_table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)


@query("op9_chat_formatting")
def op9_chat_formatting(spark, folder):
    return read_back(format_chats(_with_marked_conversation(spark, folder)))
