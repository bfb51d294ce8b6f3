"""Byte-level BPE: the merges of the rank file replayed over distinct words through an index of pairs, then looked up."""

from __future__ import annotations

import base64
import heapq
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read_table, small_batches, stored
from .registry import query

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
HELD_WORDS, HELD_BYTES = 1 << 18, 64   # words every task looks up in memory, and their greatest length
SLAB_BYTES = 1 << 18                   # bytes of words whose merges are replayed together
TEXT_CHARS = 1 << 22                   # characters of texts that are looked up together
TASK_WORDS = 200_000                   # words a task counts before it passes the counts on
WORDS_AT_ONCE = 50_000


def load_ranks(path: str = RANKS) -> dict[bytes, int]:
    """Token bytes to rank (which is the id), read on the driver; the file is bounded and travels as a broadcast."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _first_pairs(data: bytes, sizes: list[int], ranks: dict[bytes, int]) -> np.ndarray:
    """Rank of the two bytes at each position of the buffer, -1 where they are no token or not of one word."""
    table = np.full(1 << 16, -1, np.int64)
    for token, rank in ranks.items():
        if len(token) == 2:
            table[token[0] << 8 | token[1]] = rank
    codes = np.frombuffer(data, np.uint8).astype(np.int64)
    pair = np.full(len(data), -1, np.int64)
    pair[:-1] = table[codes[:-1] << 8 | codes[1:]]
    stops = np.cumsum(sizes)
    pair[stops[stops > 0] - 1] = -1
    return pair


def replay(words: list[bytes], ranks: dict[bytes, int]) -> list[list[int]]:
    """Token ids of every word: all words' merges at once, in rank order.

    The words stand one after another in one buffer. An index maps the rank that a pair of neighbouring tokens would merge
    to onto the positions of such pairs; the least rank of the index is taken next and applied at all its positions from
    left to right, and only the pairs on both sides of a merge are looked up and indexed anew. A merge that makes a pair of a
    still smaller rank holds the rest of its word back until that pair is merged, so each word gets its own least
    pair, leftmost first. A word that is itself a token is that token.
    """
    todo = [w for w in words if w and w not in ranks]
    if not todo:
        return [[ranks[w]] if w else [] for w in words]
    data, sizes = b"".join(todo), [len(w) for w in todo]
    n, stops = len(data), np.cumsum(sizes)
    firsts = stops - sizes
    before = np.arange(-1, n - 1)
    before[firsts] = -1
    first_pairs = _first_pairs(data, sizes, ranks)
    at = np.flatnonzero(first_pairs >= 0)
    at = at[np.argsort(first_pairs[at], kind="stable")]
    found, cuts = np.unique(first_pairs[at], return_index=True)
    index = {rank: part.tolist() for rank, part in zip(found.tolist(), np.split(at, cuts[1:]))} if len(found) else {}
    heap = list(index)
    ends, before, pair, limit = list(range(1, n + 1)), before.tolist(), first_pairs.tolist(), np.repeat(stops, sizes).tolist()
    look, push = ranks.get, heapq.heappush
    while heap:
        rank = heapq.heappop(heap)
        waiting, held = [], set()
        for k in sorted(index.pop(rank)):
            if pair[k] != rank:
                continue
            if held and limit[k] in held:
                waiting.append(k)
                continue
            gone = ends[k]
            end = ends[k] = ends[gone]
            pair[k] = pair[gone] = -1
            if end < limit[k]:
                before[end] = k
                sides = ((k, ends[end]), (before[k], end))
            else:
                sides = ((before[k], end),)
            for start, stop in sides:
                if start < 0:
                    continue
                made = look(data[start:stop], -1)
                pair[start] = made
                if made < 0:
                    continue
                places = index.get(made)
                if places is None:
                    index[made] = [start]
                    push(heap, made)
                else:
                    places.append(start)
                if made < rank:
                    held.add(limit[k])
        if waiting:
            index[rank] = waiting
            push(heap, rank)
    done = {}
    for word, start, stop in zip(todo, firsts.tolist(), stops.tolist()):
        ids = []
        while start < stop:
            end = ends[start]
            ids.append(ranks[data[start:end]])
            start = end
        done[word] = ids
    return [done[w] if w in done else [ranks[w]] if w else [] for w in words]


def replayed(words: list[bytes], ranks: dict[bytes, int]) -> Iterator[list[int]]:
    """``replay`` slab by slab; a word longer than a slab stands alone."""
    first = 0
    while first < len(words):
        last, size = first, 0
        while last < len(words) and (last == first or size + len(words[last]) <= SLAB_BYTES):
            size += len(words[last])
            last += 1
        yield from replay(words[first:last], ranks)
        first = last


#: Below the first of these code points, and the second, texts are split with plain character classes.
NARROW = (0x250, 0x10000)
_CLASSES = re.compile(r"\[(\^?)([^\[\]\\]*(?:\\(?:s|p\{[LN]\})[^\[\]\\]*)*)\]|\\p\{[LN]\}|\\[sS]")


def _members(kind: str, limit: int) -> str:
    """The code points below ``limit`` that match ``kind``, written as ranges of a character class."""
    matches = regex.compile(kind).match
    inside = [c for c in range(limit) if not 0xD800 <= c < 0xE000 and matches(chr(c))]
    cuts = [k for k in range(1, len(inside)) if inside[k] != inside[k - 1] + 1]
    return "".join(f"{re.escape(chr(inside[a]))}-{re.escape(chr(inside[b - 1]))}" for a, b in zip([0, *cuts], [*cuts, len(inside)]))


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """Finds all matches of ``pattern`` in a text.

    Where Unicode classes are written out as the code points of the alphabets at hand, the same matches are found in less
    time; a text beyond them, or a pattern with other classes than space, letter and number, takes the pattern as it is.
    """
    whole = regex.compile(pattern).findall
    rest = _CLASSES.sub("", pattern)
    if "\\" in rest or "[" in rest:
        return whole
    tiers = []
    for limit in NARROW:
        classes = {kind: _members(kind, limit) for kind in (r"\s", r"\p{L}", r"\p{N}")}

        def written(match, classes=classes):
            if match[0][0] == "[":
                return f"[{match[1]}" + re.sub(r"\\s|\\p\{[LN]\}", lambda k: classes[k[0]], match[2]) + "]"
            return f"[^{classes[chr(92) + 's']}]" if match[0] == r"\S" else f"[{classes[match[0]]}]"

        tiers.append((re.compile(f"[{chr(limit)}-\U0010ffff]").search, re.compile(_CLASSES.sub(written, pattern)).findall))

    def split(text: str) -> list[str]:
        for beyond, find in tiers:
            if not beyond(text):
                return find(text)
        return whole(text)
    return split


def _counter(pattern: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, split = Counter(), splitter(pattern)

        def out():
            words, counts = list(found), list(found.values())
            for k in range(0, len(words), WORDS_AT_ONCE):
                yield pa.RecordBatch.from_arrays([pa.array(words[k:k + WORDS_AT_ONCE], pa.string()), pa.array(counts[k:k + WORDS_AT_ONCE], pa.int64())], names=["word", "n"])
            found.clear()

        for batch in batches:
            for text in batch.column("text"):
                found.update(split(text.as_py() or ""))
                if len(found) > TASK_WORDS:
                    yield from out()
        yield from out()
    return count


def _replayer(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = list(replayed([w.as_py().encode() for w in batch.column("word")], shared.value))
            yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(ids, pa.list_(pa.int32()))], names=["word", "ids"])
    return run


class _Numbers(dict):
    """Numbers of the held words; further words get the next numbers."""

    def __init__(self, held):
        super().__init__(held)
        self.others: dict[str, int] = {}

    def __missing__(self, word):
        return self.others.setdefault(word, len(self) + len(self.others))


def _flattened(lists: list) -> tuple[np.ndarray, np.ndarray]:
    """Ids one after another, and the place where each list begins, with the end."""
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter((i for ids in lists for i in ids), np.int32, int(sizes.sum())), np.concatenate([[0], np.cumsum(sizes)])


def _encoder(pattern: str, ranks, held):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, words, (ids, begins) = splitter(pattern), held.value, (np.zeros(0, np.int32), np.zeros(1, np.int64))
        if words:
            ids, begins = _flattened(list(words.values()))
        numbers = _Numbers(zip(words, range(len(words))))
        keys, codes, size = [], [], 0

        def out():
            others = replayed([w.encode() for w in numbers.others], ranks.value)
            more, after = _flattened(list(others))
            numbers.others = {}
            all_ids, places = np.concatenate([ids, more]), np.concatenate([begins, begins[-1] + after[1:]])
            flat = np.concatenate(codes)
            starts, lengths = places[flat], places[flat + 1] - places[flat]
            stops = np.concatenate([[0], np.cumsum(lengths)])
            got = all_ids[np.repeat(starts - stops[:-1], lengths) + np.arange(stops[-1])]
            ends = stops[np.concatenate([[0], np.cumsum([len(c) for c in codes])])]
            column = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(got))
            return pa.RecordBatch.from_arrays([pa.concat_arrays(keys), column], names=["key", "ids"])

        for batch in batches:
            for k, value in enumerate(batch.column("text")):
                text = value.as_py() or ""
                if codes and size + len(text) > TEXT_CHARS:
                    yield out()
                    keys, codes, size = [], [], 0
                found = split(text)
                codes.append(np.fromiter(map(numbers.__getitem__, found), np.int64, len(found)))
                keys.append(batch.column("key").slice(k, 1))
                size += len(text)
        if codes:
            yield out()
    return encode


def _least_class(counted: DataFrame, most: int) -> int:
    """Least logarithm class of a word's count such that at most ``most`` words are of it or above."""
    total, least = 0, 1 << 30
    for row in sorted(counted.groupBy("class").agg(F.count(F.lit(1)).alias("words")).collect(), key=lambda r: -r["class"]):
        total += row["words"]
        if total > most:
            break
        least = row["class"]
    return least


def held_words(rows: DataFrame, ranks, pattern: str, most: int) -> dict[str, tuple[int, ...]]:
    """The corpus's most frequent distinct words with their ids: at most ``most`` words of at most ``HELD_BYTES`` bytes."""
    counted = rows.select("text").mapInArrow(_counter(pattern), "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    counted = stored(counted.where(f"n > 1 AND octet_length(word) <= {HELD_BYTES}").selectExpr("word", "CAST(floor(log2(n) * 8) AS INT) AS class"))
    least = _least_class(counted, most)
    held = counted.where(F.col("class") >= least).select("word").mapInArrow(_replayer(ranks), "word string, ids array<int>").toArrow()
    return {w: tuple(i) for w, i in zip(held.column("word").to_pylist(), held.column("ids").to_pylist())}


def encode(df: DataFrame, key: str = "doc_id", text: str = "text", ranks: str | dict[bytes, int] = RANKS, pattern: str = public_tokenizers.PATTERN,
           held: int = HELD_WORDS) -> DataFrame:
    """``key, ids`` of every row: the ids of its whole text, each match of ``pattern`` (a word) encoded separately.

    One pass counts the corpus's distinct words, combined per task. The merges of the most frequent ones, at most ``held``
    of at most ``HELD_BYTES`` bytes, are replayed on the cluster (``replay``), and every task holds their ids: the
    broadcast is bounded. A second pass looks the texts' words up; the distinct words of a task's texts that are not held
    are replayed there, many texts' words at once. So a word in many texts is replayed once, a rare one where it stands,
    and no text and no place of a word is shuffled. ``held`` is a matter of speed only.

    A null or empty text has no ids. Null or repeated keys are rows of their own; an empty table gives an empty result;
    other columns are ignored. Very long words are replayed alone. Characters assigned after the Unicode version of another
    implementation's tables may be split otherwise there.
    """
    spark = df.sparkSession
    small_batches(spark)
    ranks = spark.sparkContext.broadcast(load_ranks(ranks) if isinstance(ranks, str) else ranks)
    rows = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    known = spark.sparkContext.broadcast(held_words(rows, ranks, pattern, held) if held else {})
    out = rows.mapInArrow(_encoder(pattern, ranks, known), f"key {dict(rows.dtypes)['key']}, ids array<int>")
    return out.select(F.col("key").alias(key), "ids")


def _decoder(shared):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pa.array(shared.value, pa.large_binary())
        for batch in batches:
            ids = batch.column("ids")
            found = pieces.take(ids.flatten())
            if found.null_count:
                raise ValueError("an id without a token")
            # The taken pieces lie one after another: a text's bytes run from its first piece to the next text's.
            _, places, data = found.buffers()
            places = np.frombuffer(places, np.int64)[found.offset:found.offset + len(found) + 1] if len(found) else np.zeros(1, np.int64)
            counts = np.concatenate([[0], np.cumsum(np.nan_to_num(ids.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64))])
            joined = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(places[counts].tobytes()), data])
            if ids.null_count:
                joined = pa.compute.if_else(ids.is_valid(), joined, None)
            yield pa.RecordBatch.from_arrays([*batch.columns, joined.cast(pa.binary())], names=[*batch.schema.names, "bytes"])
    return decode


def decode(df: DataFrame, key: str = "doc_id", ids: str = "ids", ranks: str | dict[bytes, int] = RANKS) -> DataFrame:
    """``key, ids, bytes``: the bytes of every row's ids; null ids give null bytes, an id without a token is an error."""
    spark = df.sparkSession
    small_batches(spark)
    ranks = load_ranks(ranks) if isinstance(ranks, str) else ranks
    pieces = [None] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        pieces[rank] = token
    rows = df.select(F.col(key).alias("key"), F.col(ids).alias("ids"))
    out = rows.mapInArrow(_decoder(spark.sparkContext.broadcast(pieces)), f"key {dict(rows.dtypes)['key']}, ids array<int>, bytes binary")
    return out.select(F.col("key").alias(key), F.col("ids").alias(ids), "bytes")


@query("op13_byte_bpe")
def op13_byte_bpe(spark, folder):
    back = decode(encode(read_table(spark, folder, "documents")))
    return back.select("doc_id", F.expr("CAST(size(ids) AS BIGINT) AS n_tokens"), F.expr("sha2(array_join(ids, ','), 256) AS ids_sha256"),
                       F.expr("sha2(bytes, 256) AS decoded_sha256"))
