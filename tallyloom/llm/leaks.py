"""Benchmark decontamination: passages with enough of an item's words, in the order of their latent cosine, then subsequence and answer checks."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import read_table, spans_of, small_batches, stored, text_slices, hashed_spans, _LOWER
from .registry import query

BLOCK = 8                   # words per block; windows are runs of blocks
TERMS = 1 << 15             # most columns of the term matrix; a larger benchmark vocabulary shares columns
RANK, SPARE, ROUNDS = 256, 8, 2
COMMON = 192                # terms that a passage's row holds densely
PAIRS = 1 << 22             # pairs of the other terms that are counted at once
ITEM_WEIGHT = 10.0
SURE, LIKELY, ANSWER = 0.8, 0.6, 0.8   # shares of an item's and its answer's words found in order
SPARE_WORDS = 0.15          # share of an item's words that is looked up beyond those that a leak may lack
ITEMS_AT_ONCE = 256
SHORT = 8                   # items of fewer words must stand in a text word for word

GRAM = "term int, columns binary, sums binary"

_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True


@dataclass
class Item:
    number: int
    words: list[int]
    masks: dict[int, int]
    answer: list[int]
    answer_masks: dict[int, int]


def words_of(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (runs of letters, digits and non-ASCII characters), first word of every row plus the total."""
    low = _LOWER[data]
    starts, ends = spans_of(_WORD[data], rows)
    return hashed_spans(low, starts, ends), np.searchsorted(starts, rows)


def masks_of(words: list[int]) -> dict[int, int]:
    masks: dict[int, int] = {}
    for i, w in enumerate(words):
        masks[w] = masks.get(w, 0) | 1 << i
    return masks


def common_subsequence(masks: dict[int, int], n: int, words: list[int]) -> int:
    """Length of the longest common subsequence with a sequence of ``n`` words given by its position masks (bit-parallel)."""
    full = (1 << n) - 1
    s = full
    for w in words:
        m = masks.get(w)
        if m:
            u = s & m
            s = ((s + u) | (s - u)) & full
    return n - s.bit_count()


def hashed_texts(texts: list[str]) -> list[list[int]]:
    out = []
    for _, _, data, rows in text_slices(pa.array(texts, pa.large_string())):
        words, firsts = words_of(data, rows)
        out += [words[a:b].tolist() for a, b in zip(firsts[:-1], firsts[1:])]
    return out


def items_of(rows: list[tuple[int, str, str | None]]) -> list[Item]:
    """Items with their words; an item without an answer takes its last sentence."""
    texts, answers = [], []
    for _, text, answer in rows:
        sentences = [s for s in re.split(r"[.!?\n]+", text) if s.strip()]
        texts.append(text)
        answers.append(answer if answer is not None else (sentences[-1] if sentences else ""))
    return [Item(number, words, masks_of(words), answer, masks_of(answer))
            for (number, _, _), words, answer in zip(rows, hashed_texts(texts), hashed_texts(answers)) if words]


def contained(item: Item, region: list[int]) -> float | None:
    """Share of the item's words that stand in ``region`` in order, or None when the checks do not count it as a leak."""
    n = len(item.words)
    if n < SHORT:
        return 1.0 if any(region[k:k + n] == item.words for k in range(len(region) - n + 1)) else None
    share = common_subsequence(item.masks, n, region) / n
    if share >= SURE:
        return share
    if share >= LIKELY and item.answer:
        told = common_subsequence(item.answer_masks, len(item.answer), region) / len(item.answer)
        return share if told >= ANSWER else None
    return None


def width_of(n: int) -> int:
    """Window of an item of ``n`` words: the next power of two from two blocks on."""
    width = 2 * BLOCK
    while width < n:
        width *= 2
    return width


class Space:
    """Vocabulary of the items, idf weights of all documents, right singular vectors, and the items in latent space."""

    def __init__(self, items: list[Item]):
        self.items = items
        self.vocabulary = np.unique(np.array([w for i in items for w in i.words], np.uint64))
        self.columns = min(len(self.vocabulary), TERMS)
        # Hashes are even: by their leading bits a word's place is found to a few steps.
        self.shift = np.uint64(64 - max(1, (8 * len(self.vocabulary)).bit_length()))
        lead = self.vocabulary >> self.shift
        self.places = np.searchsorted(lead, np.arange((1 << 64 - int(self.shift)) + 1, dtype=np.uint64)).astype(np.int32)
        self.steps = int(np.diff(self.places).max(initial=0))
        self.idf = np.ones(self.columns)
        self.vectors = np.zeros((self.columns, 0), np.float32)

    def numbers(self, words: np.ndarray) -> np.ndarray:
        """Number of every word in the vocabulary, -1 outside."""
        at = np.minimum(self.places[words >> self.shift], len(self.vocabulary) - 1)
        for _ in range(self.steps - 1):
            at = np.minimum(at + (self.vocabulary[at] < words), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == words, at, -1).astype(np.int64)

    def terms(self, words: np.ndarray) -> np.ndarray:
        """Column of every word, -1 outside the vocabulary."""
        at = self.numbers(words)
        return np.where(at >= 0, at % self.columns, -1)

    def weigh(self, counts: dict[int, int], n_docs: int) -> None:
        df = np.zeros(self.columns)
        for term, count in counts.items():
            df[term] = count
        self.idf = np.log((n_docs + 1) / (df + 1)) + 0.05

    def item_rows(self) -> np.ndarray:
        rows = np.zeros((len(self.items), self.columns), np.float32)
        for r, item in enumerate(self.items):
            rows[r, self.terms(np.array(item.words, np.uint64))] = 1
        return rows * self.idf.astype(np.float32)

    def project(self, vectors: np.ndarray) -> None:
        self.vectors = vectors.astype(np.float32)
        self.latent = self.item_rows() @ self.vectors
        self.norms = np.linalg.norm(self.latent, axis=1) + 1e-12
        self.weighted = self.vectors * self.idf[:, None].astype(np.float32)

    def index(self) -> None:
        """Postings of the items' rarest words, by width.

        ``contained`` accepts no region with fewer than ``least`` of an item's n words, so of any p of them a region has at
        least p - (n - least). The p rarest are looked up; which ones they are changes the work and not the result.
        """
        self.counts: list[dict[int, int]] = []
        self.least = np.zeros(len(self.items), np.int64)
        self.lookups: list[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        widths = np.array([width_of(len(i.words)) for i in self.items])
        numbers = [self.numbers(np.array(i.words, np.uint64)) for i in self.items]
        for k, item in enumerate(self.items):
            n = len(item.words)
            self.least[k] = n if n < SHORT else next(c for c in range(n + 1) if c / n >= LIKELY)
            self.counts.append(dict(zip(*(x.tolist() for x in np.unique(numbers[k], return_counts=True)))))
        for width in np.unique(widths):
            for own in np.split(np.flatnonzero(widths == width), range(ITEMS_AT_ONCE, int((widths == width).sum()), ITEMS_AT_ONCE)):
                needed, postings = np.zeros(len(own)), []
                for place, k in enumerate(own.tolist()):
                    missing, looked = len(numbers[k]) - int(self.least[k]), 0
                    for v in sorted(self.counts[k], key=lambda v: (-self.idf[v % self.columns], v)):
                        if looked >= missing + max(1, SPARE_WORDS * len(numbers[k])):
                            break
                        postings.append((v, place, self.counts[k][v]))
                        looked += self.counts[k][v]
                    needed[place] = looked - missing
                postings = np.array(sorted(postings), np.int64)
                first = np.searchsorted(postings[:, 0], np.arange(len(self.vocabulary) + 1))
                self.lookups.append((int(width), own, first, postings[:, 1], postings[:, 2], needed))


def _terms_and_passages(space: Space):
    """Executor function: passages of 64 words over the vocabulary, as term numbers (``terms``); then, per task, in how many
    documents each vocabulary term stands (``term, docs``), term -1 counting the documents."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, docs = np.zeros(space.columns, np.int64), 0
        names = ["term", "docs", "terms"]
        for batch in batches:
            docs += batch.num_rows
            for _, _, data, offsets in text_slices(batch.column(0)):
                words, firsts = words_of(data, offsets)
                term = space.terms(words)
                counts = np.diff(firsts)
                row = np.repeat(np.arange(len(counts)), counts)
                pair = np.unique(row[term >= 0] * space.columns + term[term >= 0])
                total += np.bincount(pair % space.columns, minlength=space.columns)
                passages = -(-counts // 64)
                passage = (np.cumsum(passages) - passages)[row] + (np.arange(len(words)) - firsts[:-1][row]) // 64
                size = np.bincount(passage[term >= 0], minlength=int(passages.sum()))
                kept = (term >= 0) & (size >= SHORT)[passage]
                size = size[size >= SHORT]
                terms = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.array(term[kept].astype(np.int32)))
                yield pa.RecordBatch.from_arrays([pa.nulls(len(size), pa.int32()), pa.nulls(len(size), pa.int64()), terms], names=names)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-1], at]).astype(np.int32)), pa.array(np.concatenate([[docs], total[at]])),
                                          pa.nulls(len(at) + 1, pa.list_(pa.int32()))], names=names)
    return cut


def _packed(left: np.ndarray, right: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    """One row per value of ``left``, which is sorted: its columns (int32) and their sums (int64) as bytes."""
    firsts = np.flatnonzero(np.diff(left, prepend=-1))
    cuts = np.append(firsts, len(left)).tolist()
    columns, values = right.astype(np.int32).tobytes(), sums.astype(np.int64).tobytes()
    return pa.RecordBatch.from_arrays([pa.array(left[firsts].astype(np.int32)),
                                       pa.array([columns[4 * x:4 * y] for x, y in zip(cuts[:-1], cuts[1:])], pa.binary()),
                                       pa.array([values[8 * x:8 * y] for x, y in zip(cuts[:-1], cuts[1:])], pa.binary())], names=["term", "columns", "sums"])


def _gram_parts(space: Space):
    """Executor function: a task's share of N'N, N being its passages' term counts; every unordered pair of terms stands once.

    The commonest terms, most of a passage's words, are multiplied as a dense matrix; pairs of the others are counted as
    codes, ``PAIRS`` at once, so that a task's memory depends on the number of columns and not on its square.
    """
    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = space.columns
        common = np.argsort(space.idf, kind="stable")[:COMMON]
        place = np.full(columns, -1)
        place[common] = np.arange(len(common))
        total = np.zeros((columns, len(common)))
        # Pairs of a term with itself count twice, and once for each of its words.
        own = np.zeros(columns, np.int64)
        codes, held = [], 0

        def counted():
            code, n = np.unique(np.concatenate(codes), return_counts=True)
            low, high = code // columns, code % columns
            return _packed(low, high, np.where(low == high, 2 * n, n))

        for batch in batches:
            part = batch.column(0)
            term = part.flatten().to_numpy()
            row = np.repeat(np.arange(len(part)), part.value_lengths().to_numpy())
            at = place[term]
            a = np.bincount(row[at >= 0] * len(common) + at[at >= 0], minlength=len(part) * len(common)).reshape(len(part), -1).astype(np.float32)
            total[common] += a.T @ a
            row, term = row[at < 0], term[at < 0]
            if not len(row):
                continue
            order = np.argsort(term, kind="stable")
            firsts = np.flatnonzero(np.diff(term[order], prepend=-1))
            total[term[order][firsts]] += np.add.reduceat(a[row[order]], firsts, axis=0)
            own += np.bincount(term, minlength=columns)
            after = np.searchsorted(row, row, side="right") - np.arange(len(row)) - 1
            left = np.repeat(np.arange(len(row)), after)
            right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(after) - after, after)
            # Below TERMS squared, so 32 bits hold a pair.
            codes.append(np.minimum(term[left], term[right]) * np.int32(columns) + np.maximum(term[left], term[right]))
            held += len(left)
            if held >= PAIRS:
                yield counted()
                codes, held = [], 0
        if held:
            yield counted()
        at = np.flatnonzero(own)
        yield _packed(at, at, own[at])
        total[common] = np.tril(total[common])
        for start in range(0, columns, 4096):
            left, right = np.nonzero(total[start:start + 4096])
            yield _packed(left + start, common[right], total[start + left, right])
    return multiply


def _sum_parts(columns: int):
    """Executor function: the sums of the rows of each term, which arrive together."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        term, total = None, np.zeros(columns, np.int64)

        def row():
            at = np.flatnonzero(total)
            return _packed(np.full(len(at), term), at, total[at])

        for batch in batches:
            for now, places, values in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                if now != term:
                    if term is not None:
                        yield row()
                    term, total = now, np.zeros(columns, np.int64)
                total[np.frombuffer(places.as_buffer(), np.int32)] += np.frombuffer(values.as_buffer(), np.int64)
        if term is not None:
            yield row()
    return add


def _gram_step(space: Space, basis):
    """Executor function: the share of a task's rows of N'N in A'A times the basis, one row per term; A is N times the idf."""
    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf = space.idf.astype(np.float32)[:, None]
        weighted = basis.value * idf
        total = np.zeros_like(weighted)
        for batch in batches:
            term = batch.column(0).to_numpy()
            part = np.zeros((len(term), space.columns), np.float32)
            for k, (places, values) in enumerate(zip(batch.column(1), batch.column(2))):
                part[k, np.frombuffer(places.as_buffer(), np.int32)] = np.frombuffer(values.as_buffer(), np.int64)
            total[term] += part @ weighted
            part[np.arange(len(term)), term] = 0
            total += part.T @ weighted[term]
        total *= idf
        at = np.flatnonzero(np.abs(total).sum(1))
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array([total[i].tobytes() for i in at], pa.binary())], names=["term", "part"])
    return multiply


def _sum_products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for term, part in zip(batch.column(0).to_pylist(), batch.column(1)):
            vector = np.frombuffer(part.as_buffer(), np.float32)
            total[term] = total[term] + vector if term in total else vector
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())], names=["term", "part"])


def _searcher(shared):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space: Space = shared.value
        for batch in batches:
            for first, last, data, offsets in text_slices(batch.column(1)):
                words, firsts = words_of(data, offsets)
                found = search_rows(space, words, firsts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first),
                     pa.array([sorted(f) for f in found], pa.list_(pa.int64())),
                     pa.array([max(f.values(), default=0.0) for f in found], pa.float64())], names=["row", "items", "share"])
    return search


def search_rows(space: Space, words: np.ndarray, firsts: np.ndarray) -> list[dict[int, float]]:
    """Per row: leaked item numbers with the share of their words: the result of ``contained`` on the region of every window."""
    found: list[dict[int, float]] = [{} for _ in range(len(firsts) - 1)]
    if not len(words) or not space.items:
        return found
    number = space.numbers(words)
    hit = np.flatnonzero(number >= 0)
    if not len(hit):
        return found
    counts = np.diff(firsts)
    row = np.repeat(np.arange(len(counts)), counts)
    for width, own, first, item, times, needed in space.lookups:
        # Windows start every quarter width, in every row; a cell is the words up to the next start.
        step = max(1, width // BLOCK // 4) * BLOCK
        n_cells = -(-counts // step)
        first_cell = np.concatenate([[0], np.cumsum(n_cells)])
        cells = int(first_cell[-1])
        size = first[number[hit] + 1] - first[number[hit]]
        at = hit[size > 0]
        if not len(at):
            continue
        size = size[size > 0]
        cell = first_cell[row[at]] + (at - firsts[row[at]]) // step
        posting = np.repeat(first[number[at]] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        # A word counts once a cell.
        seen = np.unique(posting * cells + np.repeat(cell, size))
        posting, cell = seen // cells, seen % cells
        # A region is half a width, the width and half a width: a power of two of cells, whose sums are doubled up.
        before, region = width // 2 // step, 2 * width // step
        reach = np.bincount(item[posting] * (cells + region - 1) + before + cell, times[posting],
                            minlength=len(own) * (cells + region - 1)).astype(np.int32).reshape(len(own), -1)
        span = 1
        while span < region:
            reach = reach[:, :-span] + reach[:, span:]
            span *= 2
        # Words of other rows at a row's edge only add to the bound.
        enough = reach >= needed.astype(np.int32)[:, None]
        near: dict[int, list[int]] = {}
        for at in np.flatnonzero(enough).tolist():
            near.setdefault(at % cells, []).append(int(own[at // cells]))
        pairs = []
        for c, chosen in near.items():
            r = int(np.searchsorted(first_cell, c, side="right")) - 1
            start = int(firsts[r]) + (c - int(first_cell[r])) * step
            low, high = max(int(firsts[r]), start - width // 2), min(int(firsts[r + 1]), start + width + width // 2)
            there = set(number[low:high].tolist())
            chosen = [k for k in chosen if sum(n for v, n in space.counts[k].items() if v in there) >= space.least[k]]
            if chosen:
                inside = number[start:min(int(firsts[r + 1]), start + width)]
                x = space.weighted[inside[inside >= 0] % space.columns].sum(0)
                cosine = space.latent[chosen] @ x / (space.norms[chosen] * max(float(np.linalg.norm(x)), 1e-12))
                pairs += [(-float(a), r, low, high, k) for a, k in zip(cosine, chosen)]
        # The likeliest come first: a whole item needs no further look.
        for _, r, low, high, k in sorted(pairs):
            item_number = space.items[k].number
            if found[r].get(item_number, 0.0) < 1:
                share = contained(space.items[k], words[low:high].tolist())
                if share is not None:
                    found[r][item_number] = max(share, found[r].get(item_number, 0.0))
    return found


def fit_space(docs: DataFrame, items: list[Item]) -> Space:
    """Document frequencies over all of ``docs`` (``text``), then the randomised decomposition over all their passages."""
    spark = docs.sparkSession
    space = Space(items)
    if not items:
        return space
    read = stored(docs.select("text").mapInArrow(_terms_and_passages(space), "term int, docs bigint, terms array<int>"))
    counts = {r.term: r.docs for r in read.where("term IS NOT NULL").groupBy("term").agg(F.sum("docs").alias("docs")).collect()}
    space.weigh({t: n for t, n in counts.items() if t >= 0}, counts.get(-1, 0))
    space.index()
    # The passages are read once; both rounds multiply their sums, which no longer grow with the documents.
    parts = read.where("terms IS NOT NULL").select("terms").mapInArrow(_gram_parts(space), GRAM)
    gram = stored(parts.repartition("term").sortWithinPartitions("term").mapInArrow(_sum_parts(space.columns), GRAM))
    rank = min(RANK + SPARE, space.columns)
    z = np.random.default_rng(11).standard_normal((space.columns, rank)).astype(np.float32)
    rows = space.item_rows() * np.float32(ITEM_WEIGHT)
    for _ in range(ROUNDS):
        basis = spark.sparkContext.broadcast(z)
        parts = gram.mapInArrow(_gram_step(space, basis), "term int, part binary").repartition(4, "term").mapInArrow(_sum_products, "term int, part binary")
        total = rows.T @ (rows @ z)
        for r in parts.collect():
            total[r.term] += np.frombuffer(r.part, np.float32)
        z = np.linalg.qr(total)[0].astype(np.float32)
        basis.unpersist()
    space.project(z[:, :RANK])
    return space


def find_leaks(df: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
               answer: str | None = None, keep: Sequence[str] | None = None) -> DataFrame:
    """``key, items, share`` for every row of ``df``: the benchmark items it contains and the largest share of one.

    ``keep`` names columns to carry in place of ``key``.

    Texts are searched whole, in windows at a quarter's step, the width following each item's length. A window's region (half
    a width more at both ends) is a candidate for every item that it has enough words of, whatever their weight or order: this
    is necessary for the checks, so no leak is lost. A candidate is a leak when a share of ``SURE`` of the item's words stands
    there in order, or ``LIKELY`` and ``ANSWER`` of its answer (its last sentence where ``answer`` names no column). Items
    under ``SHORT`` words must stand there word for word.

    Candidates are checked in the order of their latent cosine, which changes the work and not the result: TF-IDF vectors over
    the benchmark's words, with document frequencies of all of ``df``, projected on the right singular vectors of a randomised
    decomposition (two rounds of A'A times a random basis, A'A being summed once over Spark tasks; fitted on all items and
    all passages of ``df``).

    The benchmark is the stated query set and is held in every task; its numbers, not texts, are the result. Null texts and
    texts without words leak nothing; null or wordless items match nothing; null keys and repeated rows are searched each;
    an empty table gives an empty result; other columns are ignored.
    """
    small_batches(df.sparkSession)
    told = F.col(answer).cast("string") if answer else F.lit(None).cast("string")
    rows = benchmark.select(F.col(item_key).cast("bigint"), F.lower(F.col(item_text).cast("string")), F.lower(told)).collect()
    items = items_of(sorted({(r[0], r[1], r[2]) for r in rows if r[0] is not None and r[1] is not None}, key=lambda r: (r[0], r[1], r[2] or "")))
    row = F.struct(*[F.col(f"`{c}`") for c in keep or [key]])
    docs = df.select(row.alias("row"), F.lower(F.col(text).cast("string")).alias("text"))
    space = fit_space(docs.select("text"), items)
    shared = df.sparkSession.sparkContext.broadcast(space)
    kind = StructType([docs.schema["row"], *StructType.fromDDL("items array<bigint>, share double")])
    return docs.select("row", "text").mapInArrow(_searcher(shared), kind).select("row.*", "items", "share")


@query("op5_benchmark_leaks")
def op5_benchmark_leaks(spark, folder):
    found = find_leaks(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))
    return found.selectExpr("doc_id", "size(items) > 0 AS contaminated", "CAST(size(items) AS BIGINT) AS n_items", "share",
                            "array_join(transform(items, x -> CAST(x AS STRING)), ',') AS item_ids", "items")
