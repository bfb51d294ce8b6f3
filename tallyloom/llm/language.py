"""Language identification: a linear-chain conditional random field over the words of a text."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import _LOWER, hashed_spans, mixed, read_table, spans_of, small_batches, stored, text_slices
from .registry import query

#: Bounds of the training sample, per language: documents, pieces of them, and words of a piece.
SAMPLE_DOCS, SAMPLE_PIECES, PIECE_WORDS = 400, 1500, 16
LEXICON_WORDS = 300     # most frequent words of each language's sample
BUCKETS = 1 << 16       # hashed affixes and n-grams
UNDETERMINED = "und"

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


@dataclass
class Field:
    """Weights of the features and transitions, and the lexicon; labels are the rows' languages."""

    languages: list[str]
    weights: np.ndarray       # features x languages
    transitions: np.ndarray   # from x to
    lexicon: np.ndarray       # sorted word hashes
    members: np.ndarray       # lexicon x languages, bool


def words_of(data: np.ndarray, rows: np.ndarray):
    """Lower-cased bytes, starts and ends of the words (runs of letters), first word of every row plus the total."""
    starts, ends = spans_of(_LETTER[data], rows)
    return _LOWER[data], starts, ends, np.searchsorted(starts, rows)


def features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray, lexicon: np.ndarray, members: np.ndarray):
    """Feature numbers of every word, word after word, and the first of each: affixes, n-grams, lexicon entries, one bias."""
    n, length = len(starts), ends - starts
    numbers, owners = [np.full(n, BUCKETS)], [np.arange(n)]

    def add(kind, at, sizes, word):
        h = hashed_spans(data, at, at + sizes)
        numbers.append((mixed(h + np.uint64(kind)) >> np.uint64(48)).astype(np.int64) % BUCKETS)
        owners.append(word)

    for k in (1, 2, 3):
        word = np.flatnonzero(length >= k)
        add(k, starts[word], k, word)
        add(10 + k, ends[word] - k, k, word)
    for k in (2, 3):
        count = np.maximum(length - k + 1, 0)
        word = np.repeat(np.arange(n), count)
        place = np.arange(len(word)) - np.repeat(np.cumsum(count) - count, count)
        add(20 + k, starts[word] + place, k, word)
    if len(lexicon):
        at = np.minimum(np.searchsorted(lexicon, hashes), len(lexicon) - 1)
        word, language = np.nonzero(members[at] & (lexicon[at] == hashes)[:, None])
        numbers.append(BUCKETS + 1 + language)
        owners.append(word)
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(numbers)[order], np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))])


def marginals(emission: np.ndarray, transitions: np.ndarray, firsts: np.ndarray, pairs: bool = False):
    """Label marginals of every word by forward-backward, all rows side by side; with ``pairs`` the expected transitions.

    ``emission`` and ``transitions`` are log potentials. Messages are scaled to sum to one, so no length overflows.
    """
    lengths = np.diff(firsts)
    order = np.argsort(-lengths, kind="stable")
    head, ordered = firsts[:-1][order], lengths[order]
    longest = int(ordered[0]) if len(ordered) else 0
    active = np.searchsorted(-ordered, -np.arange(longest), side="left")
    e = np.exp(emission - emission.max(1, keepdims=True)) if len(emission) else emission
    t = np.exp(transitions)
    forward, backward = np.empty_like(e), np.ones_like(e)
    for step in range(longest):
        at = head[:active[step]] + step
        a = e[at] if step == 0 else (a[:active[step]] @ t) * e[at]
        a = a / a.sum(1, keepdims=True)
        forward[at] = a
    expected = np.zeros_like(t)
    for step in range(longest - 2, -1, -1):
        at = head[:active[step + 1]] + step
        ahead = e[at + 1] * backward[at + 1]
        b = ahead @ t.T
        if pairs:
            joint = forward[at][:, :, None] * t[None] * ahead[:, None]
            expected += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
        backward[at] = b / b.sum(1, keepdims=True)
    m = forward * backward
    return m / m.sum(1, keepdims=True) if len(m) else m, expected


#: Words of a segment: chains are cut into segments that are passed through side by side.
SEGMENT = 64


def segment_marginals(emission: np.ndarray, transitions: np.ndarray, firsts: np.ndarray, segment: int = SEGMENT) -> np.ndarray:
    """``marginals`` of chains of any length, in loops of ``segment`` steps and one step per segment of the longest chain.

    Every chain is cut into segments. The products of the potentials over each segment, from label to label, are made for
    all segments at once; a scan over the segments of each chain gives the messages at the borders, forwards and
    backwards; then all segments are passed through side by side. Exact: sums and products are those of the whole chain.
    """
    n, k = len(emission), len(transitions)
    if not n:
        return emission
    sizes = np.diff(firsts)
    count = -(-sizes // segment)
    owner = np.repeat(np.arange(len(sizes)), count)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    head = firsts[:-1][owner] + place * segment
    length = np.minimum(segment, firsts[1:][owner] - head)
    opening = place == 0
    e = np.exp(emission - emission.max(1, keepdims=True)).astype(np.float64)
    t = np.exp(transitions.astype(np.float64))
    entry, leaving = np.ones((len(head), k)), np.ones((len(head), k))
    chained = np.flatnonzero(count[owner] > 1)
    if len(chained):
        order = chained[np.argsort(-length[chained], kind="stable")]
        active = np.searchsorted(-length[order], -np.arange(int(length[order[0]])), side="left")
        product = np.empty((len(order), k, k))
        for step, live in enumerate(active):
            at = head[order[:live]] + step
            if step:
                moved = (product[:live].reshape(-1, k) @ t).reshape(-1, k, k)
            else:
                moved = np.where(opening[order[:live]][:, None, None], np.eye(k), t)
            moved = moved * e[at][:, None]
            product[:live] = moved / moved.max((1, 2), keepdims=True)
        whole = np.empty((len(head), k, k))
        whole[order] = product
        first = np.cumsum(count) - count
        long = np.flatnonzero(count > 1)
        long = long[np.argsort(-count[long], kind="stable")]
        alive = np.searchsorted(-count[long], -np.arange(int(count[long[0]])), side="left")
        message = np.ones((len(long), k))
        for step, live in enumerate(alive):
            at = first[long[:live]] + step
            entry[at] = message[:live]
            message = np.einsum("rj,rjk->rk", message[:live], whole[at])
            message = message / message.sum(1, keepdims=True)
        message = np.ones((len(long), k))
        for step in range(len(alive) - 1, 0, -1):
            at = first[long[:alive[step]]] + step
            message[:alive[step]] = np.einsum("rjk,rk->rj", whole[at], message[:alive[step]])
            message[:alive[step]] /= message[:alive[step]].sum(1, keepdims=True)
            leaving[at - 1] = message[:alive[step]]
    order = np.argsort(-length, kind="stable")
    active = np.searchsorted(-length[order], -np.arange(int(length[order[0]])), side="left")
    forward, backward = np.empty_like(e), np.empty_like(e)
    start = opening[order][:, None]
    for step, live in enumerate(active):
        at = head[order[:live]] + step
        if step:
            a = (a[:live] @ t) * e[at]
        else:
            a = np.where(start, 1.0, entry[order] @ t) * e[at]
        a = a / a.sum(1, keepdims=True)
        forward[at] = a
    last = head + length - 1
    backward[last] = leaving
    for step in range(len(active) - 2, -1, -1):
        at = head[order[:active[step + 1]]] + step
        b = (e[at + 1] * backward[at + 1]) @ t.T
        backward[at] = b / b.sum(1, keepdims=True)
    m = forward * backward
    return m / m.sum(1, keepdims=True)


def train(pieces: list[tuple[str, str]], sequences: int = 4000, epochs: int = 6, rate: float = 0.05, penalty: float = 1e-5, seed: int = 5) -> Field:
    """Fits the field on (language, piece of text) rows, joined at random into sequences that switch between languages."""
    languages = sorted({language for language, _ in pieces})
    number = {language: i for i, language in enumerate(languages)}
    texts = pa.array([text for _, text in pieces], pa.large_string())
    parts = []
    for first, last, data, rows in text_slices(texts):
        low, starts, ends, firsts = words_of(data, rows)
        parts.append((first, low, starts, ends, hashed_spans(low, starts, ends), firsts))
    hashes = np.concatenate([p[4] for p in parts])
    counts = np.concatenate([np.diff(p[5]) for p in parts])
    label = np.repeat([number[language] for language, _ in pieces], counts)
    chosen = {}
    for i in range(len(languages)):
        values, n = np.unique(hashes[label == i], return_counts=True)
        for h in values[np.argsort(-n, kind="stable")[:LEXICON_WORDS]]:
            chosen.setdefault(int(h), set()).add(i)
    lexicon = np.array(sorted(chosen), np.uint64)
    members = np.array([[i in chosen[int(h)] for i in range(len(languages))] for h in lexicon], bool).reshape(len(lexicon), len(languages))
    found, base = [], 0
    cuts = [np.zeros(1, np.int64)]
    for _, low, starts, ends, own, _ in parts:
        f, at = features(low, starts, ends, own, lexicon, members)
        found.append(f)
        cuts.append(at[1:] + base)
        base += len(f)
    found, cuts = np.concatenate(found), np.concatenate(cuts)
    firsts = np.concatenate([[0], np.cumsum(counts)])
    usable = np.flatnonzero(counts)
    by_language = {i: usable[[number[pieces[k][0]] == i for k in usable]] for i in range(len(languages))}
    present = [i for i in by_language if len(by_language[i])]
    rng = np.random.default_rng(seed)
    width = BUCKETS + 1 + len(languages)
    w, t = np.zeros((width, len(languages))), np.zeros((len(languages), len(languages)))
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(t), np.zeros_like(t)]
    step, batch = 0, 250
    for _ in range(epochs * sequences // batch):
        words, sizes = [], []
        for _ in range(batch):
            own = rng.choice(present)
            row = []
            for _ in range(3):
                language = own if rng.random() < 0.7 else rng.choice(present)
                k = rng.choice(by_language[language])
                row.append(np.arange(firsts[k], firsts[k + 1]))
            row = np.concatenate(row)
            words.append(row)
            sizes.append(len(row))
        words, edges = np.concatenate(words), np.concatenate([[0], np.cumsum(sizes)])
        size = cuts[words + 1] - cuts[words]
        take = np.repeat(cuts[words] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        used = found[take]
        emission = np.add.reduceat(w[used], np.cumsum(size) - size)
        m, pairs = marginals(emission, t, edges, pairs=True)
        y = label[words]
        m[np.arange(len(y)), y] -= 1
        inside = np.ones(len(y), bool)
        inside[edges[1:-1]] = False
        inside[0] = False
        seen = np.zeros_like(t)
        np.add.at(seen, (y[np.flatnonzero(inside) - 1], y[inside]), 1)
        spread = np.repeat(m, size, axis=0)
        gw = np.stack([np.bincount(used, spread[:, i], minlength=width) for i in range(len(languages))], 1) / batch + penalty * w
        gt = (pairs - seen) / batch + penalty * t
        step += 1
        for p, g, one, two in ((w, gw, state[0], state[1]), (t, gt, state[2], state[3])):
            one *= 0.9
            one += 0.1 * g
            two *= 0.999
            two += 0.001 * g * g
            p -= rate * (one / (1 - 0.9 ** step)) / (np.sqrt(two / (1 - 0.999 ** step)) + 1e-8)
    return Field(languages, w.astype(np.float32), t.astype(np.float32), lexicon, members)


def predict_rows(field: Field, data: np.ndarray, rows: np.ndarray):
    """Per row: number of words, summed marginals by language, how often the likeliest label changes, and the words' summed largest marginals."""
    low, starts, ends, firsts = words_of(data, rows)
    hashes = hashed_spans(low, starts, ends)
    if not field.languages:
        return np.diff(firsts), np.zeros((len(firsts) - 1, 0)), np.zeros(len(firsts) - 1, np.int64), np.zeros(len(firsts) - 1)
    _, one, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    f, at = features(low, starts[one], ends[one], hashes[one], field.lexicon, field.members)
    scores = np.add.reduceat(field.weights[f], at[:-1]) if len(one) else np.zeros((0, len(field.languages)), np.float32)
    m = segment_marginals(scores[inverse], field.transitions, firsts)
    counts = np.diff(firsts)
    total, switches, clear = np.zeros((len(counts), len(field.languages))), np.zeros(len(counts), np.int64), np.zeros(len(counts))
    full = np.flatnonzero(counts)
    if len(full):
        total[full] = np.add.reduceat(m, firsts[:-1][full], dtype=np.float64)
        clear[full] = np.add.reduceat(m.max(1), firsts[:-1][full], dtype=np.float64)
        best = m.argmax(1)
        change = np.concatenate([[False], best[1:] != best[:-1]])
        change[firsts[:-1][full]] = False
        switches[full] = np.add.reduceat(change.astype(np.int64), firsts[:-1][full])
    return counts, total, switches, clear


def _predictor(shared):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        for batch in batches:
            for first, last, data, offsets in text_slices(batch.column(1)):
                counts, total, switches, clear = predict_rows(field, data, offsets)
                ascii_letter = np.concatenate([[0], np.cumsum(_LETTER[data] & (data < 128))])
                plain = ascii_letter[offsets[1:]] > ascii_letter[offsets[:-1]]
                for i in np.flatnonzero(~plain & (counts > 0)):
                    plain[i] = any(c.isalpha() for c in batch.column(1)[first + int(i)].as_py())
                known = plain & (counts > 0) & bool(field.languages)
                best = total.argmax(1) if field.languages else np.zeros(last - first, int)
                names = [field.languages[b] if ok else UNDETERMINED for b, ok in zip(best, known)]
                score = np.where(known, total.max(1, initial=0) / np.maximum(counts, 1), 0.0)
                clear = np.where(known, clear / np.maximum(counts, 1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), batch.column(2).slice(first, last - first), pa.array(names, pa.string()),
                     pa.array(np.clip(score, 0, 1)), pa.array(counts.astype(np.int64)), pa.array(switches), pa.array(np.clip(clear, 0, 1))],
                    names=["row", "held_out", "lang_pred", "score", "n_words", "n_switches", "clearness"])
    return predict


def _cut_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to pieces of at most PIECE_WORDS words."""
    for batch in batches:
        language, text = [], []
        for name, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = t.split()
            for k in range(0, len(words), PIECE_WORDS):
                language.append(name)
                text.append(" ".join(words[k:k + PIECE_WORDS]))
        yield pa.RecordBatch.from_arrays([pa.array(language, pa.string()), pa.array(text, pa.string())], names=["lang", "piece"])


def sample_pieces(df: DataFrame) -> list[tuple[str, str]]:
    """At most SAMPLE_PIECES pieces of SAMPLE_DOCS documents of each language of ``id, text, lang``, by hash order."""
    df = df.where("text IS NOT NULL AND lang IS NOT NULL AND id IS NOT NULL")
    # Ranks are cut per task before the shuffle, so a language of most rows is no crowded group.
    ids = stored(df.select("id", "lang", F.xxhash64("id").alias("order")).withColumn(
        "rank", F.expr("row_number() OVER (PARTITION BY lang ORDER BY order, id)")).where(f"rank <= {SAMPLE_DOCS}").select("id").distinct())
    pieces = df.join(F.broadcast(ids), "id").select("lang", "text").mapInArrow(_cut_pieces, "lang string, piece string").distinct()
    pieces = pieces.withColumn("order", F.xxhash64("piece")).withColumn(
        "rank", F.expr("row_number() OVER (PARTITION BY lang ORDER BY order, piece)")).where(f"rank <= {SAMPLE_PIECES}")
    return sorted((r.lang, r.piece) for r in pieces.select("lang", "piece").collect())


def identify(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", keep: Sequence[str] | None = None) -> DataFrame:
    """``key, held_out, lang_pred, score, n_words, n_switches, clearness`` for every row; ``keep`` names columns to carry in place of ``key``.

    A linear-chain conditional random field labels every word of the whole text: potentials of prefixes, suffixes,
    character n-grams and a lexicon, and learned transitions between languages; forward-backward gives the words'
    marginals. The language with the largest expected number of words is predicted, its share of the words is the score,
    ``n_switches`` counts changes of the likeliest label. ``clearness`` is the mean over the words of their largest marginal:
    high where every word clearly belongs to some language, however evenly the languages share the text.

    The field is fitted on a bounded sample (``SAMPLE_DOCS``, ``SAMPLE_PIECES`` and ``PIECE_WORDS`` per language) of rows
    with a text and a language whose crc32(key) mod 4 is not 2; rows with remainder 2 are held out. Only the text is an
    input of a prediction.

    A text that is null or has no letter, and every text where nothing could be learned, gets ``und`` with score 0; a null
    key is not held out and not learned from; repeated rows are predicted each; an empty table gives an empty result;
    other columns are ignored. Memory grows with the longest single text, not with the table.
    """
    small_batches(df.sparkSession)
    spark = df.sparkSession
    row = F.struct(*[F.col(f"`{c}`") for c in keep or [key]])
    docs = df.select(row.alias("row"), F.col(key).alias("id"), F.lower(F.col(text).cast("string")).alias("text"),
                     F.col(lang).cast("string").alias("lang")).withColumn(
        "held_out", F.expr("coalesce(crc32(CAST(CAST(id AS STRING) AS BINARY)) % 4 = 2, false)"))
    pieces = sample_pieces(docs.where("NOT held_out").select("id", "text", "lang"))
    field = train(pieces) if pieces else Field([], np.zeros((BUCKETS + 1, 0), np.float32), np.zeros((0, 0), np.float32), np.zeros(0, np.uint64),
                                               np.zeros((0, 0), bool))
    shared = spark.sparkContext.broadcast(field)
    kind = StructType([docs.schema["row"], *StructType.fromDDL("held_out boolean, lang_pred string, score double, n_words bigint, n_switches bigint, clearness double")])
    return docs.select("row", "text", "held_out").mapInArrow(_predictor(shared), kind).select(
        "row.*", "held_out", "lang_pred", "score", "n_words", "n_switches", "clearness")


@query("op2_language_id")
def op2_language_id(spark, folder):
    return identify(read_table(spark, folder, "documents")).drop("clearness")
