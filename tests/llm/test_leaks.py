import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tallyloom.llm import leaks


def longest(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last, row = row, [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(row[-1], last[j + 1]))
    return row[-1]


@pytest.mark.parametrize("seed", range(20))
def test_common_subsequence(seed):
    rng = random.Random(seed)
    a, b = ([rng.randint(0, 6) for _ in range(rng.randint(0, 90))] for _ in range(2))
    assert leaks.common_subsequence(leaks.masks_of(a), len(a), b) == longest(a, b)


def plain(t):
    return " " + " ".join(re.findall(r"[a-z0-9\u0080-\U0010ffff]+", t.lower())) + " "


def test_finds_every_passage_and_paraphrase(documents, spark):
    frame, _ = documents
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    rows = items.orderBy("item_id").collect()
    rng = random.Random(4)
    made, want = [], {}
    for n, r in enumerate(rows[:12]):
        filler = frame.where(f"doc_id = {n + 10}").first().text.split()
        words = r.text.split()
        if n % 3 == 1:     # one word in ten changed
            words = [w if i % 10 else "geändert" for i, w in enumerate(words)]
        if n % 3 == 2:     # words put in between
            words = [x for i, w in enumerate(words) for x in ([w, "zwischen"] if i % 5 == 0 else [w])]
        at = rng.randint(0, len(filler))
        made.append((5000 + n, " ".join(filler[:at] + [w.upper() for w in words] + filler[at:])))
        want[5000 + n] = r.item_id
    extra = spark.createDataFrame([(-1, None), (None, "text without a number"), (-2, "one two three")], items.schema)
    docs = frame.select("doc_id", "text", "items").unionAll(spark.createDataFrame([m + ("x",) for m in made], "doc_id bigint, text string, items string"))
    found = leaks.find_leaks(docs, items.unionAll(extra)).collect()
    assert len(found) == docs.count()
    exact = {(r.doc_id, i.item_id) for r in docs.collect() for i in rows if r.text and plain(i.text) in plain(r.text)}
    got = {(r.doc_id, i) for r in found for i in r["items"]}
    assert exact <= got
    assert {(d, i) for d, i in want.items()} <= got
    assert not {d for d, _ in got - exact if d is not None and d < 5000}, "documents without a passage stay clean"


def every_window(item, words):
    """Largest share that ``contained`` gives on the region of any window."""
    width = leaks.width_of(len(item.words))
    step = max(1, width // leaks.BLOCK // 4) * leaks.BLOCK
    return max((s for k in range(0, len(words), step)
                if (s := leaks.contained(item, words[max(0, k - width // 2):k + width + width // 2])) is not None), default=None)


def test_equals_the_checks_on_every_window(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("text IS NOT NULL").orderBy("doc_id").limit(150).collect()
    rows = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").orderBy("item_id").collect()
    often = {}
    for r in docs:
        for w in set(plain(r.text).split()):
            often[w] = often.get(w, 0) + 1
    rng = random.Random(5)
    made = [(r.doc_id, r.text) for r in docs]
    for n, r in enumerate(rows):
        words, last = r.text.split(), len([x for x in re.split(r"[.!?\n]+", r.text) if x.strip()][-1].split())
        # The rarest words outside the last sentence are replaced; 70% stay, in order.
        rare = sorted(range(len(words) - last), key=lambda i: often.get(plain(words[i]).strip(), 0))[:int(0.3 * len(words))]
        filler = docs[n].text.split()[:200]
        at = rng.randint(0, len(filler))
        made.append((9000 + n, " ".join(filler[:at] + ["ersatz" if i in rare else w for i, w in enumerate(words)] + filler[at:])))
    short = [(900, "a short question of six words"), (901, "two words")]
    made.append((9900, " ".join(docs[0].text.split()[:50]) + " A short question of six words, " + " ".join(docs[1].text.split()[:50]) + " two short words; two words"))
    benchmark = spark.createDataFrame([(r.item_id, r.text) for r in rows] + short, "item_id bigint, text string")
    got = {r.doc_id: set(r["items"]) for r in leaks.find_leaks(spark.createDataFrame(made, "doc_id bigint, text string"), benchmark).collect()}
    items = leaks.items_of([(r.item_id, r.text.lower(), None) for r in rows] + [(k, t, None) for k, t in short])
    want = {k: {i.number for i in items if every_window(i, words) is not None}
            for (k, _), words in zip(made, leaks.hashed_texts([t.lower() for _, t in made]))}
    assert got == want
    assert all(r.item_id in got[9000 + n] for n, r in enumerate(rows)) and got[9900] == {900, 901}


def test_empty_tables(documents, spark):
    frame, _ = documents
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    assert leaks.find_leaks(frame.limit(0), items).collect() == []
    assert {len(r["items"]) for r in leaks.find_leaks(frame, items.limit(0)).collect()} == {0}


def test_the_decomposition_reads_every_passage(spark, monkeypatch):
    """All passages of more than a thousand documents enter both rounds, with the product that a dense matrix gives."""
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.choice([4, 12, 70, 150]))) for _ in range(1500)]
    items = leaks.items_of([(k, " ".join(rng.sample(vocabulary, 30)), None) for k in range(5)])
    docs = spark.createDataFrame([(t,) for t in texts] + [(None,)], "text string").repartition(3)
    monkeypatch.setattr(leaks, "COMMON", 20)
    space = leaks.fit_space(docs, items)
    passages = [p for words in leaks.hashed_texts(texts) for k in range(0, len(words), 64)
                if sum((p := space.terms(np.array(words[k:k + 64], np.uint64))) >= 0) >= leaks.SHORT]
    a = np.stack([np.bincount(p[p >= 0], minlength=space.columns) for p in passages]) * space.idf
    rows = space.item_rows() * leaks.ITEM_WEIGHT
    z = np.random.default_rng(11).standard_normal((space.columns, space.columns)).astype(np.float32)[:, :min(leaks.RANK + leaks.SPARE, space.columns)]
    for _ in range(leaks.ROUNDS):
        z = np.linalg.qr(a.T @ (a @ z) + rows.T @ (rows @ z))[0]
    # The basis is that of the whole table up to signs and rounding: the leading directions agree.
    assert np.allclose(np.abs((z[:, :5] * space.vectors[:, :5]).sum(0)), 1, atol=1e-3)


def test_the_passages_are_multiplied_once(spark, monkeypatch):
    """Term pairs of all passages are counted exactly, over several lots of pairs and tasks; a round reads one row per term."""
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(50)]
    texts = [" ".join(rng.choices(vocabulary, range(1, 51), k=rng.choice([9, 64, 140]))) for _ in range(400)]
    space = leaks.Space(leaks.items_of([(k, " ".join(rng.sample(vocabulary, 30)), None) for k in range(4)]))
    monkeypatch.setattr(leaks, "COMMON", 7)
    monkeypatch.setattr(leaks, "PAIRS", 5000)
    passages = [p[p >= 0] for words in leaks.hashed_texts(texts) for k in range(0, len(words), 64)
                if sum((p := space.terms(np.array(words[k:k + 64], np.uint64))) >= 0) >= leaks.SHORT]
    counts = np.stack([np.bincount(p, minlength=space.columns) for p in passages])
    batches = [pa.RecordBatch.from_arrays([pa.array([p.tolist() for p in passages[k:k + 90]], pa.list_(pa.int32()))], names=["terms"])
               for k in range(0, len(passages), 90)]
    parts = pa.Table.from_batches([*leaks._gram_parts(space)(batches[:3]), *leaks._gram_parts(space)(batches[3:])]).sort_by("term")
    rows = pa.Table.from_batches(leaks._sum_parts(space.columns)(parts.to_batches()))
    assert rows.column("term").to_pylist() == sorted(set(rows.column("term").to_pylist())), "one row per term"
    gram = np.zeros((space.columns, space.columns), np.int64)
    for term, places, values in zip(*(c.to_pylist() for c in rows.columns)):
        gram[term, np.frombuffer(places, np.int32)] += np.frombuffer(values, np.int64)
    assert not (np.tril(gram, -1) * np.triu(gram, 1).T).any()
    assert (gram + gram.T - np.diag(np.diag(gram)) == counts.T @ counts).all()


@pytest.mark.parametrize("size", [1, 2, 50, 5000])
def test_words_are_found_by_their_leading_bits(size):
    rng = np.random.default_rng(size)
    space = leaks.Space([leaks.Item(0, (words := rng.integers(0, 1 << 64, size, np.uint64)).tolist(), {}, [], {})])
    asked = np.concatenate([words, words + np.uint64(1), words - np.uint64(1), rng.integers(0, 1 << 64, 99, np.uint64), np.array([0, (1 << 64) - 1], np.uint64)])
    place = {w: k for k, w in enumerate(sorted(set(words.tolist())))}
    assert space.numbers(asked).tolist() == [place.get(w, -1) for w in asked.tolist()]
    assert len(space.numbers(asked[:0])) == 0
