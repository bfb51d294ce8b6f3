import itertools
import re

import numpy as np
import pytest

from tallyloom.llm import language

SF = "/root/testdata/sf0.01"


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(2)
    lengths = [3, 0, 1, 5, 2]
    firsts = np.concatenate([[0], np.cumsum(lengths)])
    emission, trans = rng.normal(size=(firsts[-1], 3)), rng.normal(size=(3, 3))
    m, pairs = language.marginals(emission, trans, firsts, pairs=True)
    want, expected = np.zeros_like(m), np.zeros((3, 3))
    for a, b in zip(firsts[:-1], firsts[1:]):
        total, part, moves = 0.0, np.zeros((b - a, 3)), np.zeros((3, 3))
        for labels in itertools.product(range(3), repeat=b - a):
            p = np.exp(sum(emission[a + i, y] for i, y in enumerate(labels)) + sum(trans[x, y] for x, y in zip(labels, labels[1:])))
            total += p
            for i, y in enumerate(labels):
                part[i, y] += p
            for x, y in zip(labels, labels[1:]):
                moves[x, y] += p
        if b > a:
            want[a:b], expected = part / total, expected + moves / total
    assert np.allclose(m, want) and np.allclose(pairs, expected)


@pytest.mark.parametrize("segment", [1, 2, 3, 7, 64])
def test_segments_give_the_marginals_of_whole_chains(segment):
    rng = np.random.default_rng(segment)
    lengths = [0, 1, 2, 3, 5, 6, 7, 0, 12, 63, 64, 65, 200, 1, 1000]
    firsts = np.concatenate([[0], np.cumsum(lengths)])
    emission, trans = rng.normal(size=(firsts[-1], 4)) * 6, rng.normal(size=(4, 4)) * 3
    want, _ = language.marginals(emission, trans, firsts)
    assert np.allclose(language.segment_marginals(emission, trans, firsts, segment), want, atol=1e-9)
    assert len(language.segment_marginals(emission[:0], trans, np.zeros(1, int), segment)) == 0


def test_prediction_equals_a_plain_restatement():
    """Features, chain and shares of whole rows, written out word by word."""
    field = language.train([(k, t) for k, t in (("xx", "ala bala kala mala"), ("yy", "sunt fost cest gust"), ("xx", "mala ala tala"), ("yy", "rest fost"))] * 3, sequences=500)
    texts = ["ala bala fost", "", "rest", "Ala! kala, sunt cest gust fost mala ala"]
    data = np.frombuffer("".join(texts).lower().encode(), np.uint8)
    rows = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    counts, total, switches, clear = language.predict_rows(field, data, rows)
    for i, text in enumerate(texts):
        words = re.findall("[a-z]+", text.lower())
        assert counts[i] == len(words)
        scores = []
        for w in words:
            one = np.frombuffer(w.encode(), np.uint8)
            cut = np.array([0]), np.array([len(w)])
            used, _ = language.features(one, *cut, language.hashed_spans(one, *cut), field.lexicon, field.members)
            scores.append(field.weights[used].sum(0))
        if not words:
            assert total[i].sum() == 0
            continue
        weights = {}
        for labels in itertools.product(range(2), repeat=len(words)):
            weights[labels] = np.exp(sum(s[y] for s, y in zip(scores, labels)) + sum(field.transitions[x, y] for x, y in zip(labels, labels[1:])))
        z = sum(weights.values())
        m = np.array([[sum(p for labels, p in weights.items() if labels[k] == y) / z for y in range(2)] for k in range(len(words))])
        assert np.allclose(total[i], m.sum(0), atol=1e-4) and np.isclose(clear[i], m.max(1).sum(), atol=1e-4)
        assert switches[i] == sum(a != b for a, b in zip(m.argmax(1), m.argmax(1)[1:]))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 150 and sum(r.lang_pred == r.lang for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_labels_of_held_out_rows_are_no_input(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    spoilt = docs.withColumn("lang", language.F.expr("IF(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 = 2, 'zz', lang)"))
    a, b = (sorted(map(str, language.identify(d).collect())) for d in (docs, spoilt))
    assert a == b


def test_awkward_rows(documents, spark):
    frame, _ = documents
    rows = language.identify(frame).collect()
    assert len(rows) == frame.count()
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert all(by[k].lang_pred == "und" and by[k].score == 0 for k in (1001, 1002, 1003, 1008))
    assert by[1009].lang_pred != "und" and by[1007].n_words == 60_000
    nothing = language.identify(frame.withColumn("lang", language.F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in nothing} == {"und"}
    assert language.identify(frame.limit(0)).collect() == []
    symbols = spark.createDataFrame([(8001, "— — 😀 ١٢"), (8002, "日本"), (8003, "Ж")], "doc_id bigint, text string").selectExpr("*", "'xx' AS lang")
    told = {r.doc_id: r.lang_pred for r in language.identify(symbols.unionByName(frame.select("doc_id", "text", "lang"))).collect()}
    assert told[8001] == "und" and told[8002] != "und" and told[8003] != "und"


def test_code_switching(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("text IS NOT NULL")
    one, two = (docs.where(f"lang = '{k}'").selectExpr("text").limit(1).first().text.replace("\n", " ").split()[:40] for k in ("de", "es"))
    joined = spark.createDataFrame([(-5, " ".join(one + two), None, None, None)], docs.schema)
    row = language.identify(docs.unionAll(joined)).where("doc_id = -5").first()
    assert 1 <= row.n_switches <= 12 and 0.35 < row.score < 0.65
