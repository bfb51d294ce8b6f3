import hashlib
import re

from tallyloom.llm import pii

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
            "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    luhn = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0
    return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in value.split(".")), "card": 13 <= len(digits) <= 19 and luhn,
            "phone": 9 <= len(digits) <= 15}[kind]


def brute(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if passes(k, m[0])]


HARD = ["a@b.c_d@e.f x@y.z@w.v", "..a@b.cc", "1.2.3.4.5.6.7.8", "999.1.1.1 0010.1.1.255", "1.1.1.1.1", "4111 1111-1111 1111 4111111111111111", "4111111111111112",
        "+1 (234) 567-8901+44 20 7946 0958", "++12345678 +1", "é😀 a@b.de 😀 10.0.0.1", "1" * 5000, "a." * 3000 + "@" + "b." * 3000 + "c", "x" * 20000, "+1" * 2000,
        "@.@@a@b", "0.0.0.0", "+1-----------2345678901", "12 34-56 78 90 12 34 5"]


def test_base_equals_brute_force(documents, spark):
    frame, _ = documents
    hard = spark.createDataFrame([(9000 + i, t) for i, t in enumerate(HARD)], "doc_id bigint, text string")
    docs = frame.select("doc_id", "text").unionAll(hard)
    found = pii.find_pii(docs).collect()
    assert len(found) == docs.count()
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, set()).add(tuple(brute(r.text)))
    for r in found:
        own = tuple((s.kind, s.start, s.end) for s in r.base)
        assert own in texts[r.doc_id], (r.doc_id, own[:5])
        for a in r.added:
            assert all(b.end <= a.start or a.end <= b.start for b in [*r.base, *(x for x in r.added if x is not a)])


def test_digest_of_the_query(spark, tmp_path):
    rows = [(1, HARD[5] + " a@b.de"), (2, None), (3, "")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    for r in pii.op6_pii_spans(spark, str(tmp_path)).collect():
        spans = ",".join(f"{k}:{a}:{b}" for k, a, b in brute(dict(rows)[r.doc_id]))
        assert r.base_sha256 == hashlib.sha256(spans.encode()).hexdigest() and r.spans == spans


def test_trees_as_sql_and_added_spans(spark):
    trees, cuts = pii.fit(spark)
    names = list(pii.FEATURES)
    rows = [[float((i * 7 + j * 3) % 11) for j in range(len(names))] for i in range(40)]
    frame = spark.createDataFrame([(i, tuple(r)) for i, r in enumerate(rows)], "i int, f struct<" + ", ".join(f"{n}: double" for n in names) + ">")
    for r in frame.selectExpr("i", f"{trees.sql(names)} AS p").collect():
        assert abs(r.p - trees.probability(rows[r.i])) < 1e-12
    lines = pii.labelled_lines(seed=77, rounds=12)
    docs = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(lines)], "doc_id bigint, text string")
    found = {r.doc_id: {s.kind for s in r.added} for r in pii.find_pii(docs).collect()}
    hits = [lines[i][2] for i, kinds in found.items() if lines[i][1] in kinds]
    assert sum(hits) / len(hits) > 0.9 and sum(hits) > 0.6 * sum(x[2] for x in lines)


def test_empty(documents):
    assert pii.find_pii(documents[0].limit(0)).collect() == []


def test_long_texts_over_many_windows(spark):
    """Spans of a text of many windows are those of its parts, moved; some lie across a window's border."""
    part = "Call 555-123-4567 or +44 20 7946 0958, card 4111 1111 1111 1111, token=abc123def456ghi789, mail x@y.de é 10.1.2.3 😀 and write to a at b dot com.\n"
    size, times = len(part), 2 * pii.STRETCH
    assert size * times > 10 * pii.WINDOW and pii.WINDOW % size
    docs = spark.createDataFrame([(1, part * 3), (2, part * times)], "doc_id bigint, text string")
    found = {r.doc_id: [(s.kind, s.start, s.end) for s in [*r.base, *r.added]] for r in pii.find_pii(docs).collect()}
    middle = [(k, a - size, b - size) for k, a, b in found[1] if size <= a < 2 * size]
    assert {"email", "ip", "card", "phone"} <= {k for k, _, _ in middle}
    inner = [(k, a, b) for k, a, b in found[2] if size <= a < size * (times - 1)]
    assert sorted(inner) == sorted((k, a + size * i, b + size * i) for i in range(1, times - 1) for k, a, b in middle)
