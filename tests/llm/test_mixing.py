from collections import defaultdict

from tallyloom.llm import mixing

from .conftest import same_rows

COLUMNS = ["doc_id", "size", "source_size", "target", "taken"]


def test_equals_sql_with_awkward_rows(documents, duck):
    frame, path = documents
    # Rows that share an id may take each other's place in the order; their sum is fixed.
    mixed = mixing.mix(frame, mixing.SIZE, mixing.QUALITY).select(COLUMNS)
    names, rows = duck(mixing.OP1_SQL, documents=path)
    same_rows(mixed.where("doc_id IS NOT NULL AND doc_id <> 1005"), names, [r for r in rows if r[0] is not None and r[0] != 1005])
    assert mixed.count() == frame.count()


def test_targets_and_budgets(documents):
    frame, _ = documents
    rows = mixing.mix(frame, mixing.SIZE, mixing.QUALITY).collect()
    again = mixing.mix(frame.repartition(7), mixing.SIZE, mixing.QUALITY).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    sums, target, size = defaultdict(int), {}, {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        sums[r.source] += r.taken
        target[r.source], size[r.source] = r.target, r.source_size
    for s in sums:
        assert sums[s] == int(target[s] + 1e-9) and target[s] <= 3 * size[s]
    # Brute force: hand out the words, cut at the caps, share the excess again.
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    fixed, left = {}, float(sum(size.values()))
    while True:
        free = [s for s in order if s not in fixed]
        level = left / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if weight[s] * level > 3 * size[s]]
        if not over:
            break
        for s in over:
            fixed[s] = 3 * size[s]
            left -= fixed[s]
    for s in order:
        assert abs(target[s] - fixed.get(s, weight[s] * level)) < 1e-6 * max(1, target[s])


def test_complete_epochs_come_first_and_heavier_documents_win(spark):
    docs = spark.range(400).selectExpr("id AS doc_id", "'a' AS source", "10L AS words", "IF(id % 2 = 0, 1.0D, 0.1D) AS q").unionAll(
        spark.range(400, 404).selectExpr("id AS doc_id", "'b' AS source", "10L AS words", "1.0D AS q"))
    rows = mixing.mix(docs, "words", "q", weights=(1, 1)).where("source = 'a'").collect()
    assert {r.epochs for r in rows} == {0} and {r.target for r in rows} == {3920.0}
    few = mixing.mix(docs.where("doc_id < 400 OR doc_id > 500"), "words", "q").collect()
    assert all(r.taken == 10 for r in few)
    part = spark.range(400).selectExpr("id AS doc_id", "IF(id < 300, 'a', 'b') AS source", "10L AS words", "IF(id % 2 = 0, 1.0D, 0.1D) AS q")
    half = [r for r in mixing.mix(part, "words", "q", weights=(1, 3)).collect() if r.source == "a"]
    even, odd = (sum(r.taken for r in half if r.doc_id % 2 == k) for k in (0, 1))
    assert even > 2 * odd


def test_empty(documents):
    frame, _ = documents
    assert mixing.mix(frame.limit(0), mixing.SIZE, mixing.QUALITY).collect() == []
