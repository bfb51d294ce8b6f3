import numpy as np

from tallyloom.llm import jaccard
from tallyloom.llm.common import components

from .conftest import same_rows


def test_equals_brute_force_in_sql(documents, duck, spark, tmp_path):
    frame, _ = documents
    # Copies with a changed word here and there, and one far from its original.
    near = frame.where("doc_id BETWEEN 10 AND 40 AND length(text) > 800").selectExpr(
        "doc_id + 2000 AS doc_id", "regexp_replace(text, ' [a-z]+\\\\.$', ' changed.') AS text").unionAll(
        frame.where("doc_id BETWEEN 10 AND 40").selectExpr("doc_id + 3000 AS doc_id", "reverse(text) AS text"))
    all_docs = frame.where("doc_id IS NOT NULL AND doc_id <> 1005").select("doc_id", "text").unionAll(near)
    path = str(tmp_path / "d")
    all_docs.write.parquet(path)
    names, rows = duck(jaccard.OP4_SQL, documents=path)
    assert any(r[names.index("n_links")] for r in rows if r[0] > 2000)
    same_rows(jaccard.near_duplicates(spark.read.parquet(path)), names, rows)


def test_awkward_rows(documents):
    frame, _ = documents
    rows = jaccard.near_duplicates(frame).collect()
    assert len(rows) == frame.count()
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by[1005].class_id == 1004 and by[1004].n_links == 3 and by[1006].class_id == 1004
    assert by[1001].n_links == by[1002].n_links == by[1003].n_links == 0 and by[1002].class_id == 1002
    assert all(r.class_id is None and r.n_links == 0 for r in rows if r.doc_id is None)
    assert jaccard.near_duplicates(frame.limit(0)).collect() == []


def test_group_larger_than_a_block(spark):
    n = jaccard.BLOCK + 90
    words = " ".join(f"w{i}" for i in range(60))
    rows = [(i, f"{words} tail{i}") for i in range(n)]
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)).collect()
    assert all(r.class_id == 0 and r.n_links == n - 1 for r in got)


def test_banding_reaches_its_recall():
    bands, rows = jaccard.banding(0.8, 0.9995, 256)
    assert bands * rows <= 256 and 1 - (1 - 0.8 ** rows) ** bands >= 0.9995


def test_components_of_chains_and_hubs(spark):
    rng = np.random.default_rng(1)
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + rng.integers(2000, 2400, (150, 2)).tolist() + [(7, None), (5, 5)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if b is not None and a != b:
            ra, rb = root(a), root(b)
            parent[max(ra, rb)] = min(ra, rb)
    got = {r.node: r.component for r in components(spark.createDataFrame([tuple(e) for e in edges], "src bigint, dst bigint")).collect()}
    assert got == {x: root(x) for x in parent}
