from tallyloom.llm import licences

from .conftest import same_rows


def test_equals_sql_with_awkward_rows(documents, duck, spark, tmp_path):
    frame, _ = documents
    # The statement counts by id, so repeated and null ids are left to the next test.
    path = str(tmp_path / "d")
    frame.where("doc_id IS NOT NULL AND doc_id <> 1005").write.parquet(path)
    names, rows = duck(licences._sql(), documents=path)
    same_rows(licences.scan_licences(spark.read.parquet(path)), names, rows)


def test_repeated_and_null_ids(documents):
    frame, _ = documents
    rows = licences.scan_licences(frame).collect()
    assert len(rows) == frame.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert len(by[1005]) == 2 and by[1005][0] == by[1005][1] and by[1005][0].labels == by[1004][0].labels == "cc-by,gpl,gpl-3.0,mit"
    assert sorted(r.n_base for r in by[None]) == [0, by[1004][0].n_base]


def test_labels_belong_to_the_row(spark):
    """Rows that share a key, or have none, do not share labels."""
    rows = [(None, "released under the mit license", "x"), (None, "nothing of the kind", "x"), (7, "licensed under cc by nc 4.0", "x"), (7, "plain", "x"), (7, None, "x")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, key string")
    got = sorted((r.doc_id or 0, r.labels, r.score) for r in licences.scan_licences(frame).collect())
    assert got == [(0, "", 0.0), (0, "mit,mit-notice", 1.0), (7, "", 0.0), (7, "", 0.0), (7, "cc-by,cc-by-nc", 1.0)]


def test_notices_and_places(spark):
    rows = [(1, "mit license MIT-License"), (2, "Licensed under CC BY-NC 4.0."), (3, "Permission is hereby granted, free of charge, to any person obtaining "
            "a copy of this software and associated documentation"), (4, "released under\nthe mit license"), (5, "gnu general public\nlicense"), (6, None)]
    by = {r.doc_id: r for r in licences.scan_licences(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert (by[1].n_base, by[1].first_word, by[1].last_word) == (2, 0, 2)
    assert by[2].base_labels == "cc-by" and by[2].labels == "cc-by,cc-by-nc"
    assert by[3].base_labels == "" and by[3].labels == "mit-notice" and 0.9 <= by[3].score < 1
    assert by[4].labels == "mit" and by[5].labels == "gpl" and by[5].n_base == 1
    assert by[6].n_words == 0 and by[6].first_word is None and by[6].labels == ""


def test_empty(documents):
    assert licences.scan_licences(documents[0].limit(0)).collect() == []
