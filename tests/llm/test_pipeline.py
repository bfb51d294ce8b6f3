import corpus_pipeline
from tallyloom.llm.jaccard import near_duplicates


def test_stages(documents, spark, tmp_path):
    frame, _ = documents
    docs = frame.select(corpus_pipeline.COLUMNS)
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    item = benchmark.orderBy("item_id").first()
    leak = docs.where("doc_id = 30").selectExpr("7001L AS doc_id", f"concat(text, '\\n', \"{item.text}\") AS text", "lang", "source", "n_chars")
    near = docs.where("doc_id = 20").selectExpr("7002L AS doc_id", "concat(text, ' noch') AS text", "lang", "source", "n_chars")
    folder = str(tmp_path)
    docs.unionAll(leak).unionAll(near).write.parquet(f"{folder}/documents.parquet")
    benchmark.write.parquet(f"{folder}/benchmark.parquet")
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    before = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, folder)
        kept[name] = {r.doc_id for r in after.select("doc_id").collect()}
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == before.columns == corpus_pipeline.COLUMNS
            path = f"{folder}/{name}"
            after.write.parquet(path)
            before = spark.read.parquet(path)
    assert not {1001, 1002, 1003, 1008} & kept["language"] and {0, 1, 1004, 7001, None} <= kept["language"]
    assert 7001 in kept["lines"] and 1005 not in kept["lines"]
    text = spark.read.parquet(f"{folder}/lines")
    classes = near_duplicates(text).collect()
    assert kept["near_duplicates"] == {r.doc_id for r in classes if r.doc_id is None or r.class_id == r.doc_id}
    assert 7001 not in kept["leaks"] and kept["mix"] == kept["leaks"]


def test_empty_table(documents, spark, tmp_path):
    folder = str(tmp_path)
    documents[0].select(corpus_pipeline.COLUMNS).limit(0).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).collect() == []


def test_even_code_switching_stays(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(corpus_pipeline.COLUMNS)
    parts = [r.text.replace("\n", " ").split() for r in docs.where("n_chars BETWEEN 900 AND 4000").dropDuplicates(["lang"]).collect()]
    assert len(parts) == 4
    rows = [(-7, " ".join(w for p in parts for w in p[:60]), None, None, None)]
    kept = corpus_pipeline.label_languages(spark, docs.unionAll(spark.createDataFrame(rows, docs.schema)), "")
    assert kept.where("doc_id = -7").count() == 1


def test_repeated_rows_and_null_ids(spark):
    one, two = (" ".join(f"{w}{i}" for i in range(60)) for w in ("wort", "other"))
    rows = [(1, one), (1, one.upper()), (1, one), (2, one + " noch"), (3, two), (6, two + " more"), (None, two), (None, two), (4, None), (4, None), (5, " ")]
    docs = spark.createDataFrame([(k, t, "de", "s", 1) for k, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in kept) == sorted((str(k), str(t)) for k, t in [
        (1, one.upper()), (3, two), (None, two), (4, None), (4, None), (5, " ")])
