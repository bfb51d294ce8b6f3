import duckdb
import pytest

SF = "/root/testdata/sf0.001"
#: Names that operators use inside, as extra columns of their input.
CLASHES = ["id", "row", "size", "h", "component", "rep", "words", "items", "held_out", "window", "label_id", "base", "_gone"]


@pytest.fixture(scope="session")
def documents(spark, tmp_path_factory):
    """The smallest documents table with awkward rows and extra columns, written once; returns (frame, path)."""
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(120).collect()]
    own = ("Edle Worte ruhen still im Haus und warten auf den Abend, der noch lange nicht kommt.\n"
           "Mail: a.b@c.example.org und 10.0.0.256 oder 10.0.0.255, Karte 4111 1111 1111 1111, Tel. +49 (30) 123-4567.\n"
           "This work is licensed under the GNU General Public License, version 3.\nUnder the MIT License and CC-BY.")
    longest = " ".join(f"wort{i % 977} und{i}" for i in range(30_000))
    rows += [
        (1001, None, "en", "s1", None), (1002, "", "en", None, 0), (1003, " \n\t ", None, None, 4), (1004, own, "de", "s1", 1), (1005, own, "de", "s1", 1),
        (1005, own, "de", "s1", 1), (1006, own + " Ende.", None, "s2", None), (1007, longest, "de", "s2", 1), (1008, "1234 !!! 5678", "en", "s2", 2),
        (1009, "Ünd", "de", "s3", 3), (None, own, "de", "s3", 1), (None, None, None, None, None), (1010, "über ÜBER\\n \\x00 `quoted` 'text' %s", "de", "é", 1),
        (1011, "mit license mit license apache license cc by cc by", "en", "\U0001F600", 1),
    ]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{c}` string" for c in CLASHES)
    frame = spark.createDataFrame([r + ("x",) * len(CLASHES) for r in rows], schema).repartition(3)
    path = str(tmp_path_factory.mktemp("docs"))
    frame.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path), path


@pytest.fixture
def duck():
    """Runs a statement over Parquet folders given by table name."""
    def run(sql, **paths):
        con = duckdb.connect()
        for name, path in paths.items():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}/*.parquet'")
        got = con.execute(sql)
        names = [d[0] for d in got.description]
        return names, got.fetchall()
    return run


def same_rows(frame, names, rows):
    """Whether a frame has the given rows in any order, floats to 12 digits."""
    def cell(v):
        return (v is None, f"{v:.12g}" if isinstance(v, float) else str(v))
    got = sorted(tuple(cell(r[n]) for n in names) for r in frame.collect())
    assert got == sorted(tuple(cell(v) for v in row) for row in rows)
