"""Byte-level BPE against the tiktoken library, word by word, text by text and as a query."""

import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyloom.llm import tokens
from tallyloom.llm.catalog import QUERIES

from .conftest import SF

RANKS = tokens.load_ranks()
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
SPLIT = tokens.splitter(public_tokenizers.PATTERN)


def toy_ranks(*merges):
    """All single bytes, then the given tokens in order."""
    return {**{bytes([b]): b for b in range(256)}, **{m: 256 + k for k, m in enumerate(merges)}}


@given(st.lists(st.text(alphabet="abcdeéß漢 \n\t0129'.-", min_size=1, max_size=40), max_size=6))
@settings(max_examples=60, deadline=None)
def test_replay_of_words(words):
    words = [w.encode() for w in words]
    assert tokens.replay(words, RANKS) == [LIBRARY.encode_single_piece(w) if hasattr(LIBRARY, "encode_single_piece") else LIBRARY._encode_single_piece(w) for w in words]


@given(st.lists(st.binary(min_size=1, max_size=24).map(lambda b: bytes(97 + x % 3 for x in b)), max_size=5),
       st.lists(st.binary(min_size=2, max_size=5).map(lambda b: bytes(97 + x % 3 for x in b)), max_size=14, unique=True))
@settings(max_examples=150, deadline=None)
def test_ranks_in_any_order(words, merges):
    """Also for rank files in which a merge makes a pair of a smaller rank than its own."""
    ranks = toy_ranks(*merges)
    library = tiktoken.Encoding("toy", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    assert tokens.replay(words, ranks) == [library.encode_ordinary(w.decode()) for w in words]


@given(st.text(alphabet=st.characters(exclude_categories=("Cs",)), max_size=60), st.text(alphabet="ab 'st\n\t.,9é\u2009ſ漢٣", max_size=60))
@settings(max_examples=150, deadline=None)
def test_written_classes_split_alike(any_text, common):
    for text in (any_text, common, common + any_text):
        assert SPLIT(text) == tokens.regex.findall(public_tokenizers.PATTERN, text)


def test_every_code_point_splits_alike():
    for limit in (0x250, 0x10000, 0x20000):
        text = "".join(f" {chr(c)}{chr(c)}" for c in range(limit) if not 0xD800 <= c < 0xE000)
        assert SPLIT(text) == tokens.regex.findall(public_tokenizers.PATTERN, text)
    assert tokens.splitter(r"\w+|\W")("a b") == ["a", " ", "b"]


def test_slabs(monkeypatch):
    words = [w.encode() for w in "one two three four five six seven extraordinarily".split()]
    monkeypatch.setattr(tokens, "SLAB_BYTES", 9)
    assert list(tokens.replayed(words, RANKS)) == tokens.replay(words, RANKS)


def test_words_apart_and_runs():
    ranks = toy_ranks(b"aa", b"aab", b"ab")
    assert tokens.replay([b"aaa", b"a", b"", b"aab", b"caab"], ranks) == [[256, 97], [97], [], [257], [99, 257]]
    long = b"ab" * 30_000
    assert tokens.replay([long], ranks) == [[258] * 30_000]


@pytest.mark.parametrize("held", [tokens.HELD_WORDS, 40, 0])
def test_texts_equal_the_library(spark, documents, held):
    """With all words held, with few and with none, the ids are the same; nulls, repeats and clashing columns included."""
    frame, _ = documents
    rows = [(r["doc_id"], r["text"] or "") for r in frame.select("doc_id", "text").collect()]
    got = [(r["doc_id"], list(r["ids"])) for r in tokens.encode(frame, held=held).collect()]
    place = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(got, key=place) == sorted([(k, LIBRARY.encode_ordinary(t)) for k, t in rows], key=place)


def test_round_trip_and_empty_table(spark):
    texts = [None, "", "<|endoftext|>", "  two  spaces \r\n\n x", "\u0000 　", "a" * 5000, "123456 I'll we've 'S", "🙂👩‍👩‍👧 नमस्ते"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (list(r["ids"]), bytes(r["bytes"])) for r in tokens.decode(tokens.encode(frame)).collect()}
    assert got == {k: (LIBRARY.encode_ordinary(t or ""), (t or "").encode()) for k, t in enumerate(texts)}
    assert tokens.encode(frame.where("false")).count() == 0
    given = spark.createDataFrame([(1, None), (2, []), (3, [104, 105])], "doc_id long, ids array<int>").coalesce(1)
    assert [r["bytes"] and bytes(r["bytes"]) for r in tokens.decode(given, ranks=toy_ranks()).orderBy("doc_id").collect()] == [None, b"", b"hi"]


def test_query(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    for r in QUERIES["op13_byte_bpe"](spark, SF).collect():
        ids = LIBRARY.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts.pop(r["doc_id"]).encode()).hexdigest()
    assert not texts
