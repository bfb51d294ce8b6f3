"""Licence scan: exact phrases, and an exact set-similarity join of text blocks with licence notices. DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import joined_small, read_table, stored
from .registry import query

THRESHOLD = 0.92

# Phrases and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# Label of the notice, and its words.
NOTICES = [
    ("agpl-3.0", "licensed under the gnu affero general public license version 3"),
    ("apache-2.0", "licensed under the apache license version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by-nc", "licensed under cc by nc 4.0"),
    ("cc-by-nd", "licensed under cc by nd 4.0"),
    ("cc-by-sa", "licensed under cc by sa 4.0"),
    ("cc-by-nc-sa", "licensed under cc by nc sa 4.0"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("epl-2.0", "made available under the terms of the eclipse public license v 2.0"),
    ("gpl-2.0", "licensed under the gnu general public license version 2"),
    ("gpl-3.0", "licensed under the gnu general public license version 3"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "licensed under the gnu lesser general public license version 3"),
    ("mit-notice", "released under the mit license"),
    ("mit-notice", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2.0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Characters that stand in no word.
_GAPS = r"[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_PLACE = f"(?<![^ ])(?:{'|'.join(PHRASES)})(?![^ ])"


def _words_text(column: str) -> str:
    """SQL for the words of a text, A-Z lower-cased, with single spaces between."""
    return f"trim(regexp_replace(translate({column}, '{_UPPER}', '{_LOWER}'), '{_GAPS}', ' '))"


def _count(column: str) -> str:
    return f"CASE WHEN {column} = '' THEN 0 ELSE length({column}) - length(replace({column}, ' ', '')) + 1 END"


def _list(words: list[str]) -> str:
    return "array(" + ", ".join(f"'{w}'" for w in words) + ")"


def _notice_words(text: str) -> list[str]:
    return sorted(set(text.replace(".", " ").split()))


def notice_matches(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``id, label, containment``: lines of ``docs`` (``id, text``) that hold a share of ``threshold`` of a notice's distinct words.

    Exact prefix-filter join. Words are ordered by the number of lines of all documents they stand in, rarest first; words
    of no notice cannot add to an overlap and are left out. A line and a notice that share the needed words c share one among
    the line's first |line| - c + 1 and the notice's first |notice| - c + 1; lines shorter than c, and positions from which c
    can no longer be reached, are filtered; the rest are counted in full. The index side is the list of notices.
    """
    spark = docs.sparkSession
    notices = [(label, _notice_words(text)) for label, text in NOTICES]
    vocabulary = sorted({w for _, words in notices for w in words})
    lines = docs.select("id", F.explode(F.split(F.col("text"), "\n")).alias("line")).select("id", F.expr(f"split({_words_text('line')}, ' ')").alias("words"))
    seen = lines.select(F.explode(F.expr(f"array_intersect({_list(vocabulary)}, words)")).alias("word")).groupBy("word").count()
    counts = {r["word"]: r["count"] for r in seen.collect()}  # at most the notices' words
    order = sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    index = []
    for number, (label, words) in enumerate(notices):
        words = sorted(words, key=rank.__getitem__)
        need = math.ceil(threshold * len(words) - 1e-9)
        for place in range(len(words) - need + 1):
            index.append(f"struct('{words[place]}' AS word, {number} AS notice, '{label}' AS label, {place} AS at, {need} AS need, {_list(words)} AS words)")
    index = spark.range(1).select(F.expr(f"inline(array({', '.join(index)}))"))
    fewest = min(math.ceil(threshold * len(words) - 1e-9) for _, words in notices)
    blocks = lines.select("id", F.expr(f"array_intersect({_list(order)}, words)").alias("own")).where(f"size(own) >= {fewest}")
    prefixes = blocks.select("id", "own", F.posexplode(F.expr(f"slice(own, 1, size(own) - {fewest} + 1)")).alias("place", "word"))
    met = prefixes.join(F.broadcast(index), "word").where(
        "size(own) >= need AND least(place, at) + least(size(own) - place, size(words) - at) >= need")
    checked = met.withColumn("common", F.expr("size(array_intersect(own, words))")).where("common >= need")
    return checked.groupBy("id", "label").agg(F.max(F.expr("CAST(common AS DOUBLE) / size(words)")).alias("containment"))


def scan_licences(df: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``key, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    Words are runs of digits, letters and non-ASCII characters, A-Z lower-cased. The base counts the places where a
    phrase's words stand one after another, with the smallest and largest word number (from 0) at which one starts. The
    labels are those of the phrases and of the notices that a line contains (``notice_matches``); the score is 1 with a
    phrase, else the largest containment, else 0. Labels are distinct, sorted and comma-joined.

    Notices belong to a text, not to a key: texts are known by two 64-bit hashes, so rows that share a key (a null one too)
    each get their own text's labels. Null text counts as empty; without a place the word numbers are null; an empty table
    gives an empty result; other columns are ignored.
    """
    own = F.expr(f"coalesce(CAST(`{text}` AS STRING), '')")
    rows = df.select(F.col(key).alias("key"), own.alias("text")).withColumn("id", F.struct(F.xxhash64("text").alias("a"), F.xxhash64("text", F.lit(3)).alias("b")))
    docs = rows.select("id", "text")
    labels = stored(notice_matches(docs, threshold).groupBy("id").agg(F.sort_array(F.collect_set("label")).alias("notices"), F.max("containment").alias("best")))
    words = rows.select("key", "id", F.expr(_words_text("text")).alias("norm"))
    words = words.withColumn("n_base", F.expr(
        f"CASE WHEN contains(norm, 'license') OR contains(norm, 'cc by') THEN regexp_count(norm, '{_PLACE}') ELSE 0 END"))
    before_first = f"substr(norm, 1, regexp_instr(norm, '{_PLACE}') - 1)"
    before_last = f"regexp_extract(norm, '(?s)^(.*){_PLACE}', 1)"
    spaces = "length({0}) - length(replace({0}, ' ', ''))"
    base = ", ".join(f"CASE WHEN n_base > 0 AND contains(concat(' ', norm, ' '), ' {p} ') THEN '{label}' END" for p, label in PHRASES.items())
    rows = words.select(
        "key", "id", F.expr(f"CAST({_count('norm')} AS BIGINT)").alias("n_words"), F.expr("CAST(n_base AS BIGINT)").alias("n_base"),
        F.expr(f"CASE WHEN n_base > 0 THEN CAST({spaces.format(before_first)} AS BIGINT) END").alias("first_word"),
        F.expr(f"CASE WHEN n_base > 0 THEN CAST({spaces.format(before_last)} AS BIGINT) END").alias("last_word"),
        F.expr(f"array_sort(array_compact(array({base})))").alias("found"))
    joined = joined_small(rows, labels.withColumnRenamed("id", "label_id"), F.expr("id = label_id"), "left")
    return joined.select(
        F.col("key").alias(key), "n_words", "n_base", "first_word", "last_word", F.array_join("found", ",").alias("base_labels"),
        F.expr("array_join(array_sort(array_union(found, coalesce(notices, CAST(array() AS ARRAY<STRING>)))), ',')").alias("labels"),
        F.expr("CASE WHEN n_base > 0 THEN 1.0D ELSE coalesce(best, 0.0D) END").alias("score"))


def _sql() -> str:
    words = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    places = " UNION ALL ".join(
        f"SELECT doc_id, '{label}' AS label, i - 1 AS place FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d) WHERE "
        + " AND ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(phrase.split())) for phrase, label in PHRASES.items())
    notices = ", ".join(f"('{label}', [{', '.join(repr(w) for w in _notice_words(text))}])" for label, text in NOTICES)
    return f"""
WITH d AS (SELECT doc_id, text, {words.format("coalesce(text, '')")} AS w FROM documents),
p AS ({places}),
b AS (SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, list(DISTINCT label) AS base FROM p GROUP BY doc_id),
l AS (SELECT doc_id, {words.format('line')} AS w FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)),
t AS (SELECT label, words FROM (VALUES {notices}) v(label, words)),
m AS (SELECT doc_id, list(DISTINCT label) AS notices, max(len(list_intersect(w, words)) / len(words)) AS best FROM l, t
      WHERE len(list_intersect(w, words)) >= ceil({THRESHOLD} * len(words) - 1e-9) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word,
       CAST(last_word AS BIGINT) AS last_word, coalesce(array_to_string(list_sort(base), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(notices, [])))), ','), '') AS labels,
       CAST(CASE WHEN n_base > 0 THEN 1 ELSE coalesce(best, 0) END AS DOUBLE) AS score
FROM d LEFT JOIN b USING (doc_id) LEFT JOIN m USING (doc_id)
"""


@query("op3_license_scan", _sql())
def op3_license_scan(spark, folder):
    return scan_licences(read_table(spark, folder, "documents"))
