"""Personal data: overlapping candidate spans scored by boosted trees. DataFrame functions only on the rows' path.

The trees are fitted on the driver from a few hundred labelled lines that a rule writes, with features computed by the same
DataFrame expressions as for documents, and run as SQL expressions.
"""

from __future__ import annotations

import json
import math
import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table
from .registry import query

# Every pattern is the stated one with possessive repeats and, where it begins with an unbounded run, an anchor at the run's
# start (or where the last match ended): the same matches without quadratic scans or deep recursion.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}+",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Generators of further candidates; ``key`` (credentials) is a kind of its own.
MORE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:\[at\]|\(at\)| at ) ?[A-Za-z0-9-]++(?: ?(?:\[dot\]|\(dot\)|\.| dot ) ?[A-Za-z0-9-]++)++",
    "card": r"(?<![0-9A-Za-z])[0-9](?:[./_]?[0-9])++(?![A-Za-z])",
    "phone": r"(?<![0-9A-Za-z.+-])\(?[0-9]{2,4}\)?[ .-][0-9]{2,4}(?:[ .-][0-9]{2,5}){1,3}(?![0-9A-Za-z])",
    "key": r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}+",
}
KINDS = ["email", "ip", "card", "phone", "key"]
PRECISION = 0.95   # of the spans a threshold lets through, on the labelled lines kept for calibration
TREES, DEPTH, RATE = 25, 3, 0.3
CONTEXT = 32       # characters before and after a span that features look at

_CUES = {
    "cue_mail": "mail|contact|write to|reach",
    "cue_phone": "phone|tel|call|mobile|fax|dial",
    "cue_card": "card|visa|master|amex|credit|payment",
    "cue_key": "token|key|secret|passw|bearer|credential|auth",
    "cue_other": "version|order|invoice|isbn|page|date|commit|checksum|serial|ticket|build",
}
FEATURES = {
    **{f"is_{k}": f"CAST(c.kind = '{k}' AS DOUBLE)" for k in KINDS},
    "length": "CAST(least(length(c.value), 200) AS DOUBLE)",
    "digits": "CAST(least(length(regexp_replace(c.value, '[^0-9]', '')), 100) AS DOUBLE)",
    "letters": "CAST(least(length(regexp_replace(c.value, '[^A-Za-z]', '')), 100) AS DOUBLE)",
    "capitals": "CAST(least(length(regexp_replace(c.value, '[^A-Z]', '')), 100) AS DOUBLE)",
    "beyond_hex": "CAST(least(length(regexp_replace(c.value, '[0-9a-fA-F]', '')), 100) AS DOUBLE)",
    "changes": "CAST(least(length(regexp_replace(regexp_replace(c.value, '[0-9]+', '0'), '[A-Za-z]+', 'a')), 100) AS DOUBLE)",
    "luhn": "CASE WHEN length(c.value) <= 40 AND luhn_check(regexp_replace(c.value, '[^0-9]', '')) THEN 1.0D ELSE 0.0D END",
    "bracket": "CAST(contains(c.value, '(') OR contains(c.value, '[') AS DOUBLE)",
    "assigned": r"CAST(c.before RLIKE '[=:][ \"]*$' AS DOUBLE)",
    **{name: f"CAST(lower(c.before) RLIKE '{cue}' AS DOUBLE)" for name, cue in _CUES.items()},
}


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


#: Matches whose offsets are added up together, and characters of text whose spans are compared together.
STRETCH, WINDOW = 512, 8192


def _with(value: str, name: str, body: str) -> str:
    """SQL for ``body`` with ``name`` standing for ``value``, which is evaluated once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _offsets(widths: str) -> str:
    """SQL for the sums of the widths before each: of whole stretches first, then inside them, so no list grows longer than a stretch."""
    grown = "named_struct('at', {at}, 'list', CAST(array() AS ARRAY<INT>)), (a, {v}) -> named_struct('at', a.at + {add}, 'list', concat(a.list, array(a.at))), a -> a.list"
    part = f"slice(w, CAST(k AS INT) * {STRETCH} + 1, {STRETCH})"
    stretches = (f"aggregate(sequence(0, CAST((size(w) - 1) DIV {STRETCH} AS INT)), "
                 + grown.format(at="0", v="k", add=f"aggregate({part}, 0, (x, y) -> x + y)") + ")")
    inside = f"flatten(transform({stretches}, (o, k) -> aggregate({part}, {grown.format(at='o', v='y', add='y')})))"
    return _with(widths, "w", inside)


def _spans(matches: str, gaps: str, kind: str, base: bool) -> str:
    """SQL for the spans of one pattern: offsets are running sums of the gaps and matches before each."""
    widths = f"transform({matches}, (m, i) -> length({gaps}[i]) + length(m))"
    return (f"CASE WHEN size({matches}) = 0 THEN CAST(array() AS ARRAY<STRUCT<rank: INT, start: INT, `end`: INT, kind: STRING, value: STRING, base: BOOLEAN>>) "
            f"ELSE transform({_offsets(widths)}, (s, i) -> struct({KINDS.index(kind)} AS rank, s + length({gaps}[i]) AS start, "
            f"s + length({gaps}[i]) + length({matches}[i]) AS `end`, '{kind}' AS kind, {matches}[i] AS value, {'true' if base else 'false'} AS base)) END")


def _near(spans: str) -> str:
    """SQL for those of ``spans`` that the spans ``mine``, which start in window ``v``, may meet."""
    return f"filter({spans}, b -> b.`end` > v * {WINDOW} AND b.start < coalesce(array_max(transform(mine, c -> c.`end`)), 0))"


def _apart() -> str:
    """SQL for the spans of ``found`` that meet none of ``base``, with the text before them, window by window of the text."""
    inside = f"filter(z.found, c -> c.start DIV {WINDOW} = v)"
    first = f"greatest(v * {WINDOW} - {CONTEXT}, 0)"
    before = f"substr(stretch, greatest(c.start - {CONTEXT}, 0) - {first} + 1, least(c.start, {CONTEXT}))"
    kept = (f"transform(filter(mine, c -> NOT exists(near, b -> b.start < c.`end` AND c.start < b.`end`)), "
            f"c -> struct(c.rank, c.start, c.`end`, c.kind, c.value, {before} AS before))")
    window = _with(inside, "mine", _with(_near("z.base"), "near", _with(f"substr(z.text, {first} + 1, {WINDOW + CONTEXT})", "stretch", kept)))
    return _with("struct(base, found, text)", "z", f"flatten(transform(sequence(0, CAST(length(z.text) DIV {WINDOW} AS INT)), v -> {window}))")


_KEEP = {
    "email": "true",
    "ip": "forall(split(c.value, '[.]'), p -> length(ltrim('0', p)) <= 3 AND CAST(concat('0', right(ltrim('0', p), 3)) AS INT) <= 255)",
    "card": "length(regexp_replace(c.value, '[^0-9]', '')) BETWEEN 13 AND 19 AND luhn_check(regexp_replace(c.value, '[^0-9]', ''))",
    "phone": "length(regexp_replace(c.value, '[^0-9]', '')) BETWEEN 9 AND 15",
}
#: What a further candidate must at least be to get a score.
_PLAUSIBLE = {
    "email": "true",
    "card": "length(regexp_replace(c.value, '[^0-9]', '')) BETWEEN 13 AND 19",
    "phone": "length(regexp_replace(c.value, '[^0-9]', '')) BETWEEN 8 AND 15",
    "key": "c.value RLIKE '[0-9]' AND c.value RLIKE '[A-Za-z]'",
}


def candidates(docs: DataFrame) -> DataFrame:
    """Adds ``base`` and ``more`` to ``docs`` (with ``text``, not null): arrays of spans, the checked base ones and the other candidates."""
    found = docs
    for name, patterns in (("b", BASE), ("m", MORE)):
        for kind, pattern in patterns.items():
            cheap = {"email": "contains(text, '@')" if name == "b" else "text RLIKE '(?i)at'", "ip": "contains(text, '.')", "card": "true",
                     "phone": "contains(text, '+')" if name == "b" else "true", "key": "true"}[kind]
            found = found.withColumn(f"{name}_{kind}", F.expr(
                f"CASE WHEN {cheap} THEN regexp_extract_all(text, {_quoted(pattern)}, 0) ELSE CAST(array() AS ARRAY<STRING>) END"))
    for name, patterns in (("b", BASE), ("m", MORE)):
        for kind, pattern in patterns.items():
            found = found.withColumn(f"{name}_{kind}_gaps", F.expr(
                f"CASE WHEN size({name}_{kind}) > 0 THEN split(text, {_quoted(pattern)}, -1) END"))
    base = ", ".join(f"filter({_spans(f'b_{k}', f'b_{k}_gaps', k, True)}, c -> {_KEEP[k]})" for k in BASE)
    more = ", ".join(f"filter({_spans(f'm_{k}', f'm_{k}_gaps', k, False)}, c -> {_PLAUSIBLE[k]})" for k in MORE)
    return found.select(*docs.columns, F.expr(f"concat({base})").alias("base"), F.expr(f"concat({more})").alias("found")).withColumn(
        "more", F.expr(_apart())).drop("found")


def labelled_lines(seed: int = 13, rounds: int = 60) -> list[tuple[str, str, int]]:
    """(line, kind, label): lines that a rule writes, each with one candidate of the kind that is personal data (1) or is not (0)."""
    rng = random.Random(seed)

    def digits(n):
        return "".join(rng.choice("0123456789") for _ in range(n))

    def card(valid):
        body = digits(15)
        for last in "0123456789":
            total = sum(int(c) if i % 2 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(body)) + int(last)
            if (total % 10 == 0) == valid:
                return body + last

    def word():
        return "".join(rng.choice("abdefghilmnoprstu") for _ in range(rng.randint(3, 9)))

    def grouped(d, sep):
        return sep.join(d[i:i + 4] for i in range(0, 16, 4))

    out = []
    for _ in range(rounds):
        sep = rng.choice(["./", "_", "."])[0]
        phone = rng.choice([f"({digits(3)}) {digits(3)}-{digits(4)}", f"{digits(3)}-{digits(3)}-{digits(4)}", f"{digits(3)} {digits(3)} {digits(4)}"])
        at, dot = rng.choice([(" [at] ", " [dot] "), ("(at)", "(dot)"), (" at ", " dot ")])
        secret = rng.choice(["".join(rng.choice("0123456789abcdef") for _ in range(40)),
                             "".join(rng.choice("0123456789abcdefghijkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ") for _ in range(32))])
        filler = f"{word()} {word()}"
        out += [
            (f"{filler} {rng.choice(['call', 'phone:', 'tel.', 'my mobile is', 'fax'])} {phone} {word()}", "phone", 1),
            (f"{filler} {rng.choice(['version', 'order', 'page', 'date', 'serial', ''])} {digits(2)}-{digits(2)}-{digits(4)} {word()}", "phone", 0),
            (f"{filler} {rng.choice(['ticket', 'invoice', 'isbn', 'build', ''])} {digits(3)} {digits(3)} {digits(4)} {word()}", "phone", 0),
            (f"{filler} {rng.choice(['mail', 'contact', 'write to', 'reach me:', ''])} {word()}.{word()}{at}{word()}{dot}com {word()}", "email", 1),
            (f"{filler} {rng.choice(['', 'look', 'we met'])} {word()} at {word()}.{rng.choice('ABC')}{word()} {word()}", "email", 0),
            (f"{filler} {rng.choice(['card', 'visa', 'payment', 'credit card no.'])} {grouped(card(True), sep)} {word()}", "card", 1),
            (f"{filler} {rng.choice(['order', 'serial', 'build', ''])} {grouped(card(False), sep)} {word()}", "card", 0),
            (f'{filler} {rng.choice(["token =", "api_key:", "secret =", "password:", "auth ="])} "{secret}" {word()}', "key", 1),
            (f"{filler} {rng.choice(['commit', 'checksum', 'build', 'serial'])} {secret} {word()}", "key", 0),
            (f"{filler} {rng.choice(['', 'see'])} {word()}_{word()}_{word()}_{word()}_{word()}{digits(1)} {word()}", "key", 0),
        ]
    return out


class Trees:
    """Gradient boosted regression trees for the logistic loss; small data, exact splits."""

    def __init__(self, x: list[list[float]], y: list[int]):
        self.trees, score = [], [0.0] * len(y)
        for _ in range(TREES):
            p = [1 / (1 + math.exp(-s)) for s in score]
            tree = self._grow(x, [t - q for t, q in zip(y, p)], [q * (1 - q) for q in p], list(range(len(y))), DEPTH)
            self.trees.append(tree)
            score = [s + self._walk(tree, r) for s, r in zip(score, x)]

    def _grow(self, x, g, h, rows, depth):
        total_g, total_h = sum(g[r] for r in rows), sum(h[r] for r in rows)
        best = None
        if depth and len(rows) > 4:
            for f in range(len(x[0])):
                order = sorted(rows, key=lambda r: x[r][f])
                left_g = left_h = 0.0
                for a, b in zip(order, order[1:]):
                    left_g += g[a]
                    left_h += h[a]
                    if x[a][f] == x[b][f]:
                        continue
                    gain = left_g ** 2 / (left_h + 1) + (total_g - left_g) ** 2 / (total_h - left_h + 1) - total_g ** 2 / (total_h + 1)
                    if best is None or gain > best[0] + 1e-12:
                        best = (gain, f, (x[a][f] + x[b][f]) / 2)
        if best is None or best[0] < 1e-6:
            return RATE * total_g / (total_h + 1)
        _, f, cut = best
        return (f, cut, self._grow(x, g, h, [r for r in rows if x[r][f] <= cut], depth - 1),
                self._grow(x, g, h, [r for r in rows if x[r][f] > cut], depth - 1))

    def _walk(self, tree, row):
        while isinstance(tree, tuple):
            tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
        return tree

    def probability(self, row: list[float]) -> float:
        return 1 / (1 + math.exp(-sum(self._walk(t, row) for t in self.trees)))

    def sql(self, names: list[str]) -> str:
        def node(t):
            return f"CASE WHEN f.{names[t[0]]} <= {t[1]!r}D THEN {node(t[2])} ELSE {node(t[3])} END" if isinstance(t, tuple) else f"{t!r}D"
        return "1.0D / (1.0D + exp(-(" + " + ".join(node(t) for t in self.trees) + ")))"


def _features() -> str:
    return "struct(" + ", ".join(f"{text} AS {name}" for name, text in FEATURES.items()) + ")"


def fit(spark: SparkSession) -> tuple[Trees, dict[str, float]]:
    """Trees from half of the labelled lines, and per kind the lowest threshold with ``PRECISION`` on the other half."""
    lines = labelled_lines()
    text = json.dumps([{"n": i, "text": t} for i, (t, _, _) in enumerate(lines)])
    docs = spark.range(1).select(F.inline(F.from_json(F.lit(text), "array<struct<n: int, text: string>>")))
    rows = candidates(docs).select("n", F.explode("more").alias("c")).select("n", "c.kind", F.expr(_features()).alias("f")).collect()
    data = [(r["n"], r["kind"], list(r["f"]), lines[r["n"]][2] if r["kind"] == lines[r["n"]][1] else 0) for r in rows]
    data.sort(key=lambda d: (d[0], d[1], d[2]))
    fitted = [d for d in data if d[0] // 10 % 2 == 0]
    trees = Trees([d[2] for d in fitted], [d[3] for d in fitted])
    cuts = {}
    for kind in KINDS:
        held = sorted(((trees.probability(d[2]), d[3]) for d in data if d[0] // 10 % 2 and d[1] == kind), reverse=True)
        cuts[kind], good = 1.01, 0
        for n, (p, label) in enumerate(held, 1):
            good += label
            if good / n >= PRECISION and p >= 0.5 and (n == len(held) or held[n][0] < p):
                cuts[kind] = p
    return trees, cuts


def find_pii(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, base, added``: arrays of personal data spans (``rank, start, end, kind, ...``) in the whole text of every row.

    ``base`` has the matches of the stated patterns that pass their checks, leftmost and non-overlapping per kind, kinds in
    order. Further generators propose overlapping candidates of high recall; boosted trees score them from their format and
    context, and those at their kind's calibrated threshold that overlap no base span, and no better added one, are ``added``.
    Offsets are code points, the end exclusive.

    Null text counts as empty; empty text has no spans; ties between added spans go to the earlier kind, then start; null
    keys and repeated rows are searched each; an empty table gives an empty result; other columns are ignored. A row's spans
    are built in its own task: nothing is shuffled.
    """
    trees, cuts = fit(df.sparkSession)
    docs = df.select(F.col(key).alias("id"), F.expr(f"coalesce(CAST(`{text}` AS STRING), '')").alias("text"))
    rows = candidates(docs).withColumn("more", F.expr(f"transform(more, c -> struct(c.rank, c.start, c.`end`, c.kind, {_features()} AS f))"))
    score = trees.sql(list(FEATURES)).replace("f.", "c.f.")
    rows = rows.withColumn("scored", F.expr(f"transform(more, c -> struct(c.rank, c.start, c.`end`, c.kind, {score} AS score))"))
    cut = "CASE s.kind " + " ".join(f"WHEN '{k}' THEN {v!r}D" for k, v in cuts.items()) + " END"
    rows = rows.withColumn("passed", F.expr(f"filter(scored, s -> s.score >= {cut})"))
    better = "(b.score > s.score OR (b.score = s.score AND (b.rank < s.rank OR (b.rank = s.rank AND b.start < s.start))))"
    best = f"filter(mine, s -> NOT exists(near, b -> b.start < s.`end` AND s.start < b.`end` AND {better}))"
    added = _with("passed", "z", f"flatten(transform(sequence(0, CAST(coalesce(array_max(transform(z, s -> s.`end`)), 0) DIV {WINDOW} AS INT)), v -> "
                  + _with(f"filter(z, s -> s.start DIV {WINDOW} = v)", "mine", _with(_near("z"), "near", best)) + "))")
    added = f"array_sort({added})"
    return rows.select(F.col("id").alias(key), "base", F.expr(added).alias("added"))


@query("op6_pii_spans")
def op6_pii_spans(spark, folder):
    found = find_pii(read_table(spark, folder, "documents"))
    told = "transform({}, s -> concat_ws(':', s.kind, s.start, s.`end`))"
    spans = "array_sort(concat(transform(base, s -> struct(s.rank, s.start, s.`end`, s.kind)), transform(added, s -> struct(s.rank, s.start, s.`end`, s.kind))))"
    return found.select(
        "doc_id", *[F.expr(f"CAST(size(filter(base, s -> s.kind = '{k}')) AS BIGINT)").alias(f"n_{k}") for k in BASE],
        F.expr(f"sha2(array_join({told.format('base')}, ','), 256)").alias("base_sha256"),
        F.expr(f"array_join({told.format(spans)}, ',')").alias("spans"), F.expr("CAST(size(added) AS BIGINT)").alias("n_added"))
