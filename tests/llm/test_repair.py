"""Conversation repair against all edits step by step, and against SQL."""

import hashlib
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyloom.llm import repair as rp
from tallyloom.llm.catalog import ORACLES, QUERIES

from .conftest import CLASHES, SF, same_rows

BLANKS = " \t\n\x0b\x0c\r"


def faults(turns):
    seen, out = set(), []
    for role, text in turns:
        bare = text.rstrip(BLANKS)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def brute(turns):
    """(cost, audit, lines): the cheapest edits by trying every edit in every state, whole audits compared."""
    follow = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    best = {"": (0, "", ())}
    for (role, text), fault in [*zip(turns, faults(turns)), ((None, None), None)]:
        # Insertions, as many as there are states.
        for _ in range(4):
            for state, (cost, audit, lines) in list(best.items()):
                for name in ("user", "assistant"):
                    to = follow.get((state, name[0]))
                    now = (cost + 2, audit + "I", (*lines, f"{name}:"))
                    if to and (to not in best or now[:2] < best[to][:2]):
                        best[to] = now
        if role is None:
            break
        after = {}
        for state, (cost, audit, lines) in best.items():
            ways = [(3, "D", state, lines)]
            if fault in ("", "truncated"):
                extra = fault == "truncated"
                ways += [(2 + extra, "R", follow.get((state, n[0])), (*lines, f"{n}:{text}")) for n in ("user", "assistant")]
                ways.append((extra, "K", follow.get((state, role[:1])), (*lines, f"{role}:{text}")))
            for price, letter, to, left in ways:
                now = (cost + price, audit + letter, left)
                if to is not None and (to not in after or now[:2] < after[to][:2]):
                    after[to] = now
        best = after
    return min((b for s, b in best.items() if s in ("", "a")), key=lambda b: b[:2])


KIND = st.integers(0, len(rp.KINDS) - 1)


def as_turns(kinds):
    """Turns with exactly these kinds; duplicates repeat a first turn that every list begins with."""
    out = []
    for k, (initial, fault) in enumerate(rp.KINDS[x] for x in kinds):
        role = {"s": "system", "u": "user", "a": "assistant", "": "tool"}[initial]
        out.append((role, {"": f"{k}.", "truncated": f"{k}", "blank": " ", "duplicate": "again."}[fault]))
    return [*[(r, "again.") for r in ("system", "user", "assistant", "tool")], *out]


def kinds_of(turns):
    return [rp.KINDS.index((r[:1] if r[:1] in "sua" else "", f)) for (r, _), f in zip(turns, faults(turns))]


@given(st.lists(KIND, max_size=14))
@settings(max_examples=200, deadline=None)
def test_divide_and_conquer_equals_all_edits(kinds):
    turns = as_turns(kinds)
    states = rp.crossings([rp.summary(kinds_of(turns))])
    audit = "".join(rp.hirschberg(kinds_of(turns), states[0], states[1])) + rp.TAILS[states[1]]
    cost, want, _ = brute(turns)
    assert audit == want
    assert cost == rp.summary(kinds_of(turns))[0][states[1]] + 2 * len(rp.TAILS[states[1]])


@given(st.lists(KIND, min_size=1, max_size=24), st.lists(st.integers(1, 6), min_size=8, max_size=8))
@settings(max_examples=150, deadline=None)
def test_parts_of_any_length_give_the_same_audit(kinds, lengths):
    whole = rp.crossings([rp.summary(kinds)])
    want = "".join(rp.hirschberg(kinds, *whole)) + rp.TAILS[whole[-1]]
    parts, at = [], 0
    while at < len(kinds):
        step = lengths[len(parts) % len(lengths)]
        parts.append(kinds[at:at + step])
        at += step
    states = rp.crossings([rp.summary(p) for p in parts])
    got = "".join("".join(rp.hirschberg(p, a, b)) for p, a, b in zip(parts, states, states[1:]))
    assert got + rp.TAILS[states[-1]] == want


def expected(rows):
    """Reports of (conv, turn, role, text) rows that are not damaged any more."""
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, " " if role is None else role, " " if text is None else text))
    out = []
    for conv, turns in convs.items():
        turns.sort()
        numbers = [t[1] for t in turns if t[0]]
        said = [t[2:] for t in turns]
        kinds = faults(said)
        cost, audit, lines = brute(said)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:]))
        out.append((conv, max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")),
                    illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def awkward():
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi"), (1, 1, "user", "Hi"), (1, 2, "assistant", "Hello."), (1, 9, "assistant", "Hello."),
            (2, None, None, None), (2, None, "user", "x?"), (None, 1, "user", "who?"), (None, None, "assistant", "me."), (3, 5, "", ""),
            (4, 0, "assistant", "First. \n"), (4, 1, "tool", "made."), (4, 1, "system", "late."), (5, -3, "user", "é" * 9000), (5, 7, "assistant", "yes!" + " " * 5000)]
    rows += [(6, k % 700, ("user", "assistant", "system", "user", "x")[k * k % 5], f"t{k % 260}" + ("." if k % 3 else "")) for k in range(3000)]
    rows += [(7, 3, "user", "same.")] * 900
    return rows


@pytest.mark.parametrize("parts", [1, 7])
def test_reports_on_awkward_conversations(spark, parts):
    """Long conversations over many ranges, nulls, ties, repeated rows and clashing columns."""
    held = spark.conf.get("spark.sql.shuffle.partitions")
    names = [*CLASHES, "conv", "part", "seq", "edit", "state", "turns", "copies"]
    frame = spark.createDataFrame([r + ("x",) * len(names) for r in awkward()],
                                  "conv_id long, turn long, role string, text string, " + ", ".join(f"`{c}` string" for c in names))
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        edits = rp.stored(rp.repair(frame))
        same_rows(rp.repair_report(edits, frame), ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"], expected(awkward()))
        left = {}
        for r in rp.repaired_turns(edits).collect():
            left.setdefault(r["conv"], []).append((r["turn"], f"{r['role']}:{r['text']}"))
        digests = {e[0]: e[-1] for e in expected(awkward())}
        for conv, lines in left.items():
            lines.sort()
            assert [n for n, _ in lines] == list(range(len(lines)))
            key = None if conv == -(1 << 63) else conv
            assert hashlib.sha256("\n".join(x for _, x in lines).encode()).hexdigest() == digests[key]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", held)


def test_empty_table_and_emptied_conversations(spark):
    frame = spark.createDataFrame(awkward()[:3], "conv_id long, turn long, role string, text string")
    got = rp.repair_report(rp.repair(frame.where("false")), frame).collect()
    assert [tuple(r) for r in got] == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert rp.repair_report(rp.repair(frame.where("false")), frame.where("false")).count() == 0


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        elif kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        elif kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def test_query_equals_brute_force_and_sql(spark, duck, tmp_path):
    tables = {"small": [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()],
              "awkward": [r for r in awkward() if r[0] != 7][:400]}
    for name, rows in tables.items():
        folder = tmp_path / name
        spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{folder}/conversations.parquet")
        got = QUERIES["op12_conversation_repair"](spark, str(folder))
        hurt = expected(damage(rows))
        gone = {r[0] for r in rows} - {h[0] for h in hurt}
        empty = hashlib.sha256(b"").hexdigest()
        same_rows(got, got.columns, hurt + [(c, 0, 0, 0, 0, 0, 0, "", empty) for c in gone])
        names, want = duck(ORACLES["op12_conversation_repair"], conversations=f"{folder}/conversations.parquet")
        assert set(names) == set(got.columns)
        same_rows(got, names, want)
