import hashlib
import random
from collections import defaultdict

from tallyloom.llm import chats


def digest(texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def test_escape_is_reversible():
    for text in ["", "\\", "\\\\s>", "<|turn|>", "</s>[INST] ok [/INST]", "<\\|turn|>", "<|end|", "a<s>b<|says|>\\<|end|>\n"] + chats.CONTROLS:
        safe = chats.escaped(text)
        assert chats.unescaped(safe) == text and not any(c in safe for c in chats.CONTROLS)


def test_round_trip_of_awkward_conversations(spark):
    rows = [(1, 0, "system", "be <|end|> brief"), (1, 1, "user", None), (1, 2, "assistant", "a" * 10), (2, None, None, "x"), (2, 3, "assistant", ""), (2, 3, "user", "tie"),
            (None, 1, "assistant", "y\\"), (None, 2, "user", "<s>"), (3, 1, "assistant", "same"), (3, 1, "assistant", "same"), (5, 0, "assistant", "w " * 40_000)]
    rows += [(4, i, "system" if i == 0 else ("user", "assistant")[i % 2], f"turn {i} " + "word " * (i % 37)) for i in range(700)]
    frame = spark.createDataFrame([r + ("x", "y", "z") for r in rows], "conv_id bigint, turn bigint, role string, text string, window string, conv string, part string").repartition(5)
    windows = chats.format_chats(frame)
    got = {r.conv_id: r for r in chats.read_back(windows).collect()}
    talks = defaultdict(list)
    for c, t, role, text in rows:
        talks[c].append((t is not None, t or 0, role or "", text or ""))
    assert set(got) == set(talks)
    for c, turns in talks.items():
        turns.sort()
        own = [t for _, _, r, t in turns if r == "assistant"]
        assert got[c].n_turns == len(turns) and got[c].turns_sha256 == digest(f"{r}\n{t}\n" for _, _, r, t in turns)
        assert got[c].loss_chars == sum(map(len, own)) and got[c].loss_sha256 == digest(own)
    for r in windows.where("conv_id = 4").orderBy("window").collect():
        turns = chats.read_turns(r.formatted)
        assert turns[0][0] == "system" and turns[0][1].startswith("turn 0")
        sizes = [len(t.split()) + 4 for _, t in turns]
        new = sizes[r.repeated:]
        assert sum(new[:-1]) < chats.BUDGET
        if r.window:
            history = [int(t.split()[1]) for _, t in turns[1:]]
            assert history == list(range(history[0], history[0] + len(history))) and r.repeated >= 1
            assert sum(sizes[1:r.repeated]) <= chats.HISTORY


def test_every_window_keeps_the_budget(spark):
    """Random conversations, and sizes around the borders: a window is within the budget or one long turn."""
    rng = random.Random(3)
    sizes = {1: [300, 500, 3000, 40, 40], 2: [100, 120, 1, 508, 509, 5, 124, 125], 3: [600, 20, 20, 490, 10], 4: [400, 30, 60, 70, 80, 90, 100, 110] * 6}
    sizes |= {c: [rng.choice([rng.randrange(1, 30), rng.randrange(1, 200), rng.randrange(300, 700)]) for _ in range(rng.randrange(1, 60))] for c in range(5, 40)}
    rows = [(c, i, "system" if i == 0 and c % 2 else ("user", "assistant")[i % 2], f"{c}:{i} " + "w " * (n - 1)) for c, own in sizes.items() for i, n in enumerate(own)]
    windows = chats.format_chats(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).orderBy("conv_id", "window").collect()
    fresh = defaultdict(list)
    for r in windows:
        turns = chats.read_turns(r.formatted)
        said = [int(t.split()[0].split(":")[1]) for _, t in turns]
        tokens = [len(t.split()) + 4 for _, t in turns]
        assert sum(tokens) <= chats.BUDGET or len(turns) == 1
        new, old = said[r.repeated:], said[:r.repeated]
        fresh[r.conv_id] += new
        assert new == list(range(new[0], new[0] + len(new)))
        has_system = r.conv_id % 2 == 1
        if has_system and new[0] and sizes[r.conv_id][0] + 4 + sum(tokens[r.repeated:]) <= chats.BUDGET:
            assert old[0] == 0 and turns[0][0] == "system"
        past = [k for k in old if k or not has_system]
        assert past == list(range(new[0] - len(past), new[0])) and sum(sizes[r.conv_id][k] + 4 for k in past) <= chats.HISTORY
    assert fresh == {c: list(range(len(own))) for c, own in sizes.items()}


def test_long_conversation_is_spread_over_tasks(spark):
    frame = spark.range(4000).selectExpr("7L AS conv_id", "id AS turn", "IF(id % 2 = 0, 'user', 'assistant') AS role", "concat('turn ', id) AS text")
    row = chats.read_back(chats.format_chats(frame)).first()
    assert row.n_turns == 4000 and row.turns_sha256 == digest(f"{('user', 'assistant')[i % 2]}\nturn {i}\n" for i in range(4000))
    assert row.loss_sha256 == digest(f"turn {i}" for i in range(1, 4000, 2))


def test_empty(spark):
    frame = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chats.read_back(chats.format_chats(frame)).collect() == []
