"""Conversation repair: cheapest edits against a full table of suffixes, faults, long conversations in blocks, edge rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from sharelens.llm import conversation_repair as R
from sharelens.llm import queries

from .conftest import SF_SMALL

AFTER = {"": "u", "s": "u", "u": "a", "a": "u"}
NAMES = {"u": "user", "a": "assistant"}


def brute(rows):
    """(cost, audit, lines) of (role, text, fault) rows: the least of all edits, from the last row to the first."""
    best = {"": (0, "", ()), "a": (0, "", ()), "u": (5, "I", ("assistant:",)), "s": (10, "II", ("user:", "assistant:"))}
    for role, text, fault in reversed(rows):
        now = {}
        for state in best:
            c, e, t = best[state]
            options = [(c + 2, "D" + e, t)]
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                first = role[:1]
                if first == "s" and state == "" or first == "u" and state != "u" or first == "a" and state == "u":
                    c, e, t = best[first]
                    options.append((c + more, "K" + e, (f"{role}:{text}", *t)))
                c, e, t = best[AFTER[state]]
                options.append((c + more + 1, "R" + e, (f"{NAMES[AFTER[state]]}:{text}", *t)))
            now[state] = min(options)
        for _ in range(4):
            for state in now:
                c, e, t = now[AFTER[state]]
                now[state] = min(now[state], (c + 5, "I" + e, (f"{NAMES[AFTER[state]]}:", *t)))
        best = now
    return best[""]


def expected(rows):
    """The contract's row of one conversation, from (turn, role, text) in order."""
    seen, marked = set(), []
    for _, role, text in rows:
        bare = re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", text)
        marked.append((role, text, "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"))
        seen.add((role, text))
    cost, audit, lines = brute(marked)
    turns = {t for t, _, _ in rows if t is not None}
    kinds = [x[2] for x in marked]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:], strict=False)]
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, kinds.count("blank"), kinds.count("duplicate"), kinds.count("truncated"),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def place(rows):
    return sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1], hashlib.sha256(x[2].encode()).hexdigest()))


def some_rows(rng, n, texts=8):
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", "agent", "User"]
    ends = [".", "!", "?", "", " .", ". \n", " "]
    return [(rng.choice([None, *range(n)]), rng.choice(roles), rng.choice(["", " ", "\t\n"] + [f"t{i}" + rng.choice(ends) for i in range(texts)]))
            for _ in range(n)]


def test_cheapest_edits_against_all():
    rng = random.Random(3)
    codes = {"": 0, "blank": 1, "duplicate": 2, "truncated": 3}
    for n in [*range(9), 30, 64, 65, 150] * 25:
        rows = [(rng.choice(["system", "user", "assistant", "tool", ""]), "x", rng.choice(["", "", "", *codes])) for _ in range(n)]
        cost, audit, _ = brute(rows)
        assert R.edits_of([(r[:1], codes[f]) for r, _, f in rows]) == (cost, audit)


def test_blocks_for_all_states():
    rng = random.Random(8)
    for _ in range(60):
        rows = [(rng.choice("suat"), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(rng.randint(1, 14))]
        cut = rng.randint(0, len(rows))
        halves = R.join_blocks([R.solve_block(rows[:cut]), R.solve_block(rows[cut:])])
        assert halves == R.solve_block(rows)


def test_query_against_brute_force(spark):
    source = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").collect()
    want = {r["conv_id"]: [] for r in source}
    for r in source:
        case = zlib.crc32(f"{r['conv_id']}:{r['turn']}".encode()) % 20
        text = "" if case == 1 else re.sub("[.!?]", "", r["text"]) if case == 2 else r["text"]
        want[r["conv_id"]] += [(r["turn"], "user" if case == 4 else r["role"], text)] * (0 if case == 0 else 2 if case == 3 else 1)
    got = queries.QUERIES["op12_conversation_repair"](spark, SF_SMALL).collect()
    assert {r["conv_id"]: tuple(r)[1:] for r in got} == {c: expected(place(x)) for c, x in want.items()}
    assert len(got) == len(want)


def _given(spark, convs):
    rows = [(c, *r) for c, x in convs.items() for r in x]
    return spark.createDataFrame(random.Random(1).sample(rows, len(rows)), "conv_id long, turn long, role string, text string")


def _read(done):
    return {r["conv"]: tuple(r)[1:] for r in R.digests(done).collect()}


def test_long_conversations_equal_short_ones(spark, monkeypatch):
    monkeypatch.setattr(R, "LONG_ROWS", 50)
    monkeypatch.setattr(R, "FAN", 2)
    rng = random.Random(4)
    convs = {i: some_rows(rng, n, texts=2000) for i, n in enumerate([3, 50, 51, 64, 65, 128, 400, 700])}
    convs[100] = [(i, "assistant" if i % 2 else "user", f"number {i}.") for i in range(300)]      # sound
    convs[101] = [(0, "system", "Be brief.")] + convs[100]
    convs[102] = [(5, "user", "the same.")] * 200                                               # one row, repeated
    convs[103] = [(None, "user", "")] * 130                                                      # nothing stays
    convs[None] = some_rows(rng, 90)
    done = R.repair(_given(spark, convs))
    assert done.parts is not None
    assert _read(done) == {c: expected(place(x)) for c, x in convs.items()}
    assert done.whole.count() == 2
    messages = done.messages().where("conv = 101").orderBy("part", "place").collect()
    assert [(m["edit"], m["role"]) for m in messages[:3]] == [("K", "system"), ("K", "user"), ("K", "assistant")]
    assert len(messages) == 301
    assert {r["conv"] for r in done.report().collect()} == set(convs)


def test_long_texts_make_a_conversation_long(spark, monkeypatch):
    monkeypatch.setattr(R, "LONG_BYTES", 1000)
    convs = {1: [(0, "user", "x" * 5000 + "."), (1, "assistant", "y" * 5000)], 2: [(0, "user", "hi."), (1, "assistant", "ho.")]}
    done = R.repair(_given(spark, convs))
    assert done.reports.count() == 1
    assert _read(done) == {c: expected(x) for c, x in convs.items()}


def test_edge_rows(spark):
    schema = "conv_id long, turn long, role string, text string, conv string, rows int, digest string, pos int, copies int, fault int"
    rows = [(1, None, None, None), (1, 1, "user", "Hi."), (1, 1, "user", "Hi."), (1, 3, "assistant", "x" * 300_000 + "!"),
            (2, 0, "user", None), (None, 0, "user", "A?"), (None, None, "assistant", "B"), (3, 7, "system", "Only rules.")]
    df = spark.createDataFrame([(*r, "c", 1, "d", 2, 3, 4) for r in rows], schema)
    want = {1: [(None, " ", " "), (1, "user", "Hi."), (1, "user", "Hi."), (3, "assistant", "x" * 300_000 + "!")], 2: [(0, "user", " ")],
            None: [(None, "assistant", "B"), (0, "user", "A?")], 3: [(7, "system", "Only rules.")]}
    assert _read(R.repair(df)) == {c: expected(x) for c, x in want.items()}
    none = R.repair(df, copies=F.lit(0))       # every row dropped: zeros, no edits, the empty digest
    assert set(_read(none).values()) == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert R.digests(R.repair(df.limit(0))).count() == 0
    assert _read(R.repair(R.damaged(df), copies=F.col("copies"))).keys() == want.keys()


@pytest.mark.parametrize("rows,audit", [
    ([("user", "Hi."), ("assistant", "Ho.")], "KK"),
    ([("assistant", "Hi."), ("assistant", "Ho.")], "RK"),
    ([("user", "Hi."), ("user", "Hi."), ("assistant", "Ho.")], "KDK"),
    ([("system", "S.")], "D"),
    ([("user", "Hi."), ("assistant", "cut")], "DD"),
])
def test_small_cases(rows, audit):
    assert R.repair_one([(i, *x) for i, x in enumerate(rows)])["audit"] == audit
