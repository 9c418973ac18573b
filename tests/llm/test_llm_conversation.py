from __future__ import annotations

import heapq
import random
import re
import zlib
from hashlib import sha256

import pytest

from tarmac.llm import conversation, queries

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def faults_of(rows):
    seen, faults = set(), []
    for _, role, text in rows:
        word = text.strip(SPACE)
        if not word:
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append("" if word[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return faults


def cheapest(rows, faults):
    """The cheapest edits, ASCII-least, by best-first search over whole edit sequences; no grammar tables."""
    queue = [(0, "", 0, "", ())]
    best = set()
    while queue:
        cost, audit, at, initials, out = heapq.heappop(queue)
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", initials):
            return cost, audit, "\n".join(f"{r}:{t}" for r, t in out)
        # What may still follow depends on the place and on the roles so far up to whole pairs.
        state = (at, re.sub("(ua)+", "p", initials))
        if state in best or not re.fullmatch("s?(ua)*u?", initials):
            continue
        best.add(state)
        for symbol, name in (("u", "user"), ("a", "assistant")):
            heapq.heappush(queue, (cost + 3, audit + "I", at, initials + symbol, (*out, (name, ""))))
        if at < len(rows):
            _, role, text = rows[at]
            heapq.heappush(queue, (cost + 4, audit + "D", at + 1, initials, out))
            if faults[at] not in ("blank", "duplicate"):
                more = 3 if faults[at] else 0
                if role:
                    heapq.heappush(queue, (cost + more, audit + "K", at + 1, initials + role[0], (*out, (role, text))))
                for symbol, name in (("u", "user"), ("a", "assistant")):
                    heapq.heappush(queue, (cost + more + 3, audit + "R", at + 1, initials + symbol, (*out, (name, text))))


def brute_force(rows):
    """(n, gaps, blank, duplicate, truncated, illegal, cost, audit, digest) of (turn, role, text) rows in any order."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    turns = [t for t, _, _ in rows if t is not None]
    faults = faults_of(rows)
    pairs = [x[1][:1] + y[1][:1] for x, y in zip(rows, rows[1:])]
    cost, audit, text = cheapest(rows, faults) if rows else (0, "", "")
    return (
        len(rows), max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, sha256(text.encode()).hexdigest(),
    )


def damaged(rows):
    """Plain version of the planted faults: conversation -> rows."""
    out = {}
    for conv, turn, role, text in rows:
        left = out.setdefault(conv, [])
        text = " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        role = "user" if kind == 4 else role
        left.extend([(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1))
    return out


def found(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_given_conversations_equal_brute_force(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    expected = {conv: brute_force(left) for conv, left in damaged(rows).items()}
    assert found(queries.queries()["op13_conversation_repair"](spark, sf)) == expected
    assert len({e[7] for e in expected.values()}) > 10  # many different edits


def random_rows(seed, conversations, longest):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", None, "T", "u", "S"]
    texts = ["yes.", "no!", "cut off", "", " \n", None, "why?  ", "é.", "x"]
    return [
        (c, rng.choice([None, *range(5)]), rng.choice(roles[:3] if rng.random() < 0.7 else roles), rng.choice(texts if rng.random() < 0.5 else [f"{rng.random()}."]))
        for c in range(conversations) for _ in range(rng.randrange(longest))
    ]


def test_random_conversations_equal_brute_force(frame):
    rows = random_rows(3, 150, 9)
    expected = {}
    for conv, *rest in rows:
        expected.setdefault(conv, []).append(tuple(rest))
    got = found(conversation.repair(frame(rows, SCHEMA)))
    assert got == {c: brute_force(left) for c, left in expected.items()}


def test_repaired_turns_are_what_was_hashed(frame):
    rows = random_rows(4, 60, 12)
    df = frame(rows, SCHEMA)
    repaired = conversation.repair(df)
    texts = {}
    for r in sorted(conversation.repaired_turns(df, repaired).collect(), key=lambda r: (r["conv_id"], r["place"])):
        assert (r["turn"] is None) or r["action"] != "I"
        texts.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    for r in repaired.collect():
        lines = texts.get(r["conv_id"], [])
        assert sha256("\n".join(lines).encode()).hexdigest() == r["repaired_sha256"]
        assert len(lines) == len(re.sub("D", "", r["audit"]))
        assert re.fullmatch("(s?(ua)+)?", "".join(line[0] for line in lines))


def test_a_long_conversation_settles_and_equals_the_short_form(frame, monkeypatch):
    rng = random.Random(8)
    rows = [(1, i, rng.choice(["user", "assistant"]), f"{i}." if rng.random() < 0.9 else "cut") for i in range(3000)]
    whole = found(conversation.repair(frame(rows, SCHEMA)))[1]
    single = conversation.Conversation(1)
    monkeypatch.setattr(conversation, "SETTLE", 10**9)
    for _, turn, role, text in rows:
        single.add(turn, role, text)
    assert whole == single.result()[1:]
    assert whole[0] == 3000 and len(whole[7]) >= 3000


def test_nulls_empty_table_copies_and_extra_columns(frame, spark):
    rows = [
        (None, 1, "user", "hi.", 1, "x"), (None, None, "assistant", "ho.", 1, "x"), (5, 1, "user", "gone.", 0, "x"),
        (6, 2, "user", "a.", 2, "x"), (6, 4, "assistant", "b" * 300_000 + ".", 1, "x"), (7, None, None, None, 1, "x"),
    ]
    df = frame(rows, SCHEMA + ", copies int, audit string")
    got = found(conversation.repair(df, copies_col="copies"))
    nothing = sha256().hexdigest()
    assert got[None] == brute_force([(1, "user", "hi."), (None, "assistant", "ho.")])
    assert got[5] == (0, 0, 0, 0, 0, 0, 0, "", nothing)
    assert got[6] == brute_force([(2, "user", "a."), (2, "user", "a."), (4, "assistant", "b" * 300_000 + ".")])
    assert got[6][:8] == (3, 1, 0, 1, 0, 1, 4, "KDK")
    assert got[7] == (1, 0, 1, 0, 0, 0, 4, "D", nothing)
    assert conversation.repair(spark.createDataFrame([], SCHEMA)).collect() == []


def test_tables_are_those_of_the_grammar():
    assert len(conversation.MOVES) == 8
    assert len(conversation.ACCEPTS) == 3
