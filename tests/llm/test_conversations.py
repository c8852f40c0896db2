import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

from claimweave.llm import conversations, queries

STEPS = {0: "u", 1: "u", 2: "a", 3: "u"}
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def least(rows):
    """The cheapest audit by all edits at each row and state, from the last row on; a
    row is (initial, required, truncated)."""
    best = {0: (0, ""), 1: (6, "II"), 2: (3, "I"), 3: (0, "")}
    for initial, required, truncated in reversed(rows):
        paid = 3 * truncated
        now = {}
        for state in range(4):
            options = [(best[state][0] + 4, "D" + best[state][1])]
            if not required:
                then = 3 if state == 2 else 2
                change = 0 if initial == STEPS[state] else 3
                options.append((best[then][0] + paid + change, "KR"[change > 0] + best[then][1]))
                if state == 0 and initial == "s":
                    options.append((best[1][0] + paid, "K" + best[1][1]))
            now[state] = min(options)
        for _ in range(3):  # turns inserted before this row
            for state in range(4):
                then = now[3 if state == 2 else 2]
                now[state] = min(now[state], (then[0] + 3, "I" + then[1]))
        best = now
    return best[0]


def brute(rows):
    """The rows of the query."""
    by_id = defaultdict(list)
    for conv_id, turn, role, text in rows:
        shown = [" " if v is None else str(v) for v in (conv_id, turn)]
        role, text = role if role is not None else " ", text if text is not None else " "
        fate = zlib.crc32(":".join(shown).encode()) % 20
        kept = by_id[conv_id]
        if fate == 0:
            continue
        text = "" if fate == 1 else "".join(c for c in text if c not in ".!?") if fate == 2 else text
        role = "user" if fate == 4 else role
        kept += [(turn, role, text)] * (1 + (fate == 3))
    out = []
    for conv_id, turns in by_id.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2][:64].encode(), hashlib.sha256(r[2].encode()).digest()))
        seen, counts, judged = set(), dict.fromkeys(("blank", "duplicate", "truncated"), 0), []
        for _, role, text in turns:
            ended = text.rstrip(SPACE)
            fault = "blank" if not ended else "duplicate" if (role, text) in seen else "truncated" if ended[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            judged.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        initials = [j[0] for j in judged]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        numbered = [t for t, *_ in turns if t is not None]
        gaps = max(numbered) - min(numbered) + 1 - len(set(numbered)) if numbered else 0
        cost, audit = least(judged)
        left, made, state = iter(turns), [], 0
        for letter in audit:
            _, role, text = next(left) if letter != "I" else (None, "", "")
            if letter == "D":
                continue
            if letter == "K" and state == 0 and role[:1] == "s":
                state = 1
            else:
                state = 3 if state == 2 else 2
            made.append(f"{role if letter == 'K' else ('user', 'assistant')[state == 3]}:{text}")
        out.append((conv_id, gaps, *counts.values(), illegal, cost, audit, hashlib.sha256("\n".join(made).encode()).hexdigest()))
    return sorted(map(str, out))


def turns_of(rng, n):
    return tuple(conversations.Turn(rng.choice("suauaua "), rng.random() < 0.15, rng.random() < 0.2, 1) for _ in range(n))


def test_alignment_equals_all_edits():
    rng = random.Random(13)
    for n in [*range(8)] * 60 + [20, 40, 60]:
        turns = turns_of(rng, n)
        turns = tuple(t._replace(open_=t.open_ and not t.required) for t in turns)
        audit, state = conversations.Alignment(turns).walk(conversations.START, conversations.AT_END)
        audit += "I" * (conversations.AT_END[state] // 3)
        wanted = least([(t.initial.strip(), t.required, t.open_) for t in turns])
        costs = conversations.Alignment(turns).costs()[0]
        assert (min(c + e for c, e in zip(costs, conversations.AT_END)), audit) == wanted, turns


def conversations_of(rng):
    rows = []
    for conv_id in [*range(150), None]:
        n = rng.choice([0, 1, 2, 4, 6, 9, 30]) + (conv_id in (0, 7)) * 300
        for turn in range(n + 1):
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.2 else ["user", "assistant"][turn % 2]
            role = "system" if turn == 0 and rng.random() < 0.4 else rng.choice([None, "", "tool", "system", "User"]) if rng.random() < 0.04 else role
            text = rng.choice([None, "", " \t", "same.", "Same?", "no end", "é. \n", "x" * 70 + ".", f"line {turn}."]) if rng.random() < 0.4 else f"text {turn} {rng.random()}."
            rows.append((conv_id, None if rng.random() < 0.02 else turn, role, text))
            if rng.random() < 0.05:
                rows.append(rows[-1])
    return rows


@pytest.mark.parametrize("bits", [8, 1, 0])
def test_equals_brute_force_and_sql(spark, as_table, monkeypatch, bits):
    """Also with blocks of two turns and one, so that conversations take many."""
    monkeypatch.setattr(conversations, "BLOCK_BITS", bits)
    rows = conversations_of(random.Random(bits))
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    given = given.selectExpr("*", "1 AS copies", "2 AS head", "3 AS block", "4 AS fate", "5 AS _row")
    folder = as_table(conversations=given)
    found = queries.QUERIES["op13_conversations"](spark, folder).collect()
    assert sorted(map(str, map(tuple, found))) == brute(rows)
    if bits == 8:
        connection = duckdb.connect()
        connection.execute(f"CREATE VIEW conversations AS SELECT conv_id, turn, role, text FROM '{folder}/conversations.parquet/*.parquet'")
        assert sorted(map(str, connection.execute(queries.SQL["op13_conversations"]).fetchall())) == brute(rows)


def test_repaired_turns(spark):
    rows = [(1, i, ["user", "assistant"][i % 2], f"text {i}.") for i in range(40)] + [(2, 0, "system", "s."), (3, None, None, None)]
    given = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    whole = {r.conv_id: r.repaired_sha256 for r in conversations.repair(given).collect()}
    turns = defaultdict(list)
    for r in conversations.repair(given, turns=True).orderBy("conv_id", "nth").collect():
        assert r.nth == len(turns[r.conv_id])
        turns[r.conv_id].append(f"{r.role}:{r.text}")
    assert {i: hashlib.sha256("\n".join(turns[i]).encode()).hexdigest() for i in whole} == whole
    assert set(whole) == {1, 2, 3}


def test_empty_table(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversations.repair(empty).count() == 0
