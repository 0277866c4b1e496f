"""Conversation repair against enumeration of edits and a plain version of the whole."""

import hashlib
import random
import re
import zlib
from itertools import product

import pytest
from pyspark.sql import functions as F

from spendloom.llm import conversations as conv

SCHEMA = "conv_id long, turn long, role string, text string"
PATTERN = re.compile(r"(s?(ua)+)?")


def plain(turns, insertions):
    """(cost, audit, roles) of the best of all edits with so many insertions at most between two turns."""
    best = None
    choices = []
    for t in turns:
        own = [("D", 4, "")]
        if t != "x":
            extra = 3 if t.isupper() else 0
            own += [("K", extra, t.lower()), ("R", 3 + extra, "u"), ("R", 3 + extra, "a")]
        choices.append([[("I", 3, r) for r in ins] + [o] for k in range(insertions + 1) for ins in product("ua", repeat=k) for o in own])
    choices.append([[("I", 3, r) for r in ins] for k in range(insertions + 1) for ins in product("ua", repeat=k)])
    for picked in product(*choices):
        edits = [e for part in picked for e in part]
        roles = "".join(r for _, _, r in edits)
        if PATTERN.fullmatch(roles):
            found = sum(c for _, c, _ in edits), "".join(e for e, _, _ in edits), roles
            best = min(best or found, found)
    return best


def test_all_short_conversations():
    for n in range(3):
        for turns in product("suaoxSUA", repeat=n):
            cost, audit, _ = plain("".join(turns), 2)
            assert conv.cheapest("".join(turns))[:2] == (cost, audit), turns
    rnd = random.Random(1)
    for _ in range(60):
        turns = "".join(rnd.choice("suaoxUA") for _ in range(4))
        assert conv.cheapest(turns)[:2] == plain(turns, 1)[:2], turns


def table(turns):
    """Best (cost, audit) per role written last, turn by turn: letters are compared as strings."""
    legal = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    best = {0: (0, "")}

    def insert(best):
        for _ in range(3):
            for state, (cost, audit) in list(best.items()):
                to = 3 if state == 2 else 2
                best[to] = min(best.get(to, (1 << 40, "")), (cost + 3, audit + "I"))
        return best

    best = insert(best)
    for t in turns:
        now = {}
        for state, (cost, audit) in best.items():
            moves = [("D", 4, state)]
            if t != "x":
                extra = 3 if t.isupper() else 0
                moves.append(("R", 3 + extra, 3 if state == 2 else 2))
                if t.lower() in legal[state]:
                    moves.append(("K", extra, legal[state][t.lower()]))
            for letter, extra, to in moves:
                now[to] = min(now.get(to, (1 << 40, "")), (cost + extra, audit + letter))
        best = insert(now)
    return min(best[s] for s in (0, 3) if s in best)


def test_long_random_conversations_and_segments():
    rnd = random.Random(2)
    for _ in range(300):
        turns = "".join(rnd.choice("suaoxSUA" if rnd.random() < 0.4 else "ua") for _ in range(rnd.randint(0, 40)))
        want = table(turns)
        assert conv.cheapest(turns)[:2] == want, turns
        if turns:  # distances across pieces add up to the same cost
            cut = rnd.randint(0, len(turns))
            first, second = conv.crossing_costs(turns[:cut], False)[0], conv.crossing_costs(turns[cut:], True)
            assert min(first[a] + second[a][b] for a in range(4) for b in (0, 3)) == want[0]


def whole(rows):
    """The contract of op12, row by row."""
    space = lambda v: " " if v is None else str(v)
    groups = {}
    for c, turn, role, text in rows:
        role, text = space(role), space(text)
        kind = zlib.crc32(f"{space(c)}:{space(turn)}".encode()) % 20
        held = groups.setdefault(c, [])
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            held += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for c, held in groups.items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, symbols, counts = set(), "", [0, 0, 0]
        for _, role, text in held:
            bare = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
            symbols += "x" if fault in (0, 1) else initial.upper() if fault == 2 else initial
        cost, audit = table(symbols)
        numbers = {r[0] for r in held} - {None}
        illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(held, held[1:]))
        lines, left = [], list(held)
        for letter in audit:
            if letter == "I":
                lines.append([None, ""])
            else:
                _, role, text = left.pop(0)
                if letter != "D":
                    lines.append([role if letter == "K" else None, text])
        state = 0
        for line in lines:
            if line[0] is None:
                line[0] = "assistant" if state == "u" else "user"
            state = line[0][:1]
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
        out[c] = (max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0, *counts, illegal, cost, audit, digest)
    return out


def sample():
    rnd = random.Random(5)
    rows = []
    for c in [*range(60), None]:
        for turn in range(rnd.randint(1, 9)):
            role = ["user", "assistant"][turn % 2] if rnd.random() < 0.8 else rnd.choice(["system", "tool", "", None, "user", "uncle"])
            text = rnd.choice(["Yes.", "No!", "What?", "open end", "  ", None, "", "a. b", "Done. \n", "x" * 5000 + ".", "…"])
            rows.append((c, None if rnd.random() < 0.05 else turn + (rnd.random() < 0.1), role, text))
    rows += [(100, t, "user" if t % 3 else "assistant", f"turn {t}." if t % 7 else "again") for t in range(400)]
    return rows + rows[:6] + [rows[-1]] * 5


@pytest.mark.parametrize("most_turns, segment", [(10_000, 8_192), (3, 7), (0, 2)])
def test_repair(spark, monkeypatch, most_turns, segment):
    monkeypatch.setattr(conv, "SEGMENT_TURNS", segment)
    rows = sample()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).select("*", *[F.lit("kept").alias(c) for c in ("name", "seg", "place", "copies")])
    got = conv.repair_conversations(df, most_turns=most_turns, damage=conv.damaged)
    assert {r.conv_id: tuple(r)[1:] for r in got.collect()} == whole(rows)
    assert got.count() == len({r[0] for r in rows})


def test_nothing_left_and_empty_table(spark):
    gone = [(c, t, "user", "Hi.") for c in range(400) for t in range(1) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    got = conv.repair_conversations(spark.createDataFrame(gone, SCHEMA), damage=conv.damaged).collect()
    assert gone and {tuple(r)[1:] for r in got} == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert conv.repair_conversations(spark.createDataFrame([], SCHEMA), damage=conv.damaged).count() == 0


def test_undamaged_rows(spark):
    rows = [("a", 1, "user", "Hi."), ("a", 2, "assistant", "Yes.")]
    got = conv.repair_conversations(spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")).collect()
    assert [tuple(r)[:-1] for r in got] == [("a", 0, 0, 0, 0, 0, 0, "KK")]
    assert got[0].repaired_sha256 == hashlib.sha256(b"user:Hi.\nassistant:Yes.").hexdigest()
