"""Repairs against a search over all edits from each turn and state on."""

import hashlib
import random
import zlib
from functools import cache

import pytest

from tidebook.llm import conversations, queries

COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
WHITE = " \t\n\x0b\x0c\r"


def cheapest(turns):
    """Least (cost, audit) of turns given as (initial, must go, truncated)."""

    @cache
    def onward(i, state, inserted):
        options = [(0, "")] if i == len(turns) and state in "-a" else []
        wanted = "a" if state == "u" else "u"
        if inserted < 4:
            cost, audit = onward(i, wanted, inserted + 1)
            options.append((cost + 2, "I" + audit))
        if i < len(turns):
            initial, gone, cut = turns[i]
            cost, audit = onward(i + 1, state, 0)
            options.append((cost + 3, "D" + audit))
            if not gone:
                if initial == wanted or (initial == "s" and state == "-"):
                    cost, audit = onward(i + 1, initial, 0)
                    options.append((cost + cut, "K" + audit))
                cost, audit = onward(i + 1, wanted, 0)
                options.append((cost + 2 + cut, "R" + audit))
        return min(options, default=(10**9, ""))

    return onward(0, "-", 0)


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = (" " if x is None else x for x in (role, text))
        fate = zlib.crc32(key.encode()) % 20
        if fate == 1:
            text = ""
        if fate == 2:
            text = "".join(c for c in text if c not in ".!?")
        if fate == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return out


def plain(rows, damaged=True):
    kept = damage(rows) if damaged else [(c, t, *(" " if x is None else x for x in (r, x))) for c, t, r, x in rows]
    out = []
    for conv in {row[0] for row in rows}:
        own = sorted((row[1:] for row in kept if row[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        numbers = [t for t, _, _ in own if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        faults, seen = [], set()
        for _, role, text in own:
            body = text.strip(WHITE)
            faults.append("b" if not body else "d" if (role, text) in seen else "" if body[-1] in ".!?" else "t")
            seen.add((role, text))
        initials = [role[:1] for _, role, _ in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = cheapest(tuple((i, f in ("b", "d"), f == "t") for i, f in zip(initials, faults, strict=True)))
        lines, last, left = [], "", iter(own)
        for letter in audit:
            _, role, text = next(left) if letter != "I" else (0, "", "")
            if letter == "D":
                continue
            if letter != "K":
                role = "assistant" if last == "u" else "user"
            last = role[:1]
            lines.append(f"{role}:{text}")
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, digest))
    return sorted(out, key=repr)


def made(seed, count=60, longest=12):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(count), None]:
        begin = rng.choice([0, 0, 3, -2])
        for turn in range(begin, begin + rng.randint(1, longest)):
            if rng.random() < 0.08:
                continue
            role = rng.choice(["system", "tool", "", None, "student"]) if rng.random() < 0.15 else ("user", "assistant")[(turn + (rng.random() < 0.2)) % 2]
            text = rng.choice(["Yes.", "No", "Well then!", "\x85", " \t\n", "", None, "Où? \n", "What?" + " x" * 50, f"turn {turn}."])
            rows.append((conv, None if rng.random() < 0.05 else turn, role, text))
            if rng.random() < 0.1:
                rows.append(rng.choice([rows[-1], (conv, turn, "user", "Yes.")]))
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", fate string, copies int").repartition(4)


@pytest.mark.parametrize("damaged", [True, False])
def test_against_a_search(spark, rows, damaged):
    given = made(1)
    assert rows(conversations.repair(frame(spark, given), damaged), *COLUMNS) == plain(given, damaged)


@pytest.mark.parametrize("block, turns", [(1, 0), (3, 4), (512, 2)])
def test_blocks_give_the_same(spark, rows, monkeypatch, block, turns):
    given = made(2, 25) + [(77, t, ("user", "assistant")[t % 3 == 1], f"say {t % 40}.") for t in range(150)]
    given += [(None, 5, "user", "again")] * 9
    monkeypatch.setattr(conversations, "MOST_TURNS", turns)
    monkeypatch.setattr(conversations, "BLOCK", block)
    assert rows(conversations.repair(frame(spark, given)), *COLUMNS) == plain(given)


def test_a_long_conversation(spark, rows, monkeypatch):
    """The cost of some thousand turns against a pass over the states, and as many edits as turns."""
    monkeypatch.setattr(conversations, "MOST_TURNS", 1000)
    rng = random.Random(5)
    given = [(1, t, rng.choice(["user", "assistant"]) if t % 3 else "user", f"{t}" + rng.choice([".", "", "!"])) for t in range(2500)]
    found = rows(conversations.repair(frame(spark, given)), *COLUMNS)
    own = damage(given)
    states, seen = {"-": 0}, set()
    for _, _, role, text in own:
        for state, held in [*states.items(), *states.items()]:
            wanted = "a" if state == "u" else "u"
            states[wanted] = min(states.get(wanted, 10**9), states[state] + 2)
        after = {state: held + 3 for state, held in states.items()}
        if text.strip(WHITE) and (role, text) not in seen:
            cut = text[-1] not in ".!?"
            for state, held in states.items():
                wanted = "a" if state == "u" else "u"
                after[wanted] = min(after.get(wanted, 10**9), held + cut + 2 * (role[:1] != wanted))
        seen.add((role, text))
        states = after
    assert len(found) == 1 and found[0][6] == min(states["-"], states["a"], states["u"] + 2)
    assert sum(c != "I" for c in found[0][7]) == len(own)


def test_everything_dropped_and_no_rows(spark, rows, monkeypatch):
    empty = hashlib.sha256(b"").hexdigest()
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    expected = [(conv, 0, 0, 0, 0, 0, 0, "", empty)]
    given = frame(spark, [(conv, 0, "user", "Hello.")] * 3)
    assert rows(conversations.repair(given), *COLUMNS) == expected
    monkeypatch.setattr(conversations, "MOST_TURNS", 1)
    assert rows(conversations.repair(given), *COLUMNS) == expected
    assert conversations.repair(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_reads_conversations(spark, rows, tables):
    given = made(9, 20)
    assert rows(queries.op12_conversation_repair(spark, tables(conversations=frame(spark, given))), *COLUMNS) == plain(given)
