"""Repair of conversations whose turns were dropped, emptied, cut, repeated or given to the wrong role.

The turns of a conversation are aligned to the strings of roles that the grammar `(s?(ua)+)?` allows. All of
its strings of one beginning are prefixes of one alternating string, so one Wagner-Fischer table gives the cost
of every feasible length at once; cells that cannot lead to a cost within the incumbent bound are not filled
(Ukkonen), and the bound doubles until every way to end has a cost within it. Of equal costs the audit that is
least in ASCII order wins, cell by cell and then between the lengths: audits of the same turns that end with
a turn never are prefixes of one another, so what wins early wins in the end.

For the same reason a conversation can be cut anywhere. One with more than `MOST_TURNS` turns or `MOST_BYTES`
bytes is dealt over tasks by ranges of its turns and aligned block by block, for every state of the grammar
that a block may begin and end with; a few numbers of each block then settle which it was. Only the digest of
the repaired text, which has to read it in order, is a single pass over such a conversation, block by block.

Turns come by number, nulls first, those of one number by role and text after damage. Rows that are equal
are turns of their own. Null texts, roles, ids and numbers are one space where they are hashed or joined; a
null id is a conversation like any other, and so are rows whose ids have no turns left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidebook.llm import base

DELETE, INSERT, REROLE, CUT = 3, 2, 2, 1
#: States of the grammar: nothing yet, after s, after u, after a; what closes each, and what comes after it.
START, SYSTEM, USER, ASSISTANT = range(4)
AFTER = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
CLOSING = ((0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, ""))
NEXT = ("u", "u", "a", "u")
ROLE = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
BLANK = " \t\n\x0b\x0c\r"
#: A conversation beyond these is cut into blocks of at most so many turns and bytes.
MOST_TURNS, MOST_BYTES = 4096, 1 << 26
BLOCK, BLOCK_BYTES = 256, 1 << 23
#: Salts of the turns that occur again, where they meet the first of them.
SALTS = 16

REPORT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


# --- damage --------------------------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: the turns after damage; a dropped one has no copy."""

    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    marked = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), fate.alias("fate"))
    spoilt = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return marked.select(
        "conv_id",
        "turn",
        F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
        spoilt.alias("text"),
        F.when(F.col("fate") == 0, 0).when(F.col("fate") == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


# --- alignment -----------------------------------------------------------------------------------


class Turn:
    """A turn with its fault: b blank, d duplicate, t truncated, or none."""

    __slots__ = ("number", "role", "text", "fault", "initial")

    def __init__(self, number: int | None, role: str, text: str, seen: bool) -> None:
        self.number, self.role, self.text, self.initial = number, role, text, role[:1]
        kept = text.rstrip(BLANK)
        self.fault = "b" if not kept else "d" if seen else "" if kept[-1] in ".!?" else "t"

    @property
    def forced(self) -> bool:
        return self.fault in ("b", "d")


def target(system: bool, first: str, j: int) -> str:
    """Character `j` of the alternating string that begins with `first`, after an s if `system`."""
    if system:
        if not j:
            return "s"
        j -= 1
    return first if j % 2 == 0 else "ua"[first == "u"]


def banded(turns: list[Turn], system: bool, first: str, bound: int, rest: list[int]) -> dict[int, tuple[int, str]]:
    """Cost and audit for every length of target that `bound` can reach; the last edit takes the last turn."""
    cells: dict[int, tuple[int, str]] = {0: (0, "")}
    for i, turn in enumerate(turns):
        room = bound - rest[i]
        j = min(cells)
        last = max(cells)
        while j <= last:
            held = cells.get(j)
            if held and held[0] + INSERT <= room and target(system, first, j) != "s":
                longer = (held[0] + INSERT, held[1] + "I")
                if j + 1 not in cells or longer < cells[j + 1]:
                    cells[j + 1] = longer
                    last = max(last, j + 1)
            j += 1
        after: dict[int, tuple[int, str]] = {}
        room = bound - rest[i + 1]
        cut = CUT * (turn.fault == "t")
        for j, (cost, audit) in cells.items():
            moves = [(j, cost + DELETE, "D")]
            if not turn.forced:
                wanted = target(system, first, j)
                if turn.initial == wanted:
                    moves.append((j + 1, cost + cut, "K"))
                elif wanted != "s":
                    moves.append((j + 1, cost + REROLE + cut, "R"))
            for place, total, letter in moves:
                if total <= room and (place not in after or (total, audit + letter) < after[place]):
                    after[place] = (total, audit + letter)
        cells = after
        if not cells:
            return {}
    return cells


def align(turns: list[Turn], entry: int) -> dict[int, tuple[int, str]]:
    """The cheapest cost and its least audit for every state that the turns may end in, from one they begin in."""
    if not turns:
        return {entry: (0, "")}
    best = {entry: (DELETE * len(turns), "D" * len(turns))}

    def offer(state: int, found: tuple[int, str]) -> None:
        if state not in best or found < best[state]:
            best[state] = found

    # What the turns from each on cost at least.
    rest = [0]
    for turn in reversed(turns):
        rest.append(rest[-1] + (DELETE if turn.forced else CUT * (turn.fault == "t")))
    rest.reverse()
    system = [(turn.fault == "t", -k) for k, turn in enumerate(turns) if turn.initial == "s" and not turn.forced]
    families = [(False, NEXT[entry])] + [(True, "u")] * (entry == START and bool(system))
    for with_system, first in families:
        margin = 2 * INSERT
        while True:
            cells = banded(turns, with_system, first, rest[0] + margin, rest)
            ends = {AFTER[target(with_system, first, j - 1)] for j in cells if j}
            # Nothing needs more: each turn deleted, or given another role after two insertions at most.
            if {USER, ASSISTANT} <= ends or margin > 8 * len(turns) + 8:
                break
            margin *= 2
        for j, found in cells.items():
            if j:
                offer(AFTER[target(with_system, first, j - 1)], found)
    if entry == START and system:
        # Nothing but one s: the last one of those that cost least.
        cut, place = min(system)
        offer(SYSTEM, (DELETE * (len(turns) - 1) + CUT * cut, "D" * -place + "K" + "D" * (len(turns) - 1 + place)))
    return best


def closed(ends: dict[int, tuple[int, str]]) -> tuple[int, str]:
    return min((cost + CLOSING[state][0], audit + CLOSING[state][1]) for state, (cost, audit) in ends.items())


def repaired(turns: Iterable[Turn], audit: str, state: int) -> Iterator[str]:
    """The lines `role:text` that an audit leaves of turns."""
    given = iter(turns)
    for letter in audit:
        turn = next(given) if letter != "I" else None
        if letter == "D":
            continue
        initial = turn.initial if letter == "K" else NEXT[state]
        role = turn.role if letter == "K" else ROLE[initial]
        yield f"{role}:{turn.text if turn else ''}"
        state = AFTER[initial]


def illegal(turns: list[Turn]) -> int:
    return sum(a.initial + b.initial not in LEGAL for a, b in zip(turns, turns[1:]))


# --- whole conversations -------------------------------------------------------------------------


def report(numbers: Iterable[int | None], turns: list[Turn]) -> tuple[list[int], str, str]:
    known = {n for n in numbers if n is not None}
    gaps = max(known) - min(known) + 1 - len(known) if known else 0
    faults = [sum(turn.fault == fault for turn in turns) for fault in "bdt"]
    cost, audit = closed(align(turns, START))
    digest = hashlib.sha256("\n".join(repaired(turns, audit, START)).encode()).hexdigest()
    return [gaps, *faults, illegal(turns), cost], audit, digest


def _result_schema(df: DataFrame) -> T.StructType:
    more = [T.StructField(name, T.LongType()) for name in REPORT] + [T.StructField(name, T.StringType()) for name in ("audit", "repaired_sha256")]
    return T.StructType([T.StructField("conv_id", df.schema["conv_id"].dataType), *more])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _by_conversation(rows: Iterable[dict]) -> Iterator[tuple[object, Iterator[dict]]]:
    for key, own in groupby(rows, key=lambda row: (row["conv_id"] is None, row["conv_id"])):
        yield key[1], own


def _batched(rows: Iterable[dict], schema: pa.Schema, size: int = 1024) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _arrow(schema: T.StructType) -> pa.Schema:
    return to_arrow_schema(schema)


def whole(turns: DataFrame) -> DataFrame:
    """Repair of conversations that fit a task, a conversation at a time."""
    schema = _result_schema(turns)
    arrow = _arrow(schema)

    def results(rows: Iterator[dict]) -> Iterator[dict]:
        for conv_id, own in _by_conversation(rows):
            made, seen = [], set()
            for row in own:
                for _ in range(row["copies"]):
                    made.append(Turn(row["turn"], row["role"], row["text"], (row["role"], row["text"]) in seen))
                    seen.add((row["role"], row["text"]))
            numbers, audit, digest = report((turn.number for turn in made), made)
            yield {"conv_id": conv_id, **dict(zip(REPORT, numbers, strict=True)), "audit": audit, "repaired_sha256": digest}

    placed = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return placed.mapInArrow(lambda batches: _batched(results(_rows(batches)), arrow), schema)


# --- conversations in blocks ---------------------------------------------------------------------


def first_seen(turns: DataFrame) -> DataFrame:
    """Turns of which equal ones are one row with so many copies, and whether role and text occur at an earlier number."""
    same = base.materialize(turns.filter("copies > 0").groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies")), "turns")
    place = F.struct(F.col("turn").isNotNull().alias("numbered"), "turn")
    digest = F.md5(F.col("text").cast("binary"))
    again = same.groupBy("conv_id", "role", digest.alias("digest")).agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("earliest")).filter("n > 1")
    salted = again.select(
        F.col("conv_id").alias("of"), F.col("role").alias("by"), F.col("digest").alias("saying"), "earliest", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    )
    salt = F.pmod(F.xxhash64("turn"), F.lit(SALTS)) == F.col("salt")
    met = F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("role") == F.col("by")) & (digest == F.col("saying")) & salt
    later = F.coalesce(place > F.col("earliest"), F.lit(False)).alias("later")
    return same.join(salted, met, "left").select("conv_id", "turn", "role", "text", "copies", later)


BLOCK_FIELDS = (
    "part int, block long, n long, blank long, duplicate long, truncated long, illegal long, head string, tail string, "
    "low long, high long, numbers long, costs array<long>, ranks array<int>, audits array<string>, roles array<string>, texts array<string>, faults array<string>"
)


def block_summary(turns: list[Turn]) -> dict:
    costs, ranks, audits = [], [], []
    for entry in range(4):
        ends = align(turns, entry)
        order = sorted(ends, key=lambda state: ends[state][1])
        costs += [ends[state][0] if state in ends else None for state in range(4)]
        ranks += [order.index(state) if state in ends else None for state in range(4)]
        audits += [ends[state][1] if state in ends else None for state in range(4)]
    known = {turn.number for turn in turns} - {None}
    blank, duplicate, truncated = (sum(turn.fault == fault for turn in turns) for fault in "bdt")
    return {
        "n": len(turns), "blank": blank, "duplicate": duplicate, "truncated": truncated, "illegal": illegal(turns),
        "head": turns[0].initial, "tail": turns[-1].initial, "low": min(known, default=None), "high": max(known, default=None),
        "numbers": len(known), "costs": costs, "ranks": ranks, "audits": audits,
        "roles": [turn.role for turn in turns], "texts": [turn.text for turn in turns], "faults": [turn.fault for turn in turns],
    }


def blocks(turns: DataFrame) -> DataFrame:
    """Blocks of consecutive turns with their alignments for every state at either end."""
    schema = T.StructType([T.StructField("conv_id", turns.schema["conv_id"].dataType), *T.StructType.fromDDL(BLOCK_FIELDS)])
    arrow = _arrow(schema)

    def made(own: Iterator[dict]) -> Iterator[list[Turn]]:
        held, size = [], 0
        for row in own:
            for copy in range(row["copies"]):
                held.append(Turn(row["turn"], row["role"], row["text"], row["later"] or copy > 0))
                size += len(row["text"])
                if len(held) >= BLOCK or size >= BLOCK_BYTES:
                    yield held
                    held, size = [], 0
        if held:
            yield held

    def results(rows: Iterator[dict]) -> Iterator[dict]:
        part = TaskContext.get().partitionId()
        for conv_id, own in _by_conversation(rows):
            for number, held in enumerate(made(own)):
                yield {"conv_id": conv_id, "part": part, "block": number, **block_summary(held)}

    # Ranges of whole turns; of the texts a beginning is enough to tell apart most turns of one number.
    ranged = turns.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 64))
    placed = ranged.sortWithinPartitions("conv_id", "turn", "role", "text")
    return placed.mapInArrow(lambda batches: _batched(results(_rows(batches)), arrow, 1), schema)


def compose(rows: list[dict]) -> tuple[dict, list[tuple[int, int]]]:
    """Totals of a conversation and the states each of its blocks begins and ends with, from their summaries in order."""
    go = [[cost for cost, _ in CLOSING]]
    for row in reversed(rows):
        after = go[-1]
        table = [[row["costs"][4 * s + t] for t in range(4)] for s in range(4)]
        go.append([min(cost + after[t] for t, cost in enumerate(costs) if cost is not None) for costs in table])
    go.reverse()
    state, chosen = START, []
    for row, after in zip(rows, go[1:], strict=True):
        options = [(row["costs"][4 * state + t] + after[t], row["ranks"][4 * state + t], t) for t in range(4) if row["costs"][4 * state + t] is not None]
        end = min(options)[2]
        chosen.append((state, end))
        state = end
    known = [row for row in rows if row["low"] is not None]
    distinct = sum(row["numbers"] for row in known) - sum(a["high"] == b["low"] for a, b in zip(known, known[1:]))
    totals = {name: sum(row[name] for row in rows) for name in ("blank", "duplicate", "truncated", "illegal")}
    totals["illegal"] += sum(a["tail"] + b["head"] not in LEGAL for a, b in zip(rows, rows[1:]))
    totals["gaps"] = known[-1]["high"] - known[0]["low"] + 1 - distinct if known else 0
    totals["cost"] = go[0][START]
    return totals, chosen


def in_blocks(turns: DataFrame) -> DataFrame:
    """Repair of conversations of any length."""
    schema = _result_schema(turns)
    arrow = _arrow(schema)
    cut = base.materialize(blocks(first_seen(turns)), "turn-blocks")
    settled_fields = "part int, block long, entry int, exit int, " + ", ".join(f"{name} long" for name in REPORT)
    settled_schema = T.StructType([T.StructField("conv_id", turns.schema["conv_id"].dataType), *T.StructType.fromDDL(settled_fields)])
    settled_arrow = _arrow(settled_schema)

    def settle(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda row: (row["part"], row["block"]))
        totals, chosen = compose(rows)
        made = [{"conv_id": row["conv_id"], "part": row["part"], "block": row["block"], "entry": s, "exit": t, **totals} for row, (s, t) in zip(rows, chosen, strict=True)]
        return pa.Table.from_pylist(made, schema=settled_arrow)

    numbers = cut.drop("audits", "roles", "texts", "faults")
    settled = numbers.groupBy("conv_id").applyInArrow(settle, settled_schema)
    held = cut.select(F.col("conv_id").alias("of"), F.col("part").alias("in_part"), F.col("block").alias("in_block"), "audits", "roles", "texts")
    mine = F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("part") == F.col("in_part")) & (F.col("block") == F.col("in_block"))
    joined = settled.join(held, mine).select(*settled_schema.names, F.get("audits", F.col("entry") * 4 + F.col("exit")).alias("audit"), "roles", "texts")

    def results(rows: Iterator[dict]) -> Iterator[dict]:
        for conv_id, own in _by_conversation(rows):
            digest, audits, begun, row = hashlib.sha256(), [], False, None
            for row in own:
                turns_of = (Turn(None, role, text, False) for role, text in zip(row["roles"], row["texts"], strict=True))
                audit = row["audit"]
                audits.append(audit)
                for line in repaired(turns_of, audit, row["entry"]):
                    digest.update((("\n" if begun else "") + line).encode())
                    begun = True
            audits.append(CLOSING[row["exit"]][1])
            for line in repaired((), audits[-1], row["exit"]):
                digest.update((("\n" if begun else "") + line).encode())
                begun = True
            yield {"conv_id": conv_id, **{name: row[name] for name in REPORT}, "audit": "".join(audits), "repaired_sha256": digest.hexdigest()}

    placed = joined.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block")
    return placed.mapInArrow(lambda batches: _batched(results(_rows(batches)), arrow, 1), schema)


def repair(conversations: DataFrame, damage: bool = True) -> DataFrame:
    """One row for every conv_id: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Without `damage` the turns are taken as they are, nulls as one space.
    """
    turns = damaged(conversations)
    if not damage:
        kept = [F.coalesce(F.col(name).cast("string"), F.lit(" ")).alias(name) for name in ("role", "text")]
        turns = conversations.select("conv_id", "turn", *kept, F.lit(1).cast("long").alias("copies"))
    size = conversations.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.col("text"))).alias("bytes"))
    large = base.materialize(size.filter((F.col("n") > MOST_TURNS) | (F.col("bytes") > MOST_BYTES)).select(F.col("conv_id").alias("large")), "large")
    if large.isEmpty():
        return whole(turns)
    same = F.col("conv_id").eqNullSafe(F.col("large"))
    cut = in_blocks(turns.join(large, same, "left_semi"))
    # A conversation of which damage left nothing has no block.
    empty = large.join(cut.select(F.col("conv_id").alias("done")), F.col("large").eqNullSafe(F.col("done")), "left_anti")
    nothing = [F.lit(0).cast("long").alias(name) for name in REPORT] + [F.lit("").alias("audit"), F.sha2(F.lit("").cast("binary"), 256).alias("repaired_sha256")]
    rest = empty.select(F.col("large").alias("conv_id"), *nothing)
    return whole(turns.join(large, same, "left_anti")).unionByName(cut).unionByName(rest)
