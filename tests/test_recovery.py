"""Recovery from gaps, parked books, deduplication against all history: streams against the sequential model."""

import random

import pytest
from pyspark.sql import functions as F

from model import random_deltas, replay
from test_streaming import QUOTE, land, run_to_parquet
from tidebook.schemas import MESSAGE
from tidebook.streaming import history, recovery, stateful

LADDERS = "struct<yes:array<array<double>>,no:array<array<double>>>"
ROW = "channel STRING, arrival BIGINT, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in MESSAGE) + f", orderbook {LADDERS}"


def message(arrival, ticker, sequence, side="yes", price=1.0, delta=1):
    fields = dict(type="orderbook_delta", ticker=ticker, timestamp=arrival, sequence=sequence, side=side, price=price, delta_size=delta)
    return ("orderbook_delta", arrival, *[fields.get(f.name) for f in MESSAGE], None)


def snapshot(arrival, ticker, yes, no=()):
    fields = dict(type=recovery.TYPE, ticker=ticker, timestamp=0)
    book = {"yes": [list(level) for level in yes], "no": [list(level) for level in no]}
    return (None, arrival, *[fields.get(f.name) for f in MESSAGE], book)


def run(spark, tmp_path, batches, again=()):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for number, rows in enumerate(batches):
        for _ in range(2 if number in again else 1):
            recovery.recover_batch(spark.createDataFrame(rows, ROW).repartition(2), number, out, state, rows=4)
    book = {(r.ticker, r.side, r.price): r.size for r in recovery.recovered_book(spark, out).collect()}
    log = sorted(tuple(r[n] for n in ("ticker", "stale_since", "last_gap", "recovered_at")) for r in recovery.recoveries(spark, out).collect())
    return book, log


def test_a_stale_book_waits_for_its_snapshot(spark, tmp_path):
    batches = [
        [message(1, "A", 1), message(2, "A", 2), message(3, "B", 1, price=2.0)],
        [message(6, "A", 4, delta=5), message(7, "B", 2, price=2.0)],  # 3 of A was lost
        [message(8, "A", 5, price=3.0), snapshot(4, "A", [(1.0, 9.0)])],  # too old: taken before the gap
    ]
    book, log = run(spark, tmp_path / "before", batches)
    assert book == {("A", "yes", 1.0): 2, ("B", "yes", 2.0): 2} and log == []
    batches.append([snapshot(7, "A", [(1.0, 20.0), (4.0, 1.0)]), message(9, "A", 6), snapshot(7, "B", [(7.0, 7.0)])])
    book, log = run(spark, tmp_path / "after", batches, again=(1, 3))
    assert book == {("A", "yes", 1.0): 21, ("A", "yes", 3.0): 1, ("A", "yes", 4.0): 1, ("B", "yes", 2.0): 2}
    assert log == [("A", 6, 6, 7)]


def test_messages_that_a_snapshot_has_seen_may_come_after_it(spark, tmp_path):
    batches = [
        [message(1, "A", 1), message(3, "A", 3)],
        [snapshot(6, "A", [(1.0, 50.0)])],
        [message(4, "A", 4), message(5, "A", 6), message(6, "A", 7), message(7, "A", 8)],  # the gap at 5 lies before the snapshot
        [message(8, "A", 9), message(10, "A", 11)],  # and this one after it
    ]
    book, log = run(spark, tmp_path, batches)
    assert book == {("A", "yes", 1.0): 52} and log == [("A", 3, 3, 6)]


def test_random_losses(spark, tmp_path):
    """A third of the rows on one ticker, losses up to a point, a snapshot of all books at a later one."""
    rng = random.Random(4)
    rows = [(a, t, s if s in ("yes", "no") else "no", p, d) for a, t, s, p, d, _, _ in random_deltas(800)]
    counts = {}
    numbered = []
    for a, t, s, p, d in rows:
        counts[t] = counts.get(t, 0) + 1
        numbered.append(message(a, t, counts[t], s, p, d))
    kept = [m for m in numbered if m[1] >= 300 or rng.random() > 0.1]
    books = replay([(a, t, s, p, d, None, a) for a, t, s, p, d in rows if a <= 420])[0]
    polls = [snapshot(420, t, [(p, float(n)) for p, n in b.sides["yes"].items()], [(p, float(n)) for p, n in b.sides["no"].items()]) for t, b in books.items()]
    batches = [[m for m in kept if m[1] * 5 // 800 == k] for k in range(5)]
    batches[3] += polls
    book, log = run(spark, tmp_path, batches, again=(3,))
    final = replay([(a, t, s, p, d, None, a) for a, t, s, p, d in rows])[0]
    assert book == {(t, s, p): n for t, b in final.items() for s, levels in b.sides.items() for p, n in levels.items()}
    assert {entry[3] for entry in log} == {420}


@pytest.fixture
def rocksdb(spark):
    with stateful.rocksdb(spark):
        yield


def test_idle_books_are_parked_and_reopened(spark, tmp_path, rocksdb):
    """T1 is idle in the second and third file, so it must not be live there, and goes on in the fourth as it was."""
    rows = [r if r[1] != "T1" or not 200 <= r[0] < 600 else (r[0], "T0", *r[2:]) for r in random_deltas(800)]
    rows = [(a, t, s, p, d, q, 10**9 + a * 1000) for a, t, s, p, d, q, _ in rows]
    deltas = land(spark, tmp_path / "feed", rows, 4).withColumn("ts_ms", F.col("timestamp"))
    events = run_to_parquet(spark, stateful.evicting_book_stream(deltas, idle="1 minute", late="1 second"), tmp_path).collect()
    quotes = sorted(tuple(r[n] for n in QUOTE) for r in events if r.event == "quote")
    assert quotes == replay(rows)[3]
    parked = [r for r in events if r.event == "parked" and r.ticker == "T1"]
    reopened = [r for r in events if r.event == "reopened" and r.ticker == "T1"]
    assert parked and reopened and reopened[0].levels == parked[0].levels > 0
    assert 200_000 <= parked[0].ts_ms - 10**9 < 600_000 <= reopened[0].ts_ms - 10**9


def test_history_of_trades(spark, tmp_path):
    out, seen = str(tmp_path / "out"), str(tmp_path / "seen")
    schema = "trade_id STRING, arrival BIGINT"
    batches = [[("a", 1), ("a", 2), (None, 3)], [("b", 4), ("a", 5), (None, 6)], [], [("c", 7), ("b", 8), ("a", 9)]]
    for number, rows in enumerate(batches):
        for _ in range(2):  # each batch is run again
            history.dedup_batch(spark.createDataFrame(rows, schema), number, out, seen)
    assert sorted(r.arrival for r in spark.read.parquet(out).collect()) == [1, 3, 4, 6, 7]
