import pytest

from model import random_deltas, replay
from tidebook.operators import bbo as quotes
from tidebook.operators import book, segments

DELTA = "arrival BIGINT, ticker STRING, side STRING, price DOUBLE, delta_size BIGINT, sequence BIGINT, ts_ms BIGINT"


def rows_of(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


@pytest.fixture(scope="module")
def case(spark):
    rows = random_deltas(3000)
    return spark.createDataFrame(rows, DELTA), replay(rows)


def fixture_deltas(spark, *rows):
    return spark.createDataFrame(
        [(i, "TEST", side, float(p), d, s, t) for i, (side, p, d, s, t) in enumerate(rows)], DELTA
    )


def test_bbo_and_depth_of_three_deltas(spark):
    deltas = fixture_deltas(spark, ("yes", 62, 100, 1, 1), ("yes", 61, 50, 2, 2), ("no", 45, 80, 3, 3))
    row = quotes.bbo(deltas).first()
    assert (row.bid_price, row.bid_size, row.ask_price, row.ask_size) == (62.0, 100, 45.0, 80)
    assert (row.mid_price, row.spread, row.sequence, row.ts_ms) == (53.5, -17.0, 3, 3)
    nested = book.depth_nested(book.book(deltas), 2).first()
    assert [tuple(x) for x in nested.yes] == [(62.0, 100), (61.0, 50)]
    assert [tuple(x) for x in nested.no] == [(45.0, 80)]


def test_crossed(spark):
    first = [("yes", 60, 10, None, None), ("no", 65, 10, None, None)]
    assert not quotes.crossed(quotes.bbo(fixture_deltas(spark, *first))).first().crossed
    crossing = fixture_deltas(spark, *first, ("no", 58, 5, None, None))
    assert quotes.crossed(quotes.bbo(crossing)).first().crossed
    touching = fixture_deltas(spark, *first, ("no", 60, 5, None, None))
    assert quotes.crossed(quotes.bbo(touching)).first().crossed


def test_one_sided_book(spark):
    row = quotes.crossed(quotes.bbo(fixture_deltas(spark, ("yes", 60, 10, None, 5)))).first()
    assert (row.ask_price, row.mid_price, row.spread, row.crossed, row.sequence) == (None, None, None, False, 0)


def test_emptied_book_keeps_its_ticker(spark):
    row = quotes.bbo(fixture_deltas(spark, ("yes", 60, 10, 1, 5), ("yes", 60, -15, 2, 6))).first()
    assert (row.ticker, row.bid_price, row.ask_price, row.ts_ms) == ("TEST", None, None, 6)


@pytest.mark.parametrize("rows", [1, 100, 100_000])
def test_level_sizes_match_model(case, rows):
    deltas, (_, sizes, _, _) = case
    assert rows_of(book.level_sizes(deltas, rows), "arrival", "size") == sizes


@pytest.mark.parametrize("rows", [7, 100_000])
def test_final_book_matches_model(case, rows):
    deltas, (books, _, _, _) = case
    expected = sorted(
        (t, s, p, n) for t, b in books.items() for s, levels in b.sides.items() for p, n in levels.items()
    )
    assert rows_of(book.book(deltas, rows=rows), "ticker", "side", "price", "size") == expected


def test_book_as_of(spark, case):
    deltas, _ = case
    books = replay(random_deltas(3000)[:1234])[0]
    expected = sorted(
        (t, s, p, n) for t, b in books.items() for s, levels in b.sides.items() for p, n in levels.items()
    )
    assert rows_of(book.book(deltas, as_of=1233, rows=50), "ticker", "side", "price", "size") == expected


def test_bbo_matches_model(case):
    deltas, (books, _, _, _) = case
    expected = sorted((t, *b.quote(), b.sequence, b.ts_ms) for t, b in books.items())
    names = ("ticker", "bid_price", "bid_size", "ask_price", "ask_size", "sequence", "ts_ms")
    assert rows_of(quotes.bbo(deltas, 64), *names) == expected


QUOTE = ("arrival", "ticker", "bid_price", "bid_size", "ask_price", "ask_size")


@pytest.mark.parametrize("rows", [7, 128, 100_000])
def test_bbo_history_matches_model(case, rows):
    deltas, (_, _, history, changes) = case
    result = quotes.bbo_history(deltas, rows=rows).cache()
    assert rows_of(result, *QUOTE) == history
    assert rows_of(quotes.bbo_changes(result), *QUOTE) == changes
    assert rows_of(quotes.bbo_changes_of(result, rows), *QUOTE) == changes
    result.unpersist()


def test_history_splits_at_an_opening_book(spark, case):
    _, (_, _, history, changes) = case
    rows = random_deltas(3000, prices=12)
    head = spark.createDataFrame(rows[:1000], DELTA)
    tail = spark.createDataFrame(rows[1000:], DELTA)
    opening = book.book(head, rows=100)
    result = quotes.bbo_history(tail, rows=100, opening=opening)
    assert rows_of(result, *QUOTE) == history[1000:]
    assert rows_of(result.filter("changed"), *QUOTE) == [c for c in changes if c[0] >= 1000]
    sizes = replay(rows)[1]
    assert rows_of(book.level_sizes(tail, 100, opening), "arrival", "size") == sizes[1000:]


def test_incomplete_deltas_take_no_part(spark):
    deltas = fixture_deltas(spark, ("yes", 60, 10, 1, 1), (None, 61, 10, 2, 2))
    assert rows_of(book.book(deltas), "price", "size") == [(60.0, 10)]


def test_many_levels(spark):
    rows = random_deltas(2000, tickers=3, prices=300, seed=9)
    result = quotes.bbo_history(spark.createDataFrame(rows, DELTA), rows=90)
    assert rows_of(result, *QUOTE) == replay(rows)[2]


def test_untouched_opening_levels_stay_live(spark):
    rows = random_deltas(240, prices=40, seed=4)
    _, _, history, _ = replay(rows)
    opening = book.book(spark.createDataFrame(rows[:200], DELTA))
    tail = spark.createDataFrame(rows[200:], DELTA)
    for size in (5, 1000):
        assert rows_of(quotes.bbo_history(tail, size, opening), *QUOTE) == history[200:]


def test_history_without_broadcasts(spark, case):
    deltas, (_, _, history, _) = case
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert rows_of(quotes.bbo_history(deltas, rows=200), *QUOTE) == history
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_replay_of_flickering_books_on_many_levels():
    import time

    import numpy as np

    from tidebook.operators.replay import _best

    rng = np.random.default_rng(1)
    total = 1 << 18
    price, delta = rng.integers(1, 10_001, total) / 10_000, rng.integers(-30, 31, total)
    begin = time.perf_counter()
    best, size = _best(np.arange(1, total + 1), price, delta, total, True)
    assert time.perf_counter() - begin < 4
    sizes: dict[float, int] = {}
    for slot in range(2000):
        sizes[price[slot]] = max(0, sizes.get(price[slot], 0) + int(delta[slot]))
        live = max((p for p, s in sizes.items() if s), default=np.nan)
        assert best[slot + 1] == live or np.isnan(best[slot + 1]) and np.isnan(live)
        assert size[slot + 1] == sizes.get(live, 0)


def test_a_snapshot_inside_a_second(spark):
    rows = [("T", "yes", 5.0, 7, 10_300, 1), ("T", "yes", 5.0, 3, 10_600, 2)]
    deltas = spark.createDataFrame(rows, "ticker STRING, side STRING, price DOUBLE, delta_size BIGINT, ts_ms BIGINT, arrival BIGINT")
    ladder = "ticker STRING, timestamp BIGINT, orderbook STRUCT<yes: ARRAY<ARRAY<DOUBLE>>, no: ARRAY<ARRAY<DOUBLE>>>, arrival BIGINT"
    for arrival, size in ((1, 10), (None, 17)):
        taken = spark.createDataFrame([("T", 10, ([[5.0, 7.0]], []), arrival)], ladder)
        assert [r["size"] for r in book.rebuild_book(taken, deltas).collect()] == [size]


def test_no_task_gets_a_whole_ticker(spark, tmp_path):
    """Rows are shuffled by ticker and segment, once, and never by ticker alone."""
    path = str(tmp_path / "deltas")
    spark.createDataFrame(random_deltas(500), DELTA).write.parquet(path)
    deltas = spark.read.parquet(path)
    history = quotes.bbo_history(deltas, rows=50)
    history.collect()
    plan = history._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "Reused" not in line]
    assert sum("REPARTITION_BY_COL" in line for line in shuffles) == 1
    assert "ReusedExchange" in plan
    sizes = book.level_sizes(deltas, rows=50)._jdf.queryExecution().executedPlan().toString()
    keys = [line.split("hashpartitioning(")[1] for line in sizes.splitlines() if "Exchange hashpartitioning" in line]
    assert all("price" in key or "seg" in key for key in keys) and len(keys) <= 4
    final = book.book(deltas, rows=50)._jdf.queryExecution().executedPlan().toString()
    assert final.count("Exchange hashpartitioning") == 2
