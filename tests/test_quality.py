import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidebook.operators import monitoring, quality
from tidebook.operators import segments
from tidebook.operators import trades as trade_ops

SEQ = "arrival BIGINT, ticker STRING, sequence BIGINT, ts_ms BIGINT"


def gap_model(rows):
    last, out = {}, []
    for arrival, ticker, sequence, _ in rows:
        flag = False
        if ticker and sequence is not None:
            flag = ticker in last and sequence != last[ticker] + 1
            last[ticker] = sequence
        out.append((arrival, flag))
    return out


def random_sequences(n, seed=3):
    rng = random.Random(seed)
    counters, rows = {}, []
    for arrival in range(n):
        ticker = rng.choice(["A", "A", "A", "B", "C", "", None])
        counters[ticker] = counters.get(ticker, 0) + rng.choice([1] * 8 + [0, 2, -1])
        sequence = None if rng.random() < 0.1 else counters[ticker]
        rows.append((arrival, ticker, sequence, arrival * 1000))
    return rows


def test_first_gap(spark):
    feed = spark.createDataFrame([(i, "TEST", s, 0) for i, s in enumerate([1, 2, 4])], SEQ)
    flags = [r.gap for r in quality.sequence_gaps(feed).orderBy("arrival").collect()]
    assert flags == [False, False, True]


@pytest.mark.parametrize("rows", [1, 13, 10_000])
def test_gaps_match_model(spark, rows):
    data = random_sequences(800)
    gaps = quality.sequence_gaps(spark.createDataFrame(data, SEQ), rows)
    assert sorted((r.arrival, r.gap) for r in gaps.collect()) == gap_model(data)


def test_gaps_go_on_from_an_opening_state(spark):
    data = random_sequences(800)
    last = {}
    for _, ticker, sequence, _ in data[:300]:
        if ticker and sequence is not None:
            last[ticker] = sequence
    opening = spark.createDataFrame(list(last.items()), "ticker STRING, last_sequence BIGINT")
    gaps = quality.sequence_gaps(spark.createDataFrame(data[300:], SEQ), 50, opening)
    assert sorted((r.arrival, r.gap) for r in gaps.collect()) == gap_model(data)[300:]


def test_missing_ranges_leave_out_repeats(spark):
    feed = spark.createDataFrame([(i, "T", s, 0) for i, s in enumerate([1, 1, 5, 3, 4])], SEQ)
    ranges = quality.missing_ranges(quality.sequence_gaps(feed)).collect()
    assert [(r.missing_from, r.missing_to) for r in ranges] == [(2, 4)]


@pytest.mark.parametrize("rows", [9, 10_000])
def test_number_rows(spark, rows):
    data = [(a * 3, t) for a, t in enumerate(random.Random(5).choices("AAAB", k=200))]
    numbered = segments.number_rows(spark.createDataFrame(data, "arrival BIGINT, ticker STRING"), "ticker", "n", rows)
    counts, expected = {}, []
    for arrival, ticker in data:
        counts[ticker] = counts.get(ticker, 0) + 1
        expected.append((arrival, counts[ticker]))
    assert sorted((r.arrival, r.n) for r in numbered.collect()) == expected


def test_sparse_arrivals_get_wider_segments(spark):
    sparse = spark.range(0, 1000).select((F.col("id") * 1_000_000).alias("arrival"))
    cut = segments.plan_cut(sparse, 100)
    assert not cut.whole and segments.with_segment(sparse, cut.width).select("seg").distinct().count() <= 14


def test_cuts_hold_with_outliers_and_refuse_rows_without_arrival(spark):
    for far in (10**15, 2 * 10**17, 9 * 10**18):
        feed = spark.range(0, 99_999).select(F.col("id").alias("arrival")).union(spark.range(1).select(F.lit(far).alias("arrival")))
        cut = segments.plan_cut(feed, 1024)
        largest = segments.with_segment(feed, cut.width).groupBy("seg").count().agg(F.max("count")).first()[0]
        assert largest <= 1024 + 2 * 100_000 // segments.SLICES
    with pytest.raises(ValueError, match="no arrival"):
        segments.plan_cut(feed.union(spark.range(1).select(F.lit(None).cast("bigint"))), 1024)


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_joins_do_not_depend_on_broadcasts_or_arrival(spark, threshold):
    table = spark.range(50).select(F.col("id").cast("string").alias("ticker"), F.col("id").alias("n"))
    feed = spark.range(1000).select(F.lit(None).cast("bigint").alias("arrival"), (F.col("id") % 60).cast("string").alias("ticker"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        rows = segments.join_spread(feed, table, ["ticker"], "left").collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(rows) == 1000 and all(r.n == (int(r.ticker) if int(r.ticker) < 50 else None) for r in rows)


def test_bars_without_arrival_and_of_api_trades(spark):
    rows = spark.createDataFrame([("T", None, 5.0, 1, None, 10), ("T", None, 7.0, 1, None, 20)], "ticker STRING, price DOUBLE, yes_price DOUBLE, count BIGINT, arrival BIGINT, ts_ms BIGINT")
    bar = trade_ops.bars(rows).first()
    assert (bar.open, bar.close, bar.trades) == (5.0, 7.0, 2)
    assert trade_ops.latest(rows, "t", 1).first().ts_ms == 20


def test_expected_tickers_without_trades_are_incomplete(spark):
    day = dt.date(2024, 1, 1)
    traded = spark.createDataFrame([("A", day, 5)], "ticker STRING, date DATE, count BIGINT")
    expected = spark.createDataFrame([("A", day, 5), ("B", day, 1)], "ticker STRING, date DATE, expected_volume BIGINT")
    checked = quality.completeness(traded, day, day, expected=expected)
    assert {(r.ticker, r.complete) for r in checked.collect()} == {("A", True), ("B", False)}
    report = {r.ticker: (r.gaps, r.inserted, r.complete) for r in quality.backfill_report(checked, traded).collect()}
    assert report == {"A": ([], 1, True), "B": ([day], 0, False)}


def trades(spark, *rows):
    data = [(t, float(p), n, i, i_ms, dt.date(1970, 1, 1) + dt.timedelta(milliseconds=i_ms)) for i, (t, p, n, i_ms) in enumerate(rows)]
    return spark.createDataFrame(
        data, "ticker STRING, price DOUBLE, count BIGINT, arrival BIGINT, ts_ms BIGINT, date DATE"
    )


def test_bars_break_ties_by_arrival(spark):
    rows = trades(spark, ("T", 5, 1, 60_500), ("T", 9, 2, 60_000), ("T", 7, 3, 60_000), ("T", 2, 4, 60_500), ("T", 1, 1, 120_000))
    bar = trade_ops.bars(rows, "1 minute").orderBy("bar_ms").first()
    assert (bar.bar_ms, bar.open, bar.high, bar.low, bar.close, bar.volume, bar.trades) == (60_000, 9, 9, 2, 2, 10, 4)


def test_bars_with_arrivals_too_wide_for_one_key(spark):
    rows = trades(spark, ("T", 5, 1, 0), ("T", 6, 1, 0))
    far = rows.withColumn("arrival", F.col("arrival") * F.lit(2**60))
    for frame in (rows, far):
        bar = trade_ops.bars(frame, "1 day").first()
        assert (bar.open, bar.close) == (5, 6)


def test_intervals():
    assert trade_ops.interval_ms("5 minutes") == 300_000
    with pytest.raises(ValueError):
        trade_ops.interval_ms("a while")


def test_range_bounds_count_even_when_zero(spark):
    rows = trades(spark, ("T", 1, 1, 0), ("T", 1, 1, 5))
    assert trade_ops.ms_range(rows, 0, 0).count() == 1
    assert trade_ops.ms_range(rows).count() == 2


def test_day_slice_is_half_open(spark):
    rows = spark.createDataFrame(
        [(dt.datetime(2024, 11, 15), 1), (dt.datetime(2024, 11, 15, 23, 59, 59), 2), (dt.datetime(2024, 11, 16), 3)],
        "ts TIMESTAMP, n INT",
    ).withColumn("date", F.to_date("ts"))
    assert [r.n for r in trade_ops.day_slice(rows, "2024-11-15").orderBy("n").collect()] == [1, 2]


def test_dedup_keeps_trades_without_id(spark):
    rows = spark.createDataFrame([("a", 2), ("a", 1), (None, 3), (None, 4)], "trade_id STRING, arrival BIGINT")
    assert sorted(r.arrival for r in trade_ops.dedup_trades(rows).collect()) == [1, 3, 4]


def test_completeness(spark):
    day = 86_400_000
    rows = trades(spark, ("A", 1, 5, 0), ("A", 1, 5, 2 * day), ("B", 1, 1, day))
    expected = spark.createDataFrame(
        [("A", dt.date(1970, 1, 1), 5), ("A", dt.date(1970, 1, 3), 6)], "ticker STRING, date DATE, expected_volume BIGINT"
    )
    checked = quality.completeness(rows, "1970-01-01", "1970-01-03", expected=expected)
    complete = {(r.ticker, r.date.day): r.complete for r in checked.collect()}
    assert complete == {
        ("A", 1): True, ("A", 2): False, ("A", 3): False, ("B", 1): False, ("B", 2): True, ("B", 3): False,
    }
    report = {r.ticker: r for r in quality.backfill_report(checked).collect()}
    assert (report["A"].trades, report["A"].incomplete_days, report["A"].missing_days) == (2, 2, 1)
    missing = quality.missing_days(rows, "1970-01-01", "1970-01-03", rows)
    assert sorted((r.ticker, r.date.day) for r in missing.collect()) == [("A", 2), ("B", 1), ("B", 3)]


def test_gap_rates(spark):
    data = [(i, "T", s, ms, g) for i, (s, ms, g) in enumerate([(1, 0, False), (3, 299_999, True), (4, 300_000, False)])]
    gaps = spark.createDataFrame(data, SEQ + ", gap BOOLEAN")
    rate = {r.window_ms: (r.gaps, r.alert) for r in monitoring.gap_rate(gaps).collect()}
    assert rate == {0: (1, True), 300_000: (0, False)}
    sliding = {r.window_ms: r.messages for r in monitoring.sliding_gap_rate(gaps).collect()}
    assert sliding[0] == 2 and sliding[60_000] == 2 and sliding[300_000] == 1 and sliding[-240_000] == 1


def test_latency_quantile(spark):
    rows = spark.createDataFrame([(0, float(i)) for i in range(1, 201)], "ts_ms BIGINT, latency DOUBLE")
    row = monitoring.latency_quantile(rows, "5 minutes", 99, limit=197.0).first()
    assert (row.messages, row.latency, row.alert) == (200, 198.0, True)
