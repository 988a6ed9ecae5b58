"""Sequence continuity and completeness of days."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidebook.functions.scalars import parse_day
from tidebook.operators.segments import SEGMENT_ROWS, Cut, plan_cut, with_segment


def sequence_gaps(
    feed: DataFrame, rows: int = SEGMENT_ROWS, opening: DataFrame | None = None, cut: Cut | None = None
) -> DataFrame:
    """Every message with the last sequence of its ticker and whether it breaks the count.

    A gap is any sequence other than last + 1, so repeats and steps back count too; the first message of
    a ticker never does. Messages without ticker or sequence are kept, flagged false, and leave the
    last sequence as it is. All channels of a ticker share one count. `opening` gives the last sequence
    of tickers seen before, as `ticker, last_sequence`.
    """
    tracked = F.coalesce(F.col("ticker") != "", F.lit(False)) & F.col("sequence").isNotNull()
    marked = feed.withColumn("tracked", tracked)
    plan = cut or plan_cut(marked, rows)
    placed = with_segment(marked, plan.width)
    within = Window.partitionBy("tracked", "ticker", "seg").orderBy("arrival")
    last = F.when(F.col("tracked"), F.lag("sequence").over(within))
    flagged = placed.withColumn("last_sequence", last)
    if not plan.whole or opening is not None:
        ends = last_sequences(placed, "seg")
        if opening is not None:
            ends = ends.unionByName(
                opening.select("ticker", "last_sequence", F.lit(-(2**62)).cast("bigint").alias("seg"))
            )
        earlier = F.lag("last_sequence").over(Window.partitionBy("ticker").orderBy("seg"))
        carried = ends.select(F.lit(True).alias("tracked"), "ticker", "seg", earlier.alias("carried"))
        flagged = (
            flagged.join(carried, ["tracked", "ticker", "seg"], "left")
            .withColumn("last_sequence", F.coalesce("last_sequence", "carried"))
            .drop("carried")
        )
    gap = F.coalesce(F.col("sequence") != F.col("last_sequence") + 1, F.lit(False))
    return flagged.withColumn("gap", gap).drop("tracked", "seg")


def last_sequences(tracked: DataFrame, *within: str) -> DataFrame:
    """Last sequence of each ticker (and of each value of `within`) by arrival."""
    rows = tracked.filter(F.col("sequence").isNotNull() & (F.col("ticker") != ""))
    return rows.groupBy("ticker", *within).agg(F.max_by("sequence", "arrival").alias("last_sequence"))


def missing_ranges(gaps: DataFrame) -> DataFrame:
    """The sequence numbers a refill would have to ask for: `missing_from..missing_to` of each hole."""
    return gaps.filter(F.col("sequence") > F.col("last_sequence") + 1).select(
        "ticker",
        "arrival",
        (F.col("last_sequence") + 1).alias("missing_from"),
        (F.col("sequence") - 1).alias("missing_to"),
    )


def day_spine(tickers: DataFrame, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """One row per ticker and day, both ends included."""
    days = F.sequence(F.lit(parse_day(start)), F.lit(parse_day(end)))
    return tickers.select("ticker").distinct().select("ticker", F.explode(days).alias("date"))


def daily_counts(trades: DataFrame) -> DataFrame:
    return trades.groupBy("ticker", "date").agg(F.count("*").alias("trades"), F.sum("count").alias("volume"))


def completeness(
    trades: DataFrame,
    start: str | dt.date,
    end: str | dt.date,
    tickers: DataFrame | None = None,
    expected: DataFrame | None = None,
) -> DataFrame:
    """Trades and volume of each ticker and day in the range against what was expected.

    `expected` has `ticker, date, expected_volume`. A day is complete if it has trades and, where a
    volume is expected, at least that volume. `tickers` defaults to those that have a trade in the range
    or are expected there.
    """
    first, last = parse_day(start), parse_day(end)
    in_range = F.col("date").between(F.lit(first), F.lit(last))
    actual = daily_counts(trades.filter(in_range))
    if tickers is None:
        tickers = actual.select("ticker")
        if expected is not None:
            tickers = tickers.unionByName(expected.filter(in_range).select("ticker"))
    days = day_spine(tickers, first, last)
    checked = days.join(actual, ["ticker", "date"], "left")
    if expected is None:
        checked = checked.withColumn("expected_volume", F.lit(None).cast("bigint"))
    else:
        checked = checked.join(expected.select("ticker", "date", "expected_volume"), ["ticker", "date"], "left")
    zero = F.lit(0).cast("bigint")
    wanted = F.coalesce("expected_volume", zero)
    return (
        checked.withColumn("trades", F.coalesce("trades", zero))
        .withColumn("volume", F.coalesce("volume", zero))
        .withColumn("complete", (F.col("trades") > 0) & (F.col("volume") >= wanted))
    )


def missing_days(trades: DataFrame, start: str | dt.date, end: str | dt.date, tickers: DataFrame) -> DataFrame:
    """Days without a single trade: the list to fetch again."""
    first, last = parse_day(start), parse_day(end)
    have = trades.filter(F.col("date").between(F.lit(first), F.lit(last))).select("ticker", "date").distinct()
    return day_spine(tickers, first, last).join(have, ["ticker", "date"], "left_anti")


def backfill_report(checked: DataFrame, inserted: DataFrame | None = None) -> DataFrame:
    """Per ticker: trades, first and last day with trades, the incomplete and the missing days.

    `gaps` lists the days without a trade, one entry per day of the range at most; `complete` says that
    no day is incomplete. `inserted` are the trades a backfill wrote; their number is added.
    """
    has_trades = F.when(F.col("trades") > 0, F.col("date"))
    report = checked.groupBy("ticker").agg(
        F.sum("trades").alias("trades"),
        F.min(has_trades).alias("first_day"),
        F.max(has_trades).alias("last_day"),
        F.sum((~F.col("complete")).cast("bigint")).alias("incomplete_days"),
        F.sum((F.col("trades") == 0).cast("bigint")).alias("missing_days"),
        F.array_sort(F.collect_set(F.when(F.col("trades") == 0, F.col("date")))).alias("gaps"),
        F.min("complete").alias("complete"),
    )
    if inserted is None:
        return report
    written = inserted.groupBy("ticker").agg(F.count(F.lit(1)).alias("inserted"))
    return report.join(written, "ticker", "left").withColumn("inserted", F.coalesce("inserted", F.lit(0).cast("bigint")))
