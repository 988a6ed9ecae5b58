"""Bars, ranges and latest trades."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidebook.functions.scalars import floor_div, parse_day

UNIT_MS = {"second": 1_000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}


def interval_ms(interval: str) -> int:
    """`1 minute`, `5 minutes`, `1 hour`, `1 day` in milliseconds."""
    match = re.fullmatch(r"\s*(\d+)\s*(second|minute|hour|day)s?\s*", interval)
    if not match:
        raise ValueError(f"not an interval: {interval!r}")
    return int(match[1]) * UNIT_MS[match[2]]


def bars(trades: DataFrame, interval: str = "1 minute") -> DataFrame:
    """Open, high, low, close, volume and number of trades per ticker and calendar-aligned interval.

    First and last are by time, then by arrival where there is one. Trades of the API carry their price
    as `yes_price`, which counts where `price` is missing. Everything is combined before the shuffle, so a
    ticker with most of the trades sends one row per interval and task. Intervals without trades have no row.
    """
    width = interval_ms(interval)
    if "yes_price" in trades.columns:
        trades = trades.withColumn("price", F.coalesce("price", "yes_price"))
    priced = trades.filter(F.col("price").isNotNull() & F.col("ts_ms").isNotNull())
    moment = F.struct("ts_ms", "arrival")
    return priced.groupBy("ticker", (floor_div(F.col("ts_ms"), width) * width).alias("bar_ms")).agg(
        F.min_by("price", moment).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", moment).alias("close"),
        F.sum("count").alias("volume"),
        F.count("*").alias("trades"),
    )


def utc(value: dt.datetime) -> dt.datetime:
    """A bound without zone in UTC, whatever zone it was given in."""
    return value.astimezone(dt.timezone.utc).replace(tzinfo=None) if value.tzinfo else value


def _bound(df: DataFrame, value: dt.datetime) -> Column:
    """A literal of the same type as `ts`, so that the comparison is pushed into the scan."""
    text = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    if df.schema["ts"].dataType.typeName() == "timestamp_ntz":
        return F.lit(text).cast("timestamp_ntz")
    return F.to_timestamp(F.lit(text + "+00:00"))


def time_range(
    df: DataFrame,
    start: dt.datetime | None = None,
    end: dt.datetime | None = None,
    ticker: str | None = None,
) -> DataFrame:
    """Rows of a table with `start <= ts < end`, in UTC, and of one ticker.

    Where the table has a `date` column the implied days are filtered too: a filter on `ts` alone does
    not prune date partitions. A bound of zero or midnight counts as a bound.
    """
    dated = "date" in df.columns
    start, end = (bound and utc(bound) for bound in (start, end))
    if ticker is not None:
        df = df.filter(F.col("ticker") == ticker.upper())
    if start is not None:
        df = df.filter(F.col("ts") >= _bound(df, start))
        df = df.filter(F.col("date") >= F.lit(start.date())) if dated else df
    if end is not None:
        df = df.filter(F.col("ts") < _bound(df, end))
        last = (end - dt.timedelta(microseconds=1)).date()
        df = df.filter(F.col("date") <= F.lit(last)) if dated else df
    return df


def day_slice(df: DataFrame, day: str | dt.date) -> DataFrame:
    """One UTC day, from midnight up to but not including the next."""
    start = dt.datetime.combine(parse_day(day), dt.time())
    return time_range(df, start, start + dt.timedelta(days=1))


def ms_range(df: DataFrame, min_ms: int | None = None, max_ms: int | None = None) -> DataFrame:
    """Rows between two epoch-millisecond bounds, both included; 0 is a bound, None is not."""
    if min_ms is not None:
        df = df.filter(F.col("ts_ms") >= min_ms)
    if max_ms is not None:
        df = df.filter(F.col("ts_ms") <= max_ms)
    return df


def latest(trades: DataFrame, ticker: str, n: int = 20) -> DataFrame:
    """The newest `n` trades of a ticker, newest first; each task keeps only its own best `n`."""
    return (
        trades.filter(F.col("ticker") == ticker.upper()).orderBy(F.desc("ts_ms"), F.desc("arrival")).limit(n)
    )


def dedup_trades(trades: DataFrame) -> DataFrame:
    """Each trade once, for pages and days that overlap; of copies the first to arrive stays.

    Trades without an id cannot be copies of one another and all stay. Spark keeps one row per id in
    each task before the shuffle, so an id repeated without end does not pile up in one place.
    """
    identified = trades.filter(F.col("trade_id").isNotNull())
    order = F.row_number().over(Window.partitionBy("trade_id").orderBy("arrival"))
    first = identified.withColumn("copy", order).filter(F.col("copy") == 1).drop("copy")
    return first.unionByName(trades.filter(F.col("trade_id").isNull()))
