"""Scalar expressions: integer buckets, times, prices, text."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MS = 86_400_000


def floor_div(value: Column, width: Column | int) -> Column:
    """Integer division rounding down, exact over the whole BIGINT range."""
    width = width if isinstance(width, Column) else F.lit(width).cast("bigint")
    return F.call_function("div", value - F.pmod(value, width), width)


# --- time ----------------------------------------------------------------------------------------


def ms_from_ts(ts: Column) -> Column:
    """Epoch milliseconds of a timestamp column, rounding down."""
    return floor_div(F.unix_micros(ts.cast("timestamp")), 1000)


def ns_from_ms(ms: Column) -> Column:
    return ms * F.lit(1_000_000).cast("bigint")


def date_from_ms(ms: Column) -> Column:
    """UTC day, by integer arithmetic, so it does not depend on the session time zone."""
    return F.date_add(F.lit("1970-01-01").cast("date"), floor_div(ms, DAY_MS).cast("int"))


def event_ms(timestamp: Column, created_time: Column | None, ingest_ms: Column | None) -> Column:
    """Time of a message: its own `timestamp`, else its ISO `created_time`, else when it was taken in."""
    options = [timestamp]
    if created_time is not None:
        options.append(F.unix_millis(F.try_to_timestamp(created_time)))
    if ingest_ms is not None:
        options.append(ingest_ms)
    return F.coalesce(*options)


def book_ms(ts_ms: Column, ingest_ms: Column | None) -> Column:
    """Last-update time of a book; a zero counts as missing here, unlike in the tables."""
    if ingest_ms is None:
        return ts_ms
    return F.when(ts_ms.isNull() | (ts_ms == 0), ingest_ms).otherwise(ts_ms)


def parse_day(text: str | dt.date) -> dt.date:
    """`YYYY-MM-DD` to a date; a date passes through."""
    return text if isinstance(text, dt.date) else dt.datetime.strptime(text, "%Y-%m-%d").date()


def parse_day_column(text: Column) -> Column:
    return F.to_date(text, "yyyy-MM-dd")


def day_start_seconds(day: Column) -> Column:
    """Epoch seconds of UTC midnight."""
    return F.unix_date(day).cast("bigint") * F.lit(86_400).cast("bigint")


# --- prices --------------------------------------------------------------------------------------


def book_side(side: Column) -> Column:
    """`yes` is the bid side; every other side is the ask side."""
    return F.when(side == "yes", F.lit("yes")).otherwise(F.lit("no"))


def mid_price(bid: Column, ask: Column) -> Column:
    return F.round((bid + ask) / 2, 4)


def spread(bid: Column, ask: Column) -> Column:
    return F.round(ask - bid, 4)


def is_crossed(bid: Column, ask: Column) -> Column:
    """Best bid at or above best ask; false when a side is empty."""
    return F.coalesce(bid >= ask, F.lit(False))


def pair_changed(left: tuple[Column, Column], right: tuple[Column, Column]) -> Column:
    """Whether two pairs differ, taking null as an ordinary value."""
    return ~(left[0].eqNullSafe(right[0]) & left[1].eqNullSafe(right[1]))


# --- text ----------------------------------------------------------------------------------------


def upper_ticker(ticker: Column) -> Column:
    return F.upper(ticker)


def default_text(value: Column, default: str = "") -> Column:
    return F.coalesce(value, F.lit(default))


def clip_json(value: Column, length: int = 800) -> Column:
    return F.substring(F.to_json(value), 1, length)
