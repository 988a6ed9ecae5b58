"""Shaping of messages into the four tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidebook.functions.scalars import date_from_ms, event_ms
from tidebook.operators.routing import dispatch
from tidebook.schemas import BBO, DELTAS, TICKERS, TRADES


def _shape(df: DataFrame, schema: StructType, ts_ms: Column, **replaced: Column) -> DataFrame:
    """Pick the columns of `schema`, null where the input has none, and cast them."""
    have = set(df.columns)
    derived = {"ts_ms": F.col("_ms"), "ts": F.timestamp_millis("_ms"), "date": date_from_ms(F.col("_ms"))}
    derived.update(replaced)

    def pick(name: str) -> Column:
        if name in derived:
            return derived[name]
        return F.col(name) if name in have else F.lit(None)

    return df.withColumn("_ms", ts_ms.cast("bigint")).select(
        *[pick(field.name).cast(field.dataType).alias(field.name) for field in schema]
    )


def _time(df: DataFrame, ingest_ms: Column | None, created: bool = False) -> Column:
    created_time = F.col("created_time") if created and "created_time" in df.columns else None
    return event_ms(F.col("timestamp"), created_time, ingest_ms)


def to_trades(df: DataFrame, ingest_ms: Column | None = None) -> DataFrame:
    """Trades, with `yes` as the default taker side and `created_time` as the second choice of time."""
    side = F.col("taker_side") if "taker_side" in df.columns else F.lit(None).cast("string")
    return _shape(df, TRADES, _time(df, ingest_ms, created=True), taker_side=F.coalesce(side, F.lit("yes")))


def to_deltas(df: DataFrame, ingest_ms: Column | None = None) -> DataFrame:
    return _shape(df, DELTAS, _time(df, ingest_ms))


def to_tickers(df: DataFrame, ingest_ms: Column | None = None) -> DataFrame:
    return _shape(df, TICKERS, _time(df, ingest_ms))


def to_bbo(df: DataFrame, ingest_ms: Column | None = None) -> DataFrame:
    return _shape(df, BBO, _time(df, ingest_ms))


SHAPERS = {"trades": to_trades, "orderbook_deltas": to_deltas, "tickers": to_tickers, "bbo": to_bbo}


def shape_tables(feed: DataFrame, ingest_ms: Column | None = None) -> dict[str, DataFrame]:
    """All four tables of a feed, by the channel of each message."""
    return {table: SHAPERS[table](rows, ingest_ms) for table, rows in dispatch(feed).items()}
