"""Bars that can be added to: states of bars, merged from minutes to hours to days.

The state of a bar has everything that merging needs: first and last price with their moments, high, low,
volume and number. Two states of one bar merge into that of all their trades, in any order, so late trades
only touch the bars they fall in, and coarse bars come from fine ones instead of from trades.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.functions.scalars import floor_div
from tidebook.operators.trades import interval_ms

MOMENT = ("ts_ms", "arrival")


def bar_states(trades: DataFrame, interval: str = "1 minute") -> DataFrame:
    """ticker, bar_ms and the state of every bar with trades."""
    width = interval_ms(interval)
    priced = trades.filter(F.col("price").isNotNull() & F.col("ts_ms").isNotNull())
    point = F.struct(*MOMENT, "price")
    return priced.groupBy("ticker", (floor_div(F.col("ts_ms"), width) * width).alias("bar_ms")).agg(
        F.min(point).alias("first"),
        F.max(point).alias("last"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.sum("count").alias("volume"),
        F.count(F.lit(1)).alias("trades"),
    )


def merge_states(states: DataFrame, interval: str | None = None) -> DataFrame:
    """States of one bar merged; with an interval, those of all bars inside each coarser one."""
    width = interval_ms(interval) if interval else 1
    return states.groupBy("ticker", (floor_div(F.col("bar_ms"), width) * width).alias("bar_ms")).agg(
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.sum("volume").alias("volume"),
        F.sum("trades").alias("trades"),
    )


def bars_of(states: DataFrame) -> DataFrame:
    """Bars as `trades.bars` gives them."""
    return states.select("ticker", "bar_ms", F.col("first.price").alias("open"), "high", "low", F.col("last.price").alias("close"), "volume", "trades")


def _day(column: str = "bar_ms"):
    return F.date_format(F.timestamp_millis(column), "yyyy-MM-dd")


def refresh(spark: SparkSession, path: str, trades: DataFrame, batch_id: int, intervals: tuple[str, ...] = ("1 minute", "1 hour", "1 day")) -> None:
    """Add the trades of a batch to the bars below `path`, in one folder per interval and day.

    The finest states are appended, as partitions of their batch, so a repeated batch replaces itself. A coarser
    interval is made from the next finer one, for the days that the batch has trades on and no others.
    """
    states = bar_states(trades, intervals[0])
    dated = states.withColumn("day", _day()).withColumn("batch", F.lit(batch_id)).persist()
    try:
        _write(dated, path, intervals[0], "day", "batch")
        days = [row.day for row in dated.select("day").distinct().toLocalIterator()]
        if not days:
            return
        touched = F.col("day").isin(days)
        for finer, coarser in zip(intervals, intervals[1:]):
            merged = merge_states(read_states(spark, path, finer, states).filter(touched).drop("day"), coarser)
            _write(merged.withColumn("day", _day()), path, coarser, "day")
    finally:
        dated.unpersist()


def _write(rows: DataFrame, path: str, interval: str, *by: str) -> None:
    folder = f"{path}/{interval.replace(' ', '-')}"
    rows.hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(folder)


def read_states(spark: SparkSession, path: str, interval: str, like: DataFrame) -> DataFrame:
    """The states of an interval with their day; those of several batches are still apart."""
    schema = reduce(lambda made, name: made.add(name, "string"), ("day",), type(like.schema)(list(like.schema.fields)))
    return spark.read.schema(schema).parquet(f"{path}/{interval.replace(' ', '-')}")


def read_bars(spark: SparkSession, path: str, interval: str, trades: DataFrame) -> DataFrame:
    """The bars of an interval as of the last batch. `trades` gives the types of their columns."""
    return bars_of(merge_states(read_states(spark, path, interval, bar_states(trades, interval)).drop("day")))
