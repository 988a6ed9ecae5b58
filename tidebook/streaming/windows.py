"""Windowed aggregates of a stream, with a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bars_stream(trades: DataFrame, interval: str = "1 minute", late: str = "10 minutes") -> DataFrame:
    """Bars over event time. A bar is final once the watermark has passed its end."""
    moment = F.struct("ts_ms", "arrival")
    return (
        trades.filter(F.col("price").isNotNull())
        .withWatermark("ts", late)
        .groupBy("ticker", F.window("ts", interval).alias("bar"))
        .agg(
            F.min_by("price", moment).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", moment).alias("close"),
            F.sum("count").alias("volume"),
            F.count("*").alias("trades"),
        )
        .select("ticker", F.col("bar.start").alias("bar_start"), "open", "high", "low", "close", "volume", "trades")
    )


def gap_rate_stream(
    gaps: DataFrame, interval: str = "5 minutes", every: str = "1 minute", late: str = "10 minutes"
) -> DataFrame:
    """Gaps in sliding windows, with the alert."""
    return (
        gaps.withWatermark("ts", late)
        .groupBy(F.window("ts", interval, every).alias("span"))
        .agg(F.count("*").alias("messages"), F.sum(F.col("gap").cast("bigint")).alias("gaps"))
        .select(F.col("span.start").alias("window_start"), "messages", "gaps", (F.col("gaps") > 0).alias("alert"))
    )


def dedup_stream(trades: DataFrame, late: str = "1 hour") -> DataFrame:
    """Each trade id once within the watermark. Trades without an id are no copies of one another: all stay."""
    named = trades.filter(F.col("trade_id").isNotNull())
    once = named.withWatermark("ts", late).dropDuplicatesWithinWatermark(["trade_id"])
    return once.unionByName(trades.filter(F.col("trade_id").isNull()))
