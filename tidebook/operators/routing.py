"""Routing and checking of feed messages.

A feed is a DataFrame with `channel`, `arrival` and the fields of `schemas.MESSAGE`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidebook.functions.scalars import upper_ticker
from tidebook.operators.segments import join_spread
from tidebook.schemas import CHANNEL_TABLES

MESSAGE_TYPES = ("orderbook_delta", "trade", "ticker")
DELTA_KEYS = ("ticker", "side", "price", "delta_size")


def of_type(feed: DataFrame, kind: str) -> DataFrame:
    return feed.filter(F.col("type") == kind)


def route(feed: DataFrame) -> dict[str, DataFrame]:
    """One branch per supported message type. Other types are in no branch; `type_counts` shows them."""
    return {kind: of_type(feed, kind) for kind in MESSAGE_TYPES}


def pass_through(feed: DataFrame) -> DataFrame:
    """Trades and tickers, which are forwarded as they are."""
    return feed.filter(F.col("type").isin("trade", "ticker"))


def dispatch(feed: DataFrame) -> dict[str, DataFrame]:
    """One branch per table, by the channel of the envelope."""
    return {table: feed.filter(F.col("channel") == channel) for channel, table in CHANNEL_TABLES.items()}


def type_counts(feed: DataFrame) -> DataFrame:
    """Messages of each type and whether the type is one we route."""
    return feed.groupBy(F.coalesce("type", F.lit("")).alias("type")).agg(
        F.count("*").alias("messages"),
        F.max(F.coalesce(F.col("type").isin(*MESSAGE_TYPES), F.lit(False))).alias("supported"),
    )


def _missing(keys: tuple[str, ...]) -> Column:
    return F.filter(
        F.array(*[F.when(F.col(key).isNull(), F.lit(key)) for key in keys]), lambda name: name.isNotNull()
    )


def valid_deltas(deltas: DataFrame) -> DataFrame:
    """Deltas with all four required fields."""
    # One plain null check per column: Spark pushes these into the scan and knows the columns non-null.
    for key in DELTA_KEYS:
        deltas = deltas.filter(F.col(key).isNotNull())
    return deltas


def quarantined_deltas(deltas: DataFrame) -> DataFrame:
    """Deltas without one of the required fields, with the names of those missing."""
    return deltas.withColumn("missing", _missing(DELTA_KEYS)).filter(F.size("missing") > 0)


def quarantined_messages(feed: DataFrame) -> DataFrame:
    """Messages no branch takes: those of unknown type and incomplete deltas, with the reason."""
    unknown = ~F.coalesce(F.col("type").isin(*MESSAGE_TYPES), F.lit(False))
    lacking = F.when(F.col("type") == "orderbook_delta", _missing(DELTA_KEYS))
    reason = F.when(unknown, F.concat(F.lit("type "), F.coalesce("type", F.lit("missing")))).when(
        F.size(lacking) > 0, F.concat(F.lit("without "), F.concat_ws(",", lacking))
    )
    return feed.withColumn("reason", reason).filter(F.col("reason").isNotNull())


# --- subscriptions -------------------------------------------------------------------------------


def merge_subscriptions(*requests: DataFrame) -> DataFrame:
    """Union of `(channel, ticker)` requests, tickers upper-cased, each pair once."""
    merged = requests[0].select("channel", "ticker")
    for request in requests[1:]:
        merged = merged.unionByName(request.select("channel", "ticker"))
    return merged.select("channel", upper_ticker(F.col("ticker")).alias("ticker")).distinct()


def subscription_message(subscriptions: DataFrame) -> DataFrame:
    """Per channel the sorted list of its tickers, as sent to the exchange."""
    return subscriptions.groupBy("channel").agg(F.array_sort(F.collect_set("ticker")).alias("tickers"))


def subscribe(feed: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Messages of the subscribed `(channel, ticker)` pairs.

    The pairs are handed to every task while they are few; beyond that the feed is shuffled in salted
    parts.
    """
    wanted = merge_subscriptions(subscriptions)
    return join_spread(feed, wanted, ["channel", "ticker"], "left_semi")
