"""Schemas of the feed and of the tables. Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T


TYPES = {
    "STRING": T.StringType(),
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "DOUBLE": T.DoubleType(),
    "TIMESTAMP": T.TimestampType(),
    "DATE": T.DateType(),
}


def _struct(columns: str) -> T.StructType:
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


# One struct holds the fields of every message kind; `type` tells them apart.
MESSAGE = _struct(
    "type STRING, ticker STRING, timestamp BIGINT, sequence BIGINT, "
    "side STRING, price DOUBLE, delta_size BIGINT, "
    "taker_side STRING, yes_price DOUBLE, no_price DOUBLE, count BIGINT, trade_id STRING, created_time STRING, "
    "last_price DOUBLE, best_bid DOUBLE, best_ask DOUBLE, volume BIGINT, open_interest BIGINT, "
    "bid_price DOUBLE, bid_size BIGINT, ask_price DOUBLE, ask_size BIGINT, mid_price DOUBLE, spread DOUBLE"
)

CORRUPT = "_corrupt_record"

ENVELOPE = T.StructType(
    [
        T.StructField("channel", T.StringType()),
        T.StructField("message", MESSAGE),
        T.StructField("arrival", T.LongType()),
        T.StructField(CORRUPT, T.StringType()),
    ]
)

# `arrival` is the position of the message in the feed. It is ours: Spark rows have no order, and
# the books depend on one.
TRADES = _struct(
    "ticker STRING, taker_side STRING, price DOUBLE, yes_price DOUBLE, no_price DOUBLE, count BIGINT, "
    "trade_id STRING, arrival BIGINT, ts_ms BIGINT, ts TIMESTAMP, date DATE"
)
DELTAS = _struct(
    "ticker STRING, side STRING, price DOUBLE, delta_size BIGINT, sequence BIGINT, "
    "arrival BIGINT, ts_ms BIGINT, ts TIMESTAMP, date DATE"
)
TICKERS = _struct(
    "ticker STRING, last_price DOUBLE, best_bid DOUBLE, best_ask DOUBLE, volume BIGINT, open_interest BIGINT, "
    "arrival BIGINT, ts_ms BIGINT, ts TIMESTAMP, date DATE"
)
BBO = _struct(
    "ticker STRING, bid_price DOUBLE, bid_size BIGINT, ask_price DOUBLE, ask_size BIGINT, "
    "mid_price DOUBLE, spread DOUBLE, arrival BIGINT, ts_ms BIGINT, ts TIMESTAMP, date DATE"
)

# Table written for each channel.
CHANNEL_TABLES = {"trade": "trades", "orderbook_delta": "orderbook_deltas", "ticker": "tickers", "bbo": "bbo"}
TABLE_SCHEMAS = {"trades": TRADES, "orderbook_deltas": DELTAS, "tickers": TICKERS, "bbo": BBO}
# Tables with a warm tier.
WARM_TABLES = ("trades", "orderbook_deltas")

TRADE_PAGE = T.StructType(
    [
        T.StructField("trades", T.ArrayType(MESSAGE)),
        T.StructField("cursor", T.StringType()),
        T.StructField("page_no", T.LongType()),
        T.StructField(CORRUPT, T.StringType()),
    ]
)

#: A page with the cursor it was asked for and the pull it belongs to.
LANDED_PAGE = T.StructType(
    [
        T.StructField("pull", T.StringType()),
        T.StructField("own", T.StringType()),
        T.StructField("cursor", T.StringType()),
        T.StructField("trades", T.ArrayType(MESSAGE)),
        T.StructField(CORRUPT, T.StringType()),
    ]
)

MARKET = _struct(
    "ticker STRING, title STRING, event_ticker STRING, series_ticker STRING, status STRING, "
    "yes_price INT, volume BIGINT"
)
MARKET_PAGE = T.StructType(
    [
        T.StructField("markets", T.ArrayType(MARKET)),
        T.StructField(CORRUPT, T.StringType()),
    ]
)

LADDER = T.ArrayType(T.ArrayType(T.DoubleType()))
LADDERS = T.StructType([T.StructField("yes", LADDER), T.StructField("no", LADDER)])
BOOK_PAGE = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("orderbook", LADDERS),
        T.StructField(CORRUPT, T.StringType()),
    ]
)
# `timestamp` is in epoch seconds here, unlike in the feed.
SNAPSHOT = T.StructType(
    [
        T.StructField("timestamp", T.LongType()),
        T.StructField("ticker", T.StringType()),
        T.StructField("orderbook", LADDERS),
        T.StructField("arrival", T.LongType()),
        T.StructField(CORRUPT, T.StringType()),
    ]
)
