"""Keyed state held by Spark: gap flags and BBO changes message by message.

`EvictingBookKeeper` bounds what is live: an event-time timer runs for every ticker, and when it has been idle for
too long its levels leave the state and one packed value takes their place. When the ticker comes back the
book is unpacked and goes on as if it had never left.

For feeds whose micro-batches are small. All messages of one ticker in a batch go to one task and are
sorted there, so bound the batch on the source (`maxFilesPerTrigger`, `maxOffsetsPerTrigger`); for a
feed with a dominating ticker use `plant.plant_stream`, which cuts it up.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidebook.functions.scalars import book_side
from tidebook.operators.bbo import with_mid_spread
from tidebook.operators.replay import NO_LEVELS, replay_segment
from tidebook.operators.routing import valid_deltas
from tidebook.operators.trades import interval_ms

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

GAP_SCHEMA = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("arrival", T.LongType()),
        T.StructField("sequence", T.LongType()),
        T.StructField("last_sequence", T.LongType()),
        T.StructField("gap", T.BooleanType()),
    ]
)
QUOTE_SCHEMA = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("arrival", T.LongType()),
        T.StructField("ts_ms", T.LongType()),
        T.StructField("bid_price", T.DoubleType()),
        T.StructField("bid_size", T.LongType()),
        T.StructField("ask_price", T.DoubleType()),
        T.StructField("ask_size", T.LongType()),
    ]
)


def _in_order(chunks: Iterator[pd.DataFrame]) -> pd.DataFrame:
    """The rows of a ticker come in chunks of no order."""
    return pd.concat(list(chunks)).sort_values("arrival")


class GapDetector(StatefulProcessor):
    """Remembers the last sequence of a ticker."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        schema = T.StructType([T.StructField("sequence", T.LongType())])
        self.last = handle.getValueState("last", schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = _in_order(rows)
        before = self.last.get()[0] if self.last.exists() else None
        sequence = frame["sequence"].astype("Int64")
        last = sequence.shift(1)
        if before is not None:
            last.iloc[0] = before
        gap = (sequence != last + 1).fillna(False).astype(bool)
        self.last.update((int(sequence.iloc[-1]),))
        yield pd.DataFrame(
            {
                "ticker": key[0],
                "arrival": frame["arrival"],
                "sequence": sequence,
                "last_sequence": last,
                "gap": gap,
            }
        )

    def close(self) -> None:
        pass


class BookKeeper(StatefulProcessor):
    """Keeps the live levels of a ticker; the best prices follow from them."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        level = T.StructType([T.StructField("side", T.StringType()), T.StructField("price", T.DoubleType())])
        size = T.StructType([T.StructField("size", T.LongType())])
        self.levels = handle.getMapState("levels", level, size)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        yield self._changes(key, _in_order(rows))

    def _held(self) -> list[tuple[str, float, int]]:
        return [(side, price, size[0]) for (side, price), size in self.levels.iterator()]

    def _changes(self, key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        opening = pd.DataFrame(self._held(), columns=["book_side", "level", "size"])
        history = replay_segment(
            (pa.scalar(key[0]),),
            pa.Table.from_pandas(frame, preserve_index=False),
            pa.Table.from_pandas(opening, schema=NO_LEVELS.schema, preserve_index=False),
        )
        self._keep(frame, opening)
        return history.filter(history["changed"]).drop_columns(["changed"]).to_pandas(integer_object_nulls=True)

    def _keep(self, frame: pd.DataFrame, opening: pd.DataFrame) -> None:
        """Store the closing size of the levels that this batch touched."""
        levels = frame.groupby(["side", "price"])["delta_size"]
        totals = levels.agg(net="sum", low=lambda deltas: deltas.cumsum().min())
        opened = opening.set_index(["book_side", "level"])["size"].to_dict()
        for (side, price), total in totals.iterrows():
            size = int(total.net + max(opened.get((side, price), 0), -total.low))
            if size > 0:
                self.levels.updateValue((side, price), (size,))
            elif (side, price) in opened:
                self.levels.removeKey((side, price))

    def close(self) -> None:
        pass


class EvictingBookKeeper(BookKeeper):
    """A book keeper that parks the book of a ticker that has been idle for so long by the clock of the events.

    Besides quotes it tells of every book that is `parked` or `reopened`, with the number of its live levels.
    """

    def __init__(self, idle_ms: int) -> None:
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.handle = handle
        self.parked = handle.getValueState("parked", T.StructType([T.StructField("book", T.StringType())]))

    def _told(self, key: tuple, event: str, ts_ms: int, levels: int) -> pd.DataFrame:
        told = pd.DataFrame({name: [None] for name in EVENT_SCHEMA.names}).astype(object)
        told["ticker"], told["event"], told["ts_ms"], told["levels"] = key[0], event, ts_ms, levels
        return told

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = _in_order(rows)
        first, last = int(frame["ts_ms"].iloc[0]), int(frame["ts_ms"].max())
        if self.parked.exists():
            book = json.loads(self.parked.get()[0])
            for side, price, size in book:
                self.levels.updateValue((side, price), (size,))
            self.parked.clear()
            yield self._told(key, "reopened", first, len(book))
        changes = self._changes(key, frame.drop(columns=["ts"])).astype(object)
        yield changes.assign(event="quote", levels=None)[EVENT_SCHEMA.names]
        for expiry in list(self.handle.listTimers()):
            self.handle.deleteTimer(expiry)
        self.handle.registerTimer(max(last + self.idle_ms, timerValues.getCurrentWatermarkInMs() + 1))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        book = self._held()
        self.parked.update((json.dumps(book),))
        self.levels.clear()
        yield self._told(key, "parked", expiredTimerInfo.getExpiryTimeInMs(), len(book))


EVENT_SCHEMA = T.StructType([*QUOTE_SCHEMA, T.StructField("event", T.StringType()), T.StructField("levels", T.LongType())])


def _run(rows: DataFrame, processor: StatefulProcessor, schema: T.StructType, time_mode: str = "None") -> DataFrame:
    return rows.groupBy("ticker").transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=schema, outputMode="Append", timeMode=time_mode
    )


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """The state store that these operators need, for queries started inside."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def gap_stream(feed: DataFrame) -> DataFrame:
    """Messages with ticker and sequence, each with its gap flag. Needs the RocksDB state store (`rocksdb`)."""
    tracked = feed.filter((F.col("ticker") != "") & F.col("sequence").isNotNull())
    return _run(tracked.select("ticker", "arrival", "sequence"), GapDetector(), GAP_SCHEMA)


def _clean(deltas: DataFrame) -> DataFrame:
    clean = valid_deltas(deltas).withColumn("side", book_side(F.col("side")))
    return clean.select("ticker", "arrival", "ts_ms", "side", "price", "delta_size")


def bbo_change_stream(deltas: DataFrame) -> DataFrame:
    """BBO change events of a stream of deltas."""
    return with_mid_spread(_run(_clean(deltas), BookKeeper(), QUOTE_SCHEMA))


def evicting_book_stream(deltas: DataFrame, idle: str = "1 day", late: str = "1 hour") -> DataFrame:
    """BBO change events (`event` quote) of a stream whose idle books leave the state (parked, reopened).

    The clock is that of the events, `late` behind the newest; a delta that comes later than that is dropped by
    Spark, so choose `late` beyond what the source can delay.
    """
    timed = _clean(deltas).withColumn("ts", F.timestamp_millis("ts_ms")).withWatermark("ts", late)
    return with_mid_spread(_run(timed, EvictingBookKeeper(interval_ms(idle)), EVENT_SCHEMA, "EventTime"))


# Executors get the processors with the job, so the package need not be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
