"""Order-book snapshot logs: one JSON row per ticker and poll."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.operators.book import depth_nested
from tidebook.schemas import CORRUPT, SNAPSHOT


def read_snapshot_log(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Snapshots `timestamp (s), ticker, orderbook, arrival`; unreadable lines are left out.

    `arrival` is the last message in the snapshot, null where the log does not say.
    """
    rows = spark.read.schema(SNAPSHOT).option("columnNameOfCorruptRecord", CORRUPT).json(path)
    return rows.filter(F.col("timestamp").isNotNull()).select("timestamp", "ticker", "orderbook", "arrival")


def write_snapshot_log(snapshots: DataFrame, path: str) -> None:
    """Append snapshots as JSON, one folder per UTC day, the polls of a ticker next to one another."""
    dated = snapshots.withColumn("date", F.to_date(F.timestamp_seconds("timestamp")))
    dated.hint("rebalance", "date").sortWithinPartitions("date", "ticker", "timestamp").write.mode("append").partitionBy("date").json(path)


def snapshot_of(levels: DataFrame, timestamp, top: int | None = None, arrival=None) -> DataFrame:
    """A live book (`ticker, side, price, size`) as one snapshot row per ticker, best levels first.

    `arrival` is the last message that the book has seen.
    """

    def ladder(side: str):
        return F.transform(F.col(side), lambda e: F.array(e["price"], e["size"].cast("double")))

    return depth_nested(levels, top).select(
        timestamp.cast("bigint").alias("timestamp"),
        "ticker",
        F.struct(ladder("yes").alias("yes"), ladder("no").alias("no")).alias("orderbook"),
        (F.lit(None) if arrival is None else arrival).cast("bigint").alias("arrival"),
    )
