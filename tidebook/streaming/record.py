"""Writing a message stream to the hot tables and to per-channel outputs."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidebook.operators.tables import shape_tables
from tidebook.operators.tiers import Tiers, write_hot
from tidebook.sources.feed import INTAKE


def start(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], **trigger) -> StreamingQuery:
    """Run `each(batch, batch_id)` for every micro-batch; by default until the input is used up."""
    return (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def record_batch(batch: DataFrame, batch_id: int, tiers: Tiers, now_ms: int | None = None) -> None:
    """Write one micro-batch to the four hot tables. A repeated batch replaces what it wrote before.

    Messages without any time get the time at which they came in, by their file or record, so that a
    batch run again writes the same rows; where the source does not say, `now_ms`.
    """
    now = F.lit(now_ms if now_ms is not None else int(time.time() * 1000)).cast("bigint")
    taken = F.coalesce(F.col(INTAKE), now) if INTAKE in batch.columns else now
    batch.persist()
    try:
        for table, rows in shape_tables(batch, taken).items():
            write_hot(rows, tiers, table, f"stream-{batch_id}")
    finally:
        batch.unpersist()


def record_stream(stream: DataFrame, tiers: Tiers, checkpoint: str, **trigger) -> StreamingQuery:
    """Record a feed into the hot tables. The size of a batch is set on the source."""
    return start(stream, checkpoint, lambda batch, batch_id: record_batch(batch, batch_id, tiers), **trigger)


def publish_batch(events: DataFrame, path: str, batch_id: int) -> None:
    """Append events to one folder per channel; the same batch written again replaces itself."""
    (
        events.withColumn("batch", F.lit(batch_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("channel", "batch")
        .parquet(path)
    )


def topic_rows(events: DataFrame, prefix: str = "") -> DataFrame:
    """Events as `topic, key, value` for a Kafka sink, keyed by ticker so that their order is kept."""
    fields = [name for name in events.columns if name not in ("channel", "ord")]
    return events.select(
        F.concat(F.lit(prefix), F.col("channel")).alias("topic"),
        F.col("ticker").alias("key"),
        F.to_json(F.struct(*fields)).alias("value"),
    )


def upsert_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """Keep what a micro-batch changed in an aggregate; the same batch written again replaces itself."""
    rows.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)


def upsert_stream(rows: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Run an aggregate in update mode: every batch adds the windows it changed, also those still open."""
    writer = rows.writeStream.outputMode("update").foreachBatch(lambda batch, batch_id: upsert_batch(batch, path, batch_id))
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def newest(spark: SparkSession, path: str, schema: T.StructType, keys: list[str]) -> DataFrame:
    """The latest version of every window of an `upsert_stream`."""
    held = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(path)
    values = [name for name in schema.names if name not in keys]
    last = held.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("last"))
    return last.select(*keys, "last.*").select(*schema.names)
