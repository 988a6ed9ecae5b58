"""Deduplication against all trades ever seen, not only those within a watermark.

The history is a table of trade ids in hash buckets, one partition per bucket and batch. A batch reads the
buckets of its own ids, adds those that are new, and passes their trades on. A batch that is run again reads
what was there before it and replaces what it wrote.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidebook.operators.trades import dedup_trades
from tidebook.sources.feed import INTAKE
from tidebook.streaming.record import start, upsert_batch

BUCKETS = 256
HISTORY = "trade_id STRING, bucket INT, batch BIGINT"


def bucket_of(trade_id: str = "trade_id"):
    return F.pmod(F.xxhash64(trade_id), F.lit(BUCKETS)).cast("int")


def seen_before(spark: SparkSession, history: str, batch_id: int, buckets: list[int]) -> DataFrame:
    """The ids of some buckets that came with earlier batches."""
    try:
        rows = spark.read.schema(HISTORY).parquet(history)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], HISTORY)
    return rows.filter(F.col("bucket").isin(buckets) & (F.col("batch") < batch_id))


def dedup_batch(batch: DataFrame, batch_id: int, out: str, history: str) -> None:
    """Write the trades of a batch that no earlier batch had, each once; those without an id all pass."""
    spark = batch.sparkSession
    marked = dedup_trades(batch.drop(INTAKE)).withColumn("bucket", bucket_of()).persist()
    try:
        named = marked.filter(F.col("trade_id").isNotNull())
        buckets = [row.bucket for row in named.select("bucket").distinct().toLocalIterator()]
        known = seen_before(spark, history, batch_id, buckets).select("trade_id", "bucket")
        fresh = named.join(known, ["bucket", "trade_id"], "left_anti").select(*marked.columns)
        upsert_batch(fresh.unionByName(marked.filter(F.col("trade_id").isNull())).drop("bucket"), out, batch_id)
        ids = fresh.select("trade_id", "bucket").withColumn("batch", F.lit(batch_id)).hint("rebalance", "bucket")
        ids.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch").parquet(history)
    finally:
        marked.unpersist()


def dedup_history_stream(trades: DataFrame, out: str, history: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Each trade id of a stream once, however far apart its copies are."""
    return start(trades, checkpoint, lambda batch, batch_id: dedup_batch(batch, batch_id, out, history), **trigger)
