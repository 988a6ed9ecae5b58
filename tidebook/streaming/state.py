"""State that `foreachBatch` carries from one micro-batch to the next, in buckets of tickers.

A batch reads and writes the buckets of its own tickers only, all kinds of state in one go. A bucket has two
slots, and a batch writes the one that does not hold what it started from, so that a batch that is run again
overwrites only its own result.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark import InheritableThread
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 64

#: The fields of every kind of state; a kind leaves those it does not need null.
FIELDS = {
    "ticker": T.StringType(),
    "side": T.StringType(),
    "price": T.DoubleType(),
    "size": T.LongType(),
    "last_sequence": T.LongType(),
    "since": T.LongType(),
    "until": T.LongType(),
    "arrival": T.LongType(),
    "ts_ms": T.LongType(),
}
LEVEL = ("ticker", "side", "price", "size")
SEQUENCE = ("ticker", "last_sequence")
STATE = T.StructType([T.StructField("kind", T.StringType()), *(T.StructField(name, kind) for name, kind in FIELDS.items())])


def bucket_of(ticker: str = "ticker") -> Column:
    return F.pmod(F.xxhash64(ticker), F.lit(BUCKETS)).cast("int")


def touched() -> Column:
    """Aggregate: the buckets of a batch's tickers."""
    return F.collect_set(F.when(F.col("ticker").isNotNull(), bucket_of())).alias("buckets")


def side_by_side(*steps: Callable[[], object]) -> None:
    """Run steps of a batch that do not need one another at the same time; the first error is raised when all are done."""
    errors: list[BaseException] = []

    def run(step: Callable[[], object]) -> None:
        try:
            step()
        except BaseException as error:  # noqa: BLE001
            errors.append(error)

    threads = [InheritableThread(target=run, args=(step,)) for step in steps]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    if errors:
        raise errors[0]


class State:
    """The state of some buckets before a batch, and where it goes after it."""

    def __init__(self, spark: SparkSession, path: str, batch_id: int, buckets: list[int]) -> None:
        self.path, self.batch_id, self.buckets = path, batch_id, buckets
        self.rows, self.slots = self._load(spark)

    def _load(self, spark: SparkSession) -> tuple[DataFrame, dict[int, int]]:
        extra = [("batch_id", T.LongType()), ("bucket", T.IntegerType()), ("slot", T.IntegerType())]
        schema = T.StructType([*STATE.fields, *(T.StructField(name, kind) for name, kind in extra)])
        try:
            rows = spark.read.schema(schema).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], STATE), {}
        mine = rows.filter(F.col("bucket").isin(self.buckets) & (F.col("batch_id") < self.batch_id))
        newest = mine.groupBy("bucket").agg(F.max(F.struct("batch_id", "slot")).alias("last")).collect()
        slots = {row["bucket"]: row["last"]["slot"] for row in newest}
        current = reduce(lambda so_far, pair: so_far | ((F.col("bucket") == pair[0]) & (F.col("slot") == pair[1])), slots.items(), F.lit(False))
        return mine.filter(current & F.col("ticker").isNotNull()).select(*STATE.names), slots

    def of(self, kind: str, *columns: str) -> DataFrame:
        return self.rows.filter(F.col("kind") == kind).select(*columns)

    def save(self, **kinds: DataFrame) -> None:
        """Keep the given kinds of state as of the end of the batch.

        A row without ticker stands for every bucket, so that an empty one is known to be empty.
        """
        spark = self.rows.sparkSession
        free = {bucket: 1 - self.slots.get(bucket, 1) for bucket in self.buckets}
        stated = spark.createDataFrame([(bucket,) for bucket in self.buckets], "bucket INT")
        for kind, rows in kinds.items():
            named = rows.select(F.lit(kind).alias("kind"), *rows.columns, bucket_of().alias("bucket"))
            stated = stated.unionByName(named, allowMissingColumns=True)
        for name, kind in FIELDS.items():
            if name not in stated.columns:
                stated = stated.withColumn(name, F.lit(None).cast(kind))
        slot = F.create_map(*[F.lit(x) for pair in free.items() for x in pair])[F.col("bucket")]
        (
            stated.withColumn("batch_id", F.lit(self.batch_id).cast("bigint"))
            .withColumn("slot", slot)
            .hint("rebalance", "bucket")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("bucket", "slot")
            .parquet(self.path)
        )
