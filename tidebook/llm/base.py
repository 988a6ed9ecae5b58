"""Small helpers the operators share: tables, Arrow batches, words, tables written and read again."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidebook.session import scratch_path

#: White space of the contracts: space and U+0009 to U+000D, in one string.
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table below the shared folder and read it again: it cuts lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def over_batches(df: DataFrame, rows: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    """Map every Arrow batch of a frame to any number of batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from rows(batch)

    return df.mapInArrow(run, schema)


def texts(batch: pa.RecordBatch, name: str = "text") -> Iterator[str]:
    """The strings of a column one by one, null as the empty text."""
    for value in batch.column(name):
        yield value.as_py() or ""


def raw_texts(batch: pa.RecordBatch, name: str = "text") -> Iterator[bytes]:
    """The UTF-8 bytes of a column one by one, null as no bytes."""
    for value in batch.column(name).cast(pa.large_binary()):
        yield value.as_py() or b""


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread(*columns: str) -> F.Column:
    """A non-negative hash of columns, never null."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 62))
