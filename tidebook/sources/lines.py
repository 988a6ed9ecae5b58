"""The order of the lines of landed files."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidebook.session import scratch_path


def number_lines(lines: DataFrame, into: str) -> DataFrame:
    """Number the rows of a file scan from 0, by path and line.

    A file split knows where it starts, and its rows are read in order. Rows are numbered within their
    split once and written to the shared folder; splits are then counted, and one row per split goes
    through the running count.
    """
    kept = [name for name in lines.columns if name != into]
    placed = lines.select(
        *kept,
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__start"),
        F.monotonically_increasing_id().alias("__row"),
    )
    spark = lines.sparkSession
    path = scratch_path(spark, "lines")
    placed.write.parquet(path)
    held = spark.read.schema(placed.schema).parquet(path)
    splits = held.groupBy("__file", "__start").agg(F.min("__row").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__file", "__start").rowsBetween(Window.unboundedPreceding, -1))
    offsets = splits.select("__file", "__start", (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__shift"))
    return held.join(offsets, ["__file", "__start"]).withColumn(into, F.col("__row") + F.col("__shift")).select(*kept, into)
