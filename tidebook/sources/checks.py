"""Finding lines that do not fit their schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidebook.schemas import CORRUPT


def not_blank(line: str = "value") -> Column:
    """Whether a line has anything but white space."""
    return F.btrim(F.col(line), F.lit(" \t\n\x0b\x0c\r")) != ""


def malformed(spark: SparkSession, path: str | list[str], schema: StructType) -> DataFrame:
    """Text of the JSON lines that are no objects or have a field of another type, with their file.

    Lines are parsed in full here. A scan reads only the fields a query asks for, and would overlook
    faults in the others.
    """
    lines = spark.read.text(path).filter(not_blank())
    parsed = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return (
        lines.select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"), parsed.alias("parsed"))
        .filter(F.col("parsed").isNull() | F.col("parsed")[CORRUPT].isNotNull())
        .select("line", "file")
    )
