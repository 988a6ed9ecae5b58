"""Session settings and the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tidebook", master: str | None = None, **conf: object) -> SparkSession:
    """A session with the settings the package relies on; `conf` adds to or replaces them.

    The time zone is pinned to UTC because day boundaries are UTC days.
    """
    settings: dict[str, object] = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.dataFrameQueryContext.enabled": "false",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Set the session time zone to UTC on a session somebody else built."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from `spark.checkpoint.dir`.

    A local session without the setting gets a temporary folder of its own; a cluster without it is
    refused, since a folder on one machine would be lost with that machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    created = tempfile.mkdtemp(prefix="tidebook-")
    spark.conf.set("spark.checkpoint.dir", created)
    return created


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder for a table a job writes and reads back."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table below the shared folder and read it again: it cuts lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
