"""Hot, warm and archive tiers: daily tables, migration, export, retention.

Hot tables are written batch by batch and partitioned by `batch, date`; a repeated batch replaces
itself. Warm tables and the archive, a plain Parquet directory per table and day, are partitioned by
`date, batch` and sorted by ticker and time. A batch that is moved again replaces its own partitions, and
nothing else of the day is read or written. So each step can be repeated, late batches join a day that has
been moved before at the cost of their own rows, and no step ever writes less than it found.

No write here depends on the overwrite mode of the session: a hot batch names its partition in the
statement, and the moves write the paths of their partitions and then tell the catalog.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidebook.functions.scalars import parse_day
from tidebook.operators.trades import day_slice, latest
from tidebook.schemas import TABLE_SCHEMAS, WARM_TABLES

RETENTION_DAYS = 90
# Partitions named in one statement.
SPECS = 500

#: Files say by a Bloom filter whether they have a ticker; rows are sorted by it, so row groups say so too.
BY_TICKER = {"parquet.bloom.filter.enabled#ticker": "true", "parquet.bloom.filter.expected.ndv#ticker": "10000"}

LOG_SCHEMA = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("rows", T.LongType()),
        T.StructField("status", T.StringType()),
    ]
)


@dataclass(frozen=True)
class Tiers:
    """Names of the tables of one installation and the folder of its archive."""

    database: str
    archive: str

    def hot(self, table: str) -> str:
        return f"{self.database}.{table}"

    def warm(self, table: str) -> str:
        return f"{self.database}.{table}_hdb"

    @property
    def log(self) -> str:
        return f"{self.database}.migration_log"


# --- creating and writing ------------------------------------------------------------------------


def _create(spark: SparkSession, name: str, schema: T.StructType, keys: list[str]) -> None:
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
    by = f" PARTITIONED BY ({', '.join(keys)})" if keys else ""
    options = ", ".join(f"'{key}' = '{value}'" for key, value in BY_TICKER.items()) if "ticker" in schema.names else ""
    with_options = f" OPTIONS ({options})" if options else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS IDENTIFIER(:name) ({columns}) USING parquet{with_options}{by}", args={"name": name})


def batched(table: str) -> T.StructType:
    """The columns of a table with the batch each row came with."""
    return T.StructType([*TABLE_SCHEMAS[table].fields, T.StructField("batch", T.StringType())])


def create_tiers(spark: SparkSession, tiers: Tiers, location: str | None = None) -> None:
    """Create the database, the four hot tables, the warm tables and the migration log if absent."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS IDENTIFIER(:name){where}", args={"name": tiers.database})
    for table in TABLE_SCHEMAS:
        _create(spark, tiers.hot(table), batched(table), ["batch", "date"])
    create_warm_tables(spark, tiers)
    _create(spark, tiers.log, LOG_SCHEMA, [])


def create_warm_tables(spark: SparkSession, tiers: Tiers) -> None:
    """Empty daily-partitioned warm tables; filling them is left to the migration."""
    for table in WARM_TABLES:
        _create(spark, tiers.warm(table), batched(table), ["date", "batch"])


def write_hot(rows: DataFrame, tiers: Tiers, table: str, batch: str | int) -> None:
    """Add the rows of one batch to a hot table. The same batch written again replaces itself, on days
    that it no longer has as well.

    The statement names the batch, so that it overwrites no other one whatever the overwrite mode. Rows are
    brought together by day first, or else every task would write a file for every day of a long backfill.
    Adaptive execution splits big days and joins small ones into even files.
    """
    spark, name = rows.sparkSession, tiers.hot(table)
    drop_partitions(spark, name, partitions(spark, name, batch=str(batch)))
    ordered = rows.hint("rebalance", "date").sortWithinPartitions("date", "ticker", "ts_ms")
    columns = ", ".join(f"`{column}`" for column in TABLE_SCHEMAS[table].names if column != "date")
    given = _spec({"batch": str(batch)})
    spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({given}, date) SELECT {columns}, date FROM {{ordered}}", ordered=ordered)


# --- hot to warm to archive ----------------------------------------------------------------------


def _write_batches(rows: DataFrame, path: str) -> None:
    """Write the `date, batch` partitions that the rows have, each in place of what it held before.

    Even files sorted by ticker and time: ranges include the time, so a busy ticker is split.
    """
    laid_out = rows.repartitionByRange("date", "batch", "ticker", "ts_ms").sortWithinPartitions("date", "batch", "ticker", "ts_ms")
    (
        laid_out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .options(**BY_TICKER)
        .partitionBy("date", "batch")
        .parquet(path)
    )


def _location(spark: SparkSession, name: str) -> str:
    described = spark.sql("DESCRIBE TABLE EXTENDED IDENTIFIER(:name)", args={"name": name})
    return described.filter("col_name = 'Location'").first().data_type


def _add_partitions(spark: SparkSession, name: str, listed: list[str]) -> None:
    for first in range(0, len(listed), SPECS):
        clause = " ".join(f"PARTITION ({_spec(_values(p))})" for p in listed[first : first + SPECS])
        spark.sql(f"ALTER TABLE IDENTIFIER(:name) ADD IF NOT EXISTS {clause}", args={"name": name})
    spark.catalog.refreshTable(name)


def _to_warm(rows: DataFrame, tiers: Tiers, table: str, listed: list[str]) -> None:
    """Write rows of listed hot partitions to the warm table."""
    spark, name = rows.sparkSession, tiers.warm(table)
    _write_batches(rows, _location(spark, name))
    _add_partitions(spark, name, listed)


def migrate_days(spark: SparkSession, tiers: Tiers, table: str, start: str | dt.date, end: str | dt.date) -> None:
    """Copy the days `start..end` from hot to warm in one job. Days without hot rows are left alone."""
    days = F.col("date").between(F.lit(parse_day(start)), F.lit(parse_day(end)))
    moved = [row.partition for row in partitions(spark, tiers.hot(table)).filter(days).toLocalIterator()]
    if moved:
        _to_warm(spark.table(tiers.hot(table)).filter(days), tiers, table, moved)


def migrate_day(spark: SparkSession, tiers: Tiers, table: str, day: str | dt.date) -> None:
    """Copy one UTC day from hot to warm. Run twice, it leaves the same rows."""
    migrate_days(spark, tiers, table, day, day)


def archive_path(tiers: Tiers, table: str, day: str | dt.date) -> str:
    return f"{tiers.archive}/{table}/date={parse_day(day):%Y-%m-%d}"


def export_day(spark: SparkSession, tiers: Tiers, table: str, day: str | dt.date) -> str:
    """Write one day of a warm table to the archive as Snappy Parquet and return its folder."""
    export_days(spark, tiers, table, day, day)
    return archive_path(tiers, table, day)


def export_days(spark: SparkSession, tiers: Tiers, table: str, start: str | dt.date, end: str | dt.date) -> str:
    """Write the days `start..end` of a warm table to the archive in one job.

    Archived batches that the warm day no longer has, say after retention, stay; a day without warm rows is
    left alone.
    """
    target = f"{tiers.archive}/{table}"
    days = F.col("date").between(F.lit(parse_day(start)), F.lit(parse_day(end)))
    _write_batches(spark.table(tiers.warm(table)).filter(days), target)
    return target


def _archived(spark: SparkSession, tiers: Tiers, table: str, day: dt.date) -> DataFrame:
    """One archived day of a table with its batches; empty if it was never exported. Lists that day only."""
    try:
        reader = spark.read.schema(batched(table)).option("basePath", f"{tiers.archive}/{table}")
        return reader.parquet(archive_path(tiers, table, day))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], batched(table))


def read_archive(spark: SparkSession, tiers: Tiers, table: str) -> DataFrame:
    """The archived days of a table; `date` comes from the folder names."""
    return spark.read.schema(batched(table)).parquet(f"{tiers.archive}/{table}").select(*TABLE_SCHEMAS[table].names)


# --- newest rows ---------------------------------------------------------------------------------


def newest_days(spark: SparkSession, name: str, ticker: str, n: int) -> dt.date | None:
    """The day from which on a table has `n` rows of a ticker, walking back from its newest one.

    Days are listed by the catalog. Each step counts twice as many days as the one before and reads nothing but
    the ticker, so what is read depends on how far back the rows lie and not on how long the table is.
    """
    days = sorted({row.date for row in partitions(spark, name).select("date").distinct().toLocalIterator()}, reverse=True)
    found, begin, width = 0, 0, 1
    while begin < len(days):
        newest, oldest = days[begin], days[min(begin + width, len(days)) - 1]
        here = F.col("date").between(F.lit(oldest), F.lit(newest)) & (F.col("ticker") == ticker.upper())
        found += spark.table(name).filter(here).select("ticker").limit(n - found).count()
        if found >= n:
            return oldest
        begin, width = begin + width, width * 2
    return days[-1] if days else None


def latest_rows(spark: SparkSession, name: str, ticker: str, n: int = 20) -> DataFrame:
    """The newest `n` rows of a ticker in a daily table, newest first."""
    since = newest_days(spark, name, ticker, n)
    rows = spark.table(name)
    return latest(rows if since is None else rows.filter(F.col("date") >= F.lit(since)), ticker, n)


# --- retention -----------------------------------------------------------------------------------


def partitions(spark: SparkSession, name: str, **given: str) -> DataFrame:
    """The partitions of a table as `table, partition, date`, read from the catalog alone.

    Values given for some of its partition columns are looked up in the catalog, which then lists no more.
    """
    day = F.to_date(F.regexp_extract("partition", r"date=(\d{4}-\d{2}-\d{2})", 1))
    spec = f" PARTITION ({_spec(given)})" if given else ""
    listed = spark.sql(f"SHOW PARTITIONS IDENTIFIER(:name){spec}", args={"name": name})
    return listed.select(F.lit(name).alias("table"), "partition", day.alias("date"))


def _spec(values: dict[str, str]) -> str:
    """A partition specification with its values as SQL text."""
    quoted = {key: value.replace("\\", "\\\\").replace("'", "\\'") for key, value in values.items()}
    return ", ".join(f"`{key}` = '{value}'" for key, value in quoted.items())


def _values(partition: str) -> dict[str, str]:
    """The values of a partition as the catalog lists it, with special characters escaped."""
    return {key: unquote(value) for key, value in (part.split("=", 1) for part in partition.split("/"))}


def expired_partitions(
    spark: SparkSession, name: str, as_of: str | dt.date, retention_days: int = RETENTION_DAYS
) -> DataFrame:
    """Partitions older than the retention: those with `date < as_of - retention_days`."""
    cutoff = parse_day(as_of) - dt.timedelta(days=retention_days)
    return partitions(spark, name).filter(F.col("date") < F.lit(cutoff))


def drop_partitions(spark: SparkSession, name: str, listed: DataFrame) -> int:
    """Drop listed partitions; the list is streamed, and so many of them go in one statement."""
    dropped, held = 0, []

    def drop() -> None:
        clause = ", ".join(f"PARTITION ({spec})" for spec in held)
        spark.sql(f"ALTER TABLE IDENTIFIER(:name) DROP IF EXISTS {clause}", args={"name": name})

    for row in listed.toLocalIterator():
        held.append(_spec(_values(row.partition)))
        dropped += 1
        if len(held) == SPECS:
            drop()
            held = []
    if held:
        drop()
    return dropped


def apply_retention(
    spark: SparkSession, tiers: Tiers, as_of: str | dt.date, retention_days: int = RETENTION_DAYS
) -> dict[str, int]:
    """Drop expired partitions of the warm tables; returns how many of each."""
    return {
        table: drop_partitions(
            spark,
            tiers.warm(table),
            expired_partitions(spark, tiers.warm(table), as_of, retention_days),
        )
        for table in WARM_TABLES
    }


def drop_hot_day(spark: SparkSession, tiers: Tiers, table: str, day: str | dt.date) -> int:
    name = tiers.hot(table)
    return drop_partitions(spark, name, partitions(spark, name, date=f"{parse_day(day):%Y-%m-%d}"))


# --- end of day ----------------------------------------------------------------------------------


def day_rows(rows: DataFrame, day: str | dt.date) -> int:
    return day_slice(rows, day).count()


def log_migration(spark: SparkSession, tiers: Tiers, table: str, day: dt.date, rows: int, status: str) -> None:
    entry = spark.createDataFrame([(table, day, rows, status)], LOG_SCHEMA)
    entry.write.mode("append").insertInto(tiers.log)


def migration_log(spark: SparkSession, tiers: Tiers) -> DataFrame:
    return spark.table(tiers.log)


def _batch_counts(rows: DataFrame, day: dt.date, into: str) -> DataFrame:
    return day_slice(rows, day).groupBy("batch").agg(F.count(F.lit(1)).alias(into))


def end_of_day(spark: SparkSession, tiers: Tiers, day: str | dt.date) -> dict[str, int]:
    """Migrate and archive one day of the warm-tier tables, then free it from the hot tier.

    What is freed is what was listed at the start, and only when warm tier and archive hold as many rows
    of every batch; otherwise the mismatch is logged and raised, and the hot rows stay. Batches that come
    while this runs wait for the next time. A day without hot rows is logged as `unchanged`.
    """
    date = parse_day(day)
    done = {}
    for table in WARM_TABLES:
        hot = tiers.hot(table)
        listed = [row.partition for row in partitions(spark, hot, date=f"{date:%Y-%m-%d}").toLocalIterator()]
        if listed:
            batches = spark.createDataFrame([(_values(p)["batch"], p) for p in listed], "of STRING, partition STRING")
            here, mine = F.col("date") == F.lit(date), F.col("batch") == F.col("of")
            _to_warm(spark.table(hot).filter(here).join(batches, mine, "left_semi"), tiers, table, listed)
            _write_batches(spark.table(tiers.warm(table)).filter(here).join(batches, mine, "left_semi"), f"{tiers.archive}/{table}")
            moved = batches
            for rows, into in ((spark.table(hot), "hot"), (spark.table(tiers.warm(table)), "warm"), (_archived(spark, tiers, table, date), "archive")):
                moved = moved.join(_batch_counts(rows, date, into), F.col("of") == F.col("batch"), "left").drop("batch")
            wrong = moved.filter("hot <> coalesce(warm, 0) or hot <> coalesce(archive, 0)").first()
            if wrong:
                log_migration(spark, tiers, table, date, wrong["warm"] or 0, "mismatch")
                raise RuntimeError(f"{table} {date}: {wrong.hot} hot, {wrong.warm} warm and {wrong.archive} archived rows of batch {wrong.of}")
            drop_partitions(spark, hot, batches)
            left = {row.partition for row in partitions(spark, hot, date=f"{date:%Y-%m-%d}").toLocalIterator()}
            if not left.isdisjoint(listed):
                log_migration(spark, tiers, table, date, 0, "not dropped")
                raise RuntimeError(f"{table} {date}: {len(left.intersection(listed))} partitions are still there")
        done[table] = day_rows(spark.table(tiers.warm(table)), date)
        log_migration(spark, tiers, table, date, done[table], "done" if listed else "unchanged")
    return done
