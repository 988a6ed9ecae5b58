"""Message feeds: landed JSON lines, as a batch or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.schemas import CORRUPT, ENVELOPE, MESSAGE
from tidebook.sources.checks import malformed, not_blank
from tidebook.sources.lines import number_lines

# When a message came in, by its file or record; a batch that is run again finds the same time.
INTAKE = "intake_ms"


def read_feed(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """Envelopes `{"channel", "message", "arrival"}`, one JSON object per line; blank lines are skipped.

    Lines that are not such objects keep their text in `_corrupt_record`; with `strict` they fail the
    job instead.
    """
    mode = "FAILFAST" if strict else "PERMISSIVE"
    reader = spark.read.schema(ENVELOPE).option("mode", mode).option("columnNameOfCorruptRecord", CORRUPT)
    return reader.json(path)


def read_feed_lines(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """`read_feed` for files without `arrival`: the line order of the files, by path, takes its place."""
    return number_lines(read_feed(spark, path, strict), "arrival")


def stream_feed(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """The landing directory of a feed as a stream of messages."""
    raw = (
        spark.readStream.schema(ENVELOPE)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(path)
    )
    return messages(raw.select("*", F.unix_millis("_metadata.file_modification_time").alias(INTAKE)))


def kafka_feed(records: DataFrame) -> DataFrame:
    """Messages of a Kafka source (batch or stream) whose topic is keyed by ticker.

    All messages of a ticker are then in one partition and the offset is their arrival order. Read the
    source with `maxOffsetsPerTrigger`. `kafka_quarantined` has the records that are left out here.
    """
    parsed = _kafka_parsed(records)
    return messages(
        parsed.select(
            "envelope.channel", "envelope.message", F.coalesce("envelope.arrival", "offset").alias("arrival"), INTAKE
        )
    )


def _kafka_parsed(records: DataFrame) -> DataFrame:
    text = F.col("value").cast("string")
    intake = F.unix_millis("timestamp") if "timestamp" in records.columns else F.lit(None).cast("bigint")
    reading = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return records.select(F.from_json(text, ENVELOPE, reading).alias("envelope"), "offset", text.alias("line"), intake.alias(INTAKE))


def kafka_quarantined(records: DataFrame) -> DataFrame:
    """Records of a Kafka source that are no envelopes, have no message or fields of the wrong type."""
    parsed = _kafka_parsed(records)
    bad = F.col(f"envelope.{CORRUPT}").isNotNull() | F.col("envelope.message").isNull()
    return parsed.filter(bad).select("offset", "line")


def messages(envelopes: DataFrame) -> DataFrame:
    """The feed proper: `channel, arrival` and the message fields. Lines without a message are left out;
    a field of the wrong type is null, and `quarantined` shows its line."""
    more = [INTAKE] if INTAKE in envelopes.columns else []
    return envelopes.filter(F.col("message").isNotNull()).select("channel", "arrival", *more, "message.*")


def quarantined(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The lines that are no envelopes or have fields of the wrong type."""
    return malformed(spark, path, ENVELOPE)


def envelopes_of(feed: DataFrame) -> DataFrame:
    """A feed back in envelope form, to be written as JSON lines or sent to a topic."""
    fields = [F.col(field.name) for field in MESSAGE if field.name in feed.columns]
    return feed.select("channel", F.struct(*fields).alias("message"), "arrival")


def write_feed(feed: DataFrame, path: str) -> None:
    envelopes_of(feed).write.mode("append").json(path)


def preview(spark: SparkSession, path: str, n: int = 5, separator: str = "\n", size: int = 2000) -> DataFrame:
    """The first objects of a large JSON dump, each as text of `size` characters at most; reads no more than it needs.

    For a dump that is one long document give what separates its objects, for example `},`.
    """
    text = spark.read.option("lineSep", separator).text(path).withColumn("value", F.substring("value", 1, size))
    return text.filter(not_blank()).limit(n)
