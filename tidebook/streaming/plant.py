"""The ticker plant on a stream: books and sequence state carried from one micro-batch to the next.

Every micro-batch runs the batch operators with the books it opens with. A ticker that holds most of a
batch is therefore cut into segments like in batch work; a state kept per ticker would put it into one
task. `state` says how the state is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidebook.operators.bbo import bbo_changes, bbo_history
from tidebook.operators.book import book
from tidebook.operators.quality import last_sequences, sequence_gaps
from tidebook.operators.routing import of_type, pass_through, quarantined_messages, valid_deltas
from tidebook.operators.segments import SEGMENT_ROWS, plan_cut_with
from tidebook.operators.tables import to_bbo
from tidebook.operators.tiers import Tiers, write_hot
from tidebook.sources.feed import INTAKE
from tidebook.streaming.record import publish_batch, start, upsert_batch
from tidebook.streaming.state import LEVEL, SEQUENCE, State, side_by_side, touched


def last_of(batch: DataFrame, sequences: DataFrame) -> DataFrame:
    """The last sequence of every ticker after a batch."""
    merged = sequences.withColumn("newer", F.lit(0)).unionByName(last_sequences(batch).withColumn("newer", F.lit(1)))
    return merged.groupBy("ticker").agg(F.max_by("last_sequence", "newer").alias("last_sequence"))


def flag_batch(batch: DataFrame, batch_id: int, out: str, state: str, rows: int = SEGMENT_ROWS) -> None:
    """Write one micro-batch with the gap flag of every message."""
    batch = batch.drop(INTAKE)
    batch.persist()
    try:
        cut, found = plan_cut_with(batch, rows, touched())
        held = State(batch.sparkSession, state, batch_id, found.buckets)
        sequences = held.of("sequence", *SEQUENCE)
        upsert_batch(sequence_gaps(batch, rows, sequences, cut), out, batch_id)
        if held.buckets:
            held.save(sequence=last_of(batch, sequences))
    finally:
        batch.unpersist()


def flag_stream(feed: DataFrame, out: str, state: str, checkpoint: str, rows: int = SEGMENT_ROWS, **trigger) -> StreamingQuery:
    """Flag the gaps of a stream of messages; a busy ticker is cut into segments like in batch work."""
    return start(feed, checkpoint, lambda batch, batch_id: flag_batch(batch, batch_id, out, state, rows), **trigger)


def plant_batch(
    batch: DataFrame, batch_id: int, out: str, state: str, rows: int = SEGMENT_ROWS, tiers: Tiers | None = None
) -> None:
    """Publish one micro-batch: pass-through messages, BBO changes, sequence gaps and rejects, by channel.

    With `tiers` the BBO changes are also written to the hot `bbo` table, as a batch of that table.
    """
    batch = batch.drop(INTAKE)
    batch.persist()
    try:
        cut, found = plan_cut_with(batch, rows, touched())
        held = State(batch.sparkSession, state, batch_id, found.buckets)
        opening, sequences = held.of("level", *LEVEL), held.of("sequence", *SEQUENCE)
        deltas = valid_deltas(of_type(batch, "orderbook_delta")).withColumn("ts_ms", F.col("timestamp"))
        bad = quarantined_messages(batch).select(F.lit("quarantine").alias("channel"), F.lit(3).alias("ord"), "arrival", "ticker", "reason")
        forwarded = pass_through(batch).unionByName(deltas.drop("ts_ms")).withColumn("channel", F.col("type"))
        quotes = bbo_changes(bbo_history(deltas, rows, opening, cut)).withColumnRenamed("ts_ms", "timestamp")
        gaps = sequence_gaps(batch, rows, sequences, cut).filter("gap")
        events = (
            forwarded.drop("type")
            .withColumn("ord", F.lit(0))
            .unionByName(
                quotes.withColumn("channel", F.lit("bbo")).withColumn("ord", F.lit(1)), allowMissingColumns=True
            )
            .unionByName(
                gaps.select(
                    F.lit("gap").alias("channel"), F.lit(2).alias("ord"), "arrival", "ticker", "sequence", "last_sequence"
                ),
                allowMissingColumns=True,
            )
            .unionByName(bad, allowMissingColumns=True)
        )
        # What is published and what is kept do not need one another; each replaces itself when the batch is run again.
        steps = [lambda: publish_batch(events, out, batch_id)]
        if tiers:
            steps.append(lambda: write_hot(to_bbo(quotes), tiers, "bbo", f"plant-{batch_id}"))
        if held.buckets:
            steps.append(lambda: held.save(level=book(deltas, rows=rows, opening=opening, cut=cut), sequence=last_of(batch, sequences)))
        side_by_side(*steps)
    finally:
        batch.unpersist()


def plant_stream(
    feed: DataFrame, out: str, state: str, checkpoint: str, rows: int = SEGMENT_ROWS, tiers: Tiers | None = None, **trigger
) -> StreamingQuery:
    """Run the plant on a stream of messages; read the result with `published`.

    Batches must come in arrival order. Nothing is ever late: arrival order is the order of the books.
    """
    return start(feed, checkpoint, lambda batch, batch_id: plant_batch(batch, batch_id, out, state, rows, tiers), **trigger)


def published(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(out)
