"""Books that recover from lost messages: a gap makes a book stale, the next snapshot makes it whole.

From the message that breaks a ticker's count on, its deltas are held back and its book stays as it was. The
first snapshot that has seen everything before the last gap becomes the book, and the deltas held back and new
that come after the snapshot are replayed on it. A ticker without a gap needs no snapshot and ignores it.

The deltas held back are state like the levels, in buckets of tickers, and are replayed by the operators of
batch work; so a busy ticker is cut into segments here as well. Joins are to one row per ticker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidebook.operators.book import LEVEL as LEVEL_KEY
from tidebook.operators.book import book, book_deltas, latest_snapshots, snapshot_book
from tidebook.operators.quality import sequence_gaps
from tidebook.operators.segments import SEGMENT_ROWS, join_spread
from tidebook.schemas import CORRUPT, SNAPSHOT
from tidebook.sources.feed import INTAKE
from tidebook.streaming.plant import last_of
from tidebook.streaming.record import newest, start, upsert_batch
from tidebook.streaming.state import LEVEL, SEQUENCE, State, side_by_side, touched

TYPE = "orderbook_snapshot"
DELTA = ("ticker", "side", "price", "size", "arrival", "ts_ms")
CHANGE = "ticker STRING, side STRING, price DOUBLE, size BIGINT"
LOG = "ticker STRING, stale_since BIGINT, last_gap BIGINT, recovered_at BIGINT"


def stream_snapshots(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """The snapshot log as messages of a stream, to be added to the feed with `with_snapshots`."""
    rows = spark.readStream.schema(SNAPSHOT).option("columnNameOfCorruptRecord", CORRUPT)
    rows = rows.option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", True).json(path)
    known = rows.filter(F.col("timestamp").isNotNull() & F.col("arrival").isNotNull())
    return known.select(F.lit(TYPE).alias("type"), "ticker", "timestamp", "orderbook", "arrival")


def with_snapshots(feed: DataFrame, snapshots: DataFrame) -> DataFrame:
    return feed.unionByName(snapshots, allowMissingColumns=True)


def ticker_status(gaps: DataFrame, stale: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Tickers with an open gap: where it began and last broke, and the snapshot that closes it, if there is one.

    A snapshot closes gaps that it lies behind: it has seen all that came before the message of the last gap.
    """
    found = gaps.groupBy("ticker").agg(F.min("arrival").alias("since"), F.max("arrival").alias("until"))
    opened = found.unionByName(stale).groupBy("ticker").agg(F.min("since").alias("since"), F.max("until").alias("until"))
    taken = snapshots.groupBy("ticker").agg(F.max("arrival").alias("taken"))
    closes = F.when(F.col("taken") >= F.col("until") - 1, F.col("taken"))
    return opened.join(taken, "ticker", "left").withColumn("taken", closes)


def recover_batch(batch: DataFrame, batch_id: int, out: str, state: str, rows: int = SEGMENT_ROWS) -> None:
    """Bring the books up to date with one micro-batch of messages and snapshots.

    Writes the levels whose size changed to `out/levels`, emptied ones with size 0, and the gaps that were
    closed to `out/recovered`; `recovered_book` and `recoveries` read them.
    """
    batch = batch.drop(INTAKE)
    batch.persist()
    try:
        held = State(batch.sparkSession, state, batch_id, batch.agg(touched()).first().buckets)
        if not held.buckets:
            return
        is_snapshot = F.col("type") == TYPE
        feed = batch.filter(~F.coalesce(is_snapshot, F.lit(False))).drop("orderbook")
        snapshots = batch.filter(is_snapshot).select("ticker", "timestamp", "orderbook", "arrival")
        before, sequences = held.of("level", *LEVEL), held.of("sequence", *SEQUENCE)
        base = held.of("taken", "ticker", F.col("until").alias("base"))
        unseen = F.coalesce(F.col("arrival") - 1 > F.col("base"), F.lit(True))
        flagged = join_spread(sequence_gaps(feed, rows, sequences).filter("gap"), base, ["ticker"], "left").filter(unseen)
        status = ticker_status(flagged, held.of("stale", "ticker", "since", "until"), snapshots).persist()

        fresh = book_deltas(feed.filter("type = 'orderbook_delta'").withColumn("ts_ms", F.col("timestamp")))
        waiting = held.of("held", *DELTA).unionByName(fresh.withColumnRenamed("delta_size", "size").select(*DELTA))
        behind = F.coalesce(F.col("arrival") > F.col("base"), F.lit(True))
        placed = join_spread(join_spread(waiting, base, ["ticker"], "left").filter(behind), status, ["ticker"], "left")
        after_snapshot = F.col("arrival") > F.col("taken")
        applied = placed.filter(F.col("since").isNull() | F.coalesce(after_snapshot, F.col("arrival") < F.col("since")))
        kept = placed.filter(F.col("taken").isNull() & (F.col("arrival") >= F.col("since"))).select(*DELTA)

        closed = status.filter("taken IS NOT NULL")
        whole = snapshots.join(closed.select("ticker", F.col("taken").alias("arrival")), ["ticker", "arrival"], "left_semi")
        opening = before.join(closed, "ticker", "left_anti").unionByName(snapshot_book(latest_snapshots(whole)))
        levels = book(applied.withColumnRenamed("size", "delta_size").select("ticker", "side", "price", "delta_size", "arrival", "ts_ms"), rows=rows, opening=opening)
        levels = levels.persist()

        was, now = before.withColumnRenamed("size", "was"), levels.withColumnRenamed("size", "now")
        both = was.join(now, list(LEVEL_KEY), "full")
        changed = both.filter(~F.col("was").eqNullSafe(F.col("now")))
        sized = changed.select(*LEVEL_KEY, F.coalesce("now", F.lit(0).cast("bigint")).alias("size"))
        log = closed.select("ticker", F.col("since").alias("stale_since"), F.col("until").alias("last_gap"), F.col("taken").alias("recovered_at"))
        stale = status.filter("taken IS NULL").select("ticker", "since", "until")
        taken = closed.select("ticker", F.col("taken").alias("until"))
        taken = taken.unionByName(base.join(taken, "ticker", "left_anti").withColumnRenamed("base", "until"))
        side_by_side(
            lambda: upsert_batch(sized, f"{out}/levels", batch_id),
            lambda: upsert_batch(log, f"{out}/recovered", batch_id),
            lambda: held.save(level=levels, sequence=last_of(feed, sequences), stale=stale, held=kept, taken=taken),
        )
        status.unpersist()
        levels.unpersist()
    finally:
        batch.unpersist()


def recovery_stream(feed: DataFrame, out: str, state: str, checkpoint: str, rows: int = SEGMENT_ROWS, **trigger) -> StreamingQuery:
    """Keep books of a stream of messages and snapshots (`with_snapshots`).

    Messages must come in arrival order. A snapshot closes gaps that are known when it comes; those messages
    that it has seen may come before or after it, for it says by its arrival number which they are.
    """
    return start(feed, checkpoint, lambda batch, batch_id: recover_batch(batch, batch_id, out, state, rows), **trigger)


def recovered_book(spark: SparkSession, out: str) -> DataFrame:
    """The live levels as of the last batch; those of a stale ticker as of its gap."""
    schema = spark.createDataFrame([], CHANGE).schema
    return newest(spark, f"{out}/levels", schema, list(LEVEL_KEY)).filter("size > 0")


def recoveries(spark: SparkSession, out: str) -> DataFrame:
    """The gaps that a snapshot closed: ticker, stale_since, last_gap, recovered_at (arrival numbers)."""
    return spark.read.schema(LOG).parquet(f"{out}/recovered")


