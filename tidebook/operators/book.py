"""Order books rebuilt from signed size changes.

A level never goes below zero: a delta that would take it there empties it, and the next delta starts
from zero. With `run` the running sum of a level's deltas and `low` its running minimum, the size after
each delta is `run + greatest(opening, -low)`. The pair (total, lowest) of one segment is all a later
segment needs, so a level is summed segment by segment and never ordered as a whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidebook.functions.scalars import book_side
from tidebook.operators.routing import valid_deltas
from tidebook.operators.segments import (
    SEGMENT_ROWS,
    Cut,
    earlier_segments,
    join_spread,
    plan_cut,
    with_segment,
)

LEVEL = ("ticker", "side", "price")
# Number of the segment that opening sizes form; it is before all others.
OPENING_SEGMENT = -(2**62)


def book_deltas(deltas: DataFrame) -> DataFrame:
    """Complete deltas with the side reduced to the two sides of a book."""
    return valid_deltas(deltas).withColumn("side", book_side(F.col("side")))


def with_runs(cut: DataFrame) -> DataFrame:
    """Running sum and running minimum of each level inside its segment."""
    level = Window.partitionBy(*LEVEL, "seg").orderBy("arrival")
    level = level.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return cut.withColumn("run", F.sum("delta_size").over(level)).withColumn("low", F.min("run").over(level))


def segment_totals(runs: DataFrame, opening: DataFrame | None = None) -> DataFrame:
    """One row per level and segment: total change, lowest running sum and what was last seen.

    `opening` gives sizes to start from; they count as a first segment of their own.
    """
    seen = [F.max("sequence").alias("sequence")] if "sequence" in runs.columns else []
    totals = runs.groupBy(*LEVEL, "seg").agg(
        F.sum("delta_size").alias("net"),
        F.min("run").alias("low"),
        F.max("arrival").alias("last_arrival"),
        F.max_by("ts_ms", "arrival").alias("since_ms"),
        *seen,
    )
    if opening is None:
        return totals
    first = opening.select(
        *LEVEL,
        F.lit(OPENING_SEGMENT).cast("bigint").alias("seg"),
        F.col("size").alias("net"),
        F.col("size").alias("low"),
    )
    return totals.unionByName(first, allowMissingColumns=True)


def with_opening_size(totals: DataFrame) -> DataFrame:
    """Add the size each level has when its segment starts, and when it ends."""
    before = earlier_segments(*LEVEL)
    base = totals.withColumn("base", F.coalesce(F.sum("net").over(before), F.lit(0).cast("bigint")))
    lowest = base.withColumn("lowest", F.min(F.col("base") + F.col("low")).over(before))
    zero = F.lit(0).cast("bigint")
    opened = lowest.withColumn("open_size", F.col("base") + F.greatest(zero, -F.col("lowest")))
    return opened.withColumn(
        "close_size", F.col("net") + F.greatest(F.col("open_size"), -F.col("low"))
    ).drop("base", "lowest")


def level_totals(clean: DataFrame, width: int, opening: DataFrame | None = None) -> DataFrame:
    """`segment_totals` of a feed. One shuffle by ticker, side and segment serves the running sums and
    the totals; a shuffle by price as well would not be recognised by the second of them."""
    placed = with_segment(clean, width).repartition("ticker", "side", "seg")
    return segment_totals(with_runs(placed), opening)


def level_sizes(deltas: DataFrame, rows: int = SEGMENT_ROWS, opening: DataFrame | None = None) -> DataFrame:
    """Every delta with the size its level has afterwards (0 when the level is empty)."""
    clean = book_deltas(deltas)
    cut = plan_cut(deltas, rows)
    runs = with_runs(with_segment(clean, cut.width))
    zero = F.lit(0).cast("bigint")
    if cut.whole and opening is None:
        sized = runs.withColumn("size", F.col("run") + F.greatest(zero, -F.col("low")))
    else:
        totals = level_totals(clean.select(*LEVEL, "delta_size", "arrival", "ts_ms"), cut.width, opening)
        carried = with_opening_size(totals).select(*LEVEL, "seg", "open_size")
        sized = runs.join(carried, [*LEVEL, "seg"], "left").withColumn(
            "size", F.col("run") + F.greatest(F.coalesce("open_size", zero), -F.col("low"))
        )
    return sized.drop("run", "low", "open_size", "seg")


def closing_levels(
    deltas: DataFrame, rows: int = SEGMENT_ROWS, opening: DataFrame | None = None, cut: Cut | None = None
) -> DataFrame:
    """Every level ever touched, empty ones included: final size, last arrival, time and sequence.

    `cut` is the plan of a feed that has been looked at before.
    """
    kept = [name for name in (*LEVEL, "delta_size", "arrival", "ts_ms", "sequence") if name in deltas.columns]
    totals = level_totals(book_deltas(deltas).select(*kept), (cut or plan_cut(deltas, rows)).width, opening)
    # The last segment of a level holds its final state; only the sequence may have peaked before.
    level = Window.partitionBy(*LEVEL).orderBy("seg")
    closed = with_opening_size(totals).withColumn("later", F.lead("seg").over(level))
    seen = []
    if "sequence" in closed.columns:
        closed = closed.withColumn("sequence", F.max("sequence").over(level))
        seen = ["sequence"]
    last = closed.filter(F.col("later").isNull())
    return last.select(*LEVEL, F.col("close_size").alias("size"), "last_arrival", "since_ms", *seen)


def book(
    deltas: DataFrame,
    as_of: int | None = None,
    rows: int = SEGMENT_ROWS,
    opening: DataFrame | None = None,
    cut: Cut | None = None,
) -> DataFrame:
    """Live levels after the last delta, or after the last one with `arrival <= as_of`."""
    if as_of is not None:
        deltas = deltas.filter(F.col("arrival") <= as_of)
    return closing_levels(deltas, rows, opening, cut).filter(F.col("size") > 0).select(*LEVEL, "size")


def depth(levels: DataFrame, top: int | None = 5) -> DataFrame:
    """The best `top` levels of each side (all for None), numbered from 1: highest bids, lowest asks."""
    from_best = F.when(F.col("side") == "yes", -F.col("price")).otherwise(F.col("price"))
    best = Window.partitionBy("ticker", "side").orderBy(from_best)
    numbered = levels.withColumn("level", F.row_number().over(best))
    return numbered if top is None else numbered.filter(F.col("level") <= top)


def depth_nested(levels: DataFrame, top: int | None = 5) -> DataFrame:
    """`depth` as one row per ticker with two ordered arrays of (price, size)."""

    def ladder(side: str):
        entry = F.when(F.col("side") == side, F.struct("level", "price", "size"))
        ordered = F.array_sort(F.collect_list(entry))
        return F.transform(ordered, lambda e: F.struct(e["price"].alias("price"), e["size"].alias("size")))

    return depth(levels, top).groupBy("ticker").agg(ladder("yes").alias("yes"), ladder("no").alias("no"))


def latest_snapshots(snapshots: DataFrame) -> DataFrame:
    """The most recent snapshot of each ticker: `ticker, timestamp (s), orderbook, arrival`.

    The newest time of each ticker is found without reading the ladders; of snapshots with the same
    time one is kept.
    """
    newest = snapshots.groupBy("ticker").agg(F.max("timestamp").alias("timestamp"))
    found = snapshots.join(newest, ["ticker", "timestamp"])
    seen = F.col("arrival") if "arrival" in snapshots.columns else F.lit(None).cast("bigint")
    kept = F.max(F.struct(seen.alias("arrival"), "orderbook")).alias("kept")
    return found.groupBy("ticker", "timestamp").agg(kept).select("ticker", "timestamp", "kept.orderbook", "kept.arrival")


def snapshot_book(snapshots: DataFrame) -> DataFrame:
    """Ladders as level rows; a price given twice keeps its last entry."""

    def levels(side: str) -> DataFrame:
        return snapshots.select(
            "ticker",
            F.lit(side).alias("side"),
            F.posexplode(F.col("orderbook")[side]).alias("pos", "entry"),
        )

    entry = levels("yes").unionByName(levels("no"))
    priced = entry.select(
        "ticker", "side", F.get("entry", 0).alias("price"), F.get("entry", 1).cast("bigint").alias("size"), "pos"
    ).dropna(subset=["price", "size"])
    return (
        priced.groupBy(*LEVEL)
        .agg(F.max_by("size", "pos").alias("size"))
        .filter(F.col("size") > 0)
    )


def rebuild_book(snapshots: DataFrame, deltas: DataFrame, rows: int = SEGMENT_ROWS) -> DataFrame:
    """Live levels from the latest snapshot of each ticker plus the deltas that came after it.

    A snapshot that names its last message is followed by all later ones. One that has only its second is
    taken to be from the start of it: deltas after that instant follow. Tickers without a snapshot are
    rebuilt from all their deltas. Each ticker has one latest snapshot, so only its time is joined to the
    deltas; the ladders join as opening sizes, level by level.
    """
    latest = latest_snapshots(snapshots)
    taken = latest.select("ticker", (F.col("timestamp") * 1000).alias("taken_ms"), F.col("arrival").alias("taken_at"))
    after = F.coalesce(F.col("arrival") > F.col("taken_at"), F.col("ts_ms") > F.col("taken_ms"))
    later = join_spread(deltas, taken, ["ticker"], "left").filter(F.col("taken_ms").isNull() | after)
    return book(later.drop("taken_ms", "taken_at"), rows=rows, opening=snapshot_book(latest))
