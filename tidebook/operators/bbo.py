"""Best bid and offer: per ticker, after every delta, and as change events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidebook.functions.scalars import book_ms, is_crossed, mid_price, pair_changed, spread
from tidebook.operators.book import (
    LEVEL,
    OPENING_SEGMENT,
    book_deltas,
    closing_levels,
    segment_totals,
    with_opening_size,
    with_runs,
)
from tidebook.operators.replay import REPLAY_SCHEMA, replay_segment, replay_whole
from tidebook.operators.routing import of_type, pass_through, valid_deltas
from tidebook.operators.segments import (
    SEGMENT_ROWS,
    Cut,
    plan_cut,
    ticker_multiples,
    with_segment,
    with_ticker_segment,
)


def best_of(levels: DataFrame, *more: Column) -> DataFrame:
    """Best bid (highest `yes`) and best ask (lowest other) of each ticker, with sizes.

    Tickers whose levels are all empty keep a row with nulls. `more` are further aggregates.
    """
    quote = F.struct("price", "size")
    live = F.col("size") > 0
    bid = F.max(F.when(live & (F.col("side") == "yes"), quote))
    ask = F.min(F.when(live & (F.col("side") != "yes"), quote))
    best = levels.groupBy("ticker").agg(bid.alias("bid"), ask.alias("ask"), *more)
    flat = best.select(
        "*",
        F.col("bid.price").alias("bid_price"),
        F.col("bid.size").alias("bid_size"),
        F.col("ask.price").alias("ask_price"),
        F.col("ask.size").alias("ask_size"),
    )
    return flat.drop("bid", "ask")


def with_mid_spread(quotes: DataFrame) -> DataFrame:
    """Mid and spread, null unless both sides have a price; the spread may be negative."""
    bid, ask = F.col("bid_price"), F.col("ask_price")
    return quotes.withColumn("mid_price", mid_price(bid, ask)).withColumn("spread", spread(bid, ask))


def bbo(
    deltas: DataFrame, rows: int = SEGMENT_ROWS, opening: DataFrame | None = None, intake_ms: Column | None = None
) -> DataFrame:
    """BBO of every ticker after its last delta, with mid and spread.

    `ts_ms` is the time of the last delta, or `intake_ms` where that delta has none or 0; `sequence` is the
    highest one (0 if none was given).
    """
    levels = closing_levels(deltas, rows, opening)
    zero = F.lit(0).cast("bigint")
    quotes = best_of(
        levels,
        F.greatest(zero, F.max("sequence")).alias("sequence") if "sequence" in levels.columns else F.max(zero).alias("sequence"),
        F.max_by("since_ms", "last_arrival").alias("ts_ms"),
    )
    return with_mid_spread(quotes.withColumn("ts_ms", book_ms(F.col("ts_ms"), intake_ms)))


def crossed(quotes: DataFrame) -> DataFrame:
    return quotes.withColumn("crossed", is_crossed(F.col("bid_price"), F.col("ask_price")))


def opening_books(totals: DataFrame, segments: DataFrame) -> DataFrame:
    """The live levels each segment of a ticker starts with.

    `totals` has one row per touched level and segment, `segments` one per ticker and segment. A level
    that is live after a segment opens all segments up to and including the next one that touches it.
    Segments are numbered densely per ticker first, so that this is a sequence, not a range join.
    """
    numbered = segments.withColumn(
        "no", F.row_number().over(Window.partitionBy("ticker").orderBy("seg"))
    ).withColumn("last_no", F.count("*").over(Window.partitionBy("ticker")).cast("int"))
    sized = with_opening_size(totals).join(numbered, ["ticker", "seg"], "left")
    next_no = F.lead("no").over(Window.partitionBy(*LEVEL).orderBy("seg"))
    spans = (
        sized.withColumn("until", F.coalesce(next_no, F.col("last_no")))
        .filter((F.col("close_size") > 0) & (F.col("until") > F.col("no")))
        .select(
            "ticker",
            F.explode(F.sequence(F.col("no") + 1, F.col("until"))).alias("no"),
            "side",
            "price",
            "close_size",
            "since_ms",
        )
    )
    return spans.join(numbered.drop("last_no"), ["ticker", "no"]).select(
        F.col("ticker").alias("book_ticker"),
        F.col("seg").alias("book_seg"),
        F.col("side").alias("book_side"),
        F.col("price").alias("level"),
        F.col("close_size").alias("size"),
        "since_ms",
    )


def bbo_history(
    deltas: DataFrame, rows: int = SEGMENT_ROWS, opening: DataFrame | None = None, cut: Cut | None = None
) -> DataFrame:
    """BBO after every delta; `changed` marks rows whose best prices differ from those before.

    The feed is cut into segments of at most `rows` deltas per ticker. Each segment is replayed with
    the book it opens with, so a busy ticker is spread over as many tasks as it has segments.
    """
    clean = book_deltas(deltas).select(*LEVEL, "delta_size", "arrival", "ts_ms")
    plan = cut or plan_cut(deltas, rows)
    if plan.whole:
        return with_mid_spread(_history_of_whole(clean, opening))
    multiples = ticker_multiples(deltas, plan.width, min(rows, plan.width))
    cut_rows = with_ticker_segment(clean, plan.width, multiples)
    # Deltas and opening books read the same columns, so that Spark shuffles them once for both.
    placed = cut_rows.repartition("ticker", "seg")
    segments = cut_rows.select("ticker", "seg").distinct()
    if opening is not None:
        held = opening.select("ticker", F.lit(OPENING_SEGMENT).cast("bigint").alias("seg")).distinct()
        segments = segments.unionByName(held)
    books = opening_books(segment_totals(with_runs(placed), opening), segments)
    replayed = (
        placed.groupBy("ticker", "seg")
        .cogroup(books.groupBy("book_ticker", "book_seg"))
        .applyInArrow(replay_segment, schema=REPLAY_SCHEMA)
    )
    return with_mid_spread(replayed)


def _history_of_whole(clean: DataFrame, opening: DataFrame | None) -> DataFrame:
    """History of a feed that fits into one segment: a group per ticker, no summaries."""
    if opening is None:
        return clean.groupBy("ticker").applyInArrow(replay_whole, schema=REPLAY_SCHEMA)
    active = clean.select(F.col("ticker").alias("book_ticker")).distinct()
    books = opening.select(
        F.col("ticker").alias("book_ticker"), F.col("side").alias("book_side"), F.col("price").alias("level"), "size"
    ).join(active, "book_ticker", "left_semi")
    return (
        clean.groupBy("ticker")
        .cogroup(books.groupBy("book_ticker"))
        .applyInArrow(replay_segment, schema=REPLAY_SCHEMA)
    )


def bbo_changes(history: DataFrame) -> DataFrame:
    """The rows of a `bbo_history` at which the best prices changed."""
    return history.filter("changed").drop("changed")


def bbo_changes_of(quotes: DataFrame, rows: int = SEGMENT_ROWS) -> DataFrame:
    """Price changes in any table of quotes `ticker, arrival, bid_price, ask_price, ...`.

    The quote before the first one of a segment comes from a one-row summary of the segment before it.
    """
    cut = with_segment(quotes, plan_cut(quotes, rows).width)
    pair = F.struct("bid_price", "ask_price")
    ends = cut.groupBy("ticker", "seg").agg(F.max_by(pair, "arrival").alias("last"))
    carried = ends.select(
        "ticker", "seg", F.lag("last").over(Window.partitionBy("ticker").orderBy("seg")).alias("carried")
    )
    within = Window.partitionBy("ticker", "seg").orderBy("arrival")
    joined = cut.withColumn("previous", F.lag(pair).over(within)).join(carried, ["ticker", "seg"], "left")
    before = F.coalesce("previous", "carried")
    differs = pair_changed(
        (F.col("bid_price"), F.col("ask_price")), (before["bid_price"], before["ask_price"])
    )
    return joined.filter(differs).drop("previous", "carried", "seg")


def plant(feed: DataFrame, rows: int = SEGMENT_ROWS) -> DataFrame:
    """Everything the ticker plant publishes, as rows `channel, arrival, ord, ticker, ...`.

    Trades, tickers and complete deltas pass through (`ord` 0); a delta that changes the best prices is
    followed by a `bbo` row with the same arrival (`ord` 1). Order the output by `arrival, ord`.
    """
    deltas = valid_deltas(of_type(feed, "orderbook_delta"))
    forwarded = pass_through(feed).unionByName(deltas).withColumn("channel", F.col("type"))
    shaped = deltas.withColumn("ts_ms", F.col("timestamp"))
    quotes = bbo_changes(bbo_history(shaped, rows)).withColumnRenamed("ts_ms", "timestamp")
    return (
        forwarded.drop("type")
        .withColumn("ord", F.lit(0))
        .unionByName(
            quotes.withColumn("channel", F.lit("bbo")).withColumn("ord", F.lit(1)), allowMissingColumns=True
        )
    )

