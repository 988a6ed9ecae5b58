"""The registered queries, by name. Each takes the session and the folder of the tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidebook.functions import scalars
from tidebook.operators import bbo as quotes
from tidebook.operators import book, monitoring, quality, rollup, routing, tables, tiers
from tidebook.operators import trades as trade_ops
from tidebook.plans import workload
from tidebook.session import scratch_path, shared_dir, written
from tidebook.sources import feed as feeds
from tidebook.sources import cursors, documents, pages, snapshots
from tidebook.streaming import history, plant, record, recovery, stateful, windows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SOME_DAY = "2024-01-15"
# Segments short enough to be cut many times in the given tables.
SHORT_SEGMENT = 1024
# Files of a micro-batch of a stream that is run whenever a batch has landed: all that are new.
EVERY_FILE = 1 << 30

BBO_COLUMNS = ("bid_price", "bid_size", "ask_price", "ask_size", "mid_price", "spread")


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def text_date(df: DataFrame, *columns: str) -> DataFrame:
    for column in columns:
        df = df.withColumn(column, F.date_format(column, "yyyy-MM-dd"))
    return df


def span(spark: SparkSession, sf_dir: str) -> tuple[dt.date, dt.date]:
    """The first and the last day of the events."""
    return workload.events(spark, sf_dir).agg(F.min("ts").cast("date"), F.max("ts").cast("date")).first()


# --- routing and shaping -------------------------------------------------------------------------


@query
def feed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.feed_counts(workload.feed(spark, sf_dir))


@query
def type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.type_counts(workload.feed(spark, sf_dir))


@query
def pass_through(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = routing.pass_through(workload.feed(spark, sf_dir))
    return rows.select("type", "ticker", "arrival", "price", "last_price", "count")


@query
def trades_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    shaped = tables.shape_tables(workload.feed(spark, sf_dir))["trades"]
    return text_date(shaped, "date").select(
        "ticker", "taker_side", "price", "count", "trade_id", "arrival", "ts_ms", "date"
    )


@query
def deltas_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    shaped = tables.shape_tables(workload.feed(spark, sf_dir))["orderbook_deltas"]
    return text_date(shaped, "date").select(
        "ticker", "side", "price", "delta_size", "arrival", "ts_ms", "date"
    )


@query
def tickers_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    shaped = tables.shape_tables(workload.feed(spark, sf_dir))["tickers"]
    return text_date(shaped, "date").select("ticker", "last_price", "volume", "arrival", "ts_ms", "date")


@query
def bbo_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = quotes.bbo_changes(quotes.bbo_history(workload.deltas(spark, sf_dir)))
    shaped = tables.to_bbo(changes.withColumnRenamed("ts_ms", "timestamp"))
    return text_date(shaped, "date").select("ticker", *BBO_COLUMNS, "arrival", "ts_ms", "date")


@query
def quarantined_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deltas of every event, where types other than order-book deltas lack side, price or size."""
    rows = workload.feed(spark, sf_dir)
    bad = routing.quarantined_deltas(rows)
    return bad.select("arrival", "type", F.concat_ws(",", "missing").alias("missing"))


@query
def subscribed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of the channels and tickers that large customers asked for."""
    rows = workload.feed(spark, sf_dir)
    return routing.subscribe(rows, _subscriptions(spark, sf_dir)).groupBy("channel", "ticker").agg(
        F.count("*").alias("messages")
    )


def _subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests made of customers: lower-case tickers, with repeats."""
    customer = workload.table(spark, sf_dir, "customer")
    ticker = F.concat(F.lit("t"), (F.col("c_custkey") % 4).cast("string")).alias("ticker")
    by_segment = customer.select(
        F.when(F.col("c_mktsegment") == "BUILDING", "trade").otherwise("ticker").alias("channel"), ticker
    )
    deep = customer.filter("c_acctbal > 5000").select(F.lit("orderbook_delta").alias("channel"), ticker)
    return routing.merge_subscriptions(by_segment, deep)


@query
def subscription_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = routing.subscription_message(_subscriptions(spark, sf_dir))
    return lists.select("channel", F.concat_ws(",", "tickers").alias("tickers"))


# --- order books ---------------------------------------------------------------------------------


@query
def level_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return book.level_sizes(workload.deltas(spark, sf_dir))


@query
def level_sizes_segmented(spark: SparkSession, sf_dir: str) -> DataFrame:
    return book.level_sizes(workload.deltas(spark, sf_dir), rows=SHORT_SEGMENT)


@query
def live_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    return book.book(workload.deltas(spark, sf_dir))


@query
def book_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The book half-way through the feed."""
    rows = workload.deltas(spark, sf_dir)
    low, high = rows.agg(F.min("arrival"), F.max("arrival")).first()
    return book.book(rows, as_of=(low + high) // 2, rows=SHORT_SEGMENT)


@query
def bbo(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quotes.bbo(workload.sequenced(spark, sf_dir))
    return rows.select("ticker", *BBO_COLUMNS, "sequence", "ts_ms")


@query
def bbo_intake_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes whose book takes its time from the intake: every second ticker sends 0, every fourth none."""
    rows = workload.sequenced(spark, sf_dir)
    number = F.substring("ticker", 2, 1).cast("int")
    ms = F.when(number % 4 == 1, F.lit(None)).when(number % 2 == 1, F.lit(0)).otherwise(F.col("ts_ms")).cast("bigint")
    return quotes.bbo(rows.withColumn("ts_ms", ms), intake_ms=F.lit(1_700_000_000_000)).select("ticker", "bid_price", "ask_price", "ts_ms")


@query
def crossed(spark: SparkSession, sf_dir: str) -> DataFrame:
    live = book.closing_levels(workload.deltas(spark, sf_dir))
    return quotes.crossed(quotes.best_of(live)).select("ticker", "bid_price", "ask_price", "crossed")


@query
def depth_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return book.depth(book.book(workload.deltas(spark, sf_dir)), 5)


@query
def depth_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = book.depth_nested(book.book(workload.deltas(spark, sf_dir)), 5)

    def text(side: str):
        entries = F.transform(
            side, lambda e: F.concat_ws(":", e["price"].cast("int").cast("string"), e["size"].cast("string"))
        )
        return F.concat_ws(" ", entries).alias(side)

    return nested.select("ticker", text("yes"), text("no"))


@query
def bbo_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.bbo_history(workload.deltas(spark, sf_dir))


@query
def bbo_history_segmented(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.bbo_history(workload.deltas(spark, sf_dir), rows=SHORT_SEGMENT)


@query
def bbo_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.bbo_changes(quotes.bbo_history(workload.deltas(spark, sf_dir)))


@query
def bbo_changes_of_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes found in a table of quotes rather than during the replay."""
    history = quotes.bbo_history(workload.deltas(spark, sf_dir)).drop("changed")
    return quotes.bbo_changes_of(history, rows=SHORT_SEGMENT)


@query
def plant_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = quotes.plant(workload.feed(spark, sf_dir))
    return events.select("channel", "arrival", "ord", "ticker", "bid_price", "ask_price", "price", "last_price")


@query
def rebuild_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The final book from a snapshot log taken half-way, inside a second, and the deltas after it."""
    rows = workload.deltas(spark, sf_dir)
    low, high = rows.agg(F.min("ts_ms"), F.max("ts_ms")).first()
    taken = (low + high) // 2000
    seen = rows.filter(F.col("ts_ms") <= taken * 1000 + 700)
    last = seen.agg(F.max("arrival")).first()[0]
    path = scratch_path(spark, "snapshots")
    snapshots.write_snapshot_log(snapshots.snapshot_of(book.book(seen), F.lit(taken), arrival=F.lit(last)), path)
    return book.rebuild_book(snapshots.read_snapshot_log(spark, path), rows)


@query
def snapshot_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First three entries of each ladder of a logged book."""
    path = scratch_path(spark, "books")
    live = book.book(workload.deltas(spark, sf_dir))
    snapshots.write_snapshot_log(snapshots.snapshot_of(live, F.lit(0)), path)
    return pages.snapshot_levels(snapshots.read_snapshot_log(spark, path).drop("timestamp", "arrival"), 3)


# --- sequence and completeness -------------------------------------------------------------------


GAP_COLUMNS = ("arrival", "ticker", "sequence", "last_sequence", "gap")


@query
def sequence_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.sequence_gaps(workload.lossy(spark, sf_dir)).select(*GAP_COLUMNS)


@query
def sequence_gaps_segmented(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.sequence_gaps(workload.lossy(spark, sf_dir), rows=SHORT_SEGMENT).select(*GAP_COLUMNS)


@query
def sequence_gaps_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed in which some messages have no ticker, an empty one or no sequence: they are never gaps nor open one."""
    rows = workload.lossy(spark, sf_dir)
    ticker = F.when(F.col("arrival") % 11 == 0, F.lit(None)).when(F.col("arrival") % 17 == 0, F.lit("")).otherwise(F.col("ticker"))
    sequence = F.when(F.col("arrival") % 13 != 0, F.col("sequence"))
    return quality.sequence_gaps(rows.withColumn("ticker", ticker).withColumn("sequence", sequence), rows=SHORT_SEGMENT).select(*GAP_COLUMNS)


@query
def missing_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.missing_ranges(quality.sequence_gaps(workload.lossy(spark, sf_dir)))


@query
def gap_rate_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.gap_rate(quality.sequence_gaps(workload.lossy(spark, sf_dir)))


@query
def gap_rate_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.sliding_gap_rate(quality.sequence_gaps(workload.lossy(spark, sf_dir)))


def _odd_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades of a market that skips days: each ticker trades on some weekdays of the month only."""
    rows = workload.trades(spark, sf_dir)
    return rows.filter((F.dayofmonth("date") + F.substring("ticker", 2, 1).cast("int")) % 4 != 0)


def _expected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected volume: what all trades of the day add up to, less one in a hundred; one ticker has no trade at all."""
    full = quality.daily_counts(workload.trades(spark, sf_dir))
    silent = full.filter("ticker = 'T1'").withColumn("ticker", F.lit("SILENT"))
    return full.unionByName(silent).select(
        "ticker", "date", (F.col("volume") - scalars.floor_div(F.col("volume"), 100)).alias("expected_volume")
    )


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    traded = _odd_days(spark, sf_dir)
    return quality.completeness(traded, *span(spark, sf_dir), expected=_expected(spark, sf_dir))


@query
def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_date(_checked(spark, sf_dir), "date")


@query
def missing_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    traded = _odd_days(spark, sf_dir)
    return text_date(quality.missing_days(traded, *span(spark, sf_dir), traded), "date")


@query
def backfill_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The month of odd trading days, with the days to fetch again and the trades a second pull brought."""
    inserted = _odd_days(spark, sf_dir).filter("price > 50")
    report = quality.backfill_report(_checked(spark, sf_dir), inserted)
    gaps = F.concat_ws(",", F.transform("gaps", lambda d: F.date_format(d, "yyyy-MM-dd")))
    return text_date(report.withColumn("gaps", gaps), "first_day", "last_day")


# --- trades --------------------------------------------------------------------------------------


@query
def bars_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trade_ops.bars(workload.trades(spark, sf_dir), "1 minute")


@query
def bars_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trade_ops.bars(workload.trades(spark, sf_dir), "1 hour")


@query
def bars_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trade_ops.bars(workload.trades(spark, sf_dir), "1 day")


@query
def bars_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly and daily bars kept up to date: a first batch, late trades of all days in a second, which comes twice."""
    rows = workload.trades(spark, sf_dir)
    path = scratch_path(spark, "bars")
    for number, late in ((0, False), (1, True), (1, True)):
        rollup.refresh(spark, path, rows.filter((F.col("arrival") % 5 == 3) == late), number)
    hours, days = (rollup.read_bars(spark, path, interval, rows).withColumn("interval", F.lit(interval)) for interval in ("1 hour", "1 day"))
    return hours.unionByName(days)


@query
def trades_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trade_ops.latest(workload.trades(spark, sf_dir), "T0", 20).select(
        "ticker", "trade_id", "price", "count", "ts_ms"
    )


@query
def trades_latest_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest trades of a ticker in the hot table, of which only the newest days are read."""
    here = _new_tiers(spark)
    rows = tables.to_trades(workload.trades(spark, sf_dir).withColumnRenamed("ts_ms", "timestamp"))
    for number in range(2):
        tiers.write_hot(rows.filter(F.col("arrival") % 2 == number), here, "trades", number)
    return tiers.latest_rows(spark, here.hot("trades"), "t0", 20).select("ticker", "trade_id", "price", "count", "ts_ms")


@query
def trades_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = trade_ops.time_range(
        workload.trades(spark, sf_dir), dt.datetime(2024, 1, 10, 6), dt.datetime(2024, 1, 20), "t1"
    )
    return rows.select("ticker", "trade_id", "price", "count", "ts_ms")


@query
def trades_range_zoned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds given in a zone east of Greenwich, over midnight there."""
    zone = dt.timezone(dt.timedelta(hours=5))
    start, end = dt.datetime(2024, 1, 16, 1, tzinfo=zone), dt.datetime(2024, 1, 17, 2, tzinfo=zone)
    rows = trade_ops.time_range(workload.trades(spark, sf_dir), start, end)
    return rows.select("ticker", "trade_id", "price", "count", "ts_ms")


@query
def day_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = trade_ops.day_slice(workload.trades(spark, sf_dir), SOME_DAY)
    return rows.select("ticker", "trade_id", "price", "count", "ts_ms")


@query
def dedup_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades of two overlapping pulls."""
    rows = workload.trades(spark, sf_dir)
    again = rows.filter(F.col("price") > 49).withColumn("arrival", F.col("arrival") + 1_000_000_000)
    return trade_ops.dedup_trades(rows.unionByName(again)).select("trade_id", "ticker", "price", "arrival")


@query
def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times, dates and texts of every order."""
    rows = workload.table(spark, sf_dir, "orders")
    day = F.col("o_orderdate").cast("date")
    ms = scalars.ms_from_ts(F.col("o_orderdate"))
    text = F.date_format(day, "yyyy-MM-dd")
    return rows.select(
        "o_orderkey",
        scalars.ns_from_ms(ms).alias("ts_ns"),
        scalars.day_start_seconds(scalars.parse_day_column(text)).alias("midnight"),
        F.date_format(F.date_add(day, 1), "yyyy-MM-dd").alias("next_day"),
        F.datediff(F.lit("2000-01-01").cast("date"), day).alias("days"),
        scalars.upper_ticker(F.concat(F.lit("mk-"), F.lower("o_orderpriority"))).alias("ticker"),
        F.substring(F.concat(F.lit("mk-"), "o_orderpriority"), 1, 6).alias("clipped"),
        scalars.mid_price(F.col("o_orderkey") % 97, F.col("o_custkey") % 89).alias("mid"),
        scalars.spread(F.col("o_orderkey") % 97, F.col("o_custkey") % 89).alias("spread"),
    )


# --- pages and markets ---------------------------------------------------------------------------


def _landed(rows: DataFrame, name: str) -> str:
    path = scratch_path(rows.sparkSession, name)
    rows.write.json(path)
    return path


@query
def trade_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pages.read_trade_pages(spark, _landed(workload.trade_pages(spark, sf_dir), "trade-pages"))
    return rows.select("page_no", "pos", "ticker", "trade_id", "price", "count", F.col("timestamp").alias("ts_ms"))


def _raw_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades of pages as the API gives them: without numbers, their price as `yes_price`."""
    listed = F.transform("trades", lambda t: t.withField("yes_price", t["price"]).dropFields("price"))
    numbered = workload.trade_pages(spark, sf_dir).repartitionByRange(4, "page_no").sortWithinPartitions("page_no")
    path = _landed(numbered.select(listed.alias("trades"), "cursor"), "raw-pages")
    return pages.read_trade_pages(spark, path)


@query
def trade_pages_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _raw_pages(spark, sf_dir)
    return rows.select("page_no", "pos", "ticker", "trade_id", "yes_price", "count", F.col("timestamp").alias("ts_ms"))


@query
def bars_of_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars of trades that came in pages."""
    return trade_ops.bars(tables.to_trades(_raw_pages(spark, sf_dir)), "1 hour")


@query
def trade_pages_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pages.read_trade_pages(spark, _landed(workload.trade_pages(spark, sf_dir), "trade-pages"), ticker="t2")
    return pages.first_trades(rows, 10).select("page_no", "pos", "ticker", "trade_id")


@query
def backfill_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten days of one ticker from two overlapping sets of pages."""
    path = _landed(workload.trade_pages(spark, sf_dir), "trade-pages")
    rows = pages.read_trade_pages(spark, [path, path])
    taken = pages.backfill_range(rows, "T3", "2024-01-05", "2024-01-14")
    return text_date(taken, "date").select("ticker", "trade_id", "price", "count", "ts_ms", "date")


def _cursor_pages(spark: SparkSession, sf_dir: str, lost: int | None = None) -> DataFrame:
    """Trade pages of one pull with opaque cursors, landed out of order, some of them twice."""
    numbered = workload.trade_pages(spark, sf_dir)
    last = numbered.agg(F.max("page_no")).first()[0]

    def cursor(number):
        return F.when((number > 0) & (number <= last), F.substring(F.md5(number.cast("string")), 1, 12)).otherwise("")

    page = F.col("page_no")
    landed = numbered.select(F.lit("pull-1").alias("pull"), cursor(page).alias("own"), cursor(page + 1).alias("cursor"), "trades", page.alias("n"))
    landed = landed if lost is None else landed.filter(F.col("n") != lost)
    again = landed.filter("n % 4 = 1")
    return cursors.read_cursor_pages(spark, _landed(landed.unionByName(again).repartition(5, "own").drop("n"), "cursor-pages"))


@query
def trade_pages_by_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades in the order of the cursors of their pages."""
    rows = cursors.trades_by_cursor(_cursor_pages(spark, sf_dir))
    return rows.select("page_no", "pos", "ticker", "trade_id", "price", "count", F.col("timestamp").alias("ts_ms"))


@query
def broken_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a pull lacks whose fourth page never landed."""
    return cursors.broken_chains(_cursor_pages(spark, sf_dir, lost=3))


@query
def backfill_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days without trades fetched out of pages landed by day, of which neighbours overlap."""
    rows = workload.trades(spark, sf_dir)
    trade = F.struct("ticker", "trade_id", "price", "count", "taker_side", F.col("ts_ms").alias("timestamp"))
    after = rows.filter(F.hour("ts") >= 22).withColumn("day", F.date_add("date", 1))
    asked = rows.withColumn("day", F.col("date")).unionByName(after)
    paged = asked.groupBy("day", F.hour("ts").cast("bigint").alias("page_no")).agg(F.collect_list(trade).alias("trades"))
    path = scratch_path(spark, "day-pages")
    pages.land_by_day(paged.withColumn("cursor", F.lit("")), path)
    traded = _odd_days(spark, sf_dir)
    found = pages.backfill_missing(spark, path, quality.missing_days(traded, *span(spark, sf_dir), traded))
    return text_date(found, "date").select("ticker", "trade_id", "price", "count", "ts_ms", "date")


@query
def quarantined_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages of which every third has a text where its trades should be, and blank lines between them."""
    rows = workload.trade_pages(spark, sf_dir)
    good = F.to_json(F.struct("page_no", "trades"))
    bad = F.concat(F.lit('{"page_no":'), F.col("page_no").cast("string"), F.lit(',"trades":"none"}'))
    path = scratch_path(spark, "pages")
    line = F.when(F.col("page_no") % 3 == 1, bad).otherwise(good)
    rows.select(F.explode(F.array(line, F.lit(""), F.lit("  "))).alias("value")).write.text(path)
    return pages.malformed_trade_pages(spark, path).select("line")


@query
def feed_blank_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages per channel of a feed with a blank line after every message."""
    rows = feeds.envelopes_of(workload.feed(spark, sf_dir))
    path = scratch_path(spark, "feed")
    rows.select(F.explode(F.array(F.to_json(F.struct(*rows.columns)), F.lit(""), F.lit(" \t"))).alias("value")).write.text(path)
    read = feeds.read_feed(spark, path)
    quarantined = feeds.quarantined(spark, path).select(F.lit("quarantined").alias("channel"))
    return monitoring.feed_counts(feeds.messages(read).select("channel").unionByName(quarantined))


def _market_document(spark: SparkSession, sf_dir: str) -> str:
    """All parts as one list of objects in one line, with brackets and quotes inside of their texts."""
    part = workload.table(spark, sf_dir, "part")
    note = F.concat(F.lit('a "}" and [{'), "p_name", F.lit("\\"))
    entry = F.to_json(F.struct(F.col("p_partkey").alias("key"), note.alias("note"), F.struct(F.array("p_size", "p_partkey").alias("sizes")).alias("more")))
    # One file is written by one task, which sorts and streams the objects and never holds the list as a whole.
    rows = part.select(F.lit(False).alias("end"), "p_partkey", entry.alias("e")).unionByName(spark.range(1).select(F.lit(True).alias("end"), F.lit("]").alias("e")), allowMissingColumns=True)
    ordered = rows.repartition(1).sortWithinPartitions("end", "p_partkey").withColumn("row", F.monotonically_increasing_id())
    before = F.when(F.col("row") == 0, "[").when(F.col("end"), "").otherwise(",")
    path = scratch_path(spark, "document")
    ordered.select(F.concat(before, "e").alias("value")).write.option("lineSep", " ").text(path)
    return path


@query
def preview_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first seven objects of a document of one line."""
    first = documents.preview_document(spark, _market_document(spark, sf_dir), 7)
    return first.select(F.get_json_object("value", "$.key").cast("bigint").alias("key"), F.get_json_object("value", "$.note").alias("note"))


@query
def read_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every object of a document of one line, which is cut into short blocks."""
    path = _market_document(spark, sf_dir)
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 16_384)
    try:
        rows = documents.read_document(spark, path)
        return written(rows, "objects").select(F.get_json_object("value", "$.key").cast("bigint").alias("key"), F.get_json_object("value", "$.note").alias("note"), F.get_json_object("value", "$.more.sizes[0]").cast("int").alias("size"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)


@query
def book_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First three entries of each ladder of landed order-book pages."""
    live = book.book(workload.deltas(spark, sf_dir))
    path = _landed(snapshots.snapshot_of(live, F.lit(0)).select("ticker", "orderbook"), "book-pages")
    return pages.snapshot_levels(pages.read_books(spark, path), 3)


@query
def load_trade_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written to the hot table, as counted by the write and as found in the table."""
    here = _new_tiers(spark)
    path = _landed(workload.trade_pages(spark, sf_dir), "trade-pages")
    written = pages.load_trade_pages(spark, path, here, "load-1")
    return spark.table(here.hot("trades")).agg(
        F.count("*").alias("found"), F.lit(written).cast("bigint").alias("written")
    )


def _markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.read_markets(spark, _landed(workload.market_pages(spark, sf_dir), "market-pages"))


@query
def markets_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.summarize_markets(_markets(spark, sf_dir))


@query
def markets_of_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.summarize_markets(_markets(spark, sf_dir), series_ticker="economy", status="closed")


@query
def markets_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.display_markets(pages.summarize_markets(_markets(spark, sf_dir)))


@query
def series_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One series object per part, every seventh without a title."""
    part = workload.table(spark, sf_dir, "part")
    series = F.struct(
        F.concat(F.lit("s"), "p_partkey").alias("ticker"),
        F.when(F.col("p_partkey") % 7 != 0, F.col("p_name")).alias("title"),
        F.col("p_type").alias("category"),
    )
    path = _landed(part.select(series.alias("series")), "series")
    return pages.clipped(pages.read_series(spark, path), "series")


def _series_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series whose size is a number, for every fifth a text, and whose title is missing for every seventh."""
    part = workload.table(spark, sf_dir, "part")
    size = F.col("p_size").cast("string")
    body = F.concat(
        F.lit('{"series":{"ticker":"s'), F.col("p_partkey").cast("string"), F.lit('","category":'), F.to_json(F.array("p_type")),
        F.when(F.col("p_partkey") % 7 != 0, F.concat(F.lit(',"title":"'), "p_name", F.lit('"'))).otherwise(""),
        F.lit(',"size":'), F.when(F.col("p_partkey") % 5 == 0, F.concat(F.lit('"'), size, F.lit('"'))).otherwise(size), F.lit("}}"),
    )
    path = scratch_path(spark, "series")
    part.select(body.alias("value")).write.text(path)
    return pages.read_opaque_variants(spark, path, "series")


@query
def series_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields picked out of opaque series."""
    rows = _series_variants(spark, sf_dir)
    return pages.variant_fields(rows, "series", title="$.title string", category="$.category[0] string", size="$.size bigint")


@query
def series_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of the series with their types."""
    return pages.field_drift(_series_variants(spark, sf_dir), "series")


@query
def event_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One event object per supplier, with the ticker outside of the object."""
    supplier = workload.table(spark, sf_dir, "supplier")
    rows = supplier.select(
        F.concat(F.lit("e"), "s_suppkey").alias("ticker"), F.struct(F.col("s_name").alias("title")).alias("event")
    )
    return pages.read_events(spark, _landed(rows, "events"))


@query
def first_market(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.first_market(_markets(spark, sf_dir)).select("ticker", "title", "status")


@query
def markets_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first open markets of the list, which runs over several pages."""
    path = _landed(workload.market_pages(spark, sf_dir).repartitionByRange(3, "page_no").sortWithinPartitions("page_no"), "market-pages")
    return pages.read_markets(spark, path, status="open", limit=700).select("ticker", "status", "page_no", "pos")


@query
def quarantined_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landed feed in which the errors are broken lines."""
    rows = workload.feed(spark, sf_dir)
    line = F.when(F.col("type") == "unsupported", F.concat(F.lit("{bad "), F.col("arrival").cast("string")))
    good = F.to_json(F.struct("channel", F.struct("type", "ticker", "price").alias("message"), "arrival"))
    path = scratch_path(spark, "feed")
    rows.select(F.coalesce(line, good).alias("value")).write.text(path)
    return feeds.quarantined(spark, path).select("line")


# --- monitoring ----------------------------------------------------------------------------------


@query
def latency_p99(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.latency_quantile(workload.events(spark, sf_dir), "1 hour", 99, limit=200)


@query
def latency_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stretches of hours whose 99th percentile is above a limit, and whether they last two hours."""
    hourly = monitoring.latency_quantile(workload.events(spark, sf_dir), "1 hour", 99, limit=60)
    return monitoring.latency_alerts(hourly, "1 hour", "2 hours")


@query
def counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = workload.feed(spark, sf_dir, numbered=True)
    delta_rows = routing.of_type(rows, "orderbook_delta").withColumn("ts_ms", F.col("timestamp"))
    changes = quotes.bbo_changes(quotes.bbo_history(delta_rows))
    return monitoring.counters(rows, changes, quality.sequence_gaps(rows))


# --- tiers ---------------------------------------------------------------------------------------


def _new_tiers(spark: SparkSession) -> tiers.Tiers:
    """Empty tables below the shared folder."""
    name = f"tidebook_{uuid.uuid4().hex}"
    root = f"{shared_dir(spark)}/{name}"
    here = tiers.Tiers(name, f"{root}/archive")
    tiers.create_tiers(spark, here, f"{root}/tables")
    return here


def _filled_tiers(spark: SparkSession, sf_dir: str, *names: str) -> tiers.Tiers:
    here = _new_tiers(spark)
    shaped = tables.shape_tables(workload.feed(spark, sf_dir))
    for name in names:
        tiers.write_hot(shaped[name], here, name, "load-1")
    return here


def _per_day(rows: DataFrame) -> DataFrame:
    return text_date(
        rows.groupBy("date").agg(
            F.count("*").alias("rows"), F.sum("count").alias("volume"), F.min("ts_ms").alias("first_ms")
        ),
        "date",
    )


@query
def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("trades", "orderbook_deltas", "tickers")
    here = _filled_tiers(spark, sf_dir, *names)
    return monitoring.table_counts({name: spark.table(here.hot(name)) for name in names})


@query
def hot_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches of one table, the second written twice, moved to the warm tier in two goes."""
    here = _new_tiers(spark)
    rows = tables.shape_tables(workload.feed(spark, sf_dir))["trades"]
    for number in (0, 1, 1):
        tiers.write_hot(rows.filter(F.col("arrival") % 3 == number), here, "trades", f"part {number}")
    first, last = span(spark, sf_dir)
    tiers.migrate_days(spark, here, "trades", first, last)
    tiers.write_hot(rows.filter(F.col("arrival") % 3 == 2), here, "trades", "late")
    tiers.migrate_days(spark, here, "trades", first, last)
    return _per_day(spark.table(here.warm("trades")))


@query
def migrate_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day moved twice."""
    here = _filled_tiers(spark, sf_dir, "trades")
    tiers.migrate_day(spark, here, "trades", SOME_DAY)
    tiers.migrate_day(spark, here, "trades", SOME_DAY)
    return _per_day(spark.table(here.warm("trades")))


@query
def migrate_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    here = _filled_tiers(spark, sf_dir, "trades")
    tiers.migrate_days(spark, here, "trades", *span(spark, sf_dir))
    return _per_day(spark.table(here.warm("trades")))


@query
def export_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days in the archive, the last one written on its own."""
    here = _filled_tiers(spark, sf_dir, "trades")
    first, last = span(spark, sf_dir)
    tiers.migrate_days(spark, here, "trades", first, last)
    tiers.export_days(spark, here, "trades", first, last - dt.timedelta(days=1))
    tiers.export_day(spark, here, "trades", last)
    return _per_day(tiers.read_archive(spark, here, "trades"))


@query
def expired_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    here = _filled_tiers(spark, sf_dir, "trades")
    tiers.migrate_days(spark, here, "trades", *span(spark, sf_dir))
    expired = tiers.expired_partitions(spark, here.warm("trades"), "2024-03-31", 80)
    return text_date(expired.select("date"), "date")


@query
def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of the warm trades after retention."""
    here = _filled_tiers(spark, sf_dir, "trades")
    tiers.migrate_days(spark, here, "trades", *span(spark, sf_dir))
    tiers.apply_retention(spark, here, "2024-03-31", 80)
    return _per_day(spark.table(here.warm("trades")))


@query
def end_of_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the trades of each tier are after the end of one day, and what was logged."""
    here = _filled_tiers(spark, sf_dir, "trades", "orderbook_deltas")
    tiers.end_of_day(spark, here, SOME_DAY)
    logged = tiers.migration_log(spark, here).filter(F.col("table") == "trades")
    counted = monitoring.table_counts(
        {
            "hot": spark.table(here.hot("trades")),
            "warm": spark.table(here.warm("trades")),
            "archive": tiers.read_archive(spark, here, "trades"),
        }
    )
    return counted.unionByName(logged.select(F.concat(F.lit("log "), "status").alias("table"), "rows"))


def _moved(spark: SparkSession, here: tiers.Tiers) -> DataFrame:
    """Contents of both tables in every tier: rows, volume and a sum over their fields."""

    def summed(rows: DataFrame, tier: str, table: str) -> DataFrame:
        amount = F.col("count") if table == "trades" else F.col("delta_size")
        facts = rows.groupBy(F.date_format("date", "yyyy-MM-dd").alias("date")).agg(
            F.count(F.lit(1)).alias("rows"), F.sum(amount).alias("amount"), F.sum("price").alias("prices"), F.sum(F.col("arrival") % 1009).alias("arrivals")
        )
        return facts.select(F.lit(tier).alias("tier"), F.lit(table).alias("table"), "*")

    parts = [
        summed(rows, tier, table)
        for table in ("trades", "orderbook_deltas")
        for tier, rows in (
            ("hot", spark.table(here.hot(table))),
            ("warm", spark.table(here.warm(table))),
            ("archive", tiers.read_archive(spark, here, table)),
        )
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def _split_day(spark: SparkSession, sf_dir: str, here: tiers.Tiers, batch: str, remainder: int) -> None:
    """Every second message of the two tables, as one batch."""
    for name, rows in tables.shape_tables(workload.feed(spark, sf_dir)).items():
        if name in ("trades", "orderbook_deltas"):
            tiers.write_hot(rows.filter(F.col("arrival") % 2 == remainder), here, name, batch)


@query
def end_of_day_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day is closed, half of its messages come late, and it is closed again."""
    here = _new_tiers(spark)
    _split_day(spark, sf_dir, here, "2024-01-15T10:00/a", 0)
    tiers.end_of_day(spark, here, SOME_DAY)
    _split_day(spark, sf_dir, here, "late: it's 100%", 1)
    tiers.end_of_day(spark, here, SOME_DAY)
    return _moved(spark, here)


@query
def end_of_day_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day is closed, its batch is recorded and closed once more, and once again without new rows."""
    here = _filled_tiers(spark, sf_dir, "trades", "orderbook_deltas")
    tiers.end_of_day(spark, here, SOME_DAY)
    for name in ("trades", "orderbook_deltas"):
        tiers.write_hot(tables.shape_tables(workload.feed(spark, sf_dir))[name], here, name, "load-1")
    tiers.end_of_day(spark, here, SOME_DAY)
    tiers.end_of_day(spark, here, SOME_DAY)
    return _moved(spark, here)


@query
def end_of_day_after_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day is closed, dropped from the warm tier by its age, and closed again when late messages come."""
    here = _new_tiers(spark)
    _split_day(spark, sf_dir, here, "first", 0)
    tiers.end_of_day(spark, here, SOME_DAY)
    tiers.apply_retention(spark, here, "2024-06-30")
    tiers.end_of_day(spark, here, SOME_DAY)
    _split_day(spark, sf_dir, here, "late", 1)
    tiers.end_of_day(spark, here, SOME_DAY)
    return _moved(spark, here)


# --- streams -------------------------------------------------------------------------------------


def _spread(rows: DataFrame) -> DataFrame:
    """Rows dealt over all cores to be landed, whatever task they come from."""
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism, "arrival")


def _goes(rows: DataFrame, goes: int = 5) -> list[DataFrame]:
    """The rows in so many goes of equal width by their arrival numbers.

    A go is a range of the numbers, so that only files and row groups with such numbers are read for it.
    """
    low, high = rows.agg(F.min("arrival"), F.max("arrival")).first()
    edges = [low + -(-(high - low + 1) * number // goes) for number in range(goes + 1)]
    return [rows.filter((F.col("arrival") >= begin) & (F.col("arrival") < end)) for begin, end in zip(edges, edges[1:], strict=False)]


def _landed_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed landed as JSON lines and read back as a stream of one batch."""
    path = scratch_path(spark, "feed")
    feeds.write_feed(_spread(workload.feed(spark, sf_dir, numbered=True)), path)
    return feeds.stream_feed(spark, path, files_per_batch=EVERY_FILE)


def _run_in_goes(spark: SparkSession, sf_dir: str, run: Callable[[DataFrame], StreamingQuery]) -> None:
    """The feed landed as JSON lines in five goes; after each the stream is run, with the go as its micro-batch."""
    path = scratch_path(spark, "feed")
    for go in _goes(written(workload.feed(spark, sf_dir, numbered=True), "messages")):
        feeds.write_feed(_spread(go), path)
        _finish(run(feeds.stream_feed(spark, path, files_per_batch=EVERY_FILE)))


def _finish(running) -> None:
    running.awaitTermination()


@query
def feed_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed feed read as a batch."""
    path = scratch_path(spark, "feed")
    feeds.write_feed(workload.feed(spark, sf_dir, numbered=True, lossy=False), path)
    rows = feeds.messages(feeds.read_feed(spark, path))
    return rows.select("channel", "arrival", "ticker", "sequence", "price", "delta_size", "count")


@query
def stream_plant(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, state, checkpoint = (scratch_path(spark, name) for name in ("plant", "state", "checkpoint"))
    _finish(plant.plant_stream(_landed_feed(spark, sf_dir), out, state, checkpoint))
    return _planted(spark, out)


@query
def stream_plant_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plant over five micro-batches, its state carried from one to the next."""
    out, state, checkpoint = (scratch_path(spark, name) for name in ("plant", "state", "checkpoint"))
    _run_in_goes(spark, sf_dir, lambda feed: plant.plant_stream(feed, out, state, checkpoint))
    return _planted(spark, out)


def _planted(spark: SparkSession, out: str) -> DataFrame:
    events = plant.published(spark, out).filter("channel <> 'quarantine'")
    return events.select(
        "channel", "arrival", "ord", "ticker", "bid_price", "ask_price", "price", "last_price", "last_sequence"
    )


@query
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the streamed plant puts aside: unknown types, and deltas without price."""
    rows = workload.feed(spark, sf_dir, numbered=True, lossy=False)
    broken = F.when((F.col("type") == "orderbook_delta") & (F.col("arrival") % 10 == 3), F.lit(None)).otherwise(F.col("price"))
    path = scratch_path(spark, "feed")
    feeds.write_feed(rows.withColumn("price", broken), path)
    out, state, checkpoint = (scratch_path(spark, name) for name in ("plant", "state", "checkpoint"))
    _finish(plant.plant_stream(feeds.stream_feed(spark, path), out, state, checkpoint))
    return plant.published(spark, out).filter("channel = 'quarantine'").select("arrival", "ticker", "reason")


def _recovered(spark: SparkSession, sf_dir: str) -> str:
    """Five batches of every event as a delta: losses in the first two fifths, a snapshot after three."""
    rows = workload.sequenced(spark, sf_dir).withColumnRenamed("ts_ms", "timestamp").withColumn("type", F.lit("orderbook_delta"))
    rows = written(rows.withColumn("channel", F.col("type")), "messages")
    low, high = rows.agg(F.min("arrival"), F.max("arrival")).first()
    taken = low + 3 * (high - low + 1) // 5
    feed_path, log_path = scratch_path(spark, "feed"), scratch_path(spark, "snapshots")
    seen = workload.deltas(spark, sf_dir).filter(F.col("arrival") <= taken)
    logged = written(snapshots.snapshot_of(book.book(seen), F.lit(0), arrival=F.lit(taken)), "logged")
    out, state, checkpoint = (scratch_path(spark, name) for name in ("books", "state", "checkpoint"))
    for number, go in enumerate(_goes(rows)):
        feeds.write_feed(_spread(go.filter("arrival % 50 <> 7") if number < 2 else go), feed_path)
        if number < 4:  # an old poll without ticker with each of the first batches, then the real one
            polled = logged if number == 3 else logged.limit(1).withColumn("ticker", F.lit("NONE"))
            snapshots.write_snapshot_log(polled.coalesce(1), log_path)
        messages = feeds.stream_feed(spark, feed_path, files_per_batch=EVERY_FILE)
        stream = recovery.with_snapshots(messages, recovery.stream_snapshots(spark, log_path, files_per_batch=EVERY_FILE))
        _finish(recovery.recovery_stream(stream, out, state, checkpoint, rows=SHORT_SEGMENT))
    return out


@query
def stream_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The book of a feed that lost messages, made whole by a snapshot that came three batches later."""
    return recovery.recovered_book(spark, _recovered(spark, sf_dir))


@query
def stream_recovery_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each book went stale, its last gap, and the snapshot that closed it."""
    return recovery.recoveries(spark, _recovered(spark, sf_dir)).drop("batch")


@query
def stream_record_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream recorded in five batches: rows per table, day and side of the hot tier."""
    here = _new_tiers(spark)
    checkpoint = scratch_path(spark, "checkpoint")
    _run_in_goes(spark, sf_dir, lambda feed: record.record_stream(feed, here, checkpoint))
    names = ("trades", "orderbook_deltas", "tickers")
    per_day = [
        spark.table(here.hot(name)).groupBy(F.date_format("date", "yyyy-MM-dd").alias("date")).agg(F.count("*").alias("rows"), F.sum(F.col("arrival") % 1009).alias("arrivals"))
        .select(F.lit(name).alias("table"), "*")
        for name in names
    ]
    return per_day[0].unionByName(per_day[1]).unionByName(per_day[2])


@query
def stream_bbo_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The `bbo` table as the plant writes it over five batches."""
    here = _new_tiers(spark)
    out, state, checkpoint = (scratch_path(spark, name) for name in ("plant", "state", "checkpoint"))
    _run_in_goes(spark, sf_dir, lambda feed: plant.plant_stream(feed, out, state, checkpoint, tiers=here))
    return text_date(spark.table(here.hot("bbo")), "date").select("ticker", *BBO_COLUMNS, "arrival", "ts_ms", "date")


@query
def stream_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows recorded per table by the stream."""
    here = _new_tiers(spark)
    _finish(record.record_stream(_landed_feed(spark, sf_dir), here, scratch_path(spark, "checkpoint")))
    names = ("trades", "orderbook_deltas", "tickers", "bbo")
    return monitoring.table_counts({name: spark.table(here.hot(name)) for name in names})


def _to_parquet(spark: SparkSession, rows: DataFrame, out: str | None = None, checkpoint: str | None = None) -> DataFrame:
    out = out or scratch_path(spark, "out")
    running = (
        rows.writeStream.outputMode("append")
        .format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint or scratch_path(spark, "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    _finish(running)
    return spark.read.schema(rows.schema).parquet(out)


def _upserted(spark: SparkSession, rows: DataFrame, *keys: str) -> DataFrame:
    path = scratch_path(spark, "windows")
    _finish(record.upsert_stream(rows, path, scratch_path(spark, "checkpoint")))
    return record.newest(spark, path, rows.schema, list(keys))


def _streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table itself as a stream."""
    schema = workload.table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


@query
def stream_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars of a stream of trades, the last ones included."""
    trades = workload.trades_of(workload.shaped(_streamed(spark, sf_dir)))
    bars = windows.bars_stream(trades.withColumn("ts", F.col("ts").cast("timestamp")), "1 hour", "10 minutes")
    done = _upserted(spark, bars, "ticker", "bar_start")
    return done.withColumn("bar_ms", scalars.ms_from_ts(F.col("bar_start"))).drop("bar_start")


@query
def stream_gap_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gap flags of a stream of five batches, cut into short segments."""
    out, state, checkpoint = (scratch_path(spark, name) for name in ("flags", "state", "checkpoint"))
    _run_in_goes(spark, sf_dir, lambda feed: plant.flag_stream(feed, out, state, checkpoint, rows=SHORT_SEGMENT))
    return plant.published(spark, out).select("ticker", "arrival", "sequence", "last_sequence", "gap")


@query
def stream_bbo_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price changes of a stream in which every event is a delta, cut into short segments."""
    deltas = workload.deltas_of(workload.shaped(_streamed(spark, sf_dir))).withColumnRenamed("ts_ms", "timestamp")
    feed = deltas.withColumn("type", F.lit("orderbook_delta")).withColumn("sequence", F.lit(None).cast("bigint"))
    out, state, checkpoint = (scratch_path(spark, name) for name in ("plant", "state", "checkpoint"))
    _finish(plant.plant_stream(feed, out, state, checkpoint, rows=SHORT_SEGMENT))
    changes = plant.published(spark, out).filter("channel = 'bbo'").withColumnRenamed("timestamp", "ts_ms")
    return changes.select("ticker", "arrival", "ts_ms", *BBO_COLUMNS)


@query
def stream_gap_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sliding gap counts of a stream of flagged messages, the last windows included."""
    flagged = quality.sequence_gaps(workload.lossy(spark, sf_dir))
    path = scratch_path(spark, "flags")
    flagged.select(F.timestamp_millis("ts_ms").alias("ts"), "gap").write.parquet(path)
    stream = spark.readStream.schema("ts TIMESTAMP, gap BOOLEAN").parquet(path)
    done = _upserted(spark, windows.gap_rate_stream(stream), "window_start")
    return done.withColumn("window_ms", scalars.ms_from_ts(F.col("window_start"))).drop("window_start")


@query
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades of a stream that holds every one twice, each once; those without an id stay as they are."""
    trades = workload.trades_of(workload.shaped(_streamed(spark, sf_dir)))
    named = F.when(F.col("arrival") % 7 != 0, F.col("trade_id")).alias("trade_id")
    rows = trades.select(named, "arrival", F.col("ts").cast("timestamp").alias("ts"))
    return _to_parquet(spark, windows.dedup_stream(rows.unionByName(rows))).select("trade_id", "arrival")


@query
def stream_dedup_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades of a stream of five batches, each of which repeats those of three batches before."""
    trades = workload.trades(spark, sf_dir)
    named = trades.withColumn("trade_id", F.when(F.col("arrival") % 7 != 0, F.col("trade_id")))
    path = scratch_path(spark, "trades")
    out, seen, checkpoint = (scratch_path(spark, name) for name in ("unique", "history", "checkpoint"))
    goes = _goes(named)
    for number, go in enumerate(goes):
        if number >= 3:
            again = goes[number - 3].filter(F.col("trade_id").isNotNull()).withColumn("arrival", F.col("arrival") + 1_000_000_000)
            go = go.unionByName(again)
        _spread(go).write.mode("append").parquet(path)
        stream = spark.readStream.schema(named.schema).parquet(path)
        _finish(history.dedup_history_stream(stream, out, seen, checkpoint))
    return spark.read.parquet(out).select("trade_id", "arrival")


@query
def stream_gap_rate_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sliding gap counts of the messages that another stream flags, in five batches."""
    out, state, checkpoint = (scratch_path(spark, name) for name in ("flags", "state", "checkpoint"))
    deltas = workload.lossy(spark, sf_dir).withColumnRenamed("ts_ms", "timestamp").withColumn("type", F.lit("orderbook_delta"))
    path = scratch_path(spark, "feed")
    feeds.write_feed(deltas.withColumn("channel", F.col("type")).repartitionByRange(5, "arrival"), path)
    _finish(plant.flag_stream(feeds.stream_feed(spark, path), out, state, checkpoint))
    flagged = spark.readStream.schema("timestamp BIGINT, gap BOOLEAN, batch BIGINT").parquet(out)
    moments = flagged.select(F.timestamp_millis("timestamp").alias("ts"), "gap")
    done = _upserted(spark, windows.gap_rate_stream(moments), "window_start")
    return done.withColumn("window_ms", scalars.ms_from_ts(F.col("window_start"))).drop("window_start")


@query
def stream_evicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price changes of 40 tickers over five batches, by Spark's state store, books parked after six idle hours."""
    deltas = workload.deltas(spark, sf_dir).drop("ticker").join(
        workload.table(spark, sf_dir, "events").select(F.col("event_id").alias("arrival"), F.concat(F.lit("U"), F.col("user_id") % 40).alias("ticker")), "arrival"
    )
    path, out, checkpoint = (scratch_path(spark, name) for name in ("deltas", "out", "checkpoint"))
    with stateful.rocksdb(spark):
        for go in _goes(written(deltas, "keyed")):
            _spread(go).write.mode("append").parquet(path)
            stream = spark.readStream.schema(deltas.schema).parquet(path)
            events = _to_parquet(spark, stateful.evicting_book_stream(stream, idle="6 hours", late="1 hour"), out, checkpoint)
    return events.filter("event = 'quote'").select("ticker", "arrival", "ts_ms", *BBO_COLUMNS)
