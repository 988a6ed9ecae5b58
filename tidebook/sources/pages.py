"""Landed API pages: trades, markets, order books, series and events."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from tidebook.functions.scalars import clip_json, default_text, parse_day
from tidebook.operators.tables import to_trades
from tidebook.operators.trades import dedup_trades
from tidebook.operators.tiers import Tiers, write_hot
from tidebook.schemas import BOOK_PAGE, CORRUPT, MARKET_PAGE, TRADE_PAGE
from tidebook.sources.checks import malformed, not_blank
from tidebook.sources.lines import number_lines

# Bits of an arrival number that hold the position in the page; a page beyond them is refused.
POSITION_BITS = 24


def malformed_trade_pages(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Pages that are no objects or whose `trades` is no list of trades."""
    return malformed(spark, path, TRADE_PAGE)


def malformed_market_pages(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return malformed(spark, path, MARKET_PAGE)


def _read(spark: SparkSession, path: str | list[str], schema: StructType) -> DataFrame:
    return spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT).json(path)


# --- trades --------------------------------------------------------------------------------------


def read_trade_pages(
    spark: SparkSession,
    path: str | list[str],
    ticker: str | None = None,
    min_ts: int | None = None,
    max_ts: int | None = None,
) -> DataFrame:
    """Trades of all pages, one per row, with page number and position; bounds in epoch ms, inclusive.

    Pages as the API gives them have no number; they are numbered in the order of their files and lines.
    Pages without a list give no rows. Several folders are read as one.
    """
    rows = explode_trades(numbered(_read(spark, path, TRADE_PAGE)))
    return filter_trades(rows, ticker, min_ts, max_ts)


def numbered(pages: DataFrame) -> DataFrame:
    """Pages with a number: their own where all have one, else their place in the files, by path and line."""
    if pages.filter("page_no IS NULL").isEmpty():
        return pages
    return number_lines(pages, "page_no")


def explode_trades(pages: DataFrame, *keys: str) -> DataFrame:
    listed = pages.select(*keys, "page_no", F.posexplode("trades").alias("pos", "trade"))
    fits = F.col("pos") < (1 << POSITION_BITS)
    number = F.shiftleft("page_no", POSITION_BITS) + F.col("pos")
    arrival = F.when(fits, number).otherwise(F.raise_error(F.lit("a page has too many trades to be numbered")).cast("bigint"))
    return listed.select(*keys, "page_no", "pos", arrival.alias("arrival"), "trade.*")


def filter_trades(
    rows: DataFrame, ticker: str | None = None, min_ts: int | None = None, max_ts: int | None = None
) -> DataFrame:
    if ticker is not None:
        rows = rows.filter(F.col("ticker") == ticker.upper())
    moment = F.coalesce(F.col("timestamp"), F.unix_millis(F.try_to_timestamp("created_time")))
    if min_ts is not None:
        rows = rows.filter(moment >= min_ts)
    if max_ts is not None:
        rows = rows.filter(moment <= max_ts)
    return rows


def first_trades(rows: DataFrame, n: int = 10) -> DataFrame:
    """The first trades in page order."""
    return rows.orderBy("page_no", "pos").limit(n)


def load_trade_pages(
    spark: SparkSession,
    path: str | list[str],
    tiers: Tiers,
    batch: str,
    ticker: str | None = None,
    min_ts: int | None = None,
    max_ts: int | None = None,
    ingest_ms: Column | None = None,
) -> int:
    """Write the trades of landed pages to the hot table; returns the rows written.

    The count comes from the write itself, not from a second pass.
    """
    trades = to_trades(read_trade_pages(spark, path, ticker, min_ts, max_ts), ingest_ms)
    seen = Observation()
    write_hot(trades.observe(seen, F.count(F.lit(1)).alias("rows")), tiers, "trades", batch)
    return seen.get["rows"]


def backfill_range(rows: DataFrame, ticker: str | None, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """Trades of the UTC days `start..end`, both included, each trade once.

    `rows` are trades from pages of any number of days; pages of neighbouring days may overlap.
    """
    trades = to_trades(filter_trades(rows, ticker))
    days = trades.filter(F.col("date").between(F.lit(parse_day(start)), F.lit(parse_day(end))))
    return dedup_trades(days)


def land_by_day(pages: DataFrame, path: str) -> None:
    """Append pages `day, page_no, trades, cursor` to one folder per requested day."""
    pages.hint("rebalance", "day").write.mode("append").partitionBy("day").json(path)


def backfill_missing(spark: SparkSession, path: str, missing: DataFrame) -> DataFrame:
    """Trades of the missing `ticker, date` pairs out of pages landed by day, each trade once.

    The days to read come from the pairs at run time and prune the folders, so no other day is opened. There
    is one row for each of them, at most as many as the calendar has days; the pairs themselves join as they are.
    """
    schema = StructType([*TRADE_PAGE.fields, StructField("day", DateType())])
    pages = spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT).json(path)
    days = missing.filter(F.col("date") >= F.lit("0001-01-01").cast("date")).select(F.col("date").alias("day")).distinct()
    wanted = pages.join(F.broadcast(days), "day")
    trades = to_trades(explode_trades(wanted.filter(F.col("page_no").isNotNull())))
    return dedup_trades(trades.join(missing.select("ticker", "date"), ["ticker", "date"], "left_semi").select(*trades.columns))


# --- markets -------------------------------------------------------------------------------------


def read_markets(
    spark: SparkSession,
    path: str | list[str],
    series_ticker: str | None = None,
    status: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Markets of all pages with the number of their page, by file and line, and their position there."""
    pages = number_lines(_read(spark, path, MARKET_PAGE), "page_no")
    listed = pages.select("page_no", F.posexplode("markets").alias("pos", "m")).select("page_no", "pos", "m.*")
    return filter_markets(listed, series_ticker, status, limit)


def filter_markets(
    markets: DataFrame, series_ticker: str | None = None, status: str | None = None, limit: int | None = None
) -> DataFrame:
    if series_ticker is not None:
        markets = markets.filter(F.col("series_ticker") == F.upper(F.lit(series_ticker)))
    if status is not None:
        markets = markets.filter(F.col("status") == status)
    return markets if limit is None else markets.orderBy("page_no", "pos").limit(limit)


def summarize_markets(markets: DataFrame, series_ticker: str | None = None, status: str = "open") -> DataFrame:
    """Five columns per market, with empty texts for missing ones."""
    return filter_markets(markets, series_ticker, status).select(
        default_text(F.col("ticker")).alias("ticker"),
        default_text(F.col("title")).alias("title"),
        default_text(F.col("event_ticker")).alias("event_ticker"),
        F.col("yes_price").cast("int").alias("yes_price"),
        F.col("volume").cast("bigint").alias("volume"),
    )


def display_markets(summaries: DataFrame) -> DataFrame:
    """The summary as text columns: a price of 0 or none shows as `-`, no volume as 0."""
    price = F.when(F.coalesce("yes_price", F.lit(0)) == 0, F.lit("-")).otherwise(
        F.col("yes_price").cast("string")
    )
    return summaries.select(
        "ticker",
        "title",
        price.alias("yes"),
        F.coalesce("volume", F.lit(0).cast("bigint")).alias("volume"),
        F.format_string(
            "%-15s %-50s Yes:%5s¢ Volume:%d", "ticker", "title", price, F.coalesce("volume", F.lit(0).cast("bigint"))
        ).alias("line"),
    )


def first_market(markets: DataFrame) -> DataFrame:
    return markets.orderBy("page_no", "pos").limit(1)


# --- order books ---------------------------------------------------------------------------------


def read_books(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Order books as given: ladders of `[price, size]` pairs per side."""
    return _read(spark, path, BOOK_PAGE).filter(F.col("ticker").isNotNull()).select("ticker", "orderbook")


def snapshot_levels(books: DataFrame, top: int = 5) -> DataFrame:
    """The first `top` entries of each ladder in the order given, those without price or size left out."""
    keys = [name for name in books.columns if name != "orderbook"]

    def side(name: str) -> DataFrame:
        ladder = F.slice(F.col("orderbook")[name], 1, top)
        return books.select(*keys, F.lit(name).alias("side"), F.posexplode(ladder).alias("pos", "entry"))

    return (
        side("yes")
        .unionByName(side("no"))
        .select(*keys, "side", "pos", F.get("entry", 0).alias("price"), F.get("entry", 1).cast("bigint").alias("size"))
        .dropna(subset=["price", "size"])
    )


# --- series and events ---------------------------------------------------------------------------


def _read_opaque(spark: SparkSession, path: str, name: str) -> DataFrame:
    text = spark.read.text(path).filter(not_blank())
    body = F.get_json_object("value", f"$.{name}")
    ticker = F.upper(F.coalesce(F.get_json_object("value", f"$.{name}.ticker"), F.get_json_object("value", "$.ticker")))
    return text.select(
        ticker.alias("ticker"),
        F.coalesce(F.get_json_object("value", f"$.{name}.title"), ticker).alias("title"),
        body.alias(name),
    )


def read_series(spark: SparkSession, path: str) -> DataFrame:
    """Series with their title (the ticker where there is none) and the rest as JSON text."""
    return _read_opaque(spark, path, "series")


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return _read_opaque(spark, path, "event")


def read_opaque_variants(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Opaque objects with their body as a VARIANT, each line parsed once; lines that are no JSON are left out."""
    lines = spark.read.text(path).filter(not_blank())
    parsed = lines.select(F.try_parse_json("value").alias("line")).filter(F.col("line").isNotNull())
    body = F.try_variant_get("line", f"$.{name}", "variant")
    ticker = F.upper(F.coalesce(F.try_variant_get("line", f"$.{name}.ticker", "string"), F.try_variant_get("line", "$.ticker", "string")))
    return parsed.select(ticker.alias("ticker"), body.alias(name)).filter(F.col(name).isNotNull())


def variant_fields(rows: DataFrame, name: str, **fields: str) -> DataFrame:
    """Fields of the objects by path and type, `title="$.title string"`; null where missing or of another type."""
    picked = [F.try_variant_get(name, *spec.rsplit(" ", 1)).alias(into) for into, spec in fields.items()]
    return rows.select("ticker", *picked)


def field_drift(rows: DataFrame, name: str) -> DataFrame:
    """Every top-level field of the objects, the type it has and in how many: a second type, or a field that some
    objects lack, shows here. One row per field and type, combined before the shuffle."""
    fields = rows.lateralJoin(rows.sparkSession.tvf.variant_explode(F.col(name).outer()))
    kind = F.schema_of_variant("value").alias("type")
    return fields.groupBy(F.col("key").alias("field"), kind).agg(F.count(F.lit(1)).alias("objects"))


def clipped(rows: DataFrame, column: str, length: int = 800) -> DataFrame:
    """JSON text cut to `length` characters for display."""
    value = F.col(column)
    cut = F.substring(value, 1, length) if rows.schema[column].dataType.typeName() == "string" else clip_json(value, length)
    return rows.withColumn(column, cut)
