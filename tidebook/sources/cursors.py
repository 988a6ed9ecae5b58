"""Pages put in order by their cursors, whatever files they landed in.

A landed page names the cursor it was asked for (`own`, none for the first page of a pull) and the one that
leads on (`cursor`, none after the last). Its place is its distance from the first page, found for all pages
at once by pointer doubling: every page points to the one before, and in each round to where that one points,
so a pull of n pages takes log2(n) rounds. Only cursors take part; the trades join when the places are known.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.schemas import CORRUPT, LANDED_PAGE
from tidebook.session import written
from tidebook.sources.pages import explode_trades

PAGE = ("pull", "own")


def read_cursor_pages(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Landed pages: pull, own, cursor, trades; texts in place of missing cursors, each page of a pull once."""
    pages = spark.read.schema(LANDED_PAGE).option("columnNameOfCorruptRecord", CORRUPT).json(path)

    def given(name: str) -> Column:
        return F.coalesce(name, F.lit("")).alias(name)

    known = pages.filter(F.col(CORRUPT).isNull()).select(given("pull"), given("own"), given("cursor"), "trades")
    return known.groupBy(*PAGE).agg(F.max_by(F.struct("cursor", "trades"), F.coalesce(F.size("trades"), F.lit(0))).alias("page")).select(*PAGE, "page.*")


def page_places(pages: DataFrame) -> DataFrame:
    """The place of every page in its pull: pull, own, page_no, origin, looped.

    `origin` is the first page that can be reached going back: the empty cursor for a whole pull, else a page
    whose predecessor never landed, from which `page_no` counts. Pages that lead in a circle are `looped`.
    """
    keys = pages.select(*PAGE, "cursor")
    before = keys.filter("cursor <> ''").groupBy("pull", F.col("cursor").alias("own")).agg(F.min(F.struct("own")).alias("from"))
    back = keys.select(*PAGE).join(before, list(PAGE), "left")
    at = F.coalesce("from.own", "own").alias("at")
    links = written(back.select(*PAGE, at, F.col("from").isNotNull().cast("long").alias("steps")), "page-links")
    count, rounds = links.count(), 0
    while True:
        further = links.select("pull", F.col("own").alias("at"), F.col("at").alias("onward"), F.col("steps").alias("more"))
        moved = links.join(further, ["pull", "at"]).select("pull", "own", F.col("onward").alias("at"), (F.col("steps") + F.col("more")).alias("steps"), (F.col("more") > 0).alias("moved"))
        moved = written(moved, "page-links")
        rounds += 1
        links = moved.drop("moved")
        if 2 ** (rounds - 1) > count or moved.filter("moved").isEmpty():
            # A page that still moves after more steps than there are pages goes round in a circle.
            return moved.select(*PAGE, F.col("steps").alias("page_no"), F.col("at").alias("origin"), F.col("moved").alias("looped"))


def trades_by_cursor(pages: DataFrame) -> DataFrame:
    """Trades of whole pulls with page number and position; pages of broken ones are left to `broken_chains`."""
    whole = page_places(pages).filter("origin = '' AND NOT looped").select(*PAGE, "page_no")
    return explode_trades(pages.join(whole, list(PAGE)), "pull")


def broken_chains(pages: DataFrame) -> DataFrame:
    """What is missing of each pull: a cursor that leads to no landed page, or a stretch of pages none leads to.

    pull, missing (the cursor to ask for again), after (the page that leads there, null where none does) and
    pages: how many landed pages hang on it.
    """
    places = page_places(pages)
    asked = pages.filter("cursor <> ''").select("pull", F.col("cursor").alias("own"), F.col("own").alias("after"))
    lost = asked.join(pages.select(*PAGE), list(PAGE), "left_anti").select("pull", F.col("own").alias("missing"), "after", F.lit(0).cast("long").alias("pages"))
    loose = places.filter("origin <> '' OR looped").groupBy("pull", F.when(F.col("looped"), "").otherwise(F.col("origin")).alias("missing"))
    return lost.unionByName(loose.agg(F.lit(None).cast("string").alias("after"), F.count(F.lit(1)).alias("pages")))
