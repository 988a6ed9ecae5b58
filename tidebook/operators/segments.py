"""Cutting long per-ticker histories into segments of bounded size.

Books, gaps and numbering all need the rows of a ticker in arrival order. One ticker may hold a third
of a feed, so no operator here orders a whole ticker in one task. Rows are cut by their arrival
number, each segment is worked on by itself, and what a segment needs from the earlier ones is
computed from one summary row per segment and key.

`arrival` is unique, so a cut of `width` arrival numbers holds at most `width` rows whatever the skew;
`plan_cut` says what holds for numbers that are not dense.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tidebook.functions.scalars import floor_div

SEGMENT_ROWS = 1 << 18
# Slices of the arrival numbers in which their spacing is measured.
SLICES = 200
WIDEST = 1 << 61


@dataclass(frozen=True)
class Cut:
    """How a feed is cut: segments of `width` arrival numbers; `whole` if it all fits into one.

    `low` and `high` are the first and last arrival number found.
    """

    width: int
    whole: bool = False
    low: int = 0
    high: int = 0


def plan_cut(df: DataFrame, rows: int = SEGMENT_ROWS) -> Cut:
    """`plan_cut_with` without anything else."""
    return plan_cut_with(df, rows)[0]


def plan_cut_with(df: DataFrame, rows: int = SEGMENT_ROWS, *more: Column) -> tuple[Cut, Row]:
    """Segments of about `rows` rows. Reads one column and brings back one row.

    A dense counter gives a width of `rows`, which is then a strict bound. A sparse one is widened by
    the spacing in its densest slice, so that a segment exceeds `rows` by two slices at most, wherever the
    numbers lie. A feed without arrival numbers has no order and is refused. `more` are aggregates to
    find in the same pass.
    """
    marks = F.array(*[F.lit(i / SLICES) for i in range(1, SLICES)])
    found = df.agg(
        F.min("arrival").alias("low"),
        F.max("arrival").alias("high"),
        F.count("arrival").alias("n"),
        F.count(F.lit(1)).alias("all"),
        F.percentile_approx("arrival", marks, 10 * SLICES).alias("cuts"),
        *more,
    ).first()
    if found.n < found["all"]:
        raise ValueError(f"{found['all'] - found.n} rows have no arrival number, on which their order depends")
    if not found.n:
        return Cut(rows, whole=True), found
    edges = [found.low, *found.cuts, found.high + 1]
    spacing = min(max(1, b - a) * SLICES // found.n for a, b in zip(edges, edges[1:], strict=False))
    width = min(WIDEST, rows * max(1, spacing))
    return Cut(width, found.low // width == found.high // width, found.low, found.high), found


def with_segment(df: DataFrame, width: int) -> DataFrame:
    return df.withColumn("seg", floor_div(F.col("arrival"), width))


def earlier_segments(*key: str) -> Window:
    """Window over the summary rows of a key that lie before the current segment."""
    return Window.partitionBy(*key).orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)


def join_spread(df: DataFrame, table: DataFrame, on: list[str], how: str) -> DataFrame:
    """Join feed rows to a table that has one row per key.

    Adaptive execution hands a small table to every task and splits the rows of a busy key otherwise;
    neither needs the rows to be counted first.
    """
    return df.join(table, on, how)


def ticker_multiples(df: DataFrame, width: int, rows: int) -> DataFrame:
    """For tickers that do not fit one segment: how many cuts of `width` to take together.

    A ticker whose busiest cut has `peak` rows may join `rows // peak` cuts and still have at most
    `rows` rows per segment. This keeps the number of segments, and with it the opening books that
    must be repeated for each, in proportion to a ticker's own rows.
    """
    peaks = (
        df.groupBy("ticker", floor_div(F.col("arrival"), width).alias("cut"))
        .agg(F.count("*").alias("n"))
        .groupBy("ticker")
        .agg(F.max("n").alias("peak"), F.min("cut").alias("first_cut"), F.max("cut").alias("last_cut"))
        .withColumn(
            "multiple",
            F.greatest(F.lit(1).cast("bigint"), floor_div(F.lit(rows).cast("bigint"), F.col("peak"))),
        )
    )
    whole = floor_div(F.col("first_cut"), F.col("multiple")) == floor_div(F.col("last_cut"), F.col("multiple"))
    return peaks.filter(~whole).select("ticker", "multiple")


def with_ticker_segment(df: DataFrame, width: int, multiples: DataFrame) -> DataFrame:
    """Segment numbers cut per ticker; tickers without a row in `multiples` form one segment."""
    cut = floor_div(F.col("arrival"), width)
    seg: Column = F.when(F.col("multiple").isNotNull(), floor_div(cut, F.col("multiple"))).otherwise(
        F.lit(0).cast("bigint")
    )
    return join_spread(df, multiples, ["ticker"], "left").withColumn("seg", seg).drop("multiple")


def number_rows(df: DataFrame, key: str, into: str, rows: int = SEGMENT_ROWS) -> DataFrame:
    """Number the rows of each key from 1 in arrival order, like `row_number`, segment by segment."""
    plan = plan_cut(df, rows)
    if plan.whole:
        order = Window.partitionBy(key).orderBy("arrival")
        return df.withColumn(into, F.row_number().over(order).cast("bigint"))
    cut = with_segment(df, plan.width)
    counts = cut.groupBy(key, "seg").agg(F.count("*").alias("n"))
    before = counts.select(
        key, "seg", F.coalesce(F.sum("n").over(earlier_segments(key)), F.lit(0)).alias("before")
    )
    within = F.row_number().over(Window.partitionBy(key, "seg").orderBy("arrival"))
    return (
        cut.withColumn("rn", within)
        .join(before, [key, "seg"], "left")
        .withColumn(into, (F.col("rn") + F.col("before")).cast("bigint"))
        .drop("rn", "before", "seg")
    )
