"""Counters, gap rates and latency quantiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidebook.functions.scalars import floor_div
from tidebook.operators.trades import interval_ms


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each table, as `table, rows`."""
    counted = [
        rows.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, rows in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def feed_counts(feed: DataFrame) -> DataFrame:
    """Messages per channel, with those of no known channel under their own name."""
    return feed.groupBy("channel").agg(F.count("*").alias("messages"))


def counters(feed: DataFrame, changes: DataFrame, gaps: DataFrame) -> DataFrame:
    """The three totals the plant reports: trades processed, BBO updates, sequence gaps."""
    return table_counts(
        {
            "trades_processed": feed.filter(F.col("channel") == "trade"),
            "bbo_updates": changes,
            "sequence_gaps": gaps.filter("gap"),
        }
    ).select(F.col("table").alias("counter"), F.col("rows").alias("total"))


def gap_rate(gaps: DataFrame, interval: str = "5 minutes") -> DataFrame:
    """Gaps per interval, the rate per second, and whether the interval raises the alert."""
    width = interval_ms(interval)
    return (
        gaps.groupBy((floor_div(F.col("ts_ms"), width) * width).alias("window_ms"))
        .agg(F.count("*").alias("messages"), F.sum(F.col("gap").cast("bigint")).alias("gaps"))
        .withColumn("rate", F.col("gaps") / (width / 1000.0))
        .withColumn("alert", F.col("gaps") > 0)
    )


def sliding_gap_rate(gaps: DataFrame, interval: str = "5 minutes", every: str = "1 minute") -> DataFrame:
    """`gap_rate` over windows that start every `every`.

    Gaps are first summed per step and the few sums are then repeated for the windows they fall in, so
    the messages themselves are not multiplied.
    """
    width, step = interval_ms(interval), interval_ms(every)
    if width % step:
        raise ValueError("the window must be a multiple of the step")
    steps = gaps.groupBy((floor_div(F.col("ts_ms"), step) * step).alias("step_ms")).agg(
        F.count("*").alias("messages"), F.sum(F.col("gap").cast("bigint")).alias("gaps")
    )
    starts = F.sequence(F.col("step_ms") - F.lit(width - step), F.col("step_ms"), F.lit(step).cast("bigint"))
    return (
        steps.withColumn("window_ms", F.explode(starts))
        .groupBy("window_ms")
        .agg(F.sum("messages").alias("messages"), F.sum("gaps").alias("gaps"))
        .withColumn("alert", F.col("gaps") > 0)
    )


#: Ranks of a window's sketch are off by at most one part in so many.
SKETCH = 1000


def latency_quantile(
    messages: DataFrame, interval: str = "5 minutes", percent: int = 99, limit: float | None = None
) -> DataFrame:
    """Exact nearest-rank quantile of `latency` per interval, and whether it is above `limit`.

    A mergeable sketch of each window, combined before the shuffle, says between which two latencies the
    quantile lies. Only what lies between them is then counted value by value and ranked, a few of a
    thousand messages of a window; all others are counted as below or above. A sketch that does not
    enclose the quantile fails the job.
    """
    width = interval_ms(interval)
    window = (floor_div(F.col("ts_ms"), width) * width).alias("window_ms")
    measured = messages.filter(F.col("latency").isNotNull()).select(window, "latency")
    ends = [max(0.0, percent / 100 - 2 / SKETCH), min(1.0, percent / 100 + 2 / SKETCH)]
    sketched = measured.groupBy("window_ms").agg(
        F.percentile_approx("latency", F.array(*map(F.lit, ends)), SKETCH).alias("ends"), F.count(F.lit(1)).alias("messages")
    )
    near = sketched.select("window_ms", "messages", F.col("ends")[0].alias("low"), F.col("ends")[1].alias("high"))
    placed = measured.join(near, "window_ms").filter(F.col("latency") <= F.col("high"))
    value = F.when(F.col("latency") >= F.col("low"), F.col("latency")).alias("value")
    counted = placed.groupBy("window_ms", "messages", value).agg(F.count(F.lit(1)).alias("n"))
    # Those below the bucket have no value and come first.
    upto = Window.partitionBy("window_ms").orderBy(F.asc_nulls_first("value"))
    reached = F.sum("n").over(upto) * 100 >= F.col("messages") * percent
    found = counted.withColumn("reached", reached).groupBy("window_ms", "messages").agg(
        F.min(F.when(F.col("reached"), F.col("value"))).alias("latency"),
        F.max(F.col("reached") & F.col("value").isNull()).alias("below"),
    )
    missed = F.raise_error(F.lit("the sketch does not enclose the quantile"))
    sound = F.col("latency").isNotNull() & ~F.col("below")
    result = found.select("window_ms", "messages", F.when(sound, F.col("latency")).otherwise(missed.cast(found.schema["latency"].dataType)).alias("latency"))
    if limit is None:
        return result
    return result.withColumn("alert", F.col("latency") > F.lit(limit))


def latency_alerts(quantiles: DataFrame, interval: str = "5 minutes", hold: str = "5 minutes") -> DataFrame:
    """Stretches of windows in a row that are above the limit, and whether they last for `hold`.

    `quantiles` are those of `latency_quantile` with a limit. A window without messages ends a stretch. There is
    one row per window, so their order is that of a clock and not of the feed.
    """
    width = interval_ms(interval)
    alerts = quantiles.filter("alert").select("window_ms", "latency")
    order = F.row_number().over(Window.orderBy("window_ms"))
    islands = alerts.withColumn("island", F.col("window_ms") - order * F.lit(width).cast("bigint"))
    stretches = islands.groupBy("island").agg(
        F.min("window_ms").alias("start_ms"), (F.max("window_ms") + width).alias("end_ms"), F.count(F.lit(1)).alias("windows"), F.max("latency").alias("worst")
    )
    return stretches.drop("island").withColumn("fired", F.col("end_ms") - F.col("start_ms") >= interval_ms(hold))
