import datetime as dt
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidebook.operators import tables, tiers
from tidebook.sources import pages

DAY = 86_400_000
START = 1_731_628_800_000  # 2024-11-15


@pytest.fixture
def here(spark, tmp_path):
    made = tiers.Tiers(f"db_{uuid.uuid4().hex}", str(tmp_path / "archive"))
    tiers.create_tiers(spark, made, str(tmp_path / "tables"))
    return made


def trade_rows(spark, days=3, per_day=10):
    rows = [("T", f"{d}-{i}", 5.0, 1, START + d * DAY + i, d * 100 + i) for d in range(days) for i in range(per_day)]
    schema = "ticker STRING, trade_id STRING, price DOUBLE, count BIGINT, timestamp BIGINT, arrival BIGINT"
    return tables.to_trades(spark.createDataFrame(rows, schema))


def days_of(df):
    return {str(r.date): r.n for r in df.groupBy("date").agg(F.count("*").alias("n")).collect()}


def test_migration_can_be_repeated(spark, here):
    tiers.write_hot(trade_rows(spark), here, "trades", 1)
    for _ in range(2):
        tiers.migrate_day(spark, here, "trades", "2024-11-15")
    assert days_of(spark.table(here.warm("trades"))) == {"2024-11-15": 10}
    tiers.migrate_days(spark, here, "trades", "2024-11-15", "2024-11-17")
    assert sum(days_of(spark.table(here.warm("trades"))).values()) == 30


def test_a_batch_written_again_replaces_itself(spark, here):
    tiers.write_hot(trade_rows(spark), here, "trades", 1)
    tiers.write_hot(trade_rows(spark), here, "trades", 2)
    tiers.write_hot(trade_rows(spark), here, "trades", 2)
    assert spark.table(here.hot("trades")).count() == 60


def test_batches_add_up_whatever_the_overwrite_mode(spark, here):
    for mode in ("static", "dynamic"):
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
        try:
            tiers.write_hot(trade_rows(spark), here, "trades", f"{mode} a")
            tiers.write_hot(trade_rows(spark, 2, 7), here, "trades", f"{mode} b")
            tiers.write_hot(trade_rows(spark, 1, 4), here, "trades", f"{mode} b")
            tiers.end_of_day(spark, here, "2024-11-15")
        finally:
            spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert days_of(spark.table(here.warm("trades"))) == {"2024-11-15": 28}
    assert days_of(tiers.read_archive(spark, here, "trades")) == {"2024-11-15": 28}
    assert days_of(spark.table(here.hot("trades"))) == {"2024-11-16": 20, "2024-11-17": 20}


def test_a_late_batch_leaves_the_files_of_the_day(spark, here):
    tiers.write_hot(trade_rows(spark, 1), here, "trades", "first")
    tiers.end_of_day(spark, here, "2024-11-15")
    files = {f for f in spark.table(here.warm("trades")).inputFiles() + tiers.read_archive(spark, here, "trades").inputFiles()}
    tiers.write_hot(late(spark, 1, 3), here, "trades", "second")
    tiers.end_of_day(spark, here, "2024-11-15")
    assert files <= {*spark.table(here.warm("trades")).inputFiles(), *tiers.read_archive(spark, here, "trades").inputFiles()}


def test_export_is_snappy_and_reads_back(spark, here):
    tiers.write_hot(trade_rows(spark), here, "trades", 1)
    tiers.migrate_day(spark, here, "trades", "2024-11-16")
    folder = tiers.export_day(spark, here, "trades", "2024-11-16")
    assert folder.endswith("trades/date=2024-11-16")
    assert list(Path(folder).rglob("*.snappy.parquet"))
    assert days_of(tiers.read_archive(spark, here, "trades")) == {"2024-11-16": 10}


def test_retention_boundary(spark, here):
    tiers.write_hot(trade_rows(spark), here, "trades", 1)
    tiers.migrate_days(spark, here, "trades", "2024-11-15", "2024-11-17")
    as_of = dt.date(2024, 11, 23)
    expired = tiers.expired_partitions(spark, here.warm("trades"), as_of, 7)
    assert [str(r.date) for r in expired.collect()] == ["2024-11-15"]
    assert tiers.apply_retention(spark, here, as_of, 7) == {"trades": 1, "orderbook_deltas": 0}
    assert sorted(days_of(spark.table(here.warm("trades")))) == ["2024-11-16", "2024-11-17"]


def test_end_of_day(spark, here):
    tiers.write_hot(trade_rows(spark), here, "trades", 1)
    tiers.write_hot(trade_rows(spark).withColumn("arrival", F.col("arrival") + 1000), here, "trades", 2)
    assert tiers.end_of_day(spark, here, "2024-11-16") == {"trades": 20, "orderbook_deltas": 0}
    assert sorted(days_of(spark.table(here.hot("trades")))) == ["2024-11-15", "2024-11-17"]
    log = {r.table: (r.rows, r.status) for r in tiers.migration_log(spark, here).collect()}
    assert log["trades"] == (20, "done")
    assert tiers.end_of_day(spark, here, "2024-11-16")["trades"] == 20  # again, with nothing left in the hot tier
    assert days_of(tiers.read_archive(spark, here, "trades")) == {"2024-11-16": 20}


def late(spark, start, n, batch_time=0):
    return trade_rows(spark, 1, n).withColumn("trade_id", F.concat(F.lit(f"late{start}-"), "trade_id"))


def test_late_rows_join_a_finished_day(spark, here):
    tiers.write_hot(trade_rows(spark, 1, 100), here, "trades", "2024-11-15T10:00")
    tiers.write_hot(trade_rows(spark, 1, 7).drop("trade_id").withColumn("trade_id", F.lit("odd")), here, "trades", "a/b = 'c' +\\ é")
    assert tiers.end_of_day(spark, here, "2024-11-15")["trades"] == 107
    assert spark.table(here.hot("trades")).count() == 0
    tiers.write_hot(late(spark, 1, 5), here, "trades", "late 1")
    assert tiers.end_of_day(spark, here, "2024-11-15")["trades"] == 112
    assert days_of(tiers.read_archive(spark, here, "trades")) == {"2024-11-15": 112}
    ids = {r.trade_id for r in spark.table(here.warm("trades")).select("trade_id").collect()}
    assert ids == {r.trade_id for r in tiers.read_archive(spark, here, "trades").select("trade_id").collect()} and len(ids) == 106
    tiers.write_hot(late(spark, 1, 3), here, "trades", "late 1")  # the batch comes again, with fewer rows
    assert tiers.end_of_day(spark, here, "2024-11-15")["trades"] == 110
    assert [r.status for r in tiers.migration_log(spark, here).filter("table = 'trades'").collect()] == ["done"] * 3


def test_the_archive_survives_retention(spark, here):
    tiers.write_hot(trade_rows(spark), here, "trades", 1)
    for day in ("2024-11-15", "2024-11-16"):
        tiers.end_of_day(spark, here, day)
    tiers.apply_retention(spark, here, "2024-11-30", 7)
    assert spark.table(here.warm("trades")).count() == 0
    assert tiers.end_of_day(spark, here, "2024-11-15")["trades"] == 0
    tiers.export_days(spark, here, "trades", "2024-11-15", "2024-11-16")
    assert days_of(tiers.read_archive(spark, here, "trades")) == {"2024-11-15": 10, "2024-11-16": 10}
    tiers.write_hot(late(spark, 1, 4), here, "trades", 2)
    tiers.end_of_day(spark, here, "2024-11-15")
    assert days_of(tiers.read_archive(spark, here, "trades")) == {"2024-11-15": 14, "2024-11-16": 10}


def test_a_batch_written_again_leaves_no_old_days(spark, here):
    tiers.write_hot(trade_rows(spark, 3), here, "trades", "x:1")
    tiers.write_hot(trade_rows(spark, 1), here, "trades", "x:1")
    assert days_of(spark.table(here.hot("trades"))) == {"2024-11-15": 10}


def test_day_filters_prune_partitions(spark, here):
    tiers.write_hot(trade_rows(spark), here, "trades", 1)
    tiers.migrate_days(spark, here, "trades", "2024-11-15", "2024-11-17")
    from tidebook.operators.trades import day_slice

    plan = day_slice(spark.table(here.warm("trades")), "2024-11-15").select("price")._jdf.queryExecution().toString()
    scan = [line for line in plan.splitlines() if "FileScan" in line][-1]
    assert "PartitionFilters: [isnotnull(date" in scan
    assert "GreaterThanOrEqual(ts" in scan.replace("PushedFilters", "")
    assert "trade_id" not in scan.split("ReadSchema")[1]


def test_pages_to_hot_table(spark, here, tmp_path):
    folder = tmp_path / "pages"
    folder.mkdir()
    (folder / "p.json").write_text(
        '{"page_no": 0, "trades": [{"ticker": "TEST", "trade_id": "1", "timestamp": 0}, '
        '{"ticker": "TEST", "trade_id": "2", "timestamp": 1}], "cursor": ""}\n{"page_no": 1, "cursor": ""}\n'
        '{"page_no": 2, "trades": 5}\n[]\n'
    )
    assert pages.load_trade_pages(spark, str(folder), here, "a") == 2
    assert pages.load_trade_pages(spark, str(folder), here, "a", ticker="test", min_ts=1) == 1
    bad = {r.line for r in pages.malformed_trade_pages(spark, str(folder)).collect()}
    assert '{"page_no": 2, "trades": 5}' in bad and not any("TEST" in line for line in bad)


def test_backfill_days_are_utc_and_unique(spark, tmp_path):
    lines = []
    for page in (0, 1):
        lines.append(
            '{"page_no": %d, "trades": [{"ticker": "T", "trade_id": "a", "created_time": "2024-11-15T23:59:59Z"},'
            '{"ticker": "T", "trade_id": "b", "created_time": "2024-11-16T00:00:00Z"},'
            '{"ticker": "U", "trade_id": "c", "created_time": "2024-11-16T00:00:00Z"}]}' % page
        )
    (tmp_path / "p.json").write_text("\n".join(lines))
    rows = pages.read_trade_pages(spark, str(tmp_path))
    taken = pages.backfill_range(rows, "t", "2024-11-16", "2024-11-16")
    assert [r.trade_id for r in taken.collect()] == ["b"]
    assert [r.trade_id for r in pages.first_trades(rows, 2).collect()] == ["a", "b"]
