"""Pages in the order of their cursors, pages pruned by day, incremental bars, latencies, newest rows."""

import datetime as dt
import json
import random
import uuid

from pyspark.sql import functions as F

from tidebook.operators import monitoring, rollup, tables, tiers, trades
from tidebook.sources import cursors, pages


def land(spark, folder, rows):
    folder.mkdir()
    random.Random(1).shuffle(rows)
    for number in range(3):
        (folder / f"{number}.json").write_text("\n".join(json.dumps(row) for row in rows[number::3]))
    return cursors.read_cursor_pages(spark, str(folder))


def page(pull, number, last, name=lambda n: f"c{n * 37 % 101}"):
    trade = {"ticker": "T", "trade_id": f"{pull}{number}", "timestamp": number}
    row = {"pull": pull, "own": name(number) if number else None, "cursor": name(number + 1) if number < last else "", "trades": [trade]}
    return {key: value for key, value in row.items() if value is not None}


def test_places_of_shuffled_pages(spark, tmp_path):
    rows = [page("a", n, 40) for n in range(41)] + [page("b", n, 4) for n in range(5)] + [page("a", 7, 40)]
    landed = land(spark, tmp_path / "pages", rows)
    found = cursors.trades_by_cursor(landed).select("pull", "page_no", "trade_id").collect()
    assert sorted((r.pull, r.page_no, r.trade_id) for r in found) == sorted([("a", n, f"a{n}") for n in range(41)] + [("b", n, f"b{n}") for n in range(5)])
    assert cursors.broken_chains(landed).count() == 0


def test_broken_chains_are_reported(spark, tmp_path):
    rows = [page("a", n, 9) for n in range(10) if n not in (3, 7)] + [page("b", n, 2) for n in range(1, 3)]
    rows += [{"pull": "c", "own": "x", "cursor": "y"}, {"pull": "c", "own": "y", "cursor": "x", "trades": []}, {"pull": "d", "cursor": ""}]
    landed = land(spark, tmp_path / "pages", rows)
    name = [f"c{n * 37 % 101}" for n in range(11)]
    found = {tuple(r) for r in cursors.broken_chains(landed).select("pull", "missing", "after", "pages").collect()}
    assert found == {
        ("a", name[3], name[2], 0), ("a", name[7], name[6], 0), ("a", name[4], None, 3), ("a", name[8], None, 2),
        ("b", name[1], None, 2), ("c", "", None, 2),
    }
    assert {r.trade_id for r in cursors.trades_by_cursor(landed).collect()} == {"a0", "a1", "a2"}


def test_missing_days_prune_folders(spark, tmp_path):
    rows = [(d, t, f"{t}{d}", d * 86_400_000 + 5) for d in range(20) for t in "AB"]
    given = spark.createDataFrame(rows, "d INT, ticker STRING, trade_id STRING, timestamp BIGINT")
    trade = F.struct("ticker", "trade_id", "timestamp")
    paged = given.groupBy(F.date_from_unix_date("d").alias("day")).agg(F.collect_list(trade).alias("trades"), F.lit(0).cast("bigint").alias("page_no"))
    pages.land_by_day(paged, str(tmp_path / "days"))
    missing = spark.createDataFrame([("A", dt.date(1970, 1, 4)), ("B", dt.date(1970, 1, 8))], "ticker STRING, date DATE")
    found = pages.backfill_missing(spark, str(tmp_path / "days"), missing)
    assert sorted(r.trade_id for r in found.collect()) == ["A3", "B7"]
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString().lower()


def test_late_trades_touch_their_bars_only(spark, tmp_path):
    rng = random.Random(2)
    rows = [(f"T{rng.randrange(3)}", float(rng.randrange(9)), 1, rng.randrange(3 * 86_400_000), n) for n in range(600)]
    given = spark.createDataFrame(rows, "ticker STRING, price DOUBLE, count BIGINT, ts_ms BIGINT, arrival BIGINT")
    path = str(tmp_path / "bars")
    rollup.refresh(spark, path, given.filter("arrival < 500"), 0)
    untouched = {p: p.stat().st_mtime_ns for p in (tmp_path / "bars" / "1-hour" / "day=1970-01-01").glob("*.parquet")}
    rollup.refresh(spark, path, given.filter("arrival >= 500 AND ts_ms >= 86400000"), 1)
    assert untouched and all(p.exists() and p.stat().st_mtime_ns == t for p, t in untouched.items())
    rollup.refresh(spark, path, given.filter("arrival >= 500 AND ts_ms < 86400000"), 2)
    for interval in ("1 minute", "1 hour", "1 day"):
        got = sorted(tuple(r) for r in rollup.read_bars(spark, path, interval, given).collect())
        assert got == sorted(tuple(r) for r in trades.bars(given, interval).select("ticker", "bar_ms", "open", "high", "low", "close", "volume", "trades").collect())


def test_quantiles_of_large_windows_are_exact(spark):
    rng = random.Random(3)
    rows = [(w * 300_000 + rng.randrange(300_000), int(rng.lognormvariate(5, 2))) for w in range(4) for _ in range((20_000, 3, 999, 1)[w])]
    df = spark.createDataFrame(rows, "ts_ms BIGINT, latency BIGINT").repartition(6)
    for percent in (1, 50, 99, 100):
        got = {r.window_ms: (r.messages, r.latency) for r in monitoring.latency_quantile(df, percent=percent).collect()}
        for w in range(4):
            own = sorted(v for t, v in rows if t // 300_000 == w)
            assert got[w * 300_000] == (len(own), own[-(-len(own) * percent // 100) - 1])


def test_alerts_need_to_last(spark):
    minute = 60_000
    rows = [(w * minute, 1.0 + w, w not in (0, 6, 8)) for w in (0, 1, 2, 3, 4, 5, 6, 7, 8, 10)]
    quantiles = spark.createDataFrame(rows, "window_ms BIGINT, latency DOUBLE, alert BOOLEAN")
    found = monitoring.latency_alerts(quantiles, "1 minute").orderBy("start_ms").collect()
    assert [(r.start_ms // minute, r.end_ms // minute, r.windows, r.worst, r.fired) for r in found] == [(1, 6, 5, 6.0, True), (7, 8, 1, 8.0, False), (10, 11, 1, 11.0, False)]


def test_newest_rows_read_few_days(spark, tmp_path):
    here = tiers.Tiers(f"db_{uuid.uuid4().hex}", str(tmp_path / "archive"))
    tiers.create_tiers(spark, here, str(tmp_path / "tables"))
    rows = [(("RARE" if d == 3 else "T"), f"{d}-{i}", 5.0, 1, d * 86_400_000 + i, d * 100 + i) for d in range(30) for i in range(10)]
    schema = "ticker STRING, trade_id STRING, price DOUBLE, count BIGINT, timestamp BIGINT, arrival BIGINT"
    tiers.write_hot(tables.to_trades(spark.createDataFrame(rows, schema)), here, "trades", 1)
    name = here.hot("trades")
    assert tiers.newest_days(spark, name, "T", 8) == dt.date(1970, 1, 30)
    assert tiers.newest_days(spark, name, "T", 25) == dt.date(1970, 1, 28)
    found = tiers.latest_rows(spark, name, "t", 12)
    assert [r.trade_id for r in found.collect()] == [f"29-{i}" for i in range(9, -1, -1)] + ["28-9", "28-8"]
    assert len(found.inputFiles()) <= 3 < len(spark.table(name).inputFiles())
    assert [r.trade_id for r in tiers.latest_rows(spark, name, "rare", 2).collect()] == ["3-9", "3-8"]
    assert tiers.latest_rows(spark, name, "none", 2).count() == 0
