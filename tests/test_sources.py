from pyspark.sql import functions as F

from tidebook.operators import book
from tidebook.sources import pages, snapshots

MARKETS = (
    '{"markets": [{"ticker": "A", "title": "One", "series_ticker": "S", "status": "open", "yes_price": 0},'
    '{"ticker": "B", "series_ticker": "S", "status": "open", "yes_price": 12, "volume": 7},'
    '{"ticker": "C", "series_ticker": "S", "status": "closed"}]}\n{"markets": {}}\n'
)


def test_market_summaries(spark, tmp_path):
    (tmp_path / "m.json").write_text(MARKETS)
    markets = pages.read_markets(spark, str(tmp_path))
    rows = {r.ticker: r for r in pages.summarize_markets(markets, "s").collect()}
    assert sorted(rows) == ["A", "B"]
    assert (rows["B"].title, rows["B"].event_ticker, rows["B"].yes_price, rows["A"].volume) == ("", "", 12, None)
    shown = {r.ticker: r for r in pages.display_markets(pages.summarize_markets(markets)).collect()}
    assert (shown["A"].yes, shown["A"].volume, shown["B"].yes, shown["B"].volume) == ("-", 0, "12", 7)
    assert shown["B"].line.startswith("B" + " " * 15) and shown["B"].line.endswith("Yes:   12¢ Volume:7")
    assert pages.first_market(markets).first().ticker == "A"
    assert pages.read_markets(spark, str(tmp_path), limit=2).count() == 2
    assert [r.line for r in pages.malformed_market_pages(spark, str(tmp_path)).collect()] == ['{"markets": {}}']


def test_snapshot_levels_keep_array_order(spark, tmp_path):
    (tmp_path / "b.json").write_text(
        '{"ticker": "A", "orderbook": {"yes": [[1, 10], [null, 5], [3, 30], [2, 1], [9, 9], [8, 8]], "no": null}}\n'
    )
    rows = pages.snapshot_levels(pages.read_books(spark, str(tmp_path)))
    got = [(r.side, r.pos, r.price, r.size) for r in rows.orderBy("pos").collect()]
    assert got == [("yes", 0, 1.0, 10), ("yes", 2, 3.0, 30), ("yes", 3, 2.0, 1), ("yes", 4, 9.0, 9)]


def test_series(spark, tmp_path):
    (tmp_path / "s.json").write_text('{"series": {"ticker": "mk", "title": "Rain", "x": [1]}}\n\n{"ticker": "my", "series": {}}\n')
    rows = {r.ticker: r for r in pages.read_series(spark, str(tmp_path)).collect()}
    assert rows["MK"].title == "Rain" and '"x":[1]' in rows["MK"].series and rows["MY"].title == "MY"
    assert pages.clipped(pages.read_series(spark, str(tmp_path)), "series", 5).filter(F.length("series") > 5).count() == 0


def test_snapshot_log_round_trip(spark, tmp_path):
    rows = [("T", "yes", 5.0, 10), ("T", "yes", 6.0, 1), ("T", "no", 9.0, 2), ("1", "no", 3.0, 4)]
    levels = spark.createDataFrame(rows, "ticker STRING, side STRING, price DOUBLE, size BIGINT")
    snapshots.write_snapshot_log(snapshots.snapshot_of(levels, F.lit(100)), str(tmp_path / "log"))
    read = snapshots.read_snapshot_log(spark, str(tmp_path / "log"))
    again = sorted(tuple(r) for r in book.snapshot_book(read).select("ticker", "side", "price", "size").collect())
    assert again == sorted(rows)


def test_rebuild_from_latest_snapshot(spark):
    logged = spark.createDataFrame(
        [(1, "T", ([[5.0, 1.0]], None)), (2, "T", ([[5.0, 10.0], [4.0, 3.0]], [[9.0, 2.0]]))],
        "timestamp BIGINT, ticker STRING, orderbook STRUCT<yes ARRAY<ARRAY<DOUBLE>>, no ARRAY<ARRAY<DOUBLE>>>",
    )
    schema = "arrival BIGINT, ticker STRING, side STRING, price DOUBLE, delta_size BIGINT, sequence BIGINT, ts_ms BIGINT"
    deltas = spark.createDataFrame(
        [
            (0, "T", "yes", 5.0, 99, 1, 1500),
            (1, "T", "yes", 5.0, -4, 2, 2000),
            (2, "T", "yes", 5.0, -4, 3, 2001),
            (3, "T", "yes", 4.0, -5, 4, 2002),
            (4, "T", "yes", 4.0, 2, 5, 2003),
            (5, "U", "no", 7.0, 1, 1, 10),
        ],
        schema,
    )
    got = sorted(tuple(r) for r in book.rebuild_book(logged, deltas, rows=2).collect())
    assert got == [("T", "no", 9.0, 2), ("T", "yes", 4.0, 2), ("T", "yes", 5.0, 6), ("U", "no", 7.0, 1)]
