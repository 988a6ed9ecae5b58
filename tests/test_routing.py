from pyspark.sql import functions as F

from tidebook.operators import routing, tables
from tidebook.schemas import MESSAGE
from tidebook.sources import feed as feeds


def feed_of(spark, *messages):
    """Messages as a feed; the channel is the type."""
    rows = [
        (m.get("channel", m.get("type")), i, *[m.get(f.name) for f in MESSAGE]) for i, m in enumerate(messages)
    ]
    schema = "channel STRING, arrival BIGINT, " + ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in MESSAGE
    )
    return spark.createDataFrame(rows, schema)


DELTA = dict(type="orderbook_delta", ticker="TEST", side="yes", price=60.0, delta_size=50, sequence=1, timestamp=1)
TRADE = dict(type="trade", ticker="TEST", yes_price=60.0, count=10, created_time="2025-11-16T00:00:00Z")
TICKER = dict(type="ticker", ticker="TEST", last_price=61.0, best_bid=60.0, best_ask=40.0)


def test_messages_go_to_their_branch(spark):
    feed = feed_of(spark, DELTA, TRADE, TICKER, dict(type="heartbeat"), dict(ticker="X"))
    branches = routing.route(feed)
    assert {kind: rows.count() for kind, rows in branches.items()} == {
        "orderbook_delta": 1,
        "trade": 1,
        "ticker": 1,
    }
    counted = {r.type: (r.messages, r.supported) for r in routing.type_counts(feed).collect()}
    assert counted["heartbeat"] == (1, False) and counted[""] == (1, False) and counted["trade"] == (1, True)
    forwarded = {r.type: r for r in routing.pass_through(feed).collect()}
    assert forwarded["ticker"].last_price == 61.0 and forwarded["trade"]["count"] == 10


def test_incomplete_deltas_are_set_aside(spark):
    feed = feed_of(spark, DELTA, {**DELTA, "price": None, "side": None}, {**DELTA, "ticker": None})
    assert routing.valid_deltas(feed).count() == 1
    bad = {r.arrival: list(r.missing) for r in routing.quarantined_deltas(feed).collect()}
    assert bad == {1: ["side", "price"], 2: ["ticker"]}


def test_subscriptions_merge_and_filter(spark):
    one = spark.createDataFrame([("trade", "test"), ("trade", "abc")], "channel STRING, ticker STRING")
    two = spark.createDataFrame([("trade", "TEST"), ("ticker", "x")], "channel STRING, ticker STRING")
    merged = routing.merge_subscriptions(one, two)
    lists = {r.channel: list(r.tickers) for r in routing.subscription_message(merged).collect()}
    assert lists == {"trade": ["ABC", "TEST"], "ticker": ["X"]}
    taken = routing.subscribe(feed_of(spark, DELTA, TRADE, TICKER), one).collect()
    assert [r.type for r in taken] == ["trade"]


def test_trade_row(spark):
    message = dict(type="trade", ticker="TEST", taker_side="yes", price=55.0, count=10, trade_id="abc", timestamp=1234567890000)
    row = tables.to_trades(feed_of(spark, message)).withColumn("ns", F.unix_micros("ts") * 1000).first()
    assert (row.ticker, row.taker_side, row.price, row["count"], row.trade_id) == ("TEST", "yes", 55.0, 10, "abc")
    assert row.ns == 1234567890000 * 1_000_000
    assert str(row.date) == "2009-02-13"


def test_trade_time_and_side_defaults(spark):
    feed = feed_of(spark, TRADE, {**TRADE, "created_time": None}, {**TRADE, "timestamp": 0}, {**TRADE, "created_time": "soon"})
    rows = tables.to_trades(feed, F.lit(77).cast("bigint")).orderBy("arrival").collect()
    assert [r.ts_ms for r in rows] == [1763251200000, 77, 0, 77]
    assert {r.taker_side for r in rows} == {"yes"}


def test_each_channel_has_its_table(spark):
    quote = dict(channel="bbo", type="bbo", ticker="T", bid_price=1.0, timestamp=86_400_000)
    shaped = tables.shape_tables(feed_of(spark, DELTA, TRADE, TICKER, quote, dict(type="other")))
    assert {name: rows.count() for name, rows in shaped.items()} == {
        "trades": 1,
        "orderbook_deltas": 1,
        "tickers": 1,
        "bbo": 1,
    }
    assert str(shaped["bbo"].first().date) == "1970-01-02"


def test_feed_lines(spark, tmp_path):
    path = tmp_path / "feed.jsonl"
    path.write_text(
        '{"channel": "trade", "message": {"ticker": "A", "timestamp": 5}}\n\n'
        "{bad\n"
        '{"channel": "orderbook_delta", "message": {"ticker": "B"}}\n'
    )
    envelopes = feeds.read_feed_lines(spark, str(path))
    rows = feeds.messages(envelopes).orderBy("arrival").collect()
    assert [(r.channel, r.ticker) for r in rows] == [("trade", "A"), ("orderbook_delta", "B")]
    assert [r.line for r in feeds.quarantined(spark, str(path)).collect()] == ["{bad"]
    try:
        feeds.messages(feeds.read_feed(spark, str(path), strict=True)).count()
        raise AssertionError("strict read must fail")
    except Exception as error:
        assert "strict read" not in str(error)


def test_line_numbers_follow_files_and_splits(spark, tmp_path):
    for name, start in (("b", 300), ("a", 0)):
        lines = [f'{{"channel": "trade", "message": {{"ticker": "T", "timestamp": {start + i}}}}}' for i in range(300)]
        (tmp_path / f"{name}.jsonl").write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = feeds.read_feed_lines(spark, str(tmp_path)).select("arrival", "message.timestamp").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((r.arrival, r.timestamp) for r in rows) == [(i, i) for i in range(600)]


def test_preview(spark, tmp_path):
    path = tmp_path / "dump.json"
    path.write_text("\n".join('{"n": %d}' % i for i in range(50)))
    assert feeds.preview(spark, str(path), 3).count() == 3
    path.write_text("[" + ",".join('{"n": %d}' % i for i in range(5000)) + "]")
    assert [r.value for r in feeds.preview(spark, str(path), 2, "},").collect()] == ['[{"n": 0', '{"n": 1']


def test_kafka_rows_that_cannot_be_read_are_kept_apart(spark):
    lines = ['{"channel": "trade", "message": {"ticker": "A"}}', "{bad", '{"channel": "x"}', '{"channel": "trade", "message": {"ticker": "B", "count": "many"}}', None]
    records = spark.createDataFrame([(line, i) for i, line in enumerate(lines)], "value STRING, offset BIGINT")
    assert [r.offset for r in feeds.kafka_quarantined(records).orderBy("offset").collect()] == [1, 2, 3, 4]
    assert [(r.arrival, r.ticker) for r in feeds.kafka_feed(records).orderBy("arrival").collect()] == [(0, "A"), (3, "B")]


def test_every_message_is_routed_or_put_aside(spark):
    rows = [("trade", "A", None, None, None), ("orderbook_delta", "A", "yes", 1.0, None), ("odd", "A", None, None, None), (None, "A", None, None, None)]
    feed = spark.createDataFrame(rows, "type STRING, ticker STRING, side STRING, price DOUBLE, delta_size BIGINT")
    assert sorted(r.reason for r in routing.quarantined_messages(feed).collect()) == ["type missing", "type odd", "without delta_size"]
