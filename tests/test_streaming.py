import uuid

import pytest
from pyspark.sql import functions as F

from model import random_deltas, replay
from tidebook.operators import tables, tiers
from tidebook.schemas import MESSAGE
from tidebook.sources import feed as feeds
from tidebook.streaming import plant, record, stateful, windows


def land(spark, folder, rows, files):
    """The deltas as landed feed files, one file per slice, oldest first."""
    import json
    import os

    folder.mkdir(parents=True, exist_ok=True)
    step = -(-len(rows) // files)
    for n in range(files):
        lines = [
            json.dumps(
                {
                    "channel": "orderbook_delta",
                    "arrival": arrival,
                    "message": dict(
                        type="orderbook_delta", ticker=ticker, side=side, price=price, delta_size=delta,
                        sequence=sequence, timestamp=ts_ms,
                    ),
                }
            )
            for arrival, ticker, side, price, delta, sequence, ts_ms in rows[n * step : (n + 1) * step]
        ]
        path = folder / f"{n:03d}.json"
        path.write_text("\n".join(lines))
        os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))
    return feeds.stream_feed(spark, str(folder), files_per_batch=1)


QUOTE = ("arrival", "ticker", "bid_price", "bid_size", "ask_price", "ask_size")


def test_plant_stream_equals_batch(spark, tmp_path):
    rows = random_deltas(900)
    stream = land(spark, tmp_path / "feed", rows, 3)
    out, state, check = (str(tmp_path / name) for name in ("out", "state", "check"))
    plant.plant_stream(stream, out, state, check).awaitTermination()
    events = plant.published(spark, out).cache()
    quotes = events.filter("channel = 'bbo'")
    assert quotes.select("batch").distinct().count() == 3
    assert sorted(tuple(r[n] for n in QUOTE) for r in quotes.collect()) == replay(rows)[3]
    assert events.filter("channel = 'orderbook_delta'").count() == 900
    last, gaps = {}, []
    for arrival, ticker, _, _, _, sequence, _ in rows:
        if sequence is not None:
            if ticker in last and sequence != last[ticker] + 1:
                gaps.append(arrival)
            last[ticker] = sequence
    assert sorted(r.arrival for r in events.filter("channel = 'gap'").collect()) == gaps
    events.unpersist()


def test_a_batch_run_again_leaves_the_same(spark, tmp_path):
    rows = random_deltas(600)
    fields = [f.name for f in MESSAGE]
    land(spark, tmp_path / "feed", rows, 1)
    feed = feeds.messages(feeds.read_feed(spark, str(tmp_path / "feed"))).select("channel", "arrival", *fields)
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    first, second = feed.filter("arrival < 300"), feed.filter("arrival >= 300")
    for batch, batch_id in ((first, 0), (second, 1), (second, 1)):
        plant.plant_batch(batch, batch_id, out, state, rows=150)
    quotes = plant.published(spark, out).filter("channel = 'bbo'")
    assert sorted(tuple(r[n] for n in QUOTE) for r in quotes.collect()) == replay(rows)[3]


def test_recording_is_idempotent(spark, tmp_path):
    here = tiers.Tiers(f"db_{uuid.uuid4().hex}", str(tmp_path / "archive"))
    tiers.create_tiers(spark, here, str(tmp_path / "tables"))
    schema = "channel STRING, arrival BIGINT, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in MESSAGE)

    def message(channel, **fields):
        return (channel, 0, *[fields.get(f.name) for f in MESSAGE])

    batch = spark.createDataFrame(
        [message("trade", ticker="TEST"), message("orderbook_delta", ticker="TEST"), message("noise")], schema
    )
    for _ in range(2):
        record.record_batch(batch, 7, here, now_ms=86_400_000)
    counts = {t: spark.table(here.hot(t)).count() for t in ("trades", "orderbook_deltas", "tickers", "bbo")}
    assert counts == {"trades": 1, "orderbook_deltas": 1, "tickers": 0, "bbo": 0}
    assert str(spark.table(here.hot("trades")).first().date) == "1970-01-02"


def test_topic_rows(spark):
    events = spark.createDataFrame([("bbo", 1, "T", 5.0)], "channel STRING, ord INT, ticker STRING, bid_price DOUBLE")
    row = record.topic_rows(events, "md.").first()
    assert (row.topic, row.key, row.value) == ("md.bbo", "T", '{"ticker":"T","bid_price":5.0}')


def test_kafka_rows(spark):
    value = '{"channel": "trade", "message": {"ticker": "T", "count": 3}}'
    records = spark.createDataFrame([(value.encode(), 41), (b"junk", 42)], "value BINARY, offset BIGINT")
    rows = feeds.messages(feeds.kafka_feed(records).select("channel", "arrival", F.struct("ticker", "count").alias("message")))
    assert [(r.channel, r.arrival, r.ticker, r["count"]) for r in rows.collect() if r.channel] == [("trade", 41, "T", 3)]


@pytest.fixture
def rocksdb(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", stateful.ROCKSDB)
    yield
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def run_to_parquet(spark, df, tmp_path):
    out = str(tmp_path / "result")
    (
        df.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", str(tmp_path / "check"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.schema(df.schema).parquet(out)


def test_state_store_quotes_equal_batch(spark, tmp_path, rocksdb):
    rows = random_deltas(600)
    deltas = land(spark, tmp_path / "feed", rows, 3).withColumn("ts_ms", F.col("timestamp"))
    got = run_to_parquet(spark, stateful.bbo_change_stream(deltas), tmp_path).collect()
    assert sorted(tuple(r[n] for n in QUOTE) for r in got) == replay(rows)[3]


def test_state_store_gap_flags(spark, tmp_path, rocksdb):
    rows = [(i, "TEST", "yes", 1.0, 1, s, i) for i, s in enumerate([1, 2, 4, 5, 5, 6])]
    got = run_to_parquet(spark, stateful.gap_stream(land(spark, tmp_path / "feed", rows, 3)), tmp_path)
    assert [r.gap for r in got.orderBy("arrival").collect()] == [False, False, True, False, True, False]


def test_windows_over_a_stream(spark, tmp_path):
    rows = [(i, "T", "yes", float(i % 7), 1, i if i < 50 else i + 1, i * 10_000) for i in range(200)]
    feed = land(spark, tmp_path / "feed", rows, 2)
    shaped = tables.to_trades(feed.withColumn("count", F.lit(1).cast("bigint")))
    bars = run_to_parquet(spark, windows.bars_stream(shaped, "1 minute", "1 minute"), tmp_path / "bars")
    first = bars.orderBy("bar_start").first()
    assert (first.open, first.high, first.low, first.close, first.volume) == (0.0, 5.0, 0.0, 5.0, 6)
    flagged = shaped.select("ts", (F.col("arrival") == 50).alias("gap"))
    sliding = run_to_parquet(spark, windows.gap_rate_stream(flagged, late="1 minute"), tmp_path / "gaps")
    assert sliding.filter("alert").count() == 5
    unique = run_to_parquet(spark, windows.dedup_stream(shaped.withColumn("trade_id", F.expr("arrival % 3"))), tmp_path / "unique")
    assert unique.count() == 3
