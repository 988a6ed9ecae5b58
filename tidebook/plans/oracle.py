"""SQL for DuckDB that gives the same rows as the registered queries, on the same tables."""

from __future__ import annotations

# --- the adapters of `workload` in SQL ----------------------------------------------------------

EVENTS = """
ev AS (
  SELECT event_id AS arrival, epoch_us(ts) // 1000 AS ts_ms, 'T' || (user_id % 5) AS ticker,
         CASE WHEN event_type = 'purchase' THEN 'trade'
              WHEN event_type IN ('view', 'click') THEN 'orderbook_delta'
              WHEN event_type = 'signup' THEN 'ticker' ELSE 'unsupported' END AS type,
         CASE WHEN event_id % 2 = 0 THEN 'yes' ELSE 'no' END AS side,
         45.0::DOUBLE + CAST(json_extract_string(props, '$.k') AS INTEGER) % 10 AS price,
         CAST(1 + floor(value) % 50 AS BIGINT) AS count,
         CAST((CASE WHEN event_id % 3 = 2 THEN -1 ELSE 1 END) * (1 + floor(value) % 50) AS BIGINT) AS delta_size,
         CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 = 0 THEN 'no' ELSE 'yes' END AS taker_side,
         CAST(event_id AS VARCHAR) AS trade_id,
         CAST(floor(value) AS BIGINT) AS volume,
         strftime(ts, '%Y-%m-%d') AS date
  FROM events
)"""

# Sizes after each delta of a delta table `d`.
SIZED = """
run AS (
  SELECT *, sum(delta_size) OVER (PARTITION BY ticker, side, price ORDER BY arrival) AS run FROM d
), sized AS (
  SELECT arrival, ts_ms, ticker, side, price, delta_size,
         CAST(run - least(0, min(run) OVER (PARTITION BY ticker, side, price ORDER BY arrival)) AS BIGINT) AS size
  FROM run
)"""

# Final sizes of all levels, empty ones included.
CLOSED = """
closed AS (
  SELECT ticker, side, price, arg_max(size, arrival) AS size FROM sized GROUP BY ALL
)"""

# Best prices after every delta: each level is live from one of its deltas to the next.
HISTORY = """
spans AS (
  SELECT ticker, side, price, size, arrival AS from_arrival,
         lead(arrival) OVER (PARTITION BY ticker, side, price ORDER BY arrival) AS to_arrival
  FROM sized
), live AS (
  SELECT e.ticker, e.arrival, e.ts_ms, s.side, s.price, s.size
  FROM sized e LEFT JOIN spans s
    ON s.ticker = e.ticker AND s.size > 0 AND s.from_arrival <= e.arrival
   AND (s.to_arrival IS NULL OR s.to_arrival > e.arrival)
), best AS (
  SELECT ticker, arrival, ts_ms,
         max(price) FILTER (side = 'yes') AS bid_price,
         arg_max(size, price) FILTER (side = 'yes') AS bid_size,
         min(price) FILTER (side = 'no') AS ask_price,
         arg_min(size, price) FILTER (side = 'no') AS ask_size
  FROM live GROUP BY ticker, arrival, ts_ms
), quoted AS (
  SELECT *, round((bid_price + ask_price) / 2, 4) AS mid_price, round(ask_price - bid_price, 4) AS spread
  FROM best
), history AS (
  SELECT *, (bid_price IS DISTINCT FROM lag(bid_price) OVER w
             OR ask_price IS DISTINCT FROM lag(ask_price) OVER w) AS changed
  FROM quoted WINDOW w AS (PARTITION BY ticker ORDER BY arrival)
)"""

FINAL_QUOTES = """
quotes AS (
  SELECT ticker,
         max(price) FILTER (side = 'yes' AND size > 0) AS bid_price,
         arg_max(size, price) FILTER (side = 'yes' AND size > 0) AS bid_size,
         min(price) FILTER (side = 'no' AND size > 0) AS ask_price,
         arg_min(size, price) FILTER (side = 'no' AND size > 0) AS ask_size
  FROM closed GROUP BY ticker
)"""

# A numbered feed that lost every fiftieth message, with its gaps.
LOSSY = """
lossy AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY arrival) AS sequence FROM ev
  ) WHERE arrival % 50 <> 7
), gaps AS (
  SELECT *, coalesce(sequence <> last_sequence + 1, false) AS gap
  FROM (SELECT *, lag(sequence) OVER (PARTITION BY ticker ORDER BY arrival) AS last_sequence FROM lossy)
)"""

ALL_DELTAS = f"{EVENTS}, d AS (SELECT * FROM ev)"
FEED_DELTAS = f"{EVENTS}, d AS (SELECT * FROM ev WHERE type = 'orderbook_delta')"
LOSSY_DELTAS = f"{EVENTS}, {LOSSY}, d AS (SELECT * FROM gaps WHERE type = 'orderbook_delta')"


def with_(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


QUOTES = "bid_price, bid_size, ask_price, ask_size, mid_price, spread"
BBO_HISTORY = with_(f"{ALL_DELTAS}, {SIZED}, {HISTORY}", f"SELECT ticker, arrival, ts_ms, {QUOTES}, changed FROM history")
BBO_CHANGES = with_(
    f"{ALL_DELTAS}, {SIZED}, {HISTORY}", f"SELECT ticker, arrival, ts_ms, {QUOTES} FROM history WHERE changed"
)
LEVEL_SIZES = with_(f"{ALL_DELTAS}, {SIZED}", "SELECT * FROM sized")
LIVE_BOOK = with_(f"{ALL_DELTAS}, {SIZED}, {CLOSED}", "SELECT * FROM closed WHERE size > 0")
RANKED = """
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY ticker, side
            ORDER BY CASE WHEN side = 'yes' THEN -price ELSE price END) AS INTEGER) AS level
  FROM closed WHERE size > 0
)"""
SEQUENCE_GAPS = with_(f"{EVENTS}, {LOSSY}", "SELECT arrival, ticker, sequence, last_sequence, gap FROM gaps")


def bars(width_ms: int, where: str = "true") -> str:
    return with_(
        EVENTS,
        f"""SELECT ticker, ts_ms // {width_ms} * {width_ms} AS bar_ms,
       arg_min(price, arrival) AS open, max(price) AS high, min(price) AS low, arg_max(price, arrival) AS close,
       CAST(sum(count) AS BIGINT) AS volume, count(*) AS trades
FROM ev WHERE {where} GROUP BY ALL""",
    )


def per_day(where: str) -> str:
    return with_(
        EVENTS,
        f"""SELECT date, count(*) AS rows, CAST(sum(count) AS BIGINT) AS volume, min(ts_ms) AS first_ms
FROM ev WHERE type = 'trade' AND {where} GROUP BY date""",
    )


def moved(full: str, late: str = "") -> str:
    """Contents of the tiers after a day was closed: `full` tiers hold the day, `late` ones what came after
    retention; the hot tier keeps all other days."""
    day, other = "date = '2024-01-15'", "date <> '2024-01-15'"
    tiers = [(tier, day) for tier in full.split()] + [("hot", other)]
    tiers += [(late, f"{day} AND arrival % 2 = 1")] if late else []
    parts = [
        f"""SELECT '{tier}' AS tier, '{table}' AS "table", date, count(*) AS rows, CAST(sum({amount}) AS BIGINT) AS amount,
       sum(price) AS prices, CAST(sum(arrival % 1009) AS BIGINT) AS arrivals
FROM ev WHERE type = '{kind}' AND {where} GROUP BY date"""
        for tier, where in tiers
        for table, kind, amount in (("trades", "trade", "count"), ("orderbook_deltas", "orderbook_delta", "delta_size"))
    ]
    return with_(EVENTS, "\nUNION ALL\n".join(parts))


CHECKED = f"""{EVENTS}, odd AS (
  SELECT * FROM ev WHERE (day(CAST(date AS DATE)) + CAST(substr(ticker, 2, 1) AS INTEGER)) % 4 <> 0
), spine AS (
  SELECT ticker, strftime(unnest(generate_series((SELECT min(CAST(date AS DATE)) FROM ev), (SELECT max(CAST(date AS DATE)) FROM ev), INTERVAL 1 DAY)), '%Y-%m-%d') AS date
  FROM (SELECT DISTINCT ticker FROM odd UNION SELECT 'SILENT')
), actual AS (
  SELECT ticker, date, count(*) AS trades, CAST(sum(count) AS BIGINT) AS volume FROM odd GROUP BY ALL
), expected AS (
  SELECT ticker, date, CAST(sum(count) - sum(count) // 100 AS BIGINT) AS expected_volume
  FROM (SELECT ticker, date, count FROM ev UNION ALL SELECT 'SILENT', date, count FROM ev WHERE ticker = 'T1') GROUP BY ALL
), checked AS (
  SELECT ticker, date, coalesce(trades, 0) AS trades, coalesce(volume, 0) AS volume, expected_volume,
         coalesce(trades, 0) > 0 AND coalesce(volume, 0) >= coalesce(expected_volume, 0) AS complete
  FROM spine LEFT JOIN actual USING (ticker, date) LEFT JOIN expected USING (ticker, date)
)"""

MARKETS = """
markets AS (
  SELECT CAST(p_partkey AS VARCHAR) AS ticker,
         CASE WHEN p_partkey % 7 <> 0 THEN p_name ELSE '' END AS title,
         p_brand AS event_ticker, upper(p_type) AS series_ticker,
         CASE WHEN p_size % 2 = 1 THEN 'open' ELSE 'closed' END AS status,
         CASE WHEN p_size % 5 <> 0 THEN p_size ELSE 0 END AS yes_price,
         CAST(NULL AS BIGINT) AS volume
  FROM part
)"""

SUBSCRIPTIONS = """
subs AS (
  SELECT DISTINCT channel, upper('t' || (c_custkey % 4)) AS ticker FROM (
    SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN 'trade' ELSE 'ticker' END AS channel, c_custkey FROM customer
    UNION ALL
    SELECT 'orderbook_delta', c_custkey FROM customer WHERE c_acctbal > 5000
  )
)"""

TRADE_TABLE_COUNTS = """
SELECT 'trades' AS "table", count(*) AS rows FROM {source} WHERE type = 'trade'
UNION ALL SELECT 'orderbook_deltas', count(*) FROM {source} WHERE type = 'orderbook_delta'
UNION ALL SELECT 'tickers', count(*) FROM {source} WHERE type = 'ticker'"""

STREAM_PLANT = with_(
    f"{LOSSY_DELTAS}, {SIZED}, {HISTORY}",
    """SELECT type AS channel, arrival, 0 AS ord, ticker, NULL::DOUBLE AS bid_price, NULL::DOUBLE AS ask_price,
       CASE WHEN type <> 'ticker' THEN price END AS price, CASE WHEN type = 'ticker' THEN price END AS last_price,
       NULL::BIGINT AS last_sequence
FROM gaps WHERE type <> 'unsupported'
UNION ALL
SELECT 'bbo', arrival, 1, ticker, bid_price, ask_price, NULL, NULL, NULL FROM history WHERE changed
UNION ALL
SELECT 'gap', arrival, 2, ticker, NULL, NULL, NULL, NULL, last_sequence FROM gaps WHERE gap""",
)

ORACLE: dict[str, str] = {
    # routing and shaping
    "feed_counts": with_(EVENTS, "SELECT type AS channel, count(*) AS messages FROM ev GROUP BY type"),
    "type_counts": with_(
        EVENTS, "SELECT type, count(*) AS messages, type <> 'unsupported' AS supported FROM ev GROUP BY type"
    ),
    "pass_through": with_(
        EVENTS,
        """SELECT type, ticker, arrival, CASE WHEN type = 'trade' THEN price END AS price,
       CASE WHEN type = 'ticker' THEN price END AS last_price, CASE WHEN type = 'trade' THEN count END AS count
FROM ev WHERE type IN ('trade', 'ticker')""",
    ),
    "trades_shape": with_(
        EVENTS,
        "SELECT ticker, taker_side, price, count, trade_id, arrival, ts_ms, date FROM ev WHERE type = 'trade'",
    ),
    "deltas_shape": with_(
        EVENTS,
        "SELECT ticker, side, price, delta_size, arrival, ts_ms, date FROM ev WHERE type = 'orderbook_delta'",
    ),
    "tickers_shape": with_(
        EVENTS,
        "SELECT ticker, price AS last_price, volume, arrival, ts_ms, date FROM ev WHERE type = 'ticker'",
    ),
    "bbo_shape": with_(
        f"{ALL_DELTAS}, {SIZED}, {HISTORY}",
        f"""SELECT ticker, {QUOTES}, arrival, ts_ms,
       strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d') AS date FROM history WHERE changed""",
    ),
    "quarantined_deltas": with_(
        EVENTS,
        """SELECT arrival, type, CASE WHEN type = 'trade' THEN 'side,delta_size' ELSE 'side,price,delta_size' END AS missing
FROM ev WHERE type <> 'orderbook_delta'""",
    ),
    "subscribed_messages": with_(
        f"{EVENTS}, {SUBSCRIPTIONS}",
        """SELECT channel, ticker, count(*) AS messages FROM ev JOIN subs USING (ticker)
WHERE ev.type = subs.channel GROUP BY ALL""",
    ),
    "subscription_lists": with_(
        SUBSCRIPTIONS, "SELECT channel, string_agg(ticker, ',' ORDER BY ticker) AS tickers FROM subs GROUP BY channel"
    ),
    # order books
    "level_sizes": LEVEL_SIZES,
    "level_sizes_segmented": LEVEL_SIZES,
    "live_book": LIVE_BOOK,
    "book_as_of": with_(
        f"""{EVENTS}, d AS (SELECT * FROM ev WHERE arrival <= (SELECT (min(arrival) + max(arrival)) // 2 FROM ev)),
{SIZED}, {CLOSED}""",
        "SELECT * FROM closed WHERE size > 0",
    ),
    "bbo": with_(
        f"{ALL_DELTAS}, {SIZED}, {CLOSED}, {FINAL_QUOTES}",
        """SELECT ticker, bid_price, bid_size, ask_price, ask_size,
       round((bid_price + ask_price) / 2, 4) AS mid_price, round(ask_price - bid_price, 4) AS spread,
       last.sequence, last.ts_ms
FROM quotes JOIN (SELECT ticker, count(*) AS sequence, arg_max(ts_ms, arrival) AS ts_ms FROM ev GROUP BY ticker) last
USING (ticker)""",
    ),
    "bbo_intake_time": with_(
        f"{ALL_DELTAS}, {SIZED}, {CLOSED}, {FINAL_QUOTES}, times AS (SELECT ticker, arg_max(ts_ms, arrival) AS ts_ms FROM ev GROUP BY ticker)",
        """SELECT ticker, bid_price, ask_price,
       CASE WHEN CAST(substr(ticker, 2, 1) AS INTEGER) % 2 = 1 THEN 1700000000000 ELSE ts_ms END AS ts_ms
FROM quotes JOIN times USING (ticker)""",
    ),
    "crossed": with_(
        f"{ALL_DELTAS}, {SIZED}, {CLOSED}, {FINAL_QUOTES}",
        "SELECT ticker, bid_price, ask_price, coalesce(bid_price >= ask_price, false) AS crossed FROM quotes",
    ),
    "depth_top5": with_(
        f"{ALL_DELTAS}, {SIZED}, {CLOSED}, {RANKED}",
        "SELECT ticker, side, price, size, level FROM ranked WHERE level <= 5",
    ),
    "depth_nested": with_(
        f"{ALL_DELTAS}, {SIZED}, {CLOSED}, {RANKED}",
        """SELECT ticker,
       string_agg(CAST(price AS INTEGER) || ':' || size, ' ' ORDER BY level) FILTER (side = 'yes') AS yes,
       string_agg(CAST(price AS INTEGER) || ':' || size, ' ' ORDER BY level) FILTER (side = 'no') AS no
FROM ranked WHERE level <= 5 GROUP BY ticker""",
    ),
    "bbo_history": BBO_HISTORY,
    "bbo_history_segmented": BBO_HISTORY,
    "bbo_changes": BBO_CHANGES,
    "bbo_changes_of_table": BBO_CHANGES,
    "plant_events": with_(
        f"{FEED_DELTAS}, {SIZED}, {HISTORY}",
        """SELECT type AS channel, arrival, 0 AS ord, ticker, NULL::DOUBLE AS bid_price, NULL::DOUBLE AS ask_price,
       CASE WHEN type <> 'ticker' THEN price END AS price, CASE WHEN type = 'ticker' THEN price END AS last_price
FROM ev WHERE type <> 'unsupported'
UNION ALL
SELECT 'bbo', arrival, 1, ticker, bid_price, ask_price, NULL, NULL FROM history WHERE changed""",
    ),
    "rebuild_book": LIVE_BOOK,
    "snapshot_levels": with_(
        f"{ALL_DELTAS}, {SIZED}, {CLOSED}, {RANKED}",
        "SELECT ticker, side, level - 1 AS pos, price, size FROM ranked WHERE level <= 3",
    ),
    "book_pages": with_(
        f"{ALL_DELTAS}, {SIZED}, {CLOSED}, {RANKED}",
        "SELECT ticker, side, level - 1 AS pos, price, size FROM ranked WHERE level <= 3",
    ),
    # sequence and completeness
    "sequence_gaps": SEQUENCE_GAPS,
    "sequence_gaps_segmented": SEQUENCE_GAPS,
    "sequence_gaps_partial": with_(
        f"""{EVENTS}, {LOSSY}, part AS (
  SELECT arrival, CASE WHEN arrival % 11 = 0 THEN NULL WHEN arrival % 17 = 0 THEN '' ELSE ticker END AS ticker,
         CASE WHEN arrival % 13 <> 0 THEN sequence END AS sequence
  FROM lossy
), kept AS (
  SELECT arrival, lag(sequence) OVER (PARTITION BY ticker ORDER BY arrival) AS last_sequence
  FROM part WHERE ticker <> '' AND sequence IS NOT NULL
)""",
        """SELECT arrival, ticker, sequence, last_sequence, coalesce(sequence <> last_sequence + 1, false) AS gap
FROM part LEFT JOIN kept USING (arrival)""",
    ),
    "missing_ranges": with_(
        f"{EVENTS}, {LOSSY}",
        """SELECT ticker, arrival, last_sequence + 1 AS missing_from, sequence - 1 AS missing_to
FROM gaps WHERE sequence > last_sequence + 1""",
    ),
    "gap_rate_5m": with_(
        f"{EVENTS}, {LOSSY}",
        """SELECT ts_ms // 300000 * 300000 AS window_ms, count(*) AS messages, count(*) FILTER (gap) AS gaps,
       count(*) FILTER (gap) / 300.0::DOUBLE AS rate, bool_or(gap) AS alert
FROM gaps GROUP BY ALL""",
    ),
    "gap_rate_sliding": with_(
        f"{EVENTS}, {LOSSY}",
        """SELECT window_ms, count(*) AS messages, count(*) FILTER (gap) AS gaps, bool_or(gap) AS alert
FROM (SELECT gap, ts_ms // 60000 * 60000 - 60000 * unnest([0, 1, 2, 3, 4]) AS window_ms FROM gaps)
GROUP BY window_ms""",
    ),
    "completeness": with_(CHECKED, "SELECT * FROM checked"),
    "missing_days": with_(CHECKED, "SELECT ticker, date FROM checked WHERE trades = 0 AND ticker <> 'SILENT'"),
    "backfill_report": with_(
        CHECKED,
        """SELECT ticker, CAST(sum(trades) AS BIGINT) AS trades, min(date) FILTER (trades > 0) AS first_day,
       max(date) FILTER (trades > 0) AS last_day, count(*) FILTER (NOT complete) AS incomplete_days,
       count(*) FILTER (trades = 0) AS missing_days,
       coalesce(string_agg(date, ',' ORDER BY date) FILTER (trades = 0), '') AS gaps, bool_and(complete) AS complete,
       (SELECT count(*) FROM odd WHERE price > 50 AND odd.ticker = checked.ticker) AS inserted
FROM checked GROUP BY ticker""",
    ),
    # trades
    "bars_1m": bars(60_000),
    "bars_1h": bars(3_600_000),
    "bars_1d": bars(86_400_000),
    "bars_rollup": f"""SELECT *, '1 hour' AS interval FROM ({bars(3_600_000)})
UNION ALL SELECT *, '1 day' FROM ({bars(86_400_000)})""",
    "trades_latest": with_(
        EVENTS,
        """SELECT ticker, trade_id, price, count, ts_ms FROM ev WHERE ticker = 'T0'
ORDER BY ts_ms DESC, arrival DESC LIMIT 20""",
    ),
    "trades_latest_hot": with_(
        EVENTS,
        """SELECT ticker, trade_id, price, count, ts_ms FROM ev WHERE ticker = 'T0'
ORDER BY ts_ms DESC, arrival DESC LIMIT 20""",
    ),
    "trades_range": with_(
        EVENTS,
        """SELECT ticker, trade_id, price, count, ts_ms FROM ev WHERE ticker = 'T1'
AND ts_ms >= epoch_ms(TIMESTAMP '2024-01-10 06:00:00') AND ts_ms < epoch_ms(TIMESTAMP '2024-01-20')""",
    ),
    "trades_range_zoned": with_(
        EVENTS,
        """SELECT ticker, trade_id, price, count, ts_ms FROM ev
WHERE ts_ms >= epoch_ms(TIMESTAMP '2024-01-15 20:00:00') AND ts_ms < epoch_ms(TIMESTAMP '2024-01-16 21:00:00')""",
    ),
    "day_slice": with_(
        EVENTS, "SELECT ticker, trade_id, price, count, ts_ms FROM ev WHERE date = '2024-01-15'"
    ),
    "dedup_trades": with_(EVENTS, "SELECT trade_id, ticker, price, arrival FROM ev"),
    "scalar_functions": """SELECT o_orderkey, epoch_us(o_orderdate) // 1000 * 1000000 AS ts_ns,
       epoch_us(date_trunc('day', o_orderdate)) // 1000000 AS midnight,
       strftime(CAST(o_orderdate AS DATE) + INTERVAL 1 DAY, '%Y-%m-%d') AS next_day,
       CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2000-01-01') AS INTEGER) AS days,
       upper('mk-' || o_orderpriority) AS ticker, substr('mk-' || o_orderpriority, 1, 6) AS clipped,
       round((o_orderkey % 97 + o_custkey % 89) / 2, 4) AS mid, o_custkey % 89 - o_orderkey % 97 AS spread
FROM orders""",
    # pages and markets
    "trade_pages": with_(
        EVENTS,
        """SELECT arrival // 1000 AS page_no, CAST(arrival % 1000 AS INTEGER) AS pos, ticker, trade_id, price, count, ts_ms
FROM ev""",
    ),
    "trade_pages_by_cursor": with_(
        EVENTS,
        """SELECT arrival // 1000 AS page_no, CAST(arrival % 1000 AS INTEGER) AS pos, ticker, trade_id, price, count, ts_ms
FROM ev""",
    ),
    "broken_chains": with_(
        EVENTS,
        """SELECT 'pull-1' AS pull, substr(md5('3'), 1, 12) AS missing, substr(md5('2'), 1, 12) AS after, 0 AS pages FROM ev HAVING max(arrival // 1000) >= 3
UNION ALL SELECT 'pull-1', substr(md5('4'), 1, 12), NULL, count(DISTINCT arrival // 1000) FILTER (arrival // 1000 > 3) FROM ev HAVING max(arrival // 1000) > 3""",
    ),
    "preview_document": r"""SELECT p_partkey AS key, 'a "}" and [{' || p_name || '\' AS note FROM part ORDER BY p_partkey LIMIT 7""",
    "read_document": r"""SELECT p_partkey AS key, 'a "}" and [{' || p_name || '\' AS note, p_size AS size FROM part""",
    "backfill_missing": with_(
        EVENTS,
        """SELECT ticker, trade_id, price, count, ts_ms, date FROM ev
WHERE (day(CAST(date AS DATE)) + CAST(substr(ticker, 2, 1) AS INTEGER)) % 4 = 0""",
    ),
    "quarantined_pages": with_(
        EVENTS, """SELECT DISTINCT '{"page_no":' || (arrival // 1000) || ',"trades":"none"}' AS line FROM ev WHERE arrival // 1000 % 3 = 1"""
    ),
    "feed_blank_lines": with_(EVENTS, "SELECT type AS channel, count(*) AS messages FROM ev GROUP BY type"),
    "trade_pages_raw": with_(
        EVENTS,
        """SELECT arrival // 1000 - (SELECT min(arrival) // 1000 FROM ev) AS page_no, CAST(arrival % 1000 AS INTEGER) AS pos, ticker, trade_id,
       price AS yes_price, count, ts_ms
FROM ev""",
    ),
    "bars_of_pages": bars(3_600_000),
    "trade_pages_first": with_(
        EVENTS,
        """SELECT arrival // 1000 AS page_no, CAST(arrival % 1000 AS INTEGER) AS pos, ticker, trade_id
FROM ev WHERE ticker = 'T2' ORDER BY arrival LIMIT 10""",
    ),
    "backfill_range": with_(
        EVENTS,
        """SELECT ticker, trade_id, price, count, ts_ms, date FROM ev
WHERE ticker = 'T3' AND date BETWEEN '2024-01-05' AND '2024-01-14'""",
    ),
    "load_trade_pages": "SELECT count(*) AS found, count(*) AS written FROM events",
    "markets_summary": with_(
        MARKETS, "SELECT ticker, title, event_ticker, yes_price, volume FROM markets WHERE status = 'open'"
    ),
    "markets_of_series": with_(
        MARKETS,
        """SELECT ticker, title, event_ticker, yes_price, volume FROM markets
WHERE status = 'closed' AND series_ticker = 'ECONOMY'""",
    ),
    "markets_display": with_(
        f"""{MARKETS}, shown AS (
  SELECT ticker, title, CASE WHEN yes_price = 0 THEN '-' ELSE CAST(yes_price AS VARCHAR) END AS yes,
         coalesce(volume, 0) AS volume FROM markets WHERE status = 'open'
)""",
        """SELECT *, rpad(ticker, CAST(greatest(15, length(ticker)) AS INTEGER), ' ') || ' ' || rpad(title, CAST(greatest(50, length(title)) AS INTEGER), ' ')
       || ' Yes:' || lpad(yes, 5, ' ') || '¢ Volume:' || volume AS line FROM shown""",
    ),
    "series_titles": """SELECT 'S' || p_partkey AS ticker,
       CASE WHEN p_partkey % 7 <> 0 THEN p_name ELSE 'S' || p_partkey END AS title,
       substr('{"ticker":"s' || p_partkey || '",' || CASE WHEN p_partkey % 7 <> 0 THEN '"title":"' || p_name || '",' ELSE '' END
              || '"category":"' || p_type || '"}', 1, 800) AS series
FROM part""",
    "series_fields": """SELECT 'S' || p_partkey AS ticker, CASE WHEN p_partkey % 7 <> 0 THEN p_name END AS title,
       p_type AS category, CAST(p_size AS BIGINT) AS size FROM part""",
    "series_drift": """SELECT field, type, objects FROM (
  SELECT 'ticker' AS field, 'STRING' AS type, count(*) AS objects FROM part
  UNION ALL SELECT 'category', 'ARRAY<STRING>', count(*) FROM part
  UNION ALL SELECT 'title', 'STRING', count(*) FROM part WHERE p_partkey % 7 <> 0
  UNION ALL SELECT 'size', 'STRING', count(*) FROM part WHERE p_partkey % 5 = 0
  UNION ALL SELECT 'size', 'BIGINT', count(*) FROM part WHERE p_partkey % 5 <> 0) WHERE objects > 0""",
    "event_titles": """SELECT 'E' || s_suppkey AS ticker, s_name AS title, '{"title":"' || s_name || '"}' AS event
FROM supplier""",
    "first_market": with_(
        MARKETS, "SELECT ticker, nullif(title, '') AS title, status FROM markets ORDER BY CAST(ticker AS BIGINT) LIMIT 1"
    ),
    "markets_limited": with_(
        MARKETS,
        """SELECT ticker, status, page_no, pos FROM (
  SELECT *, CAST(ticker AS BIGINT) // 1000 AS page_no,
         CAST(row_number() OVER (PARTITION BY CAST(ticker AS BIGINT) // 1000 ORDER BY CAST(ticker AS BIGINT)) - 1 AS INTEGER) AS pos
  FROM markets
) WHERE status = 'open' ORDER BY CAST(ticker AS BIGINT) LIMIT 700""",
    ),
    "quarantined_lines": with_(EVENTS, "SELECT '{bad ' || arrival AS line FROM ev WHERE type = 'unsupported'"),
    # monitoring
    "latency_p99": with_(
        f"""{EVENTS}, ranked AS (
  SELECT ts_ms // 3600000 * 3600000 AS window_ms, volume AS latency,
         row_number() OVER (PARTITION BY ts_ms // 3600000 ORDER BY volume) AS place,
         count(*) OVER (PARTITION BY ts_ms // 3600000) AS messages
  FROM ev
)""",
        """SELECT window_ms, max(messages) AS messages, min(latency) FILTER (place * 100 >= messages * 99) AS latency,
       min(latency) FILTER (place * 100 >= messages * 99) > 200 AS alert
FROM ranked GROUP BY window_ms""",
    ),
    "latency_alerts": with_(
        f"""{EVENTS}, ranked AS (
  SELECT ts_ms // 3600000 * 3600000 AS window_ms, volume AS latency,
         row_number() OVER (PARTITION BY ts_ms // 3600000 ORDER BY volume) AS place,
         count(*) OVER (PARTITION BY ts_ms // 3600000) AS messages
  FROM ev
), p99 AS (
  SELECT window_ms, min(latency) FILTER (place * 100 >= messages * 99) AS latency FROM ranked GROUP BY window_ms
), above AS (
  SELECT *, window_ms - 3600000 * row_number() OVER (ORDER BY window_ms) AS island FROM p99 WHERE latency > 60
)""",
        """SELECT min(window_ms) AS start_ms, max(window_ms) + 3600000 AS end_ms, count(*) AS windows, max(latency) AS worst,
       count(*) >= 2 AS fired
FROM above GROUP BY island""",
    ),
    "counters": with_(
        f"{LOSSY_DELTAS}, {SIZED}, {HISTORY}",
        """SELECT 'trades_processed' AS counter, count(*) AS total FROM gaps WHERE type = 'trade'
UNION ALL SELECT 'bbo_updates', count(*) FROM history WHERE changed
UNION ALL SELECT 'sequence_gaps', count(*) FROM gaps WHERE gap""",
    ),
    # tiers
    "table_counts": with_(EVENTS, TRADE_TABLE_COUNTS.format(source="ev")),
    "hot_batches": per_day("true"),
    "migrate_day": per_day("date = '2024-01-15'"),
    "migrate_days": per_day("true"),
    "export_days": per_day("true"),
    "expired_partitions": with_(
        EVENTS, "SELECT DISTINCT date FROM ev WHERE type = 'trade' AND CAST(date AS DATE) < DATE '2024-03-31' - 80"
    ),
    "retention": per_day("CAST(date AS DATE) >= DATE '2024-03-31' - 80"),
    "end_of_day": with_(
        f"{EVENTS}, t AS (SELECT * FROM ev WHERE type = 'trade')",
        """SELECT 'hot' AS "table", count(*) AS rows FROM t WHERE date <> '2024-01-15'
UNION ALL SELECT 'warm', count(*) FROM t WHERE date = '2024-01-15'
UNION ALL SELECT 'archive', count(*) FROM t WHERE date = '2024-01-15'
UNION ALL SELECT 'log done', count(*) FROM t WHERE date = '2024-01-15'""",
    ),
    "end_of_day_late": moved("warm archive"),
    "end_of_day_repeated": moved("warm archive"),
    "end_of_day_after_retention": moved("archive", late="warm"),
    # streams
    "feed_replay": with_(
        f"{EVENTS}, numbered AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY arrival) AS sequence FROM ev)",
        """SELECT type AS channel, arrival, ticker, sequence,
       CASE WHEN type IN ('trade', 'orderbook_delta') THEN price END AS price,
       CASE WHEN type = 'orderbook_delta' THEN delta_size END AS delta_size,
       CASE WHEN type = 'trade' THEN count END AS count
FROM numbered""",
    ),
    "stream_plant": STREAM_PLANT,
    "stream_plant_batches": STREAM_PLANT,
    "stream_quarantine": with_(
        EVENTS,
        """SELECT arrival, ticker, CASE WHEN type = 'unsupported' THEN 'type unsupported' ELSE 'without price' END AS reason
FROM ev WHERE type = 'unsupported' OR type = 'orderbook_delta' AND arrival % 10 = 3""",
    ),
    "stream_record": with_(
        f"{EVENTS}, {LOSSY}", TRADE_TABLE_COUNTS.format(source="lossy") + "\nUNION ALL SELECT 'bbo', 0"
    ),
    "stream_record_batches": with_(
        f"{EVENTS}, {LOSSY}",
        """SELECT CASE type WHEN 'trade' THEN 'trades' WHEN 'ticker' THEN 'tickers' ELSE 'orderbook_deltas' END AS "table",
       date, count(*) AS rows, CAST(sum(arrival % 1009) AS BIGINT) AS arrivals
FROM lossy WHERE type <> 'unsupported' GROUP BY type, date""",
    ),
    "stream_bbo_table": with_(
        f"{LOSSY_DELTAS}, {SIZED}, {HISTORY}",
        f"""SELECT ticker, {QUOTES}, arrival, ts_ms, strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d') AS date
FROM history WHERE changed""",
    ),
    "stream_recovery": LIVE_BOOK,
    "stream_recovery_log": with_(
        f"""{EVENTS}, span AS (SELECT min(arrival) AS low, max(arrival) - min(arrival) + 1 AS width FROM ev),
kept AS (
  SELECT ticker, arrival, sequence, lag(sequence) OVER (PARTITION BY ticker ORDER BY arrival) AS before
  FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY arrival) AS sequence FROM ev), span
  WHERE arrival % 50 <> 7 OR (arrival - low) * 5 // width >= 2
)""",
        """SELECT ticker, min(arrival) AS stale_since, max(arrival) AS last_gap,
       (SELECT low + 3 * width // 5 FROM span) AS recovered_at
FROM kept WHERE sequence <> before + 1 GROUP BY ticker""",
    ),
    "stream_bars": bars(3_600_000),
    "stream_gap_flags": with_(f"{EVENTS}, {LOSSY}", "SELECT ticker, arrival, sequence, last_sequence, gap FROM gaps"),
    "stream_bbo_changes": BBO_CHANGES,
    "stream_evicted": with_(
        f"""{EVENTS}, d AS (SELECT * REPLACE ('U' || (user_id % 40) AS ticker) FROM (SELECT ev.*, user_id FROM ev JOIN events ON event_id = arrival)), {SIZED}, {HISTORY}""",
        f"SELECT ticker, arrival, ts_ms, {QUOTES} FROM history WHERE changed",
    ),
    "stream_gap_rate": with_(
        f"{EVENTS}, {LOSSY}",
        """SELECT window_ms, count(*) AS messages, count(*) FILTER (gap) AS gaps, bool_or(gap) AS alert
FROM (SELECT gap, ts_ms // 60000 * 60000 - 60000 * unnest([0, 1, 2, 3, 4]) AS window_ms FROM gaps)
GROUP BY window_ms""",
    ),
    "stream_gap_rate_flagged": with_(
        f"{EVENTS}, {LOSSY}",
        """SELECT window_ms, count(*) AS messages, count(*) FILTER (gap) AS gaps, bool_or(gap) AS alert
FROM (SELECT gap, ts_ms // 60000 * 60000 - 60000 * unnest([0, 1, 2, 3, 4]) AS window_ms FROM gaps)
GROUP BY window_ms""",
    ),
    "stream_dedup_history": with_(EVENTS, "SELECT CASE WHEN arrival % 7 <> 0 THEN trade_id END AS trade_id, arrival FROM ev"),
    "stream_dedup": with_(
        EVENTS,
        """SELECT trade_id, arrival FROM ev WHERE arrival % 7 <> 0
UNION ALL SELECT NULL, arrival FROM ev WHERE arrival % 7 = 0
UNION ALL SELECT NULL, arrival FROM ev WHERE arrival % 7 = 0""",
    ),
}
