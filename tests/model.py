"""A sequential book in plain Python, the yardstick of the order-book tests."""

from __future__ import annotations

import random


class Book:
    def __init__(self):
        self.sides = {"yes": {}, "no": {}}
        self.sequence = 0
        self.ts_ms = None

    def take(self, side, price, delta, sequence=None, ts_ms=None):
        levels = self.sides["yes" if side == "yes" else "no"]
        size = max(0, levels.get(price, 0) + delta)
        if size:
            levels[price] = size
        else:
            levels.pop(price, None)
        if sequence is not None and sequence > self.sequence:
            self.sequence = sequence
        self.ts_ms = ts_ms
        return size

    def quote(self):
        bids, asks = self.sides["yes"], self.sides["no"]
        bid = max(bids) if bids else None
        ask = min(asks) if asks else None
        return bid, bids.get(bid), ask, asks.get(ask)


def random_deltas(count, tickers=5, prices=12, seed=1, hot=True):
    """Rows (arrival, ticker, side, price, delta_size, sequence, ts_ms); ticker T0 holds about a third."""
    rng = random.Random(seed)
    rows = []
    for arrival in range(count):
        ticker = "T0" if hot and rng.random() < 0.33 else f"T{rng.randrange(tickers)}"
        side = rng.choice(["yes", "no", "yes", "no", "maybe"])
        delta = rng.randint(1, 20) * rng.choice([1, -1])
        sequence = None if rng.random() < 0.1 else arrival
        rows.append((arrival, ticker, side, float(40 + rng.randrange(prices)), delta, sequence, 1000 + arrival))
    return rows


def replay(rows):
    """Sizes, quotes and change events after each row, and the final books."""
    books, sizes, quotes, changes, last = {}, [], [], [], {}
    for arrival, ticker, side, price, delta, sequence, ts_ms in rows:
        book = books.setdefault(ticker, Book())
        sizes.append((arrival, book.take(side, price, delta, sequence, ts_ms)))
        quote = book.quote()
        quotes.append((arrival, ticker, *quote))
        pair = (quote[0], quote[2])
        if pair != last.get(ticker, (None, None)):
            changes.append((arrival, ticker, *quote))
            last[ticker] = pair
    return books, sizes, quotes, changes
