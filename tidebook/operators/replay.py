"""Best bid and offer after every delta of one segment, in numpy.

Spark cuts the feed into segments of bounded size and hands each one over together with the book it
opens with; this helper fills in the best price of each side.
"""

from __future__ import annotations

import sys
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

REPLAY_SCHEMA = (
    "ticker STRING, arrival BIGINT, ts_ms BIGINT, bid_price DOUBLE, bid_size BIGINT, "
    "ask_price DOUBLE, ask_size BIGINT, changed BOOLEAN"
)

NO_LEVELS = pa.schema([("book_side", pa.string()), ("level", pa.float64()), ("size", pa.int64())]).empty_table()


def _best(position, price, delta, total, highest):
    """Best price and its size before the first delta (slot 0) and after each of `total` deltas.

    The live prices are kept in a heap; a price leaves it when it comes to the top with nothing left.
    """
    order = np.argsort(position, kind="stable")
    sign = -1.0 if highest else 1.0
    sizes: dict[float, int] = {}
    heap: list[float] = []
    waiting: set[float] = set()
    best_price, best_size = [], []
    for level, change in zip((sign * price[order]).tolist(), delta[order].tolist(), strict=True):
        size = sizes.get(level, 0) + change
        if size > 0:
            sizes[level] = size
            if level not in waiting:
                waiting.add(level)
                heappush(heap, level)
        else:
            sizes[level] = 0
        while heap and not sizes[heap[0]]:
            waiting.remove(heappop(heap))
        best_price.append(sign * heap[0] if heap else np.nan)
        best_size.append(sizes[heap[0]] if heap else 0)
    last = np.searchsorted(position[order], np.arange(total + 1), side="right")
    return np.array([np.nan, *best_price])[last], np.array([0, *best_size], dtype=np.int64)[last]


def replay_segment(key: tuple[pa.Scalar, ...], events: pa.Table, opening: pa.Table) -> pa.Table:
    """BBO after each delta in `events`, starting from the levels in `opening`."""
    total = events.num_rows
    arrival = events["arrival"].to_numpy()
    order = np.argsort(arrival, kind="stable")
    is_bid = pc.equal(events["side"], "yes").to_numpy()[order]
    price = events["price"].to_numpy()[order]
    delta = events["delta_size"].to_numpy()[order]
    slot = np.arange(1, total + 1)
    open_bid = pc.equal(opening["book_side"], "yes").to_numpy()
    open_price = opening["level"].to_numpy()
    open_size = opening["size"].to_numpy()

    def side(bids: bool):
        mine, opened = is_bid == bids, open_bid == bids
        return _best(
            np.r_[np.zeros(opened.sum(), dtype=np.int64), slot[mine]],
            np.r_[open_price[opened], price[mine]],
            np.r_[open_size[opened], delta[mine]],
            total,
            highest=bids,
        )

    bid, bid_size = side(True)
    ask, ask_size = side(False)

    def moved(best):
        return ~((best[1:] == best[:-1]) | (np.isnan(best[1:]) & np.isnan(best[:-1])))

    def column(values, best, kind):
        return pa.array(values[1:], type=kind, mask=np.isnan(best[1:]))

    return pa.table(
        {
            "ticker": pa.array([key[0].as_py()] * total, type=pa.string()),
            "arrival": pa.array(arrival[order]),
            "ts_ms": events["ts_ms"].take(pa.array(order)),
            "bid_price": column(bid, bid, pa.float64()),
            "bid_size": column(bid_size, bid, pa.int64()),
            "ask_price": column(ask, ask, pa.float64()),
            "ask_size": column(ask_size, ask, pa.int64()),
            "changed": pa.array(moved(bid) | moved(ask)),
        }
    )


def replay_whole(key: tuple[pa.Scalar, ...], events: pa.Table) -> pa.Table:
    """BBO after each delta of a ticker that starts with an empty book."""
    return replay_segment(key, events, NO_LEVELS)


# Executors get these helpers with the job, so the package need not be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
