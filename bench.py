"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the tables and the number of cores. Every query runs once to warm
the session up and is then timed over its whole output, best of BENCH_RUNS.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidebook.plans.catalog import QUERIES  # noqa: E402
from tidebook.session import build_session  # noqa: E402

HEADLINE = (
    "feed_counts trades_shape level_sizes level_sizes_segmented live_book bbo depth_top5 bbo_history "
    "bbo_history_segmented bbo_changes plant_events sequence_gaps gap_rate_5m rebuild_book bars_1m bars_1h "
    "trades_latest day_slice dedup_trades completeness latency_p99 trade_pages migrate_days end_of_day "
    "stream_plant stream_bars"
).split()


def timed(run, spark, sf_dir: str) -> float:
    begin = time.perf_counter()
    run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus if cpus.isdigit() else 8, "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        timed(QUERIES[name], spark, sf_dir)
        seconds[name] = round(min(timed(QUERIES[name], spark, sf_dir) for _ in range(runs)), 3)
    total = round(sum(seconds.values()), 3)
    scale = Path(sf_dir).name.removeprefix("sf")
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    main()
