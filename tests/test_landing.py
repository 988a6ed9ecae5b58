"""Streams over landed tables: many files a batch, and still the batches that were meant."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidebook.plans import catalog
from tidebook.session import shared_dir

SF_DIR = "/root/testdata/sf0.001"


def test_goes_are_fifths_of_the_numbers(spark):
    for low, high in ((0, 999), (7, 11), (3, 3), (-5, 996), (1_000_000_007, 1_000_000_030)):
        rows = spark.range(low, high + 1).withColumnRenamed("id", "arrival")
        part = F.expr(f"(arrival - {low}) * 5 div {high - low + 1}").alias("part")
        expected = [[] for _ in range(5)]
        for row in rows.select("arrival", part).collect():
            expected[row.part].append(row.arrival)
        assert [sorted(row.arrival for row in go.collect()) for go in catalog._goes(rows)] == expected


def landed(spark, name, folder):
    """Data files of a folder that a query lands, and the batches that its stream made of them."""
    shared = Path(shared_dir(spark))
    before = set(shared.iterdir()) if shared.exists() else set()
    catalog.QUERIES[name](spark, SF_DIR).count()
    made = [path for path in shared.iterdir() if path not in before]
    (path,) = [path for path in made if path.name.startswith(f"{folder}-")]
    (checkpoint,) = [path for path in made if path.name.startswith("checkpoint-")]
    return list(path.rglob("part-*")), [file for file in (checkpoint / "sources" / "0").iterdir() if file.name.isdigit()]


@pytest.mark.parametrize("name, folder", [("stream_evicted", "deltas"), ("stream_dedup_history", "trades"), ("stream_recovery_log", "feed"), ("stream_bbo_table", "feed")])
def test_a_batch_is_landed_by_many_tasks(spark, name, folder):
    files, batches = landed(spark, name, folder)
    assert len(files) > 5 and len(batches) == 5
