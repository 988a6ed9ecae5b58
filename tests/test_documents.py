"""Objects cut out of one large document, however it is split."""

import json
import random
from pathlib import Path

import pytest

from tidebook.plans import catalog
from tidebook.sources import documents


def made(rng, count):
    texts = ["", "}", '"', "\\", '\\"}', "[{", "é}{", 'a "b" c', "x" * 300, "\\\\\\"]
    nested = [{}, {"a": [{"b": {}}, []]}, [1, [2]], "}", None]
    return [{"n": n, rng.choice(texts): rng.choice(texts), "more": rng.choice(nested)} for n in range(count)]


@pytest.mark.parametrize("block", [64, 257, 1 << 20])
@pytest.mark.parametrize("indent", [None, 2])
def test_every_object_comes_back(spark, tmp_path, block, indent):
    rng = random.Random(block)
    first, second = made(rng, 60), made(rng, 9)
    (tmp_path / "a.json").write_text(json.dumps(first, ensure_ascii=False, indent=indent))
    (tmp_path / "b.json").write_text(json.dumps({"cursor": "}", "list": second}, indent=indent) + "\n")
    (tmp_path / "c.json").write_text("[]")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        for name, nesting, given in (("a", 1, first), ("b", 2, second), ("c", 1, [])):
            rows = documents.read_document(spark, str(tmp_path / f"{name}.json"), nesting).orderBy("file", "block", "number").collect()
            assert [json.loads(r.value) for r in rows] == given
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_preview_takes_the_first(spark, tmp_path):
    given = made(random.Random(1), 50)
    (tmp_path / "a.json").write_text(json.dumps(given))
    found = documents.preview_document(spark, str(tmp_path / "a.json"), 3).collect()
    assert [json.loads(r.value) for r in found] == given[:3]
    assert [len(r.value) for r in documents.preview_document(spark, str(tmp_path / "a.json"), 2, size=5).collect()] == [5, 5]


def test_a_document_cut_short_loses_its_last_object_only(spark, tmp_path):
    given = made(random.Random(2), 9)
    text = json.dumps(given)
    (tmp_path / "a.json").write_text(text[: text.rindex('"more"') + 3])
    found = documents.read_document(spark, str(tmp_path / "a.json")).orderBy("number").collect()
    assert [json.loads(r.value) for r in found] == given[:-1]


def test_many_short_blocks_are_read_by_few_tasks(spark, tmp_path):
    given = made(random.Random(3), 400)
    (tmp_path / "a.json").write_text(json.dumps(given))
    few = documents.TASKS * spark.sparkContext.defaultParallelism
    ran = []
    spark.conf.set("spark.sql.files.maxPartitionBytes", 64)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    spark.sparkContext.setJobGroup("document", "document")
    try:
        found = documents.read_document(spark, str(tmp_path / "a.json"))
        tracker = spark.sparkContext.statusTracker()
        stages = [tracker.getStageInfo(stage) for job in tracker.getJobIdsForGroup("document") for stage in tracker.getJobInfo(job).stageIds]
        ran = [stage.numTasks for stage in stages if stage]
        assert [json.loads(r.value) for r in found.orderBy("file", "block", "number").collect()] == given
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert (tmp_path / "a.json").stat().st_size > 64 * few
    assert ran and max(ran) <= few


def test_the_document_is_one_line_of_every_object(spark):
    (file,) = [p for p in Path(catalog._market_document(spark, "/root/testdata/sf0.001")).iterdir() if p.name.startswith("part-")]
    text = file.read_text()
    keys = [entry["key"] for entry in json.loads(text)]
    assert keys == sorted(r.p_partkey for r in spark.read.parquet("/root/testdata/sf0.001/part.parquet").collect()) and "\n" not in text.strip()
