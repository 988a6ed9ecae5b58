"""One large JSON document cut into its objects, without ever being parsed as a whole.

Spark's text reader delivers the document in pieces that end with `}`, block by block and in order within a
block. Whether a piece lies inside a string, and how deep, depends on all that came before it; so every block
is scanned once for each way it may begin (outside of a string, inside one, behind a backslash), and the
small summaries, one row per block, settle how it does begin. A second scan then cuts the objects out.
An object that runs over the end of its block is put together from its parts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidebook.session import written

OUTSIDE, INSIDE, ESCAPED = range(3)
#: Objects handed on at a time.
ROWS = 512
#: Tasks a core, where there are more blocks than that.
TASKS = 8
#: A string up to its end, if it has one here; or a bracket.
TOKEN = re.compile(r'"(?:[^"\\]|\\.)*("|\\$|$)|[{}\[\]]', re.S)
REST = re.compile(r'(?:[^"\\]|\\.)*("|\\$|$)', re.S)


def scan(text: str, state: int, depth: int, at: int) -> tuple[int, int, list[tuple[int, bool]]]:
    """State and depth after a piece, and where objects of nesting `at` begin (True) and end (False) in it."""
    place, marks = 0, []
    if state == ESCAPED:
        place, state = min(1, len(text)), INSIDE if text else ESCAPED
    if state == INSIDE:
        found = REST.match(text, place)
        place = found.end()
        if found[1] != '"':
            return (ESCAPED if found[1] else INSIDE), depth, marks
        state = OUTSIDE
    for found in TOKEN.finditer(text, place):
        token = found[0]
        if token in "{[":
            if depth == at and token == "{":
                marks.append((found.start(), True))
            depth += 1
        elif token in "}]":
            depth -= 1
            if depth == at and token == "}":
                marks.append((found.end(), False))
        elif found[1] != '"':
            return (ESCAPED if found[1] else INSIDE), depth, marks
    return OUTSIDE, depth, marks


def _pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Pieces of documents with the file and block they lie in; each is to be followed by a `}`."""
    text = spark.read.option("lineSep", "}").text(path)
    return text.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _several_a_task(spark: SparkSession, pieces: DataFrame) -> DataFrame:
    """Where there are many blocks, a task reads several, one after the other, as each task has its costs."""
    tasks = TASKS * spark.sparkContext.defaultParallelism
    return pieces.coalesce(tasks) if pieces.rdd.getNumPartitions() > tasks else pieces


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], str]]:
    for batch in batches:
        keys = zip(batch.column("file").to_pylist(), batch.column("block").to_pylist(), strict=True)
        for key, value in zip(keys, batch.column("value").to_pylist(), strict=True):
            yield key, value + "}"


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every block and each state it may begin in: the state it ends in and the change of depth."""
    ways: dict[tuple[str, int], list[tuple[int, int]]] = {}
    for key, text in _by_block(batches):
        before = ways.setdefault(key, [(OUTSIDE, 0), (INSIDE, 0), (ESCAPED, 0)])
        ways[key] = [scan(text, state, depth, -(1 << 60))[:2] for state, depth in before]
    rows = [(*key, begin, end, depth) for key, found in ways.items() for begin, (end, depth) in enumerate(found)]
    kinds = (pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int64())
    columns = zip(*rows) if rows else [[]] * 5
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["file", "block", "begin", "end", "depth"])


def block_states(pieces: DataFrame) -> dict[tuple[str, int], tuple[int, int]]:
    """The state and depth with which each block begins. Three rows of a few bytes per block come to the driver."""
    summary = "file string, block long, begin int, end int, depth long"
    rows = sorted(pieces.mapInArrow(_summaries, summary).collect())
    states, state, depth, last = {}, OUTSIDE, 0, None
    for number in range(0, len(rows), 3):
        file, block = rows[number].file, rows[number].block
        if file != last:
            state, depth, last = OUTSIDE, 0, file
        states[file, block] = state, depth
        found = rows[number + state]
        state, depth = found.end, depth + found.depth
    return states


def read_document(spark: SparkSession, path: str | list[str], nesting: int = 1) -> DataFrame:
    """The objects that lie in `nesting` other objects and lists, as text: file, block, number, value.

    1 is for a document that is a list of objects, 2 for one whose lists lie in an object. Ordered by file,
    block and number they come as in the document. One that the end of the document cuts off is left out,
    unless nothing but its last bracket is missing.
    """
    pieces = _several_a_task(spark, _pieces(spark, path))
    # Parts and whole objects are taken from one cut.
    found = written(_cut(pieces, block_states(pieces), nesting), "cut")
    # Number 0 goes on with what an earlier block began, an object that is not closed goes on in the next one.
    # That is two rows a block at most.
    parts = found.filter("number = 0 OR NOT closed")
    begun = F.sum((F.col("number") > 0).cast("int")).over(Window.partitionBy("file").orderBy("block", "number"))
    spans = parts.withColumn("span", begun).filter("span > 0").groupBy("file", "span")
    pieced = spans.agg(F.array_sort(F.collect_list(F.struct("block", "number", "value", "closed"))).alias("parts"))
    joined = pieced.filter(F.element_at("parts", -1)["closed"]).select(
        "file", F.col("parts")[0]["block"].alias("block"), F.col("parts")[0]["number"].alias("number"), F.array_join(F.transform("parts", lambda part: part["value"]), "").alias("value")
    )
    return found.filter("number > 0 AND closed").drop("closed").unionByName(joined)


def preview_document(spark: SparkSession, path: str, n: int = 5, nesting: int = 1, size: int = 2000) -> DataFrame:
    """The first objects of a document, each as text of `size` characters at most: number, value.

    Reads the first block of the document and of that no more than it needs; `read_document` has the rest.
    """
    first = _cut(_pieces(spark, path), None, nesting).filter("number > 0 AND closed").limit(n)
    return first.select("number", F.substring("value", 1, size).alias("value"))


def _cut(pieces: DataFrame, states: dict[tuple[str, int], tuple[int, int]] | None, nesting: int) -> DataFrame:
    """Objects and parts of objects of each block, numbered from 1; without states, of first blocks only."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], tuple] = {}
        made: list[tuple] = []

        def left_open() -> list[tuple]:
            return [(*key, number, "".join(parts), False) for key, (_, _, number, parts) in held.items() if parts is not None]

        for key, text in _by_block(batches):
            if states is None and key[1] > 0:
                continue
            if key not in held:
                made += left_open()
                held.clear()
                state, depth = states[key] if states is not None else (OUTSIDE, 0)
                held[key] = (state, depth, 0, [] if depth > nesting else None)
            state, depth, number, parts = held[key]
            state, depth, marks = scan(text, state, depth, nesting)
            begin = 0
            for place, opens in marks:
                if opens:
                    number, parts, begin = number + 1, [], place
                elif parts is not None:
                    made.append((*key, number, "".join([*parts, text[begin:place]]), True))
                    parts = None
            if parts is not None:
                parts.append(text[begin:])
            held[key] = (state, depth, number, parts)
            if len(made) >= ROWS:
                yield _batch(made)
                made = []
        made += left_open()
        yield _batch(made)

    return pieces.mapInArrow(cut, "file string, block long, number long, value string, closed boolean")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
    columns = zip(*rows) if rows else [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["file", "block", "number", "value", "closed"])
