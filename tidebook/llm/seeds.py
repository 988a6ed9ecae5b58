"""Winnowed seeds of repeats: where texts may share a run of symbols, found without comparing pairs.

A run of `length` symbols that occurs twice holds the same winnowed anchor (a gram of `gram` symbols) at
the same place in both. An anchor is known by the hash of its gram and by the hash of its context: all
symbols that any run through it can cover. Occurrences of one gram with one context form a class; in a
class everything repeats, so only one member per class has to be looked at more closely, and only
where a gram has several contexts.

Classes are combined within each slice of the input before anything is shuffled, so an anchor of a
third of all documents sends a row per slice to its group; the rest are settled on the spot.

Documents are told apart by their id and a 64-bit hash of their text (`mark`); rows with both equal share
their results. Long texts are cut into overlapping pieces of bounded size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidebook.llm import base
from tidebook.llm.cuckoo import mixed
from tidebook.llm.words import Hashes, Powers

SEEDS = "gram long, context long, doc_id long, place long, mark long, n int"


@dataclass(frozen=True)
class Shape:
    """Length of a repeat and of a gram, and how many symbols to work on at a time."""

    length: int
    gram: int
    slice: int

    @property
    def left(self) -> int:
        return self.length - self.gram


def sliding_minimum(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every window of so many keys, from running minima of blocks."""
    blocks = -(-len(keys) // width)
    padded = np.full(blocks * width, np.iinfo(keys.dtype).max, keys.dtype)
    padded[: len(keys)] = keys
    table = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    back = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(keys) - width + 1
    return np.minimum(back[:count], ahead[width - 1 : width - 1 + count])


def stretches(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each begin on, so many each, one after the other."""
    return np.repeat(begins - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


@dataclass
class Piece:
    """A stretch of a document: symbols around the runs that begin in [first, last) of the document."""

    doc: int
    at: int
    symbols: np.ndarray
    first: int
    last: int
    size: int


def pieces(doc: int, symbols: np.ndarray, shape: Shape) -> Iterator[Piece]:
    runs = len(symbols) - shape.length + 1
    for first in range(0, max(0, runs), shape.slice):
        last = min(first + shape.slice, runs)
        at, end = max(0, first - shape.left), min(len(symbols), last + 2 * shape.length)
        yield Piece(doc, at, symbols[at:end], first, last, len(symbols))


def anchors(run: list[Piece], shape: Shape, powers: Powers) -> tuple[np.ndarray, ...]:
    """Document, place, gram hash and context hash of the anchors of pieces."""
    symbols = np.concatenate([p.symbols for p in run])
    begins = np.cumsum([0, *(len(p.symbols) for p in run)])
    hashes = Hashes(symbols, powers)
    grams = hashes.grams(shape.gram)
    order = (grams & np.uint64(0xFFFFFFFF00000000)) | (np.uint64(0xFFFFFFFF) - np.arange(len(grams), dtype=np.uint64))
    lows = sliding_minimum(order, shape.left + 1)
    firsts = np.array([b + p.first - p.at for b, p in zip(begins[:-1], run, strict=True)])
    counts = np.array([p.last - p.first for p in run])
    starts = stretches(firsts, counts)
    chosen = (np.uint64(0xFFFFFFFF) - (lows[starts] & np.uint64(0xFFFFFFFF))).astype(np.int64)
    owner = np.repeat(np.arange(len(run)), counts)
    docs, ats, sizes = (np.array(x, dtype=np.int64) for x in ([p.doc for p in run], [p.at for p in run], [p.size for p in run]))
    place = chosen - begins[owner] + ats[owner]
    new = np.concatenate([[True], (np.diff(place) != 0) | (np.diff(docs[owner]) != 0)])
    chosen, owner, place = chosen[new], owner[new], place[new]
    shift = chosen - place
    left, right = np.maximum(place - shape.left, 0), np.minimum(place + shape.length, sizes[owner])
    context = hashes.of(left + shift, right + shift) ^ mixed((place - left).astype(np.uint64))
    return docs[owner], place, grams[chosen], context


def mark_of(text):
    """The hash that tells documents of one id, or of none, apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def seed_rows(docs: DataFrame, symbols_of: Callable[[], Callable[[bytes], np.ndarray]], shape: Shape) -> DataFrame:
    """Anchors of all documents: n members per class of a slice in the row of its first, 0 in the others.

    Equal rows of a slice have one row, and are counted as often as they occur.
    """

    def emit(run: list[Piece], ids: pa.Array, marks: np.ndarray, powers: Powers, last: list) -> pa.RecordBatch:
        doc, place, gram, context = anchors(run, shape, powers)
        if last[0] is not None and len(doc) and (doc[0], place[0]) == last[0]:
            doc, place, gram, context = doc[1:], place[1:], gram[1:], context[1:]
        if len(doc):
            last[0] = (doc[-1], place[-1])
        mark, keys, none = marks[doc], ids.fill_null(0).to_numpy()[doc], ids.is_null().to_numpy(zero_copy_only=False)[doc]
        order = np.lexsort((mark, place, keys, none, context, gram))
        doc, place, mark, gram, context, keys, none = (x[order] for x in (doc, place, mark, gram, context, keys, none))
        opens = np.concatenate([[True], (np.diff(gram) != 0) | (np.diff(context) != 0)])[: len(doc)]
        begins = np.flatnonzero(opens)
        members = np.zeros(len(doc), np.int32)
        members[begins] = np.diff(np.append(begins, len(doc)))
        gram = np.where(opens, gram, mixed(context ^ mixed(place.astype(np.uint64) + mixed(mark.view(np.uint64)) + gram)))
        single = opens | np.concatenate([[True], np.any([x[1:] != x[:-1] for x in (keys, none, place, mark)], axis=0)])[: len(doc)]
        gram, context, doc, place, mark, members = (x[single] for x in (gram, context, doc, place, mark, members))
        return pa.RecordBatch.from_arrays(
            [pa.array(gram.view(np.int64)), pa.array(context.view(np.int64)), ids.take(pa.array(doc)), pa.array(place), pa.array(mark), pa.array(members)],
            names=["gram", "context", "doc_id", "place", "mark", "n"],
        )

    def run_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, powers = symbols_of(), Powers()
        for batch in batches:
            ids, marks = batch.column("doc_id"), batch.column("mark").to_numpy()
            held, size, last = [], 0, [None]
            for i, raw in enumerate(base.raw_texts(batch)):
                for piece in pieces(i, symbols(raw), shape):
                    held.append(piece)
                    size += len(piece.symbols)
                    if size >= shape.slice:
                        yield emit(held, ids, marks, powers, last)
                        held, size = [], 0
            if held:
                yield emit(held, ids, marks, powers, last)

    return docs.select("doc_id", "text", mark_of(F.col("text")).alias("mark")).mapInArrow(run_all, SEEDS)


def classified(rows: DataFrame, keep_first: bool) -> DataFrame:
    """Anchors that repeat: settled ones, all of whose runs repeat, and open ones, to be compared further.

    With `keep_first` a run counts as repeated only after its first occurrence, which all rows with the
    same id and text are together. Each anchor of such rows comes out once.
    """
    dealt = rows.repartition("gram")
    of_class = Window.partitionBy("gram", "context")
    in_order = of_class.orderBy(F.col("doc_id").asc_nulls_last(), "place", "mark")
    of_gram = Window.partitionBy("gram")
    seen = dealt.select(
        "gram",
        "doc_id",
        "place",
        "mark",
        "n",
        F.rank().over(in_order).alias("number"),
        F.row_number().over(in_order).alias("row"),
        F.sum("n").over(of_class).alias("total"),
        (F.min("context").over(of_gram) != F.max("context").over(of_gram)).alias("several"),
    )
    settled = (F.col("n") == 0) | (F.col("number") > 1 if keep_first else F.col("total") > 1)
    opened = F.col("several") & (F.col("row") == 1) & (F.col("n") > 0)
    judged = seen.filter("row = number").select("gram", "doc_id", "place", "mark", settled.alias("settled"), opened.alias("opened"))
    return base.materialize(judged.filter("settled or opened"), "seeds")


def at_documents(docs: DataFrame, rows: DataFrame, *columns: str) -> DataFrame:
    """Texts of documents with the list `items` of their rows: structs of place and the columns; null without any."""
    grouped = rows.groupBy(F.col("doc_id").alias("of"), F.col("mark").alias("of_mark")).agg(F.collect_list(F.struct("place", *columns)).alias("items"))
    own = docs.select("doc_id", "text", mark_of(F.col("text")).alias("mark"))
    return own.join(grouped, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("mark") == F.col("of_mark")), "left").select("doc_id", "text", "mark", "items")


def merged(spans: np.ndarray) -> list[tuple[int, int]]:
    """Sorted spans that neither overlap nor touch, from an array of (begin, end)."""
    if not len(spans):
        return []
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    reach = np.maximum.accumulate(spans[:, 1])
    opens = np.concatenate([[True], spans[1:, 0] > reach[:-1]])
    ends = np.append(np.flatnonzero(opens)[1:], len(spans)) - 1
    return list(zip(spans[opens, 0].tolist(), reach[ends].tolist(), strict=True))
