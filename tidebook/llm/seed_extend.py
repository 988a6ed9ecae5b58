"""Substring dedup by seed and extend: repeats of words after their first occurrence.

Seeds are winnowed anchors of six words. Documents meet on equal anchors; a match is extended both ways
over the whole stretch that a repeat through the anchor can cover. Where the stretch agrees with an
earlier occurrence, all its windows repeat; where an anchor has several contexts, the extension goes
window by window, and each window is compared with its first occurrence. Windows that repeat join into
maximal repeats of at least `length` words.

A repeat is judged against the input: a window is removed when its words also start earlier, in a
document of smaller id or earlier in the same one. Null ids come last. Null and empty texts have no
words. Rows with the same id and text count as one document and are never earlier than each other;
rows with the same id and other texts are ordered by place. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebook.llm import base, seeds, words

LENGTH = 20
GRAM = 6
SLICE = 1 << 19


def word_symbols():
    powers = words.Powers()
    return lambda raw: words.word_hashes([raw], powers)[0]


def repeated_windows(docs: DataFrame, opened: DataFrame, shape: seeds.Shape) -> DataFrame:
    """Starts of windows around open anchors that also start earlier: doc_id, place, mark."""
    around = seeds.at_documents(docs, opened).filter("items is not null")

    def windows(batches):
        symbols, powers = word_symbols(), seeds.Powers()
        for batch in batches:
            owners, places, found = [], [], []
            for i, (raw, items) in enumerate(zip(base.raw_texts(batch), batch.column("items"), strict=True)):
                own = symbols(raw)
                at = np.unique(np.array([x["place"] for x in items.as_py()], dtype=np.int64))
                low, high = np.maximum(at - shape.left, 0), np.minimum(at, len(own) - shape.length)
                start = np.unique(seeds.stretches(low, high - low + 1))
                found.append(seeds.Hashes(own, powers).of(start, start + shape.length))
                owners.append(np.full(len(start), i))
                places.append(start)
            if owners:
                owner = pa.array(np.concatenate(owners))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(found).view(np.int64)),
                        batch.column("doc_id").take(owner),
                        pa.array(np.concatenate(places)),
                        batch.column("mark").take(owner),
                    ],
                    names=["window", "doc_id", "place", "mark"],
                )

    held = base.materialize(around.mapInArrow(windows, "window long, doc_id long, place long, mark long"), "windows")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "place", "mark")
    first = held.groupBy("window").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    met = held.join(first.withColumnRenamed("window", "of"), F.col("window") == F.col("of"))
    later = ~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("place") == F.col("first.place")) & (F.col("mark") == F.col("first.mark")))
    return met.filter(later).select("doc_id", "place", "mark").distinct()


def repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Documents with the list `items` of stretches that repeat earlier words, as (place, size); null for none."""
    docs = docs.select("doc_id", "text")
    shape = seeds.Shape(length, gram, SLICE)
    found = seeds.classified(seeds.seed_rows(docs, word_symbols, shape), keep_first=True)
    settled = found.filter("settled").select("doc_id", "place", "mark", F.lit(True).alias("anchor"))
    windows = repeated_windows(docs, found.filter("opened"), shape).select("doc_id", "place", "mark", F.lit(False).alias("anchor"))
    return seeds.at_documents(docs, settled.unionByName(windows), "anchor")


def spans_of(items: list[dict] | None, size: int, shape: seeds.Shape) -> list[tuple[int, int]]:
    """Maximal repeats: spans of settled anchors and of windows, joined."""
    if not items:
        return []
    at = np.array([(x["place"], x["anchor"]) for x in items], dtype=np.int64)
    begin = np.where(at[:, 1] == 1, np.maximum(at[:, 0] - shape.left, 0), at[:, 0])
    end = np.minimum(at[:, 0] + shape.length, size)
    return seeds.merged(np.stack([begin, end], axis=1))


def remove(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Texts without their repeats: doc_id, text (kept words joined by a space), n_words, n_removed, spans, kept_sha256."""
    shape = seeds.Shape(length, gram, SLICE)
    pair = pa.list_(pa.struct([("begin", pa.int64()), ("stop", pa.int64())]))

    def cut(batch: pa.RecordBatch):
        texts, sizes, gone, spans, marks = [], [], [], [], []
        for raw, items in zip(base.raw_texts(batch), batch.column("items"), strict=True):
            own = raw.split()
            found = spans_of(items.as_py(), len(own), shape)
            kept, at = [], 0
            for begin, end in found:
                kept += own[at:begin]
                at = end
            kept += own[at:]
            texts.append(b" ".join(kept))
            sizes.append(len(own))
            gone.append(len(own) - len(kept))
            spans.append([{"begin": a, "stop": b} for a, b in found])
            marks.append(hashlib.sha256(texts[-1]).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(texts, pa.binary()).cast(pa.string()),
                pa.array(sizes, pa.int64()),
                pa.array(gone, pa.int64()),
                pa.array(spans, pair),
                pa.array(marks, pa.string()),
            ],
            names=["doc_id", "text", "n_words", "n_removed", "spans", "kept_sha256"],
        )

    schema = "doc_id long, text string, n_words long, n_removed long, spans array<struct<begin: long, stop: long>>, kept_sha256 string"
    return base.over_batches(repeats(docs, length, gram), cut, schema)
