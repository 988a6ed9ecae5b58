"""Benchmark decontamination: FM-indexes of training shards searched for the windows of test items.

A shard is a bounded slice of the documents a task reads. Its words become symbols of the benchmark's
vocabulary; a word outside it cannot be in any occurrence, so it only ends a run, and runs shorter than
the shortest window are left out. The shard's index finds every window by backward search, places of
occurrences come from sampled suffix positions, and the spans they cover are merged per document.

Words are maximal strings of letters, digits and characters beyond ASCII, with A-Z lower-cased. An item's
windows are all runs of `window` consecutive words; a shorter item is one window; one without words
has none. Windows are shipped in blocks of bounded size, a pass over the documents per block, so a
benchmark of any size can be used. A document is contaminated when the words hit are at least one
in `dilution`.

Null and empty texts have no words. Every row of the documents gives one row, whatever its id; items
of one id count as one, an item without id has the empty name. Columns besides doc_id and text can be
carried through. Long texts are held once per task. An empty benchmark hits nothing.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidebook.llm import base
from tidebook.llm.fm_index import FMIndex

WINDOW = 13
DILUTION = 20
SHARD_BYTES = 1 << 25
BLOCK_WORDS = 2_000_000
FOUND = "__n_words long, __spans array<struct<begin: long, stop: long>>, __items array<string>"

LOWER = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words(raw: bytes) -> list[bytes]:
    return raw.translate(LOWER).split()


class Phrases:
    """The distinct windows of a block of items, as rows of symbols, and the items of each."""

    def __init__(self, items: list[tuple[str, bytes]], window: int) -> None:
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for name, raw in items:
            ids = tuple(self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(raw))
            for at in range(max(1, len(ids) - window + 1) if ids else 0):
                owners.setdefault(ids[at : at + window], set()).add(name)
        self.lengths = np.array([len(w) for w in owners], dtype=np.int64)
        self.shortest = int(self.lengths.min(initial=window))
        self.rows = np.zeros((len(owners), window), dtype=np.int64)
        for row, ids in zip(self.rows, owners, strict=True):
            row[window - len(ids) :] = ids
        self.names = [sorted(o) for o in owners.values()]


def runs(symbols: np.ndarray, shortest: int) -> np.ndarray:
    """Places of runs of at least so many symbols above 0, each with the 0 after it."""
    ends = np.flatnonzero(symbols == 0)
    starts = np.concatenate([[0], ends[:-1] + 1])
    long = ends - starts >= shortest
    keep = np.zeros(len(symbols) + 1, dtype=np.int64)
    np.add.at(keep, starts[long], 1)
    np.add.at(keep, ends[long] + 1, -1)
    return np.flatnonzero(np.cumsum(keep[:-1]) > 0)


def search_shard(texts: list[bytes], phrases: Phrases) -> Iterator[tuple[int, list[tuple[int, int]], list[str]]]:
    """Words, merged spans hit and names of items found, of every text of a shard."""
    everything: list[bytes] = []
    sizes = np.zeros(len(texts), dtype=np.int64)
    for i, raw in enumerate(texts):
        own = words(raw)
        sizes[i] = len(own)
        everything += own
        everything.append(b"")
    symbols = np.fromiter(map(phrases.vocabulary.get, everything, repeat(0)), np.int64, len(everything))
    del everything
    spans: dict[int, list[tuple[int, int]]] = {}
    names: dict[int, set[str]] = {}
    begins = np.concatenate([[0], np.cumsum(sizes + 1)])
    places = runs(symbols, phrases.shortest) if len(phrases.rows) else np.empty(0, np.int64)
    if len(places):
        index = FMIndex(symbols[places], len(phrases.vocabulary))
        low, high = index.search(phrases.rows, phrases.lengths)
        counts = high - low
        which = np.repeat(np.arange(len(counts)), counts)
        rows = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(low, counts)
        found = places[index.locate(rows)]
        cover = np.zeros(len(symbols) + 1, dtype=np.int64)
        np.add.at(cover, found, 1)
        np.add.at(cover, found + phrases.lengths[which], -1)
        hit = np.diff(np.concatenate([[0], (np.cumsum(cover) > 0).astype(np.int8)]))
        first, stop = np.flatnonzero(hit == 1), np.flatnonzero(hit == -1)
        for a, b, doc in zip(first.tolist(), stop.tolist(), (np.searchsorted(begins, first, side="right") - 1).tolist(), strict=True):
            spans.setdefault(doc, []).append((a - int(begins[doc]), b - int(begins[doc])))
        pairs = np.unique(np.stack([np.searchsorted(begins, found, side="right") - 1, which]), axis=1)
        for doc, phrase in pairs.T.tolist():
            names.setdefault(doc, set()).update(phrases.names[phrase])
    for i, size in enumerate(sizes.tolist()):
        yield size, spans.get(i, []), sorted(names.get(i, ()))


def slices(batch: pa.RecordBatch, limit: int = SHARD_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch cut so that no slice of more than one row holds more text than the limit."""
    sizes = np.array([len(t) for t in base.raw_texts(batch)])
    begin, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > limit:
            yield batch.slice(begin, i - begin)
            begin, held = i, 0
        held += size
    yield batch.slice(begin)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def item_blocks(benchmark: DataFrame, block_words: int) -> Iterator[list[tuple[str, bytes]]]:
    """The items in blocks of about so many words, by a hash of the item."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name"), F.coalesce("text", F.lit("")).alias("text"))
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // (4 * block_words)))
    for block in range(blocks):
        own = items if blocks == 1 else items.filter(F.pmod(F.xxhash64("name", "text"), F.lit(blocks)) == block)
        yield [(r["name"], r["text"].encode()) for r in own.toLocalIterator()]


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, carry: tuple[str, ...] = ("doc_id",), block_words: int = BLOCK_WORDS) -> DataFrame:
    """Documents' carried columns with __n_words, __spans (word places, merged) and __items."""
    held = docs.select(*carry, *(["text"] if "text" not in carry else []))
    blocks = list(item_blocks(benchmark, block_words)) if block_words else []
    for number, items in enumerate(blocks):
        last = number == len(blocks) - 1
        names = [c for c in held.columns if not c.startswith("__")]
        names = [c for c in names if c != "text" or "text" in carry or not last]
        extra = T.StructType.fromDDL(FOUND)
        schema = T.StructType([*(held.schema[c] for c in names), *extra.fields])
        held = held.mapInArrow(finder(items, window, names), schema)
    return held


def finder(items: list[tuple[str, bytes]], window: int, names: list[str]):
    packed = zlib.compress(b"\0".join(name.encode() + b"\1" + raw.translate(LOWER) for name, raw in items))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [tuple(item.split(b"\1", 1)) for item in zlib.decompress(packed).split(b"\0") if item]
        phrases = Phrases([(name.decode(), raw) for name, raw in rows], window)
        span = pa.list_(pa.struct([("begin", pa.int64()), ("stop", pa.int64())]))
        for batch in batches:
            for part in slices(batch):
                found = list(search_shard(list(base.raw_texts(part)), phrases))
                earlier = part.schema.get_field_index("__spans") >= 0
                old_spans = part.column("__spans").to_pylist() if earlier else [[]] * len(part)
                old_items = part.column("__items").to_pylist() if earlier else [[]] * len(part)
                spans = [merged([*((s["begin"], s["stop"]) for s in o), *f[1]]) for o, f in zip(old_spans, found, strict=True)]
                named = [sorted({*o, *f[2]}) for o, f in zip(old_items, found, strict=True)]
                columns = [part.column(c) for c in names]
                columns += [pa.array([f[0] for f in found], pa.int64())]
                columns += [pa.array([[{"begin": a, "stop": b} for a, b in s] for s in spans], span), pa.array(named, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "__n_words", "__spans", "__items"])

    return run


def judge(found: DataFrame, dilution: int = DILUTION) -> DataFrame:
    """Adds n_words, n_hit, n_items, items_sha256 and contaminated to what `find` returned."""
    hit = F.aggregate("__spans", F.lit(0).cast("long"), lambda total, s: total + s["stop"] - s["begin"])
    own = [F.col(c) for c in found.columns if not c.startswith("__")]
    counted = found.select(*own, F.col("__n_words").alias("n_words"), hit.alias("n_hit"), F.size("__items").cast("long").alias("n_items"), "__spans", "__items")
    named = F.sha2(F.array_join("__items", ",").cast("binary"), 256)
    bad = (F.col("n_hit") > 0) & (dilution * F.col("n_hit") >= F.col("n_words"))
    return counted.withColumn("items_sha256", named).withColumn("contaminated", bad)


def digest_of(names: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
