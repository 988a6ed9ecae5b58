"""Reversible line deduplication: exact reference tables behind sharded cuckoo filters.

A line's key is the line stripped of white space with A-Z lower-cased, held as a 128-bit hash. The index
keeps one reference (key, document) per document and key, in as many shards as it was made with, and
a cuckoo filter per shard. Inserting documents appends references: keys the filter does not know are
new and need no look at the table. Deleting documents takes their references out and, where a key has
none left, its tag out of the filter, so that the index is again what it was without them. Key counts
are exact at any time; a filter only says which lines need to be looked up.

For the verdict, a second filter holds the keys in at least `min_documents` documents. Lines are
dealt to its shards, salted so that a line of a third of all documents is spread over many tasks;
what passes the filter is compared with the exact table, so no filter error reaches the result.

Every row of the documents counts as one document. Null and empty texts are one empty line. Rows
with the same or a null doc_id share the verdict on their lines; null is smaller than any id. Columns
other than doc_id and text pass through. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidebook.llm import base
from tidebook.llm.cuckoo import CuckooFilter

MIN_CHARS = 40
MIN_DOCUMENTS = 5
KEYS_PER_SHARD = 50_000
SALTS = 8
REFS = "key binary, doc_id long"


def line_key(line: str, min_chars: int) -> bytes | None:
    """Hash of a line's key, None for keys too short to count."""
    key = line.strip(base.SPACES)
    if len(key) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key.encode().lower())


def references(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per document and distinct key."""

    def rows(batch: pa.RecordBatch):
        keys: list[bytes] = []
        owner: list[int] = []
        for i, text in enumerate(base.texts(batch)):
            if len(text) >= min_chars:
                own = {k for line in text.split("\n") if (k := line_key(line, min_chars))}
                keys.extend(own)
                owner.extend([i] * len(own))
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.binary()), batch.column("doc_id").take(pa.array(owner, pa.int64()))], names=["key", "doc_id"]
        )

    return base.over_batches(docs.select("doc_id", "text"), rows, REFS)


def key_hashes(column: pa.Array) -> np.ndarray:
    """The first 64 bits of 128-bit keys."""
    if not len(column):
        return np.empty(0, np.uint64)
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u8").reshape(-1, 2)[:, 0]


def shard_of(key: str, shards: int):
    return F.pmod(F.xxhash64(key), F.lit(shards)).cast("int")


def filters(keys: DataFrame, shards: int) -> DataFrame:
    """A cuckoo filter per shard of a table of distinct keys."""

    def build(rows: pa.Table) -> pa.Table:
        blob = CuckooFilter.of(key_hashes(rows.column("key").combine_chunks())).to_bytes()
        return pa.table({"shard": rows.column("shard").slice(0, 1), "filter": pa.array([blob], pa.binary())})

    sharded = keys.select("key").distinct().withColumn("shard", shard_of("key", shards))
    return sharded.groupBy("shard").applyInArrow(build, "shard int, filter binary")


def probe(refs: DataFrame, sieve: DataFrame, shards: int, known: bool = True) -> DataFrame:
    """References whose key a filter knows (or does not), each dealt to its shard under a salt.

    The filters, bounded in size each, are copied to every salt; they arrive before the references of
    their shard, which then stream past.
    """
    salts = F.explode(F.array([F.lit(i) for i in range(SALTS)]))
    held = sieve.select("shard", salts.alias("salt"), "filter", F.lit(None).cast("binary").alias("key"), F.lit(None).cast("long").alias("doc_id"))
    asked = refs.select(
        shard_of("key", shards).alias("shard"), F.pmod(F.hash("doc_id"), F.lit(SALTS)).alias("salt"), F.lit(None).cast("binary").alias("filter"), "key", "doc_id"
    )
    dealt = held.unionByName(asked).repartition("shard", "salt").sortWithinPartitions("shard", "salt", F.col("filter").isNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, sieve_here = None, None
        for batch in batches:
            shard, salt = (batch.column(c).to_numpy() for c in ("shard", "salt"))
            marks = np.flatnonzero(np.diff(shard) | np.diff(salt)) + 1
            for begin, end in zip([0, *marks], [*marks, len(shard)], strict=True):
                part = batch.slice(begin, end - begin)
                if not len(part):
                    continue
                if place != (shard[begin], salt[begin]):
                    place, sieve_here = (shard[begin], salt[begin]), None
                blob = part.column("filter")[0].as_py()
                if blob is not None:
                    sieve_here = CuckooFilter.from_bytes(blob)
                    part = part.slice(1)
                if len(part):
                    hit = np.zeros(len(part), bool) if sieve_here is None else sieve_here.contains(key_hashes(part.column("key")))
                    chosen = part.filter(pa.array(hit == known))
                    yield pa.RecordBatch.from_arrays([chosen.column("key"), chosen.column("doc_id")], names=["key", "doc_id"])

    return dealt.mapInArrow(run, REFS)


@dataclass(frozen=True)
class LineIndex:
    """References of all documents inserted and not deleted, and the filter of their keys."""

    refs: DataFrame
    sieve: DataFrame | None
    shards: int
    min_chars: int = MIN_CHARS

    @classmethod
    def build(cls, docs: DataFrame, min_chars: int = MIN_CHARS, sieve: bool = True) -> LineIndex:
        """An index of documents. Without a filter it can be read and extended, which then builds one."""
        refs = base.materialize(references(docs, min_chars), "line-refs")
        return cls(refs, None, enough_shards(refs), min_chars).sieved() if sieve else cls(refs, None, enough_shards(refs), min_chars)

    def sieved(self) -> LineIndex:
        if self.sieve is not None:
            return self
        return LineIndex(self.refs, base.materialize(filters(self.refs, self.shards), "line-filters"), self.shards, self.min_chars)

    def insert(self, docs: DataFrame) -> LineIndex:
        """The index with more documents.

        Keys that the filter does not know are new; those it seems to know are looked up in the table.
        New keys join the filter of their shard, which is built anew when it is full.
        """
        held = self.sieved()
        added = base.materialize(references(docs, self.min_chars), "line-refs")
        shards = held.shards
        unknown = probe(added, held.sieve, shards, known=False).select("key")
        mistaken = probe(added, held.sieve, shards).select("key").distinct().join(held.refs.select("key"), "key", "left_anti")
        grown = self.edit(held.sieve, unknown.union(mistaken).distinct(), shards, insert=True)
        refs = held.refs.unionByName(added)
        full = grown.filter("filter is null").select("shard")
        anew = refs.select("key").withColumn("shard", shard_of("key", shards)).join(full, "shard", "left_semi")
        sieve = grown.filter("filter is not null").unionByName(filters(anew, shards))
        return LineIndex(refs, base.materialize(sieve, "line-filters"), shards, self.min_chars)

    def delete(self, doc_ids: DataFrame) -> LineIndex:
        """The index without the documents of these ids; keys that nobody holds any more leave the filter."""
        held = self.sieved()
        gone = doc_ids.select(F.col("doc_id").alias("gone")).distinct()
        matches = F.col("doc_id").eqNullSafe(F.col("gone"))
        left = base.materialize(held.refs.join(gone, matches, "left_anti"), "line-refs")
        taken = held.refs.join(gone, matches, "left_semi").select("key").distinct()
        orphans = taken.join(left.select("key"), "key", "left_anti")
        return LineIndex(left, self.edit(held.sieve, orphans, held.shards, insert=False), held.shards, self.min_chars)

    @staticmethod
    def edit(sieve: DataFrame, keys: DataFrame, shards: int, insert: bool) -> DataFrame:
        """Filters with keys put in or taken out, shard by shard."""

        def change(old: pa.Table, new: pa.Table) -> pa.Table:
            hashes = key_hashes(new.column("key").combine_chunks()) if len(new) else np.empty(0, np.uint64)
            shard = old.column("shard") if len(old) else new.column("shard").slice(0, 1)
            if not len(old):
                made = CuckooFilter.of(hashes)
            else:
                made = CuckooFilter.from_bytes(old.column("filter")[0].as_py())
                if not insert:
                    made.delete(hashes)
                elif int((made.tags > 0).sum()) + len(hashes) > 0.9 * made.tags.size or not made.insert(np.unique(hashes)):
                    return pa.table({"shard": shard, "filter": pa.array([None], pa.binary())})
            return pa.table({"shard": shard, "filter": pa.array([made.to_bytes()], pa.binary())})

        sharded = keys.withColumn("shard", shard_of("key", shards))
        edited = sieve.groupBy("shard").cogroup(sharded.groupBy("shard")).applyInArrow(change, "shard int, filter binary")
        return base.materialize(edited, "line-filters")

    def repeated(self, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
        """Keys in at least so many documents, with that number and the largest id, which keeps its lines.

        Rows of one id are one document, rows without an id one each.
        """
        of_id = self.refs.groupBy("key", "doc_id").agg(F.count(F.lit(1)).alias("rows"))
        documents = F.sum(F.when(F.col("doc_id").isNull(), F.col("rows")).otherwise(1)).alias("documents")
        counts = of_id.groupBy("key").agg(documents, F.max("doc_id").alias("keeper"))
        return counts.filter(F.col("documents") >= min_documents)

    def losses(self, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
        """The keys whose lines each document loses: doc_id, keys."""
        repeated = base.materialize(self.repeated(min_documents), "line-repeated")
        shards = enough_shards(repeated)
        passed = probe(self.refs, filters(repeated, shards), shards)
        exact = passed.join(repeated.withColumnRenamed("key", "of"), (F.col("key") == F.col("of")) & ~F.col("doc_id").eqNullSafe(F.col("keeper")))
        return exact.groupBy("doc_id").agg(F.collect_set("key").alias("keys"))


def enough_shards(keys: DataFrame) -> int:
    return max(base.shuffle_partitions(keys.sparkSession), -(-keys.count() // KEYS_PER_SHARD))


def drop_lines(docs: DataFrame, index: LineIndex, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """Documents with the lines that stay, and the numbers of lines before and of lines dropped.

    Columns of the documents that are named n_lines or n_dropped are replaced.
    """
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    losses = index.losses(min_documents).select(F.col("doc_id").alias("__loser"), F.col("keys").alias("__lost"))
    joined = docs.select(*names).join(losses, F.col("doc_id").eqNullSafe(F.col("__loser")), "left").drop("__loser")
    schema = T.StructType([*joined.schema.fields[:-1], T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    min_chars = index.min_chars

    def rows(batch: pa.RecordBatch):
        stay, before, dropped = [], [], []
        for text, lost in zip(base.texts(batch), batch.column("__lost"), strict=True):
            lines = text.split("\n")
            gone = set(lost.as_py() or ())
            left = [line for line in lines if line_key(line, min_chars) not in gone] if gone else lines
            before.append(len(lines))
            dropped.append(len(lines) - len(left))
            stay.append("\n".join(left) if len(left) < len(lines) else text)
        columns = [pa.array(stay, pa.string()) if c == "text" else batch.column(c) for c in names]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(before, pa.int64()), pa.array(dropped, pa.int64())], names=schema.names)

    return base.over_batches(joined, rows, schema)
