"""Document fingerprints from spot signatures: chains of content words after common-word anchors.

Common words are those in at least `SHARE` of all documents, and in two; they are few whatever the input. Every
common word opens a chain of the next content words, and the set of chains is the fingerprint. Texts
with words but without a chain have one signature, their whole sequence of words. Likeness is the Jaccard
similarity of the sets. `matches` finds all pairs of fingerprints of at least a threshold: equal
fingerprints are one class; classes are partitioned by the length of their sets, so that only neighbouring
partitions can match; within a partition they meet on the rarest signatures of each set, and the
comparison stops as soon as the length bound rules a pair out.

Null and empty texts have the empty fingerprint; two empty ones are alike (1). Equal texts have equal
fingerprints. Rows of one id, and rows without an id, follow each other in the order of a hash of their
texts; null ids come after all others. Repeated rows give repeated rows. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidebook.llm import base
from tidebook.llm.cuckoo import mixed

SHARE = 0.05
CHAIN = 2
DISTANCE = 1
THRESHOLD = 0.8
CACHE = 1 << 20
BUCKETS = 4
EDGES = b".,;:!?\"'()"
FACTORS = [np.uint64(pow(0x9E3779B97F4A7C15, i + 1, 1 << 64)) for i in range(16)]
COMPARED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, n_signatures long, length_class int, edited_is_near boolean"
)


def words_of(raw: bytes) -> list[bytes]:
    return [w for x in raw.lower().split() if (w := x.strip(EDGES))]


def common_words(docs: DataFrame, share: float = SHARE) -> list[bytes]:
    """Words in at least this share of the documents, and in two.

    A word that common is so in some partition: the first pass takes the words that are common in a
    partition, the second counts those in all documents.
    """

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = Counter(), 0
        for batch in batches:
            rows += len(batch)
            for raw in base.raw_texts(batch):
                seen.update(set(words_of(raw)))
        yield pa.RecordBatch.from_arrays([pa.array([w for w, n in seen.items() if n >= share * rows], pa.binary())], names=["word"])

    candidates = [bytes(r["word"]) for r in docs.select("text").mapInArrow(local, "word binary").distinct().collect()]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, seen, rows = set(candidates), Counter(), 0
        for batch in batches:
            rows += len(batch)
            for raw in base.raw_texts(batch):
                seen.update(wanted.intersection(words_of(raw)))
        names = [b"", *seen]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array([rows, *seen.values()], pa.int64())], names=["word", "n"])

    counts = {bytes(r["word"]): r["n"] for r in docs.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()}
    total = counts.pop(b"", 0)
    return sorted(w for w, n in counts.items() if n >= max(2, share * total))


class Spotter(dict):
    """Spot signatures of texts. As a dictionary it remembers words: a hash with the lowest bit set for common ones."""

    def __init__(self, common: list[bytes], chain: int = CHAIN, distance: int = DISTANCE) -> None:
        super().__init__()
        self.common, self.chain, self.distance = frozenset(common), chain, distance

    def __missing__(self, token: bytes) -> int:
        if len(self) > CACHE:
            self.clear()
        word = token.strip(EDGES)
        self[token] = value = (xxhash.xxh3_64_intdigest(word) & ~1 | (word in self.common)) if word else 0
        return value

    def spots(self, raw: bytes) -> np.ndarray:
        """The sorted distinct signatures of a text, 32 bits each."""
        tokens = raw.lower().split()
        words = np.fromiter(map(self.__getitem__, tokens), np.uint64, len(tokens))
        words = words[words != 0]
        if not len(words):
            return np.empty(0, np.uint32)
        is_common = (words & np.uint64(1)) == 1
        content, anchors = np.flatnonzero(~is_common), np.flatnonzero(is_common)
        first = np.searchsorted(content, anchors)
        anchors, first = anchors[first < len(content)], first[first < len(content)]
        if not len(anchors):
            whole = np.cumsum(words * FACTORS[0] ** np.arange(1, len(words) + 1, dtype=np.uint64), dtype=np.uint64)[-1]
            return (mixed(np.array([whole])) >> np.uint64(32)).astype(np.uint32)
        total = words[anchors] * FACTORS[0]
        padded = np.concatenate([words[content], np.zeros(self.chain * self.distance, np.uint64)])
        for link in range(self.chain):
            total += padded[first + link * self.distance] * FACTORS[link + 1]
        return np.unique((mixed(total) >> np.uint64(32)).astype(np.uint32))


def fingerprint(spots: np.ndarray) -> str:
    """A fingerprint as text: base64 of its signatures, little-endian, in order."""
    return base64.b64encode(spots.astype("<u4").tobytes()).decode()


def spots_in(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), "<u4")


def length_class(size: int, threshold: float = THRESHOLD) -> int:
    """Partition of a set by its length; sets that can be alike lie in the same or in adjacent ones."""
    return int(math.log(size) / -math.log(threshold) + 1e-9) if size else -1


def likeness(one: np.ndarray, two: np.ndarray, threshold: float = 0.0) -> float:
    """Jaccard similarity; 0 without looking at the elements where the lengths keep it below the threshold."""
    small, large = sorted((len(one), len(two)))
    if not large:
        return 1.0
    if small < threshold * large or not small:
        return 0.0
    both = len(np.intersect1d(one, two, assume_unique=True))
    return both / (small + large - both)


def fingerprints(docs: DataFrame, common: list[bytes] | None = None) -> DataFrame:
    """The fingerprint of every row: doc_id, fingerprint, n_signatures, length_class."""
    common = common_words(docs) if common is None else common

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spotter = Spotter(common)
        for batch in batches:
            found = [spotter.spots(raw) for raw in base.raw_texts(batch)]
            columns = [batch.column("doc_id"), pa.array([fingerprint(s) for s in found], pa.string()), pa.array([len(s) for s in found], pa.int64())]
            columns.append(pa.array([length_class(len(s)) for s in found], pa.int32()))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "fingerprint", "n_signatures", "length_class"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fingerprint string, n_signatures long, length_class int")


def matches(prints: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """All pairs of different fingerprints at least this alike, and the documents of each.

    The first table has one, two (class ids, one < two) and similarity, the second doc_id and class.
    Classes meet on a signature among the rarest of each, as many as a match could miss and one more.
    """
    keyed = prints.filter("n_signatures > 0").withColumn("class", F.sha2("fingerprint", 256))
    members = keyed.select("doc_id", "class")
    classes = base.materialize(keyed.select("class", "fingerprint", "n_signatures").distinct(), "classes")

    def spell(batch: pa.RecordBatch):
        for name, text in zip(batch.column("class"), batch.column("fingerprint"), strict=True):
            spots = spots_in(text.as_py())
            yield pa.RecordBatch.from_arrays(
                [pa.array([name.as_py()] * len(spots)), pa.array(spots.astype(np.int64)), pa.array([len(spots)] * len(spots), pa.int64())], names=["class", "spot", "size"]
            )

    spelled = base.materialize(base.over_batches(classes, spell, "class string, spot long, size long"), "spots")
    rarity = spelled.groupBy("spot").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").withColumnRenamed("spot", "of")
    ranked = spelled.join(rarity, F.col("spot") == F.col("of"), "left").withColumn("n", F.coalesce("n", F.lit(1)))
    order = Window.partitionBy("class").orderBy("n", "spot")
    rare = ranked.withColumn("number", F.row_number().over(order)).filter(f"number <= size - ceil({threshold} * size) + 1 and n > 1")
    rare = rare.select("class", "spot", "size", F.floor(F.log("size") / -math.log(threshold) + 1e-9).alias("part"))
    one = rare.select(F.col("class").alias("one"), "spot", F.col("size").alias("size_one"), F.explode(F.array("part", F.col("part") + 1, F.col("part") - 1)).alias("part"))
    two = rare.select(F.col("class").alias("two"), "spot", F.col("size").alias("size_two"), "part")
    bound = (F.least("size_one", "size_two") >= threshold * F.greatest("size_one", "size_two")) & (F.col("one") < F.col("two"))
    pairs = one.join(two, ["spot", "part"]).filter(bound).select("one", "two").distinct()
    texts = classes.select("class", "fingerprint")
    pairs = pairs.join(texts.select(F.col("class").alias("one"), F.col("fingerprint").alias("f_one")), "one")
    pairs = pairs.join(texts.select(F.col("class").alias("two"), F.col("fingerprint").alias("f_two")), "two").select("one", "two", "f_one", "f_two")

    def verify(batch: pa.RecordBatch):
        found = [likeness(spots_in(a), spots_in(b), threshold) for a, b in zip(batch.column("f_one").to_pylist(), batch.column("f_two").to_pylist(), strict=True)]
        made = pa.RecordBatch.from_arrays([batch.column("one"), batch.column("two"), pa.array(found, pa.float64())], names=["one", "two", "similarity"])
        yield made.filter(pa.array([x >= threshold for x in found], pa.bool_()))

    return base.over_batches(pairs, verify, "one string, two string, similarity double"), members


def edited_text(text: str, following: str) -> str:
    """The text with its last third replaced by as much of the beginning of the following one."""
    tail = len(text) // 3
    return text[: len(text) - tail] + following[:tail]


def in_buckets(docs: DataFrame) -> DataFrame:
    """Documents dealt to ranges of ids, each with a copy of the row that follows its last: bucket, lent, doc_id, text.

    Rows run from the largest id down, and the first follows the last.
    """
    spark = docs.sparkSession
    count = BUCKETS * base.shuffle_partitions(spark)
    marks = F.array(*[F.lit(i / count) for i in range(1, count)])
    cuts = np.unique(np.array(docs.agg(F.percentile_approx("doc_id", marks, 10 * count).alias("cuts")).first()["cuts"] or [], dtype=np.int64))

    def bucket_of(batch: pa.RecordBatch) -> np.ndarray:
        column = batch.column("doc_id")
        ids = column.fill_null(0).to_numpy(zero_copy_only=False)
        return np.where(column.is_null().to_numpy(zero_copy_only=False), -1, np.searchsorted(cuts, ids, side="right"))

    def number(batch: pa.RecordBatch):
        yield pa.RecordBatch.from_arrays([pa.array(bucket_of(batch), pa.int64()), batch.column("doc_id")], names=["bucket", "doc_id"])

    numbered = base.over_batches(docs.select("doc_id"), number, "bucket long, doc_id long")
    heads = [(r["bucket"], r["head"]) for r in numbered.groupBy("bucket").agg(F.max("doc_id").alias("head")).orderBy("bucket").collect()]
    lent: dict[int | None, list[int]] = {}
    for (_, head), (above, _) in zip(heads, [*heads[1:], *heads[:1]], strict=True):
        lent.setdefault(head, []).append(above)

    def deal(batch: pa.RecordBatch):
        own = bucket_of(batch)
        ids = batch.column("doc_id").to_pylist()
        extra = [(i, to) for i, doc in enumerate(ids) if doc in lent for to in lent[doc]]
        rows = pa.array([*range(len(ids)), *(i for i, _ in extra)], pa.int64())
        bucket = pa.array(np.concatenate([own, np.array([to for _, to in extra], np.int64)]), pa.int64())
        late = pa.array([False] * len(ids) + [True] * len(extra))
        yield pa.RecordBatch.from_arrays([bucket, late, batch.column("doc_id").take(rows), batch.column("text").take(rows)], names=["bucket", "lent", "doc_id", "text"])

    return base.over_batches(docs.select("doc_id", "text"), deal, "bucket long, lent boolean, doc_id long, text string")


def against_next(docs: DataFrame) -> DataFrame:
    """Every row's fingerprint, that of its edited text, and how like it the edited and the next text are."""
    common = common_words(docs)
    order = ["bucket", "lent", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), "text"]
    sorted_rows = in_buckets(docs).repartition("bucket").sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spotter = Spotter(common)
        held: tuple | None = None
        waiting = False
        for batch in batches:
            rows: list[tuple] = []
            columns = (batch.column(c).to_pylist() for c in ("bucket", "lent", "doc_id"))
            for bucket, lent, doc_id, text in zip(*columns, base.texts(batch), strict=True):
                if lent and not waiting:
                    continue
                spots = spotter.spots(text.encode())
                if waiting:
                    rows.append(compared(held, text, spots, spotter))
                held, waiting = (doc_id, text, spots), not lent
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.int32(), pa.bool_()]
                names = [part.split()[0] for part in COMPARED.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    def compared(own: tuple, following: str, next_spots: np.ndarray, spotter: Spotter) -> tuple:
        doc_id, text, spots = own
        changed = edited_text(text, following).encode()
        edited = spotter.spots(changed)
        return (
            doc_id,
            len(text),
            hashlib.sha256(changed).hexdigest(),
            fingerprint(spots),
            fingerprint(edited),
            likeness(spots, edited),
            likeness(spots, next_spots),
            len(spots),
            length_class(len(spots)),
            likeness(spots, edited, THRESHOLD) >= THRESHOLD,
        )

    return sorted_rows.mapInArrow(run, COMPARED)
