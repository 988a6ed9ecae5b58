"""Similarity join on word shingles by the pigeonhole principle over a partition of the universe.

Two sets with Jaccard similarity of `percent` differ in at most H = (100 - percent) / (100 + percent) of
their summed sizes. Shingles are hashed into m segments; if the segments that the two sets agree on
exactly (allowance 1) or up to one element (allowance 2) have allowances that sum to more than H, one
of them shows the pair. m and the number of segments with allowance 2 are chosen per size band, by cost:
rows to post against accidental agreement expected among the sets of the band. A set posts a key per
segment subset, and for allowance 2 also the keys of the subset with one element deleted. Sets near the
top of a band post in the next one as well.

Empty segments are not posted, and keys of more than `FREQUENT` sets are put aside, as long as the rest of
the set's allowances still exceeds H; each band holds a reserve for that. Only two sets that both run out
of it can be linked without sharing another key, and those meet in a different way: every frequent key
has a pivot, the set that holds most frequent keys; a pivot that shares half of a stronger one hands
its sets to that. Two sets differ by exactly as much as their differences from a common pivot differ, and
if they are linked, though not both to the pivot, these differences share some elements; prefixes of them,
those outside the pivot first, suffice to find the pair.

Sets that share a key are not paired with each other: each is compared with one set of the key, which settles
keys of two sets. Only where other keys still join several components are the remaining pairs between components
looked at. Such a pair must share as many keys as the pigeonhole demands of a link, a set with fewer keys in all is
out beforehand, and its sketches must be close enough: a sketch
holds the parity of the number of elements in each of a fixed number of classes, so two sets differ by at
least as many elements as their sketches differ in bits. Keys travel with a sketch folded to a quarter, which
counts classes together; the whole one is looked at for the pairs that pass. Texts move for the pairs that are
left. Every comparison is exact, on the sets themselves. Equal sets are merged and keys combined within slices
before the shuffle. Lists that are mostly short, such as frequent keys and pairs, are written before they are
joined, so that Spark knows their size and the large side moves only if they are long. Where it does, both ends of
the pairs read one shuffle of it: it is joined under its own column names, and renamed after.

Null and empty texts have no shingles and no links; texts with fewer words than a shingle are one
shingle. The join runs on a key of id and text, so other texts of an id, or without one, are linked on
their own; rows with equal id and text are one set. A component is named by its least id; null ids are
larger than any other. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidebook.llm import base
from tidebook.llm.components import components, merged
from tidebook.llm.cuckoo import mixed
from tidebook.llm.words import Powers, word_hashes

SHINGLE = 4
PERCENT = 85
GROWTH = 1.4
CHANCE = 0.01
FREQUENT = 64
SPARE = 0.1
SHARP = 16
FOLD = 4
SAME_PIVOT = 50
SHARES = 64
ROWS = 1 << 19
POSTED = "key long, sig long, doc long, info int, n int, leader long"
FACTORS = [np.uint64(pow(0x9E3779B97F4A7C15, i + 1, 1 << 64)) for i in range(64)]


def shingles(raws: list[bytes], size: int, powers: Powers) -> Iterator[np.ndarray]:
    """The sorted distinct hashes of the shingles of each text."""
    for ids in word_hashes(raws, powers, lower=True):
        if not len(ids):
            yield ids
            continue
        width = min(size, len(ids))
        total = np.full(len(ids) - width + 1, width, np.uint64)
        for i in range(width):
            total += ids[i : len(ids) - width + 1 + i] * FACTORS[i]
        elements = np.sort(mixed(total))
        yield elements[np.concatenate([[True], elements[1:] != elements[:-1]])]


def most_different(total: int, percent: int) -> int:
    """The largest symmetric difference of a linked pair with so many elements in sum."""
    return (100 - percent) * total // (100 + percent)


@dataclass(frozen=True)
class Band:
    """Sizes from `low` to below `high`: segments, how many have allowance 2, and the difference allowed."""

    low: int
    high: int
    segments: int = 1
    deep: int = 0
    most: int = 0


def allocate(low: int, high: int, percent: int, sets: int) -> Band:
    """The cheapest allocation for a band: rows per set, and sets expected to agree by accident."""
    most = most_different(2 * (high - 1), percent)
    middle = (low + high - 1) / 2
    best = None
    for segments in range(max(1, (most + 2) // 2), 2 * most + 16):
        filled = middle / segments
        empty = segments * math.exp(-filled)
        reserve = math.ceil(empty + 5 * math.sqrt(empty)) + math.ceil(SPARE * most) if most else 0
        deep = max(0, most + 1 + reserve - segments)
        if deep <= segments:
            cost = segments + deep * filled + sets * segments * CHANCE**filled
            if best is None or cost < best[0]:
                best = (cost, Band(low, high, segments, deep, most))
    return best[1] if best else Band(low, high, most + 1, 0, most)


def band_edges(largest: int) -> list[int]:
    edges = [1]
    while edges[-1] <= largest:
        edges.append(max(edges[-1] + 1, int(edges[-1] * GROWTH)))
    return edges


def bands_of(sizes: DataFrame, percent: int) -> list[Band]:
    """Allocations for all bands that have sets, by the number of sets in each."""
    largest = sizes.agg(F.max("n_shingles")).first()[0] or 0
    edges = band_edges(largest)
    place = F.lit(0)
    for i, edge in enumerate(edges):
        place = F.when(F.col("n_shingles") >= edge, i).otherwise(place) if i else F.lit(0)
    counted = sizes.filter("n_shingles > 0").groupBy(place.alias("band")).count().collect()
    counts = {r["band"]: r["count"] for r in counted}
    return [allocate(low, high, percent, counts.get(i, 0) + counts.get(i - 1, 0)) for i, (low, high) in enumerate(zip(edges, edges[1:], strict=False))]


class Poster:
    """Keys of sets in the bands where they take part."""

    def __init__(self, bands: list[Band], percent: int) -> None:
        self.bands, self.percent = bands, percent
        self.lows = np.array([b.low for b in bands])
        self.cuts = [np.array([((1 << 64) * i) // b.segments for i in range(1, b.segments)], dtype=np.uint64) for b in bands]
        self.salts = [mixed(np.arange(b.segments, dtype=np.uint64) + np.uint64(i << 32) + np.uint64(1)) for i, b in enumerate(bands)]

    def post(self, elements: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(keys, info) of a set in its own band and in those above that hold possible partners."""
        for number in self.bands_for(len(elements)):
            yield self.keys(elements, number)

    def bands_for(self, size: int) -> Iterator[int]:
        own = int(np.searchsorted(self.lows, size, side="right")) - 1
        while size and own < len(self.bands) and (size >= self.bands[own].low or 100 * size >= self.percent * self.bands[own].low):
            yield own
            own += 1

    def keys(self, elements: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
        band = self.bands[number]
        ends = np.concatenate([[0], np.searchsorted(elements, self.cuts[number]), [len(elements)]])
        marks = mixed(elements ^ np.uint64(0x5BD1E9955BD1E995))
        sums = np.diff(np.concatenate([np.zeros(1, np.uint64), np.cumsum(marks, dtype=np.uint64)])[ends])
        sizes = np.diff(ends)
        deep = np.arange(band.segments) < band.deep
        allowed = np.where(sizes == 0, 0, np.where(deep & (sizes > 1), 2, 1))
        slack = int(allowed.sum()) - band.most - 1
        posted = np.ones(band.segments, bool) if slack < 0 else sizes > 0
        keys = [mixed(sums + self.salts[number])[posted]]
        weights = [np.where(deep, 2, 1)[posted]]
        for i in range(band.deep):
            if sizes[i] > (0 if slack < 0 else 1):
                own = marks[ends[i] : ends[i + 1]]
                keys.append(mixed(sums[i] - own + self.salts[number][i]))
                weights.append(np.ones(len(own), np.int64))
        weight = np.concatenate(weights)
        return np.concatenate(keys), (((max(slack, -1) + 1) * 128 + number) * 4 + weight).astype(np.int32)


def sketch_of(elements: np.ndarray, most: int) -> np.ndarray:
    """Parities of a set in classes of its elements, `SHARP` bits for each element of the difference allowed."""
    bits = 64 * max(1, -(-SHARP * most // 64))
    classes = mixed(elements + np.uint64(0xD6E8FEB86659FD93)) % np.uint64(bits)
    return np.packbits((np.bincount(classes.astype(np.int64), minlength=bits) & 1).astype(np.uint8)).view(np.int64)


def folded(sketch: np.ndarray) -> np.ndarray:
    """A sketch in a `FOLD`-th of its words: the parities of several of its classes together."""
    words = -(-len(sketch) // FOLD)
    padded = np.concatenate([sketch, np.zeros(-len(sketch) % words, np.int64)])
    return np.bitwise_xor.reduce(padded.reshape(-1, words), axis=0)


def lists(values: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *(len(v) for v in values)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.empty(0, np.int64), *values]), pa.int64()))


def may_link(percent: int) -> F.Column:
    """Whether the sketches of two sets, columns marked x and y, leave room for a link."""
    apart = F.aggregate(F.zip_with("sketch_x", "sketch_y", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda total, n: total + n)
    return apart * (100 + percent) <= (100 - percent) * (F.col("size_x") + F.col("size_y"))


def row_key() -> F.Column:
    """62 bits of id and text, by which rows are told apart."""
    return base.spread(F.col("doc_id").isNull(), "doc_id", F.coalesce("text", F.lit("")))


def set_sizes(rows: DataFrame, size: int) -> DataFrame:
    """Number of distinct shingles of every keyed row: doc_id, key, n_shingles."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            counts = [len(elements) for elements in shingles(list(base.raw_texts(batch)), size, powers)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), pa.array(counts, pa.int64())], names=["doc_id", "key", "n_shingles"])

    return rows.mapInArrow(count, "doc_id long, key long, n_shingles long")


def post_keys(rows: DataFrame, size: int, bands: list[Band], percent: int) -> DataFrame:
    """Keys of all sets, combined per slice.

    n > 0: the least document of a slice with this key, of n. n = 0: another one, under a key of its own,
    with its `sig` and the least as leader. n = -1: a document whose set equals its leader's.
    """

    def packed(docs_: list, keys: list, infos: list, twins: list) -> pa.RecordBatch:
        doc = np.repeat(np.array(docs_, np.int64), [len(k) for k in keys])
        key, info = np.concatenate([np.empty(0, np.uint64), *keys]), np.concatenate([np.empty(0, np.int32), *infos])
        order = np.lexsort((doc, key))
        doc, key, info = doc[order], key[order], info[order]
        repeat = np.concatenate([[False], (np.diff(key) == 0) & (np.diff(doc) == 0)])[: len(key)]
        doc, key, info = doc[~repeat], key[~repeat], info[~repeat]
        first = np.concatenate([[True], np.diff(key) != 0])[: len(key)]
        begins = np.flatnonzero(first)
        members = np.diff(np.append(begins, len(key)))
        n = np.zeros(len(key), np.int32)
        n[begins] = members
        leader = np.repeat(doc[begins], members)
        alone = mixed(key ^ mixed(doc.astype(np.uint64)))
        twin = np.array(twins, np.int64).reshape(-1, 2)
        spread = mixed(mixed(twin[:, 0].astype(np.uint64)) + np.uint64(7))
        none = np.zeros(len(twin), np.int64)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([np.where(first, key, alone), spread]).view(np.int64)),
                pa.array(np.concatenate([key.view(np.int64), none]), mask=np.concatenate([first, none == 0])),
                pa.array(np.concatenate([doc, twin[:, 0]])),
                pa.array(np.concatenate([info, none.astype(np.int32)])),
                pa.array(np.concatenate([n, (none - 1).astype(np.int32)])),
                pa.array(np.concatenate([leader, twin[:, 1]]), mask=np.concatenate([first, none != 0])),
            ],
            names=["key", "sig", "doc", "info", "n", "leader"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, poster = Powers(), Poster(bands, percent)
        for batch in batches:
            ids = batch.column("key").to_pylist()
            sets: dict[bytes, tuple[int, np.ndarray]] = {}
            twins: list[tuple[int, int]] = []
            held = 0
            for doc, elements in zip(ids, shingles(list(base.raw_texts(batch)), size, powers), strict=True):
                if not len(elements):
                    continue
                mark = elements.tobytes() if len(elements) < 16 else mixed(elements).sum(dtype=np.uint64).tobytes() + elements[:8].tobytes()
                if mark in sets and np.array_equal(sets[mark][1], elements):
                    least = sets[mark][0]
                    twins.append((max(doc, least), min(doc, least)))
                    sets[mark] = (min(doc, least), elements)
                    continue
                sets[mark] = (doc, elements)
                held += len(elements) + 8
                if held > 4 * ROWS:
                    yield from flush(sets, twins, poster)
                    sets, twins, held = {}, [], 0
            yield from flush(sets, twins, poster)

    def flush(sets: dict, twins: list, poster: Poster) -> Iterator[pa.RecordBatch]:
        docs_, keys, infos = [], [], []
        for doc, elements in sets.values():
            for key, info in poster.post(elements):
                docs_.append(doc)
                keys.append(key)
                infos.append(info)
        yield packed(docs_, keys, infos, [t for t in twins if t[0] != t[1]])

    return rows.select("key", "text").mapInArrow(run, POSTED)


def meetings(posted: DataFrame) -> DataFrame:
    """Keys held by several documents: sig, doc, info, leader, total (documents per key, as far as known)."""
    of_key = Window.partitionBy("key")
    least = F.min(F.when(F.col("n") > 0, F.col("doc"))).over(of_key)
    total = F.sum(F.when(F.col("n") > 0, F.col("n"))).over(of_key)
    met = posted.repartition("key").select("key", "sig", "doc", "info", "n", "leader", least.alias("least"), total.alias("total"))
    met = met.filter("n <= 0 or total > 1")
    sig = F.when(F.col("n") > 0, F.col("key")).otherwise(F.col("sig"))
    leader = F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("leader"))
    return base.materialize(met.select(sig.alias("sig"), "doc", "info", "n", leader.alias("leader"), "total"), "meetings")


def parted(met: DataFrame, frequent: int) -> tuple[DataFrame, DataFrame]:
    """Meetings on other than frequent keys, and those on frequent keys of sets that cannot do without.

    `demand` is the number of keys of the first kind that a link of the set needs. `settled`: a key of two sets, whose
    pair is compared as a set with its leader. `direct`: the key may be one of these, so that the pair is compared
    however few keys it shares.
    """
    slack, instance, weight = F.expr("info div 512 - 1"), F.expr("(info div 4) % 128"), F.expr("info % 4")
    two = F.expr("n > 0 and total = 2")
    rows = met.filter("n >= 0").select("sig", "doc", "leader", slack.alias("slack"), instance.alias("instance"), weight.alias("weight"), two.alias("settled"), F.expr("n = 0").alias("inner"))
    hot = base.materialize(met.filter(F.col("total") > frequent).select(F.col("sig").alias("hot")).distinct(), "hot")
    marked = rows.join(hot, F.col("sig") == F.col("hot"), "left")
    lost = marked.filter("hot is not null").groupBy(F.col("doc").alias("d"), F.col("instance").alias("i")).agg(F.sum("weight").alias("lost"))
    lost = base.materialize(lost, "lost")
    judged = marked.join(lost, (F.col("doc") == F.col("d")) & (F.col("instance") == F.col("i")), "left").withColumn("lost", F.coalesce("lost", F.lit(0)))
    demand = F.greatest(F.col("slack") - F.col("lost") + 1, F.lit(1))
    kinds = ("settled", F.expr("settled or inner").alias("direct"))
    judged = base.materialize(judged.select("sig", "doc", "leader", "instance", *kinds, "hot", demand.alias("demand"), (F.col("lost") > F.col("slack")).alias("short")), "parted")
    return judged.filter("hot is null").drop("hot", "short"), judged.filter("hot is not null and short").select("sig", "doc")


def bonds_of(rows: DataFrame) -> DataFrame:
    """Sets and leaders with the keys they share: doc, leader, instance, shared, demand, direct.

    Sets that have fewer keys than a link of theirs demands are left out; a set that leads a key is there with itself.
    """
    met = rows.groupBy("doc", "leader", "instance").agg(F.count(F.lit(1)).alias("shared"), F.max("demand").alias("demand"), F.max("direct").alias("direct"))
    held = met.withColumn("held", F.sum("shared").over(Window.partitionBy("doc", "instance")))
    return base.materialize(held.filter("held >= demand").drop("held"), "bonds")


def pivots_of(hot: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """Each set of a frequent key with the key's pivot, or the strongest that this one leads to: a, b.

    A pivot that holds keys of stronger pivots and shares half of one of them is replaced by the strongest such.
    """
    held = hot.groupBy(F.col("doc").alias("holder")).agg(F.count(F.lit(1)).alias("held"))
    ranked = hot.join(held, F.col("doc") == F.col("holder")).select("sig", "doc", "held")
    best = ranked.groupBy(F.col("sig").alias("of")).agg(F.max(F.struct("held", (-F.col("doc")).alias("low"))).alias("best"))
    met = hot.join(best, F.col("sig") == F.col("of")).select(F.col("doc").alias("a"), (-F.col("best.low")).alias("b"), "best")
    met = base.materialize(met.distinct(), "pivots")
    between = met.filter("a <> b").join(met.select(F.col("b").alias("pivot")).distinct(), F.col("a") == F.col("pivot"), "left_semi")
    between = base.materialize(between.select("a", "b", "best"), "between")
    close = linked(between.select("a", "b"), texts, size, SAME_PIVOT)
    led = between.join(close, ["a", "b"]).groupBy(F.col("a").alias("weak")).agg((-F.max("best")["low"]).alias("strong"))
    led = base.materialize(led, "led")
    while True:
        onward = led.select(F.col("weak").alias("via"), F.col("strong").alias("further"))
        moved = led.join(onward, F.col("strong") == F.col("via"), "left").select("weak", F.coalesce("further", "strong").alias("strong"), "further")
        moved = base.materialize(moved, "led")
        led = moved.select("weak", "strong")
        if moved.filter("further is not null").isEmpty():
            break
    met = met.join(led, F.col("b") == F.col("weak"), "left").select("a", F.coalesce("strong", "b").alias("b"))
    return base.materialize(met.filter("a <> b").distinct(), "pivots")


def texts_of_pairs(pairs: DataFrame, texts: DataFrame, shares: int = 1) -> DataFrame:
    """Pairs (a, b), a table, with both texts; the pairs of one b are dealt to so many tasks."""
    salted = pairs.withColumn("share", F.pmod(F.xxhash64("a"), F.lit(shares)))
    first = salted.join(texts, F.col("a") == F.col("doc")).select("a", "b", "share", F.col("text").alias("one"))
    second = (F.col("doc").alias("b"), F.col("text").alias("two"))
    if shares == 1:
        ends = pairs.select(F.col("b").alias("end"))
        return first.join(texts.join(ends, F.col("doc") == F.col("end"), "left_semi").select(*second), "b").select("a", "b", "one", "two")
    spread = salted.select(F.col("b").alias("end"), "share").distinct().join(texts, F.col("end") == F.col("doc"))
    return first.join(spread.select("share", *second), ["b", "share"]).select("a", "b", "one", "two")


DIFFERENCES = "a long, b long, linked boolean, size long, n_new long, n_gone long, early int, keys array<long>, sketch array<long>"


def from_pivots(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Differences of sets from their pivots: a, b, linked, and in `keys` the elements by which the set can be found.

    With d the size of the difference and M the most that the set differs from any partner, a partner that
    is not linked to the pivot shares at least (d + H(pivot) - H(set)) / 2 elements of the difference, H being
    what the pigeonhole allows for their sizes, and one that is linked to it shares at least d - M and one.
    The first d - least + 1 elements of one order of all, those outside the pivot first, then share
    one. The first `early` are those for partners that are not linked.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            for part in range(0, len(batch), 256):
                yield differences(batch.slice(part, 256), powers)

    def differences(batch: pa.RecordBatch, powers: Powers) -> pa.RecordBatch:
        twos = list(base.raw_texts(batch, "two"))
        distinct = list(dict.fromkeys(twos))
        known = dict(zip(distinct, shingles(distinct, size, powers), strict=True))
        pivots = batch.column("b").to_numpy()
        facts: list[tuple] = []
        keys, sketches = [], []
        for i, (own, two) in enumerate(zip(shingles(list(base.raw_texts(batch, "one")), size, powers), twos, strict=True)):
            pivot = known[two]
            new, gone = np.setdiff1d(own, pivot, assume_unique=True), np.setdiff1d(pivot, own, assume_unique=True)
            apart = len(new) + len(gone)
            link = len(own) > 0 and apart <= most_different(len(own) + len(pivot), percent)
            most = most_different(len(own) + 100 * len(own) // percent, percent)
            half = max(1, (apart - -(-(100 - percent) * max(0, len(own) - len(pivot)) // (100 + percent)) + 1) // 2)
            early = apart - (half if link else max(half, apart - most)) + 1 if apart else 0
            given = early if link else apart - max(1, apart - most) + 1
            prefix = np.concatenate([np.sort(new), np.sort(gone)])[:given]
            keys.append(mixed(prefix ^ mixed(pivots[i : i + 1])).view(np.int64))
            sketches.append(sketch_of(own, most_different(2 * len(pivot), percent)))
            facts.append((link, len(own), len(new), len(gone), early))
        kinds = [pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
        columns = [batch.column("a"), batch.column("b"), *(pa.array([f[i] for f in facts], kind) for i, kind in enumerate(kinds)), lists(keys), lists(sketches)]
        return pa.RecordBatch.from_arrays(columns, names=[part.split()[0] for part in DIFFERENCES.split(", ")])

    return base.materialize(texts_of_pairs(pairs, texts, SHARES).mapInArrow(compare, DIFFERENCES), "differences")


def across_pivots(apart: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components whose differences from a pivot share an element and whose sketches are close: a, b.

    At least one of the two is not linked to the pivot. Sets linked to a pivot take part where others are not.
    """
    found = apart.join(labels, F.col("a") == F.col("node"), "left").withColumn("component", F.coalesce("component", "a"))
    far = found.filter("not linked")
    near = found.filter("linked").join(far.select(F.col("b").alias("pivot")).distinct(), F.col("b") == F.col("pivot"), "left_semi")

    def side(rows: DataFrame, mark: str) -> DataFrame:
        names = ("a", "component", "size", "n_new", "n_gone", "early", "linked", "sketch")
        return rows.select(F.posexplode("keys").alias("place", f"key_{mark}"), *(F.col(n).alias(f"{n}_{mark}") for n in names)).withColumnRenamed("place", f"place_{mark}")

    others = far.withColumn("keys", F.slice("keys", F.lit(1), F.col("early"))).unionByName(near)
    of_two = F.col("linked_y") | ((F.col("place_x") < F.col("early_x")) & (F.col("a_x") < F.col("a_y")))
    unlike = F.abs(F.col("n_new_x") - F.col("n_new_y")) + F.abs(F.col("n_gone_x") - F.col("n_gone_y"))
    sized = unlike * (100 + percent) <= (100 - percent) * (F.col("size_x") + F.col("size_y"))
    on = (F.col("key_x") == F.col("key_y")) & (F.col("component_x") != F.col("component_y")) & of_two & sized & may_link(percent)
    met = side(far, "x").join(side(others, "y"), on)
    return met.select(F.greatest("a_x", "a_y").alias("a"), F.least("a_x", "a_y").alias("b"))


def sketched(texts: DataFrame, size: int, bands: list[Band], percent: int) -> DataFrame:
    """The sketch of every set for each band where it takes part, whole and folded: of, band, size, sketch, folded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, poster = Powers(), Poster(bands, percent)
        for batch in batches:
            at, numbers, sizes, found = [], [], [], []
            for i, elements in enumerate(shingles(list(base.raw_texts(batch)), size, powers)):
                for number in poster.bands_for(len(elements)):
                    at.append(i)
                    numbers.append(number)
                    sizes.append(len(elements))
                    found.append(sketch_of(elements, bands[number].most))
            columns = [batch.column("doc").take(pa.array(at, pa.int64())), pa.array(numbers, pa.int32()), pa.array(sizes, pa.int64()), lists(found), lists([folded(x) for x in found])]
            yield pa.RecordBatch.from_arrays(columns, names=["of", "band", "size", "sketch", "folded"])

    schema = "of long, band int, size long, sketch array<long>, folded array<long>"
    return base.materialize(texts.select("doc", "text").mapInArrow(run, schema), "sketches")


def still_close(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of a band, `instance`, whose whole sketches leave room for a link: a, b."""
    whole = sketches.select("of", "band", "size", "sketch")
    for end, mark in (("b", "y"), ("a", "x")):
        pairs = pairs.join(whole, (F.col(end) == F.col("of")) & (F.col("instance") == F.col("band"))).drop("of", "band")
        pairs = pairs.withColumnsRenamed({"size": f"size_{mark}", "sketch": f"sketch_{mark}"})
    return pairs.filter(may_link(percent)).select("a", "b").distinct()


def linked(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Of different pairs (a, b) those whose sets are similar enough, by comparing the sets."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            ones, twos = list(base.raw_texts(batch, "one")), list(base.raw_texts(batch, "two"))
            distinct = list(dict.fromkeys(twos))
            known = dict(zip(distinct, shingles(distinct, size, powers), strict=True))
            keep = []
            for other, two in zip(shingles(ones, size, powers), twos, strict=True):
                elements = known[two]
                both = len(np.intersect1d(other, elements, assume_unique=True))
                keep.append(both > 0 and 100 * both >= percent * (len(other) + len(elements) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return base.materialize(texts_of_pairs(pairs, texts).mapInArrow(compare, "a long, b long"), "links")


def across_components(rows: DataFrame, labels: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs of sets of different components that share as many keys as a link demands and whose sketches are close: a, b."""
    of_key = Window.partitionBy("sig")
    labelled = rows.join(labels, F.col("doc") == F.col("node"), "left").select("sig", "doc", "instance", "demand", F.coalesce("component", "doc").alias("component"))
    several = labelled.withColumn("least", F.min("component").over(of_key)).withColumn("most", F.max("component").over(of_key)).filter("least <> most")
    several = several.join(sketches, (F.col("doc") == F.col("of")) & (F.col("instance") == F.col("band")))
    several = several.select("sig", "doc", "instance", "demand", "component", "size", F.col("folded").alias("sketch"))
    several = base.materialize(several, "several")
    one, two = (several.select(*(F.col(c).alias(f"{c}_{mark}") for c in several.columns)) for mark in "xy")
    same = (F.col("sig_x") == F.col("sig_y")) & (F.col("instance_x") == F.col("instance_y"))
    met = one.join(two, same & (F.col("component_x") < F.col("component_y")) & may_link(percent))
    shared = met.groupBy("doc_x", "doc_y", "instance_x").agg(F.count(F.lit(1)).alias("shared"), F.max(F.greatest("demand_x", "demand_y")).alias("demand"))
    ends = (F.greatest("doc_x", "doc_y").alias("a"), F.least("doc_x", "doc_y").alias("b"))
    near = base.materialize(shared.filter("shared >= demand").select(*ends, F.col("instance_x").alias("instance")), "near")
    return still_close(near, sketches, percent)


def joined(docs: DataFrame, size: int, percent: int, frequent: int = FREQUENT) -> tuple[DataFrame, DataFrame]:
    """Every row with its key and number of shingles (doc_id, key, n_shingles), and the component of linked keys (node, component)."""
    docs = docs.select("doc_id", row_key().alias("key"), "text")
    sizes = base.materialize(set_sizes(docs, size), "sizes")
    bands = bands_of(sizes, percent)
    met = meetings(post_keys(docs, size, bands, percent))
    twins = met.filter("n < 0").select(F.col("doc").alias("a"), F.col("leader").alias("b"))
    rows, hot = parted(met, frequent)

    bonds = bonds_of(rows)
    members = bonds.select("doc").union(hot.select("doc")).distinct()
    own = docs.select(F.col("key").alias("doc"), "text").join(members, "doc", "left_semi")
    texts = base.materialize(own.groupBy("doc").agg(F.first("text").alias("text")), "texts")

    stars = bonds.filter("doc <> leader and (direct or shared >= demand)").select(F.col("doc").alias("a"), F.col("leader").alias("b"), "instance")
    sketches = sketched(texts, size, bands, percent)
    stars = base.materialize(still_close(stars, sketches, percent), "close-stars")
    apart = from_pivots(pivots_of(hot, texts, size), texts, size, percent)
    links = linked(stars, texts, size, percent).union(twins).union(apart.filter("linked").select("a", "b"))
    labels = components(links)

    pairs = across_components(rows.filter("not settled"), labels, sketches, percent).union(across_pivots(apart, labels, percent)).distinct()
    pairs = base.materialize(pairs.join(stars, ["a", "b"], "left_anti"), "pairs")
    more = linked(pairs, texts, size, percent)
    return sizes, labels if more.isEmpty() else merged(labels, more)


def labelled(sizes: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows with the component of their key, null for none, and per component its first row: group, first (none, doc_id, key)."""
    rows = base.materialize(sizes.join(labels, F.col("key") == F.col("node"), "left").select("doc_id", "key", "n_shingles", "component"), "labelled")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("first")
    return rows, base.materialize(rows.filter("component is not null").groupBy(F.col("component").alias("group")).agg(first), "firsts")


def groups(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, frequent: int = FREQUENT) -> DataFrame:
    """Every row with its number of shingles and its component: doc_id, n_shingles, component_id."""
    rows, firsts = labelled(*joined(docs, size, percent, frequent))
    alone = rows.filter("component is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    named = rows.join(firsts, F.col("component") == F.col("group"))
    return alone.union(named.select("doc_id", "n_shingles", F.col("first.doc_id").alias("component_id")))


def representatives(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The documents, with one row for each group of near copies: that of the least id, any id before none.

    Of several texts of that id in the group the one with the least key stays, and of equal rows one.
    Texts without words are in no group and stay.
    """
    rows, firsts = labelled(*joined(docs, size, percent))
    later = rows.join(firsts, F.col("component") == F.col("group")).filter(F.col("key") != F.col("first.key"))
    copies = base.materialize(later.select(F.col("key").alias("__copy")).distinct(), "copies")
    again = rows.filter("n_shingles > 0").groupBy(F.col("key").alias("__of")).count().filter("count > 1").select("__of")
    again = base.materialize(again, "equal-rows")
    left = docs.withColumn("__key", row_key()).join(copies, F.col("__key") == F.col("__copy"), "left_anti")
    if again.isEmpty():
        return left.select(*docs.columns)
    equal = left.join(again, F.col("__key") == F.col("__of"), "left_semi")
    single = equal.groupBy("__key").agg(F.first(F.struct(*docs.columns)).alias("__row")).select("__row.*")
    return left.join(again, F.col("__key") == F.col("__of"), "left_anti").select(*docs.columns).unionByName(single)
