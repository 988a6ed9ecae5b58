"""Repeated byte strings by the common-prefix interval tree of an enhanced suffix array.

Every repeat of `length` bytes and more holds a winnowed anchor at the same place, so the suffix array is
built over suffixes that begin at anchors, an anchor's group at a time: suffixes of equal grams, sorted,
with the lengths of their common prefixes. A stack scan over these lengths visits the intervals of the
tree from the deepest up. Where two intervals meet, all pairs between them have that common prefix; how
far a member also agrees to the left is read from the order of the reversed left contexts. Members whose
left extensions differ make the repeat maximal; all members are its occurrences, not just neighbours.

Occurrences with equal surroundings are settled as a class before the suffix array (see `seeds`), so
groups hold different contexts only. A group above `GROUP` contexts is dealt out further by longer
common parts, halving the range of places a repeat can begin at, until it is small or its members agree.

Strings are judged on the input: every byte of a string that also starts elsewhere goes, in all places.
Null and empty texts have no bytes. Rows with the same id and text are two documents with equal text.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebook.llm import base, seeds

LENGTH = 400
GRAM = 50
SLICE = 1 << 21
GROUP = 20_000
CONTEXTS = "gram long, doc_id long, place long, mark long, before binary, after binary"
REACHED = "doc_id long, place long, mark long, back long, on long"
BLOCK = 1 << 24


def byte_symbols():
    return lambda raw: np.frombuffer(raw, np.uint8)


def contexts_of(docs: DataFrame, opened: DataFrame, shape: seeds.Shape) -> DataFrame:
    """Bytes before (reversed) and from open anchors on, as far as a repeat through them can reach."""
    around = seeds.at_documents(docs, opened, "gram").filter("items is not null")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            size = 0
            columns = (batch.column("doc_id").to_pylist(), batch.column("mark").to_pylist(), base.raw_texts(batch), batch.column("items"))
            for doc_id, mark, raw, items in zip(*columns, strict=True):
                for item in items.as_py():
                    at = item["place"]
                    rows.append((item["gram"], doc_id, at, mark, raw[max(0, at - shape.left) : at][::-1], raw[at : at + shape.length]))
                    size += 2 * shape.length
                if size > BLOCK:
                    yield packed(rows)
                    rows, size = [], 0
            if rows:
                yield packed(rows)

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["gram", "doc_id", "place", "mark", "before", "after"]
        )

    return around.mapInArrow(cut, CONTEXTS)


def common(texts: list[bytes], width: int) -> np.ndarray:
    """Common prefix length of each text with the one before it; 0 for the first."""
    table = np.frombuffer(b"".join(t.ljust(width, b"\0") for t in texts), np.uint8).reshape(-1, width)
    sizes = np.array([len(t) for t in texts])
    differ = table[1:] != table[:-1]
    found = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    return np.concatenate([[0], np.minimum(found, np.minimum(sizes[1:], sizes[:-1]))])


class Group:
    """The suffixes at one gram: scan of their interval tree.

    `ahead[i]` is the common prefix of suffix i with suffix i - 1 in suffix order; `rank[i]` its place in
    the order of left contexts, with `behind` the common lengths of neighbours there.
    """

    def __init__(self, ahead: np.ndarray, rank: np.ndarray, behind: np.ndarray, length: int) -> None:
        self.ahead, self.rank, self.behind, self.length = ahead.tolist(), rank.tolist(), behind, length
        self.back = np.full(len(ahead), -1, dtype=np.int64)
        self.on = np.full(len(ahead), -1, dtype=np.int64)
        self.member = np.argsort(rank)
        self.repeats: list[tuple[int, int, list[int]]] = []

    def agree(self, a: int, b: int) -> int:
        """Common left length of the members at two left ranks, a < b."""
        return int(self.behind[a + 1 : b + 1].min())

    def meet(self, left: int, right: int, depth: int, found: int) -> None:
        """Two members agree on `found` bytes before and `depth` from the anchor on."""
        if found + depth >= self.length:
            for rank in (left, right):
                i = self.member[rank]
                self.back[i] = max(self.back[i], found)
                self.on[i] = max(self.on[i], depth)

    def join(self, one: list[int], two: list[int], depth: int) -> list[int]:
        """Members of two intervals that meet at a depth, as sorted left ranks."""
        if len(one) < len(two):
            one, two = two, one
        for rank in two:
            at = bisect_left(one, rank)
            if at:
                self.meet(one[at - 1], rank, depth, self.agree(one[at - 1], rank))
            if at < len(one):
                self.meet(rank, one[at], depth, self.agree(rank, one[at]))
            one.insert(at, rank)
        return one

    def scan(self, collect: bool = False) -> None:
        """Visit the intervals from the deepest up, with a stack of (common prefix with the one below, members)."""
        stack: list[tuple[int, list[int]]] = [(-1, [self.rank[0]])]
        for i in range(1, len(self.ahead) + 1):
            depth = self.ahead[i] if i < len(self.ahead) else -1
            while stack[-1][0] > depth:
                deep, members = stack.pop()
                below, earlier = stack.pop()
                stack.append((below, self.join(earlier, members, deep)))
                if collect and below < deep:
                    self.close(stack[-1][1], deep)
            if i < len(self.ahead):
                stack.append((depth, [self.rank[i]]))

    def close(self, members: list[int], depth: int) -> None:
        """Note the long enough repeats of a whole interval, one per set of members that agree to the left."""
        begin = 0
        for k in range(1, len(members) + 1):
            if k == len(members) or self.agree(members[k - 1], members[k]) + depth < self.length:
                if k - begin > 1:
                    shared = self.agree(members[begin], members[k - 1])
                    self.repeats.append((shared, depth, [int(self.member[r]) for r in members[begin:k]]))
                begin = k


def built(befores: list[bytes], afters: list[bytes], length: int) -> tuple[list[int], Group]:
    """The group of contexts, with the suffix order of its members."""
    order = sorted(range(len(afters)), key=afters.__getitem__)
    ahead = common([afters[i] for i in order], max(1, max(map(len, afters))))
    lefts = sorted(range(len(order)), key=lambda k: befores[order[k]])
    rank = np.empty(len(order), dtype=np.int64)
    rank[lefts] = np.arange(len(order))
    behind = common([befores[order[k]] for k in lefts], max(1, max(map(len, befores))))
    return order, Group(ahead, rank, behind, length)


def reached(befores: list[bytes], afters: list[bytes], length: int) -> Iterator[tuple[int, int, int]]:
    """(member, bytes back, bytes on) of every member with a repeat through the anchor."""
    order, group = built(befores, afters, length)
    group.scan()
    for k, (back, on) in enumerate(zip(group.back.tolist(), group.on.tolist(), strict=True)):
        if back >= 0:
            yield order[k], back, on


def maximal_repeats(befores: list[bytes], afters: list[bytes], length: int) -> list[tuple[int, int, list[int]]]:
    """Maximal repeats through an anchor: (bytes before, bytes on, all members that have it)."""
    order, group = built(befores, afters, length)
    group.scan(collect=True)
    return [(back, on, sorted(order[k] for k in members)) for back, on, members in group.repeats]


def refined(contexts: DataFrame, shape: seeds.Shape, group: int) -> tuple[DataFrame, DataFrame | None]:
    """Contexts under keys of groups of bounded size, and what was settled on the way.

    A repeat begins 0 to `left` bytes before the anchor. A large group is halved by that place: members of
    a half share all bytes that every repeat of the half covers. Halves of one place agree on a repeat.
    """
    held = contexts.select("gram", "doc_id", "place", "mark", "before", "after", F.lit(0).alias("low"), F.lit(shape.left).alias("high"))
    settled = None
    while True:
        large = held.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > group).select(F.col("gram").alias("of"))
        large = base.materialize(large, "large-groups")
        if large.isEmpty():
            return held, settled
        same = F.col("gram") == F.col("of")
        small, big = held.join(large, same, "left_anti"), held.join(large, same, "left_semi")
        done = big.filter("low = high").select("doc_id", "place", "mark", F.col("low").cast("long").alias("back"), (F.lit(shape.length) - F.col("low")).cast("long").alias("on"))
        done = base.materialize(done, "agreed")
        settled = done if settled is None else settled.unionByName(done)
        middle = F.expr("(low + high) div 2").cast("int")
        halves = big.filter("low < high").withColumn("half", F.explode(F.array(F.struct(F.col("low").alias("a"), middle.alias("b")), F.struct((middle + 1).alias("a"), F.col("high").alias("b")))))
        halves = halves.filter((F.octet_length("before") >= F.col("half.a")) & (F.octet_length("after") >= shape.length - F.col("half.b")))
        core = F.xxhash64("gram", "half", F.expr("substring(before, 1, half.a)"), F.expr(f"substring(after, 1, {shape.length} - half.b)"))
        halves = halves.select(core.alias("gram"), "doc_id", "place", "mark", "before", "after", F.col("half.a").alias("low"), F.col("half.b").alias("high"))
        held = base.materialize(small.unionByName(halves), "contexts")


def scan_groups(contexts: DataFrame, shape: seeds.Shape) -> DataFrame:
    """Suffix arrays of all groups: how far each anchor's repeats reach back and on."""
    dealt = contexts.select("gram", "doc_id", "place", "mark", "before", "after").repartition("gram").sortWithinPartitions("gram")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            gram = batch.column("gram").to_numpy()
            last = int(np.searchsorted(gram, gram[-1])) if len(gram) else 0
            if held and len(gram) and held[-1].column("gram")[-1].as_py() != gram[0]:
                yield from scanned(held)
                held = []
            if last:
                yield from scanned([*held, batch.slice(0, last)])
                held = []
            held.append(batch.slice(last))
        if held:
            yield from scanned(held)

    def scanned(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(parts)
        gram = rows.column("gram").to_numpy()
        before, after = rows.column("before").to_pylist(), rows.column("after").to_pylist()
        marks = [0, *(np.flatnonzero(np.diff(gram)) + 1).tolist(), len(gram)]
        taken, back, on = [], [], []
        for begin, end in zip(marks, marks[1:], strict=False):
            if end - begin > 1:
                for member, b, o in reached(before[begin:end], after[begin:end], shape.length):
                    taken.append(begin + member)
                    back.append(b)
                    on.append(o)
        where = rows.select(["doc_id", "place", "mark"]).take(pa.array(taken, pa.int64())).combine_chunks()
        columns = [where.column("doc_id"), where.column("place"), where.column("mark"), pa.array(back, pa.int64()), pa.array(on, pa.int64())]
        yield from pa.table(columns, names=["doc_id", "place", "mark", "back", "on"]).to_batches()

    return dealt.mapInArrow(run, REACHED)


def occurrences(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """Documents with the list `items` of stretches around anchors that repeat: (place, back, on); null for none."""
    docs = docs.select("doc_id", "text")
    shape = seeds.Shape(length, gram, SLICE)
    found = seeds.classified(seeds.seed_rows(docs, byte_symbols, shape), keep_first=False)
    settled = found.filter("settled").select("doc_id", "place", "mark", F.lit(shape.left).cast("long").alias("back"), F.lit(length).cast("long").alias("on"))
    contexts, agreed = refined(base.materialize(contexts_of(docs, found.filter("opened"), shape), "contexts"), shape, group)
    scanned = scan_groups(contexts, shape)
    every = settled.unionByName(scanned) if agreed is None else settled.unionByName(scanned).unionByName(agreed)
    return seeds.at_documents(docs, every, "back", "on")


def spans_of(items: list[dict] | None, size: int) -> list[tuple[int, int]]:
    if not items:
        return []
    at = np.array([(x["place"], x["back"], x["on"]) for x in items], dtype=np.int64)
    return seeds.merged(np.stack([np.maximum(at[:, 0] - at[:, 1], 0), np.minimum(at[:, 0] + at[:, 2], size)], axis=1))


def remove(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """Bytes left of every document: doc_id, kept binary, n_bytes, n_removed, n_spans, spans, kept_sha256."""
    pair = pa.list_(pa.struct([("begin", pa.int64()), ("stop", pa.int64())]))

    def cut(batch: pa.RecordBatch):
        kept, sizes, gone, spans = [], [], [], []
        for raw, items in zip(base.raw_texts(batch), batch.column("items"), strict=True):
            found = spans_of(items.as_py(), len(raw))
            edges = [0, *(x for span in found for x in span), len(raw)]
            kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            sizes.append(len(raw))
            gone.append(len(raw) - len(kept[-1]))
            spans.append([{"begin": a, "stop": b} for a, b in found])
        whole = pa.int64()
        columns = [batch.column("doc_id"), pa.array(kept, pa.binary()), pa.array(sizes, whole), pa.array(gone, whole)]
        columns += [pa.array([len(s) for s in spans], whole), pa.array(spans, pair), pa.array([hashlib.sha256(k).hexdigest() for k in kept])]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "kept", "n_bytes", "n_removed", "n_spans", "spans", "kept_sha256"])

    schema = "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long, spans array<struct<begin: long, stop: long>>, kept_sha256 string"
    return base.over_batches(occurrences(docs, length, gram, group), cut, schema)
