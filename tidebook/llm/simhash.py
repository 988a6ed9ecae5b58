"""SimHash fingerprints and their near duplicates by generalised pigeonhole.

The 64 bits are dealt into `differing + 1` partitions, bits that tend to agree into the same one. If the
thresholds of the partitions, each -1 or more, add up to 0, then two fingerprints that differ in at most
`differing` bits are within the threshold of one partition at least. So every fingerprint chooses its own
thresholds, by dynamic programming over the candidates it has to expect, looks up the values around its own
in each partition that it does not skip, and verifies what it finds.

What it has to expect comes from a table of counts of at most `MOST_CELLS` cells a partition, whatever the
input; a cell counts at least what each of its values has. Where a fingerprint has no choice that costs less
than looking at all strings within half of `differing` bits of it, it does that instead: two that are close
have such a string in common, and all that have one in common are close. A dense region is therefore joined
through these strings, in proportion to its fingerprints, and no value of a partition is looked up that more
than a bounded number of them share.

Equal fingerprints are one node from the start. A null text is empty; a text without words has the
fingerprint zero and is linked like any other. Rows are documents of their own even where ids repeat; the
class of a document has the smallest id in it, null only where no row of the class has one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidebook.llm import base
from tidebook.llm.components import components

BITS = 64
SEED = 42
MOST_CELLS = 1 << 20
#: Salts by which documents that share a fingerprint are spread when they meet their class.
SALTS = 16
SPREAD = np.uint64(0x9E3779B97F4A7C15)
#: The bits of every byte value, lowest first.
OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


# --- fingerprints --------------------------------------------------------------------------------


def fingerprint(raw: bytes, size: int = 3) -> int:
    """Bits set in over half of the hashes of a text's shingles, repeats counted."""
    own = raw.lower().split()
    if not own:
        return 0
    width = min(size, len(own))
    joined = b" ".join(own)
    lengths = np.fromiter(map(len, own), np.int64, len(own))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(own) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)
    hashes = np.fromiter((digest(joined[s:e], SEED) for s, e in spans), np.uint64, len(own) - width + 1)
    by_byte = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    counts = np.concatenate([np.bincount(by_byte[:, k], minlength=256) @ OF_BYTE for k in range(8)])
    return sum(1 << int(bit) for bit in np.flatnonzero(2 * counts > len(hashes)))


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """doc_id, fingerprint as a signed number, of every document."""
    schema = docs.select("doc_id").schema.add("fingerprint", "long")

    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        prints = np.fromiter((fingerprint(raw, size) for raw in base.raw_texts(batch)), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints.view(np.int64))], names=["doc_id", "fingerprint"])

    return base.over_batches(docs.select("doc_id", "text"), rows, schema)


# --- partitions of the bits ----------------------------------------------------------------------


def bits_of(prints: np.ndarray) -> np.ndarray:
    return np.unpackbits(prints.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def agreements(nodes: DataFrame) -> np.ndarray:
    """For every two bits, the number of fingerprints in which they agree less those in which they differ."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS), np.int64)
        for batch in batches:
            signs = bits_of(batch.column("fingerprint").to_numpy(zero_copy_only=False)).astype(np.float64) * 2 - 1
            total += np.rint(signs.T @ signs).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BITS * BITS)), pa.array(total.ravel())], names=["pair", "n"])

    parts = nodes.select("fingerprint").mapInArrow(sums, "pair long, n long")
    total = np.zeros(BITS * BITS, np.float64)
    for row in parts.groupBy("pair").agg(F.sum(F.col("n").cast("double")).alias("n")).collect():
        total[row.pair] = row.n
    return total.reshape(BITS, BITS)


def partitions(agreement: np.ndarray, count: int) -> list[list[int]]:
    """Bits dealt into partitions of even size; each takes the bits that agree most with those it has."""
    strength = np.abs(agreement - np.diag(np.diag(agreement)))
    left = set(range(BITS))
    dealt = []
    for number in range(count):
        width = BITS // count + (number >= count - BITS % count)
        own = [max(left, key=lambda bit: (strength[bit, sorted(left)].sum(), -bit))]
        while left.remove(own[-1]) or len(own) < width:
            own.append(max(left, key=lambda bit: (strength[bit, own].sum(), -bit)))
        dealt.append(sorted(own))
    return dealt


def values(prints: np.ndarray, bits: list[int]) -> np.ndarray:
    """What fingerprints have in a partition, as numbers."""
    found = np.zeros(len(prints), np.uint64)
    for place, bit in enumerate(bits):
        found |= ((prints >> np.uint64(bit)) & np.uint64(1)) << np.uint64(place)
    return found


def balls(width: int, radius: int) -> list[np.ndarray]:
    """For each radius the masks of at most so many of `width` bits."""
    found, masks = [], [0]
    for bits in range(radius + 1):
        if bits:
            masks += [sum(1 << b for b in chosen) for chosen in combinations(range(width), bits)]
        found.append(np.array(masks, np.uint64))
    return found


def cells_of(found: np.ndarray, cell_bits: int) -> np.ndarray:
    return ((found * SPREAD) >> np.uint64(64 - cell_bits)).astype(np.int64)


def counted(nodes: DataFrame, parts: list[list[int]], cell_bits: int, above: int) -> np.ndarray:
    """For every partition the fingerprints in each cell, counted up to just above a bound."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(parts), 1 << cell_bits), np.int64)
        for batch in batches:
            prints = batch.column("fingerprint").to_numpy(zero_copy_only=False).view(np.uint64)
            for number, bits in enumerate(parts):
                total[number] += np.bincount(cells_of(values(prints, bits), cell_bits), minlength=1 << cell_bits)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total.ravel()[found])], names=["cell", "n"])

    held = nodes.select("fingerprint").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    full = held.filter("n > 1").select("cell", F.least("n", F.lit(above + 1)).cast("short").alias("n")).toArrow()
    table = np.ones(len(parts) << cell_bits, np.int16)
    table[full.column("cell").to_numpy()] = full.column("n").to_numpy()
    return table.reshape(len(parts), -1)


# --- allocation ----------------------------------------------------------------------------------


def allocate(costs: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Thresholds of least cost that add up to `total`, and that cost, for every row.

    `costs[row, partition, 1 + threshold]` has the cost of every threshold from -1 on.
    """
    rows, count, options = costs.shape
    # Sums of thresholds start at -count; `best` has the least cost of every sum of the partitions so far.
    best = np.full((rows, count * (options - 1) + 1), np.inf)
    best[:, 0] = 0
    chosen = []
    for number in range(count):
        after = np.full_like(best, np.inf)
        choice = np.zeros(best.shape, np.int8)
        for option in range(options):
            moved = np.full_like(best, np.inf)
            moved[:, option:] = best[:, : best.shape[1] - option] + costs[:, number, option, None]
            better = moved < after
            after[better], choice[better] = moved[better], option
        best = after
        chosen.append(choice)
    at = np.full(rows, total + count)
    least = best[np.arange(rows), at]
    thresholds = np.zeros((rows, count), np.int64)
    for number in reversed(range(count)):
        option = chosen[number][np.arange(rows), at]
        thresholds[:, number] = option - 1
        at = at - option
    return thresholds, least


def keyed(nodes: DataFrame, parts: list[list[int]], table: np.ndarray, differing: int) -> DataFrame:
    """What every fingerprint is found by (kind 0), looks up (1), and the strings around it if it is in a dense region (2)."""
    kinds = {"kind": T.IntegerType(), "part": T.IntegerType(), "value": T.LongType(), "fingerprint": T.LongType()}
    schema = T.StructType([*nodes.select("node").schema, *(T.StructField(name, kind) for name, kind in kinds.items())])
    around = [balls(len(bits), differing) for bits in parts]
    whole = balls(BITS, differing // 2)[-1]
    bound = len(whole)
    cell_bits = table.shape[1].bit_length() - 1

    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        prints = batch.column("fingerprint").to_numpy(zero_copy_only=False).view(np.uint64)
        own = [values(prints, bits) for bits in parts]
        costs = np.zeros((len(prints), len(parts), differing + 2))
        for number, found in enumerate(own):
            for radius, masks in enumerate(around[number]):
                held = table[number][cells_of(found[:, None] ^ masks, cell_bits)]
                costs[:, number, radius + 1] = (held + 1).sum(axis=1)
        thresholds, least = allocate(costs, differing - len(parts) + 1)
        dense = least > bound

        def made(kind: int, part: int, rows_of: np.ndarray, found: np.ndarray) -> pa.RecordBatch:
            every = np.repeat(rows_of, found.shape[1])
            columns = [batch.column("node").take(pa.array(every)), np.full(len(every), kind, np.int32), np.full(len(every), part, np.int32)]
            arrays = [*columns, found.ravel().view(np.int64), prints[every].view(np.int64)]
            return pa.RecordBatch.from_arrays([pa.array(a) if isinstance(a, np.ndarray) else a for a in arrays], names=schema.names)

        for number, found in enumerate(own):
            light = np.flatnonzero(table[number][cells_of(found, cell_bits)] <= bound)
            yield made(0, number, light, found[light][:, None])
            for radius, masks in enumerate(around[number]):
                asking = np.flatnonzero(~dense & (thresholds[:, number] == radius))
                yield made(1, number, asking, found[asking][:, None] ^ masks)
        several = np.flatnonzero(dense)
        yield made(2, -1, several, prints[several][:, None] ^ whole)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                yield from rows(batch.slice(start, 2048))

    return nodes.select("node", "fingerprint").mapInArrow(run, schema)


def links(nodes: DataFrame, differing: int = 2) -> DataFrame:
    """Links a, b between nodes: enough of those that differ in at most `differing` bits to connect all that do.

    `nodes` has columns node and fingerprint, one row for each fingerprint. `differing` must be even.
    """
    if differing % 2:
        raise ValueError("an even number of differing bits is needed")
    bound = len(balls(BITS, differing // 2)[-1])
    cell_bits = min(MOST_CELLS.bit_length() - 1, max(12, (nodes.count() // 4).bit_length()))
    parts = partitions(agreements(nodes), differing + 1)
    table = counted(nodes, parts, cell_bits, bound)
    keys = base.materialize(keyed(nodes, parts, table, differing), "simhash-keys")
    held = keys.filter("kind = 0").select("part", "value", F.col("node").alias("b"), F.col("fingerprint").alias("other"))
    asked = keys.filter("kind = 1").select("part", "value", F.col("node").alias("a"), "fingerprint")
    apart = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("other")))
    same = (asked["part"] == held["part"]) & (asked["value"] == held["value"])
    verified = asked.join(held, same & apart.between(1, differing)).select("a", "b")
    # At most as many fingerprints as masks have a string in common, so these groups are small.
    met = keys.filter("kind = 2").groupBy("value").agg(F.collect_list("node").alias("met")).filter(F.size("met") > 1)
    stars = met.select(F.array_min("met").alias("a"), F.explode("met").alias("b")).filter("a <> b")
    return verified.union(stars)


def groups(docs: DataFrame, size: int = 3, differing: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id of every document."""
    prints = base.materialize(fingerprints(docs, size), "simhash")
    first = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first"))
    nodes = base.materialize(first.select(F.struct(F.col("first").isNull().alias("without"), "first", "fingerprint").alias("node"), "fingerprint"), "simhash-nodes")
    classes = components(links(nodes, differing))
    known = nodes.join(classes, "node", "left").select("fingerprint", F.coalesce("component.first", "node.first").alias("component_id"))
    salted = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = prints.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    joined = dealt.join(salted, ["fingerprint", "salt"])
    return joined.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
