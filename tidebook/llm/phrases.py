"""Phrases whose words come together more often than their parts would, by the stripes pattern.

A stripe belongs to a prefix of no, one or two words. It has how often the prefix occurs and, for two words,
how often each word follows it inside a piece of text. Every task counts its texts into stripes; stripes of
one prefix are brought together and merged word by word, one prefix at a time, so that a task holds no more
than the different words after one pair of words. Merged stripes have everything: the totals are the
frequencies of words and pairs, the entries those of triples, and the largest entry of a pair, together with the
largest of the triples that end in it, says whether a longer phrase subsumes it.

A null text is empty, and a null language is `und`. Rows are texts of their own even where ids repeat.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidebook.llm import base

#: Bytes that end a piece and bytes that only end a word.
ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
KIND = np.zeros(256, np.uint8)
KIND[list(ENDS)], KIND[list(BLANKS)] = 2, 1
#: Bytes of text that a task counts at a time, a longer text alone, and rows of the batches it hands on.
BLOCK, ROWS = 1 << 24, 1 << 16
#: Parts in which the phrases of one language are ranked before the last ranking.
SALTS = 32

STRIPE = "lang string, first string, second string, total long, words array<string>, counts array<long>"
STRIPE_ARROW = pa.schema(
    [("lang", pa.string()), ("first", pa.string()), ("second", pa.string()), ("total", pa.int64()), ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))]
)
#: A stripe on its way: `first second lang`, the total, and the words after it by spaces, each with a tab and its
#: count unless that is 1. Words have neither spaces nor tabs.
PACKED = "prefix string, total long, follow string"
PACKED_ARROW = pa.schema([("prefix", pa.string()), ("total", pa.int64()), ("follow", pa.string())])


# --- counting ------------------------------------------------------------------------------------


def words_of(raw: bytes) -> tuple[pa.Array, np.ndarray]:
    """The words of lower-cased text, dictionary-encoded, and whether the next word is in the same piece."""
    symbols = np.frombuffer(raw, np.uint8)
    kinds = KIND[symbols]
    inside = kinds == 0
    turns = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, stops = turns[::2], turns[1::2]
    ends = np.flatnonzero(kinds == 2)
    before, after = np.searchsorted(ends, stops[:-1]), np.searchsorted(ends, starts[1:])
    joined = np.append(before == after, False) if len(starts) else np.zeros(0, bool)
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(stops - starts, out=offsets[1:])
    letters = symbols[inside]
    found = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(letters))
    return found.cast(pa.string()).dictionary_encode(), joined


def stripes_of(lang: str, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
    """The stripes of some texts of one language."""
    found, joined = words_of(b"\n".join(texts).lower())
    codes, known = found.indices.to_numpy(zero_copy_only=False).astype(np.int64), found.dictionary
    size = len(known)

    def made(first: pa.Array, second: pa.Array, totals: np.ndarray, entries: pa.Array, offsets: np.ndarray) -> Iterator[pa.RecordBatch]:
        for begin in range(0, len(totals), ROWS):
            end = min(begin + ROWS, len(totals))
            low, high = offsets[begin], offsets[end]
            lists = pa.ListArray.from_arrays(pa.array((offsets[begin : end + 1] - low).astype(np.int32)), entries[low:high])
            prefix = pc.binary_join_element_wise(first[begin:end], second[begin:end], pa.repeat(pa.scalar(lang), end - begin), " ")
            yield pa.RecordBatch.from_arrays([prefix, pa.array(totals[begin:end]), pc.binary_join(lists, " ")], schema=PACKED_ARROW)

    def bare(first: pa.Array, totals: np.ndarray) -> Iterator[pa.RecordBatch]:
        return made(first, pa.repeat(pa.scalar(""), len(first)), totals, pa.array([], pa.string()), np.zeros(len(first) + 1, np.int64))

    if not size:
        return
    yield from bare(pa.array([""]), np.array([len(codes)]))
    yield from bare(known, np.bincount(codes, minlength=size))
    at = np.flatnonzero(joined)
    if not len(at):
        return
    pairs, which = np.unique(codes[at] * size + codes[at + 1], return_inverse=True)
    follows = joined[at + 1]
    third = np.where(follows, codes[np.minimum(at + 2, len(codes) - 1)], -1)
    triples, counts = np.unique(which[follows] * size + third[follows], return_counts=True)
    offsets = np.searchsorted(triples, np.arange(len(pairs) + 1) * size)
    words = known.take(pa.array(triples % size))
    several = np.flatnonzero(counts > 1)
    told = pc.binary_join_element_wise(words.take(pa.array(several)), pa.array(counts[several]).cast(pa.string()), "\t")
    entries = pc.replace_with_mask(words, pa.array(counts > 1), told)
    yield from made(known.take(pa.array(pairs // size)), known.take(pa.array(pairs % size)), np.bincount(which, minlength=len(pairs)), entries, offsets)


def counted(docs: DataFrame) -> DataFrame:
    """Stripes of blocks of texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        size = 0
        for batch in batches:
            for lang, raw in zip(batch.column("lang").to_pylist(), base.raw_texts(batch), strict=True):
                held.setdefault(lang, []).append(raw)
                size += len(raw)
                if size >= BLOCK:
                    for of, texts in held.items():
                        yield from stripes_of(of, texts)
                    held, size = {}, 0
        for of, texts in held.items():
            yield from stripes_of(of, texts)

    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").mapInArrow(count, PACKED)


# --- merging -------------------------------------------------------------------------------------


def unpacked(follow: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Of packed words after prefixes: how many each has, the words, and their counts."""
    lists = pc.split_pattern(follow, " ")
    lengths = np.where(pc.equal(follow, "").to_numpy(zero_copy_only=False), 0, pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    flat = lists.flatten()
    flat = flat.filter(pc.not_equal(flat, ""))
    tabs = pc.find_substring(flat, "\t").to_numpy(zero_copy_only=False)
    several = np.flatnonzero(tabs >= 0)
    counts = np.ones(len(flat), np.int64)
    if len(several):
        pairs = pc.split_pattern(flat.take(pa.array(several)), "\t").flatten()
        counts[several] = pairs.take(pa.array(np.arange(1, len(pairs), 2))).cast(pa.int64()).to_numpy()
        flat = pc.replace_with_mask(flat, pa.array(tabs >= 0), pairs.take(pa.array(np.arange(0, len(pairs), 2))))
    return lengths, flat, counts


def merged(stripes: pa.RecordBatch, least: int, last: bool) -> tuple[pa.RecordBatch, pa.RecordBatch | None]:
    """Sorted packed stripes merged, without totals and entries below `least`; the last prefix packed again unless `last`."""
    prefix = stripes.column("prefix")
    new = np.ones(stripes.num_rows, bool)
    new[1:] = pc.not_equal(prefix[1:], prefix[:-1]).to_numpy(zero_copy_only=False)
    begins = np.flatnonzero(new)
    totals = np.add.reduceat(stripes.column("total").to_numpy(), begins)
    of_row = np.cumsum(new) - 1
    apart = len(begins) - 1
    # The empty prefix, which says how many words a language has, is kept whatever it counts.
    kept = (totals >= least) | pc.starts_with(prefix.take(pa.array(begins)), " ").to_numpy(zero_copy_only=False)
    wanted = kept.copy()
    wanted[apart] |= not last
    rows = np.flatnonzero(wanted[of_row])
    lengths, words, counts = unpacked(stripes.column("follow").take(pa.array(rows)))
    entries = pa.table({"of": np.repeat(of_row[rows], lengths), "word": words, "n": counts})
    summed = entries.group_by(["of", "word"]).aggregate([("n", "sum")])
    of, n = summed.column("of").to_numpy(), summed.column("n_sum").to_numpy()
    words = summed.column("word").combine_chunks()
    words = words.chunk(0) if isinstance(words, pa.ChunkedArray) else words
    order = np.argsort(of, kind="stable")
    enough = order[(n[order] >= least) & (last | (of[order] != apart))]
    final = np.flatnonzero(kept if last else kept & (np.arange(len(kept)) != apart))
    chosen = enough[np.isin(of[enough], final)]
    cuts = pa.array(np.searchsorted(of[chosen], np.append(final, len(kept))).astype(np.int32))
    lists = [pa.ListArray.from_arrays(cuts, part) for part in (words.take(pa.array(chosen)), pa.array(n[chosen]))]
    keys = pc.split_pattern(prefix.take(pa.array(begins[final])), " ", max_splits=2)
    names = [pc.list_element(keys, place) for place in (2, 0, 1)]
    done = pa.RecordBatch.from_arrays([*names, pa.array(totals[final]), *lists], schema=STRIPE_ARROW)
    if last:
        return done, None
    left = order[of[order] == apart]
    follow = " ".join(word if count == 1 else f"{word}\t{count}" for word, count in zip(words.take(pa.array(left)).to_pylist(), n[left].tolist(), strict=True))
    row = [[prefix[int(begins[apart])].as_py()], [int(totals[apart])], [follow]]
    return done, pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(row, PACKED_ARROW, strict=True)], schema=PACKED_ARROW)


def together(stripes: DataFrame, least: int = 10) -> DataFrame:
    """One stripe for each prefix that occurs at least so often, with the words that follow it at least so often."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_row = None
        for batch in batches:
            rows = pa.RecordBatch.from_arrays([batch.column(name) for name in PACKED_ARROW.names], schema=PACKED_ARROW)
            if rows.num_rows:
                done, open_row = merged(pa.concat_batches([open_row, rows]) if open_row is not None else rows, least, False)
                yield done
        if open_row is not None:
            yield merged(open_row, least, True)[0]

    return stripes.repartition("prefix").sortWithinPartitions("prefix").mapInArrow(merge, STRIPE)


# --- scoring -------------------------------------------------------------------------------------


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (left right)), exact while the numerator has at most 38 digits."""
    wide = [c.cast("decimal(19,0)") for c in (a, left, right)]
    return F.call_function("div", wide[0] * wide[0] * F.lit(1_000_000).cast("decimal(7,0)"), wide[1] * wide[2])


def candidates(stripes: DataFrame, percent: int = 50) -> DataFrame:
    """Phrases of merged stripes with their weakest cut: lang, phrase, a, l, r, score; those subsumed left out."""
    words = stripes.filter("first <> '' AND second = ''")
    pairs = stripes.filter("second <> ''")

    def frequency(word: str, into: str) -> DataFrame:
        return words.select("lang", F.col("first").alias(word), F.col("total").alias(into))

    entry = F.explode(F.arrays_zip("words", "counts")).alias("entry")
    triples = pairs.select("lang", "first", "second", F.col("total").alias("l2"), entry).select(
        "lang", "first", "second", F.col("entry.words").alias("third"), F.col("entry.counts").alias("a"), "l2"
    )
    ending = triples.groupBy("lang", F.col("second").alias("first"), F.col("third").alias("second")).agg(F.max("a").alias("before"))
    largest = F.greatest(F.coalesce(F.array_max("counts"), F.lit(0)), F.coalesce("before", F.lit(0)))
    two = (
        pairs.join(ending, ["lang", "first", "second"], "left")
        .filter(100 * largest < percent * F.col("total"))
        .join(frequency("first", "l"), ["lang", "first"])
        .join(frequency("second", "r"), ["lang", "second"])
        .select("lang", F.concat_ws(" ", "first", "second").alias("phrase"), F.col("total").alias("a"), "l", "r")
        .withColumn("score", score(F.col("a"), F.col("l"), F.col("r")))
    )
    ends = pairs.select("lang", F.col("first").alias("second"), F.col("second").alias("third"), F.col("total").alias("r1"))
    three = (
        triples.join(ends, ["lang", "second", "third"])
        .join(frequency("first", "l1"), ["lang", "first"])
        .join(frequency("third", "r2"), ["lang", "third"])
        .withColumn("s1", score(F.col("a"), F.col("l1"), F.col("r1")))
        .withColumn("s2", score(F.col("a"), F.col("l2"), F.col("r2")))
    )
    early = F.col("s1") <= F.col("s2")
    three = three.select(
        "lang",
        F.concat_ws(" ", "first", "second", "third").alias("phrase"),
        "a",
        F.when(early, F.col("l1")).otherwise(F.col("l2")).alias("l"),
        F.when(early, F.col("r1")).otherwise(F.col("r2")).alias("r"),
        F.least("s1", "s2").alias("score"),
    )
    return two.unionByName(three)


def collocations(docs: DataFrame, top: int = 2000, least: int = 10, percent: int = 50) -> DataFrame:
    """The first phrases of every language: lang, rank, phrase, a, l, r, n, score."""
    stripes = base.materialize(together(counted(docs), least), "stripes")
    best = [F.desc("score"), F.desc("a"), "phrase"]
    # Ranked in parts first, so that the phrases of one language never meet in one task.
    salted = candidates(stripes, percent).withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    first = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best))).filter(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).filter(F.col("rank") <= top)
    sizes = stripes.filter("first = ''").select("lang", F.col("total").alias("n"))
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
