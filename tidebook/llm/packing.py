"""Best-fit packing of tokenised documents into sequences of a fixed capacity, in bulk rounds.

Documents are tokenised where they are read; only the lengths of their pieces travel. Pieces of one
length are interchangeable, so a round of best-fit decreasing works on a whole length class: the class
sweeps the gap classes upward from its own length, the successor gap takes as many pieces as it can,
conflicts between pieces are resolved by their rank within the class, the gaps shrink, and the next
shorter class follows. A round needs only how many pieces and gaps of each size there are, at most
`capacity` numbers for any input. The ranks, which are per piece, come from a distributed count: a rank
within (input part, length) plus the counts of that length in earlier parts.

Null texts are empty; every document gets the end id, so each has at least one piece. Null and
repeated ids and repeated rows are packed like any other row. Very long texts are tokenised in pieces
cut where the tokenizer splits words anyway. An empty table gives no rows.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left, insort
from collections import defaultdict, deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidebook.llm import base

CAPACITY = 1024
END_ID = 2
CHUNK = 1 << 18
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECES + ", sequence_id long, offset long"
BREAK = re.compile(r"(?<=\S) (?=\S)")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def load_encoder(path: str) -> Callable[[str], list[int]]:
    """Encode a text with the tokenizer of a file, without special tokens added.

    A byte-level vocabulary whose ids follow its merges is the same thing as a table of ranks; the rank
    encoder gives the same ids several times faster. Texts that spell out an added token, and all other
    kinds of tokenizer, go through the file's own library.
    """
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    added = [t["content"] for t in spec.get("added_tokens") or []]

    def slow(text: str) -> list[int]:
        return exact.encode(text, add_special_tokens=False).ids

    split, model = spec.get("pre_tokenizer") or {}, spec["model"]
    plain = split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)
    if not (plain and model.get("type") == "BPE" and spec.get("normalizer") is None):
        return slow
    letters = byte_letters()
    ranks = {bytes(letters[c] for c in word): i for word, i in model["vocab"].items() if word not in added}
    merged = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
    ids = [model["vocab"].get(m.replace(" ", "", 1)) for m in merged]
    if None in ids or any(a >= b for a, b in zip(ids, ids[1:], strict=False)):
        return slow
    import public_tokenizers
    import tiktoken

    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        return slow(text) if any(a in text for a in added) else fast.encode_ordinary(text)

    return encode


def safe_parts(text: str, size: int = CHUNK) -> Iterator[str]:
    """Cut a long text before single spaces between words, where no token of a byte-level pattern spans."""
    begin = 0
    while len(text) - begin > size:
        cut = BREAK.search(text, begin + size)
        if cut is None:
            break
        yield text[begin : cut.start()]
        begin = cut.start()
    yield text[begin:]


def token_ids(text: str, encode: Callable[[str], list[int]], end_id: int) -> np.ndarray:
    parts = [np.asarray(encode(part), dtype="<u4") for part in safe_parts(text)]
    return np.concatenate([*parts, np.array([end_id], dtype="<u4")])


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of every document, with the input part each came from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = load_encoder(tokenizer)
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), base.texts(batch), strict=True):
                ids = token_ids(text, encode, end_id)
                begin, number = 0, 0
                while begin < len(ids):
                    end = begin + ((len(ids) - begin - 1) % capacity + 1 if not number else capacity)
                    for column, value in zip(rows, (doc_id, number, begin, end - begin, zlib.crc32(ids[begin:end].tobytes())), strict=True):
                        column.append(value)
                    begin, number = end, number + 1
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(run, PIECES).withColumn("part", F.spark_partition_id())


def sweep(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing on length classes: (length, first rank, end rank, first sequence, offset).

    Pieces of the class with ranks from the first to before the end go to consecutive sequences from
    the first sequence on, all at that offset.
    """
    gaps: dict[int, deque[tuple[int, int]]] = defaultdict(deque)
    sizes: list[int] = []
    moves: list[tuple[int, int, int, int, int]] = []
    sequences = 0

    def give(gap: int, first: int, count: int) -> None:
        if gap and count:
            if not gaps[gap]:
                insort(sizes, gap)
            gaps[gap].append((first, count))

    def layers(length: int, rank: int, first: int, count: int, gap: int, depth: int) -> int:
        for layer in range(depth):
            moves.append((length, rank, rank + count, first, capacity - gap + layer * length))
            rank += count
        give(gap - depth * length, first, count)
        return rank

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while rank < left:
            at = bisect_left(sizes, length)
            if at == len(sizes):
                gap, first, count = capacity, sequences, -(-(left - rank) // (capacity // length))
                sequences += count
            else:
                gap = sizes[at]
                first, count = gaps[gap].popleft()
                if not gaps[gap]:
                    sizes.pop(at)
            depth = gap // length
            full = min(count, (left - rank) // depth)
            if full:
                rank = layers(length, rank, first, full, gap, depth)
            if rank < left and full < count:
                rest = min(depth, left - rank)
                rank = layers(length, rank, first + full, 1, gap, rest)
                give(gap, first + full + 1, count - full - 1)
            elif full < count:
                give(gap, first + full, count - full)
    return moves


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    pieces = base.materialize(cut_pieces(docs, tokenizer or default_tokenizer(), capacity, end_id), "pieces")
    by_part = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    moves = np.array(sweep(counts, capacity) or np.empty((0, 5)), dtype=np.int64)
    moves = moves[np.lexsort((moves[:, 1], moves[:, 0]))]

    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = by_part.select(F.col("part").alias("of_part"), F.col("length").alias("of_length"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    own = Window.partitionBy("part", "length").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = pieces.withColumn("own", F.row_number().over(own) - 1)
    ranked = ranked.join(before, (F.col("part") == F.col("of_part")) & (F.col("length") == F.col("of_length")))
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("own") + F.col("before")).alias("rank"))

    def place(batch: pa.RecordBatch):
        length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
        span = int(moves[:, 2].max(initial=0)) + 1
        at = np.searchsorted(moves[:, 0] * span + moves[:, 1], length * span + rank, side="right") - 1
        sequence = moves[at, 3] + rank - moves[at, 1]
        columns = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(moves[at, 4])], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return base.over_batches(ranked, place, PLACED)
