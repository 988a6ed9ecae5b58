"""WARC archives with a two-level capture index.

Archives are written by Spark's own committed writer, so a lost or repeated task leaves no half
files: every record is one gzip member, and the members follow one another. The last byte of a member
shorter than 16 MB is always zero, so that byte serves as the writer's line separator; longer records
are several members. Of equal payloads the smallest page_id (then url) is the response and the rest are
revisits of it. Payloads below `min_bytes` are always responses, and so are full repeats of the row that
is the response.

The index scans the archives, sorts captures by reversed host and path, and packs them into compressed
blocks; a sparse directory keeps the first key and the place of every block. A look-up binary-searches
the directory, range-reads the blocks that may hold the key, and range-reads the records found there.
The directory is searched in chunks of bounded size, so it never has to fit into a task as a whole.

Null html is an empty payload; a null url is kept under an empty key; a null page_id stays null and is
larger than any id. Control characters in urls are percent-encoded. Extra columns are ignored, an
empty table makes an empty archive. Archives are read with pyarrow's file systems, which must know the
scheme of the shared folder.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.llm import base
from tidebook.session import scratch_path

MIN_BYTES = 100
LEVEL = 3
LINES_PER_BLOCK = 2000
DIRECTORY_CHUNK = 200_000
MEMBER = (1 << 24) - 1
READ = 1 << 20
STRETCH = 1 << 22
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURES = "key string, captured string, page_id long, kind string, digest string, file string, offset long, length long"
BLOCKS = "first_key string, last_key string, file string, offset long, length long"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
CONTROL = re.compile(r"[\x00-\x20\x7f]")


def clean(url: str | None) -> str:
    return CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url or "")


def reversed_host(url: str | None) -> str:
    """Index key of a url: host labels from the last to the first, then path and query."""
    url = clean(url)
    try:
        parts = urlsplit(url)
        host = parts.hostname or ""
    except ValueError:
        return url
    if not host:
        return url
    query = f"?{parts.query}" if parts.query else ""
    return f"{','.join(reversed(host.split('.')))}){parts.path or '/'}{query}"


def member(data: bytes, first: bool) -> bytes:
    """One gzip member; the time field tells a record's first member from the rest of a long record."""
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, -15)
    head = struct.pack("<BBBBIBB", 0x1F, 0x8B, 8, 0, 0 if first else 1, 0, 255)
    return head + packer.compress(data) + packer.flush() + struct.pack("<II", zlib.crc32(data), len(data))


def members(data: bytes) -> bytes:
    return b"".join(member(data[at : at + MEMBER], at == 0) for at in range(0, max(1, len(data)), MEMBER))


def record_id(page_id: int | None, url: str | None, digest: str) -> str:
    mark = hashlib.sha256(f"{page_id}\n{url}\n{digest}".encode()).hexdigest()
    return f"<urn:uuid:{mark[:8]}-{mark[8:12]}-5{mark[13:16]}-8{mark[17:20]}-{mark[20:32]}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, original: dict | None) -> bytes:
    """A response, or a revisit of the original, which leaves the payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if original else http + payload
    head = {
        "WARC-Type": "revisit" if original else "response",
        "WARC-Record-ID": record_id(page_id, url, digest),
        "WARC-Date": DATE,
        "WARC-Target-URI": clean(url),
        "WARC-Payload-Digest": f"sha256:{digest}",
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": len(block),
        "X-Page-Id": "" if page_id is None else page_id,
    }
    if original:
        head |= {
            "WARC-Profile": PROFILE,
            "WARC-Refers-To": record_id(original["page_id"], original["url"], digest),
            "WARC-Refers-To-Target-URI": clean(original["url"]),
            "X-Refers-To-Page-Id": "" if original["page_id"] is None else original["page_id"],
        }
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def fields(head: bytes) -> dict[str, str]:
    pairs = (line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if ": " in line)
    return {k: v for k, v in pairs}


def parse(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Record header, HTTP header and payload of one record."""
    head, rest = data.split(b"\r\n\r\n", 1)
    outer = fields(head)
    block = rest[: int(outer["Content-Length"])]
    http, payload = block.split(b"\r\n\r\n", 1)
    return outer, fields(http), payload


def number(text: str | None) -> int | None:
    return int(text) if text else None


def locate(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path there."""
    if re.match(r"file:/(?!/)", path):
        path = "file://" + path.removeprefix("file:")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def read_range(path: str, offset: int, length: int, opened: dict[str, pa.NativeFile]) -> bytes:
    """Decompressed bytes of the members in a range of a file; the last file stays open."""
    if path not in opened:
        for file in opened.values():
            file.close()
        opened.clear()
        system, place = locate(path)
        opened[path] = system.open_input_file(place)
    return inflate(opened[path].read_at(length, offset))


def inflate(data: bytes) -> bytes:
    out = []
    while data:
        stream = zlib.decompressobj(31)
        out.append(stream.decompress(data))
        data = stream.unused_data
    return b"".join(out)


def units(path: str) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, content) of every record or block of a file, read front to back."""
    system, place = locate(path)
    with system.open_input_stream(place) as file:
        raw, at, begin, parts, ended = b"", 0, 0, [], False
        while not ended or raw:
            while len(raw) < 10 and not ended:
                more = file.read(READ)
                ended, raw = not more, raw + more
            if not raw:
                break
            if parts and struct.unpack_from("<I", raw, 4)[0] == 0:
                yield begin, at - begin, b"".join(parts)
                begin, parts = at, []
            stream = zlib.decompressobj(31)
            while not stream.eof:
                if not raw:
                    raw = file.read(READ)
                    if not raw:
                        raise ValueError(f"{path} ends inside a member")
                parts.append(stream.decompress(raw))
                at += len(raw) - len(stream.unused_data)
                raw = stream.unused_data
        if parts:
            yield begin, at - begin, b"".join(parts)


def write_units(rows: DataFrame, path: str) -> None:
    """Write the members of a binary column `unit`, one after the other, into committed files."""
    cut = F.expr("cast(substring(unit, 1, octet_length(unit) - 1) as string)")
    rows.select(cut.alias("value")).write.option("lineSep", "\x00").text(path)


def each_file(spark: SparkSession, path: str, run, schema: str) -> DataFrame:
    """Apply a function of file paths to the files of a folder, a file at a time."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path")
    return files.repartition(base.shuffle_partitions(spark), "path").mapInArrow(run, schema)


def batches_of(rows: Iterator[tuple], names: list[str], kinds: list[pa.DataType], size: int = 2000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def made() -> pa.RecordBatch:
        columns = list(zip(*held, strict=True)) or [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    for row in rows:
        held.append(row)
        if len(held) == size:
            yield made()
            held = []
    if held:
        yield made()


def originals(pages: DataFrame, min_bytes: int) -> DataFrame:
    """Rows that repeat an earlier payload, with the page that holds it."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    facts = pages.select("page_id", "url", F.sha2(payload, 256).alias("digest"), F.octet_length(payload).alias("bytes"))
    facts = facts.filter(F.col("bytes") >= min_bytes)
    rank = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "url")
    first = facts.groupBy("digest").agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    repeats = facts.join(first.withColumnRenamed("digest", "of"), F.col("digest") == F.col("of"))
    repeats = repeats.filter(~(F.col("page_id").eqNullSafe(F.col("first.page_id")) & F.col("url").eqNullSafe(F.col("first.url"))))
    return repeats.select(
        F.col("page_id").alias("r_page"),
        F.col("url").alias("r_url"),
        F.col("digest").alias("r_digest"),
        F.struct(F.col("first.page_id").alias("page_id"), F.col("first.url").alias("url")).alias("original"),
    ).distinct()


@dataclass(frozen=True)
class Archive:
    """Folders of an archive and of its index, and the directory of the index blocks."""

    path: str
    index_path: str
    directory: DataFrame

    def find(self, keys: DataFrame) -> DataFrame:
        """Captures of every key (column `key`): directory search, then range reads of blocks."""
        hits = None
        for chunk in self.chunks():
            found = keys.select("key").distinct().mapInArrow(searcher(chunk), "key string, file string, offset long, length long")
            hits = found if hits is None else hits.unionByName(found)
        if hits is None:
            return keys.sparkSession.createDataFrame([], CAPTURES)
        dealt = hits.repartition("file", "offset").sortWithinPartitions("file", "offset", "key")
        return dealt.mapInArrow(read_blocks, CAPTURES)

    def chunks(self) -> Iterator[pa.Table]:
        """The sorted directory in pieces of bounded size."""
        total = self.directory.count()
        if total <= DIRECTORY_CHUNK:
            if total:
                yield self.directory.toArrow()
            return
        cuts = self.directory.approxQuantile("place", [i * DIRECTORY_CHUNK / 2 / total for i in range(1, -(-2 * total // DIRECTORY_CHUNK))], 0)
        for low, high in zip([None, *cuts], [*cuts, None], strict=True):
            part = self.directory
            part = part if low is None else part.filter(F.col("place") >= low)
            yield (part if high is None else part.filter(F.col("place") < high)).toArrow()

    def read(self, captures: DataFrame) -> DataFrame:
        """The records of captures, range-read from the archives and checked against their digests."""
        near = F.expr(f"offset div {STRETCH}")
        dealt = captures.repartition("file", near).sortWithinPartitions("file", "offset")
        return dealt.mapInArrow(read_records, RECORDS)


def searcher(chunk: pa.Table):
    """Blocks of a directory chunk that may hold a key, by binary search over first and last keys."""
    chunk = chunk.sort_by([("first_key", "ascending"), ("last_key", "ascending")])
    first = np.array([k.encode() for k in chunk["first_key"].to_pylist()], dtype=object)
    last = np.array([k.encode() for k in chunk["last_key"].to_pylist()], dtype=object)
    places = [chunk[c].to_pylist() for c in ("file", "offset", "length")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_pylist()
            coded = np.array([k.encode() for k in keys], dtype=object)
            low, high = np.searchsorted(last, coded, side="left"), np.searchsorted(first, coded, side="right")
            rows = ((k, *(p[b] for p in places)) for k, lo, hi in zip(keys, low, high, strict=True) for b in range(lo, hi))
            yield from batches_of(rows, ["key", "file", "offset", "length"], [pa.string(), pa.string(), pa.int64(), pa.int64()])

    return run


def read_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    opened: dict[str, pa.NativeFile] = {}

    def rows() -> Iterator[tuple]:
        place, lines = None, {}
        for batch in batches:
            for row in batch.to_pylist():
                if place != (row["file"], row["offset"]):
                    place, lines = (row["file"], row["offset"]), {}
                    for line in read_range(row["file"], row["offset"], row["length"], opened).decode().split("\n"):
                        cells = line.split("\t")
                        lines.setdefault(cells[0], []).append(cells)
                for key, captured, page_id, kind, digest, file, offset, length in lines.get(row["key"], ()):
                    yield key, captured, number(page_id), kind, digest, file, int(offset), int(length)

    text, whole = pa.string(), pa.int64()
    yield from batches_of(rows(), ["key", "captured", "page_id", "kind", "digest", "file", "offset", "length"], [text, text, whole, text, text, text, whole, whole])


def read_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    opened: dict[str, pa.NativeFile] = {}

    def rows() -> Iterator[tuple]:
        for batch in batches:
            for row in batch.to_pylist():
                outer, http, payload = parse(read_range(row["file"], row["offset"], row["length"], opened))
                digest, kind = outer["WARC-Payload-Digest"].removeprefix("sha256:"), outer["WARC-Type"]
                if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                    raise ValueError(f"payload of {row['file']} at {row['offset']} does not fit its digest")
                yield number(outer["X-Page-Id"]), outer["WARC-Target-URI"], int(http["Content-Length"]), digest, kind, number(outer.get("X-Refers-To-Page-Id"))

    text, whole = pa.string(), pa.int64()
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    yield from batches_of(rows(), names, [whole, text, whole, text, text, whole], 500)


def scan_archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                for offset, length, data in units(path):
                    outer = fields(data[: data.index(b"\r\n\r\n")])
                    key = reversed_host(outer["WARC-Target-URI"])
                    yield key, outer["WARC-Date"], number(outer["X-Page-Id"]), outer["WARC-Type"], outer["WARC-Payload-Digest"].removeprefix("sha256:"), path, offset, length

    text, whole = pa.string(), pa.int64()
    yield from batches_of(rows(), ["key", "captured", "page_id", "kind", "digest", "file", "offset", "length"], [text, text, whole, text, text, text, whole, whole])


def scan_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                for offset, length, data in units(path):
                    lines = data.decode().split("\n")
                    yield lines[0].split("\t", 1)[0], lines[-1].split("\t", 1)[0], path, offset, length

    text, whole = pa.string(), pa.int64()
    yield from batches_of(rows(), ["first_key", "last_key", "file", "offset", "length"], [text, text, text, whole, whole])


def pack_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[str] = []

    def packed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([members("\n".join(held).encode())], pa.binary())], names=["unit"])

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            held.append("\t".join("" if v is None else str(v) for v in row))
            if len(held) == LINES_PER_BLOCK:
                yield packed()
                held = []
    if held:
        yield packed()


def write_archive(pages: DataFrame, min_bytes: int = MIN_BYTES) -> Archive:
    """Write pages into WARC files below the shared folder and index them."""
    spark = pages.sparkSession
    pages = pages.select("page_id", "url", "html")
    digest = F.sha2(F.coalesce(F.col("html"), F.lit("")).cast("binary"), 256)
    same = F.col("page_id").eqNullSafe(F.col("r_page")) & F.col("url").eqNullSafe(F.col("r_url")) & (F.col("digest") == F.col("r_digest"))
    judged = pages.withColumn("digest", digest).join(originals(pages, min_bytes), same, "left").select("page_id", "url", "html", "digest", "original")

    def records(batch: pa.RecordBatch):
        held, size = [], 0
        columns = (batch.column(c) for c in ("page_id", "url", "html", "digest", "original"))
        for page_id, url, html, own, original in zip(*columns, strict=True):
            payload = (html.as_py() or "").encode()
            held.append(members(record(page_id.as_py(), url.as_py(), payload, own.as_py(), original.as_py())))
            size += len(held[-1])
            if size > READ:
                yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], names=["unit"])
                held, size = [], 0
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], names=["unit"])

    path, index_path = scratch_path(spark, "warc"), scratch_path(spark, "warc-index")
    write_units(base.over_batches(judged, records, "unit binary"), path)
    return index_archive(spark, path, index_path)


def index_archive(spark: SparkSession, path: str, index_path: str) -> Archive:
    """Index the archives of a folder: sorted compressed blocks and their directory."""
    captures = base.materialize(each_file(spark, path, scan_archives, CAPTURES), "captures")
    ordered = captures.repartitionByRange("key", "captured", "page_id", "file", "offset").sortWithinPartitions("key", "captured", "page_id", "file", "offset")
    write_units(ordered.mapInArrow(pack_blocks, "unit binary"), index_path)
    blocks = each_file(spark, index_path, scan_blocks, BLOCKS)
    return Archive(path, index_path, base.materialize(blocks.withColumn("place", F.monotonically_increasing_id()), "directory"))


def page_keys(pages: DataFrame) -> DataFrame:
    """Index keys of the urls of pages."""

    def rows(batch: pa.RecordBatch):
        yield pa.RecordBatch.from_arrays([pa.array([reversed_host(u) for u in batch.column("url").to_pylist()], pa.string())], names=["key"])

    return base.over_batches(pages.select("url"), rows, "key string")
