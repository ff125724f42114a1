"""WARC archives with a two-level capture index.

Records are gzip members of WARC files, one or more per task. A repeated task writes files of
its own; ``manifest`` in the folder lists those that count, each once. Of records with equal payloads
the one with the smallest ``page_id`` is a response, the others are revisits that name it.

The index is sorted by key: the host's labels reversed, then path and query, then the page.
Its lines lie in compressed blocks of ``BLOCK_LINES`` lines; a sparse directory has the first
key and the byte range of each block. A look-up binary-searches the directory file by range
reads, reads one block by its range, and then the record by the range the block's line names.
No step needs a file, or the directory, in memory.

Look-ups in bulk are sorted first, so neighbours share a block.

Defined cases: a null payload is empty; payloads of less than ``LEAST_REVISIT`` bytes are
always responses (at 0, even empty ones are revisited); a null url has the key ``-``; a null
``page_id`` sorts last and never serves as the response of others that have one; rows that
repeat a ``page_id`` are records of their own, and of those with the smallest id all are
responses. Very long urls and payloads are ordinary. Other columns never matter. An empty
table gives no archive and an empty result.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.llm.files import Output, Ranges
from tidemark.session import scratch_dir

LEAST_REVISIT = 0
BLOCK_LINES = 1000
FILE_LINES = 200_000  # captures per file of blocks
TASK_KEYS = 2000      # look-ups per task
SCAN = 1 << 18        # bytes of an archive read at a time
FLUSH = 16 << 20      # bytes of payload per batch that leaves a task
FILE_BYTES = 512 << 20  # a task begins a new archive beyond that
DATE = "2026-01-01T00:00:00Z"  # fixed: the tables have no capture time


def url_key(url: str | None) -> str:
    """``com,example,blog)/path?query`` for ``https://blog.example.com/path?query``.

    Blanks and controls are escaped, as they part the fields of an index line.
    """
    if not url:
        return "-"
    try:
        parts = urlsplit(url)
        host = (parts.hostname or "").rstrip(".")
        port = f":{parts.port}" if parts.port else ""
        tail = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
        key = ",".join(reversed(host.split("."))) + port + ")" + tail
    except ValueError:  # not a URL
        key = ")" + url
    return re.sub(r"[^!-~]", lambda m: quote(m[0], safe=""), key)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def page_field(page_id: int | None) -> str:
    """Sorts like the number; 21 characters; null last."""
    return "~" if page_id is None else f"{page_id + (1 << 63):020d}"


# -- records -----------------------------------------------------------------

def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None,
           revisit: bool) -> bytes:
    """One gzip member."""
    shown = quote(url or "", safe="!#$%&'()*+,/:;=?@[]~")
    body = b"" if revisit else (
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
        + str(len(payload)).encode() + b"\r\n\r\n" + payload)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {shown}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    if revisit:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}>",
        ]
    head = "\r\n".join(lines).encode() + b"\r\n\r\n"
    return gzip.compress(head + body + b"\r\n\r\n", 6, mtime=0)


def parsed(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of a record; its digest must hold."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    body = rest[:int(fields["Content-Length"])]
    payload = body.partition(b"\r\n\r\n")[2]
    if fields["WARC-Type"] == "response":
        if f"sha1:{digest(payload)}" != fields["WARC-Payload-Digest"]:
            raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
    return fields, payload


def page_of(field: str | None) -> int | None:
    number = (field or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def with_references(pages: DataFrame, least_revisit: int = LEAST_REVISIT) -> DataFrame:
    """``(page_id, url, payload, first_id, several)``: the page that has the payload first.

    Digests are counted and joined; of the payloads' groups only one row each moves.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload"))
    same = F.sha2("payload", 512)
    groups = stored(
        rows.where(F.octet_length("payload") >= least_revisit)
        .groupBy(same.alias("same"))
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("copies"))
        .where("copies > 1").select("same", "first_id"))
    return rows.join(groups, same == F.col("same"), "left").select(
        "page_id", "url", "payload", "first_id", F.col("same").isNotNull().alias("several"))


def write_archives(pages: DataFrame, folder: str,
                   least_revisit: int = LEAST_REVISIT) -> DataFrame:
    """Write the archives; gives ``(key, page, file, offset, length)`` per record, stored."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}"
        out, files = None, 0
        for batch in batches:
            rows = []
            for page_id, url, text, first, several in zip(
                    *(c.to_pylist() for c in batch.columns)):
                payload = (text or "").encode()
                revisit = several and page_id != first
                if out is None:
                    out = Output(folder, f"{name}-{files:04d}.warc.gz")
                    files += 1
                member = record(page_id, url, payload, first if revisit else None, revisit)
                rows.append((url_key(url), page_field(page_id), out.name, out.write(member),
                             len(member)))
                if out.size >= FILE_BYTES:
                    out.close()
                    out = None
            yield columns(rows, CAPTURE)
        if out is not None:
            out.close()

    captures = stored(with_references(pages, least_revisit).mapInArrow(write, CAPTURE_DDL))
    captures.groupBy("file").agg(F.count("*").alias("records"), F.sum("length").alias("bytes")
                                 ).write.parquet(f"{folder}/manifest")
    return captures


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The archives of a folder: ``(file, records, bytes)``."""
    return spark.read.schema("file string, records bigint, bytes bigint").parquet(
        f"{folder}/manifest")


def members(archives: Ranges, name: str) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and content of each record of an archive."""
    size, read, begin, rest = archives.size(name), 0, 0, b""
    inflate, content = zlib.decompressobj(31), []
    while rest or read < size:
        if not rest:
            rest = archives.read(name, read, min(SCAN, size - read))
            read += len(rest)
        content.append(inflate.decompress(rest))
        rest = inflate.unused_data
        if inflate.eof:
            end = read - len(rest)
            yield begin, end - begin, b"".join(content)
            begin, inflate, content = end, zlib.decompressobj(31), []
    if begin != size:
        raise ValueError(f"{name} ends within a record")


def records(spark: SparkSession, folder: str) -> DataFrame:
    """All records of a folder's archives, as ``look_up`` gives them, one archive per task."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archives, rows, size = Ranges(folder), [], 0
        for batch in batches:
            for name in batch.column(0).to_pylist():
                for offset, length, content in members(archives, name):
                    rows.append(record_row(content, (name, offset, length)))
                    size += len(rows[-1][PAYLOAD])
                    if size >= FLUSH:
                        yield columns(rows, RECORD)
                        rows, size = [], 0
        yield columns(rows, RECORD)

    files = manifest(spark, folder).select("file")
    return files.repartition(max(1, files.count())).mapInArrow(read, RECORD_DDL)


CAPTURE = pa.schema([("key", pa.string()), ("page", pa.string()), ("file", pa.string()),
                     ("offset", pa.int64()), ("length", pa.int64())])
CAPTURE_DDL = "key string, page string, file string, offset bigint, length bigint"


def columns(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    values = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(v, f.type) for v, f in zip(values, schema)], schema=schema)


# -- index -------------------------------------------------------------------

PART = pa.schema([("first", pa.string()), ("last", pa.string()), ("part", pa.string())])
PART_DDL = "first string, last string, part string"


def write_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Write the sorted blocks and their directories.

    Each range of keys has a file of blocks and a directory of one line per block. What comes
    back is one row per range: its first and last key and its files' name. The folder keeps it
    as ``parts``, and readers open no file that isn't named there.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = f"index-{task.partitionId():06d}-{task.taskAttemptId()}"
        blocks = directory = first = last = None
        lines: list[str] = []

        def flush() -> None:
            packed = zlib.compress("\n".join(lines).encode(), 6)
            at = blocks.write(packed)
            key = " ".join(lines[0].split(" ", 2)[:2])
            directory.write(f"{key} {at} {len(packed)}\n".encode())
            lines.clear()

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if blocks is None:
                    blocks, directory = Output(folder, f"{name}.blocks"), Output(folder, f"{name}.dir")
                    first = f"{row[0]} {row[1]}"
                last = f"{row[0]} {row[1]}"
                lines.append(" ".join(map(str, row)))
                if len(lines) >= block_lines:
                    flush()
        if blocks is not None:
            if lines:
                flush()
            blocks.close()
            directory.close()
            yield columns([(first, last, name)], PART)

    order = ["key", "page", "file", "offset"]
    files = -(-captures.count() // FILE_LINES) or 1
    ranged = captures.repartitionByRange(files, *order).sortWithinPartitions(*order)
    ranged.select(*CAPTURE.names).mapInArrow(write, PART_DDL).write.parquet(f"{folder}/parts")
    return index_parts(captures.sparkSession, folder)


def index_parts(spark: SparkSession, folder: str) -> DataFrame:
    """The ranges of keys of an index folder."""
    return spark.read.schema(PART_DDL).parquet(f"{folder}/parts")


class Index:
    """Binary search in one index folder. ``parts`` has one row per range of keys."""

    def __init__(self, folder: str, parts: list[tuple[str, str, str]]):
        self.parts = sorted(parts)
        self.firsts = [p[0] for p in self.parts]
        self.directories, self.blocks = Ranges(folder), Ranges(folder)
        self.block = None
        self.lines: list[str] = []

    def line_at(self, name: str, offset: int) -> tuple[int, str, int] | None:
        """Directory line that begins at or after ``offset``: begin, text, end."""
        size, length = self.directories.size(name), 1024
        while True:
            begin = max(0, offset - 1)
            chunk = self.directories.read(name, begin, min(length, size - begin))
            skip = 0 if offset == 0 else chunk.find(b"\n") + 1
            stop = chunk.find(b"\n", skip)
            if (offset == 0 or skip) and stop >= 0:
                return begin + skip, chunk[skip:stop].decode(), begin + stop + 1
            if begin + length >= size:
                return None
            length *= 4

    def start(self, key: str, part: int) -> int:
        """Offset of the last directory line whose key is below ``key``, or of the first."""
        name = f"{self.parts[part][2]}.dir"
        low, high, found = 0, self.directories.size(name), 0
        while low < high:
            middle = (low + high) // 2
            line = self.line_at(name, middle)
            if line is None or " ".join(line[1].split(" ", 2)[:2]) >= key:
                high = middle
            else:
                found, low = line[0], line[2]
        return found

    def load(self, part: int, offset: int) -> int | None:
        """Make the block of the directory line at ``offset`` current; next line's offset."""
        if self.block == (part, offset):
            return self.next
        name = self.parts[part][2]
        line = self.line_at(f"{name}.dir", offset)
        if line is None:
            return None
        at, length = map(int, line[1].split(" ")[2:])
        raw = zlib.decompress(self.blocks.read(f"{name}.blocks", at, length))
        self.block, self.lines = (part, line[0]), raw.decode().split("\n")
        self.next = line[2]
        return self.next

    def captures(self, key: str) -> Iterator[list[str]]:
        """Fields of the lines whose first two fields are ``key``."""
        low, high = f"{key} ", f"{key}!"  # a blank sorts before all that a field may hold
        if self.block and self.lines[0] < key and high <= self.lines[-1]:
            part, offset = self.block  # a neighbour of the last look-up
        else:
            part = max(0, bisect.bisect_left(self.firsts, key) - 1)
            offset = self.start(key, part) if self.parts else 0
        while part < len(self.parts) and self.firsts[part] < high:
            while (after := self.load(part, offset)) is not None:
                for line in self.lines[bisect.bisect_left(self.lines, low):]:
                    if line >= high:
                        return
                    yield line.split(" ")
                offset = after
            part, offset = part + 1, 0


def look_up(parts: DataFrame, index_folder: str, archive_folder: str,
            wanted: DataFrame) -> DataFrame:
    """Records of ``wanted`` (``url``, ``page_id``), found in the index and read by range.

    A null ``page_id`` in a row of ``wanted`` means a record without one.
    """
    ranges = [tuple(r) for r in parts.collect()]  # one row per range of keys

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [f"{url_key(url)} {page_field(page_id)}"
                     for url, page_id in zip(*(c.to_pylist() for c in batch.columns))]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["key"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, archives = Index(index_folder, ranges), Ranges(archive_folder)
        rows, size = [], 0
        for batch in batches:
            places = [(line[2], int(line[3]), int(line[4]))
                      for key in batch.column(0).to_pylist() for line in index.captures(key)]
            for place in sorted(places):
                rows.append(record_row(gzip.decompress(archives.read(*place)), place))
                size += len(rows[-1][PAYLOAD])
                if size >= FLUSH:
                    yield columns(rows, RECORD)
                    rows, size = [], 0
        yield columns(rows, RECORD)

    sought = stored(wanted.select("url", F.col("page_id").cast("bigint"))
                    .mapInArrow(keys, "key string").distinct())
    tasks = -(-sought.count() // TASK_KEYS) or 1
    return sought.repartitionByRange(tasks, "key").sortWithinPartitions("key").mapInArrow(
        read, RECORD_DDL)


RECORD = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ("payload", pa.binary()), ("file", pa.string()), ("offset", pa.int64()),
    ("length", pa.int64())])
RECORD_DDL = ("page_id bigint, url string, payload_bytes bigint, payload_digest string, "
              "record_type string, refers_to bigint, payload binary, file string, "
              "offset bigint, length bigint")


PAYLOAD = RECORD.get_field_index("payload")


def record_row(raw: bytes, place: tuple[str, int, int]) -> tuple:
    """A record as a row of ``RECORD``."""
    fields, payload = parsed(raw)
    return (page_of(fields["WARC-Record-ID"]), fields["WARC-Target-URI"],
            int(fields["X-Payload-Length"]),
            fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"],
            page_of(fields.get("WARC-Refers-To")), payload, *place)


def archived(pages: DataFrame, least_revisit: int = LEAST_REVISIT) -> DataFrame:
    """Write all pages, index them, and read every record back through the index."""
    root = scratch_dir(pages.sparkSession)
    archives, index = f"{root}/archives", f"{root}/index"
    captures = write_archives(pages, archives, least_revisit)
    parts = write_index(captures, index)
    return look_up(parts, index, archives, pages.select("url", "page_id"))
