"""WARC archives with a two-level capture index.

Every task writes archives of its own, one gzip member per record, and hands
on where each record stands.  Captures are sorted by key (reversed host, then
path) and id into index files of compressed blocks; a sparse directory at each
file's end has the first key of every block.  A look-up finds its file among
the files' first keys, a block by binary search in the directory, and the
record by a range read of the archive.

Files go through pyarrow's file systems, so the shared folder may be local,
HDFS or an object store.  Names are unique per attempt and become visible only
through a table that Spark commits; what a lost task has left is never read.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantloom.llm.store import written
from quantloom.session import scratch_path

LEAST_REVISIT = 100
BLOCK_CAPTURES = 1000
FILE_CAPTURES = 20_000
MAX_INDEX_FILES = 4096
ARCHIVE_BYTES = 256 << 20
LEVEL = 4
DATE = "1970-01-01T00:00:00Z"

_NO_ID = -(2**63)
CAPTURES = "key string, page_id long, archive string, offset long, length long"


def surt(url: str | None) -> str:
    """The key of a URL: host labels from the right, then path and query; null is the empty key."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").rstrip("."), parts.port
    except ValueError:
        return ")" + _clean(url)
    labels = ",".join(reversed(host.split("."))).removesuffix(",www")
    tail = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return _clean(f"{labels}{f':{port}' if port and port not in (80, 443) else ''}){tail}")


def _clean(text: str) -> str:
    """Control characters and blanks as percent codes, so that a line stays a line."""
    return "".join(quote(c) if c <= " " or c == "\x7f" else c for c in text)


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str = DATE) -> bytes:
    """One gzip member: a response with its payload, or a revisit that names the response instead."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Page-Id: {refers_to}"]
    block = http if refers_to is not None else http + payload
    head += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


@dataclass(frozen=True)
class Record:
    kind: str
    page_id: int | None
    url: str | None
    payload_bytes: int
    digest: str
    refers_to: int | None
    payload: bytes | None


def _fields(head: bytes) -> dict[str, str]:
    return {k.lower(): v for k, _, v in (line.partition(": ") for line in head.decode().split("\r\n")[1:])}


def parse(member: bytes) -> Record:
    """Reads a record back; a response must have the payload that its digest says."""
    head, _, rest = zlib.decompress(member, 31).partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    revisit = fields["warc-type"] == "revisit"
    if not revisit and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
    number = lambda name: int(fields[name]) if name in fields else None
    return Record(fields["warc-type"], number("x-page-id"), fields.get("warc-target-uri"), int(_fields(http)["content-length"]), digest, number("x-refers-to-page-id"), None if revisit else payload)


def _system(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def with_first_copies(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """(page_id, url, payload, digest, refers_to): later records of equal payloads name the smallest page_id.

    Rows that share the smallest id are all responses, and so are payloads below
    ``least`` bytes and rows whose copies have no id at all.  A null id comes after all others.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    large = F.length("payload") >= least
    first = rows.where(large).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    later = large & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(first, "digest", "left").select("page_id", "url", "payload", "digest", F.when(later, F.col("first")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes all records and returns the written table of captures."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _system(folder)
        system.create_dir(root, recursive=True)
        sink, name, at = None, "", 0
        for batch in batches:
            rows = []
            for row in range(batch.num_rows):
                page_id, url, payload, digest, refers_to = (batch.column(c)[row].as_py() for c in range(5))
                if sink is None or at >= ARCHIVE_BYTES:
                    if sink is not None:
                        sink.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    sink = system.open_output_stream(f"{root}/{name}", compression=None)
                member = record(page_id, url, payload, digest, refers_to)
                sink.write(member)
                rows.append((surt(url), page_id, name, at, len(member)))
                at += len(member)
            if rows:
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["key", "page_id", "archive", "offset", "length"])
        if sink is not None:
            sink.close()

    return written(pages.select("page_id", "url", "payload", "digest", "refers_to").mapInArrow(run, CAPTURES), "captures")


@dataclass(frozen=True)
class IndexFile:
    """An index file's first key and where its directory stands."""

    key: str
    page_id: int
    name: str
    at: int
    size: int


def _mark(key: str, page_id: int | None) -> tuple[bytes, int]:
    return key.encode(), _NO_ID if page_id is None else page_id


def build_index(captures: DataFrame, folder: str, block: int = BLOCK_CAPTURES) -> list[IndexFile]:
    """Writes the sorted captures in index files; at most ``MAX_INDEX_FILES`` of them are named to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _system(folder)
        system.create_dir(root, recursive=True)
        held: list[tuple] = []
        directory: list[tuple] = []
        sink, name, at = None, f"{uuid.uuid4().hex}.idx", 0

        def flush() -> None:
            nonlocal at, sink
            if sink is None:
                sink = system.open_output_stream(f"{root}/{name}", compression=None)
            packed = zlib.compress("\n".join(json.dumps(line) for line in held).encode(), 6)
            sink.write(packed)
            directory.append((held[0][0], held[0][1], at, len(packed)))
            at += len(packed)
            held.clear()

        for batch in batches:
            for line in zip(*(batch.column(c).to_pylist() for c in range(5))):
                held.append(line)
                if len(held) == block:
                    flush()
        if held:
            flush()
        if sink is not None:
            packed = zlib.compress(json.dumps(directory).encode(), 6)
            sink.write(packed)
            sink.close()
            yield pa.RecordBatch.from_pydict({"key": [directory[0][0]], "page_id": [directory[0][1]], "name": [name], "at": [at], "size": [len(packed)]}, pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("name", pa.string()), ("at", pa.int64()), ("size", pa.int64())]))

    files = min(MAX_INDEX_FILES, max(1, -(-captures.count() // FILE_CAPTURES)))
    order = ["key", "page_id", "archive", "offset"]
    listed = captures.select("key", "page_id", "archive", "offset", "length").repartitionByRange(files, *order).sortWithinPartitions(*order)
    found = written(listed.mapInArrow(run, "key string, page_id long, name string, at long, size long"), "index-files").collect()
    return sorted((IndexFile(r["key"], _NO_ID if r["page_id"] is None else r["page_id"], r["name"], r["at"], r["size"]) for r in found), key=lambda f: (f.key.encode(), f.page_id))


class Reader:
    """Looks keys up in one index file after another, holding one directory and one block."""

    def __init__(self, folder: str, files: list[IndexFile]) -> None:
        self.system, self.root = _system(folder)
        self.files, self.file, self.block = files, -1, -1

    def _open(self, file: int) -> None:
        if file != self.file:
            entry = self.files[file]
            self.input = self.system.open_input_file(f"{self.root}/{entry.name}")
            self.directory = json.loads(zlib.decompress(self.input.read_at(entry.size, entry.at)))
            self.marks = [_mark(key, page_id) for key, page_id, *_ in self.directory]
            self.file, self.block = file, -1

    def _lines(self, block: int) -> list[tuple]:
        if block != self.block:
            _, _, at, size = self.directory[block]
            self.lines = [tuple(json.loads(line)) for line in zlib.decompress(self.input.read_at(size, at)).decode().split("\n")]
            self.line_marks = [_mark(key, page_id) for key, page_id, *_ in self.lines]
            self.block = block
        return self.lines

    def find(self, file: int, key: str, page_id: int | None = None, any_id: bool = False) -> Iterator[tuple]:
        """Captures of this file with the key, of one id or of any."""
        self._open(file)
        low = (key.encode(), _NO_ID) if any_id else _mark(key, page_id)
        high = (key.encode(), 2**63) if any_id else low
        # Equal marks may begin in the block before the first that starts with them.
        for block in range(max(0, bisect.bisect_left(self.marks, low) - 1), len(self.marks)):
            if self.marks[block] > high:
                break
            lines = self._lines(block)
            yield from lines[bisect.bisect_left(self.line_marks, low) : bisect.bisect_right(self.line_marks, high)]


def look_up(wanted: DataFrame, folder: str, files: list[IndexFile], any_id: bool = False) -> DataFrame:
    """The captures of the wanted (url, page_id); with ``any_id`` all captures of the urls."""
    starts = [(f.key.encode(), f.page_id) for f in files]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for url, page_id in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                key = surt(url)
                low = (key.encode(), _NO_ID) if any_id else _mark(key, page_id)
                high = (key.encode(), 2**63) if any_id else low
                first = max(0, bisect.bisect_left(starts, low) - 1)
                rows += [(file, key, page_id) for file in range(first, max(first + 1, bisect.bisect_right(starts, high)))] if starts else []
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else ((), (), ()), (pa.int32(), pa.string(), pa.int64()))], ["file", "key", "page_id"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(folder, files)
        for batch in batches:
            rows = [line for file, key, page_id in zip(*(batch.column(c).to_pylist() for c in range(3))) for line in reader.find(file, key, page_id, any_id)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else ((),) * 5, (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()))], ["key", "page_id", "archive", "offset", "length"])

    asked = wanted.select("url", F.lit(None).cast("long").alias("page_id") if any_id else F.col("page_id").cast("long")).distinct()
    routed = asked.mapInArrow(route, "file int, key string, page_id long").distinct()
    return routed.repartitionByRange("file", "key", "page_id").sortWithinPartitions("file", "key", "page_id").mapInArrow(search, CAPTURES)


def read_records(captures: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """Reads records by their ranges, in the order in which they stand in the archives."""
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", *["payload"] * payloads]
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * payloads
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), *[pa.binary()] * payloads]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _system(folder)
        opened, source = None, None
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part, rows = batch.slice(a, 256), []
                for archive, offset, length in zip(*(part.column(c).to_pylist() for c in range(3))):
                    if archive != opened:
                        opened, source = archive, system.open_input_file(f"{root}/{archive}")
                    r = parse(source.read_at(length, offset))
                    rows.append((r.page_id, r.url, r.payload_bytes, r.digest, r.kind, r.refers_to, *[r.payload] * payloads))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    order = ["archive", "offset"]
    return captures.select("archive", "offset", "length").repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema)


def archive_and_read(spark: SparkSession, pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Archives all pages (page_id, url, html) and reads every record back through the index.

    A null html is an empty payload; null urls share the empty key.  Repeated
    rows are records of their own.
    """
    folder = folder or scratch_path(spark, "warc")
    captures = write_archives(with_first_copies(pages), folder)
    files = build_index(captures, folder)
    return read_records(written(look_up(pages, folder, files), "looked-up"), folder)


#: The same for DuckDB.
ORACLE = f"""
with rows as (
    select page_id, coalesce(html, '') as html, strlen(coalesce(html, '')) as size, sha256(coalesce(html, '')) as digest from pages),
first as (select digest, min(page_id) as page_id from rows where size >= {LEAST_REVISIT} group by digest)
select r.page_id, r.size::bigint as payload_bytes, r.digest as payload_digest,
    case when f.page_id <> r.page_id then 'revisit' else 'response' end as record_type,
    case when f.page_id <> r.page_id then f.page_id end as refers_to
from rows r left join first f on r.digest = f.digest and r.size >= {LEAST_REVISIT}
"""
