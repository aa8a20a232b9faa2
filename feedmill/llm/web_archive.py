"""WARC records in ZIP-packaged archives, and a reader that extracts nothing.

A package is a ZIP file with stored members: ``archive/data.warc.gz``, where every record
is a gzip member of its own, and ``indexes/index.cdxj``, one line a record with its place
in the archive. The reader asks for byte ranges only: the end of the file, its central
directory (through the ZIP64 directory where sizes or counts need it), the index member,
and then single records.

Packages are rows of a Parquet table (name, content) written by Spark, hence valid on any
store that Spark reaches; ``FileRange`` reads the same from a file.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from feedmill.llm.tables import text_of
from feedmill.session import cut

DATA = "archive/data.warc.gz"
INDEX = "indexes/index.cdxj"
# A package is closed once its records reach this size; a larger record is a package of its own.
PACKAGE_BYTES = 8 << 20
# Payloads of fewer bytes are never replaced by a revisit.
SMALLEST_REVISIT = 1000
DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_LOCAL = struct.Struct("<4s5H3L2H")
_CENTRAL = struct.Struct("<4s6H3L5H2L")
_END = struct.Struct("<4s4H2LH")
_END64 = struct.Struct("<4sQ2H2L4Q")
_LOCATOR = struct.Struct("<4sLQL")
_FULL32, _FULL16 = 0xFFFFFFFF, 0xFFFF


# --- packages --------------------------------------------------------------------

def pack(members: list[tuple[str, bytes]], zip64: bool | None = None) -> bytes:
    """A ZIP file of stored members; ZIP64 directories where needed, or as asked for."""
    out: list[bytes] = []
    central: list[bytes] = []
    at = 0
    for name, data in members:
        raw, crc, size = name.encode(), zlib.crc32(data), len(data)
        big = zip64 if zip64 is not None else max(size, at) >= _FULL32
        small = _FULL32 if big else size
        extra = struct.pack("<HHQQ", 1, 16, size, size) if big else b""
        out += [_LOCAL.pack(b"PK\x03\x04", 45, 0x800, 0, 0, 0x21, crc, small, small, len(raw), len(extra)), raw, extra, data]
        more = struct.pack("<HHQQQ", 1, 24, size, size, at) if big else b""
        central.append(_CENTRAL.pack(b"PK\x01\x02", 45, 45, 0x800, 0, 0, 0x21, crc, small, small, len(raw), len(more), 0, 0, 0, 0,
                                     _FULL32 if big else at) + raw + more)
        at += _LOCAL.size + len(raw) + len(extra) + size
    directory = b"".join(central)
    big = zip64 if zip64 is not None else at >= _FULL32 or len(members) >= _FULL16 or len(directory) >= _FULL32
    tail = b""
    if big:
        tail = _END64.pack(b"PK\x06\x06", _END64.size - 12, 45, 45, 0, 0, len(members), len(members), len(directory), at)
        tail += _LOCATOR.pack(b"PK\x06\x07", 0, at + len(directory), 1)
    count = _FULL16 if big else len(members)
    tail += _END.pack(b"PK\x05\x06", 0, 0, count, count, _FULL32 if big else len(directory), _FULL32 if big else at, 0)
    return b"".join([*out, directory, tail])


class BytesRange:
    """Byte ranges of a package in memory."""

    def __init__(self, data: bytes):
        self.data, self.size = memoryview(data), len(data)

    def read(self, start: int, size: int) -> bytes:
        return bytes(self.data[start:start + size])


class FileRange:
    """Byte ranges of a package file."""

    def __init__(self, path: str):
        self.file = open(path, "rb")  # noqa: SIM115 - open as long as the reader is
        self.size = self.file.seek(0, 2)

    def read(self, start: int, size: int) -> bytes:
        self.file.seek(start)
        return self.file.read(size)


@dataclass(frozen=True)
class Member:
    """A member of a package: where its header begins, how it is packed, its size."""

    name: str
    header: int
    method: int
    size: int


class Package:
    """The members of a ZIP file, found through its directories."""

    def __init__(self, source: BytesRange | FileRange):
        self.source = source
        tail_size = min(source.size, _END.size + _FULL16)
        tail = source.read(source.size - tail_size, tail_size)
        at = tail.rfind(b"PK\x05\x06")
        while at >= 0 and (at + _END.size > len(tail) or at + _END.size + _END.unpack_from(tail, at)[7] != len(tail)):
            at = tail.rfind(b"PK\x05\x06", 0, at)
        if at < 0:
            raise ValueError("no end of central directory")
        _, _, _, _, count, size, start, _ = _END.unpack_from(tail, at)
        end = source.size - tail_size + at
        if count == _FULL16 or size == _FULL32 or start == _FULL32:
            place = end - _LOCATOR.size
            locator = _LOCATOR.unpack(source.read(place, _LOCATOR.size)) if place >= 0 else (b"",)
            if locator[0] != b"PK\x06\x07":
                raise ValueError("no ZIP64 locator")
            end64 = _END64.unpack(source.read(locator[2], _END64.size))
            if end64[0] != b"PK\x06\x06":
                raise ValueError("no ZIP64 end of central directory")
            count, size, start = end64[7], end64[8], end64[9]
        self.members = {m.name: m for m in self._directory(source.read(start, size), count)}

    @staticmethod
    def _directory(data: bytes, count: int) -> Iterator[Member]:
        at = 0
        for _ in range(count):
            head = _CENTRAL.unpack_from(data, at)
            if head[0] != b"PK\x01\x02":
                raise ValueError("broken central directory")
            method, packed, size, name_size, extra_size, note_size, offset = head[4], head[8], head[9], head[10], head[11], head[12], head[16]
            at += _CENTRAL.size
            name = data[at:at + name_size].decode("utf-8" if head[3] & 0x800 else "cp437")
            extra, k = data[at + name_size:at + name_size + extra_size], 0
            while k + 4 <= len(extra):
                kind, length = struct.unpack_from("<HH", extra, k)
                if kind == 1:
                    values = iter(struct.unpack_from(f"<{length // 8}Q", extra, k + 4))
                    size = next(values) if size == _FULL32 else size
                    packed = next(values) if packed == _FULL32 else packed
                    offset = next(values) if offset == _FULL32 else offset
                k += 4 + length
            at += name_size + extra_size + note_size
            yield Member(name, offset, method, packed)

    def data_start(self, member: Member) -> int:
        """Where the bytes of a stored member begin: its own header may be longer."""
        if member.method != 0:
            raise ValueError(f"{member.name} is compressed: its records have no place in the file")
        head = _LOCAL.unpack(self.source.read(member.header, _LOCAL.size))
        if head[0] != b"PK\x03\x04":
            raise ValueError("broken member header")
        return member.header + _LOCAL.size + head[9] + head[10]

    def index(self) -> Iterator[dict]:
        """The lines of the index member."""
        member = self.members[INDEX]
        for line in self.source.read(self.data_start(member), member.size).decode().splitlines():
            yield json.loads(line.split(" ", 2)[2])

    def record(self, offset: int, length: int, filename: str = DATA) -> tuple[dict[str, str], bytes]:
        """Headers and payload of one record, by one range of the archive member."""
        raw = gzip.decompress(self.source.read(self.data_start(self.members[filename]) + offset, length))
        head, _, body = raw.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        block = body[:int(headers["Content-Length"])]
        return headers, block.partition(b"\r\n\r\n")[2]


def record_bytes(kind: str, page: int | None, number: str, url: str | None, digest: str, size: int, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record, a gzip member."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (payload if kind == "response" else b"")
    headers = [
        ("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{number}>"), ("WARC-Date", DATE),
        ("WARC-Target-URI", (url or "").replace("\r", "%0D").replace("\n", "%0A")), ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(size)), ("Content-Length", str(len(block)))]
    if page is not None:
        headers.append(("X-Page", str(page)))
    if kind == "revisit":
        headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers)
    return gzip.compress(head.encode() + b"\r\n" + block + b"\r\n\r\n", compresslevel=6, mtime=0)


# --- tables ----------------------------------------------------------------------

def write_packages(pages: DataFrame, path: str, *, smallest_revisit: int = SMALLEST_REVISIT) -> None:
    """Write a record for every page (page_id, url, html) to packages at ``path``.

    Of pages with equal payloads of at least ``smallest_revisit`` bytes, the one with the
    largest page_id is the response and the others are revisits of it; rows that repeat
    that very page_id are responses too, one each. A null html is empty; a page with a null
    page_id is a revisit if another page has its payload, else a response; a null url is
    empty. Other columns are ignored.

    Payloads are compared by their SHA-1 and length. The largest page_id of a payload is
    found by an aggregate that combines in the tasks; only payloads with several pages meet
    the pages again, in a join that Spark splits where one payload has very many.
    """
    hashed = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", text_of("html").cast("binary").alias("payload"),
    ).withColumn("digest", F.sha1("payload")).withColumn("size", F.octet_length("payload").cast("long"))
    shared = cut(
        hashed.where(F.col("size") >= smallest_revisit).groupBy("digest")
        .agg(F.max("page_id").alias("last"), F.count("*").alias("pages")).where("pages > 1 AND last IS NOT NULL").select("digest", "last"),
        "payloads")
    decided = hashed.join(shared, "digest", "left").select(
        "page_id", "url", "payload", "digest", "size",
        F.when(F.col("last") != F.coalesce("page_id", F.lit(-1) - F.abs("last")), F.col("last")).alias("refers_to"))

    def packages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        held: list[bytes] = []
        lines: list[str] = []
        at = 0

        def close() -> pa.RecordBatch:
            content = pack([(DATA, b"".join(held)), (INDEX, "".join(f"{x}\n" for x in sorted(lines)).encode())])
            return pa.RecordBatch.from_pydict({"name": pa.array([f"pages-{part:05d}-{seq:05d}.wacz"]), "content": pa.array([content], pa.binary())})

        for batch in batches:
            for k in range(batch.num_rows):
                page, url, payload, digest, size, last = (batch.column(j)[k].as_py() for j in range(6))
                kind = "response" if last is None else "revisit"
                number = str(page) if page is not None else f"none-{part}-{seq}-{len(held)}"
                record = record_bytes(kind, page, number, url, digest, size, payload, last)
                place = {"url": url or "", "digest": f"sha1:{digest}", "offset": at, "length": len(record), "filename": DATA}
                lines.append(f"{''.join((url or '-').split()) or '-'} 20240101000000 {json.dumps(place)}")
                held.append(record)
                at += len(record)
                if at >= PACKAGE_BYTES:
                    yield close()
                    held, lines, at, seq = [], [], 0, seq + 1
        if held:
            yield close()

    decided.mapInArrow(packages, "name string, content binary").write.option("parquet.block.size", 8 << 20).parquet(path)


def read_packages(spark: SparkSession, path: str) -> DataFrame:
    """A row a record: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Every record is read by its range from the index. A response's payload is measured and
    hashed again and must agree with its headers; a revisit has those of what it repeats.
    """

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                package = Package(BytesRange(batch.column(0)[k].as_py()))
                rows: list[tuple] = []
                for line in package.index():
                    headers, payload = package.record(line["offset"], line["length"], line["filename"])
                    digest, size = headers["WARC-Payload-Digest"].removeprefix("sha1:"), int(headers["X-Payload-Length"])
                    kind = headers["WARC-Type"]
                    if kind == "response" and (len(payload), hashlib.sha1(payload).hexdigest()) != (size, digest):
                        raise ValueError(f"record {headers['WARC-Record-ID']} is damaged")
                    last = headers.get("WARC-Refers-To")
                    rows.append((int(headers["X-Page"]) if "X-Page" in headers else None, size, digest, kind,
                                 int(last.removeprefix("<urn:page:").removesuffix(">")) if last else None))
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()), strict=True)],
                    names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return spark.read.schema("name string, content binary").parquet(path).select("content").mapInArrow(
        records, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


SQL = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS payload_digest,
         CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes
  FROM pages
), m AS (
  SELECT *, CASE WHEN payload_bytes >= {SMALLEST_REVISIT} THEN max(page_id) OVER (PARTITION BY payload_digest) END AS last FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN last IS NULL OR last = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN last IS NULL OR last = page_id THEN NULL ELSE last END AS refers_to
FROM m
"""
