"""WARC records in ZIP packages, read back by ranges.

A package is a ZIP file with two stored members: ``archive/data.warc.gz``, one
gzip member per record, and ``indexes/index.cdxj``, one line per record with its
place in the first. The reader parses the central directory (and its ZIP64 forms),
finds where the stored members lie, reads the index and then each record by its
byte range; nothing is extracted.

Of records with equal payloads of at least ``min_revisit_bytes`` the one with the
largest page_id is a response and the others revisit it. Rows that repeat that
page_id are responses too. A null html is an empty payload; a null url leaves its
header out; a null page_id is never referred to and comes back as null. Only
page_id, url and html are read; an empty table gives no package and no row.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import stored, text_of

#: Compressed bytes after which a task begins another package.
PACKAGE_BYTES = 64 << 20
ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
# Signatures and sizes of the ZIP format.
END_RECORD, END64_RECORD, END64_LOCATOR = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
CENTRAL_ENTRY, LOCAL_ENTRY = b"PK\x01\x02", b"PK\x03\x04"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_PREFIX = "urn:wayfare:page:"
RECORD_DATE = "2024-01-01T00:00:00Z"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<{ID_PREFIX}{'none' if page_id is None else page_id}>"


def page_of(record: str) -> int | None:
    name = record.strip("<>").removeprefix(ID_PREFIX)
    return None if name == "none" else int(name)


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record; a revisit carries the response's headers and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {RECORD_DATE}",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}")
    if revisit:
        head += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class PackageWriter:
    """Streams records into one package and notes where each lies."""

    def __init__(self, files: pafs.FileSystem, path: str):
        self.sink = files.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.sink, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(zipfile.ZipInfo(ARCHIVE), "w", force_zip64=True)
        self.lines: list[str] = []
        self.at = 0

    def add(self, page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> None:
        packer = zlib.compressobj(1, zlib.DEFLATED, 31)
        data = packer.compress(record_bytes(page_id, url, payload, refers_to)) + packer.flush()
        self.member.write(data)
        self.lines.append(json.dumps({"record": record_id(page_id), "offset": self.at, "length": len(data)}))
        self.at += len(data)

    def close(self) -> None:
        self.member.close()
        with self.zip.open(zipfile.ZipInfo(INDEX), "w", force_zip64=True) as index:
            index.write("".join(f"{line}\n" for line in self.lines).encode())
        self.zip.close()
        self.sink.close()


def packer(folder: str, package_bytes: int):
    """A function for mapInArrow: page_id, url, html, refers_to to one row per package written.

    Every attempt writes under names of its own, and only rows of the attempt that
    Spark commits name packages, so a task that runs twice leaves no record twice.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pafs.FileSystem.from_uri(folder)
        writer, name, done = None, "", []
        for batch in batches:
            for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if writer is None:
                    files.create_dir(root, recursive=True)
                    name = f"{uuid.uuid4().hex}.zip"
                    writer = PackageWriter(files, f"{root}/{name}")
                writer.add(page_id, url, html.encode(), refers_to)
                if writer.at >= package_bytes:
                    writer.close()
                    done.append((name, len(writer.lines)))
                    writer = None
        if writer is not None:
            writer.close()
            done.append((name, len(writer.lines)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([n for n, _ in done], pa.string()), pa.array([k for _, k in done], pa.int64())], names=["package", "records"]
        )

    return write


def write_packages(pages: DataFrame, folder: str, min_revisit_bytes: int = 0, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Writes a record per page below ``folder`` (a URI every worker reaches); returns package, records."""
    keyed = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), text_of("html").alias("html")
    ).withColumn("digest", F.unhex(F.sha1(F.col("html").cast("binary"))))
    long_enough = F.octet_length("html") >= min_revisit_bytes
    keepers = keyed.where(long_enough).groupBy("digest").agg(F.max("page_id").alias("keeper"))
    # a digest that many pages share is one row here and a skewed key there, which the join may split
    decided = keyed.join(keepers, "digest", "left").select(
        "page_id", "url", "html",
        F.when(F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper")), F.col("keeper")).alias("refers_to"),
    )
    return stored(decided.mapInArrow(packer(folder, package_bytes), "package string, records bigint"), "packages")


@dataclass(frozen=True)
class Member:
    """A stored member: where its bytes begin and how many there are."""

    start: int
    size: int


def zip_members(source) -> dict[str, Member]:
    """Stored members of a ZIP file by name, from its central directory; compressed ones are refused."""
    size = source.size()
    tail_size = min(size, 22 + FULL16 + 20)
    tail = source.read_at(tail_size, size - tail_size)
    end = tail.rfind(END_RECORD)
    if end < 0:
        raise ValueError("no end of central directory")
    entries, length, start = struct.unpack("<H L L", tail[end + 10 : end + 20])
    locator = end - 20
    if (entries == FULL16 or length == FULL32 or start == FULL32) and locator >= 0 and tail[locator : locator + 4] == END64_LOCATOR:
        (at,) = struct.unpack("<Q", tail[locator + 8 : locator + 16])
        record = source.read_at(56, at)
        if record[:4] != END64_RECORD:
            raise ValueError("no ZIP64 end of central directory")
        entries, length, start = struct.unpack("<Q Q Q", record[32:56])
    directory, at, out = source.read_at(length, start), 0, {}
    for _ in range(entries):
        if directory[at : at + 4] != CENTRAL_ENTRY:
            raise ValueError("broken central directory")
        method, = struct.unpack("<H", directory[at + 10 : at + 12])
        packed, full, n_name, n_extra, n_note = struct.unpack("<L L H H H", directory[at + 20 : at + 34])
        (place,) = struct.unpack("<L", directory[at + 42 : at + 46])
        name = directory[at + 46 : at + 46 + n_name].decode()
        extra = directory[at + 46 + n_name : at + 46 + n_name + n_extra]
        full, packed, place = wide_values(extra, (full, packed, place))
        at += 46 + n_name + n_extra + n_note
        if method != zipfile.ZIP_STORED:
            raise ValueError(f"member {name} is compressed; ranges need stored members")
        local = source.read_at(30, place)
        if local[:4] != LOCAL_ENTRY:
            raise ValueError(f"no local header of {name}")
        skip_name, skip_extra = struct.unpack("<H H", local[26:30])
        out[name] = Member(place + 30 + skip_name + skip_extra, full)
    return out


def wide_values(extra: bytes, values: tuple[int, int, int]) -> list[int]:
    """Size, packed size and place, with those that are full taken from the ZIP64 field, where they stand in this order."""
    at, wide = 0, b""
    while at + 4 <= len(extra):
        kind, n = struct.unpack("<H H", extra[at : at + 4])
        if kind == 1:
            wide = extra[at + 4 : at + 4 + n]
        at += 4 + n
    out = []
    for value in values:
        if value == FULL32 and len(wide) >= 8:
            value, wide = struct.unpack("<Q", wide[:8])[0], wide[8:]
        out.append(value)
    return out


def parse_record(data: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Headers, HTTP headers and payload of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines)
    http, _, payload = rest[: int(headers["Content-Length"])].partition(b"\r\n\r\n")
    return headers, http, payload


def package_records(source) -> Iterator[tuple]:
    """page_id, url, record type, payload (None of a revisit), payload bytes, payload digest, refers_to."""
    members = zip_members(source)
    archive, index = members[ARCHIVE], members[INDEX]
    for line in source.read_at(index.size, index.start).decode().splitlines():
        place = json.loads(line)
        data = zlib.decompress(source.read_at(place["length"], archive.start + place["offset"]), 31)
        headers, http, payload = parse_record(data)
        declared = headers["WARC-Payload-Digest"].removeprefix("sha1:")
        size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
        kind = headers["WARC-Type"]
        if headers["WARC-Record-ID"] != place["record"]:
            raise ValueError(f"the index names {place['record']}, the record {headers['WARC-Record-ID']}")
        if kind == "response" and (payload_digest(payload) != declared or len(payload) != size):
            raise ValueError(f"payload of {place['record']} is damaged")
        refers = headers.get("WARC-Refers-To")
        yield (
            page_of(headers["WARC-Record-ID"]), headers.get("WARC-Target-URI"), kind, payload if kind == "response" else None,
            size, declared, None if refers is None else page_of(refers),
        )


RECORDS = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload", pa.binary()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()),
])


def reader(folder: str, columns: tuple[str, ...]):
    """A function for mapInArrow: package names to records."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with files.open_input_file(f"{root}/{name}") as source:
                    rows: list[tuple] = []
                    for row in package_records(source):
                        rows.append(row)
                        if len(rows) == 500:
                            yield chosen(rows, columns)
                            rows = []
                    yield chosen(rows, columns)

    return read


def chosen(rows: list[tuple], columns: tuple[str, ...]) -> pa.RecordBatch:
    places = [RECORDS.names.index(c) for c in columns]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], RECORDS.types[i]) for i in places], names=list(columns))


SPARK_TYPES = {"page_id": "bigint", "url": "string", "record_type": "string", "payload": "binary", "payload_bytes": "bigint", "payload_digest": "string", "refers_to": "bigint"}


def read_packages(packages: DataFrame, folder: str, columns: tuple[str, ...] = tuple(SPARK_TYPES)) -> DataFrame:
    """The records of the named packages; urls come back percent-encoded."""
    schema = ", ".join(f"{c} {SPARK_TYPES[c]}" for c in columns)
    # packages are of like size, so one each is a fair share of work
    return packages.select("package").mapInArrow(reader(folder, columns), schema)
