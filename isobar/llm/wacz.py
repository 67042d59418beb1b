"""WARC records in ZIP-packaged archives: written by tasks, read by byte ranges without extraction.

An archive is a ZIP file whose members are stored as they are: the WARC data, each record a gzip
member of its own, and an index with each record's offset and length. The reader takes the central directory (ZIP64 where the sizes
or counts say so), locates the index and the data inside the file, and reads each record by its
range. Equal payloads are found by their digest before writing; one of them is a response, the
others are revisits that refer to it. Archives have a bounded size, so a task holds one at a time.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from isobar.llm.common import bounded_batches, free_name, pieces, stored
from isobar.session import scratch_path

ARCHIVE_BYTES = 32 << 20
# ZIP record signatures, names inside the package.
END, END64, LOCATOR64, ENTRY, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
CONTROL = {c: f"%{c:02X}" for c in [*range(32), 127]}


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str, payload: bytes, refers_to: int | None, revisit: bool, uid: str) -> bytes:
    """One WARC record. Control characters of the url are percent-encoded."""
    block = b"" if revisit else HTTP + b"Content-Length: %d\r\n\r\n" % len(payload) + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<urn:uuid:{uid}>"),
        ("WARC-Date", "2024-01-01T00:00:00Z"), ("WARC-Target-URI", url.translate(CONTROL)),
        ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"), ("X-Payload-Length", len(payload)),
        *([("WARC-Profile", REVISIT_PROFILE), ("X-Refers-To-Page", refers_to)] if revisit else []),
        *([("X-Page", page_id)] if page_id is not None else []),
        ("Content-Type", "application/http;msgtype=response"), ("Content-Length", len(block)),
    ]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return f"WARC/1.1\r\n{head}\r\n".encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """A record's page_id, url, payload length, digest, type and reference; a response's payload is checked against them."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    if not version.startswith("WARC/") or len(rest) != int(fields["Content-Length"]) + 4:
        raise ValueError("not a WARC record")
    kind, length = fields["WARC-Type"], int(fields["X-Payload-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    payload = None
    if kind == "response":
        payload = rest[:-4].partition(b"\r\n\r\n")[2]
        if len(payload) != length or payload_digest(payload) != digest:
            raise ValueError("payload differs from its digest")
    number = lambda name: int(fields[name]) if name in fields else None
    return {
        "page_id": number("X-Page"), "url": fields["WARC-Target-URI"], "payload": payload, "payload_bytes": length,
        "payload_digest": digest, "record_type": kind, "refers_to": number("X-Refers-To-Page"),
    }


class Package:
    """An archive being filled; closed into a ZIP file with stored members and ZIP64 sizes."""

    def __init__(self):
        self.data, self.index = io.BytesIO(), []

    def add(self, raw: bytes, url: str) -> None:
        raw = gzip.compress(raw, 6, mtime=0)
        self.index.append(json.dumps({"url": url.translate(CONTROL), "offset": self.data.tell(), "length": len(raw)}))
        self.data.write(raw)

    def write(self, folder: str) -> tuple[str, int]:
        """The new file's path and its number of records. A task that is repeated writes another file; the unused one is never listed."""
        path = f"{folder}/{uuid.uuid4().hex}.wacz"
        system, place = fs.FileSystem.from_uri(path)
        system.create_dir(place.rpartition("/")[0], recursive=True)
        with system.open_output_stream(place) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True) as package:
            for name, content in ((DATA, self.data.getbuffer()), (INDEX, "\n".join(self.index).encode("utf-8", "surrogatepass"))):
                with package.open(name, "w", force_zip64=True) as member:
                    member.write(content)
        return path, len(self.index)


@dataclass(frozen=True)
class Member:
    start: int
    size: int


def _at(source, offset: int, size: int) -> bytes:
    source.seek(offset)
    found = source.read(size)
    if len(found) != size:
        raise ValueError("archive is cut short")
    return found


def members(source, total: int) -> dict[str, Member]:
    """Where each stored member's bytes lie in a ZIP file; a compressed member is an error."""
    tail_start = max(0, total - 65_557)
    tail = _at(source, tail_start, total - tail_start)
    place = tail.rfind(END)
    if place < 0:
        raise ValueError("no ZIP directory")
    count, size, offset = struct.unpack("<HII", tail[place + 10 : place + 20])
    if (count == 0xFFFF or size == 0xFFFFFFFF or offset == 0xFFFFFFFF) and tail[place - 20 : place - 16] == LOCATOR64:
        at = struct.unpack("<Q", tail[place - 12 : place - 4])[0]
        end64 = _at(source, at, 56)
        if end64[:4] != END64:
            raise ValueError("no ZIP64 directory")
        count, size, offset = struct.unpack("<QQQ", end64[32:56])
    directory, found, at = _at(source, offset, size), {}, 0
    for _ in range(count):
        if directory[at : at + 4] != ENTRY:
            raise ValueError("broken ZIP directory")
        flags, method = struct.unpack("<HH", directory[at + 8 : at + 12])
        packed, plain, name_size, extra_size, note_size = struct.unpack("<IIHHH", directory[at + 20 : at + 34])
        header = struct.unpack("<I", directory[at + 42 : at + 46])[0]
        name = directory[at + 46 : at + 46 + name_size].decode("utf-8" if flags & 0x800 else "cp437")
        extra = directory[at + 46 + name_size : at + 46 + name_size + extra_size]
        while len(extra) >= 4:  # sizes that did not fit, in a fixed order
            kind, length = struct.unpack("<HH", extra[:4])
            if kind == 1:
                wide = iter(struct.unpack(f"<{length // 8}Q", extra[4 : 4 + length // 8 * 8]))
                plain = next(wide) if plain == 0xFFFFFFFF else plain
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                header = next(wide) if header == 0xFFFFFFFF else header
            extra = extra[4 + length :]
        if method or packed != plain:
            raise ValueError(f"member {name} is compressed")
        local = _at(source, header, 30)
        if local[:4] != LOCAL:
            raise ValueError("broken ZIP member")
        found[name] = Member(header + 30 + sum(struct.unpack("<HH", local[26:30])), plain)
        at += 46 + name_size + extra_size + note_size
    return found


def read(path: str) -> Iterator[dict]:
    """The records of an archive, each read by its range."""
    system, place = fs.FileSystem.from_uri(path)
    with system.open_input_file(place) as source:
        found = members(source, source.size())
        index, data = found[INDEX], found[DATA]
        for line in _at(source, index.start, index.size).split(b"\n"):
            if line:
                entry = json.loads(line.decode("utf-8", "surrogatepass"))
                if entry["offset"] + entry["length"] > data.size:
                    raise ValueError("record lies outside its member")
                yield parse(gzip.decompress(_at(source, data.start + entry["offset"], entry["length"])))


MANIFEST = pa.schema([("archive", pa.string()), ("records", pa.int64())])
RECORDS = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])


def _written(batches: Iterator[pa.RecordBatch], folder: str, limit: int) -> Iterator[pa.RecordBatch]:
    package = Package()
    row = lambda path, n: pa.RecordBatch.from_pylist([{"archive": path, "records": n}], MANIFEST)
    for batch in batches:
        for page in batch.to_pylist():
            payload = (page["html"] or "").encode("utf-8", "surrogatepass")
            uid = str(uuid.uuid5(uuid.NAMESPACE_URL, f"page:{page['page_id']}"))
            package.add(record(page["page_id"], page["url"] or "", payload, page["refers_to"], page["revisit"], uid), page["url"] or "")
            if package.data.tell() >= limit:
                yield row(*package.write(folder))
                package = Package()
    if package.index:
        yield row(*package.write(folder))


def _read(batches: Iterator[pa.RecordBatch], payload: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("archive").to_pylist():
            held, size = [], 0
            for found in read(path):
                size += found["payload_bytes"] + 500
                held.append(found if payload else found | {"payload": None})
                if size >= 4 << 20:
                    yield pa.RecordBatch.from_pylist(held, RECORDS)
                    held, size = [], 0
            if held:
                yield pa.RecordBatch.from_pylist(held, RECORDS)


def write_archives(pages: DataFrame, folder: str, least: int = 0, limit: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record for each page and return the archives written, with their record counts.

    Of equal payloads of at least ``least`` bytes that with the largest page_id is the response, all rows of
    that page_id included; the others are revisits of it. Where no equal payload has a page_id, all are
    responses. Null html is an empty payload, a null url an empty one. Equal rows are written as often as given.
    """
    key, top = free_name(pages, "_digest"), free_name(pages, "_largest")
    html = F.coalesce("html", F.lit(""))
    keyed = pages.select("page_id", "url", "html").withColumn(key, F.when(F.octet_length(html) >= least, F.sha1(html)))
    largest = keyed.where(f"{key} is not null").groupBy(key).agg(F.max("page_id").alias(top), F.count("*").alias("n")).where("n > 1").drop("n")
    revisit = F.col(top).isNotNull() & ~F.col("page_id").eqNullSafe(F.col(top))
    marked = keyed.join(largest.hint("merge"), key, "left").select(
        F.col("page_id").cast("long").alias("page_id"), "url", "html", revisit.alias("revisit"),
        F.when(revisit, F.col(top)).cast("long").alias("refers_to"))
    bounded_batches(pages.sparkSession)
    return stored(marked.mapInArrow(lambda b: _written(b, folder, limit), "archive string, records long"), "archives")


def read_archives(archives: DataFrame, payload: bool = True) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type and refers_to of all records of the listed archives.

    The names are few bytes, so their partitions would be merged into one: the number of reading tasks is
    stated, one for each archive up to the number of shuffle partitions.
    """
    names = archives.select("archive")
    tasks = max(1, min(names.count(), pieces(archives.sparkSession, 1)))
    return names.repartition(tasks, "archive").mapInArrow(
        lambda b: _read(b, payload),
        "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long")


def round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write all pages to archives in the shared folder and read the records back."""
    folder = scratch_path(pages.sparkSession, "wacz")
    return read_archives(write_archives(pages, folder, least), payload=False).drop("payload", "url")
