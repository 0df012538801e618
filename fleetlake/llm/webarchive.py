"""Web archives in ZIP packages: writing WARC records, and range-reading them without extraction.

A package is a ZIP file with a stored member ``archive/data.warc.gz`` (one gzip
member per record) and a stored index ``indexes/index.cdxj`` (a line per record:
key, date, JSON with offset and length inside the WARC member).

Reading parses the end of the file: the end-of-central-directory record, the
ZIP64 locator and record where sizes need them, and the central directory.  It
finds the data of a member behind its local header, reads the index, cuts
the records into ranges of at most ``RANGE`` bytes (or one record), and reads
each range by itself, so that even one large package is read by many tasks.

Records of equal payloads (same SHA-1 and length) are stored once: the largest
page_id holds the payload as ``response``, the others are ``revisit`` records
that refer to it.  A null html is an empty payload; a null page_id is left out;
rows that repeat a page_id give a record each, and those with the keeper's id are
responses.  A missing url is named after the page.  Further columns are ignored.

Packages and readers use the file system of the path (``pyarrow.fs``), so tasks
on any executor see the same files.
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
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_batches, run_folder, width, written

# Member names, record names and signatures of the formats.
WARC_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.cdxj"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END, END64, LOCATOR64 = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
CENTRAL, LOCAL = b"PK\x01\x02", b"PK\x03\x04"
DATE = "2024-01-01T00:00:00Z"
RANGE = 4 << 20

ReadAt = Callable[[int, int], bytes]


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()  # noqa: S324 - the format's digest


# --- ZIP directories


@dataclass
class Member:
    name: str
    method: int
    size: int
    packed: int
    header: int


def _extra64(extra: bytes, fields: list[int], full: list[int]) -> list[int]:
    """``fields`` with those at their 32-bit limit taken from the ZIP64 extra field."""
    at = 0
    while at + 4 <= len(extra):
        tag, size = struct.unpack_from("<HH", extra, at)
        if tag == 1:
            body, k = extra[at + 4:at + 4 + size], 0
            for i, value in enumerate(fields):
                if value == full[i]:
                    fields[i] = struct.unpack_from("<Q", body, k)[0]
                    k += 8
            return fields
        at += 4 + size
    return fields


def directory(read: ReadAt, size: int) -> dict[str, Member]:
    """Members of the ZIP file of ``size`` bytes behind ``read``, from its central directory."""
    tail_at = max(0, size - (1 << 16) - 22)
    tail = read(tail_at, size - tail_at)
    found = tail.rfind(END)
    while found >= 0:  # a comment may hold the signature: the comment's length decides
        if found + 22 <= len(tail) and found + 22 + struct.unpack_from("<H", tail, found + 20)[0] == len(tail):
            break
        found = tail.rfind(END, 0, found)
    if found < 0:
        raise ValueError("not a ZIP file: no end of central directory")
    entries, length, start = struct.unpack_from("<HII", tail, found + 10)
    if 0xFFFF in (entries,) or 0xFFFFFFFF in (length, start):
        locator = read(tail_at + found - 20, 20)
        if locator[:4] == LOCATOR64:
            at = struct.unpack_from("<Q", locator, 8)[0]
            record = read(at, 56)
            if record[:4] != END64:
                raise ValueError("damaged ZIP64 end of central directory")
            entries, length, start = struct.unpack_from("<QQQ", record, 32)
    raw, at, members = read(start, length), 0, {}
    for _ in range(entries):
        if raw[at:at + 4] != CENTRAL:
            raise ValueError("damaged central directory")
        flags, method = struct.unpack_from("<HH", raw, at + 8)
        packed, full, n, m, k = struct.unpack_from("<IIHHH", raw, at + 20)
        header = struct.unpack_from("<I", raw, at + 42)[0]
        name = raw[at + 46:at + 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
        limit = 0xFFFFFFFF
        full, packed, header = _extra64(raw[at + 46 + n:at + 46 + n + m], [full, packed, header], [limit] * 3)
        members[name] = Member(name, method, full, packed, header)
        at += 46 + n + m + k
    return members


def data_offset(read: ReadAt, member: Member) -> int:
    """Where the bytes of a stored member begin."""
    if member.method != 0 or member.size != member.packed:
        raise ValueError(f"{member.name} is compressed: it can't be range-read")
    head = read(member.header, 30)
    if head[:4] != LOCAL:
        raise ValueError(f"damaged local header of {member.name}")
    n, m = struct.unpack_from("<HH", head, 26)
    return member.header + 30 + n + m


# --- WARC records


def record(page_id: int, url: str | None, payload: bytes, refers_to: int | None, full_bytes: int, sha1: str) -> bytes:
    """One WARC record: a response, or a revisit that ``refers_to`` another page."""
    name = f"urn:x-page:{page_id}"
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {full_bytes}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{name}>",
            f"WARC-Date: {DATE}", f"WARC-Target-URI: {quote(url, safe='%/:=&?~#+!$,;@()*[]') if url else name}",
            f"WARC-Payload-Digest: sha1:{sha1}"]
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:x-page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC fields, HTTP fields (lower-case names) and payload of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    inner = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in http.decode("latin-1").split("\r\n")[1:])}
    return fields, inner, payload


def package(records: list[tuple[int, str | None, bytes]]) -> bytes:
    """A ZIP package of ``(page_id, url, gzipped record)``."""
    body, lines, at = io.BytesIO(), [], 0
    for page_id, url, packed in records:
        body.write(packed)
        lines.append(f"{page_id:020d} {DATE} " + json.dumps({"url": url, "offset": at, "length": len(packed)}))
        at += len(packed)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        z.writestr(WARC_MEMBER, body.getvalue())
        z.writestr(INDEX_MEMBER, "\n".join(sorted(lines)))
    return out.getvalue()


def opened(path: str) -> tuple[ReadAt, int]:
    """Range reads of a file in any file system that ``pyarrow.fs`` knows, and its size."""
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    file = system.open_input_file(inner)
    return (lambda at, n: file.read_at(n, at)), file.size()


def ranges(path: str, limit: int = RANGE) -> Iterator[tuple[int, int, list[int]]]:
    """(offset, length, lengths of the records) of pieces of the package's WARC member."""
    read, size = opened(path)
    members = directory(read, size)
    index, data = members[INDEX_MEMBER], members[WARC_MEMBER]
    start = data_offset(read, data)
    lines = read(data_offset(read, index), index.size).decode().splitlines()
    places = sorted((e["offset"], e["length"]) for e in (json.loads(x.split(" ", 2)[2]) for x in lines if x))
    at, sizes = 0, []
    for offset, length in places:
        if sizes and (offset != at + sum(sizes) or sum(sizes) + length > limit):
            yield start + at, sum(sizes), sizes
            sizes = []
        if not sizes:
            at = offset
        sizes.append(length)
    if sizes:
        yield start + at, sum(sizes), sizes


# --- Spark


def roles(pages: DataFrame, least: int = 0) -> DataFrame:
    """``(page_id, html, url, keeper)``: keeper is the page whose record holds the payload (itself: response)."""
    body = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    own = (pages.where("page_id is not null").select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), body.alias("payload"), F.sha1(body).alias("sha1")))
    keys = own.select("page_id", "sha1", F.octet_length("payload").alias("n"))
    keepers = keys.where(F.col("n") >= least).groupBy("sha1", "n").agg(
        F.max("page_id").alias("keeper"), F.count("*").alias("copies")).where("copies > 1")
    revisits = (keys.join(keepers, ["sha1", "n"]).where("page_id <> keeper").select("page_id", "sha1", "keeper").distinct())
    return own.join(revisits, ["page_id", "sha1"], "left")


def write_packages(pages: DataFrame, folder: str, least: int = 0, package_bytes: int = 8 << 20) -> DataFrame:
    """Write the WARC packages of ``pages(page_id, url, html)`` under ``folder``; returns ``(path)`` of each.

    A task names each package anew, so a repeated task never touches a package that was handed on."""

    def run(batches):
        import pyarrow as pa
        from pyarrow import fs

        system, inner = fs.FileSystem.from_uri(folder)
        system.create_dir(inner, recursive=True)
        waiting, size = [], 0

        def put():
            name = f"{uuid.uuid4().hex}.zip"
            with system.open_output_stream(f"{inner}/{name}") as out:
                out.write(package(waiting))
            return pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"])], ["path"])

        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                for page_id, url, payload, keeper in zip(*(c.to_pylist() for c in batch.slice(at, 200).columns), strict=True):
                    raw = record(page_id, url, payload, keeper, len(payload), digest(payload))
                    packed = gzip.compress(raw, 4, mtime=0)
                    waiting.append((page_id, url, packed))
                    size += len(packed)
                    if size >= package_bytes:
                        yield put()
                        waiting.clear()
                        size = 0
        if waiting:
            yield put()

    return written(roles(pages, least).select("page_id", "url", "payload", "keeper").transform(in_batches, run, "path string"),
                   "packages")


def read_packages(paths: DataFrame, with_payload: bool = False) -> DataFrame:
    """Records of the packages at ``paths(path)``: page_id, url, payload_bytes, payload_digest, record_type,
    refers_to[, payload]; payload is null for a revisit.  A payload that differs from its digest is an error."""
    schema = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
              + (", payload binary" if with_payload else ""))

    def locate(batches):
        import pyarrow as pa

        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows = [(path, *r) for r in ranges(path)]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (
                            pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int32())), strict=True)],
                        ["path", "at", "length", "sizes"])

    def fetch(batches):
        import pyarrow as pa

        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
        for batch in batches:
            for path, at, length, sizes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                read, _ = opened(path)
                raw, lo, rows = read(at, length), 0, []
                for n in sizes:
                    fields, http, payload = parse(zlib.decompress(raw[lo:lo + n], 31))
                    lo += n
                    name, kind = fields["warc-record-id"], fields["warc-type"]
                    stated = fields["warc-payload-digest"].removeprefix("sha1:")
                    if kind == "response" and digest(payload) != stated:
                        raise ValueError(f"payload of {name} in {path} differs from its digest")
                    target = fields.get("warc-refers-to")
                    rows.append((int(name.strip("<>").rpartition(":")[2]), fields["warc-target-uri"],
                                 len(payload) if kind == "response" else int(http["content-length"]), stated, kind,
                                 int(target.strip("<>").rpartition(":")[2]) if target else None,
                                 payload if kind == "response" else None))
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                keep = 7 if with_payload else 6
                yield pa.RecordBatch.from_arrays(columns[:keep], names[:keep])

    # a stated number, which is not merged: descriptors are tiny and say nothing of the bytes behind them
    tasks = width(paths.sparkSession)
    found = paths.repartition(tasks, "path").transform(in_batches, locate, "path string, at long, length long, sizes array<int>")
    return found.repartition(tasks, "path", "at").transform(in_batches, fetch, schema)


def round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write packages of all ``pages`` in the shared folder and read every record back."""
    spark = pages.sparkSession
    return read_packages(write_packages(pages, run_folder(spark, "warc"), least))
