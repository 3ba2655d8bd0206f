"""Legacy ARC archives: write, parse by version, convert to WARC, read back.

An ARC file opens with a version block that names the version and its header
fields; version 1 lines hold five fields, version 2 lines ten, and each
declares the length of the content that follows.  The converter synthesises
what WARC wants: record ids (UUIDs from a digest of what identifies the
record), ISO timestamps, record types and payload digests; of records with
equal payloads all but one become revisits.

Archives are whole files of about ``FILE_BYTES`` before compression; a task
packs its rows into files, and Spark writes each as one gzip file, with its
own commit protocol, wherever its file systems reach.  Readers take files
through Spark's binary source and parse them as they are unpacked.  Only
(digest, id) pairs are grouped to find equal payloads; the payload itself is
shuffled at most once, by page, to meet its decision.

Defined cases: null html is an empty payload; a null or empty url is written
as "-"; white space and control characters in a url are percent-encoded; pages
with a null id are responses; rows that repeat id and html become records of
the same type, each with an id of its own; payloads under
``MIN_REVISIT_BYTES`` are always responses; empty tables give no files.

Legacy lines are read from both ends, so urls and content types may hold
spaces.  What cannot be read (a line without a valid date or length, a record
cut short, a file without version block, a damaged gzip member) is a reject with
its file, its number there, a reason and the bytes in question; reading goes on
with the next line that is a header.  A malformed WARC file raises.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from datetime import datetime
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize

FILE_BYTES = 16 << 20
MIN_REVISIT_BYTES = 100
CAPTURED = "20240101000000"

# The field names that each ARC version declares.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}

_SPACE = re.compile(r"[\x00-\x20\x7f]")


# --- files ---------------------------------------------------------------

def _pack(head: Callable[[str], bytes], records: Iterable[bytes], separator: bytes, file_bytes: int) -> Iterator[bytes]:
    """Whole files (without their last separator): a head and its records."""
    task, number = TaskContext.get().partitionId(), 0
    held: list[bytes] = []
    size = 0
    for record in records:
        if not held:
            held = [head(f"{task:06d}-{number:06d}")]
        held.append(record)
        size += len(record)
        if size >= file_bytes:
            yield separator.join(held)
            held, size, number = [], 0, number + 1
    if held:
        yield separator.join(held)


def _write_files(rows: DataFrame, make: Callable[[Iterator[pa.RecordBatch]], Iterator[bytes]], path: str,
                 separator: str) -> None:
    """One gzip file per packed file; Spark ends each with the separator."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for content in make(batches):
            yield pa.RecordBatch.from_arrays([pa.array([content], pa.large_binary()).cast(pa.binary())], names=["file"])

    files = rows.mapInArrow(run, "file binary").select(F.col("file").cast("string").alias("value"))
    files.write.mode("overwrite").option("maxRecordsPerFile", 1).option("compression", "gzip").option(
        "zlib.compress.level", "BEST_SPEED").option("lineSep", separator).text(path)


def _read_files(spark: SparkSession, path: str, parse: Callable[[io.BufferedReader, str], Iterator[tuple]],
                schema: str, types: list[pa.DataType]) -> DataFrame:
    names = [f.split(" ")[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                unpacked = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content.as_py())), 1 << 20)
                held, size = [], 0
                for row in parse(unpacked, name):
                    held.append(row)
                    size += sum(len(v) for v in row if isinstance(v, bytes)) + 100
                    if size >= 4 << 20:
                        yield _batch(held, names, types)
                        held, size = [], 0
                if held:
                    yield _batch(held, names, types)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("path", "content").mapInArrow(run, schema)


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                                      names=names)


def _exactly(file: io.BufferedReader, n: int, name: str) -> bytes:
    content = file.read(n)
    if len(content) < n:
        raise ValueError(f"{name}: a record declares {n} bytes, {len(content)} are left")
    return content


# --- ARC -----------------------------------------------------------------

def arc_head(version: int, name: str) -> bytes:
    """The version block that opens an ARC file, without the separator."""
    body = f"{version} 0 tributary\n{ARC_FIELDS[version]}\n".encode()
    fields = {1: "text/plain", 2: "text/plain 200 - - 0 " + f"{name}.arc"}[version]
    return f"filedesc://{name}.arc 0.0.0.0 {CAPTURED} {fields} {len(body)}\n".encode() + body


def arc_record(version: int, url: str | None, date: str, name: str, content: bytes) -> bytes:
    url = target(url or "-")
    fields = {1: "text/html", 2: f"text/html 200 - - 0 {name}.arc"}[version]
    return f"{url} 0.0.0.0 {date} {fields} {len(content)}\n".encode() + content


def http_block(page_id: int | None, payload: bytes) -> bytes:
    """The stored exchange: a response head and the payload."""
    own = "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
    return (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{own}"
            f"Content-Length: {len(payload)}\r\n\r\n").encode() + payload


def write_arc(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html",
              file_bytes: int = FILE_BYTES) -> None:
    """Store pages as ARC files; odd tasks write version 1, even ones version 2."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
        version = 2 - TaskContext.get().partitionId() % 2

        def records() -> Iterator[bytes]:
            for batch in batches:
                for i, u, h in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    yield arc_record(version, u, CAPTURED, "pages", http_block(i, (h or "").encode()))
        return _pack(lambda name: arc_head(version, name), records(), b"\n", file_bytes)

    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                        F.col(html).cast("string").alias("html"))
    _write_files(rows, make, path, "\n")


_IP = re.compile(rb"[0-9.]+|[0-9A-Fa-f:.]*:[0-9A-Fa-f:.]*")
_MIME = re.compile(rb"[^ ;]+(?: *;.*)?")  # a type, parameters after a semicolon
#: A line this long without an end is no header.
LINE_BYTES = 1 << 16


def is_date(digits: bytes) -> bool:
    """4 to 14 digits that name a time (missing ones are the earliest)."""
    if not (digits.isdigit() and 4 <= len(digits) <= 14 and len(digits) % 2 == 0):
        return False
    try:
        datetime.strptime(_full(digits.decode()), "%Y%m%d%H%M%S")
    except ValueError:
        return False
    return True


def _full(date: str) -> str:
    return (date + "00000101000000"[len(date):])[:14]


def header_fields(line: bytes, version: int) -> tuple[bytes, bytes, bytes, bytes, bytes | None, int] | None:
    """(url, ip, date, content type, status, length) of a header line, or None.

    The length is the last field, in version 2 after five others without
    spaces; the date is the last time that follows an address.  What stands
    before the address is the url, what follows the date the content type.
    """
    fields = line.rstrip(b"\r\n").split(b" ")
    behind = len(ARC_FIELDS[version].split()) - 4  # the fields after the content type
    if len(fields) < 4 + behind or not re.fullmatch(rb"[0-9]{1,18}", fields[-1]):
        return None
    for at in range(len(fields) - behind - 2, 1, -1):
        if is_date(fields[at]) and _IP.fullmatch(fields[at - 1]):
            url, mime = b" ".join(fields[:at - 1]), b" ".join(fields[at + 1:len(fields) - behind])
            status = fields[-behind] if version == 2 else None
            if not url.strip() or not _MIME.fullmatch(mime):
                return None
            return url, fields[at - 1], fields[at], mime, status, int(fields[-1])
    return None


class ArcEntry(NamedTuple):
    """A record of an ARC file (number from 0), or, with a reason, a reject."""

    number: int
    url: str | None
    ip: str | None
    date: str | None
    mime: str | None
    status: str | None
    content: bytes
    reason: str | None = None


def parse_arc(file: io.BufferedReader) -> Iterator[ArcEntry]:
    """Every record of an ARC file, and what could not be read of it."""
    number = 0

    def reject(reason: str, content: bytes) -> ArcEntry:
        return ArcEntry(number, None, None, None, None, None, content, reason)

    try:
        line = file.readline(LINE_BYTES)
        if not line:
            return  # a task without rows leaves an empty file
        first = line.split()
        size = first[-1] if first else b""
        if len(first) < 5 or not first[0].startswith(b"filedesc:") or not size.isdigit():
            yield reject("no version block", line)
            return
        body = file.read(int(size)).split(b"\n")
        found = re.match(rb"([0-9]+)(?: |$)", body[0])
        version = int(found[1]) if found else None
        if version not in ARC_FIELDS:
            yield reject("unknown version", b"\n".join(body))
            return
        lost = False  # whether the lines since the last record are rejects
        while line := file.readline(LINE_BYTES):
            if not line.strip():
                continue
            fields = header_fields(line, version)
            if fields is None:
                if not lost:
                    yield reject("header line", line)
                    number, lost = number + 1, True
                continue
            content = file.read(fields[-1])
            if len(content) < fields[-1]:
                yield reject(f"{fields[-1]} bytes declared, {len(content)} left", line + content)
                number, lost = number + 1, True
                file = io.BytesIO(content)  # a wrong length may have swallowed records
                continue
            url, ip, date, mime, status = (None if v is None else v.decode("utf-8", "replace") for v in fields[:-1])
            yield ArcEntry(number, url, ip, date, mime, status, content)
            number, lost = number + 1, False
    except (EOFError, OSError, zlib.error) as damage:
        yield reject(f"damaged file: {damage}", b"")


def split_http(content: bytes) -> tuple[bytes, bytes]:
    """The head (with its empty line) and the payload of a stored exchange;
    content that is no HTTP response is all payload."""
    if not content.startswith(b"HTTP/"):
        return b"", content
    head, mark, payload = content.partition(b"\r\n\r\n")
    return head + mark, payload


def head_field(head: bytes, name: bytes) -> str | None:
    found = re.search(rb"(?im)^" + re.escape(name) + rb":\x20*([^\r\n]*)", head)
    return found[1].decode("utf-8", "replace") if found else None


_RECORD_SCHEMA = ("page_id long, url string, ip string, date string, mime string, head binary, payload binary, "
                  "digest string, place string")
_RECORD_TYPES = [pa.int64(), *[pa.string()] * 4, pa.binary(), pa.binary(), pa.string(), pa.string()]
_REJECT_SCHEMA = "file string, number long, reason string, content binary"
_REJECT_TYPES = [pa.string(), pa.int64(), pa.string(), pa.binary()]


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """The records of all ARC files under ``path``, with payload digests and
    the place (file and number) that tells repeated records apart."""
    def parse(file, name):
        base = name.rsplit("/", 1)[-1]
        for r in parse_arc(file):
            if r.reason is None:
                head, payload = split_http(r.content)
                yield (number(head_field(head, b"X-Page-Id")), r.url, r.ip, r.date, r.mime, head, payload,
                       hashlib.sha256(payload).hexdigest(), f"{base}:{r.number:012d}")
    return _read_files(spark, path, parse, _RECORD_SCHEMA, _RECORD_TYPES)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """What could not be read under ``path``: file, number there, reason, bytes."""
    def parse(file, name):
        for r in parse_arc(file):
            if r.reason is not None:
                yield name, r.number, r.reason, r.content
    return _read_files(spark, path, parse, _REJECT_SCHEMA, _REJECT_TYPES)


def number(text: str | None) -> int | None:
    """A page id as written, None for anything else."""
    return int(text) if text is not None and re.fullmatch(r"-?[0-9]{1,18}|-?9[0-9]{18}", text.strip()) else None


# --- conversion ----------------------------------------------------------

def decide_types(records: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """The records with ``refers_to``, the page of the response (null: they are
    one), and the url, date and place that give that record its id.

    Groups of equal digests are found by a pre-aggregated minimum; only ids
    that are not the group's smallest are joined to the records, by page, so
    that a much-copied payload does not meet in one task.  The revisits are
    written first: Spark knows their size and broadcasts a small table instead
    of shuffling all payloads to a large one.
    """
    narrow = records.where((F.octet_length("payload") >= min_bytes) & F.col("page_id").isNotNull()).select(
        "digest", "page_id", "url", "date", "place")
    first = narrow.groupBy("digest").agg(F.min(F.struct("page_id", "place", "url", "date")).alias("first"),
                                         F.max("page_id").alias("last")).where("last > first.page_id")
    revisits = materialize(narrow.select("digest", "page_id").distinct().join(
        first.select("digest", "first"), "digest").where("page_id > first.page_id").select(
        F.col("digest").alias("r_digest"), F.col("page_id").alias("r_page"),
        F.col("first.page_id").alias("refers_to"), F.col("first.url").alias("refers_url"),
        F.col("first.date").alias("refers_date"), F.col("first.place").alias("refers_place")), "warc-revisits")
    return records.join(revisits, (F.col("page_id") == F.col("r_page")) & (F.col("digest") == F.col("r_digest")),
                        "left").drop("r_page", "r_digest")


def record_id(url: str | None, date: str, digest: str, place: str) -> str:
    """A UUID from what a record is and where it stood in its archive."""
    name = hashlib.sha256("\n".join([url or "", date, digest, place]).encode()).digest()
    return f"<urn:uuid:{uuid.UUID(bytes=name[:16], version=5)}>"


def warc_date(date: str) -> str:
    """14 digits as ISO 8601 in UTC (missing digits count as the earliest)."""
    d = _full(date)
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:]}Z"


def warc_record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return f"WARC/1.0\r\n{lines}Content-Length: {len(block)}\r\n\r\n".encode() + block


def warc_head(name: str) -> bytes:
    body = b"software: tributary\r\nformat: WARC File Format 1.0\r\n"
    return warc_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(name, CAPTURED, "", "")),
                        ("WARC-Date", warc_date(CAPTURED)), ("WARC-Filename", f"{name}.warc"),
                        ("Content-Type", "application/warc-fields")], body)


class ArcRecord(NamedTuple):
    page_id: int | None
    url: str | None
    ip: str
    date: str
    mime: str
    head: bytes
    payload: bytes
    digest: str
    place: str
    refers_to: int | None
    refers_url: str | None
    refers_date: str | None
    refers_place: str | None

    def to_warc(self) -> bytes:
        """The equivalent WARC record; a revisit keeps the head only."""
        revisit = self.refers_to is not None
        of = record_id(self.refers_url, self.refers_date, self.digest, self.refers_place) if revisit else None
        http = bool(self.head)
        return warc_record([
            ("WARC-Type", "revisit" if revisit else "response" if http else "resource"),
            ("WARC-Record-ID", record_id(self.url, self.date, self.digest, self.place)),
            ("WARC-Target-URI", target(self.url)), ("WARC-Date", warc_date(self.date)), ("WARC-IP-Address", self.ip),
            ("WARC-Profile", "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest" if revisit else None),
            ("WARC-Refers-To", of), ("WARC-Refers-To-Target-URI", target(self.refers_url) if revisit else None),
            ("WARC-Refers-To-Date", warc_date(self.refers_date) if revisit else None),
            ("X-Refers-To-Page-Id", str(self.refers_to) if revisit else None),
            ("WARC-Payload-Digest", f"sha256:{self.digest}"),
            ("X-Payload-Length", str(len(self.payload))),
            ("Content-Type", "application/http; msgtype=response" if http else _SPACE.sub(" ", self.mime)),
        ], self.head if revisit else self.head + self.payload)


def target(url: str | None) -> str | None:
    """A url as a header may hold it."""
    return None if url is None else _SPACE.sub(lambda m: f"%{ord(m[0]):02X}", url)


def write_warc(records: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> None:
    """Write decided records (see ``decide_types``) as WARC files."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
        def converted() -> Iterator[bytes]:
            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    yield ArcRecord(*row).to_warc()
        return _pack(warc_head, converted(), b"\r\n\r\n", file_bytes)

    _write_files(records.select(*ArcRecord._fields), make, path, "\r\n\r\n")


def convert(spark: SparkSession, arc_path: str, warc_path: str, min_bytes: int = MIN_REVISIT_BYTES,
            rejects_path: str | None = None) -> None:
    """Convert all ARC files under one path to WARC files under another; what
    could not be read is written as a table to ``rejects_path``, if given."""
    write_warc(decide_types(read_arc(spark, arc_path), min_bytes), warc_path)
    if rejects_path:
        read_rejects(spark, arc_path).write.mode("overwrite").parquet(rejects_path)


# --- WARC ----------------------------------------------------------------

def parse_warc(file: io.BufferedReader, name: str) -> Iterator[tuple[bytes, bytes]]:
    """(header, block) of every record of a WARC file."""
    while line := file.readline():
        if line == b"\r\n":
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"{name}: no WARC record at {line[:200]!r}")
        header = [line]
        while (line := file.readline()) not in (b"\r\n", b""):
            header.append(line)
        head = b"".join(header)
        yield head, _exactly(file, int(head_field(head, b"Content-Length") or 0), name)


_READ_SCHEMA = ("page_id long, record_type string, payload_bytes long, payload_digest string, refers_to long, "
                "url string, record_id string, refers_to_id string, date string, payload binary")
_READ_TYPES = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), *[pa.string()] * 4, pa.binary()]


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The page records of all WARC files; a stored payload is checked against
    the digest its header declares."""
    def parse(file, name):
        for head, block in parse_warc(file, name):
            kind = head_field(head, b"WARC-Type")
            if kind == "warcinfo":
                continue
            http, payload = split_http(block)
            digest = (head_field(head, b"WARC-Payload-Digest") or "").removeprefix("sha256:")
            size = int(head_field(head, b"X-Payload-Length") or len(payload))
            if kind != "revisit" and (hashlib.sha256(payload).hexdigest(), len(payload)) != (digest, size):
                raise ValueError(f"{name}: a payload differs from its digest {digest}")
            yield (number(head_field(http, b"X-Page-Id")), kind, size, digest,
                   number(head_field(head, b"X-Refers-To-Page-Id")), head_field(head, b"WARC-Target-URI"),
                   head_field(head, b"WARC-Record-ID"), head_field(head, b"WARC-Refers-To"),
                   head_field(head, b"WARC-Date"),
                   None if kind == "revisit" else payload)
    return _read_files(spark, path, parse, _READ_SCHEMA, _READ_TYPES)
