"""WARC archives: a writer in DataFrame functions and a salvage reader.

The writer turns each row into one WARC/1.0 record and lets Spark's text
writer put the records one after another (the line separator is the end of
the record), so any file system Spark can reach will do. Equal payloads of at
least ``min_revisit_bytes`` are stored once; the others become revisit records.

The reader walks one archive from start to end, plain or with a gzip member
for each record. A record must have a version line, a parsable Content-Length,
its whole block, the closing line breaks, and, for a response, the payload that
its digest names. When a check fails the reader searches for the next gzip
member or version line that leads to a valid record, goes on from there, and
logs the bytes in between as a quarantined gap.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MIN_REVISIT_BYTES = 100
#: Bytes of an archive; a reading task holds one archive at a time.
ARCHIVE_BYTES = 32 << 20
#: A gzip member is unpacked in slices of so many bytes; a record has at most so many header and record bytes.
SLICE, HEADER_BYTES, RECORD_BYTES = 1 << 16, 1 << 20, 1 << 30
#: Digits of a length that is taken for one (it fits 64 bits).
_DIGITS = 18
RECORD_DATE = "2024-01-01T00:00:00Z"
PREFIX = "urn:x-page:"
CRLF = "\r\n"

#: A gzip member without content. Spark's text writer puts it after each compressed record; readers skip it.
EMPTY_MEMBER = gzip.compress(b"", mtime=0)

_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
_HTTP_LENGTH = re.compile(rb"(?im)^content-length:[ \t]*(\d+)")


def records(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
            min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """One column ``value``: each row as a WARC record without its last line break.

    A null payload is empty, a null URL is written as 'about:blank', control
    characters and spaces in a URL are percent-encoded, a null id is written as
    'null'. Of equal payloads the rows with the smallest id are responses (all
    of them, if the id repeats), the others revisit it; if no id is given, all
    are responses.
    """
    p = pages.select(F.col(id_col).cast("string").alias("id"), F.col(id_col).alias("order"),
                     F.coalesce(F.col(url_col), F.lit("about:blank")).alias("url"),
                     F.coalesce(F.col(payload_col), F.lit("")).alias("body"))
    p = p.withColumns({"digest": F.sha2(F.col("body").cast("binary"), 256), "size": F.octet_length("body")})
    big = F.col("size") >= min_revisit_bytes
    first = (p.where(big).groupBy("digest").agg(F.min("order").alias("first"), F.count("*").alias("n"))
             .where("n > 1").select("digest", "first"))
    p = p.join(first, "digest", "left")
    revisit = F.coalesce(big & F.col("first").isNotNull() & ~F.col("order").eqNullSafe(F.col("first")), F.lit(False))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.col("size").cast("string"), F.lit(CRLF * 2))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("body")))
    url = F.regexp_replace(F.regexp_replace("url", "[\\r\\n]", "%0A"), "[\\x00-\\x20\\x7F]", "%20")
    head = F.concat(
        F.lit(f"WARC/1.0{CRLF}WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit(f"{CRLF}WARC-Record-ID: <{PREFIX}"), F.coalesce("id", F.lit("null")),
        F.lit(f">{CRLF}WARC-Date: {RECORD_DATE}{CRLF}WARC-Target-URI: "), url,
        F.lit(f"{CRLF}WARC-Payload-Digest: sha256:"), F.col("digest"),
        F.when(revisit, F.concat(
            F.lit(f"{CRLF}WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
                  f"{CRLF}WARC-Refers-To: <{PREFIX}"), F.col("first").cast("string"), F.lit(">"))).otherwise(""),
        F.lit(f"{CRLF}Content-Type: application/http; msgtype=response{CRLF}Content-Length: "),
        F.octet_length(block).cast("string"), F.lit(CRLF * 2))
    return p.select(F.concat(head, block, F.lit(CRLF)).alias("value"))


def _packed(archive_bytes: int, compress: bool):
    """Records with the number, within this task, of the archive that they go to; packed if ``compress``."""

    def run(batches):
        archive = held = 0
        for b in batches:
            values, at = [], []
            for r in b.column(0).cast(pa.binary()).to_pylist():
                if held and held + len(r) > archive_bytes:
                    archive, held = archive + 1, 0
                held += len(r)
                at.append(archive)
                values.append(gzip.compress(r + b"\r\n", 6, mtime=0) if compress else r)
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.binary()), pa.array(at, pa.int32())],
                                             names=["value", "archive"])

    return run


def write(pages: DataFrame, path: str, *, archive_bytes: int = ARCHIVE_BYTES, compress: bool = True,
          **columns) -> None:
    """Write archives of at most ``archive_bytes`` (before compression) each under ``path``, or of one longer record.

    Each writing task cuts its archives where their bytes add up, so long
    pages that gather in a task make more archives, not longer ones. With
    ``compress`` every record is a gzip member of its own.
    """
    rows = records(pages, **columns).mapInArrow(_packed(archive_bytes, compress), "value binary, archive int")
    # the text writer passes the packed bytes on as they are
    packed, separator, encoding = F.col("value").cast("string"), CRLF, "UTF-8"
    if compress:
        separator, encoding = EMPTY_MEMBER.decode("latin-1"), "ISO-8859-1"
    (rows.select(packed.alias("value"), "archive").write.mode("overwrite").option("lineSep", separator)
     .option("encoding", encoding).partitionBy("archive").text(path))


def _headers(block: bytes) -> dict[bytes, bytes] | None:
    out = {}
    for line in block.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        out[name.strip().lower()] = value.strip()
    return out


def _plain(data: bytes, at: int) -> tuple[dict, bytes, int] | None:
    """Headers, block and end of the valid record at ``at``, else None."""
    version = _VERSION.match(data, at)
    stop = data.find(b"\r\n\r\n", at, at + HEADER_BYTES)
    if not version or stop < 0:
        return None
    head = _headers(data[version.end():stop])
    length = (head or {}).get(b"content-length", b"")
    if head is None or not length.isdigit() or len(length) > _DIGITS:
        return None
    if b"warc-type" not in head or b"warc-record-id" not in head:
        return None
    start = stop + 4
    end = start + int(length)
    if data[end:end + 4] != b"\r\n\r\n":
        return None
    block = data[start:end]
    digest = head.get(b"warc-payload-digest", b"")
    if head.get(b"warc-type") == b"response" and digest.startswith(b"sha256:"):
        if hashlib.sha256(_payload(block)[1]).hexdigest().encode() != digest[7:].lower():
            return None
    if head.get(b"warc-type") == b"revisit" and (m := _HTTP_LENGTH.search(_payload(block)[0])) and len(m[1]) > _DIGITS:
        return None
    return head, block, end + 4


def _payload(block: bytes) -> tuple[bytes, bytes]:
    """HTTP head and body; a block that is no HTTP message is all body."""
    if block.startswith(b"HTTP/"):
        head, gap, body = block.partition(b"\r\n\r\n")
        if gap:
            return head, body
    return b"", block


def _member(data: bytes, at: int) -> tuple[dict | None, bytes, int] | None:
    """The same for a gzip member that holds one record; no headers for an empty member."""
    unzip, parts, size, end = zlib.decompressobj(31), [], 0, at
    while not unzip.eof:
        piece = data[end:end + SLICE]
        end += len(piece)
        try:
            part = unzip.decompress(piece)
        except zlib.error:
            return None
        size += len(part)
        if part:
            # what is no record is given up at once, and so is what grows beyond bounds
            if not parts and not b"WARC/1."[:len(part)] == part[:7] or size > RECORD_BYTES:
                return None
            parts.append(part)
        if not piece and not unzip.eof:
            return None
    end -= len(unzip.unused_data)
    inner = b"".join(parts)
    if not inner:
        return None, b"", end
    found = _plain(inner, 0)
    return None if found is None or found[2] != len(inner) else (found[0], found[1], end)


def read_archive(data: bytes) -> Iterator[tuple]:
    """('record', offset, length, headers, block) and ('gap', offset, length, None, None)."""
    at, bad = 0, None
    while at < len(data):
        found = _member(data, at) if data[at:at + 3] == b"\x1f\x8b\x08" else _plain(data, at)
        if found is not None:
            if bad is not None:
                yield "gap", bad, at - bad, None, None
                bad = None
            if found[0] is not None:
                yield "record", at, found[2] - at, found[0], found[1]
            at = found[2]
            continue
        if bad is None:
            bad = at
        following = _START.search(data, at + 1)
        at = following.start() if following else len(data)
    if bad is not None:
        yield "gap", bad, len(data) - bad, None, None


_SCHEMA = ("kind string, path string, offset bigint, length bigint, record_type string, record_id string, "
           "refers_to string, target_uri string, payload_bytes bigint, payload_digest string")


def _id(value: bytes | None) -> str | None:
    return None if value is None else value.decode("utf-8", "replace").strip("<>").removeprefix(PREFIX)


def _describe(kind, path, offset, length, head, block, payload: bool) -> tuple:
    if kind == "gap":
        return (kind, path, offset, length) + (None,) * (7 if payload else 6)
    http, body = _payload(block)
    record_type = head.get(b"warc-type", b"").decode("utf-8", "replace")
    size, digest = len(body), hashlib.sha256(body).hexdigest()
    if record_type == "revisit":  # the payload is elsewhere: its size and digest are in the headers
        m = _HTTP_LENGTH.search(http)
        size = int(m[1]) if m else None
        digest = head.get(b"warc-payload-digest", b"").decode("utf-8", "replace").removeprefix("sha256:") or None
    uri = head.get(b"warc-target-uri")
    out = (kind, path, offset, length, record_type, _id(head.get(b"warc-record-id")), _id(head.get(b"warc-refers-to")),
           None if uri is None else uri.decode("utf-8", "replace"), size, digest)
    return (*out, body) if payload else out


def read(spark: SparkSession, path: str, *, payload: bool = False) -> DataFrame:
    """Records and quarantined gaps of all archives under ``path`` (see ``_SCHEMA``).

    ``kind`` is 'record' or 'gap'; offsets and lengths are bytes of the archive
    file. With ``payload`` the body bytes come as well. An empty archive gives
    no rows. Records with a length of more than 18 digits, headers of over
    ``HEADER_BYTES`` or over ``RECORD_BYTES`` in all are quarantined.
    """
    schema = _SCHEMA + (", payload binary" if payload else "")
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches):
        for b in batches:
            for file, data in zip(b.column(0).to_pylist(), b.column(1)):
                held = []
                for found in read_archive(data.as_py() or b""):
                    held.append(_describe(found[0], file, *found[1:], payload=payload))
                    if len(held) == 1000:
                        yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*held)))), schema=arrow)
                        held = []
                if held:
                    yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*held)))), schema=arrow)

    text, number = pa.string(), pa.int64()
    arrow = pa.schema([(n, pa.binary() if n == "payload" else number if n in ("offset", "length", "payload_bytes")
                        else text) for n in names])
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
             .select("path", "content"))
    return files.mapInArrow(run, schema)
