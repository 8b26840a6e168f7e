"""Web archives: pages written as WARC records, and a reader that survives damage.

Writing: of pages with equal payloads of at least ``REVISIT_BYTES`` bytes the one with the
largest id is a ``response``, and the others are ``revisit`` records that refer to it. Payloads
meet by their SHA-256. Every record is a gzip member of its own. Members are gathered into
archives of about ``ARCHIVE_BYTES`` bytes, one file each, so a reading task holds one archive.

Reading: an archive is walked record by record. A member must decompress with a correct
checksum, and a record must have its version line, a length that ends at the two line ends, and
the digests it states. After a failed check, at whatever place, the reader searches for the next
valid member or version line, goes on there, and returns the bytes between as a quarantined gap
with its reason. Nothing about an archive is told from its name or its first bytes.

Results for special rows: a null payload counts as empty. Pages that repeat an id and a payload
are records of their own with the same type. A null id is smaller than any other; a page that
refers to one has a null ``refers_to``. Control characters in addresses are percent-encoded. An
empty table gives no archive and an empty result, and an empty archive no records. Other columns
are ignored, whatever their names. A page of any length is one record, and the archive it ends is
that much longer. A reading task holds one archive and the member it unpacks, and Spark reads none
of over 2 GB; damage inside a member of many records costs those behind it in that member.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm.common import stored

REVISIT_BYTES = 1000
ARCHIVE_BYTES = 8_000_000
RECORDS_AT_ONCE = 500
LEVEL = 6

# Strings of the WARC 1.1 format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
TRAILER = b"\r\n\r\n"
GZIP_MAGIC = b"\x1f\x8b\x08"
BEGINS = re.compile(rb"\x1f\x8b\x08|WARC/1\.")
REQUIRED = {"warc-type", "warc-record-id", "warc-date", "content-length"}
#: The one field that a record may have more than once; its values are a list.
REPEATED = "warc-concurrent-to"
RECORD_ID = "<urn:x-page:{}>"

RECORDS = (
    "archive string, offset bigint, bytes bigint, status string, reason string, record_type string, "
    "record_id string, refers_to string, target_uri string, payload_digest string, "
    "payload_bytes bigint, payload binary"
)


class Found(NamedTuple):
    """A record, or with a reason the gap before the next one."""

    offset: int
    size: int
    headers: dict[str, str | list[str]]
    block: bytes
    reason: str = ""


# --- writing ------------------------------------------------------------------------------


def with_record_types(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """``page_id``, ``url``, ``payload`` and ``refers_to``, with ``revisit`` for those that have
    an equal of a larger id."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    long = rows.filter(F.octet_length("payload") >= least)
    # Only payloads that occur more than once take part in the join that follows.
    groups = long.groupBy("digest").agg(F.max("page_id").alias("keep"), F.count("*").alias("n"))
    groups = stored(groups.filter("n > 1").select(F.col("digest").alias("_digest"), "keep"))
    joined = rows.join(groups, F.col("digest") == F.col("_digest"), "left")
    revisit = F.col("_digest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keep"))
    return joined.select(
        "page_id", "url", "payload", revisit.alias("revisit"), F.when(revisit, F.col("keep")).alias("refers_to")
    )


def record(page_id, url, payload: bytes, revisit: bool, refers_to) -> bytes:
    """One WARC record; a revisit keeps the HTTP head, which states the length, not the payload."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    address = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    headers = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": RECORD_ID.format("" if page_id is None else page_id),
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Target-URI": address,
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Block-Digest": "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode(),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if revisit:
        headers["WARC-Profile"] = REVISIT_PROFILE
        headers["WARC-Refers-To"] = RECORD_ID.format("" if refers_to is None else refers_to)
    lines = "".join(f"{name}: {value}\r\n" for name, value in headers.items()).encode()
    return VERSION + b"\r\n" + lines + b"\r\n" + block + TRAILER


def member(content: bytes) -> bytes:
    return gzip.compress(content, LEVEL, mtime=0)


def write_archives(
    pages: DataFrame, path: str, compressed: bool = True, archive_bytes: int = ARCHIVE_BYTES
) -> None:
    """Write a record per page into archives below ``path``, a folder that must not exist yet."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        size = 0
        for batch in source:
            for row in zip(*(batch.column(i) for i in range(5))):
                made = record(*(value.as_py() for value in row))
                held.append(member(made) if compressed else made)
                size += len(held[-1])
                if size >= archive_bytes:
                    yield archive(held)
                    held, size = [], 0
        if held:
            yield archive(held)

    def archive(held: list[bytes]) -> pa.RecordBatch:
        content = b"".join(held)
        # The writer ends a row with a separator: here the end of the last record, or an empty
        # member, which both belong to the format.
        content = content if compressed else content.removesuffix(TRAILER)
        return pa.record_batch([pa.array([content], pa.binary())], names=["value"])

    end = member(b"") if compressed else TRAILER
    rows = with_record_types(pages).mapInArrow(batches, "value binary")
    writer = rows.select(F.col("value").cast("string").alias("value")).write
    writer = writer.option("maxRecordsPerFile", 1).option("compression", "none")
    writer.option("encoding", "ISO-8859-1").option("lineSep", end.decode("latin-1")).text(path)


# --- reading ------------------------------------------------------------------------------


def parse(data: bytes, at: int) -> tuple[Found | None, str]:
    """The record that begins at ``at``, or why there is none."""
    if not re.match(rb"WARC/1\.\d\r\n", data[at : at + 10]):
        return None, "no version line"
    end = data.find(TRAILER, at)
    if end < 0:
        return None, "unfinished header"
    headers: dict[str, str | list[str]] = {}
    for line in data[at:end].split(b"\r\n")[1:]:
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        name = name.strip().lower()
        # Two headers run into one where bytes between records are missing: fields come twice.
        if not colon or name in headers and name != REPEATED or "\r" in value or "\n" in value:
            return None, "malformed header"
        if name == REPEATED:
            headers.setdefault(name, []).append(value.strip())
        else:
            headers[name] = value.strip()
    if not REQUIRED.issubset(headers):
        return None, "incomplete header"
    if not re.fullmatch("[0-9]{1,18}", headers["content-length"]):
        return None, "no length"
    begin = end + len(TRAILER)
    stop = begin + int(headers["content-length"])
    if data[stop : stop + len(TRAILER)] != TRAILER:
        return None, "length does not end at a record end"
    block = data[begin:stop]
    if not matches(headers.get("warc-block-digest"), block):
        return None, "block digest differs"
    if headers.get("warc-type") == "response" and not matches(headers.get("warc-payload-digest"), payload_of(block)):
        return None, "payload digest differs"
    return Found(at, stop + len(TRAILER) - at, headers, block), ""


def matches(stated: str | None, content: bytes) -> bool:
    """Whether a stated SHA-1 fits; other algorithms are not checked."""
    kind, _, value = (stated or "").partition(":")
    if kind != "sha1":
        return True
    digest = hashlib.sha1(content).digest()
    return value.upper() == base64.b32encode(digest).decode() or value.lower() == digest.hex()


def payload_of(block: bytes) -> bytes:
    head, found, payload = block.partition(TRAILER)
    return payload if found and head.startswith(b"HTTP/") else block


def plain_records(data: bytes) -> Iterator[Found]:
    """Records of uncompressed bytes, and the gaps between valid ones."""
    at = 0
    while at < len(data):
        found, reason = parse(data, at)
        if found:
            yield found
            at += found.size
            continue
        begin = at
        while found is None:
            at = data.find(b"WARC/1.", at + 1)
            if at < 0:
                at = len(data)
                break
            found, _ = parse(data, at)
        yield Found(begin, at - begin, {}, b"", reason)


def unpacked(data: bytes, at: int) -> tuple[bytes | None, int, str]:
    """Content of the gzip member at ``at`` and where it ends, or why there is none."""
    if data[at : at + 3] != GZIP_MAGIC:
        return None, at, "no member"
    stream = zlib.decompressobj(31)
    made, view, upto = [], memoryview(data), at
    try:
        while not stream.eof and upto < len(data):
            made.append(stream.decompress(view[upto : upto + 65_536]))
            upto += 65_536
    except zlib.error as failure:
        return None, at, f"damaged member: {failure}"
    if not stream.eof:
        return None, at, "unfinished member"
    return b"".join(made), min(upto, len(data)) - len(stream.unused_data), ""


def at_place(data: bytes, at: int) -> tuple[list[Found], int, str]:
    """What begins at ``at``, a member with its records or a plain record, and its size, or why
    there is nothing."""
    if data.startswith(GZIP_MAGIC, at):
        content, end, reason = unpacked(data, at)
        if content is None:
            return [], 0, reason
        return [f._replace(offset=at, size=end - at) for f in plain_records(content)], end - at, ""
    found, reason = parse(data, at)
    return ([found], found.size, "") if found else ([], 0, reason)


def records_of(data: bytes) -> Iterator[Found]:
    """Records of an archive, of gzip members or plain or both, and the gaps between valid ones.

    After a failed check every later place where a member or a version line may begin is tried,
    and the first that holds a valid record, or is an empty member, ends the gap. A gap is counted
    in bytes of the archive; where a whole member is sound and a record in it is not, the gap is
    that member.
    """
    at = 0
    while at < len(data):
        found, size, reason = at_place(data, at)
        if not size:
            begin, at = at, len(data)
            for place in BEGINS.finditer(data, begin + 1):
                found, size, _ = at_place(data, place.start())
                if size and (not found or any(not f.reason for f in found)):
                    at = place.start()
                    break
                found, size = [], 0
            yield Found(begin, at - begin, {}, b"", reason)
        yield from found
        at += size


def described(archive: str, found: Found) -> dict:
    if found.reason:
        return {"archive": archive, "offset": found.offset, "bytes": found.size, "status": "quarantined", "reason": found.reason}
    headers, payload = found.headers, payload_of(found.block)
    revisit = headers.get("warc-type") == "revisit"
    stated = re.search(rb"(?i)\r\ncontent-length: *([0-9]{1,18})\r\n", found.block) if revisit else None
    _, _, digest = headers.get("warc-payload-digest", "").partition(":")
    if revisit:
        try:
            digest = base64.b32decode(digest).hex() if len(digest) == 32 else digest.lower()
        except ValueError:
            digest = digest.lower()
    else:
        digest = hashlib.sha1(payload).hexdigest()
    return {
        "archive": archive,
        "offset": found.offset,
        "bytes": found.size,
        "status": "record",
        "record_type": headers.get("warc-type"),
        "record_id": headers.get("warc-record-id"),
        "refers_to": headers.get("warc-refers-to"),
        "target_uri": headers.get("warc-target-uri"),
        "payload_digest": digest,
        "payload_bytes": int(stated[1]) if stated else len(payload),
        "payload": None if revisit else payload,
    }


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """All records and quarantined gaps of the archives below ``path``; see ``RECORDS``."""
    names = [part.split()[0] for part in RECORDS.split(", ")]
    kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(n, kinds[p.split()[1]]) for n, p in zip(names, RECORDS.split(", "))])

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for path, content in zip(batch.column("path"), batch.column("content")):
                held: list[dict] = []
                for found in records_of(content.as_py()):
                    held.append(described(path.as_py(), found))
                    if len(held) >= RECORDS_AT_ONCE:
                        yield pa.RecordBatch.from_pylist(held, schema=schema)
                        held = []
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(batches, RECORDS)


def page_records(records: DataFrame) -> DataFrame:
    """The records that stand for pages, with their ids as numbers."""

    def number(column: str):
        return F.regexp_extract(column, "^<urn:x-page:(-?[0-9]+)>$", 1).try_cast("bigint")

    return records.filter("status = 'record' AND record_type IN ('response', 'revisit')").select(
        number("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.when(F.col("record_type") == "revisit", number("refers_to")).alias("refers_to"),
    )
