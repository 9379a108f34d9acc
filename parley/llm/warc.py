"""ARC and WARC archives: writing, reading, and converting the old format to the new.

An archive is a text file that Spark writes: one record per row, gzipped per file, one file per
partition, so its size follows the size of the scan's splits.  Reading goes file by file as bytes,
record by record by the declared lengths, whatever the payload holds.

ARC files start with a version block that says how the header lines are laid out: five fields in
version 1 (URL, IP, date, type, length), ten in version 2 (with result code, checksum, location,
offset and filename).  The converter synthesises from these what WARC asks for: record ids (name
based UUIDs, the same in every run), ISO timestamps, record types and SHA-1 digests.  Blocks go over
byte by byte: an HTTP response becomes a response record with its own head, any other block (dns, ftp)
a resource record with the content type of its ARC header.

Equal payloads of ``min_revisit`` bytes or more are stored once: the record with the largest page
id is the response, the others revisit it.  Payload digests are grouped by an aggregate over
(page_id, digest, length), so a payload that a third of all pages share is one row per task.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.plans.scratch import scratch_path, settle

MIN_REVISIT = 1000
EMPTY_DATE = "19700101000000"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL name space of RFC 4122

# Fixed values of the formats.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
_BLANK_LINE = re.compile(rb"\r?\n\r?\n")
RECORD_SCHEMA = "page_id bigint, url string, ip string, date string, mime string, head binary, payload binary"


# --- ARC ---------------------------------------------------------------------------------------


def _http(page_id: int | None, payload: bytes) -> bytes:
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n"
    if page_id is not None:
        head += f"X-Page-Id: {page_id}\r\n"
    return head.encode() + b"\r\n" + payload


def arc_version_block(version: int, name: str) -> bytes:
    body = f"{version} 0 parley\n{ARC_FIELDS[version]}\n".encode()
    fields = ["filedesc://" + name, "0.0.0.0", EMPTY_DATE, "text/plain"]
    if version == 2:
        fields += ["200", "-", "-", "0", name]
    return (" ".join(fields) + f" {len(body)}\n").encode() + body


def arc_record(version: int, url: str | None, page_id: int | None, payload: bytes, name: str = "-") -> bytes:
    """One ARC record: header line, then the HTTP response.  Spaces and controls in a URL are escaped."""
    block = _http(page_id, payload)
    safe = "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url or "") or "-"
    fields = [safe, "0.0.0.0", EMPTY_DATE, "text/html"]
    if version == 2:
        checksum = base64.b32encode(hashlib.sha1(block).digest()).decode()
        fields += ["200", checksum, "-", "0", name]
    return (" ".join(fields) + f" {len(block)}\n").encode() + block


def _lines(records: list[bytes]) -> pa.RecordBatch:
    """Records for Spark's text writer, which writes the bytes as they are; they need not be UTF-8."""
    return pa.RecordBatch.from_arrays([pa.array(records, pa.binary()).view(pa.string())], names=["value"])


def _to_arc(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one file: its version block, then its records.  Files take turns in the version."""
    opened = False
    for part in parts:
        out = []
        for page_id, url, payload in zip(part.column("page_id").to_pylist(), part.column("url").to_pylist(), part.column("payload").to_pylist()):
            if not opened:
                version = 1 + (page_id or 0) % 2
                out.append(arc_version_block(version, "pages.arc"))
                opened = True
            out.append(arc_record(version, url, page_id, payload or b"", "pages.arc"))
        yield _lines(out)


class ArchiveError(ValueError):
    """An archive whose headers or lengths do not fit."""


def _line(content: bytes, at: int) -> tuple[bytes, int]:
    end = content.find(b"\n", at)
    if end < 0:
        raise ArchiveError(f"no header line at byte {at}")
    return content[at:end].rstrip(b"\r"), end + 1


def _text(field: bytes) -> str:
    """A header field; bytes that are no UTF-8 are escaped as in URLs."""
    try:
        return field.decode()
    except UnicodeDecodeError:
        return "".join(chr(c) if c < 128 else f"%{c:02X}" for c in field)


# URL and type may hold blanks: address, date and the fields behind the type tell where they end.
_LOOSE = {5: re.compile(rb"(.+) (\S+) ([0-9]{8,14}) (.*) ([0-9]+)"), 10: re.compile(rb"(.+) (\S+) ([0-9]{8,14}) (.*) (\S+) (\S+) (\S+) (\S+) (\S+) ([0-9]+)")}


def _fields(line: bytes, fields: int) -> list[bytes]:
    """The fields of a header line; ``fields``: how many there have to be (0: not known yet)."""
    words = line.split(b" ")
    if fields in _LOOSE and len(words) > fields and (found := _LOOSE[fields].fullmatch(line)):
        return list(found.groups())
    return words


def read_arc(content: bytes) -> Iterator[tuple[str, str, str, str, bytes]]:
    """(url, ip, date, mime, block) of every record of an ARC file, its version block left out."""
    at, fields = 0, 0
    while at < len(content):
        if content[at] in (10, 13):  # the line end behind a record
            at += 1
            continue
        line, at = _line(content, at)
        words = _fields(line, fields)
        try:
            length = int(words[-1])
        except ValueError as e:
            raise ArchiveError(f"no length in ARC header {line[:80]!r}") from e
        if at + length > len(content):
            raise ArchiveError(f"record of {length} bytes runs past the end of the file")
        block = content[at : at + length]
        at += length
        if not fields:
            if not line.startswith(b"filedesc://"):
                raise ArchiveError("an ARC file starts with a version block")
            version = int(block.split(b" ", 1)[0])
            if version not in ARC_FIELDS:
                raise ArchiveError(f"unknown ARC version {version}")
            fields = len(ARC_FIELDS[version].split())
            continue
        if len(words) != fields:
            raise ArchiveError(f"{len(words)} fields in ARC header {line[:80]!r}, {fields} expected")
        yield _text(words[0]), _text(words[1]), _text(words[2]), _text(words[3]), block


def split_block(block: bytes) -> tuple[bytes | None, bytes]:
    """Head, with its blank line, and payload of an HTTP response; of any other block no head and all of it."""
    if not block.startswith(b"HTTP/"):
        return None, block
    blank = _BLANK_LINE.search(block)
    end = blank.end() if blank else len(block)
    return block[:end], block[end:]


def split_http(block: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names) and payload of an HTTP response; a block that is none is all payload."""
    head, payload = split_block(block)
    fields = (line.partition(b":") for line in (head or b"").splitlines()[1:] if line)
    return {k.decode("latin-1").strip().lower(): v.decode("latin-1").strip() for k, _, v in fields}, payload


# --- WARC --------------------------------------------------------------------------------------


def warc_date(arc_date: str) -> str:
    """14 digits to ISO 8601; shorter old dates are filled up."""
    d = (arc_date + "00000101000000"[len(arc_date) :])[:14] if arc_date.isdigit() else EMPTY_DATE
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def record_id(page_id: int | str | None, digest: str) -> str:
    return f"urn:uuid:{uuid.uuid5(_SPACE, f'{page_id}/{digest}')}"


def warc_record(url: str, ip: str, date: str, page_id: int | None, payload: bytes, refers_to: int | None,
                head: bytes | None = None, resource: str | None = None) -> bytes:
    """One WARC record without its two closing line ends; a revisit has no payload in its block.

    ``head`` is the HTTP head of the response, without one a plain head is made; ``resource`` is the
    content type of a payload that is no HTTP response.
    """
    digest = hashlib.sha1(payload)
    revisit = refers_to is not None
    if resource is None and head is None:
        made = _http(page_id, payload)
        head = made[: len(made) - len(payload)]
    kind = "revisit" if revisit else "response" if resource is None else "resource"
    block = (head or b"") + (b"" if revisit else payload)
    b32 = base64.b32encode(digest.digest()).decode()
    # Records without page id differ by URL and date.
    name = page_id if page_id is not None else f"{url} {date}"
    lines = [
        "WARC/1.0", f"WARC-Type: {kind}",
        f"WARC-Record-ID: <{record_id(name, digest.hexdigest())}>", f"WARC-Date: {warc_date(date)}",
        f"WARC-Target-URI: {url}", f"WARC-IP-Address: {ip}", f"Content-Type: {resource or 'application/http; msgtype=response'}",
        f"WARC-Payload-Digest: sha1:{b32}",
        "WARC-Block-Digest: sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode(),
    ]
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <{record_id(refers_to, digest.hexdigest())}>",
                  f"X-Refers-To-Page: {refers_to}", f"X-Payload-Length: {len(payload)}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def read_warc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of every record of a WARC file; names in lower case."""
    at = 0
    while at < len(content):
        if content[at] in (10, 13):
            at += 1
            continue
        line, at = _line(content, at)
        if not line.startswith(b"WARC/"):
            raise ArchiveError(f"no WARC record at byte {at}")
        fields: dict[str, str] = {}
        while True:
            line, at = _line(content, at)
            if not line:
                break
            name, _, value = line.partition(b":")
            fields[name.decode().strip().lower()] = value.decode().strip()
        length = int(fields.get("content-length", -1))
        if length < 0 or at + length > len(content):
            raise ArchiveError("a WARC record's length does not fit the file")
        yield fields, content[at : at + length]
        at += length


# --- Spark -------------------------------------------------------------------------------------


def _unzipped(content: bytes) -> bytes:
    """Gzip members one after the other, or plain bytes."""
    if content[:2] != b"\x1f\x8b":
        return content
    out = []
    while content:
        member = zlib.decompressobj(31)
        out.append(member.decompress(content))
        if not member.eof:
            raise ArchiveError("a gzip member is cut off")
        content = member.unused_data
    return b"".join(out)


def _contents(parts: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
    for part in parts:
        for content in part.column("content"):
            yield _unzipped(content.as_py())


def _in_batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Batches of rows of about ``most`` bytes in their binary columns."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(c) for c in row if isinstance(c, bytes))
        if size >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def _page_id(fields: dict[str, str]) -> int | None:
    """The page id that ``arc_record`` has written; other writers' records have none."""
    value = fields.get("x-page-id", "")
    return int(value) if re.fullmatch(r"-?[0-9]{1,19}", value) and abs(int(value)) < 1 << 63 else None


def _arc_rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("ip", pa.string()), ("date", pa.string()), ("mime", pa.string()), ("head", pa.binary()), ("payload", pa.binary())])

    def rows():
        for content in _contents(parts):
            for url, ip, date, mime, block in read_arc(content):
                head, payload = split_block(block)
                yield _page_id(split_http(head or b"")[0]), url, ip, date, mime, head, payload

    return _in_batches(rows(), schema)


def _to_warc(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        columns = [part.column(c).to_pylist() for c in ("url", "ip", "date", "page_id", "payload", "refers_to", "head", "mime")]
        out = []
        for *row, head, mime in zip(*columns):
            kind = mime if "/" in mime else "application/octet-stream"
            out.append(warc_record(*row, head, None if head is not None else kind))
        yield _lines(out)


def _warc_rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("record_id", pa.string()), ("date", pa.string()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])

    def rows():
        for content in _contents(parts):
            for fields, block in read_warc(content):
                http, payload = split_http(block)
                kind = fields["warc-type"]
                digest = base64.b32decode(fields["warc-payload-digest"].partition(":")[2]).hex()
                if kind != "revisit" and hashlib.sha1(payload).hexdigest() != digest:
                    raise ArchiveError(f"payload of {fields['warc-record-id']} does not fit its digest")
                refers = int(fields["x-refers-to-page"]) if kind == "revisit" else None
                yield (_page_id(http), fields["warc-target-uri"], kind, fields["warc-record-id"].strip("<>"), fields["warc-date"],
                       int(fields["x-payload-length"]) if kind == "revisit" else len(payload), digest, refers, payload if kind != "revisit" else None)

    return _in_batches(rows(), schema)


def write_arc(pages: DataFrame, path: str) -> None:
    """Write (page_id, url, payload) rows as ARC files, one per partition, versions 1 and 2 mixed."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("payload").cast("binary").alias("payload"))
    rows.mapInArrow(_to_arc, "value string").write.option("compression", "gzip").text(path)


def read_arcs(spark: SparkSession, path: str) -> DataFrame:
    """Records of ARC files: page_id, url, ip, date, mime, head (null if not HTTP), payload."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(_arc_rows, RECORD_SCHEMA)


def convert_arcs(spark: SparkSession, arc_path: str, warc_path: str, min_revisit: int = MIN_REVISIT) -> None:
    """Convert ARC files to WARC files; equal payloads of ``min_revisit`` bytes or more are stored once.

    Only HTTP responses with a page id to refer to become revisits; other records are kept whole.
    """
    records = read_arcs(spark, arc_path)
    digests = records.where("head IS NOT NULL").select("page_id", F.sha1("payload").alias("digest"), F.octet_length("payload").alias("bytes"))
    digests = settle(digests.where(F.col("bytes") >= min_revisit), "digests")
    kept = digests.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "refers_to")
    revisits = digests.join(kept, "digest").where(~F.col("page_id").eqNullSafe(F.col("refers_to"))).where("refers_to IS NOT NULL")
    revisits = revisits.select(F.col("page_id").alias("_page"), F.col("digest").alias("_digest"), "refers_to").distinct()
    joined = records.withColumn("_sha1", F.sha1("payload")).join(
        revisits, F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("_sha1") == F.col("_digest")) & F.col("head").isNotNull(), "left")
    rows = joined.select("url", "ip", "date", "page_id", "payload", "refers_to", "head", "mime").mapInArrow(_to_warc, "value string")
    rows.write.option("compression", "gzip").option("lineSep", "\r\n\r\n").text(warc_path)


def read_warcs(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC files: page_id, url, record_type, record_id, date, payload_bytes,
    payload_digest, refers_to, payload (null for revisits)."""
    schema = ("page_id bigint, url string, record_type string, record_id string, date string, "
              "payload_bytes bigint, payload_digest string, refers_to bigint, payload binary")
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(_warc_rows, schema)


def archive_pages(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """``pages`` (page_id, url, html) through ARC and WARC files and back.

    page_id, payload_bytes, payload_digest, record_type, refers_to, record_id per row.  Null html
    is an empty payload, a null url is written as "-".  Of repeated rows with the largest page id
    all are responses; rows without page id revisit that id like any other, or are responses if
    the whole group has none.  An empty table gives no rows; further columns are not looked at.
    """
    spark = pages.sparkSession
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    write_arc(pages.select("page_id", "url", payload.alias("payload")), arc)
    convert_arcs(spark, arc, warc, min_revisit)
    return read_warcs(spark, warc).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id")
