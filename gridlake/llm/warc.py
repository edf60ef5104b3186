"""Legacy ARC archives, their conversion to WARC, and reading WARC archives back.

An ARC file is a version block and records, each a header line of blank-separated fields
that ends in the block's length. Version 1 has five fields, version 2 ten. The converter
takes fields from both ends of a line, since URLs may hold blanks, and blocks by
declared length, never by looking for the next header.

Of each ARC record it makes a WARC record: an identifier derived from the record's key,
the archive date in W3C form, type and content type by the block, and SHA-1 digests.
Records whose payload is that of another one become ``revisit`` records without it.

Archives are written by Spark's text writer, one archive per row and file, so they go to
any file system Spark can write to, and a lost task writes its file again. Its line end is the
blank line that ends a WARC record.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.llm.batches import map_batches, map_partitions, utf8
from gridlake.session import scratch_path

#: An archive is closed when it has so many bytes; one longer record has its own.
ARCHIVE_BYTES = 8 << 20
#: Field names of the two ARC versions, line ends, WARC names.
ARC_FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: (
        "URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum",
        "Location", "Offset", "Filename", "Archive-length",
    ),
}
CRLF = b"\r\n"
END = CRLF + CRLF
VERSION = b"WARC/1.1"
KEY = "X-Page-Id"
#: The archive date of a page, which has none of its own.
DATE = "20240101000000"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:gridlake:arc")
_DATE = re.compile(rb"\d{14}$")


# --- ARC ----------------------------------------------------------------------


@dataclass
class ArcRecord:
    url: str
    address: str
    date: str
    kind: str
    block: bytes


def arc_header(name: str, version: int) -> bytes:
    """The version block that starts an ARC file."""
    body = f"{version} 0 gridlake\n{' '.join(ARC_FIELDS[version])}\n".encode()
    rest = f"text/plain 200 - - 0 {name} {len(body)}" if version == 2 else f"text/plain {len(body)}"
    return f"filedesc://{name} 0.0.0.0 20240101000000 {rest}\n".encode() + body + b"\n"


def arc_record(record: ArcRecord, version: int, offset: int, name: str) -> bytes:
    fields = [record.url or "-", record.address, record.date, record.kind]
    if version == 2:
        fields += ["200", hashlib.md5(record.block).hexdigest(), "-", str(offset), name]
    line = " ".join([*fields, str(len(record.block))])
    return line.encode() + b"\n" + record.block + b"\n"


def parse_arc(content: bytes) -> Iterator[ArcRecord]:
    """The records of an ARC file, without its version block.

    The version is the one of the version block. A header that lacks fields or a length, or a
    block that ends early, is an error: the rest could not be found reliably.
    """
    version, at = 1, 0
    while at < len(content):
        if content[at : at + 1] in (b"\n", b"\r"):  # line ends between records
            at += 1
            continue
        end = content.find(b"\n", at)
        line = content[at:end] if end >= 0 else content[at:]
        first = line.startswith(b"filedesc://")
        # the version block's own line tells how many fields its version has
        tail = 9 if (len(line.split(b" ")) >= 10 if first else version == 2) else 4
        fields = line.rstrip(b"\r").rsplit(b" ", tail)
        if end < 0 or len(fields) != tail + 1 or not fields[-1].isdigit():
            raise ValueError(f"no ARC header at byte {at}: {line[:80]!r}")
        length = int(fields[-1])
        block = content[end + 1 : end + 1 + length]
        if len(block) < length:
            raise ValueError(f"the block at byte {end + 1} has {len(block)} of {length} bytes")
        at = end + 1 + length
        if first:
            version = int(block.split(b" ", 1)[0])
            continue
        if not _DATE.match(fields[2]):
            raise ValueError(f"no ARC date in {line[:80]!r}")
        url, address, date, kind = (part.decode() for part in fields[:4])
        yield ArcRecord("" if url == "-" else url, address, date, kind, block)


# --- WARC ---------------------------------------------------------------------


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def split_http(block: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """The fields of an HTTP response, its head and its payload; all payload if it is none."""
    if not block.startswith(b"HTTP/"):
        return {}, b"", block
    head, blank, payload = block.partition(END)
    pairs = (line.partition(b":") for line in head.split(CRLF)[1:])
    fields = {name.decode().strip(): value.decode().strip() for name, _, value in pairs}
    return fields, head + blank, payload


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, ' '.join(parts))}>"


def warc_date(arc_date: str) -> str:
    d = arc_date
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


@dataclass(frozen=True)
class Original:
    """The response that a revisit refers to. It has the same payload."""

    key: str
    url: str
    date: str = DATE


def to_warc(record: ArcRecord, refers_to: Original | None = None) -> bytes:
    """The WARC record of an ARC record; a revisit of the response ``refers_to``.

    The identifier follows from key, URL, date and payload, so that of the response is known
    without reading it. Records that agree in all four are copies and share it.
    """
    fields, head, payload = split_http(record.block)
    key, digest = fields.get(KEY, ""), sha1_base32(payload)
    block = record.block if refers_to is None else head
    lines = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(key, record.url, record.date, digest)),
        ("WARC-Date", warc_date(record.date)),
        ("WARC-Target-URI", record.url),
        ("WARC-IP-Address", record.address),
        ("Content-Type", "application/http;msgtype=response" if head else record.kind),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
        ("WARC-Source-Key", key),
        ("WARC-Source-Payload-Length", str(len(payload))),
    ]
    if refers_to is not None:
        target = record_id(refers_to.key, refers_to.url, refers_to.date, digest)
        lines += [
            ("WARC-Profile", REVISIT_PROFILE),
            ("WARC-Refers-To", target),
            ("WARC-Refers-To-Target-URI", refers_to.url),
            ("WARC-Refers-To-Date", warc_date(refers_to.date)),
            ("WARC-Source-Refers-To", refers_to.key),
        ]
    lines.append(("Content-Length", str(len(block))))
    head_lines = [f"{name}: {value}".encode() for name, value in lines if value]
    return CRLF.join([VERSION, *head_lines]) + END + block + END


@dataclass
class WarcRecord:
    fields: dict[str, str]
    block: bytes


def parse_warc(content: bytes) -> Iterator[WarcRecord]:
    """The records of an uncompressed WARC file, by declared lengths.

    A block that does not match its digest, or is cut short, is an error.
    """
    at = 0
    while at < len(content):
        end = content.find(END, at)
        lines = content[at:end].split(CRLF) if end >= 0 else [b""]
        if not lines[0].startswith(b"WARC/"):
            raise ValueError(f"no WARC header at byte {at}: {content[at : at + 40]!r}")
        pairs = (line.decode().partition(":") for line in lines[1:])
        fields = {name: value.strip() for name, _, value in pairs}
        length = int(fields["Content-Length"])
        block = content[end + 4 : end + 4 + length]
        digest = fields.get("WARC-Block-Digest")
        if len(block) < length or (digest and digest != f"sha1:{sha1_base32(block)}"):
            raise ValueError(f"a damaged record at byte {at}")
        yield WarcRecord(fields, block)
        at = end + 4 + length + 4


# --- on tables ----------------------------------------------------------------


def _clean_url(url: bytes) -> str:
    """A URL for a header line: bytes that would end the line or a field are escaped.

    A lone "-" stands for no URL in ARC, so it is one here as well.
    """
    clean = re.sub(rb"[\x00-\x20\x7f]", lambda m: b"%%%02X" % m[0][0], url).decode()
    return "" if clean == "-" else clean


def _archives(records: Iterable[bytes]) -> Iterator[pa.RecordBatch]:
    """Records packed into archives of about ARCHIVE_BYTES, one per batch."""

    def batch(parts: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([b"".join(parts)], pa.binary())], ["archive"])

    own: list[bytes] = []
    size = 0
    for record in records:
        own.append(record)
        size += len(record)
        if size >= ARCHIVE_BYTES:
            yield batch(own)
            own, size = [], 0
    if own:
        yield batch(own)


def arc_file(pages: list[tuple], version: int) -> bytes:
    """An ARC file of (page_id, url, html) rows; the id is a field of the HTTP head."""
    name = f"pages-{uuid.uuid5(NAMESPACE, repr([row[0] for row in pages]))}.arc"
    parts = [arc_header(name, version)]
    size = len(parts[0])
    for page_id, url, html in pages:
        key = "" if page_id is None else str(page_id)
        head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n{KEY}: {key}\r\n\r\n".encode()
        record = ArcRecord(_clean_url(url), "192.0.2.1", DATE, "text/html", head + html)
        parts.append(arc_record(record, version, size, name))
        size += len(parts[-1])
    return b"".join(parts)


def convert(archives: DataFrame) -> DataFrame:
    """WARC archives (archive) of ARC files (archive): every record a response."""

    def converted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = (content or b"" for b in batches for content in b.column("archive").to_pylist())
        return _archives(to_warc(record) for content in files for record in parse_arc(content))

    return map_partitions(archives.select("archive"), converted, "archive binary", rows=1)


def pages_to_warc(pages: DataFrame) -> DataFrame:
    """WARC archives (archive) of (page_id, url, html, refers, refers_url, version) rows.

    Each batch of pages is made an ARC file per version, which is then converted.
    ``refers`` is the key of the page that a page revisits, or null, ``refers_url`` its URL.
    """

    def records(batch: pa.RecordBatch) -> Iterator[bytes]:
        pages = list(
            zip(batch.column("page_id").to_pylist(), utf8(batch, "url"), utf8(batch, "html"), strict=True)
        )
        refers, versions = batch.column("refers").to_pylist(), batch.column("version").to_pylist()
        places = utf8(batch, "refers_url")
        originals = [
            None if key is None else Original(key, _clean_url(url))
            for key, url in zip(refers, places, strict=True)
        ]
        for version in ARC_FIELDS:
            own = [i for i, v in enumerate(versions) if v == version]
            if own:
                legacy = parse_arc(arc_file([pages[i] for i in own], version))
                for i, record in zip(own, legacy, strict=True):
                    yield to_warc(record, originals[i])

    def converted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _archives(record for batch in batches for record in records(batch))

    return map_partitions(pages, converted, "archive binary", rows=100)


def write_warc(archives: DataFrame, path: str) -> None:
    """One file per archive, ``.txt.gz`` by Spark's naming: gzipped WARC."""
    # the writer puts the last record's end after each row
    body = F.expr(f"substring(archive, 1, octet_length(archive) - {len(END)})")
    (
        archives.select(body.cast("string").alias("value"))
        .write.option("lineSep", END.decode())
        .option("maxRecordsPerFile", 1)
        .option("compression", "gzip")
        .text(path)
    )


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives in ``path``.

    page_id, payload_bytes, payload_digest, record_type, refers_to, record_id and
    refers_to_id, the record_id of the response. Length and digest of a response are those
    of the payload read; of a revisit, those it declares.
    """
    def parsed(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for content in batch.column("content").to_pylist():
            for record in parse_warc(gzip.decompress(content)):
                kind = record.fields["WARC-Type"]
                length = int(record.fields["WARC-Source-Payload-Length"])
                digest = record.fields["WARC-Payload-Digest"].removeprefix("sha1:")
                if kind == "response":
                    _, _, payload = split_http(record.block)
                    if (length, digest) != (len(payload), sha1_base32(payload)):
                        raise ValueError(f"{record.fields['WARC-Record-ID']} has another payload")
                key, refers = (record.fields.get(f"WARC-Source-{x}") for x in ("Key", "Refers-To"))
                ids = (record.fields["WARC-Record-ID"], record.fields.get("WARC-Refers-To"))
                rows.append((key and int(key), length, digest, kind, refers and int(refers), *ids))
        columns = zip(*rows, strict=True) if rows else [[]] * 7
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())
        names = (
            "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id",
            "refers_to_id",
        )
        arrays = [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, list(names))

    files = spark.read.format("binaryFile").load(path).select("content")
    return map_batches(
        files,
        parsed,
        "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long,"
        " record_id string, refers_to_id string",
        rows=1,
    )


def responses(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(digest, keeper, keeper_url) of each payload of at least ``min_bytes`` bytes.

    Of several rows with the largest page_id the one with the greatest url counts.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    last = F.max(F.struct("page_id", "url"))
    return (
        pages.select(F.sha1(payload).alias("digest"), "page_id", "url", payload.alias("payload"))
        .filter(F.octet_length("payload") >= min_bytes)
        .groupBy("digest")
        .agg(last.alias("last"))
        .select(
            "digest", F.col("last.page_id").alias("keeper"), F.col("last.url").alias("keeper_url")
        )
    )


def archive_pages(
    pages: DataFrame, min_bytes: int = 0, path: str | None = None
) -> tuple[str, DataFrame]:
    """Write ``pages`` as ARC, convert to WARC files in ``path``, and read these back.

    Of pages with equal payloads of at least ``min_bytes`` bytes the one with the largest
    page_id is a response and the others revisit it; all rows with that id are responses.
    Null html is an empty payload, a null url an empty one. Rows with a null page_id revisit
    a page with the same payload that has an id; among themselves they are responses. Pages
    with even ids go through version 2 of ARC, others through version 1.
    """
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    narrow = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    keepers = responses(narrow, min_bytes)
    payload = F.coalesce(F.col("html"), F.lit(""))
    other = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    decided = (
        narrow.withColumn("own_digest", F.sha1(payload))
        .join(keepers, F.col("own_digest") == F.col("digest"), "left")
        .select(
            "page_id",
            "url",
            "html",
            F.when(other, F.col("keeper").cast("string")).alias("refers"),
            F.when(other, F.col("keeper_url")).alias("refers_url"),
            F.when(F.col("page_id") % 2 == 0, 2).otherwise(1).alias("version"),
        )
    )
    write_warc(pages_to_warc(decided), path)
    return path, read_warc(spark, path)
