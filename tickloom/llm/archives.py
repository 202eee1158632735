"""Legacy web archives (ARC, versions 1 and 2) turned into WARC.

An ARC file begins with a version block that names its version and the fields of its header
lines; every record is a header line by those fields, the declared number of bytes, and a
line end. A WARC record is made of each: an identifier derived from place, address and time,
the time in ISO form, a type by what the bytes are, and digests. Records whose payload was
seen before become revisits.

Archives are written by Spark's own text writer, one file for each task, with what ends a
record as line separator, and read whole by Spark's binary reader, so they may lie in any
store that Spark knows. The number of records bounds a file; inside, a task reads record by
record. Equal payloads are found by digest; of each digest one row is kept, and its join
with the records is one Spark can split where a digest is frequent.

Cases: a null payload is an empty one. Payloads below ``LEAST_REVISIT`` bytes are never
revisits. Of equal payloads the row with the smallest id is the response (repeated rows of
that id too; rows without an id come last). A null address is written as ``about:blank``;
blanks, control and non-ASCII letters in it are percent-encoded. Empty tables give archives
without records. Columns other than id, address and payload do not matter.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from datetime import UTC, datetime, timedelta
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.workspace import fresh_path, settle

LEAST_REVISIT = 100
RECORDS_PER_FILE = 10_000
# A task hands on what it has read when it holds so many bytes.
BATCH_BYTES = 4_000_000

# The header fields of the two ARC versions.
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"],
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_FIELD = "X-Page-Id"

RECORD_SQL = (
    "record_id string, kind string, page string, uri string, ip string, date string, content_type string, "
    "head binary, payload binary, payload_bytes bigint, digest string"
)
RECORD = pa.schema(
    [(x, pa.string()) for x in ("record_id", "kind", "page", "uri", "ip", "date", "content_type")]
    + [("head", pa.binary()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("digest", pa.string())]
)


# --- ARC ---------------------------------------------------------------------------------


def arc_version_block(name: str, version: int, date: str) -> bytes:
    """The first record of a file, without the line end that follows it."""
    body = f"{version} 0 tickloom\n{' '.join(ARC_FIELDS[version])}\n".encode()
    return arc_record(f"filedesc://{name}", "0.0.0.0", date, "text/plain", body, version, name, 0)


def arc_record(uri: str, ip: str, date: str, kind: str, body: bytes, version: int, name: str, offset: int) -> bytes:
    """A header line by the fields of the version, then the declared bytes."""
    values = {
        "URL": uri, "IP-address": ip, "Archive-date": date, "Content-type": kind, "Result-code": "200",
        "Checksum": "-", "Location": "-", "Offset": str(offset), "Filename": name, "Archive-length": str(len(body)),
    }
    return " ".join(values[field] for field in ARC_FIELDS[version]).encode() + b"\n" + body


def arc_address(uri: str | None) -> str:
    return quote(uri, safe="!#$%&'()*+,/:;=?@[]~-._") if uri else "about:blank"


def write_arc(pages: DataFrame, path: str, key: str = "page_id", uri: str = "url", payload: str = "html") -> None:
    """Write pages as compressed ARC files, every other one in version 2."""
    rows = pages.select(F.col(key).cast("string"), F.col(uri).cast("string"), F.col(payload).cast("binary"))

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        version, name, offset = 1 + part % 2, f"pages-{part:05d}.arc", 0
        start = datetime(2000, 1, 1)
        for batch in batches:
            records = []
            for page, address, body in zip(*(column.to_pylist() for column in batch.columns)):
                moment = start + timedelta(seconds=offset // 1000)
                date = f"{moment:%Y%m%d%H%M%S}"
                if not offset:
                    records.append(arc_version_block(name, version, date))
                    offset += len(records[-1]) + 1
                records.append(arc_record(arc_address(address), "192.0.2.1", date, "text/html", http_response(page, body or b""), version, name, offset))
                offset += len(records[-1]) + 1
            # The writer takes text; it hands on its bytes as they are.
            yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], ["record"])

    records = rows.mapInArrow(archive, "record binary").select(F.col("record").cast("string"))
    _write_text(records, path, "\n")


def http_response(page: str | None, body: bytes) -> bytes:
    mark = f"{PAGE_FIELD}: {page}\r\n" if page is not None else ""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{mark}Content-Length: {len(body)}\r\n\r\n"
    return head.encode() + body


def arc_records(file: BinaryIO) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Offset, header fields and bytes of each record of an ARC file."""
    first = file.readline()
    if not first:
        return
    # The version block is needed to read its own header: its last field is the length.
    length = int(first.split()[-1])
    block = file.read(length)
    version = int(block.split(b" ", 1)[0])
    fields = block.split(b"\n")[1].decode().split()
    if fields != ARC_FIELDS.get(version):
        raise ValueError(f"not an ARC version block: {block[:200]!r}")
    yield 0, dict(zip(fields, first.decode().split())), block
    offset = len(first) + length
    while line := file.readline():
        if line.strip():
            values = line.decode().split()
            if len(values) != len(fields) or not values[-1].isdigit():
                raise ValueError(f"not an ARC header of version {version}, at byte {offset}: {line[:200]!r}")
            header = dict(zip(fields, values))
            body = file.read(int(header["Archive-length"]))
            if len(body) < int(header["Archive-length"]):
                raise ValueError(f"the record at byte {offset} ends before its declared length")
            yield offset, header, body
            offset += len(body)
        offset += len(line)


# --- from ARC to WARC --------------------------------------------------------------------


def converted(name: str, offset: int, header: dict[str, str], body: bytes) -> dict:
    """What a WARC record needs, from an ARC record."""
    digits = header["Archive-date"].ljust(14, "0")
    moment = datetime.strptime(digits, "%Y%m%d%H%M%S").replace(tzinfo=UTC)
    uri = header["URL"]
    head, payload, page, content_type = b"", body, None, header["Content-type"]
    if uri.startswith("filedesc:"):
        kind, content_type = "warcinfo", "application/warc-fields"
        head, payload = f"software: tickloom\r\nisPartOf: {name}\r\n".encode(), b""
    elif body.startswith(b"HTTP/"):
        kind, content_type = "response", "application/http; msgtype=response"
        end = body.find(b"\r\n\r\n") + 4
        head, payload = (body[:end], body[end:]) if end > 3 else (body, b"")
        page = _http_field(head, PAGE_FIELD)
    else:
        kind = "resource"
    return {
        "record_id": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}#{offset} {uri} {digits}')}>",
        "kind": kind, "page": page, "uri": uri, "ip": header["IP-address"], "date": f"{moment:%Y-%m-%dT%H:%M:%SZ}",
        "content_type": content_type, "head": head, "payload": payload, "payload_bytes": len(payload),
        "digest": hashlib.sha256(payload).hexdigest(),
    }


def _http_field(head: bytes, name: str) -> str | None:
    for line in head.decode("latin-1").split("\r\n")[1:]:
        field, _, value = line.partition(":")
        if field.strip().lower() == name.lower():
            return value.strip()
    return None


def read_arc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of ARC files as WARC needs them; ``payloads=False`` leaves those out."""

    def records(file: BinaryIO) -> Iterator[dict]:
        name = ""
        for offset, header, body in arc_records(file):
            name = name or header["URL"].removeprefix("filedesc://")
            record = converted(name, offset, header, body)
            yield record if payloads else record | {"payload": None}

    return _read_files(spark, path, records, RECORD_SQL, RECORD)


def with_revisits(records: DataFrame, firsts: DataFrame) -> DataFrame:
    """Records with the first of those with the same payload, null for that one itself."""
    same = records.join(firsts, F.col("digest") == F.col("first_digest"), "left")
    is_first = F.col("page").eqNullSafe(F.col("first.page"))
    kept = F.when((F.col("kind") == "response") & (F.col("payload_bytes") >= LEAST_REVISIT) & ~is_first, F.col("first"))
    return same.select(*records.columns, kept.alias("first"))


def first_payloads(records: DataFrame) -> DataFrame:
    """Of each payload that occurs more than once, the record with the smallest id."""
    number = F.col("page").cast("decimal(38,0)")
    order = F.struct(number.isNull(), number, F.col("page"), F.col("record_id"))
    long = records.filter((F.col("kind") == "response") & (F.col("payload_bytes") >= LEAST_REVISIT))
    first = F.min_by(F.struct("page", "record_id", "uri", "date"), order).alias("first")
    grouped = long.groupBy(F.col("digest").alias("first_digest")).agg(first, F.count(F.lit(1)).alias("n"))
    return grouped.filter("n > 1").drop("n")


def warc_text(record: DataFrame) -> Column:
    """A WARC record without the two line ends that close it."""
    revisit = F.col("first").isNotNull()
    block = F.concat("head", F.when(revisit, F.lit(b"")).otherwise(F.col("payload")))

    def field(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"\r\n{name}: "), value)

    has_payload = F.col("kind").isin("response", "resource")
    header = F.concat(
        F.lit("WARC/1.1"),
        field("WARC-Type", F.when(revisit, "revisit").otherwise(F.col("kind"))),
        field("WARC-Record-ID", F.col("record_id")),
        field("WARC-Date", F.col("date")),
        F.when(has_payload, field("WARC-Target-URI", F.col("uri"))).otherwise(""),
        F.when(has_payload, field("WARC-IP-Address", F.col("ip"))).otherwise(""),
        F.when(has_payload, field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest")))).otherwise(""),
        F.when(revisit, F.concat(
            field("WARC-Profile", F.lit(REVISIT_PROFILE)),
            field("WARC-Refers-To", F.col("first.record_id")),
            field("WARC-Refers-To-Target-URI", F.col("first.uri")),
            field("WARC-Refers-To-Date", F.col("first.date")),
            F.coalesce(field("WARC-Refers-To-Page", F.col("first.page")), F.lit("")),
        )).otherwise(""),
        field("Content-Type", F.col("content_type")),
        field("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n\r\n"),
    )
    return F.concat(header.cast("binary"), block).cast("string")


def arc_to_warc(spark: SparkSession, arc: str, warc: str, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Convert a folder of ARC files into a folder of WARC files."""
    firsts = settle(first_payloads(read_arc(spark, arc, payloads=False)), "payloads")
    records = with_revisits(read_arc(spark, arc), firsts)
    _write_text(records.select(warc_text(records).alias("record")), warc, "\r\n\r\n", records_per_file)


# --- WARC --------------------------------------------------------------------------------

READ_SQL = (
    "record_id string, kind string, page string, uri string, date string, refers_to string, refers_to_page string, "
    "payload binary, payload_bytes bigint, digest string"
)
READ = pa.schema(
    [(x, pa.string()) for x in ("record_id", "kind", "page", "uri", "date", "refers_to", "refers_to_page")]
    + [("payload", pa.binary()), ("payload_bytes", pa.int64()), ("digest", pa.string())]
)


def warc_records(file: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record of a WARC file."""
    while line := file.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:200]!r}")
        header = {}
        while (line := file.readline().strip()) != b"":
            name, _, value = line.decode().partition(":")
            header[name.strip().lower()] = value.strip()
        block = file.read(int(header["content-length"]))
        if len(block) < int(header["content-length"]):
            raise ValueError("a record ends before its declared length")
        yield header, block


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Responses and revisits of WARC files. The size of a revisit's payload is the one
    its HTTP head declares, its digest the one in its header; a response's are worked out
    from what was read."""

    def records(file: BinaryIO) -> Iterator[dict]:
        for header, block in warc_records(file):
            kind = header["warc-type"]
            if kind not in ("response", "revisit", "resource"):
                continue
            end = block.find(b"\r\n\r\n") + 4 if kind != "resource" else 0
            head, payload = block[:end], block[end:]
            if kind == "revisit":
                size, digest = int(_http_field(head, "Content-Length") or 0), header["warc-payload-digest"].split(":")[1]
            else:
                size, digest = len(payload), hashlib.sha256(payload).hexdigest()
                if f"sha256:{digest}" != header["warc-payload-digest"]:
                    raise ValueError(f"{header['warc-record-id']} does not match its digest")
            yield {
                "record_id": header["warc-record-id"], "kind": kind, "page": _http_field(head, PAGE_FIELD),
                "uri": header["warc-target-uri"], "date": header["warc-date"],
                "refers_to": header.get("warc-refers-to"), "refers_to_page": header.get("warc-refers-to-page"),
                "payload": payload if payloads and kind != "revisit" else None, "payload_bytes": size, "digest": digest,
            }

    return _read_files(spark, path, records, READ_SQL, READ)


# --- files -------------------------------------------------------------------------------


def _write_text(records: DataFrame, path: str, separator: str, records_per_file: int = 0) -> None:
    writer = records.write.option("lineSep", separator).option("compression", "gzip")
    # Archives are read once, right after: rather fast than small.
    writer = writer.option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", records_per_file)
    writer.text(path)


def _read_files(spark: SparkSession, path: str, records, schema_sql: str, schema: pa.Schema) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for record in records(gzip.GzipFile(fileobj=io.BytesIO(content.as_buffer()))):
                    rows.append(record)
                    held += len(record.get("payload") or b"") + 500
                    if held >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return files.mapInArrow(read, schema_sql)


def archived_pages(pages: DataFrame, key: str = "page_id", uri: str = "url", payload: str = "html") -> DataFrame:
    """Write pages as legacy archives, convert them, and read the WARC files back."""
    spark = pages.sparkSession
    arc, warc = fresh_path(spark, "arc"), fresh_path(spark, "warc")
    write_arc(pages, arc, key, uri, payload)
    arc_to_warc(spark, arc, warc)
    kind = pages.schema[key].dataType
    return read_warc(spark, warc, payloads=False).select(
        F.col("page").cast(kind).alias(key),
        "payload_bytes",
        F.col("digest").alias("payload_digest"),
        F.col("kind").alias("record_type"),
        F.col("refers_to_page").cast(kind).alias("refers_to"),
    )
