"""Legacy ARC archives converted to WARC, written and read back.

An ARC file opens with a version block whose second line names the fields of
every following header line; a record is one such line, ``length`` bytes as
declared, and a line feed.  The converter takes the fields by the version of
the file (1: five, 2: ten), and synthesises what WARC asks for: a record id
derived from the record's origin and digest, an ISO timestamp, the record type
and SHA-256 digests.  Equal payloads are kept once: the record with the least
source id is the response, the others are revisits that refer to it.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import bounded_broadcast, slices, staged, wide_rows

#: Fixed values of the two formats: field names by ARC version, WARC's version
#: line and the profile of a revisit with an identical payload.
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"],
}
WARC_VERSION = b"WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

END = b"\r\n\r\n"
ARCHIVE_BYTES = 16 << 20
_SPACE = re.compile(r"[\x00-\x20\x7f]")


@dataclass
class ArcRecord:
    version: int
    fields: dict[str, str]
    body: bytes


def parse_arc(content: bytes) -> Iterator[ArcRecord]:
    """Records of one ARC file, without its version block.

    Fields are counted from the right, so a URL with spaces stays whole.
    Raises ValueError on a header line that does not fit the file's version
    or a declared length beyond the end.
    """
    version, at = 0, 0
    while at < len(content):
        if content[at : at + 1] == b"\n":
            at += 1
            continue
        end = content.find(b"\n", at)
        line = content[at : end if end >= 0 else len(content)].decode("utf-8", "replace").rstrip("\r")
        names = ARC_FIELDS[version or 1]
        if not version and line.startswith("filedesc://"):
            # version 2 files also spell their own first line with ten fields
            names = ARC_FIELDS[2 if len(line.split(" ")) >= len(ARC_FIELDS[2]) else 1]
        parts = line.rsplit(" ", len(names) - 1)
        if len(parts) != len(names) or not parts[-1].isdigit() or end < 0:
            raise ValueError(f"not an ARC header line of version {version or '?'}: {line[:80]!r}")
        fields, body = dict(zip(names, parts)), content[end + 1 : end + 1 + int(parts[-1])]
        if len(body) != int(parts[-1]):
            raise ValueError(f"record of {parts[-1]} bytes is cut off: {line[:80]!r}")
        at = end + 1 + len(body)
        if not version:
            version = int(body.split(b" ", 1)[0])
            if version not in ARC_FIELDS:
                raise ValueError(f"unknown ARC version {version}")
            continue
        yield ArcRecord(version, fields, body)


def arc_file(name: str, version: int, date: str, records: list[tuple[dict[str, str], bytes]]) -> bytes:
    """An ARC file of the given records; their fields but for the length."""
    names = ARC_FIELDS[version]

    def line(fields: dict[str, str], body: bytes) -> bytes:
        values = [_SPACE.sub(lambda m: f"%{ord(m[0]):02X}", fields.get(x) or "-") for x in names[:-1]]
        return " ".join([*values, str(len(body))]).encode() + b"\n" + body + b"\n"

    head = f"{version} 0 trustlens\n{' '.join(names)}\n".encode()
    first = {"URL": f"filedesc://{name}", "IP-address": "0.0.0.0", "Archive-date": date, "Content-type": "text/plain"}
    return b"".join([line(first, head), *(line(f, b) for f, b in records)])


def timestamp(date: str) -> str:
    """WARC-Date of an ARC date; short dates are filled up with the least value."""
    digits = re.sub(r"\D", "", date)[:14]
    d = digits + "00000101000000"[len(digits) :]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def record_id(source: str, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{source}|{digest}')}>"


def payload_of(body: bytes, is_http: bool) -> tuple[bytes, bytes]:
    """(protocol head, payload) of a record's body."""
    if not is_http:
        return b"", body
    at = body.find(END)
    return (body, b"") if at < 0 else (body[: at + 4], body[at + 4 :])


# --- pages to ARC -------------------------------------------------------------


def _to_arc(date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "html"):
            records = []
            for page, url, html in zip(b.column("page_id").to_pylist(), b.column("url").to_pylist(), b.column("html").cast(pa.binary()).to_pylist()):
                payload = html or b""
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Length: {len(payload)}".encode() + END
                source = "-" if page is None else f"page-{page}"
                fields = {"URL": url or f"urn:{source}", "IP-address": "0.0.0.0", "Archive-date": date, "Content-type": "text/html", "Result-code": "200", "Filename": source}
                records.append((fields, head + payload))
            yield pa.RecordBatch.from_arrays([pa.array([arc_file("pages.arc", 2, date, records)], pa.binary())], names=["content"])

    return run


def pages_to_arc(pages: DataFrame, date: str = "20240101000000") -> DataFrame:
    """(content): version 2 ARC files of the rows of ``pages`` (page_id, url,
    html), one record each; a null html is an empty payload, a null url is
    named after the page.  The page's id is the record's Filename field."""
    rows = wide_rows(pages).select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return rows.mapInArrow(_to_arc(date), "content binary")


# --- ARC to WARC --------------------------------------------------------------

_CONVERTED = "source_id long, uri string, warc_date string, mime string, is_http boolean, head binary, payload binary, payload_bytes long, payload_digest string"


def _convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split(" ")[0] for x in _CONVERTED.split(", ")]
    for b in batches:
        for content in b.column("content"):
            columns = [[] for _ in names]
            for r in parse_arc(content.as_py()):
                uri = r.fields["URL"]
                is_http = r.body.startswith(b"HTTP/")
                head, payload = payload_of(r.body, is_http)
                source = re.fullmatch(r"page-(-?\d+)", r.fields.get("Filename", ""))
                row = (int(source[1]) if source else None, uri, timestamp(r.fields["Archive-date"]), r.fields["Content-type"])
                row += (is_http, head, payload, len(payload), hashlib.sha256(payload).hexdigest())
                for column, value in zip(columns, row):
                    column.append(value)
            types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.bool_(), pa.binary(), pa.binary(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def convert_arc(archives: DataFrame) -> DataFrame:
    """One row per record of ARC files (column content, bytes of a file): its
    origin, WARC date, protocol head, payload, length and hex SHA-256."""
    return archives.select("content").mapInArrow(_convert, _CONVERTED)


def mark_revisits(records: DataFrame, at_least: int = 100) -> DataFrame:
    """Add refers_to: the least source_id among records with the same payload
    of ``at_least`` bytes or more, where that is another one; else null.

    Records without a source_id refer to one that has it; rows that share the
    least source_id are all responses.
    """
    same = records.where(F.col("payload_bytes") >= at_least).groupBy("payload_digest")
    same = same.agg(F.min("source_id").alias("first_id"), F.count(F.lit(1)).alias("times"))
    same = staged(same.where("times > 1 and first_id is not null").drop("times"), "same-payloads")
    found = records.join(bounded_broadcast(same), "payload_digest", "left")
    return found.withColumn("refers_to", F.when(~F.col("source_id").eqNullSafe(F.col("first_id")), F.col("first_id"))).drop("first_id")


def warc_record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A WARC record but for the two line ends after its block."""
    lines = [WARC_VERSION, f"WARC-Type: {kind}".encode(), *(f"{k}: {v}".encode() for k, v in headers)]
    return b"\r\n".join([*lines, f"Content-Length: {len(block)}".encode()]) + END + block


def _to_warc(row: dict) -> bytes:
    source, digest = row["source_id"], row["payload_digest"]
    origin = row["uri"] if source is None else f"page-{source}"
    kind = "response" if row["is_http"] else "resource"
    headers = [
        ("WARC-Record-ID", record_id(origin, digest)),
        ("WARC-Date", row["warc_date"]),
        ("WARC-Target-URI", row["uri"]),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http; msgtype=response" if row["is_http"] else row["mime"]),
    ]
    if source is not None:
        headers.append(("WARC-X-Source-ID", str(source)))
    block = row["head"] + row["payload"]
    if row["refers_to"] is not None:
        kind, block = "revisit", row["head"]
        headers += [
            ("WARC-Profile", SAME_PAYLOAD),
            ("WARC-Refers-To", record_id(f"page-{row['refers_to']}", digest)),
            ("WARC-X-Refers-To-Source-ID", str(row["refers_to"])),
            ("WARC-X-Payload-Length", str(row["payload_bytes"])),
        ]
    headers.append(("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"))
    return warc_record(kind, headers, block)


def _archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def archive() -> pa.RecordBatch:
        about = b"software: trustlens\r\nformat: WARC File Format 1.1\r\n"
        info = [("WARC-Record-ID", record_id("warcinfo", hashlib.sha256(held[0]).hexdigest())), ("WARC-Date", timestamp("")), ("Content-Type", "application/warc-fields")]
        return pa.RecordBatch.from_arrays([pa.array([END.join([warc_record("warcinfo", info, about), *held])], pa.binary())], names=["content"])

    for b in slices(batches, "payload"):
        for row in b.to_pylist():
            held.append(_to_warc(row))
            size += len(held[-1])
            if size >= ARCHIVE_BYTES:
                yield archive()
                held, size = [], 0
    if held:
        yield archive()


def write_warc(records: DataFrame, path: str) -> None:
    """Write converted records (with refers_to) as WARC files of about 16 MB.

    The text sink writes bytes as they are, one archive per file, and its line
    separator is the end of the last record; Spark commits the files.
    """
    raw = records.mapInArrow(_archives, "content binary").select(F.col("content").cast("string").alias("value"))
    raw.write.option("maxRecordsPerFile", 1).option("lineSep", END.decode()).text(path)


# --- reading ------------------------------------------------------------------


def parse_warc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of a WARC file."""
    at = 0
    while at < len(content):
        end = content.find(END, at)
        lines = content[at:end].split(b"\r\n") if end >= 0 else []
        if not lines or not lines[0].startswith(b"WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = dict(x.decode().split(": ", 1) for x in lines[1:])
        size = int(headers["Content-Length"])
        block = content[end + 4 : end + 4 + size]
        if len(block) != size or content[end + 4 + size : end + 8 + size] != END:
            raise ValueError(f"record at byte {at} is cut off")
        yield headers, block
        at = end + 8 + size


_READ = "source_id long, uri string, record_id string, record_type string, payload_bytes long, payload_digest string, refers_to long"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split(" ")[0] for x in _READ.split(", ")]
    types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    for b in batches:
        for content in b.column("content"):
            columns = [[] for _ in names]
            for h, block in parse_warc(content.as_py()):
                kind = h["WARC-Type"]
                if kind == "warcinfo":
                    continue
                if hashlib.sha256(block).hexdigest() != h["WARC-Block-Digest"].removeprefix("sha256:"):
                    raise ValueError(f"block digest of {h['WARC-Record-ID']} does not hold")
                digest = h["WARC-Payload-Digest"].removeprefix("sha256:")
                if kind == "revisit":
                    size = int(h["WARC-X-Payload-Length"])
                else:
                    payload = payload_of(block, kind == "response")[1]
                    size = len(payload)
                    if hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"payload digest of {h['WARC-Record-ID']} does not hold")
                whole = lambda name: int(h[name]) if name in h else None  # noqa: E731, B023
                row = (whole("WARC-X-Source-ID"), h["WARC-Target-URI"], h["WARC-Record-ID"], kind, size, digest, whole("WARC-X-Refers-To-Source-ID"))
                for column, value in zip(columns, row):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the WARC files under ``path``; digests of every
    block, and of every payload that is there, are checked on the way."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(_read, _READ)


def pages_through_warc(pages: DataFrame, path: str) -> DataFrame:
    """Write ``pages`` as WARC under ``path`` by way of ARC, and read it back:
    (page_id, payload_bytes, payload_digest, record_type, refers_to, uri).

    Every row gives a record.  A null html is an empty payload; a null page_id
    comes back null; repeated rows of a page_id are all kept.  An empty table
    writes no archive and gives no rows.  Other columns are not read.
    """
    records = convert_arc(pages_to_arc(pages))
    write_warc(mark_revisits(records), path)
    back = read_warc(pages.sparkSession, path)
    return back.select(F.col("source_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to", "uri")
