"""Web archives: a converter of legacy ARC files to WARC, a WARC writer with revisit records, and a reader.

ARC: a version block names the fields of the header line of each record; the header's last field is the record's length.
Version 1 headers have URL, IP address, date, content type and length; version 2 adds result code, checksum, location,
offset and file name.  Conversion synthesises what WARC asks for beside: record ids, ISO dates, types and digests.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import scratch_path, stash, text_bytes

# The formats' header fields, separators and profile.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
RECORD_END = b"\r\n\r\n"
_DATE, _ADDRESS = re.compile(r"\d{4,14}"), re.compile(r"\d+(\.\d+){3}|[0-9a-fA-F]*:[0-9a-fA-F:.]+")
#: Files of pages up to so many bytes hold so many records, so that a file's size is bounded.
FILE_RECORDS = ((64 << 10, 4000), (4 << 20, 64), (1 << 62, 1))


@dataclass
class ArcRecord:
    fields: dict[str, str]
    block: bytes

    @property
    def url(self) -> str:
        return self.fields["URL"]


@dataclass
class WarcRecord:
    headers: dict[str, str]
    block: bytes = b""
    http: dict[str, str] = field(default_factory=dict)
    payload: bytes = b""

    def to_bytes(self) -> bytes:
        """The record without the two line ends that close it."""
        head = "".join(f"{k}: {v}\r\n" for k, v in self.headers.items())
        return f"WARC/1.0\r\n{head}Content-Length: {len(self.block)}\r\n\r\n".encode() + self.block


def digest32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def arc_header(version: int, url: str, date: str, mime: str, length: int, status: str = "200", checksum: str = "-", name: str = "-") -> bytes:
    """A record's header line; a URL is escaped so that it holds no space or control character."""
    url = quote(url, safe="!#$%&'()*+,/:;=?@[]~-._") or "unknown:"
    parts = [url, "0.0.0.0", date, mime] + ([status, checksum, "-", "0", name] if version == 2 else []) + [str(length)]
    return (" ".join(parts) + "\n").encode()


def arc_version_block(version: int, name: str, date: str) -> bytes:
    """What an ARC file begins with."""
    body = f"{version} 0 tidewell\n{ARC_FIELDS[version]}\n".encode()
    head = arc_header(version, f"filedesc://{name}", date, "text/plain", len(body) + 1, name=name)
    return head + body + b"\n"


def _header(line: bytes, names: list[str]) -> dict[str, str]:
    """The fields of a record's header line.  URLs and content types may hold spaces, so the fields between are found by
    the date and the address before it; fields that a short line lacks are ``-``."""
    values = line.decode("utf-8", "replace").rstrip("\r").split(" ")
    if len(values) < 3 or not values[-1].isdigit():
        raise ValueError(f"not a record's header: {line[:80]!r}")
    if len(values) != len(names):
        at = next((i for i in range(2, len(values) - 1) if _DATE.fullmatch(values[i]) and _ADDRESS.fullmatch(values[i - 1])), None)
        if at is None:
            raise ValueError(f"no date and address in a record's header: {line[:80]!r}")
        rest, behind = values[at + 1 : -1], len(names) - 5  # fields after the content type
        tail = rest[len(rest) - behind :] if behind and len(rest) > behind else rest[1:] if behind else []
        mime = " ".join(rest[: len(rest) - len(tail)]) or "-"
        values = [" ".join(values[: at - 1]), values[at - 1], values[at], mime, *tail, *["-"] * (behind - len(tail)), values[-1]]
    return dict(zip(names, values, strict=True))


def parse_arc(data: bytes, problems: list[str] | None = None) -> Iterator[ArcRecord]:
    """The records after the version block, by declared lengths; line ends between records may lack or repeat.

    What is no record raises ValueError.  With ``problems`` it is noted there, and reading goes on at the next line that is
    a record's header.
    """
    first = data.find(b"\n")
    head = data[:first].decode().split(" ")
    body = data[first + 1 : first + 1 + int(head[-1])].decode()
    version = int(body.split(" ", 1)[0])
    names = body.split("\n")[1].split(" ") if body.count("\n") > 1 else ARC_FIELDS[version].split(" ")
    at = first + 1 + int(head[-1])
    lost = False
    while True:
        while data[at : at + 1] in (b"\n", b"\r"):
            at += 1
        if at >= len(data):
            return
        end = data.find(b"\n", at)
        end = len(data) if end < 0 else end
        try:
            fields = _header(data[at:end], names)
            length = int(fields["Archive-length"])
            if end + 1 + length > len(data):
                raise ValueError(f"record of {fields['URL']} is cut short")
        except ValueError as e:
            if problems is None:
                raise
            if not lost:
                problems.append(str(e))
            lost, at = True, end + 1
            continue
        yield ArcRecord(fields, data[end + 1 : end + 1 + length])
        lost, at = False, end + 1 + length


def split_http(block: bytes) -> tuple[bytes, dict[str, str], bytes]:
    """Head, header fields (lower-case names) and payload of an HTTP response."""
    head, gap, payload = block.partition(b"\r\n\r\n")
    fields = dict((k.strip().lower(), v.strip()) for k, _, v in (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:]))
    return head + gap, fields, payload


def iso_date(stamp: str) -> str:
    """An ARC date (year to second, trailing parts may lack) as a WARC date."""
    stamp = (stamp + "00000101000000"[len(stamp) :])[:14]
    return f"{stamp[:4]}-{stamp[4:6]}-{stamp[6:8]}T{stamp[8:10]}:{stamp[10:12]}:{stamp[12:]}Z"


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, '|'.join(parts))}>"


def arc_to_warc(record: ArcRecord) -> WarcRecord:
    """The equivalent WARC record: a response for HTTP, a resource for anything else (DNS answers, for one)."""
    is_http = record.block.startswith(b"HTTP/")
    head, http, payload = split_http(record.block) if is_http else (b"", {}, record.block)
    digest = digest32(payload)
    headers = {
        "WARC-Type": "response" if is_http else "resource",
        "WARC-Record-ID": record_id(digest, http.get("x-page-id") or f"{record.url} {record.fields['Archive-date']}"),
        "WARC-Date": iso_date(record.fields["Archive-date"]),
        "WARC-Target-URI": record.url,
        "WARC-IP-Address": record.fields["IP-address"],
        "WARC-Block-Digest": "sha1:" + digest32(record.block),
        "WARC-Payload-Digest": "sha1:" + digest,
        "Content-Type": "application/http; msgtype=response" if is_http else record.fields["Content-type"],
    }
    return WarcRecord(headers, record.block, http, payload)


def to_revisit(record: WarcRecord, original: str) -> WarcRecord:
    """The record without its payload, referring to the record of page ``original`` that has an equal one."""
    head = record.block[: len(record.block) - len(record.payload)]
    digest = record.headers["WARC-Payload-Digest"]
    headers = record.headers | {
        "WARC-Type": "revisit",
        "WARC-Profile": REVISIT_PROFILE,
        "WARC-Refers-To": record_id(digest.removeprefix("sha1:"), original),
        "WARC-Block-Digest": "sha1:" + digest32(head),
    }
    return WarcRecord(headers, head, record.http)


def page_arc(page_id: int | None, url: str | None, payload: bytes, version: int, date: str) -> bytes:
    """One page as an ARC file's record."""
    extra = "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n{extra}\r\n".encode() + payload
    return arc_header(version, url or "", date, "text/html", len(block), checksum=hashlib.md5(payload).hexdigest()) + block + b"\n"


def read_warc(stream: io.BufferedIOBase) -> Iterator[WarcRecord]:
    """Records of an uncompressed WARC stream, one at a time."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers: dict[str, str] = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode().partition(":")
            headers[name] = value.strip()
        length = int(headers.pop("Content-Length"))
        block = stream.read(length)
        if len(block) != length:
            raise ValueError(f"record {headers.get('WARC-Record-ID')} is cut short")
        record = WarcRecord(headers, block)
        if headers.get("Content-Type", "").startswith("application/http"):
            _, record.http, record.payload = split_http(block)
        else:
            record.payload = block
        yield record


def convert_arc_files(spark: SparkSession, path: str) -> DataFrame:
    """WARC records (name of the ARC file, record bytes, null) of all ARC files below ``path``; gzip members are read too.
    What a file holds that is no record comes as a row without a record that says what is wrong."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
                problems: list[str] = []
                found = [arc_to_warc(r).to_bytes() for r in parse_arc(data, problems)]
                n = len(found) + len(problems)
                columns = (pa.array([name] * n, pa.string()), pa.array(found + [None] * len(problems), pa.binary()), pa.array([None] * len(found) + problems, pa.string()))
                yield pa.RecordBatch.from_arrays(list(columns), ["arc", "record", "problem"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(convert, "arc string, record binary, problem string")


def write_warc(records: DataFrame, path: str, compression: str | None = "gzip", records_per_file: int = 4000) -> None:
    """Write the ``record`` column (bytes without their end; null is no record) as WARC files through Spark's own file
    systems, beside those that are below ``path`` already."""
    writer = records.where("record is not null").select(F.col("record").cast("string")).write.mode("append").option("lineSep", RECORD_END.decode()).option("maxRecordsPerFile", records_per_file)
    (writer.option("compression", compression) if compression else writer).text(path)


PAGE_ROWS = "page_id long, payload_bytes long, payload_digest string, record_type string, record_id string, refers_to string"


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """The page rows that WARC files hold: page_id, payload_bytes, payload_digest, record_type, refers_to (the page_id of the
    response whose record a revisit refers to).  Payloads of responses are checked against their declared lengths and digests."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0).to_pylist():
                stream = gzip.GzipFile(fileobj=io.BytesIO(data)) if data[:2] == b"\x1f\x8b" else io.BytesIO(data)
                rows = []
                for r in read_warc(stream):
                    kind = r.headers["WARC-Type"]
                    if kind not in ("response", "revisit"):
                        continue
                    digest, declared = r.headers["WARC-Payload-Digest"].removeprefix("sha1:"), int(r.http["content-length"])
                    if kind == "response" and (declared != len(r.payload) or digest != digest32(r.payload)):
                        raise ValueError(f"payload of {r.headers['WARC-Record-ID']} isn't what its header says")
                    number = lambda name: int(v) if (v := r.http.get(name)) is not None else None  # noqa: B023, E731
                    rows.append((number("x-page-id"), declared, digest, kind, r.headers["WARC-Record-ID"], r.headers.get("WARC-Refers-To")))
                columns = list(zip(*rows, strict=True)) or [()] * 6
                kinds = (pa.int64(), pa.int64(), *[pa.string()] * 4)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [x.split()[0] for x in PAGE_ROWS.split(", ")])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    found = stash(files.select("content").mapInArrow(parse, PAGE_ROWS), "warc-rows")
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type")
    first = found.where("record_type = 'response'").select(F.col("record_id").alias("first"), F.col("page_id").alias("first_page")).dropDuplicates(["first"])
    revisits = found.where("record_type = 'revisit'").join(first, F.col("refers_to") == F.col("first"), "left")
    return found.where("record_type = 'response'").select(*columns, F.lit(None).cast("long").alias("refers_to")).unionByName(
        revisits.select(*columns, F.col("first_page").alias("refers_to"))
    )


def _about_archive(date: str) -> bytes:
    """A record that says what wrote the archive."""
    block = b"software: tidewell\r\nformat: WARC File Format 1.0\r\n"
    headers = {"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": iso_date(date), "Content-Type": "application/warc-fields"}
    return WarcRecord(headers, block).to_bytes()


def archive_pages(pages: DataFrame, path: str, least_bytes: int = 0, date: str | None = None) -> None:
    """Write a WARC record for every row of ``pages(page_id, url, html)`` below ``path``, dated ``date`` (an ARC date; by
    default when it is called).  Each task's records follow one that says what wrote them; long pages are in files of few.

    Each page becomes an ARC record (version 1 for even ids, 2 for odd ones), which the converter turns into WARC.  Of
    rows with equal payloads of at least ``least_bytes`` that with the smallest page_id is the response, the others
    revisit it; among rows that share that page_id, too, one is (they are written with the first URL).  A null html is an
    empty payload; a null url is written as ``unknown:``; rows with a null page_id revisit any others, and if all are null
    one of them is the response, without an id to refer to.  An empty table writes no record.
    """
    keyed = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("html"),
    ).withColumn("payload", F.when(F.octet_length("html") >= least_bytes, F.sha1("html")))
    order = F.struct(F.col("page_id").isNull().alias("none"), F.col("page_id").alias("page_id"), F.col("same").alias("same"))
    firsts = stash(
        keyed.where("payload is not null")
        .groupBy("payload", "page_id")
        .agg(F.count("*").alias("same"))
        .groupBy("payload")
        .agg(F.min(order).alias("first"), F.sum("same").alias("rows"))
        .where("rows > 1")
        .select(F.col("payload").alias("p"), F.col("first.page_id").alias("first_id"), (F.col("first.same") > 1).alias("tied")),
        "warc-firsts",
    )
    joined = keyed.join(firsts, F.col("payload") == F.col("p"), "left")
    is_first = F.col("p").isNull() | F.col("page_id").eqNullSafe(F.col("first_id"))
    rows = joined.select("page_id", "url", "html", is_first.alias("response"), F.when(~is_first, F.col("first_id")).alias("refers"), F.coalesce("tied", F.lit(False)).alias("tied"))
    if not firsts.where("tied").isEmpty():
        ties = rows.where("tied and response").groupBy("page_id", F.md5("html")).agg(F.min("url").alias("url"), F.min("html").alias("html"), F.count("*").alias("n"))
        copies = ties.select("page_id", "url", "html", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("copy"))
        copies = copies.select("page_id", "url", "html", (F.col("copy") == 1).alias("response"), F.when(F.col("copy") > 1, F.col("page_id")).alias("refers"), F.lit(True).alias("tied"))
        rows = rows.where("not (tied and response)").unionByName(copies)

    date = date or time.strftime("%Y%m%d%H%M%S", time.gmtime())

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun = False
        for batch in batches:
            html = text_bytes(batch.column(2))
            out = [] if begun or not html else [_about_archive(date)]
            begun = begun or bool(html)
            for k, (page, url, first, refers) in enumerate(zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 4)), strict=True)):
                version = 2 if page is not None and page % 2 else 1
                arc = arc_version_block(version, "pages.arc", date) + page_arc(page, url, html[k], version, date)
                for record in map(arc_to_warc, parse_arc(arc)):
                    out.append((record if first else to_revisit(record, str(refers))).to_bytes())
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    longest = keyed.agg(F.max(F.octet_length("html"))).first()[0] or 0
    low = -1
    for high, records in FILE_RECORDS:
        if low < longest:
            sized = rows.where((F.octet_length("html") > low) & (F.octet_length("html") <= high))
            write_warc(sized.mapInArrow(convert, "record binary"), path, records_per_file=records)
        low = high


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Archive ``pages`` in the shared scratch folder and read the archives back: page_id, payload_bytes, payload_digest
    (bare base32 SHA-1; both of the full payload), record_type, refers_to.  For nulls and ties see :func:`archive_pages`."""
    path = scratch_path(pages.sparkSession, "warc")
    archive_pages(pages, path, least_bytes)
    return read_pages(pages.sparkSession, path)


ORACLE_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes,
    list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        ((('0x' || substr(h, ((i // 4) * 5 + 1)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31)::INT + 1, 1)), 'string_agg', '') AS payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM p
"""
