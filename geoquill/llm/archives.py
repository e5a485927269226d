"""Legacy web archives: ARC records are parsed by their declared lengths and become WARC records.

An ARC file begins with a version block (filedesc://) whose second line names the
version: 1 has URL, IP, date, type and length on each record's line; 2 has ten
fields. Lengths count bytes of the block that follows the line; a newline follows
the block. WARC identifiers, timestamps, types and digests are synthesised from
what the ARC line and the HTTP block declare.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoquill.llm.files import read_files, write_pieces

# Field names of the two versions of the format.
FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"),
}
REVISIT = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
#: Payloads of fewer bytes never become revisits.
LEAST_REVISIT = 100


@dataclass
class ArcRecord:
    url: str
    ip: str
    date: str
    kind: str
    status: str
    block: bytes


def arc_line(url: str, date: str, kind: str, block: bytes, version: int, ip: str = "0.0.0.0", offset: int = 0, name: str = "-", status: int = 200) -> bytes:
    safe = "".join(c if c > " " and c != "\x7f" else "".join(f"%{x:02X}" for x in c.encode()) for c in url) or "-"
    if version == 1:
        return f"{safe} {ip} {date} {kind} {len(block)}\n".encode()
    return f"{safe} {ip} {date} {kind} {status} {hashlib.md5(block).hexdigest()} - {offset} {name} {len(block)}\n".encode()


def arc_file(records: list[tuple[str, str, str, bytes]], version: int, name: str = "pages.arc", date: str = "19961111000000") -> bytes:
    """An ARC file of (url, date, type, block) records."""
    body = f"{version} 0 geoquill\n{' '.join(FIELDS[version])}\n".encode()
    out = [arc_line(f"filedesc://{name}", date, "text/plain", body, version, name=name) + body + b"\n"]
    size = len(out[0])
    for url, when, kind, block in records:
        out.append(arc_line(url, when, kind, block, version, offset=size, name=name) + block + b"\n")
        size += len(out[-1])
    return b"".join(out)


def parse_arc(data: bytes) -> Iterator[ArcRecord]:
    """Records of an ARC file, without its version block. Raises ValueError where a line or length is wrong."""
    at, fields = 0, None
    while at < len(data):
        end = data.find(b"\n", at)
        if end < 0:
            raise ValueError(f"no record line at byte {at}")
        line = data[at:end].decode("utf-8", "replace").rstrip("\r")
        if not line:
            at = end + 1
            continue
        # the other fields hold no spaces, so a space in a URL is the URL's
        values = line.rsplit(" ", len(fields or FIELDS[1]) - 1)
        n = int(values[-1])
        block = data[end + 1 : end + 1 + n]
        if len(block) < n:
            raise ValueError(f"the record at byte {at} declares {n} bytes and has {len(block)}")
        if fields is None:
            if not line.startswith("filedesc:"):
                raise ValueError("no version block")
            version = int(block.split(b" ", 1)[0])
            fields = FIELDS[version]
        elif len(values) != len(fields):
            raise ValueError(f"the record at byte {at} has {len(values)} fields, not {len(fields)}")
        else:
            got = dict(zip(fields, values, strict=True))
            yield ArcRecord(got["URL"], got["IP-address"], got["Archive-date"], got["Content-type"], got.get("Result-code", "-"), block)
        at = end + 1 + n
        if at < len(data) and data[at : at + 1] != b"\n":
            raise ValueError(f"no newline after the record that ends at byte {at}")
        at += 1


def inflated(data: bytes) -> bytes:
    """The contents of all gzip members of a file, one after another (archives have one for each record); other data as it is. Raises where a member is cut short."""
    if data[:2] != b"\x1f\x8b":
        return data
    out = []
    while data:
        member = zlib.decompressobj(31)
        out.append(member.decompress(data))
        if not member.eof:
            raise ValueError("a compressed record is cut short")
        data = member.unused_data.lstrip(b"\0")
    return b"".join(out)


def http_parts(block: bytes) -> tuple[bytes, dict[str, str], bytes]:
    """(header bytes with the empty line, header fields by lower-case name, payload) of an HTTP response."""
    end = block.find(b"\r\n\r\n") + 4
    if end < 4:
        return b"", {}, block
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in block[:end].decode("utf-8", "replace").split("\r\n")[1:] if ":" in x)}
    return block[:end], fields, block[end:]


def record_id(page: str, digest: str, place: str = "") -> str:
    """The identifier of a page's record: the same for the same page and payload; place tells records without a page id apart."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page} {digest} {place}')}>"


def warc_record(arc: ArcRecord, refers_to: str | None, place: str = "") -> bytes:
    """A WARC record without the two line ends that close it.

    refers_to: page of the response with the same payload. place: where the record
    stands, for the identifiers of records whose HTTP block names no page.
    """
    head, fields, payload = http_parts(arc.block)
    d, page, digest = arc.date.ljust(14, "0"), fields.get("x-page-id", "-"), hashlib.sha256(payload).hexdigest()
    block = head if refers_to is not None else arc.block
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if refers_to is not None else 'response'}",
        f"WARC-Record-ID: {record_id(page, digest, place if page == '-' else '')}",
        f"WARC-Date: {d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z",
        f"WARC-Target-URI: {arc.url}",
        f"WARC-IP-Address: {arc.ip}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Page: {refers_to}"]
    lines += [f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode("utf-8").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = {k: v.strip() for k, _, v in (x.partition(":") for x in lines)}
        n = int(fields["Content-Length"])
        yield fields, data[end + 4 : end + 4 + n]
        if data[end + 4 + n : end + 8 + n] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} doesn't end where it says")
        at = end + 8 + n


def revisits(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """pages plus gq_refers: for each payload of `least` bytes or more, the smallest page_id that has it, where that is another page.

    Only (digest, page_id) pairs are grouped, summed up before they are shuffled;
    the join takes digests that at least two pages share. Rows that repeat the
    smallest page_id are responses too; rows without page_id revisit, and are
    responses only if no row of that payload has an id.
    """
    digest = F.sha2(F.coalesce(F.col("html").cast("binary"), F.lit(b"")), 256)
    long = F.octet_length(F.coalesce(F.col("html"), F.lit(""))) >= least
    shared = pages.where(long).groupBy(digest.alias("gq_digest")).agg(F.min("page_id").alias("gq_first"), F.count(F.lit(1)).alias("n")).where("n > 1 and gq_first is not null").drop("n")
    return pages.withColumn("gq_digest", F.when(long, digest)).join(shared, "gq_digest", "left").withColumn("gq_refers", F.when(~F.col("page_id").eqNullSafe(F.col("gq_first")), F.col("gq_first"))).drop("gq_digest", "gq_first")


def write_archives(pages: DataFrame, path: str, version: int = 1, date: str = "19961111000000", group: int = 64) -> None:
    """pages (page_id, url, html; nulls: empty) as ARC records, `group` at a time, converted to WARC files under path.

    The files are plain gzip; every record ends in two line ends, the first part
    of each file name is the partition. Ids and payloads may repeat: rows with the
    same page_id and payload are captures of one record and share its identifier,
    rows without page_id have identifiers of their own.
    """

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        place = (f"{TaskContext.get().partitionId()}-{n}" for n in count())
        for b in batches:
            rows = list(zip(*(c.to_pylist() for c in b.columns), strict=True))
            for i in range(0, len(rows), group):
                legacy, refers = [], []
                for page, url, html, ref in rows[i : i + group]:
                    body = html or b""
                    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Page-Id: {'-' if page is None else page}\r\nContent-Length: {len(body)}\r\n\r\n"
                    legacy.append((url or "", date, "text/html", head.encode() + body))
                    refers.append(None if ref is None else str(ref))
                got = parse_arc(arc_file(legacy, version))
                yield pa.RecordBatch.from_arrays([pa.array([warc_record(a, r, p) for a, r, p in zip(got, refers, place, strict=False)], pa.binary())], names=["record"])

    marked = revisits(pages.select("page_id", "url", "html")).select("page_id", "url", F.col("html").cast("binary").alias("html"), F.col("gq_refers").cast("long"))
    write_pieces(marked.mapInArrow(convert, "record binary"), path, "\r\n\r\n", "gzip")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of each record of the files under path."""

    def page(own: str) -> int | None:
        return int(own) if own.lstrip("-").isdigit() else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(1):
                rows = []
                for fields, block in parse_warc(inflated(content.as_buffer().to_pybytes())):
                    head, http, payload = http_parts(block)
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                    revisit = fields["WARC-Type"] == "revisit"
                    if not revisit and (len(payload) != int(http["content-length"]) or hashlib.sha256(payload).hexdigest() != digest):
                        raise ValueError("a payload differs from its record")
                    if revisit and fields["WARC-Refers-To"] != record_id(fields["X-Refers-To-Page"], digest):
                        raise ValueError("a revisit doesn't name its response")
                    rows.append((page(http.get("x-page-id", "-")), int(http["content-length"]), digest, fields["WARC-Type"], page(fields["X-Refers-To-Page"]) if revisit else None))
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()))], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return read_files(spark, path).mapInArrow(read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """url, ip, date, kind, status, block of each record of the ARC files (plain or gzip, in one member or in one for each record) under path, of both versions; files without records give none."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                rows = list(parse_arc(inflated(content.as_buffer().to_pybytes())))
                texts = [pa.array([getattr(r, k) for r in rows], pa.string()) for k in ("url", "ip", "date", "kind", "status")]
                yield pa.RecordBatch.from_arrays([*texts, pa.array([r.block for r in rows], pa.binary())], names=["url", "ip", "date", "kind", "status", "block"])

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(read, "url string, ip string, date string, kind string, status string, block binary")
