"""Legacy archive converter: ARC version 1 and 2 records to WARC 1.1 records, with revisits for repeated payloads.

An archive is a row (name, bytes) of a binary column, so that any file system Spark reads can hold
it; ``spark.read.format("binaryFile")`` gives the same shape for files on disk.  ``parse_arc``
follows the version block's own field list, so records of either version are read by the declared
names and the declared Archive-length, and bytes after a record are never guessed at.

Among equal payloads the record with the smallest page_id is the response and the others are
revisits of it.  The digests are pre-aggregated (min of page_id) before the join, and the join is
left to adaptive skew splitting, so a payload shared by a third of all pages does not meet in one task.

Defined cases: null html is the empty payload; null url becomes ``urn:none``; null page_id never
beats an id, and among null ids alone all are responses; rows repeated with the same page_id and
payload are all responses (or all revisits); extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .util import slices, table, write_scratch

ARCHIVE_BYTES = 4 << 20
#: Fixed values of the two formats: the field lists of ARC version blocks and the revisit profile.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def b32sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def write_arc(records: list[dict], version: int, name: str, date: str = "20240101000000") -> bytes:
    """An ARC file: the version block, then url records with declared lengths."""
    fields = ARC_FIELDS[version]
    block = f"{version} 0 none\n{fields}\n\n".encode()
    if version == 1:
        head = f"filedesc://{name} 0.0.0.0 {date} text/plain {len(block)}\n"
    else:
        head = f"filedesc://{name} 0.0.0.0 {date} text/plain 200 - - 0 {name} {len(block)}\n"
    out = [head.encode() + block]
    at = len(out[0])
    for r in records:
        body = r["http"] + r["payload"]
        url = r["url"].replace(" ", "%20").replace("\n", "%0A")
        if version == 1:
            line = f"{url} {r['ip']} {r['date']} {r['type']} {len(body)}\n"
        else:
            line = f"{url} {r['ip']} {r['date']} {r['type']} 200 {hashlib.md5(body).hexdigest()} - {at} {name} {len(body)}\n"
        out.append(line.encode() + body + b"\n")
        at += len(out[-1])
    return b"".join(out)


def parse_arc(data: bytes) -> Iterator[dict]:
    """Records of an ARC file, with header fields by the names its version block declares."""
    at, names = 0, None
    while at < len(data):
        end = data.index(b"\n", at)
        parts = data[at:end].decode("utf-8").split(" ")
        if names is None:
            length = int(parts[-1])
            block = data[end + 1 : end + 1 + length].decode("utf-8").split("\n")
            version = int(block[0].split(" ")[0])
            if version not in ARC_FIELDS:
                raise ValueError(f"unknown ARC version {version}")
            names = block[1].split(" ")
            at = end + 1 + length
            continue
        if len(parts) != len(names):
            raise ValueError(f"an ARC header of {len(parts)} fields, {len(names)} are declared")
        fields = dict(zip(names, parts, strict=True))
        length = int(fields["Archive-length"])
        body = data[end + 1 : end + 1 + length]
        if len(body) != length:
            raise ValueError("an ARC record is shorter than declared")
        yield {"version": version, "fields": fields, "body": body}
        at = end + 1 + length
        if data[at : at + 1] == b"\n":
            at += 1


def split_http(body: bytes) -> tuple[bytes, bytes]:
    head, sep, payload = body.partition(b"\r\n\r\n")
    return head + sep, payload


def record_id(url: str, date: str, digest: str, page_id: str) -> str:
    """A WARC identifier made from what the legacy record holds: the same record always gets the same one."""
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{url} {date} {digest} {page_id}')}>"


def warc_date(arc_date: str) -> str:
    d = arc_date.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def warc_record(r: dict) -> bytes:
    """One WARC record: a response with http header and payload, or a revisit with the http header alone."""
    revisit = r["refers_to"] is not None
    block = r["http"] if revisit else r["http"] + r["payload"]
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(r['url'], r['date'], r['digest'], str(r['page_id']))}",
        f"WARC-Date: {warc_date(r['date'])}", f"WARC-Target-URI: {r['url']}", f"WARC-IP-Address: {r['ip']}",
        f"WARC-Payload-Digest: sha1:{r['digest']}", f"WARC-Block-Digest: sha1:{b32sha1(block)}", f"X-Payload-Length: {r['payload_bytes']}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(r['refers_url'], r['refers_date'], r['digest'], str(r['refers_to']))}"]
        head += [f"WARC-Refers-To-Target-URI: {r['refers_url']}", f"WARC-Refers-To-Date: {warc_date(r['refers_date'])}", f"X-Refers-To-Page: {r['refers_to']}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_warc(data: bytes) -> Iterator[tuple[dict, bytes]]:
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        head = dict(x.split(": ", 1) for x in lines[1:])
        length = int(head["Content-Length"])
        block = data[end + 4 : end + 4 + length]
        if len(block) != length or f"sha1:{b32sha1(block)}" != head["WARC-Block-Digest"]:
            raise ValueError("a WARC block differs from its header")
        yield head, block
        at = end + 4 + length + 4


def _to_arc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for k, (part, html) in enumerate(slices(batches, text="html", limit=ARCHIVE_BYTES)):
        ids, urls = part.column(0).to_pylist(), part.column(1).to_pylist()
        records = [
            {"url": u or "urn:none", "ip": "0.0.0.0", "date": "20240101000000", "type": "text/html", "payload": h, "http": f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Page-Id: {i}\r\n\r\n".encode()}
            for i, u, h in zip(ids, urls, html, strict=True)
        ]
        name = f"pages-{ids[0]}-{k}.arc"
        yield pa.record_batch({"archive": [name], "data": pa.array([write_arc(records, 1 + k % 2, name)], pa.binary())})


_RECORD = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("ip", pa.string()), ("date", pa.string()), ("http", pa.binary()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("digest", pa.string())])


def _from_arc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, archives in slices(batches, text="data", limit=1):
        rows = []
        for r in parse_arc(archives[0]):
            http, payload = split_http(r["body"])
            page = http.split(b"X-Page-Id: ", 1)[1].split(b"\r\n", 1)[0].decode()
            f = r["fields"]
            rows.append({"page_id": None if page == "None" else int(page), "url": f["URL"], "ip": f["IP-address"], "date": f["Archive-date"], "http": http, "payload": payload, "payload_bytes": len(payload), "digest": b32sha1(payload)})
        yield pa.RecordBatch.from_pylist(rows, schema=_RECORD)


def _to_warc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, _ in slices(batches, text="payload", limit=ARCHIVE_BYTES):
        blob = b"".join(warc_record(r) for r in part.to_pylist())
        yield pa.record_batch({"data": pa.array([blob], pa.binary())})


_READ = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("warc_record_id", pa.string()), ("warc_date", pa.string())])


def _from_warc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, archives in slices(batches, text="data", limit=1):
        rows = []
        for head, block in parse_warc(archives[0]):
            http, payload = split_http(block)
            page = http.split(b"X-Page-Id: ", 1)[1].split(b"\r\n", 1)[0].decode()
            size, digest, kind = int(head["X-Payload-Length"]), head["WARC-Payload-Digest"].removeprefix("sha1:"), head["WARC-Type"]
            if kind == "response":
                size, digest = len(payload), b32sha1(payload)
            refers = head.get("X-Refers-To-Page")
            rows.append({"page_id": None if page == "None" else int(page), "payload_bytes": size, "payload_digest": digest, "record_type": kind, "refers_to": int(refers) if refers else None, "warc_record_id": head["WARC-Record-ID"], "warc_date": head["WARC-Date"]})
        yield pa.RecordBatch.from_pylist(rows, schema=_READ)


def pages_to_arc(pages: DataFrame) -> DataFrame:
    """``pages(page_id, url, html)`` as ARC files of alternating versions: rows (archive, data)."""
    return pages.selectExpr("cast(page_id as long) page_id", "url", "html").mapInArrow(_to_arc, "archive string, data binary")


def read_arc(archives: DataFrame) -> DataFrame:
    return archives.select("data").mapInArrow(_from_arc, "page_id long, url string, ip string, date string, http binary, payload binary, payload_bytes long, digest string")


def mark_revisits(records: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Add ``refers_to``, ``refers_url``, ``refers_date``: the page with the smallest id and the same payload, where that is another."""
    able = records.where((F.col("payload_bytes") >= min_bytes) & F.col("page_id").isNotNull())
    first = able.groupBy("digest").agg(F.min(F.struct("page_id", "url", "date")).alias("first"))
    out = records.join(first, "digest", "left")
    other = F.col("first").isNotNull() & ~F.col("first.page_id").eqNullSafe(F.col("page_id"))
    return out.select(
        *records.columns, F.when(other, F.col("first.page_id")).alias("refers_to"),
        F.when(other, F.col("first.url")).alias("refers_url"), F.when(other, F.col("first.date")).alias("refers_date"),
    )


def write_warc(records: DataFrame) -> DataFrame:
    return records.select("page_id", "url", "ip", "date", "http", "payload", "payload_bytes", "digest", "refers_to", "refers_url", "refers_date").mapInArrow(_to_warc, "data binary")


def read_warc(archives: DataFrame) -> DataFrame:
    return archives.select("data").mapInArrow(_from_warc, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, warc_record_id string, warc_date string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read_arc(pages_to_arc(table(spark, sf_dir, "pages")))
    archives = write_scratch(write_warc(mark_revisits(records)), "warc")
    return read_warc(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: Base32 of a SHA-1 has no DuckDB function; it is spelled out from the hex digest, five bits a character.
ORACLE_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h FROM pages),
b AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first_id,
  array_to_string(list_transform(range(0, 8), lambda g: array_to_string(list_transform(range(0, 4), lambda j:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(h, 1 + 5 * g, 5) AS BIGINT) >> (15 - 5 * j)) & 31 AS INTEGER), 1)), '')), '') AS d FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
  CASE WHEN first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first_id = page_id THEN NULL ELSE first_id END AS refers_to
FROM b
"""
