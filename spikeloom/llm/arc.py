"""Legacy ARC archives to WARC.

An ARC file begins with a version block, `filedesc://...`, whose second line names the version. Version 1 records have the
header line `URL IP-address Archive-date Content-type Archive-length`, version 2 adds result code, checksum, location,
offset and filename before the length. A record's body is what its declared length says, whatever it holds. The converter
walks these lines and lengths and makes WARC/1.1 records of them: version blocks become `warcinfo`, HTTP responses `response` and other
bodies `resource` records, with a record id derived from the content of the header line and the body, the timestamp in ISO
8601 and base32 SHA-1 digests of block and payload. Of records with equal payloads the one with the smallest page id is kept
whole, others are `revisit` records that refer to it by record id, URI and date, and carry no payload.

A WARC file is a row of gzip members, one for each record and a `warcinfo` record in front, of about FILE_BYTES. Tasks make them; Spark's
text writer puts the bytes as they are into the shared folder (with the zero byte that gzip allows as padding at the end), and its binary
reader takes them up again, a record at a time. Bodies are bytes throughout.

`convert` takes any table with ARC files in a column `content`, as Spark's binary reader makes it; a column `page_ids`, if there
is one, has the ids of each file's records in order. Null html is an empty payload, a null url is replaced by one made of the page
id. Rows that repeat page_id, url and html are numbered: one of them may be the response, the others revisit it under record ids of their own. Null page ids come last in the order of ids. Other
columns are ignored; an empty table gives no records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, portions, shared_folder

VERSIONS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
SHARD_BYTES = 4 << 20
FILE_BYTES = 8 << 20
MIN_BYTES = 0
_EPOCH = datetime(2001, 1, 1, tzinfo=timezone.utc)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def arc_record(version: int, url: str, ip: str, date: str, mime: str, body: bytes, offset: int = 0, filename: str = "-") -> bytes:
    """One ARC record with its closing line end."""
    more = f" 200 {base32_sha1(body)} - {offset} {filename}" if version == 2 else ""
    return f"{url} {ip} {date} {mime}{more} {len(body)}\n".encode() + body + b"\n"


def arc_head(version: int, filename: str) -> bytes:
    """The version block that begins an ARC file."""
    body = f"{version} 0 legacy\n{VERSIONS[version]}\n".encode()
    more = " 200 - - 0 -" if version == 2 else ""
    return f"filedesc://{filename} 0.0.0.0 20010101000000 text/plain{more} {len(body)}\n".encode() + body + b"\n"


def parse_arc(data: bytes) -> Iterator[dict]:
    """url, ip, date, mime, status, body of each record, version blocks included."""
    names, k = VERSIONS[1].split(), 0
    while k < len(data):
        end = data.find(b"\n", k)
        if end < 0:
            raise ValueError(f"no header line at byte {k}")
        line = data[k:end].decode("utf-8", "replace")
        k = end + 1
        if not line.strip():
            continue
        block = line.startswith("filedesc://")
        if block:  # its own line is of the version that the block names
            size = int(line.rsplit(" ", 1)[1])
            names = data[k : k + size].decode("utf-8", "replace").split("\n")[1].split()
        fields = line.rsplit(" ", len(names) - 1)  # an unescaped blank can only be in the url, which comes first
        if len(fields) != len(names) or not fields[-1].isdigit():
            raise ValueError(f"bad header line at byte {k}")
        own = dict(zip(names, fields, strict=True))
        size = int(own["Archive-length"])
        if k + size > len(data):
            raise ValueError(f"record at byte {k} is cut short")
        yield {"url": own["URL"], "ip": own["IP-address"], "date": own["Archive-date"], "mime": own["Content-type"], "status": own.get("Result-code"), "body": data[k : k + size], "version": block}
        k += size + (not block)


def http_payload(body: bytes) -> bytes:
    """What follows the header of an HTTP response, or all if there is none."""
    return body[body.find(b"\r\n\r\n") + 4 :] if body.startswith(b"HTTP/") and b"\r\n\r\n" in body else body


def _arcs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    version, ids, parts, size = 1, [], [], 0

    def flushed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([ids], pa.list_(pa.int64())), pa.array([b"".join(parts)], pa.binary())], names=["page_ids", "content"])

    for batch in portions(batches, "html"):
        for page_id, url, html in zip(batch["page_id"].to_pylist(), batch["url"].to_pylist(), batch["html"].to_pylist(), strict=True):
            if not parts:
                parts.append(arc_head(version, "legacy.arc"))
                size = len(parts[0])
            payload = (html or "").encode()
            body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
            date = (_EPOCH + timedelta(seconds=(page_id or 0) % 800_000_000)).strftime("%Y%m%d%H%M%S")
            clean = re.sub(r"\s", "%20", url) if url else f"urn:x-page:{page_id}"
            parts.append(arc_record(version, clean, "192.0.2.1", date, "text/html", body, size, "legacy.arc"))
            ids.append(page_id)
            size += len(parts[-1])
            if size >= SHARD_BYTES:
                yield flushed()
                version, ids, parts = 3 - version, [], []
    if parts:
        yield flushed()


def _pages(pages: DataFrame) -> DataFrame:
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")


def as_arc(pages: DataFrame) -> DataFrame:
    """(page_ids, content): ARC files of both versions in turn, of about SHARD_BYTES, and the ids of their records in order."""
    return _pages(pages).mapInArrow(_arcs, "page_ids array<long>, content binary")


RECORD = "page_id long, kind string, uri string, date string, ip string, mime string, record_id string, block binary, payload_bytes long, payload_digest string, block_digest string"


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, kinds = [x.split()[0] for x in RECORD.split(", ")], [pa.int64(), *[pa.string()] * 6, pa.binary(), pa.int64(), pa.string(), pa.string()]
    for batch in portions(batches, "content", 1):
        ids, out, size = iter(batch["page_ids"][0].as_py()) if "page_ids" in batch.schema.names else None, [], 0
        for r in parse_arc(batch["content"][0].as_py()):
            body, page_id = r["body"], None if r["version"] or ids is None else next(ids)
            kind = "warcinfo" if r["version"] else "response" if body.startswith(b"HTTP/") else "resource"
            payload = http_payload(body)
            when = datetime.strptime(r["date"][:14].ljust(14, "0"), "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")
            own = uuid.UUID(bytes=hashlib.sha1(f"{page_id} {r['url']} {r['date']} ".encode() + body).digest()[:16], version=5)
            out.append((page_id, kind, r["url"], when, r["ip"], r["mime"], f"<urn:uuid:{own}>", body, len(payload), base32_sha1(payload), base32_sha1(body)))
            size += len(body)
            if size > SHARD_BYTES // 4:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)


def convert(arcs: DataFrame) -> DataFrame:
    """A row for each record of the ARC files in `content`, with what its WARC record needs."""
    return arcs.select("content", *["page_ids"] * ("page_ids" in arcs.columns)).mapInArrow(_records, RECORD)


def warc_record(kind: str, fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    """A record as a gzip member; fields without a value are left out."""
    lines = [f"{name}: {value}\r\n" for name, value in [("WARC-Type", kind), *fields, ("Content-Length", str(len(block)))] if value is not None]
    return gzip.compress(f"WARC/1.1\r\n{''.join(lines)}\r\n".encode() + block + b"\r\n\r\n", 5, mtime=0)


def _file_head(members: list[bytes]) -> bytes:
    own = uuid.UUID(bytes=hashlib.sha1(b"".join(members)).digest()[:16], version=5)
    return warc_record("warcinfo", [("WARC-Record-ID", f"<urn:uuid:{own}>"), ("WARC-Date", _EPOCH.strftime("%Y-%m-%dT%H:%M:%SZ")), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\ndescription: converted from ARC\r\n")


def write_warc(records: DataFrame, folder: str) -> None:
    """Writes the records as WARC files; copies of a payload become revisits of the one with the smallest page id."""
    heads = cut(records.where("kind <> 'warcinfo'").select("payload_digest", "payload_bytes", "page_id", "record_id", "uri", "date"))  # no bodies
    order = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", F.col("record_id").alias("first"), F.col("uri").alias("first_uri"), F.col("date").alias("first_date"))
    first = heads.where(F.col("payload_bytes") >= MIN_BYTES).groupBy("payload_digest", "payload_bytes").agg(F.min(order).alias("f"), F.count("*").alias("n"))
    first = first.where("n > 1").select("payload_digest", "payload_bytes", F.col("f.page_id").alias("first_page"), "f.first", "f.first_uri", "f.first_date")
    same = heads.join(first, ["payload_digest", "payload_bytes"]).groupBy("record_id").agg(*[F.first(c).alias(c) for c in ("first_page", "first", "first_uri", "first_date")], F.count("*").alias("copies"))
    same = cut(same)
    known = records.join(same, "record_id", "left")  # ids are spread evenly, whatever payloads are
    kept = known.where("copies IS NULL OR copies = 1").withColumn("copy", F.lit(1))
    if not same.where("copies > 1").isEmpty():  # rows that repeat: one body, as often as it was there
        once = known.where("copies > 1").groupBy("record_id").agg(F.first(F.struct(*known.columns)).alias("x"))
        kept = kept.unionByName(once.select("x.*", F.explode(F.sequence(F.lit(1), F.col("x.copies").cast("int"))).alias("copy")))
    slim = kept.withColumn("again", F.coalesce((F.col("kind") != "warcinfo") & ((F.col("first") != F.col("record_id")) | (F.col("copy") > 1)), F.lit(False))).withColumn("block", F.when(~F.col("again"), F.col("block")))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members, size = [], 0

        def flushed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([b"".join([_file_head(members), *members])], pa.binary())], names=["file"])

        for batch in portions(batches, "block"):
            for r in batch.to_pylist():
                again, page, first_page = r["again"], r["page_id"], r["first_page"]
                members.append(warc_record("revisit" if again else r["kind"], [
                    ("WARC-Record-ID", r["record_id"] if r["copy"] == 1 else f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{r['record_id']} {r['copy']}')}>"), ("WARC-Date", r["date"]), ("WARC-Target-URI" if r["kind"] != "warcinfo" else "WARC-Filename", r["uri"]), ("WARC-IP-Address", r["ip"] if r["kind"] != "warcinfo" and r["ip"] != "-" else None),
                    ("WARC-Payload-Digest", f"sha1:{r['payload_digest']}"), ("WARC-Block-Digest", None if again else f"sha1:{r['block_digest']}"),
                    ("WARC-Refers-To", r["first"] if again else None), ("WARC-Refers-To-Target-URI", r["first_uri"] if again else None), ("WARC-Refers-To-Date", r["first_date"] if again else None),
                    ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if again else None),
                    ("X-Page-ID", None if page is None else str(page)), ("X-Payload-Length", str(r["payload_bytes"])), ("X-Refers-To-Page-ID", str(first_page) if again and first_page is not None else None),
                    ("Content-Type", "application/http;msgtype=response" if r["kind"] == "response" else r["mime"]),
                ], r["block"] or b""))
                size += len(members[-1])
                if size >= FILE_BYTES:
                    yield flushed()
                    members, size = [], 0
        if members:
            yield flushed()

    files = slim.mapInArrow(pack, "file binary").select(F.col("file").cast("string").alias("value"))  # the bytes as they are
    files.write.option("lineSep", "\0").option("maxRecordsPerFile", 1).text(folder)


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record of a file's gzip members, by declared lengths, a record in memory at a time."""
    with io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(data))) as stream:
        while line := stream.readline():
            if not line.startswith(b"WARC/1."):
                raise ValueError(f"no record begins with {line[:20]!r}")
            fields = {}
            while (line := stream.readline().rstrip(b"\r\n")):
                name, value = line.decode().split(": ", 1)
                fields[name] = value
            size = int(fields["Content-Length"])
            block = stream.read(size)
            if len(block) != size or stream.read(4) != b"\r\n\r\n":
                raise ValueError(f"{fields['WARC-Record-ID']}: the record isn't as long as it says")
            yield fields, block


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of each record with a payload of the files in `folder`.

    A payload's length and digest are taken from the bytes that are there and must agree with the header.
    """
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, "content", 1):
            out = []
            for fields, block in parse_warc(batch["content"][0].as_py()):
                if fields["WARC-Type"] == "warcinfo":
                    continue
                digest, size = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["X-Payload-Length"])
                if fields["WARC-Type"] != "revisit":
                    payload = http_payload(block)
                    if (len(payload), base32_sha1(payload)) != (size, digest):
                        raise ValueError(f"{fields['WARC-Record-ID']}: the payload isn't what its header says")
                page, first = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page-ID")
                out.append((page and int(page), size, digest, fields["WARC-Type"], first and int(first)))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(folder).select("content")
    return files.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archive(pages: DataFrame) -> DataFrame:
    """Lays the pages out as ARC files, converts them, writes WARC files to the shared folder and reads these back.

    A task converts the ARC files that it lays out, so that these are never held or shuffled by Spark.
    """
    spark = pages.sparkSession
    folder = shared_folder(spark, "warc")
    write_warc(_pages(pages).mapInArrow(lambda batches: _records(_arcs(batches)), RECORD), folder)
    return read_warc(spark, folder)
