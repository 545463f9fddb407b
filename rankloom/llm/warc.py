"""Legacy archive converter: ARC files to WARC files with revisit records, and readers of both.

An ARC file starts with a version block whose number says which fields a record's header line has
(five in version 1, ten in version 2); a record's last field declares its length.  The converter
parses these, synthesises WARC identifiers (from the ARC file and the record's number), ISO dates,
record types, and SHA-1 digests, and writes a revisit record for a payload that another record has.

All files lie in the shared folder, written by tasks under names of their own; a written
manifest lists those of the tasks that succeeded, so what a lost task left behind is never read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_path, materialize, ship, text_or_empty

#: Bytes before compression at which a task starts the next file.
FILE_BYTES = 128 << 20
#: Date of the records that op10 writes.
DATE = "20240101000000"
KEY_HEADER = "X-Record-Key"
FIELDS = {
    1: ("url", "ip", "date", "type", "length"),
    2: ("url", "ip", "date", "type", "status", "checksum", "location", "offset", "filename", "length"),
}
_TITLES = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


def _open(uri: str, mode: str) -> BinaryIO:
    system, path = fs.FileSystem.from_uri(uri)
    if mode == "r":
        return system.open_input_stream(path, compression=None)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(path, compression=None)


def _plain(raw: BinaryIO) -> BinaryIO:
    """A buffered stream of what raw holds, in gzip members or plain."""
    stream = raw if hasattr(raw, "peek") else io.BufferedReader(raw, 1 << 20)
    if stream.peek(2)[:2] == b"\x1f\x8b":
        return io.BufferedReader(gzip.GzipFile(fileobj=stream), 1 << 20)
    return stream


def _member(data: bytes) -> bytes:
    """One gzip member."""
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# --- ARC


@dataclass
class ArcRecord:
    fields: dict[str, str]
    block: bytes
    seq: int


def arc_version_block(version: int, name: str) -> bytes:
    body = f"{version} 0 rankloom\n{_TITLES[version]}\n\n".encode()
    own = {"url": f"filedesc://{name}", "ip": "0.0.0.0", "date": DATE, "type": "text/plain", "status": "200", "checksum": "-", "location": "-", "offset": "0", "filename": name, "length": str(len(body))}
    return " ".join(own[f] for f in FIELDS[version]).encode() + b"\n" + body


def arc_record(version: int, url: str, block: bytes, mime: str = "text/html", ip: str = "0.0.0.0", date: str = DATE, name: str = "-", offset: int = 0) -> bytes:
    own = {"url": re.sub(r"\s", lambda m: "".join(f"%{b:02X}" for b in m.group().encode()), url) or "-", "ip": ip, "date": date, "type": mime, "status": "200", "checksum": "-", "location": "-", "offset": str(offset), "filename": name, "length": str(len(block))}
    return " ".join(own[f] for f in FIELDS[version]).encode("utf-8", "surrogatepass") + b"\n" + block + b"\n"


def read_arc(raw: BinaryIO) -> Iterator[ArcRecord]:
    """Records of an ARC stream (gzip members or plain), the version block first, as number 0."""
    stream = _plain(raw)
    version, seq = None, 0
    while line := stream.readline():
        if not line.strip():
            continue
        parts = line.rstrip(b"\r\n").decode("utf-8", "surrogateescape").split(" ")
        try:
            length = int(parts[-1])
        except ValueError:
            raise ValueError(f"ARC header line without a length: {line[:80]!r}") from None
        block = stream.read(length)
        if len(block) != length:
            raise ValueError(f"ARC record {seq} declares {length} bytes and has {len(block)}")
        if version is None:
            if not parts[0].startswith("filedesc:"):
                raise ValueError("an ARC file starts with its version block")
            version = int(block.split(None, 1)[0])
            if version not in FIELDS:
                raise ValueError(f"ARC version {version} isn't known")
        names = FIELDS[version]
        extra = len(parts) - len(names)
        if extra < 0:
            raise ValueError(f"ARC header line has {len(parts)} fields, version {version} has {len(names)}")
        parts[: extra + 1] = [" ".join(parts[: extra + 1])]  # old writers left spaces in addresses
        yield ArcRecord(dict(zip(names, parts, strict=True)), block, seq)
        seq += 1


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """HTTP headers with their empty line, and the payload; no headers where the block isn't HTTP."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    ends = [(i + len(e), i) for e in (b"\r\n\r\n", b"\n\n") if (i := block.find(e)) >= 0]
    end = min(ends)[0] if ends else len(block)
    return block[:end], block[end:]


def http_header(head: bytes, name: str) -> str | None:
    for line in head.split(b"\n")[1:]:
        k, _, v = line.partition(b":")
        if k.strip().lower() == name.lower().encode():
            return v.strip().decode("utf-8", "replace")
    return None


# --- WARC


def iso_date(date: str) -> str:
    """An ARC date of 4 to 14 digits as a WARC date."""
    d = re.sub(r"\D", "", date)[:14]
    d = d + "00000101000000"[len(d) :] if len(d) >= 4 else "19960101000000"
    month, day = max(1, min(12, int(d[4:6]))), max(1, min(31, int(d[6:8])))
    return f"{d[:4]}-{month:02d}-{day:02d}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def record_id(file: str, seq: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{file.rsplit(chr(47), 1)[-1]}#{seq}')}>"


def warc_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    return b"WARC/1.0\r\n" + head.encode("utf-8", "surrogateescape") + b"\r\n" + block + b"\r\n\r\n"


def convert(rec: ArcRecord, file: str, refers: tuple[str, int, str, str] | None = None) -> bytes:
    """The WARC record of an ARC record; refers: file, number, address and date of the record with the same payload."""
    f, date = rec.fields, iso_date(rec.fields["date"])
    own = [("WARC-Record-ID", record_id(file, rec.seq)), ("WARC-Date", date)]
    if f["url"].startswith("filedesc:"):
        return warc_record([("WARC-Type", "warcinfo"), *own, ("WARC-Filename", f["url"][11:]), ("Content-Type", "application/warc-fields")], b"software: rankloom\r\nformat: WARC File Format 1.0\r\nconvertedFrom: ARC\r\n")
    head, payload = split_http(rec.block)
    kind = "response" if head else "resource"
    mime = "application/http; msgtype=response" if head else f.get("type") or "application/octet-stream"
    own += [("WARC-Target-URI", f["url"])]
    if f["ip"] not in ("0.0.0.0", "-", ""):
        own.append(("WARC-IP-Address", f["ip"]))
    own.append(("WARC-Payload-Digest", "sha1:" + base32_sha1(payload)))
    block = rec.block
    if refers:
        kind, block = "revisit", head
        own += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers[0], refers[1])), ("WARC-Refers-To-Target-URI", refers[2]), ("WARC-Refers-To-Date", iso_date(refers[3]))]
    own.append(("WARC-Block-Digest", "sha1:" + base32_sha1(block)))
    return warc_record([("WARC-Type", kind), *own, ("Content-Type", mime)], block)


@dataclass
class WarcRecord:
    headers: dict[str, str]
    block: bytes = field(repr=False)


def read_warc(raw: BinaryIO) -> Iterator[WarcRecord]:
    """Records of a WARC stream (gzip members or plain)."""
    stream = _plain(raw)
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record starts with {line[:40]!r}")
        headers = {}
        while (line := stream.readline()).strip():
            k, _, v = line.decode("utf-8", "surrogateescape").partition(":")
            headers[k.strip().lower()] = v.strip()
        n = int(headers["content-length"])
        block = stream.read(n)
        if len(block) != n:
            raise ValueError(f"WARC record declares {n} bytes and has {len(block)}")
        yield WarcRecord(headers, block)


# --- tables


class _Out:
    """A file of gzip members that a task writes, moved on to the next when it is large."""

    def __init__(self, folder: str, suffix: str):
        self.folder, self.suffix, self.file, self.size, self.n = folder, suffix, None, 0, 0

    def start(self) -> str:
        self.close()
        self.path = f"{self.folder}/{uuid.uuid4().hex}.{self.suffix}"
        self.file, self.size, self.n = _open(self.path, "w"), 0, 0
        return self.path

    def put(self, data: bytes) -> None:
        self.file.write(_member(data))
        self.size += len(data)
        self.n += 1

    def close(self) -> None:
        if self.file:
            self.file.close()
        self.file = None


def write_arc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", version: int = 1, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record per row into ARC files under folder; the manifest (file, records) is returned, written.

    Each record is an HTTP response whose header KEY_HEADER has the row's identifier (none if null).
    A null page is an empty payload, a null address "-".
    """
    ship(pages.sparkSession)
    given = pages.select(F.col(id_col).cast("string").alias("id"), text_or_empty(url_col).alias("url"), text_or_empty(html_col).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, done = _Out(folder, f"v{version}.arc.gz"), []
        for batch in batches:
            for i, url, page in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out.file is None or out.size >= file_bytes:
                    if out.file:
                        done.append((out.path, out.n - 1))
                    out.start()
                    out.put(arc_version_block(version, out.path.rsplit("/", 1)[-1]))
                payload = page.encode("utf-8", "surrogatepass")
                head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + (f"{KEY_HEADER}: {i}\r\n" if i is not None else "") + f"Content-Length: {len(payload)}\r\n\r\n"
                out.put(arc_record(version, url, head.encode() + payload, name=out.path.rsplit("/", 1)[-1], offset=out.size))
        if out.file:
            done.append((out.path, out.n - 1))
        out.close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done]), pa.array([d[1] for d in done], pa.int64())], ["file", "records"])

    return materialize(given.mapInArrow(run, "file string, records long"), "arc-manifest")


def _each_file(manifest: DataFrame) -> DataFrame:
    """A task for each file, up to 100,000 tasks."""
    return manifest.select("file").repartition(max(1, min(manifest.count(), 100_000)))


def arc_index(manifest: DataFrame) -> DataFrame:
    """file, seq, key, url, date, bytes, sha1, sha256 of every record but the version blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0).to_pylist():
                rows = []
                with _open(file, "r") as f:
                    for rec in read_arc(f):
                        if rec.seq:
                            head, payload = split_http(rec.block)
                            url = rec.fields["url"].encode("utf-8", "surrogateescape").decode("utf-8", "replace")
                            rows.append((file, rec.seq, http_header(head, KEY_HEADER), url, rec.fields["date"], len(payload), hashlib.sha256(payload).digest()))
                        if len(rows) >= 5000:
                            yield _rows(rows)
                            rows = []
                if rows:
                    yield _rows(rows)

    def _rows(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["file", "seq", "key", "url", "date", "bytes", "sha256"])

    return _each_file(manifest).mapInArrow(run, "file string, seq long, key string, url string, date string, bytes long, sha256 binary")


def convert_arc(manifest: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Convert the ARC files of a manifest to WARC files under folder; returns their manifest, written.

    Of records with equal payloads of at least least_bytes bytes the one with the smallest key (as a
    number where it is one; none last; then file and number) stays a response, others revisit it.
    """
    spark = manifest.sparkSession
    ship(spark)
    index = materialize(arc_index(manifest), "arc-index")
    number = F.col("key").try_cast("decimal(38,0)")
    rank = F.struct(F.col("key").isNull().alias("none"), number.isNull().alias("name"), number.alias("number"), F.col("key"), F.col("file"), F.col("seq"), F.col("url"), F.col("date"))
    first = index.filter(F.col("bytes") >= least_bytes).groupBy("sha256", "bytes").agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    firsts = first.select("sha256", "bytes", F.struct("first.file", "first.seq", "first.url", "first.date").alias("refers"))
    told = index.select("file", "seq", "sha256", "bytes").join(firsts, ["sha256", "bytes"], "left")
    own = (F.col("refers.file") == F.col("file")) & (F.col("refers.seq") == F.col("seq"))
    told = told.select("file", "seq", F.when(~own, F.col("refers")).alias("refers"))
    told = told.repartition(max(1, min(manifest.count(), 100_000)), "file").sortWithinPartitions("file", "seq")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, done = _Out(folder, "warc.gz"), []
        rows = (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        for file, own_rows in groupby(rows, key=lambda r: r[0]):
            out.start()
            with _open(file, "r") as f:
                for rec in read_arc(f):
                    if rec.seq:
                        _, seq, refers = next(own_rows)
                        if seq != rec.seq:
                            raise ValueError(f"{file}: record {rec.seq} isn't in the index")
                        out.put(convert(rec, file, (refers["file"], refers["seq"], refers["url"], refers["date"]) if refers else None))
                    else:
                        out.put(convert(rec, file))
            done.append((out.path, out.n - 1))
        out.close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done]), pa.array([d[1] for d in done], pa.int64())], ["file", "records"])

    return materialize(told.mapInArrow(run, "file string, records long"), "warc-manifest")


def warc_table(manifest: DataFrame) -> DataFrame:
    """record_id, key, url, record_type, payload_bytes, payload_digest, refers_id of each record but warcinfo, checked against its digests."""
    ship(manifest.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["record_id", "key", "url", "record_type", "payload_bytes", "payload_digest", "refers_id"]
        kinds = [pa.string()] * 4 + [pa.int64()] + [pa.string()] * 2
        for batch in batches:
            for file in batch.column(0).to_pylist():
                rows = []
                with _open(file, "r") as f:
                    for rec in read_warc(f):
                        h = rec.headers
                        if h["warc-type"] == "warcinfo":
                            continue
                        if h["warc-block-digest"] != "sha1:" + base32_sha1(rec.block):
                            raise ValueError(f"{file}: {h['warc-record-id']} doesn't have the bytes of its digest")
                        head, payload = split_http(rec.block)
                        digest = h["warc-payload-digest"].removeprefix("sha1:")
                        if h["warc-type"] == "revisit":
                            n = int(http_header(head, "Content-Length") or 0)
                        elif digest != base32_sha1(payload):
                            raise ValueError(f"{file}: {h['warc-record-id']} doesn't have the payload of its digest")
                        else:
                            n = len(payload)
                        url = h["warc-target-uri"].encode("utf-8", "surrogateescape").decode("utf-8", "replace")
                        rows.append((h["warc-record-id"], http_header(head, KEY_HEADER), url, h["warc-type"], n, digest, h.get("warc-refers-to")))
                        if len(rows) >= 5000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    schema = "record_id string, key string, url string, record_type string, payload_bytes long, payload_digest string, refers_id string"
    return _each_file(manifest).mapInArrow(run, schema)


def op10_warc(spark: SparkSession, sf_dir: str, version: int = 1) -> DataFrame:
    """Write all pages as ARC files, convert them to WARC files, and read those back.

    A null page is an empty payload; a null page_id comes back null and is a response only where no equal
    payload has an id; of rows that repeat an id and payload one is the response; an empty table
    gives no files and no rows; further columns are not read.
    """
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    arcs = write_arc(pages, fresh_path(spark, "arc"), version=version)
    warcs = convert_arc(arcs, fresh_path(spark, "warc"))
    rows = materialize(warc_table(warcs), "warc-table")
    kind = pages.schema["page_id"].dataType
    to = rows.filter("record_type = 'response'").select(F.col("record_id").alias("refers_id"), F.col("key").cast(kind).alias("refers_to"))
    back = rows.filter("record_type = 'revisit'").join(to, "refers_id", "left")
    own = rows.filter("record_type <> 'revisit'").withColumn("refers_to", F.lit(None).cast(kind))
    return back.unionByName(own).select(F.col("key").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


OP10_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
g AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS s, min(page_id) OVER (PARTITION BY h) AS first FROM p),
v AS (SELECT *, [CAST('0x' || substr(s, 5 * i + 1, 5) AS INTEGER) FOR i IN range(0, 8)] AS v FROM g)
SELECT page_id, payload_bytes,
       list_reduce([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (x >> 15) % 32 + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (x >> 10) % 32 + 1, 1)
         || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (x >> 5) % 32 + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', x % 32 + 1, 1) FOR x IN v], lambda a, b: a || b) AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM v
"""
