"""WARC records in ZIP packages: written by Spark, read back by ranges without extraction.

A package holds ``archive/data.warc.gz`` (a gzip member per record, the whole
stored, so a record is a range) and ``indexes/index.cdxj`` (a line per record
with its range). The reader finds both in the central or ZIP64 directory,
reads the index, and then each record's range; a package without an index is
walked from record to record. Digests are checked on reading.

Spark does the rest. One aggregate per payload digest keeps one payload of each
group and its largest page, copies collapse before the shuffle, and the other
pages of the group become revisits without ever carrying their payload. A task
fills packages up to ``package_bytes``; Spark's file writer stores each as one
file (a row per file) on whatever store the path names, with its commit for
lost executors, and the binary file source reads them.

Defined results. Null html is an empty payload. Null page ids count as smaller
than any other and come back null, null urls as no target address. Rows that
are wholly equal are one response and revisits to it; equal payloads under the
same id and different urls too (the last url by code point responds). Empty
tables give no records. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.llm.common import map_arrow
from tempora.llm.zip_ranges import PackageError, Ranges, directory, in_memory, pack, stored_at, whole

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
# Fixed values of the WARC format.
VERSION, CRLF = b"WARC/1.1", b"\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = ("package string, offset long, length long, record_type string, record_id string, target_uri string, refers_to string, "
           "payload_bytes long, payload_digest string, payload binary")
ROW_END = b"\n"  # what the file writer puts after a row: the package's comment


# -- one record ------------------------------------------------------------------

@dataclass(frozen=True)
class Record:
    headers: dict[str, str]
    block: bytes

    @property
    def kind(self) -> str:
        return self.headers.get("warc-type", "")

    def http(self) -> tuple[dict[str, str], bytes]:
        """(headers, body) of the HTTP message in the block."""
        head, _, body = self.block.partition(CRLF + CRLF)
        return _fields(head.split(CRLF)[1:]), body


def _fields(lines: Iterable[bytes]) -> dict[str, str]:
    return {k.strip().lower().decode(): v.strip().decode() for k, _, v in (line.partition(b":") for line in lines)}


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def write_record(headers: list[tuple[str, str | None]], block: bytes, level: int = 1) -> bytes:
    """A record as a gzip member; headers without a value are left out."""
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in [*headers, ("Content-Length", str(len(block)))] if v is not None)]
    packer = zlib.compressobj(level, zlib.DEFLATED, 16 + zlib.MAX_WBITS)
    return packer.compress(CRLF.join(lines) + CRLF * 2 + block + CRLF * 2) + packer.flush()


def parse_record(raw: bytes) -> Record:
    head, mark, rest = raw.partition(CRLF + CRLF)
    lines = head.split(CRLF)
    if not mark or not lines[0].startswith(b"WARC/"):
        raise PackageError("no WARC record here")
    headers = _fields(lines[1:])
    n = int(headers["content-length"])
    if len(rest) < n:
        raise PackageError("record ends early")
    return Record(headers, rest[:n])


def _unzip(raw: bytes) -> tuple[bytes, int]:
    """(content, length of the first gzip member); uncompressed records come as they are."""
    if raw[:2] != b"\x1f\x8b":
        head, _, _ = raw.partition(CRLF + CRLF)
        n = len(head) + 8 + int(_fields(head.split(CRLF)[1:])["content-length"])
        return raw[:n], n
    one = zlib.decompressobj(16 + zlib.MAX_WBITS)
    content = one.decompress(raw)
    if not one.eof:
        raise PackageError("record ends early")
    return content, len(raw) - len(one.unused_data)


def _address(url: str | None) -> str | None:
    """A url fit for a header line: blanks and controls as percent escapes."""
    return None if url is None else quote(url, safe="".join(chr(c) for c in range(33, 127)))


def index_key(url: str | None) -> str:
    """Host labels turned round, then the path, lower-cased: the order of the index."""
    if url is None or "://" not in url:
        return "-" if not url else _address(url.lower())
    host, slash, path = _address(url.lower()).split("://", 1)[1].partition("/")
    return ",".join(reversed(host.split(":")[0].split("."))) + ")" + slash + path


# -- packages ----------------------------------------------------------------------

def _http(n: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()


def _page_record(row: dict, serial: str, date: str) -> tuple[bytes, dict]:
    """One page as (gzip member, index entry)."""
    digest = base64.b32encode(bytes.fromhex(row["digest"])).decode()
    name = lambda page, more="": f"<urn:page:{'' if page is None else page}:{digest}{more}>"
    revisit = row["payload"] is None
    alone = revisit or not row["shared"]  # a response that revisits refer to is named by page and digest only
    block = _http(row["n"]) + (b"" if revisit else row["payload"])
    headers = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", name(row["page_id"], f":{serial}" if alone else "")),
               ("WARC-Date", date), ("WARC-Target-URI", _address(row["url"])), ("WARC-Payload-Digest", f"sha1:{digest}"),
               ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}")]
    if revisit:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", name(row["refers_to"])), ("WARC-Refers-To-Target-URI", _address(row["refers_url"]))]
    headers.append(("Content-Type", "application/http;msgtype=response"))
    entry = {"url": _address(row["url"]), "mime": "warc/revisit" if revisit else "text/html", "status": "200", "digest": f"sha1:{digest}"}
    return write_record(headers, block), entry


def make_packages(batches: Iterable[pa.RecordBatch], package_bytes: int, part: int, date: str, zip64: bool = True) -> Iterator[bytes]:
    """Fill packages: a new one begins when the archive has reached ``package_bytes`` (one record may be larger)."""
    archive, index, serial = bytearray(), [], 0
    info = write_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:pages:{part}>"), ("WARC-Date", date),
                         ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")

    def close() -> bytes:
        lines = sorted(f"{key} {stamp} {json.dumps(entry)}\n" for key, stamp, entry in index)
        return pack([(ARCHIVE, bytes(archive)), (INDEX, "".join(lines).encode())], ROW_END, zip64)

    stamp = "".join(c for c in date if c.isdigit())
    for batch in batches:
        for i in range(batch.num_rows):
            row = {k: batch.column(k)[i].as_py() for k in batch.schema.names}
            if not index:
                archive += info
            record, entry = _page_record(row, f"{part}-{serial}", date)
            serial += 1
            index.append((index_key(row["url"]), stamp, entry | {"filename": "data.warc.gz", "offset": str(len(archive)), "length": str(len(record))}))
            archive += record
            if len(archive) >= package_bytes:
                yield close()
                archive, index = bytearray(), []
    if index:
        yield close()


def _ranges(read: Ranges, members: dict) -> Iterator[tuple[int, int]]:
    """(offset in the package, length) of every indexed record."""
    base = {}
    for name in [m for m in members if m.startswith("indexes/") and m.endswith((".cdxj", ".cdx"))]:
        for line in whole(read, members[name]).decode().splitlines():
            if "{" not in line:
                continue  # a header or an empty line
            entry = json.loads(line[line.index("{"):])
            file = entry["filename"]
            if file not in base:
                base[file] = stored_at(read, members[f"archive/{file}"])
            yield base[file] + int(entry["offset"]), int(entry["length"])


def _walk(read: Ranges, members: dict, step: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """The same for archives without an index, from record to record."""
    for name in [m for m in members if m.startswith("archive/")]:
        at = stored_at(read, members[name])
        end = at + members[name].size
        while at < end:
            want, n = step, 0
            while True:
                raw = read(at, min(want, end - at))
                try:
                    content, n = _unzip(raw)
                    parse_record(content)
                    break
                except (PackageError, KeyError, ValueError):
                    if at + want >= end:
                        raise
                    want *= 4  # the record is longer than what was read
            yield at, n
            at += n


def package_records(read: Ranges, size: int, wanted: Callable[[int, int], bool] | None = None) -> Iterator[tuple[int, int, Record]]:
    """(offset, length, record) of a package's records, each read by its own range."""
    members = directory(read, size)
    indexed = any(m.startswith("indexes/") for m in members)
    for offset, length in (_ranges if indexed else _walk)(read, members):
        if wanted is None or wanted(offset, length):
            raw = read(offset, length)
            if len(raw) != length:
                raise PackageError("index points beyond the package")
            yield offset, length, parse_record(_unzip(raw)[0])


def described(record: Record) -> dict:
    """What a record says of its page; a payload that does not have the stated digest or length is an error."""
    http, body = record.http()
    n, digest = http.get("content-length"), record.headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
    n = None if n is None else int(n)
    if record.kind == "response":
        own = base32_sha1(body)
        if n not in (None, len(body)) or digest not in (None, own):
            raise PackageError(f"damaged payload in {record.headers.get('warc-record-id')}")
        n, digest = len(body), own
    return {"record_type": record.kind, "record_id": record.headers.get("warc-record-id"), "target_uri": record.headers.get("warc-target-uri"),
            "refers_to": record.headers.get("warc-refers-to"), "payload_bytes": n, "payload_digest": digest,
            "payload": body if record.kind == "response" else None}


# -- Spark -------------------------------------------------------------------------------

def page_records(pages: DataFrame, min_bytes: int) -> DataFrame:
    """The records to write: responses with their payload, revisits without.

    Columns page_id, url, digest (hex), n, payload (null: revisit), shared
    (revisits may refer to it), refers_to, refers_url.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    p = pages.select("page_id", "url", payload.alias("payload"))
    p = p.withColumns({"digest": F.sha1("payload"), "n": F.octet_length("payload").cast("long")})
    none = {"refers_to": F.lit(None).cast("long"), "refers_url": F.lit(None).cast("string")}
    order = ["page_id", "url", "digest", "n", "payload", "shared", "refers_to", "refers_url"]
    large = p.where(F.col("n") >= min_bytes)
    same = ["digest", "n"]
    newest = F.max(F.struct("page_id", "url"))
    # one payload per group leaves a map task, however many copies it read
    responses = large.groupBy(*same).agg(newest.alias("top"), F.first("payload").alias("payload")).select(
        "top.page_id", "top.url", *same, "payload", F.lit(True).alias("shared")).withColumns(none)
    keys = large.groupBy(*same, "page_id", "url").agg(F.count(F.lit(1)).alias("copies"))
    groups = keys.groupBy(*same).agg(newest.alias("top"), F.sum("copies").alias("all")).where(F.col("all") > 1)
    is_top = F.col("page_id").eqNullSafe(F.col("top.page_id")) & F.col("url").eqNullSafe(F.col("top.url"))
    others = keys.join(groups, same).withColumn("again", F.col("copies") - F.when(is_top, 1).otherwise(0)).where(F.col("again") > 0)
    revisits = others.select("page_id", "url", *same, F.lit(None).cast("binary").alias("payload"), F.lit(False).alias("shared"),
                             F.col("top.page_id").alias("refers_to"), F.col("top.url").alias("refers_url"),
                             F.explode(F.sequence(F.lit(1).cast("long"), "again")).alias("_copy"))
    small = p.where(F.col("n") < min_bytes).withColumns(none | {"shared": F.lit(False)})
    return responses.select(*order).unionByName(revisits.select(*order)).unionByName(small.select(*order))


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, package_bytes: int = 32 << 20, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write a record per page as packages under ``path``.

    Of the records with equal payloads of ``min_bytes`` or more, that with the
    largest page id is a response and the others revisit it.
    """

    def packages(batches):
        for package in make_packages(batches, package_bytes, TaskContext.get().partitionId(), date):
            yield pa.RecordBatch.from_arrays([pa.array([package.removesuffix(ROW_END)], pa.binary())], names=["package"])

    made = map_arrow(page_records(pages, min_bytes), packages, "package binary")
    made.select(F.col("package").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(path)


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of all packages under ``path``: columns as in ``RECORDS`` (``payloads=False`` leaves those null)."""

    def records(batches):
        names = [f.split()[0] for f in RECORDS.split(", ")]
        for batch in batches:
            for where, content in zip(batch.column("path"), batch.column("content")):
                rows, held = [], 0
                for offset, length, record in package_records(*in_memory(content.as_buffer())):
                    if record.kind not in ("response", "revisit"):
                        continue
                    row = described(record) | {"package": where.as_py(), "offset": offset, "length": length}
                    if not payloads:
                        row["payload"] = None
                    rows.append(row)
                    held += len(row["payload"] or b"") + 512
                    if held > 16 << 20:
                        yield _batch(rows, names)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows, names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return map_arrow(files, records, RECORDS)


def _batch(rows: list[dict], names: list[str]) -> pa.RecordBatch:
    types = {"offset": pa.int64(), "length": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], types.get(n, pa.string())) for n in names], names=names)


def page_of(record_id: str) -> Column:
    """The page id in a record's name (null if the page had none)."""
    found = F.regexp_extract(record_id, r"^<urn:page:(-?[0-9]*):", 1)
    return F.when(found != "", found).cast("long")
