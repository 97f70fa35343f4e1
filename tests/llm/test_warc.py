from __future__ import annotations

import base64
import hashlib
import io
import os
import zipfile

import duckdb
import pytest
from oracle_check import compare

from tempora.llm import warc
from tempora.llm.oracle import ORACLE
from tempora.llm.zip_ranges import END, PackageError, directory, in_memory, of_file, pack, stored_at, whole
from tempora.session import scratch_path

PAGES = "page_id long, url string, html string"
ROWS = [
    (1, "http://a.example.com/x y?q=1#f", "<p>éin</p>"), (2, "http://b.example.com/", "<p>éin</p>"), (3, None, None), (4, "http://c/", ""),
    (5, "x", "<p>long</p>" * 20000), (None, "http://d/", "<p>éin</p>"), (None, None, "only nulls"), (None, None, "only nulls"),
    (7, "http://e/", "twice"), (7, "http://e/", "twice"), (7, "http://f/", "twice"), (7, "http://f/", "other"), (8, "a\r\nWARC-Type: x", "\r\n\r\nWARC/1.1"),
]


def b32(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def plain(rows, least=0):
    """Per group of equal payloads, the last row by (page id, url) responds."""
    order = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")
    groups, out = {}, []
    for r in rows:
        groups.setdefault((r[2] or "").encode(), []).append(r)
    for body, members in groups.items():
        members.sort(key=order)
        for k, r in enumerate(members):
            first = k == len(members) - 1 or len(body) < least
            out.append((r[0], len(body), b32(body), "response" if first else "revisit", None if first else members[-1][0]))
    return sorted(out, key=str)


def result(df):
    rows = df.select(warc.page_of("record_id").alias("p"), "payload_bytes", "payload_digest", "record_type", warc.page_of("refers_to").alias("t")).collect()
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("least,size", [(0, 32 << 20), (0, 1), (6, 700), (1 << 40, 4096)])
def test_round_trip(spark, least, size):
    path = scratch_path(spark, "test-warc")
    pages = spark.createDataFrame(ROWS, PAGES).selectExpr("*", "1 AS digest", "2 AS n", "'x' AS payload", "3 AS top").repartition(3)
    warc.write_archives(pages, path, least, size)
    back = warc.read_archives(spark, path)
    assert result(back) == plain(ROWS, least)
    bodies = {r.payload_digest: bytes(r.payload) for r in back.where("record_type = 'response'").collect()}
    assert bodies == {b32(b): b for b in {(r[2] or "").encode() for r in ROWS}}
    assert back.where("record_type = 'revisit' AND payload IS NOT NULL").count() == 0
    ids = [r.record_id for r in back.collect()]
    assert len(set(ids)) == len(ids)
    assert {r.refers_to for r in back.where("refers_to IS NOT NULL").collect()} <= set(ids)
    assert warc.read_archives(spark, path, payloads=False).where("payload IS NOT NULL").count() == 0


def test_empty_table(spark):
    path = scratch_path(spark, "test-warc-none")
    warc.write_archives(spark.createDataFrame([], PAGES), path)
    assert warc.read_archives(spark, path).count() == 0


def test_query_equals_sql_with_copies(spark, tmp_path):
    spark.createDataFrame(ROWS, PAGES).write.parquet(f"{tmp_path}/pages.parquet")
    from tempora.llm.queries import op12_warc

    con = duckdb.connect()
    con.register("pages", spark.read.parquet(f"{tmp_path}/pages.parquet").toPandas())
    ok, why = compare(op12_warc(spark, str(tmp_path)).toPandas(), con.execute(ORACLE["op12_warc"]).fetchdf())
    assert ok, why


def records_of(content):
    return [(r.kind, r.headers.get("warc-target-uri"), r.http()[1]) for _, _, r in warc.package_records(*in_memory(content))]


def archive(n, level=1):
    parts = [warc.write_record([("WARC-Type", "response"), ("WARC-Target-URI", f"http://h/{i}")], b"HTTP/1.1 200 OK\r\n\r\n" + b"x" * i * 1000, level)
             for i in range(n)]
    return parts, [("response", f"http://h/{i}", b"x" * i * 1000) for i in range(n)]


@pytest.mark.parametrize("zip64", [False, True])
def test_packages_are_zip_files(zip64):
    members = [("archive/ä.bin", os.urandom(1000)), ("b", b""), ("c/d", b"text" * 100)]
    content = pack(members, b"\n", zip64)
    with zipfile.ZipFile(io.BytesIO(content)) as z:  # the library agrees
        assert z.testzip() is None and [(n, z.read(n)) for n in z.namelist()] == members
    for before in (b"", b"#!/bin/sh\n" * 7):  # bytes before the package shift every place
        read, size = in_memory(before + content)
        found = directory(read, size)
        assert [(n, whole(read, m)) for n, m in found.items()] == members
        assert all(read(stored_at(read, m), m.size) == body for m, (_, body) in zip(found.values(), members))


def test_packages_of_others():
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        with z.open("big", "w", force_zip64=True) as f:  # ZIP64 fields in the local header only
            f.write(b"abc" * 1000)
        z.writestr("packed", b"index" * 500, zipfile.ZIP_DEFLATED)
        z.comment = END + b" a comment that looks like an end record " + bytes(40)
    read, size = in_memory(buffer.getvalue())
    found = directory(read, size)
    assert whole(read, found["packed"]) == b"index" * 500
    assert read(stored_at(read, found["big"]), 3000) == b"abc" * 1000
    with pytest.raises(PackageError):
        stored_at(read, found["packed"])
    for bad in (b"", b"PK", os.urandom(500), buffer.getvalue()[:-90], pack([("a", b"x")])[5:][:60]):
        with pytest.raises(PackageError):
            directory(*in_memory(bad))
    spoilt = bytearray(pack([("a", b"x" * 50)], zip64=False))
    spoilt[40] ^= 1
    with pytest.raises(PackageError):
        whole(in_memory(bytes(spoilt))[0], directory(*in_memory(bytes(spoilt)))["a"])


def test_archives_without_an_index_are_walked(monkeypatch):
    parts, want = archive(6)
    assert records_of(pack([(warc.ARCHIVE, b"".join(parts))])) == want
    step = warc._walk
    monkeypatch.setattr(warc, "_walk", lambda read, members: step(read, members, 64))  # records longer than a read
    assert records_of(pack([(warc.ARCHIVE, b"".join(parts))])) == want
    plain_records = [warc.VERSION + b"\r\nWARC-Type: response\r\nContent-Length: 21\r\n\r\nHTTP/1.1 200 OK\r\n\r\nab\r\n\r\n"] * 2
    assert records_of(pack([("archive/data.warc", b"".join(plain_records))])) == [("response", None, b"ab")] * 2


def test_one_record_is_read_by_ranges(spark, tmp_path):
    rows = [(i, f"http://h/{i}", os.urandom(30000).hex()) for i in range(40)]
    path = scratch_path(spark, "test-warc-ranges")
    warc.write_archives(spark.createDataFrame(rows, PAGES).coalesce(1), path)
    files = [r.path for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path").collect()]
    got, read_bytes, total = 0, 0, 0
    for f in files:
        fd = os.open(f.removeprefix("file:"), os.O_RDONLY)
        ranges, size = of_file(fd)

        def counted(offset, n):
            nonlocal read_bytes
            data = ranges(offset, n)
            read_bytes += len(data)
            return data

        first = []
        for _, _, record in warc.package_records(counted, size, lambda offset, length: not first and not first.append(1)):
            got += len(warc.described(record)["payload"]) > 0
        total += size
        os.close(fd)
    assert got == len(files) and total > 500_000 and read_bytes < total / 2


def test_damage_is_noticed():
    row = {"page_id": 1, "url": "u", "digest": hashlib.sha1(b"body").hexdigest(), "n": 4, "payload": b"body", "shared": True, "refers_to": None, "refers_url": None}
    good = warc.parse_record(warc._unzip(warc._page_record(row, "0-0", "d")[0])[0])
    assert warc.described(good)["payload"] == b"body"
    for bad in (row | {"payload": b"bodx"}, row | {"payload": b"bod"}):
        with pytest.raises(PackageError):
            warc.described(warc.parse_record(warc._unzip(warc._page_record(bad, "0-0", "d")[0])[0]))
    with pytest.raises(PackageError):
        warc._unzip(warc._page_record(row, "0-0", "d")[0][:-9])


def test_index_keys():
    assert warc.index_key("HTTP://www.Example.com:80/A?b") == "com,example,www)/a?b"
    assert warc.index_key(None) == "-" and warc.index_key("") == "-" and warc.index_key("a b") == "a%20b"
