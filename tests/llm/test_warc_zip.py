"""WARC packages: round trips, and ZIP directories written by others."""

import hashlib
import base64
import io
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import SF_DIR, by_key, clashing
from tidegauge.llm import warc_zip as wz

PAGES = "page_id long, url string, html string"


def expected(rows):
    payloads = [(i, (h or "").encode()) for i, _, h in rows]
    first = {}
    for i, p in payloads:
        if i is not None:
            first[p] = min(i, first.get(p, i))
    out = []
    for i, p in payloads:
        refers = first.get(p) if first.get(p) != i else None
        digest = base64.b32encode(hashlib.sha1(p).digest()).decode()
        out.append((i, len(p), digest, "response" if refers is None else "revisit", refers))
    return out


def test_whole_table(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    assert by_key(wz.archive_round_trip(pages).collect()) == by_key(expected([tuple(r) for r in pages.collect()]))


def test_odd_rows_in_small_packages(spark):
    rows = [
        (1, "http://a.example/x?y=1 2", "same"), (0, None, "same"), (2, "http://[bad", None), (3, "", ""), (None, "http://b.example/\r\nX: y", "same"),
        (4, "http://é.example/ü", "body\r\n\r\nWARC/1.1\r\n"), (4, "http://é.example/ü", "body\r\n\r\nWARC/1.1\r\n"), (5, "x", "long " * 200_000),
        (None, None, None), (None, None, "only without id"), (-7, "http://a.example/", "ünï"),
    ]
    pages = spark.createDataFrame(rows, PAGES)
    for settings in ({}, {"package_bytes": 10}):
        got = wz.archive_round_trip(clashing(pages), **settings)
        assert by_key(got.collect()) == by_key(expected(rows))
    assert wz.archive_round_trip(spark.createDataFrame([], PAGES)).count() == 0


def test_payloads_come_back(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    back = wz.read_records(wz.read_index(wz.write_packages(pages)), payloads=True).where("record_type = 'response'")
    joined = back.join(pages.select(F.col("page_id"), "html"), "page_id").select(F.decode("payload", "UTF-8").alias("a"), "html")
    assert joined.count() > 0 and joined.where("a <> html").count() == 0


def members(data):
    source = io.BytesIO(data)
    return {m.name: data[wz.stored_at(source, m) :][: m.size] for m in wz.directory(source, len(data))}


def test_directories_of_other_writers():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as archive:
        with archive.open("big", "w", force_zip64=True) as file:
            file.write(b"b" * 1000)
        archive.writestr("small", b"PK\x05\x06 inside")
        archive.comment = b"a comment with PK\x05\x06 in it"
    assert members(out.getvalue()) == {"big": b"b" * 1000, "small": b"PK\x05\x06 inside"}


def test_zip64_directory():
    """Sizes, offsets, and counts that only the ZIP64 records tell."""
    name, body = b"archive/x", b"payload"
    local = struct.pack("<4sHHHHHIIIHH", b"PK\x03\x04", 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), 20) + name
    local += struct.pack("<HHQQ", 1, 16, len(body), len(body)) + body
    extra = struct.pack("<HHH", 0x5455, 2, 0) + struct.pack("<HHQQQ", 1, 24, len(body), len(body), 3)
    head = struct.pack("<4sHHHHHHIIIHHHHHII", b"PK\x01\x02", 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), len(extra), 0, 0, 0, 0, 0xFFFFFFFF)
    central = head + name + extra
    at = 3 + len(local)  # three bytes of something else come first
    end64 = struct.pack("<4sQHHIIQQQQ", b"PK\x06\x06", 44, 45, 45, 0, 0, 1, 1, len(central), at)
    locator = struct.pack("<4sIQI", b"PK\x06\x07", 0, at + len(central), 1)
    end = struct.pack("<4sHHHHIIH", b"PK\x05\x06", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    assert members(b"xyz" + local + central + end64 + locator + end) == {"archive/x": body}


def test_what_is_no_package():
    with pytest.raises(ValueError):
        wz.directory(io.BytesIO(b"nothing"), 7)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("x", b"x" * 100)
    with pytest.raises(ValueError):
        members(out.getvalue())
    broken = wz.record(1, None, b"abc", wz.base32_sha1(b"abd"), None, "2024-01-01T00:00:00Z")
    with pytest.raises(ValueError):
        wz.parse_record(broken)
