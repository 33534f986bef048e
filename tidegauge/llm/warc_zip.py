"""WARC records in ZIP packages, read by range without unpacking.

A package is a ZIP archive whose members are stored, not deflated: ``archive/data.warc.gz``
(every record a gzip member by itself), ``indexes/index.cdxj`` (a line per record with its
place) and ``datapackage.json``. A reader takes the central directory from the end of the
file, ZIP64 or not, finds the members, reads the index, and then only the bytes of the
records it wants. Repeated payloads are written as revisits of the first record.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import open_folder, pick, stage
from tidegauge.session import scratch_dir

#: Bytes of compressed records per package (a larger record has a package by itself), bytes read at a time.
PACKAGE_BYTES, READ_BYTES = 32 << 20, 4 << 20
ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Signatures and fields of the ZIP records read here; fixed values.
END, END64, LOCATOR64, CENTRAL, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- ZIP directories -------------------------------------------------------------------


@dataclass(frozen=True)
class Member:
    """A member as the central directory tells of it."""

    name: str
    method: int
    size: int
    compressed: int
    header: int


def _read(source, at: int, n: int) -> bytes:
    source.seek(at)
    return source.read(n)


def _wide(extra: bytes, values: list[int]) -> list[int]:
    """Replace 32-bit placeholders, in order, by the values of the ZIP64 extra field."""
    at = 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            place, out = at + 4, []
            for value in values:
                if value == 0xFFFFFFFF:
                    (value,) = struct.unpack_from("<Q", extra, place)
                    place += 8
                out.append(value)
            return out
        at += 4 + size
    return values


def directory(source, size: int) -> list[Member]:
    """The members of the archive in an open file of ``size`` bytes, from its central directory alone."""
    tail_at = max(0, size - (1 << 16) - 22)
    tail = _read(source, tail_at, size - tail_at)
    at = tail.rfind(END)
    while at >= 0:  # the signature may also stand in a comment
        if at + 22 <= len(tail) and struct.unpack_from("<H", tail, at + 20)[0] == len(tail) - at - 22:
            break
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise ValueError("not a ZIP archive")
    entries, length, start = struct.unpack_from("<HII", tail, at + 10)
    if entries == 0xFFFF or 0xFFFFFFFF in (length, start):
        locator = _read(source, tail_at + at - 20, 20)
        if locator[:4] != LOCATOR64:
            raise ValueError("no ZIP64 locator where one is needed")
        end = _read(source, struct.unpack_from("<Q", locator, 8)[0], 56)
        if end[:4] != END64:
            raise ValueError("no ZIP64 end record where the locator points")
        entries, length, start = struct.unpack_from("<QQQ", end, 32)
    data, place, members = _read(source, start, length), 0, []
    for _ in range(entries):
        if data[place : place + 4] != CENTRAL:
            raise ValueError("broken central directory")
        method = struct.unpack_from("<H", data, place + 10)[0]
        compressed, whole, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", data, place + 20)
        (header,) = struct.unpack_from("<I", data, place + 42)
        name_at = place + 46
        extra = data[name_at + n_name : name_at + n_name + n_extra]
        whole, compressed, header = _wide(extra, [whole, compressed, header])
        members.append(Member(data[name_at : name_at + n_name].decode(), method, whole, compressed, header))
        place = name_at + n_name + n_extra + n_comment
    return members


def stored_at(source, member: Member) -> int:
    """Where the bytes of a stored member begin in the file."""
    if member.method != 0:
        raise ValueError(f"{member.name} is compressed")
    head = _read(source, member.header, 30)
    if head[:4] != LOCAL:
        raise ValueError(f"no local header of {member.name}")
    n_name, n_extra = struct.unpack_from("<HH", head, 26)
    return member.header + 30 + n_name + n_extra


# --- records ---------------------------------------------------------------------------


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One record, not compressed. With ``refers_to`` a revisit, which has the HTTP head but no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{'null' if page_id is None else page_id}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", quote(url, safe="%/:?#[]@!$&'()*+,;=~") if url else None),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Profile", None if refers_to is None else PROFILE),
        ("WARC-Refers-To", None if refers_to is None else f"<urn:page:{refers_to}>"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return f"WARC/1.1\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """The fields of an uncompressed record; the digest of a response is computed from its payload."""
    head, rest = data.split(b"\r\n\r\n", 1)
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/1."):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines)}
    block = rest[: int(fields["content-length"])]
    http, payload = block.split(b"\r\n\r\n", 1)
    declared = fields["warc-payload-digest"].removeprefix("sha1:")
    kind = fields["warc-type"]
    length = next(int(h.split(b":")[1]) for h in http.split(b"\r\n") if h.lower().startswith(b"content-length:"))
    if kind == "response" and (base32_sha1(payload) != declared or len(payload) != length):
        raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
    return {
        "page_id": _page(fields["warc-record-id"]),
        "payload_bytes": length,
        "payload_digest": declared,
        "record_type": kind,
        "refers_to": _page(fields.get("warc-refers-to")),
        "url": fields.get("warc-target-uri"),
        "payload": payload if kind == "response" else None,
    }


def _page(urn: str | None) -> int | None:
    name = (urn or "null").strip("<>").rpartition(":")[2]
    return None if name == "null" else int(name)


def index_key(url: str | None) -> str:
    """The host with its labels reversed, then the path, as CDX files sort them."""
    try:
        parts = urlsplit(url or "")
    except ValueError:
        return "-"
    path = quote(parts.path + (f"?{parts.query}" if parts.query else ""), safe="%/:?#[]@!$&'()*+,;=~")
    return f"{','.join(reversed((parts.hostname or '-').split('.')))}){path.lower()}".replace(" ", "%20")


def package(records: list[tuple[str, bytes]], date: str) -> bytes:
    """A package of (index key, compressed record) pairs, in order."""
    place, lines = 0, []
    for key, data in records:
        about = {"offset": place, "length": len(data), "filename": "data.warc.gz"}
        lines.append(f"{key} {date} {json.dumps(about)}\n")
        place += len(data)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as archive:
        archive.writestr(zipfile.ZipInfo(ARCHIVE), b"".join(data for _, data in records))
        archive.writestr(zipfile.ZipInfo(INDEX), "".join(sorted(lines)))
        archive.writestr(zipfile.ZipInfo("datapackage.json"), json.dumps({"profile": "data-package", "wacz_version": "1.1.1", "resources": [{"path": ARCHIVE}, {"path": INDEX}]}))
    return out.getvalue()


# --- jobs ------------------------------------------------------------------------------


def with_first_page(pages: DataFrame) -> DataFrame:
    """``pages`` with ``first_id``, the smallest id among pages of an equal payload (digest and length)."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    hashed = pages.select("page_id", "url", "html", F.sha1(payload).alias("digest"), F.octet_length(payload).alias("n"))
    firsts = hashed.groupBy("digest", "n").agg(F.min("page_id").alias("first_id"))
    # a payload with a third of all pages is one row there; its pages are dealt out by the join
    return hashed.join(firsts, ["digest", "n"], "left").select("page_id", "url", "html", "first_id")


def write_packages(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", folder: str | None = None,
    package_bytes: int = PACKAGE_BYTES, date: str = "2024-01-01T00:00:00Z",
) -> DataFrame:
    """Write every page as a record; the table of packages (``file``, ``folder``, ``size``, ``n_records``).

    A package of a lost attempt is not in that table.
    """
    folder = folder or scratch_dir(pages.sparkSession, "packages")
    marked = with_first_page(pick(pages, page_id=id_col, url=url_col, html=payload_col))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        system, root = open_folder(folder)
        system.create_dir(root, recursive=True)
        held: list[tuple[str, bytes]] = []

        def close() -> pa.RecordBatch:
            name, data = f"{root}/part-{task:06d}-{uuid.uuid4().hex}.wacz", package(held, date)
            with system.open_output_stream(name) as out:
                out.write(data)
            row = [name, len(data), len(held)]
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in row], names=["file", "size", "n_records"])

        n = 0
        for batch in batches:
            for page_id, url, html, first in zip(*[batch.column(c) for c in ("page_id", "url", "html", "first_id")]):
                page_id, url, first = page_id.as_py(), url.as_py(), first.as_py()
                payload = (html.as_py() or "").encode()
                refers_to = first if first is not None and page_id != first else None
                made = record(page_id, url, payload, base32_sha1(payload), refers_to, date)
                gzip = zlib.compressobj(1, zlib.DEFLATED, 31)
                packed = gzip.compress(made) + gzip.flush()
                if held and n + len(packed) > package_bytes:
                    yield close()
                    held, n = [], 0
                held.append((index_key(url), packed))
                n += len(packed)
        if held:
            yield close()

    packages = marked.mapInArrow(write, "file string, size long, n_records long")
    return stage(packages.select("*", F.lit(folder).alias("folder")), "package-list")


def _tasks(n: int, spark) -> int:
    return max(1, min(n, max(200, 4 * spark.sparkContext.defaultParallelism)))


def read_index(packages: DataFrame) -> DataFrame:
    """Where each record lies: ``file``, ``folder``, ``place`` and ``length`` in bytes of the package."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, _ = open_folder(row["folder"])
                with system.open_input_file(row["file"]) as source:
                    members = {m.name: m for m in directory(source, row["size"])}
                    lines = _read(source, stored_at(source, members[INDEX]), members[INDEX].size).decode().splitlines()
                    base = stored_at(source, members[ARCHIVE])
                found = [json.loads(line.split(" ", 2)[2]) for line in lines]
                if found:
                    columns = {
                        "file": [row["file"]] * len(found), "folder": [row["folder"]] * len(found),
                        "place": [base + f["offset"] for f in found], "length": [f["length"] for f in found],
                    }
                    yield pa.RecordBatch.from_pydict(columns)

    n = _tasks(packages.count(), packages.sparkSession)
    return packages.repartition(n, "file").mapInArrow(read, "file string, folder string, place long, length long")


RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def read_records(index: DataFrame, payloads: bool = False, read_bytes: int = READ_BYTES) -> DataFrame:
    """The records an index points at, read by range; with ``payloads`` also the payload of responses.

    Records are dealt out by file and place, so a large package is read by several tasks, and
    neighbours are fetched together.
    """
    schema = f"{RECORD}, payload binary" if payloads else RECORD
    names = [f.split(" ")[0] for f in schema.split(", ")]
    types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    arrow_schema = pa.schema([(f.split(" ")[0], types[f.split(" ")[1]]) for f in schema.split(", ")])

    def stretches(rows: list[dict]) -> Iterator[list[dict]]:
        held: list[dict] = []
        for row in rows:
            if held and (
                row["file"] != held[0]["file"] or row["place"] != held[-1]["place"] + held[-1]["length"]
                or row["place"] + row["length"] - held[0]["place"] > read_bytes
            ):
                yield held
                held = []
            held.append(row)
        if held:
            yield held

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in stretches(batch.to_pylist()):
                system, _ = open_folder(rows[0]["folder"])
                with system.open_input_file(rows[0]["file"]) as source:
                    data = _read(source, rows[0]["place"], sum(r["length"] for r in rows))
                at, parsed = 0, []
                for row in rows:
                    parsed.append(parse_record(zlib.decompress(data[at : at + row["length"]], 31)))
                    at += row["length"]
                yield pa.RecordBatch.from_pylist([{k: p[k] for k in names} for p in parsed], schema=arrow_schema)

    # a short key for each package: splitters are sampled to the driver
    dealt = index.withColumn("package", F.xxhash64("file"))
    dealt = dealt.repartitionByRange(_tasks(-(-index.count() // 500), index.sparkSession), "package", "place")
    dealt = dealt.sortWithinPartitions("file", "place").drop("package")
    return dealt.mapInArrow(read, schema)


def archive_round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", **settings) -> DataFrame:
    """Write ``pages`` into packages and read every record back; a row per page.

    A null payload counts as empty, and so do its digest and length. Of equal payloads the
    page with the smallest id is the response; if several rows carry that id, each is. A
    null id is never smallest: such a page revisits a page that has one, and where none has
    an id all are responses. A null address leaves the target out. An empty table writes no
    package and gives an empty result; other columns are not looked at.
    """
    packages = write_packages(pages, id_col, url_col, payload_col, **settings)
    return read_records(stage(read_index(packages), "record-index")).drop("url")


ROUND_TRIP_SQL = """
WITH paid AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
hashed AS (SELECT page_id, octet_length(payload) AS n, sha1(payload) AS hex FROM paid),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY hex, n) AS first_id FROM hashed)
SELECT page_id, n AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT, 1)), '') AS payload_digest,
       CASE WHEN first_id IS NULL OR page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first_id IS NULL OR page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM firsts
"""
