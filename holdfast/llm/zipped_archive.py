"""WARC records in ZIP packages: written by tasks, read back by ranges without extraction."""

from __future__ import annotations

import json
import struct
import zlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from holdfast.llm.common import small_batches
from holdfast.session import stage_table, staging_path

ARCHIVE_RECORDS, ARCHIVE_BYTES, SPAN_BYTES = 20_000, 256 << 20, 4 << 20
WARC_MEMBER, INDEX_MEMBER, ABOUT_MEMBER = "archive/data.warc.gz", "indexes/index.cdxj", "datapackage.json"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Fixed values of the ZIP format: signatures of its parts, and the marks for 64-bit sizes.
LOCAL, CENTRAL, END = 0x04034B50, 0x02014B50, 0x06054B50
END64, LOCATOR64, DESCRIPTOR = 0x06064B50, 0x07064B50, 0x08074B50
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF


class PackageWriter:
    """Writes stored members one after another to a stream that only moves forward.

    Sizes follow each member and stand in the directory, all in 64-bit form.
    """

    def __init__(self, stream):
        self.stream, self.at, self.members = stream, 0, []

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        raw = name.encode()
        self.name, self.offset = raw, self.at
        extra = struct.pack("<HHQQ", 1, 16, 0, 0)
        self.write(struct.pack("<IHHHHHIIIHH", LOCAL, 45, 0x808, 0, 0, 33, 0, FULL32, FULL32,
                               len(raw), len(extra)) + raw + extra)
        self.crc, self.size = 0, 0

    def add(self, data: bytes) -> None:
        self.crc, self.size = zlib.crc32(data, self.crc), self.size + len(data)
        self.write(data)

    def finish(self) -> None:
        self.write(struct.pack("<IIQQ", DESCRIPTOR, self.crc, self.size, self.size))
        self.members.append((self.name, self.crc, self.size, self.offset))

    def close(self) -> None:
        start = self.at
        for name, crc, size, offset in self.members:
            extra = struct.pack("<HHQQQ", 1, 24, size, size, offset)
            self.write(struct.pack("<IHHHHHHIIIHHHHHII", CENTRAL, 45, 45, 0x808, 0, 0, 33, crc, FULL32,
                                   FULL32, len(name), len(extra), 0, 0, 0, 0, FULL32) + name + extra)
        size, end, n = self.at - start, self.at, len(self.members)
        self.write(struct.pack("<IQHHIIQQQQ", END64, 44, 45, 45, 0, 0, n, n, size, start))
        self.write(struct.pack("<IIQI", LOCATOR64, 0, end, 1))
        self.write(struct.pack("<IHHHHIIH", END, 0, 0, min(n, FULL16), min(n, FULL16), FULL32, FULL32, 0))
        self.stream.close()


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    crc: int
    packed: int
    size: int
    offset: int


def read_directory(read, length: int) -> dict[str, Member]:
    """Members by name, from the central directory. ``read(offset, n)`` returns a range of the file."""
    tail_at = max(0, length - (FULL16 + 22 + 20))
    tail = read(tail_at, length - tail_at)
    found = tail.rfind(struct.pack("<I", END))
    while found >= 0 and found + 22 + int.from_bytes(tail[found + 20: found + 22], "little") != len(tail):
        found = tail.rfind(struct.pack("<I", END), 0, found)
    if found < 0:
        raise ValueError("not a ZIP package: no end of the directory")
    count, size, start = struct.unpack("<HII", tail[found + 10: found + 20])
    locator = tail[found - 20: found] if found >= 20 else b""
    if locator[:4] == struct.pack("<I", LOCATOR64):
        (at,) = struct.unpack("<Q", locator[8:16])
        end64 = read(at, 56)
        if end64[:4] != struct.pack("<I", END64):
            raise ValueError("broken ZIP package: 64-bit end missing")
        count, size, start = struct.unpack("<QQQ", end64[32:56])
    raw, at, members = read(start, size), 0, {}
    for _ in range(count):
        fields = struct.unpack("<IHHHHHHIIIHHHHHII", raw[at: at + 46])
        if fields[0] != CENTRAL:
            raise ValueError("broken ZIP package: directory entry expected")
        method, crc, packed, full = fields[4], fields[7], fields[8], fields[9]
        name_n, extra_n, note_n, offset = fields[10], fields[11], fields[12], fields[16]
        name = raw[at + 46: at + 46 + name_n].decode()
        extra = raw[at + 46 + name_n: at + 46 + name_n + extra_n]
        full, packed, offset = _long_sizes(extra, full, packed, offset)
        members[name] = Member(name, method, crc, packed, full, offset)
        at += 46 + name_n + extra_n + note_n
    return members


def _long_sizes(extra: bytes, full: int, packed: int, offset: int) -> tuple[int, int, int]:
    at = 0
    while at + 4 <= len(extra):
        kind, n = struct.unpack("<HH", extra[at: at + 4])
        if kind == 1:
            values = iter(struct.unpack(f"<{n // 8}Q", extra[at + 4: at + 4 + n // 8 * 8]))
            full = next(values) if full == FULL32 else full
            packed = next(values) if packed == FULL32 else packed
            offset = next(values) if offset == FULL32 else offset
        at += 4 + n
    return full, packed, offset


def data_start(read, member: Member) -> int:
    """Where the bytes of a stored member begin."""
    if member.method != 0:
        raise ValueError(f"member {member.name} is compressed; only stored members can be read by range")
    head = read(member.offset, 30)
    if head[:4] != struct.pack("<I", LOCAL):
        raise ValueError(f"broken ZIP package: no header of {member.name}")
    name_n, extra_n = struct.unpack("<HH", head[26:30])
    return member.offset + 30 + name_n + extra_n


def gzip_member(data: bytes, level: int = 6) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _clean(url: str) -> str:
    from urllib.parse import quote

    return quote(url, safe="".join(chr(c) for c in range(33, 127)))


def warc_record(page_id, url, payload: bytes, digest: str, kind: str, refers_to, date: str) -> bytes:
    """One record; a revisit has the response's HTTP head, which gives the length, but no payload."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http + (payload if kind == "response" else b"")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page_id}>",
             f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_clean(url)}")
    if kind == "revisit":
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(WARC fields, HTTP fields, payload) of one record; names in lower case."""
    def fields(head: bytes) -> dict[str, str]:
        pairs = (line.partition(":") for line in head.decode().split("\r\n")[1:])
        return {name.strip().lower(): value.strip() for name, _, value in pairs}

    head, _, rest = raw.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    warc = fields(head)
    http, _, payload = rest[: int(warc["content-length"])].partition(b"\r\n\r\n")
    return warc, fields(http), payload


def mark_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, html, sha1, record_type, refers_to) of every row of ``pages``.

    Of the rows whose payloads are equal, the one with the largest page_id is the response; where rows
    repeat, one of them. Null html is an empty payload. Rows without an id come last.
    """
    payload = F.coalesce("html", F.lit(""))
    sha1 = F.sha1(payload.cast("binary"))
    key = F.concat_ws(":", F.coalesce(F.col("page_id").cast("string"), F.lit("null")), sha1)
    marked = pages.select(F.col("page_id").cast("long"), "url", payload.alias("html"), sha1.alias("sha1"),
                          key.alias("_key"))
    own = marked.groupBy("_key", "sha1").agg(F.max("page_id").alias("id"))
    best = own.groupBy("sha1").agg(F.max("id").alias("best"))
    wide = own.join(best, "sha1").select("_key", "best", F.col("id").eqNullSafe(F.col("best")).alias("first"))
    copies = Window.partitionBy("_key").orderBy("url")
    response = F.col("first") & (F.col("_n") == 1) | (F.octet_length("html") < min_bytes)
    return (
        marked.join(wide, "_key").withColumn("_n", F.row_number().over(copies))
        .select("page_id", "url", "html", "sha1",
                F.when(response, "response").otherwise("revisit").alias("record_type"),
                F.when(~response, F.col("best")).alias("refers_to"))
    )


def write_packages(marked: DataFrame, folder: str, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """(path, records): the packages that tasks wrote to ``folder``, a shared one that pyarrow can open.

    A task that is run again writes new files; what a lost one left is in no row of the result, which
    is stored, so packages are written once.
    """
    import pyarrow as pa

    def write(batches):
        import base64
        import uuid

        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        package, index = None, []

        def close():
            package.finish()
            package.begin(INDEX_MEMBER)
            package.add("".join(f"{line}\n" for line in index).encode())
            package.finish()
            package.begin(ABOUT_MEMBER)
            package.add(json.dumps({"profile": "data-package", "resources": [
                {"path": WARC_MEMBER}, {"path": INDEX_MEMBER}]}).encode())
            package.finish()
            package.close()
            return pa.RecordBatch.from_pylist(
                [{"path": name, "records": len(index)}],
                pa.schema([("path", pa.string()), ("records", pa.int64())]),
            )

        for batch in batches:
            for row in range(batch.num_rows):
                page_id, url, html, sha1, kind, refers_to = (c[row].as_py() for c in batch.columns)
                if package is None:
                    name = f"{base.rstrip('/')}/{uuid.uuid4().hex}.wacz"
                    package, index = PackageWriter(system.open_output_stream(name)), []
                    package.begin(WARC_MEMBER)
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                raw = gzip_member(warc_record(page_id, url, html.encode(), digest, kind, refers_to, date))
                index.append(f"{_clean(url or '-')} {date[:10].replace('-', '')} " + json.dumps(
                    {"offset": str(package.size), "length": str(len(raw)), "digest": f"sha1:{digest}",
                     "filename": WARC_MEMBER.rpartition("/")[2]}))
                package.add(raw)
                if len(index) >= ARCHIVE_RECORDS or package.size >= ARCHIVE_BYTES:
                    yield close()
                    package = None
        if package is not None:
            yield close()

    return stage_table(small_batches(marked).mapInArrow(write, "path string, records long"), "packages")


def package_records(system, path: str):
    """(WARC fields, HTTP fields, payload) of all records of a package, read by ranges of the open file."""
    with system.open_input_file(path) as file:
        def read(offset: int, n: int) -> bytes:
            return file.read_at(n, offset)

        members = read_directory(read, file.size())
        for name in sorted(m for m in members if m.startswith("indexes/")):
            start, size = data_start(read, members[name]), members[name].size
            lines = read(start, size).decode().splitlines()
            entries: dict[str, list[tuple[int, int]]] = {}
            for line in lines:
                about = json.loads(line.split(" ", 2)[2])
                entries.setdefault(about["filename"], []).append((int(about["offset"]), int(about["length"])))
            for filename, places in entries.items():
                base = data_start(read, members[f"archive/{filename}"])
                places.sort()
                i = 0
                while i < len(places):
                    j = i + 1
                    while j < len(places) and sum(places[j]) - places[i][0] <= SPAN_BYTES:
                        j += 1
                    first, end = places[i][0], max(map(sum, places[i:j]))
                    span = read(base + first, end - first)
                    for offset, n in places[i:j]:
                        yield parse_record(zlib.decompress(span[offset - first: offset - first + n], 31))
                    i = j


def read_packages(packages: DataFrame, folder: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of all records of all packages.

    The digest of a response is checked against its payload.
    """
    import pyarrow as pa

    def number(urn: str | None):
        text = (urn or "").rpartition(":")[2].rstrip(">")
        return int(text) if text.lstrip("-").isdigit() else None

    def read(batches):
        import base64
        import hashlib

        from pyarrow import fs

        system, _ = fs.FileSystem.from_uri(folder)
        schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()),
                            ("payload_digest", pa.string()), ("record_type", pa.string()),
                            ("refers_to", pa.int64())])
        for batch in batches:
            for path in batch.column(0).to_pylist():
                out = []
                for warc, http, payload in package_records(system, path):
                    digest = warc["warc-payload-digest"].removeprefix("sha1:")
                    kind = warc["warc-type"]
                    if kind == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                        raise ValueError(f"payload of {warc['warc-record-id']} does not match its digest")
                    out.append((number(warc["warc-record-id"]), int(http["content-length"]), digest, kind,
                                number(warc.get("warc-refers-to"))))
                    if len(out) == 5000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), schema)], schema=schema)
                        out = []
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), schema)], schema=schema)

    spread = packages.select("path").repartition(max(1, packages.count()))
    return spread.mapInArrow(
        read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    )


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes a record for every row of ``pages`` (page_id, url, html) to packages in the shared folder, and reads them back.

    Rows that repeat, null urls and null ids get records like others. No rows: no packages, no rows.
    """
    folder = staging_path(pages.sparkSession, "packages")
    packages = write_packages(mark_revisits(pages, min_bytes), folder)
    return read_packages(packages, folder)
