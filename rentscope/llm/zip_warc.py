"""WARC archives in ZIP packages, read by ranges (operator 6).

Writing: every page is a WARC record, gzipped on its own.  Of records with
equal payloads of REVISIT_FROM bytes or more the one with the smallest page id
is the response and the others are revisits that refer to it.  Records fill
members ``archive/data-N.warc.gz`` of a ZIP package, stored without further
compression; ``indexes/index.cdxj`` tells each record's member, offset and
length.  A package is one file of Spark's text writer: each written row is
followed by a line feed, which ZIP allows between members (offsets count it)
and, after the end record, as the archive comment.

A task closes a package after MEMBERS members and begins another file, so a
package stays at about MEMBERS * MEMBER_BYTES however much a task holds.

Reading: the end record and, where sizes or numbers need it, the ZIP64 records
lead to the central directory; only the index and then single records are read,
as ranges of the stored members, and nothing is extracted.  ``Package`` works
on any function that returns a range of bytes.  In Spark, packages are listed
without their content; one task a package reads its directory and index by
ranges and gives rows (file, place, sizes of consecutive records), which are
spread over all tasks and read there, each as one range.  Ranges are read
through Python's and Arrow's file systems (local, hdfs, s3, gs); for a store
that only Spark opens, packages are loaded whole, up to Spark's limit of 2 GB.

Defined results: null html is an empty payload; null urls are empty; rows that
share the smallest page id of a payload are all responses; a null page id only
is a response if all of its payload's are null; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import struct
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentscope.llm.tables import table
from rentscope.session import scratch_path
from rentscope.sources.ranges import Ranges

REVISIT_FROM = 100
MEMBER_BYTES = 8 << 20
MEMBERS = 30             # in a package
RANGE_BYTES = 4 << 20    # consecutive records that are read at once
TASK_BYTES = 64 << 20    # of packages that a reading task has on average
DATE = "1970-01-01T00:00:00Z"  # fixed, so that a package does not depend on when it is written
_LOCAL = struct.Struct("<4s5H3I2H")
_CENTRAL = struct.Struct("<4s6H3I5H2I")
_END = struct.Struct("<4s4H2IH")
_END64 = struct.Struct("<4sQ2H2I4Q")
_LOCATOR = struct.Struct("<4sIQI")
_MAX16, _MAX32 = 0xFFFF, 0xFFFFFFFF


def decided(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, payload_digest, record_type, refers_to)."""
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"),
                        F.coalesce("html", F.lit("")).alias("html")).withColumns({
                            "payload_digest": F.sha2(F.col("html").cast("binary"), 256),
                            "payload_bytes": F.octet_length("html").cast("long")})
    # decided on ids and digests alone; payloads move at most once
    ids = rows.filter(F.col("payload_bytes") >= REVISIT_FROM).select("page_id", "payload_digest")
    first = (ids.groupBy("payload_digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("_n"))
             .filter("_n > 1 AND refers_to IS NOT NULL").drop("_n"))
    again = (ids.join(first, "payload_digest").filter(~F.col("page_id").eqNullSafe(F.col("refers_to"))).distinct()
             .withColumnRenamed("page_id", "_id").withColumnRenamed("payload_digest", "_digest"))
    rows = rows.join(again, F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("payload_digest") == F.col("_digest")), "left")
    return rows.select("page_id", "url", "html", "payload_digest",
                       F.when(F.col("refers_to").isNull(), "response").otherwise("revisit").alias("record_type"),
                       "refers_to")


def warc_record(page_id, url: str, payload: bytes, digest: str, kind: str, refers_to) -> bytes:
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
            f"WARC-Target-URI: {_field(url)}", f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha256:{digest}",
            f"X-Payload-Length: {len(payload)}"]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    if kind == "revisit":
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        payload = b""
    block = http + payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _field(value: str) -> str:
    """Header values are one line."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def read_warc(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    block = rest[:int(fields["content-length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


class PackageWriter:
    """Rows of a package; ``gap`` bytes follow each row in the file."""

    def __init__(self, gap: int = 1, zip64: bool = False):
        self.at, self.gap, self.zip64, self.entries = 0, gap, zip64, []

    def row(self, data: bytes) -> bytes:
        self.at += len(data) + self.gap
        return data

    def member(self, name: str, data: bytes) -> bytes:
        raw, crc, size = name.encode(), zlib.crc32(data), len(data)
        large = self.zip64 or size >= _MAX32
        extra = struct.pack("<2H2Q", 1, 16, size, size) if large else b""
        shown = _MAX32 if large else size
        self.entries.append((raw, crc, size, self.at))
        return self.row(_LOCAL.pack(b"PK\3\4", 45 if large else 20, 0x800, 0, 0, 0x21, crc, shown, shown,
                                    len(raw), len(extra)) + raw + extra + data)

    def close(self) -> bytes:
        """Central directory and end records; the last row, its gap is the comment."""
        out = []
        for raw, crc, size, at in self.entries:
            large = self.zip64 or size >= _MAX32 or at >= _MAX32
            extra = struct.pack("<2H3Q", 1, 24, size, size, at) if large else b""
            shown, place = (_MAX32, _MAX32) if large else (size, at)
            out.append(_CENTRAL.pack(b"PK\1\2", 45, 45 if large else 20, 0x800, 0, 0, 0x21, crc, shown, shown, len(raw),
                                     len(extra), 0, 0, 0, 0, place) + raw + extra)
        directory, n = b"".join(out), len(out)
        tail = b""
        if self.zip64 or n >= _MAX16 or self.at >= _MAX32 or len(directory) >= _MAX32:
            tail = (_END64.pack(b"PK\6\6", 44, 45, 45, 0, 0, n, n, len(directory), self.at)
                    + _LOCATOR.pack(b"PK\6\7", 0, self.at + len(directory), 1))
        small = (min(n, _MAX16), min(len(directory), _MAX32), min(self.at, _MAX32)) if not tail else (
            _MAX16, _MAX32, _MAX32)
        return self.row(directory + tail + _END.pack(b"PK\5\6", 0, 0, small[0], small[0], small[1], small[2], self.gap))


class Package:
    """A ZIP package behind ``read(offset, length)``."""

    def __init__(self, read: Callable[[int, int], bytes], size: int):
        self.read = read
        tail_at = max(0, size - _END.size - _MAX16)
        tail = bytes(read(tail_at, size - tail_at))
        at = len(tail)
        while True:  # the end record whose comment reaches exactly to the file's end
            at = tail.rfind(b"PK\5\6", 0, at)
            if at < 0:
                raise ValueError("no end of central directory")
            if at + _END.size <= len(tail) and at + _END.size + _END.unpack_from(tail, at)[7] == len(tail):
                break
        n, length, start = _END.unpack_from(tail, at)[4:7]
        if (n == _MAX16 or length == _MAX32 or start == _MAX32) and at + tail_at >= _LOCATOR.size:
            mark, _, where, _ = _LOCATOR.unpack(bytes(read(at + tail_at - _LOCATOR.size, _LOCATOR.size)))
            if mark == b"PK\6\7":
                end = _END64.unpack(bytes(read(where, _END64.size)))
                if end[0] != b"PK\6\6":
                    raise ValueError("no ZIP64 end record")
                n, length, start = end[7:10]
        self.members: dict[str, tuple[int, int, int]] = {}  # name: header's place, stored bytes, method
        directory, at = bytes(read(start, length)), 0
        for _ in range(n):
            f = _CENTRAL.unpack_from(directory, at)
            if f[0] != b"PK\1\2":
                raise ValueError("central directory is broken")
            names, extras, comment = f[10:13]
            name = directory[at + _CENTRAL.size:at + _CENTRAL.size + names].decode()
            stored, place = self._large(directory[at + _CENTRAL.size + names:][:extras], f[9], f[8], f[16])
            self.members[name] = (place, stored, f[4])
            at += _CENTRAL.size + names + extras + comment

    @staticmethod
    def _large(extra: bytes, plain: int, stored: int, place: int) -> tuple[int, int]:
        at = 0
        while at + 4 <= len(extra):
            kind, size = struct.unpack_from("<2H", extra, at)
            if kind == 1:  # 64-bit values, only of the fields that are full, in this order
                values = iter(struct.unpack_from(f"<{size // 8}Q", extra, at + 4))
                plain = next(values) if plain == _MAX32 else plain
                stored = next(values) if stored == _MAX32 else stored
                place = next(values) if place == _MAX32 else place
            at += 4 + size
        return stored, place

    def begin(self, name: str) -> int:
        """Where the bytes of a stored member begin."""
        place, _, method = self.members[name]
        if method:
            raise ValueError(f"{name} is compressed; only stored members are read by ranges")
        head = _LOCAL.unpack(bytes(self.read(place, _LOCAL.size)))
        if head[0] != b"PK\3\4":
            raise ValueError(f"no local header of {name}")
        return place + _LOCAL.size + head[9] + head[10]

    def range(self, name: str, offset: int = 0, length: int | None = None) -> bytes:
        """Bytes of a stored member, without reading the rest of it."""
        begin, stored = self.begin(name), self.members[name][1]
        length = stored - offset if length is None else length
        if not 0 <= offset <= offset + length <= stored:
            raise ValueError(f"range outside {name}")
        return bytes(self.read(begin + offset, length))

    def places(self) -> Iterator[tuple[int, int]]:
        """Place in the package and length of every indexed record; a package
        with archive members that no index lists is refused at the end."""
        listed, begins = set(), {}
        for name in sorted(self.members):
            if name.startswith("indexes/"):
                for line in self.range(name).decode().splitlines():
                    at = json.loads(line[line.index("{"):])
                    member = at["filename"]
                    if member not in begins:
                        begins[member] = self.begin(member)
                    listed.add(member)
                    if not 0 <= at["offset"] <= at["offset"] + at["length"] <= self.members[member][1]:
                        raise ValueError(f"range outside {member}")
                    yield begins[member] + at["offset"], at["length"]
        if lost := sorted(x for x in self.members if x.startswith("archive/") and not x.endswith("/") and x not in listed):
            raise ValueError(f"no index lists {', '.join(lost[:5])} ({len(lost)} in all)")

    def records(self) -> Iterator[tuple[dict[str, str], bytes]]:
        """All indexed records, one range read each."""
        for at, length in self.places():
            yield read_warc(gzip.decompress(self.read(at, length)))


def write_packages(rows: DataFrame, path: str) -> None:
    """Packages of at most MEMBERS members, their records in page order."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        out, index, held, size, n = PackageWriter(), [], [], 0, 0

        def row(data: bytes) -> pa.RecordBatch:
            return pa.record_batch([pa.array([data], pa.binary())], ["data"])

        def close() -> Iterator[pa.RecordBatch]:
            yield row(out.member("indexes/index.cdxj", "\n".join(index).encode()))
            yield row(out.close())
        for batch in batches:
            for i in range(batch.num_rows):
                page, url, html, digest, kind, refers = (c[i].as_py() for c in batch.columns)
                data = gzip.compress(warc_record(page, url, html.encode(), digest, kind, refers), 6, mtime=0)
                index.append(f"{page} {json.dumps({'url': url, 'filename': f'archive/data-{n}.warc.gz', 'offset': size, 'length': len(data), 'digest': digest})}")
                held.append(data)
                size += len(data)
                if size >= MEMBER_BYTES:
                    yield row(out.member(f"archive/data-{n}.warc.gz", b"".join(held)))
                    held, size, n = [], 0, n + 1
                    if n == MEMBERS:  # as many rows as the text writer puts in a file
                        yield from close()
                        out, index, n = PackageWriter(), [], 0
        if held:
            yield row(out.member(f"archive/data-{n}.warc.gz", b"".join(held)))
        if index:
            yield from close()
    (rows.sortWithinPartitions("page_id", "url", "payload_digest")
     .mapInArrow(run, "data binary").select(F.col("data").cast("string"))
     .write.option("lineSep", "\n").option("maxRecordsPerFile", MEMBERS + 2).text(path))


def ranges(files: DataFrame) -> DataFrame:
    """(path, at, sizes): runs of consecutive records of the packages (path, length)."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        def row(path: str, at: int, sizes: list[int]) -> pa.RecordBatch:
            return pa.record_batch([pa.array([path]), pa.array([at], pa.int64()), pa.array([sizes], pa.list_(pa.int64()))],
                                   ["path", "at", "sizes"])
        for batch in batches:
            for path, length in zip(*(c.to_pylist() for c in batch.columns)):
                if not length:
                    continue
                with Ranges(path) as read:
                    begin, sizes, total = 0, [], 0
                    for at, size in Package(read, length).places():
                        if sizes and (at != begin + total or total >= RANGE_BYTES):
                            yield row(path, begin, sizes)
                            sizes, total = [], 0
                        if not sizes:
                            begin = at
                        sizes.append(size)
                        total += size
                    if sizes:
                        yield row(path, begin, sizes)
    return files.mapInArrow(run, "path string, at long, sizes array<long>")


FIELDS = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "html"]
KINDS = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]


def _table(records: Iterator[tuple[dict[str, str], bytes]]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def batch() -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*held), KINDS)], FIELDS)
    for f, payload in records:
        revisit = f["warc-type"] == "revisit"
        digest = f["warc-payload-digest"].removeprefix("sha256:")
        if not revisit and hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"payload of {f['warc-record-id']} is damaged")
        page, refers = (x[len("<urn:page:"):-1] for x in (f["warc-record-id"], f.get("warc-refers-to", "<urn:page:>")))
        held.append((int(page) if page else None, f["warc-target-uri"],
                     int(f["x-payload-length"]) if revisit else len(payload), digest, f["warc-type"],
                     int(refers) if refers else None, None if revisit else payload.decode()))
        size += len(payload)
        if size > 4 << 20:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def read_packages(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to,
    html) of every record; a revisit has no html of its own."""
    def by_ranges(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, at, sizes in zip(*(c.to_pylist() for c in batch.columns)):
                with Ranges(name) as read:
                    data, ends = read(at, sum(sizes)), [0]
                    for n in sizes:
                        ends.append(ends[-1] + n)
                yield from _table(read_warc(gzip.decompress(data[a:b])) for a, b in zip(ends, ends[1:]))

    def whole(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                data = memoryview(content.as_buffer())
                if len(data):
                    yield from _table(Package(lambda at, n: data[at:at + n], len(data)).records())
    schema = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
              "refers_to long, html string")
    files = spark.read.format("binaryFile").load(path)
    if not Ranges.can(path):
        return files.select("content").mapInArrow(whole, schema)
    files = files.select("path", "length")  # a listing: no content is read
    total = files.agg(F.sum("length")).first()[0] or 0
    parts = max(-(-total // TASK_BYTES), 2 * spark.sparkContext.defaultParallelism)
    return ranges(files).repartition(parts, "path", "at").mapInArrow(by_ranges, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc-packages")
    write_packages(decided(table(spark, sf_dir, "pages")), path)
    return read_packages(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def oracle() -> str:
    """The query in DuckDB's SQL, from the pages alone."""
    return f"""
WITH p AS (SELECT row_number() OVER () AS r, page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT r, page_id, octet_length(encode(h))::BIGINT AS n, sha256(h) AS digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS least FROM d)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= {REVISIT_FROM} AND page_id IS DISTINCT FROM least THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= {REVISIT_FROM} AND page_id IS DISTINCT FROM least THEN least END AS refers_to
FROM f"""
