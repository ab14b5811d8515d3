"""Web archives in ZIP packages: written by partition, located through their directories, read by ranges without extraction.

A package is a ZIP file with stored (uncompressed) members: ``archive/data.warc.gz``, each WARC record a gzip member of its
own, and ``indexes/index.cdxj``, a line per record that says where it lies. So a reader needs the end of the file, the index
and the ranges it wants, and any number of tasks can read one package.
"""

from __future__ import annotations

import hashlib
import io
import json
import math
import posixpath
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.operators.joins import join_per_key
from orderloom.session import SHUFFLE_TARGET_BYTES

from .common import staged, text_of

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
DATE = "1970-01-01T00:00:00Z"  # pages carry no time of capture
LEAST_REVISIT = 100  # bytes; smaller payloads are stored each time
LEVEL = 3  # of gzip
PACKAGE_BYTES = 1 << 30  # at which a task begins another package; the index of one is held in memory
PACKAGE_RECORDS = 100_000
RANGE_BYTES = 4 << 20  # of neighbouring records that are read together
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of the format
_URN = "urn:page:"
_BATCH_BYTES = 8 << 20


def file_at(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path of a URI or local path; tasks read and write packages there without Spark."""
    return pyarrow.fs.FileSystem.from_uri(uri)


# ---------------------------------------------------------------- writing


def record(page: str, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One WARC record, compressed. A revisit has the HTTP headers of the full payload and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{_URN}{quote(page, safe='')}>"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header(url)}")
    lines += [f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response"]
    block = http + payload
    if refers_to is not None:
        lines += [f"WARC-Profile: {SAME_PAYLOAD}", f"WARC-Refers-To: <{_URN}{quote(refers_to, safe='')}>"]
        block = http
    lines.append(f"Content-Length: {len(block)}")
    packed = zlib.compressobj(LEVEL, wbits=31)
    return packed.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packed.flush()


def _header(url: str) -> str:
    """White space and control characters would end or fold a header line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


class Package:
    """A package while it is written, as a stream that is never sought."""

    def __init__(self, path: str, out):
        self.path, self.out = path, out
        self.zip = zipfile.ZipFile(out, "w", zipfile.ZIP_STORED)
        self.member = self.zip.open(zipfile.ZipInfo(ARCHIVE), "w", force_zip64=True)
        self.at, self.index = 0, []

    def add(self, page: str, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> None:
        data = record(page, url, payload, digest, refers_to)
        self.member.write(data)
        place = {"filename": posixpath.basename(ARCHIVE), "offset": self.at, "length": len(data), "digest": f"sha256:{digest}"}
        key, time = "-" if url is None else _header(url), re.sub(r"\D", "", DATE)
        self.index.append(f"{key} {time} {json.dumps(place)}\n")
        self.at += len(data)

    @property
    def full(self) -> bool:
        return self.at >= PACKAGE_BYTES or len(self.index) >= PACKAGE_RECORDS

    def close(self) -> tuple[str, int, int]:
        self.member.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), "".join(self.index).encode())
        self.zip.close()
        self.out.close()
        return self.path, len(self.index), self.at


def marked(pages: DataFrame, id_column: str, url_column: str, body_column: str, least: int = LEAST_REVISIT) -> DataFrame:
    """``page``, ``url``, ``payload``, ``digest`` of every row, and ``refers_to``, the page whose payload it repeats.

    Only payloads that occur more than once are looked up; their table is written first, so that Spark knows its size.
    """
    body = text_of(body_column).cast("binary")
    rows = pages.select(F.col(id_column).alias("page"), F.col(url_column).cast("string").alias("url"), body.alias("payload"), F.sha2(body, 256).alias("digest"))
    long = rows.where(F.octet_length("payload") >= least)
    repeated = long.groupBy("digest").agg(F.min("page").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    # a payload has one row there; the length is no part of the key, as equal digests have equal lengths
    found = join_per_key(rows, staged(repeated, "repeated"), "digest", "left")
    return found.withColumn("refers_to", F.when(~F.col("page").eqNullSafe(F.col("least")), F.col("least"))).drop("least")


def write_packages(
    pages: DataFrame, folder: str, id_column: str = "page_id", url_column: str = "url", body_column: str = "html", least: int = LEAST_REVISIT
) -> DataFrame:
    """Write a record per row into packages below ``folder``, a URI all executors share; returns their ``path``, ``records``, ``bytes``.

    Of rows with equal payloads of at least ``least`` bytes, the one with the smallest id is a response and the others are
    revisits of it. Every task writes files of its own with new names, and the returned table names those of the
    attempts that Spark committed: what a lost executor leaves behind is in no later read.

    Defined cases: a null payload is an empty one; a null url leaves the header out; white space and control characters of a url are
    percent-encoded; rows that repeat the smallest id of a payload are responses like it; a null id is larger than
    all others; other columns are passed over; an empty table gives no package.
    """
    rows = marked(pages, id_column, url_column, body_column, least)
    text = lambda c: F.col(c).cast("string").alias(c)
    rows = rows.select(F.coalesce(text("page"), F.lit("")).alias("page"), "url", "payload", "digest", text("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = file_at(folder)
        package = None
        for b in batches:
            columns = [b.column(k) for k in range(5)]
            for k in range(b.num_rows):
                if package is None:
                    if files.type_name in ("local", "hdfs"):
                        files.create_dir(root, recursive=True)
                    name = f"{uuid.uuid4().hex}.zip"
                    package = Package(f"{folder.rstrip('/')}/{name}", files.open_output_stream(f"{root}/{name}"))
                package.add(*(c[k].as_py() for c in columns))
                if package.full:
                    yield _written(package)
                    package = None
        if package is not None:
            yield _written(package)

    return staged(rows.mapInArrow(run, "path string, records long, bytes long"), "packages")


def _written(package: Package) -> pa.RecordBatch:
    path, records, size = package.close()
    return pa.RecordBatch.from_pydict({"path": [path], "records": [records], "bytes": [size]})


# ---------------------------------------------------------------- reading


class BadPackage(ValueError):
    """The file is no ZIP package, or its parts contradict each other."""


@dataclass(frozen=True)
class Member:
    """Where the bytes of a stored member lie in the package."""

    start: int
    size: int


_END, _END64, _AT64, _ENTRY, _LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"


def _directory(file) -> tuple[bytes, int]:
    """The central directory, and by how many bytes the package is shifted against its own offsets."""
    size = file.size()
    begin = max(0, size - 22 - 0xFFFF)
    tail = file.read_at(size - begin, begin)
    at = len(tail)
    while (at := tail.rfind(_END, 0, at)) >= 0:  # a comment may hold the signature
        if at + 22 <= len(tail) and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail):
            break
    else:
        raise BadPackage("no end of a central directory")
    count, length, offset = struct.unpack_from("<HII", tail, at + 10)
    end = begin + at
    locator = file.read_at(20, end - 20) if end >= 20 else b""
    if locator[:4] == _AT64:
        end64 = struct.unpack_from("<Q", locator, 8)[0]
        head = file.read_at(56, end64)
        if head[:4] != _END64:  # something stands before the package: the record ends where the locator begins
            end64 = end - 20 - 56
            head = file.read_at(56, end64)
        if head[:4] != _END64:
            raise BadPackage("no ZIP64 directory at its place")
        length, offset = struct.unpack_from("<QQ", head, 40)
        end = end64
    elif 0xFFFF == count or 0xFFFFFFFF in (length, offset):
        raise BadPackage("no locator of the ZIP64 directory")
    if length > end:
        raise BadPackage("the central directory is longer than the file")
    return file.read_at(length, end - length), end - length - offset


def members(file) -> dict[str, Member]:
    """The stored members of a package by name; compressed or encrypted ones cannot be read by ranges and are left out."""
    directory, shift = _directory(file)
    found, at = {}, 0
    while at < len(directory):
        if directory[at : at + 4] != _ENTRY or at + 46 > len(directory):
            raise BadPackage("broken central directory")
        flags, method = struct.unpack_from("<HH", directory, at + 8)
        packed, size, name_len, extra_len, note_len, _, _, _, local = struct.unpack_from("<IIHHHHHII", directory, at + 20)
        name = directory[at + 46 : at + 46 + name_len].decode()
        extra = directory[at + 46 + name_len : at + 46 + name_len + extra_len]
        at += 46 + name_len + extra_len + note_len
        size, packed, local = _wide(extra, size, packed, local)
        if method or flags & 1:
            continue
        head = file.read_at(30, local + shift)
        if head[:4] != _LOCAL or packed != size:
            raise BadPackage(f"{name} is not where the directory says")
        start = local + shift + 30 + sum(struct.unpack_from("<HH", head, 26))
        if start + size > file.size():
            raise BadPackage(f"{name} goes beyond the file's end")
        found[name] = Member(start, size)
    return found


def _wide(extra: bytes, *sizes: int) -> list[int]:
    """Sizes and offset of an entry; those that do not fit 32 bits follow in its ZIP64 field, in this order."""
    at, field = 0, b""
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            field = extra[at + 4 : at + 4 + length]
        at += 4 + length
    out, at = [], 0
    for n in sizes:
        if n == 0xFFFFFFFF:
            if at + 8 > len(field):
                raise BadPackage("an entry lacks its ZIP64 sizes")
            n, at = struct.unpack_from("<Q", field, at)[0], at + 8
        out.append(n)
    return out


def _lines(file, member: Member) -> Iterator[bytes]:
    rest = b""
    for at in range(member.start, member.start + member.size, 1 << 20):
        *lines, rest = (rest + file.read_at(min(1 << 20, member.start + member.size - at), at)).split(b"\n")
        yield from lines
    if rest:
        yield rest


def ranges(file) -> Iterator[tuple[int, list[int]]]:
    """Where the indexed records lie: start of a range, lengths of the neighbouring records in it."""
    found = members(file)
    indexes = [m for name, m in sorted(found.items()) if re.fullmatch(r"indexes/.*\.cdxj?", name)]
    if not indexes:
        raise BadPackage("no stored index")
    start, lengths, end = 0, [], -1
    for index in indexes:
        for line in _lines(file, index):
            place = json.loads(line[line.index(b"{") :])
            member = found.get(f"archive/{place['filename']}")
            offset, length = int(place["offset"]), int(place["length"])
            if member is None or offset < 0 or length <= 0 or offset + length > member.size:
                raise BadPackage(f"the index names a record that no stored archive holds: {place}")
            offset += member.start
            if offset != end or end - start + length > RANGE_BYTES:
                if lengths:
                    yield start, lengths
                start, lengths = offset, []
            lengths.append(length)
            end = offset + length
    if lengths:
        yield start, lengths


def locate(packages: DataFrame) -> DataFrame:
    """``path``, ``start`` and ``lengths`` of the ranges of all packages; reads only their ends, directories and indexes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, records in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                files, at = file_at(path)
                with files.open_input_file(at) as file:
                    n = 0
                    found = ranges(file)
                    while some := [r for r, _ in zip(found, range(64), strict=False)]:
                        n += sum(len(lengths) for _, lengths in some)
                        starts, lengths = zip(*some, strict=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([path] * len(some)), pa.array(starts, pa.int64()), pa.array(lengths, pa.list_(pa.int64()))],
                            ["path", "start", "lengths"],
                        )
                    if records is not None and n != records:
                        raise BadPackage(f"{path}: {records} records were written, {n} are indexed")

    records = F.col("records") if "records" in packages.columns else F.lit(None).cast("long").alias("records")
    return packages.select("path", records).mapInArrow(run, "path string, start long, lengths array<long>")


def parse(data: bytes) -> tuple[str, str, str | None, str | None, str, int, bytes | None]:
    """Type, page, url, page referred to, payload digest, payload bytes and payload of one compressed record; None for a revisit's payload."""
    raw = zlib.decompress(data, wbits=31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    if not version.startswith("WARC/"):
        raise BadPackage("no WARC record")
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    told = int(re.search(rb"(?im)^content-length:\s*(\d+)", http)[1])
    kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha256:")
    page = lambda name: unquote(fields[name].strip("<>").removeprefix(_URN)) if name in fields else None
    if kind == "response" and (len(payload) != told or hashlib.sha256(payload).hexdigest() != digest):
        raise BadPackage(f"the payload of {fields['warc-record-id']} is not the one that was written")
    return kind, page("warc-record-id"), fields.get("warc-target-uri"), page("warc-refers-to"), digest, told, payload if kind == "response" else None


RECORDS = "record_type string, page string, url string, refers_to string, payload_digest string, payload_bytes long, payload binary"


def read_ranges(located: DataFrame) -> DataFrame:
    """The records of all ranges, each range read at once; a response's payload is held against its digest."""
    names = [x.split()[0] for x in RECORDS.split(", ")]
    kinds = [pa.string()] * 5 + [pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, file = None, None
        for b in batches:
            for path, start, lengths in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if path != opened:
                    if file is not None:
                        file.close()
                    files, at = file_at(path)
                    opened, file = path, files.open_input_file(at)
                data = io.BytesIO(file.read_at(sum(lengths), start))
                rows, size = [], 0
                for length in lengths:
                    rows.append(parse(data.read(length)))
                    size += rows[-1][5]
                    if size >= _BATCH_BYTES:
                        yield _records(rows, names, kinds)
                        rows, size = [], 0
                if rows:
                    yield _records(rows, names, kinds)
        if file is not None:
            file.close()

    return located.mapInArrow(run, RECORDS)


def _records(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def read_packages(packages: DataFrame) -> DataFrame:
    """Every record of the packages: RECORDS. Ranges are dealt over the tasks, whatever package they are in.

    Defined cases: pages without an id have the empty ``page``; a revisit has no payload, but the digest and bytes of the full one;
    a package that is cut short, has no stored index, or holds other than what was written fails the job; no package, no rows.
    """
    spark = packages.sparkSession
    size = packages.agg(F.sum("bytes")).first()[0] if "bytes" in packages.columns else None
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil((size or 0) / SHUFFLE_TARGET_BYTES))
    return read_ranges(locate(packages).repartition(n))


def resolve(records: DataFrame) -> DataFrame:
    """The records, revisits with the payload of the response they refer to; however many refer to one."""
    key = lambda page: F.struct(F.col(page).alias("page"), "payload_digest")
    responses = records.where("record_type = 'response'").select(key("page").alias("__key"), F.col("payload").alias("__full"))
    found = join_per_key(records.withColumn("__key", key("refers_to")), responses.dropDuplicates(["__key"]), "__key", "left")
    return found.withColumn("payload", F.coalesce("payload", "__full")).select(*records.columns)
