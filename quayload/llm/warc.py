"""Operator 3: WARC records in ZIP-packaged archives, read by range.

Every Spark task writes archives of its own: stored (uncompressed) ZIP members with
gzipped WARC records, and a stored index member with one line per record. The reader
parses the end record, the ZIP64 records and the central directory from the file's tail,
finds the stored members, reads the index and then only the byte ranges of records;
nothing is extracted. Files are opened through ``pyarrow.fs``, so the shared folder may
be on any file system it knows.

Of records with equal payloads of at least ``least_bytes`` the one with the smallest
identifier is a response; the others are revisits without payload, read back with the
size and digest of the response they refer to. Defined results: null html is an empty
payload; rows that repeat both identifier and payload are judged alike; a null
identifier counts as largest; an empty table gives no archives and no rows; payloads of
any size are written whole; other columns of the input are not read.
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

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayload.llm.registry import llm_query
from quayload.llm.workspace import shuffle_partitions, stage
from quayload.plans.registry import table
from quayload.session import shared_path

#: A member or an archive is closed when it has reached these sizes.
MEMBER_BYTES = 16 << 20
ARCHIVE_BYTES = 512 << 20
#: Records closer than this are fetched by one range read.
GAP_BYTES = 64 << 10
READ_BYTES = 8 << 20
# Fixed value: the profile of revisits by payload digest in the WARC standard.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
RECORD_DATE = "2024-01-01T00:00:00Z"


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ---- writing ------------------------------------------------------------------------------------


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One gzipped WARC record."""
    revisit = refers_to is not None
    block = HTTP_HEAD if revisit else HTTP_HEAD + payload
    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<urn:page:{page_id}>",
        "WARC-Date": RECORD_DATE,
        # A line break would end the header.
        "WARC-Target-URI": " ".join((url or "").split()),
        "WARC-Payload-Digest": f"sha1:{digest}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if revisit:
        head |= {"WARC-Refers-To": f"<urn:page:{refers_to}>", "WARC-Profile": REVISIT_PROFILE}
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()) + "\r\n"
    packer = zlib.compressobj(6, wbits=31)
    return packer.compress(text.encode() + block + b"\r\n\r\n") + packer.flush()


class ArchiveWriter:
    """One ZIP file: members of records, then the index."""

    def __init__(self, folder: str, part: int, force_zip64: bool = False):
        system, path = fs.FileSystem.from_uri(folder)
        system.create_dir(path, recursive=True)
        name = f"archive-{part:05d}-{uuid.uuid4().hex}.wacz"
        self.path = f"{folder}/{name}"
        self.force_zip64 = force_zip64
        self.stream = system.open_output_stream(f"{path}/{name}")
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member, self.members, self.index, self.total = io.BytesIO(), 0, [], 0

    def add(self, page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> None:
        data = record_bytes(page_id, url, payload, digest, refers_to)
        where = {"id": page_id, "member": self._member_name(), "offset": self.member.tell(), "length": len(data)}
        self.index.append(json.dumps(where))
        self.member.write(data)
        if self.member.tell() >= MEMBER_BYTES:
            self._close_member()

    def _member_name(self) -> str:
        return f"archive/data-{self.members:05d}.warc.gz"

    def _put(self, name: str, data: bytes) -> None:
        with self.zip.open(zipfile.ZipInfo(name), "w", force_zip64=self.force_zip64) as out:
            out.write(data)
        self.total += len(data)

    def _close_member(self) -> None:
        if self.member.tell():
            self._put(self._member_name(), self.member.getvalue())
            self.member = io.BytesIO()
            self.members += 1

    def close(self) -> tuple[str, int, int]:
        self._close_member()
        self._put("indexes/index.cdxj", "\n".join(self.index).encode())
        self.zip.close()
        self.stream.close()
        return self.path, len(self.index), self.total


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` (page_id, url, html) below ``folder``; one row per archive: path, records, bytes.

    The files named in the result are whole. A retried task writes files under new names,
    and what it left before is named nowhere.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).select(
        "*", F.sha2("html", 256).alias("_sha"), F.octet_length("html").alias("_bytes")
    )
    firsts = rows.select("page_id", "_sha").groupBy("_sha").agg(F.min("page_id").alias("_first"))
    # Rows of one payload may be many; a plain join lets Spark split them.
    marked = rows.join(firsts, "_sha").select(
        "page_id",
        "url",
        F.when((F.col("_bytes") >= least_bytes) & ~F.col("page_id").eqNullSafe(F.col("_first")), F.col("_first")).alias("refers_to"),
        F.col("html").cast("binary").alias("payload"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        done, writer = [], None
        for batch in batches:
            for page_id, url, refers_to, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                writer = writer or ArchiveWriter(folder, TaskContext.get().partitionId())
                writer.add(page_id, url, payload, payload_digest(payload), refers_to)
                if writer.total + writer.member.tell() >= ARCHIVE_BYTES:
                    done.append(writer.close())
                    writer = None
        if writer:
            done.append(writer.close())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], ["path", "records", "bytes"])

    return marked.mapInArrow(run, "path string, records long, bytes long")


# ---- reading ------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    crc: int
    stored: int
    size: int
    header: int


class ZipRanges:
    """Members of a ZIP file found from its directories, and ranges of stored ones."""

    def __init__(self, file, size: int):
        self.file, self.size = file, size
        self.members = {m.name: m for m in self._directory()}

    def _at(self, start: int, length: int) -> bytes:
        self.file.seek(start)
        data = self.file.read(length)
        if len(data) != length:
            raise ValueError("the archive is cut short")
        return bytes(data)

    def _end(self) -> tuple[int, int, int]:
        """Entries, size and start of the central directory."""
        tail_start = max(0, self.size - 22 - 0xFFFF)
        tail = self._at(tail_start, self.size - tail_start)
        at = len(tail)
        while (at := tail.rfind(b"PK\x05\x06", 0, at)) >= 0:
            if at + 22 <= len(tail) and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail):
                break
        if at < 0:
            raise ValueError("no end record: not a ZIP file")
        entries, size, start = struct.unpack_from("<HII", tail, at + 10)
        locator = tail_start + at - 20
        if 0xFFFF in (entries,) or 0xFFFFFFFF in (size, start):
            signature, _, end64, _ = struct.unpack("<4sIQI", self._at(locator, 20))
            if signature != b"PK\x06\x07":
                raise ValueError("a ZIP64 archive without its locator")
            head = self._at(end64, 56)
            if head[:4] != b"PK\x06\x06":
                raise ValueError("a ZIP64 archive without its end record")
            entries, size, start = struct.unpack_from("<QQQ", head, 32)
        return entries, size, start

    def _directory(self) -> Iterator[Member]:
        entries, size, start = self._end()
        data, at = self._at(start, size), 0
        for _ in range(entries):
            if data[at : at + 4] != b"PK\x01\x02":
                raise ValueError("a broken central directory")
            flags, method, crc, stored, plain, n_name, n_extra, n_note, header = struct.unpack_from("<8xHH4xIIIHHH8xI", data, at)
            name = data[at + 46 : at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
            extra, e = data[at + 46 + n_name : at + 46 + n_name + n_extra], 0
            while e + 4 <= len(extra):
                kind, length = struct.unpack_from("<HH", extra, e)
                if kind == 1:
                    wide = iter(struct.unpack_from(f"<{length // 8}Q", extra, e + 4))
                    plain = next(wide) if plain == 0xFFFFFFFF else plain
                    stored = next(wide) if stored == 0xFFFFFFFF else stored
                    header = next(wide) if header == 0xFFFFFFFF else header
                e += 4 + length
            yield Member(name, method, crc, stored, plain, header)
            at += 46 + n_name + n_extra + n_note

    def start_of(self, name: str) -> int:
        """Where the bytes of a stored member begin; its local header has lengths of its own."""
        member = self.members[name]
        if member.method != 0:
            raise ValueError(f"{name} is compressed: ranges of it cannot be read")
        head = self._at(member.header, 30)
        if head[:4] != b"PK\x03\x04":
            raise ValueError(f"no local header of {name}")
        n_name, n_extra = struct.unpack_from("<HH", head, 26)
        return member.header + 30 + n_name + n_extra

    def read(self, name: str) -> bytes:
        return self._at(self.start_of(name), self.members[name].stored)

    def ranges(self, wanted: list[tuple[int, int]]) -> Iterator[bytes]:
        """The given (start, length) ranges, in order; near ones share a read."""
        i = 0
        while i < len(wanted):
            start, end, j = wanted[i][0], sum(wanted[i]), i + 1
            while j < len(wanted) and 0 <= wanted[j][0] - end <= GAP_BYTES and sum(wanted[j]) - start <= READ_BYTES:
                end, j = sum(wanted[j]), j + 1
            data = self._at(start, end - start)
            for s, length in wanted[i:j]:
                yield data[s - start : s - start + length]
            i = j


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower case) and payload of one gzipped WARC record."""
    plain = zlib.decompress(data, wbits=31)
    head, _, rest = plain.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
    block = rest[: int(fields["content-length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def _page(urn: str | None) -> int | None:
    value = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(value) if value and value != "None" else None


def read_archive(path: str) -> Iterator[tuple[int | None, str, str, str, int | None, bytes | None]]:
    """(page_id, url, record_type, payload_digest, refers_to, payload) of every record of one archive."""
    system, name = fs.FileSystem.from_uri(path)
    with system.open_input_file(name) as file:
        ranges = ZipRanges(file, file.size())
        index = [json.loads(line) for line in ranges.read("indexes/index.cdxj").splitlines()]
        starts = {m: ranges.start_of(m) for m in {x["member"] for x in index}}
        for data in ranges.ranges([(starts[x["member"]] + x["offset"], x["length"]) for x in index]):
            fields, payload = parse_record(data)
            kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
            if kind == "response" and payload_digest(payload) != digest:
                raise ValueError(f"a payload in {path} does not match its digest")
            own = payload if kind == "response" else None
            yield _page(fields["warc-record-id"]), fields["warc-target-uri"], kind, digest, _page(fields.get("warc-refers-to")), own


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """Every record of the archives in column ``path``: one row per record, with its payload if asked for."""
    names = ["page_id", "url", "record_type", "payload_digest", "refers_to", "own_bytes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                for record in read_archive(path):
                    *meta, payload = record
                    rows.append((*meta, None if payload is None else len(payload), payload))
                    held += len(payload or b"")
                    if held >= READ_BYTES or len(rows) >= 10_000:
                        yield pack_rows(rows)
                        rows, held = [], 0
                if rows:
                    yield pack_rows(rows)

    def pack_rows(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        last = 7 if payloads else 6
        return pa.RecordBatch.from_arrays(columns[:last], (names + ["payload"])[:last])

    schema = "page_id long, url string, record_type string, payload_digest string, refers_to long, own_bytes long"
    spread = archives.select("path").repartition(shuffle_partitions(archives.sparkSession))
    return spread.mapInArrow(run, schema + ", payload binary" * payloads)


def resolve(records: DataFrame) -> DataFrame:
    """Records with ``payload_bytes``; a revisit has that of the response it refers to."""
    responses = (
        records.where("record_type = 'response'")
        .groupBy(F.col("page_id").alias("_id"), F.col("payload_digest").alias("_digest"))
        .agg(F.max("own_bytes").alias("_bytes"))
    )
    joined = records.join(
        responses, (F.col("refers_to") == F.col("_id")) & (F.col("payload_digest") == F.col("_digest")), "left"
    )
    return joined.withColumn("payload_bytes", F.coalesce("own_bytes", "_bytes")).drop("_id", "_digest", "_bytes", "own_bytes")


@llm_query("op3_warc")
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_path(spark, "warc")
    archives = stage(write_archives(table(spark, sf_dir, "pages"), folder), "warc-list")
    records = stage(read_archives(archives, payloads=False), "warc-records")
    return resolve(records).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
