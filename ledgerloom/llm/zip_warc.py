"""WARC records in ZIP packages: written by tasks, read back by byte ranges without extraction.

A package is a ZIP file whose members are stored, not deflated: ``archive/data.warc.gz`` (one gzip member per
record) and ``indexes/index.cdx`` (one line per record: offset, length, page). The reader asks a package's file
for ranges only: the end record, the ZIP64 locator and end record if they are there, the central directory, each
member's local header (the data begins behind it), the index, and then each record by its offset inside
the archive member. Entries with ZIP64 extra fields and archives behind a preface or before a comment are read too.

Payloads that occur more than once are found from narrow rows (id, digest, size); only repeated ones meet the pages
again, by page_id, so a payload shared by a third of all pages makes no heavy group. Tasks write packages of about
``PACKAGE_BYTES`` under names of their own and list them in a table; a lost or repeated task leaves at most
unlisted files, and only listed packages are read. Files are opened through pyarrow's file systems, by the
scheme of ``spark.checkpoint.dir``.

Defined results: a null html is an empty payload; payloads below ``MIN_REVISIT_BYTES`` are always responses; rows that
repeat page_id and payload are written each, all with the same verdict. A null page_id is never
referred to unless all equal payloads have none, and then refers_to is null. An empty table gives no packages.
"""

from __future__ import annotations

import gzip
import struct
import uuid
import zlib
from collections.abc import Iterator
from hashlib import sha1

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.staging import new_folder, staged

MIN_REVISIT_BYTES = 1000
PACKAGE_BYTES = 8 << 20
ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
_DATE = "2024-01-01T00:00:00Z"

# ZIP structures, by the public format description (little endian).
_LOCAL = struct.Struct("<4s5H3I2H")
_CENTRAL = struct.Struct("<4s6H3I5H2I")
_END = struct.Struct("<4s4H2IH")
_END64 = struct.Struct("<4sQ2H2I4Q")
_LOCATOR = struct.Struct("<4sIQI")
_FULL16, _FULL32 = 0xFFFF, 0xFFFFFFFF


# ---- WARC records -------------------------------------------------------------------------------


def _target(url: str | None) -> str:
    return "".join(c if c > " " else f"%{ord(c):02X}" for c in url or "")


def warc_record(page: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record: a response with its payload, or a revisit that names the response and keeps the payload's length."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:page:{page}>"),
        ("WARC-Date", _DATE),
        ("WARC-Target-URI", _target(url)),
        ("WARC-Payload-Digest", f"sha1:{sha1(payload).hexdigest()}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if revisit:
        fields.insert(5, ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        fields.insert(6, ("WARC-Refers-To", f"<urn:page:{refers_to}>"))
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def _headers(lines: bytes) -> dict[str, str]:
    pairs = (line.partition(b":") for line in lines.split(b"\r\n")[1:] if line)
    return {k.decode().strip().lower(): v.decode().strip() for k, _, v in pairs}


def _page(urn: str) -> int | None:
    number = urn.strip("<>").rpartition(":")[2]
    return None if number == "None" else int(number)


def parse_record(data: bytes) -> dict:
    """The fields of one WARC record and, for a response, its payload."""
    if not data.startswith(b"WARC/1."):
        raise ValueError("not a WARC record")
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _headers(head)
    length = int(fields["content-length"])
    block, tail = rest[:length], rest[length:]
    if len(block) != length or tail != b"\r\n\r\n":
        raise ValueError("record is cut short")
    http, _, payload = block.partition(b"\r\n\r\n")
    response = fields["warc-type"] == "response"
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    if response and sha1(payload).hexdigest() != digest:
        raise ValueError("payload does not fit its digest")
    return {
        "page_id": _page(fields["warc-record-id"]),
        "payload_bytes": len(payload) if response else int(_headers(http)["content-length"]),
        "payload_digest": digest,
        "record_type": fields["warc-type"],
        "refers_to": None if response else _page(fields["warc-refers-to"]),
        "url": fields["warc-target-uri"],
        "payload": payload if response else None,
    }


# ---- ZIP packages -------------------------------------------------------------------------------


def zip_package(members: list[tuple[str, bytes]], zip64: bool = False) -> bytes:
    """A ZIP file of stored members; ``zip64`` forces the 64-bit fields that large packages need."""
    out, directory = bytearray(), bytearray()
    for name, data in members:
        at, crc, encoded = len(out), zlib.crc32(data), name.encode()
        wide = zip64 or max(len(data), at) >= _FULL32
        size, place = (_FULL32, _FULL32) if wide else (len(data), at)
        local = struct.pack("<2H2Q", 1, 16, len(data), len(data)) if wide else b""
        central = struct.pack("<2H3Q", 1, 24, len(data), len(data), at) if wide else b""
        version = 45 if wide else 20
        out += _LOCAL.pack(b"PK\x03\x04", version, 0x800, 0, 0, 33, crc, size, size, len(encoded), len(local)) + encoded + local + data
        directory += _CENTRAL.pack(b"PK\x01\x02", version, version, 0x800, 0, 0, 33, crc, size, size, len(encoded), len(central), 0, 0, 0, 0, place)
        directory += encoded + central
    at, count = len(out), len(members)
    out += directory
    wide = zip64 or at >= _FULL32 or count >= _FULL16
    if wide:
        end64 = len(out)
        out += _END64.pack(b"PK\x06\x06", _END64.size - 12, 45, 45, 0, 0, count, count, len(directory), at)
        out += _LOCATOR.pack(b"PK\x06\x07", 0, end64, 1)
        out += _END.pack(b"PK\x05\x06", 0, 0, _FULL16, _FULL16, _FULL32, _FULL32, 0)
    else:
        out += _END.pack(b"PK\x05\x06", 0, 0, count, count, len(directory), at, 0)
    return bytes(out)


class ZipRanges:
    """Stored members of a ZIP file, located through its directories. ``read(offset, length)`` gives bytes of the file."""

    def __init__(self, read, size: int):
        self.read = read
        self.members = dict(self._directory(size))

    def _directory(self, size: int) -> Iterator[tuple[str, tuple[int, int]]]:
        tail_at = max(0, size - _END.size - _FULL16)
        tail = self.read(tail_at, size - tail_at)
        at = tail.rfind(b"PK\x05\x06")
        while at >= 0:  # a comment may hold the signature too; the right one's comment ends with the file
            if at + _END.size <= len(tail) and at + _END.size + _END.unpack_from(tail, at)[7] == len(tail):
                break
            at = tail.rfind(b"PK\x05\x06", 0, at)
        if at < 0:
            raise ValueError("no end of central directory")
        *_, count, length, start, _ = _END.unpack_from(tail, at)
        end_of_directory = tail_at + at
        locator_at = end_of_directory - _LOCATOR.size
        if locator_at >= 0 and (count == _FULL16 or length == _FULL32 or start == _FULL32):
            signature, _, end64_at, _ = _LOCATOR.unpack(self.read(locator_at, _LOCATOR.size))
            if signature == b"PK\x06\x07":
                guess = locator_at - _END64.size  # right also behind a preface, where stored offsets are short
                record = self.read(guess, _END64.size) if guess >= 0 else b""
                if not record.startswith(b"PK\x06\x06"):
                    guess, record = end64_at, self.read(end64_at, _END64.size)
                *_, count, length, start = _END64.unpack(record)
                end_of_directory = guess
        preface = end_of_directory - length - start
        if preface < 0:
            raise ValueError("central directory lies outside the file")
        directory = self.read(start + preface, length)
        at = 0
        for _ in range(count):
            (signature, _, _, flags, method, _, _, _, packed, plain, name, extra, comment, _, _, _, place) = _CENTRAL.unpack_from(directory, at)
            if signature != b"PK\x01\x02":
                raise ValueError("damaged central directory")
            at += _CENTRAL.size
            title = directory[at : at + name].decode("utf-8" if flags & 0x800 else "cp437")
            plain, packed, place = self._wide(directory[at + name : at + name + extra], plain, packed, place)
            at += name + extra + comment
            if method == 0 and not flags & 1:
                yield title, (place + preface, packed)

    @staticmethod
    def _wide(extra: bytes, plain: int, packed: int, place: int) -> tuple[int, int, int]:
        at = 0
        while at + 4 <= len(extra):
            kind, length = struct.unpack_from("<2H", extra, at)
            if kind == 1:
                values = iter(struct.unpack_from(f"<{length // 8}Q", extra, at + 4))
                plain, packed, place = (next(values) if v == _FULL32 else v for v in (plain, packed, place))
            at += 4 + length
        return plain, packed, place

    def begin(self, name: str) -> tuple[int, int]:
        """Where a member's data begins in the file, and its length."""
        place, length = self.members[name]
        header = _LOCAL.unpack(self.read(place, _LOCAL.size))
        if header[0] != b"PK\x03\x04":
            raise ValueError("no local header where the directory points")
        return place + _LOCAL.size + header[9] + header[10], length


# ---- tasks --------------------------------------------------------------------------------------


def _open_folder(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def _write_packages(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _open_folder(folder)
        archive, index, count = bytearray(), [], 0

        def close() -> pa.RecordBatch:
            nonlocal archive, index, count
            name = f"{base}/{uuid.uuid4().hex}.wacz"
            content = zip_package([(ARCHIVE, bytes(archive)), (INDEX, "".join(index).encode())])
            system.create_dir(base, recursive=True)
            with system.open_output_stream(name) as out:
                out.write(content)
            row = pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(content)]), pa.array([count])], ["package", "bytes", "records"])
            archive, index, count = bytearray(), [], 0
            return row

        for batch in batches:
            for page, url, html, refers_to, revisit in zip(*(batch.column(c) for c in range(5))):
                page = page.as_py()
                payload = html.as_buffer().to_pybytes() if html.is_valid else b""
                record = gzip.compress(warc_record(page, url.as_py(), payload, refers_to.as_py(), revisit.as_py()), 3, mtime=0)
                index.append(f"{len(archive)} {len(record)} {page}\n")
                archive += record
                count += 1
                if len(archive) >= PACKAGE_BYTES:
                    yield close()
        if count:
            yield close()

    return run


def _read_packages(folder: str, with_payload: bool):
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["url", "payload"] * with_payload
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()] + [pa.string(), pa.binary()] * with_payload

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = _open_folder(folder)
        for batch in batches:
            for name, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with system.open_input_file(name) as file:
                    package = ZipRanges(lambda offset, length, file=file: file.read_at(length, offset), size)
                    start, _ = package.begin(ARCHIVE)
                    index_at, index_length = package.begin(INDEX)
                    lines = package.read(index_at, index_length).decode().splitlines()
                    for at in range(0, len(lines), 500):
                        records = []
                        for line in lines[at : at + 500]:
                            offset, length, _ = line.split(" ")
                            records.append(parse_record(gzip.decompress(package.read(start + int(offset), int(length)))))
                        yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in records], t) for n, t in zip(names, types)], names)

    return run


def write_archives(pages: DataFrame) -> tuple[DataFrame, str]:
    """Write every page as a WARC record; gives the table of packages (package, bytes, records) and their folder."""
    spark = pages.sparkSession
    html = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    narrow = pages.select(F.col("page_id").cast("long").alias("page_id"), F.sha1(html).alias("digest"), F.octet_length(html).alias("size"))
    narrow = narrow.where(F.col("size") >= MIN_REVISIT_BYTES)
    repeated = narrow.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("times")).where("times > 1")
    repeated = staged(repeated.select("digest", "refers_to"), "payloads")
    revisits = narrow.join(repeated, "digest").where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
    revisits = revisits.select(F.col("page_id").alias("again_id"), F.col("digest").alias("again_digest"), "refers_to").distinct()
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"))
    same = F.col("page_id").eqNullSafe(F.col("again_id")) & (F.sha1("html") == F.col("again_digest"))
    rows = rows.join(revisits, same, "left").select("page_id", "url", "html", "refers_to", F.col("again_digest").isNotNull().alias("revisit"))
    folder = new_folder(spark, "packages")
    return staged(rows.mapInArrow(_write_packages(folder), "package string, bytes long, records long"), "package-list"), folder


def read_archives(packages: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to[, url, payload]) of every record in the packages."""
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    schema += ", url string, payload binary" * with_payload
    spread = packages.repartition(packages.sparkSession.sparkContext.defaultParallelism * 4, "package")
    return spread.select("package", "bytes").mapInArrow(_read_packages(folder, with_payload), schema)


def archived(pages: DataFrame) -> DataFrame:
    """Write the pages to packages and give back what the packages hold."""
    return read_archives(*write_archives(pages))
