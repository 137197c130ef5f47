"""WARC files as a Spark data source in Python: planned file ranges, pushed filters, headers first, payloads on demand.

Files hold one gzip member per record. A member written here carries its compressed size in the gzip header (the ``sl``
field of the WARC standard), so a reader that has seen the WARC headers of an unwanted record jumps over the
rest without inflating it. Members without that field are inflated and thrown away.
"""

from __future__ import annotations

import base64
import datetime
import struct
import uuid
import warnings
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, IsNull, StringStartsWith, WriterCommitMessage,
)

from tallyforge.llm.storage import prepare

#: Bytes of one range to read, of one file to write, and of one batch to hand on.
RANGE_BYTES, FILE_BYTES, BATCH_BYTES = 32 << 20, 128 << 20, 4 << 20
#: WARC header of each column that a filter can be pushed to.
HEADERS = {
    "record_id": "warc-record-id", "warc_type": "warc-type", "target_uri": "warc-target-uri",
    "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to", "content_type": "content-type",
}
SCHEMA = (
    "record_id string, warc_type string, target_uri string, payload_digest string, refers_to string, content_type string, "
    "content_length long, payload_length long, headers map<string,string>, payload binary"
)
_ARROW = pa.schema([
    *((name, pa.string()) for name in HEADERS), ("content_length", pa.int64()), ("payload_length", pa.int64()),
    ("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary()),
])
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_MAGIC = b"\x1f\x8b\x08"


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def member(record: bytes, level: int = 1) -> bytes:
    """One gzip member with its sizes in the header; sizes beyond 32 bits leave the field out."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(record) + deflate.flush()
    tail = struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)
    size = 10 + 2 + 12 + len(body) + 8
    if max(size, len(record)) >= 1 << 32:
        return _MAGIC + b"\0\0\0\0\0\0\xff" + body + tail
    return _MAGIC + b"\x04\0\0\0\0\0\xff" + struct.pack("<H2sHII", 12, b"sl", 8, size, len(record)) + body + tail


def record_bytes(headers: dict[str, str], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers.items() if v is not None)
    return f"WARC/1.1\r\n{lines}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def _clean(value: str | None) -> str | None:
    """Header values hold no line breaks."""
    return None if value is None else value.replace("\r", "%0D").replace("\n", "%0A")


@dataclass
class _Written(WriterCommitMessage):
    names: list[str]


class WarcWriter(DataSourceArrowWriter):
    """Files get their final names when all tasks have succeeded; what failed tasks leave starts with an underscore."""

    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        system, root = _open(self.path)
        system.create_dir(root, recursive=True)
        names, out, size = [], None, 0
        now = datetime.datetime.now(datetime.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None or size >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    names.append(f"{uuid.uuid4().hex}.warc.gz")
                    out, size = system.open_output_stream(f"{root}/_{names[-1]}", compression=None), 0
                    info = {"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": now, "Content-Type": "application/warc-fields"}
                    size += out.write(member(record_bytes(info, b"format: WARC File Format 1.1\r\n")))
                size += out.write(member(self.record(row, now)))
        if out is not None:
            out.close()
        return _Written(names)

    @staticmethod
    def record(row: dict, now: str) -> bytes:
        """A response with its payload, or a revisit whose HTTP head still tells the payload's length."""
        kind, payload = row["warc_type"], row.get("payload") or b""
        digest = row.get("payload_digest")
        headers = {
            "WARC-Type": kind, "WARC-Record-ID": f"<{_clean(row['record_id'])}>", "WARC-Date": now, "WARC-Target-URI": _clean(row.get("target_uri")),
            "WARC-Payload-Digest": None if digest is None else "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(),
            "Content-Type": "application/http; msgtype=response",
        }
        length = row.get("payload_length")
        if kind == "revisit":
            headers["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
            headers["WARC-Refers-To"] = f"<{_clean(row['refers_to'])}>"
            payload = b""
        head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload) if length is None else length}\r\n\r\n"
        return record_bytes(headers, head.encode() + payload)

    def commit(self, messages) -> None:
        system, root = _open(self.path)
        system.create_dir(root, recursive=True)
        if self.overwrite:
            for old in system.get_file_info(fs.FileSelector(root)):
                if old.is_file and not old.base_name.startswith("_"):
                    system.delete_file(old.path)
        for message in messages:
            for name in message.names if message is not None else []:
                system.move(f"{root}/_{name}", f"{root}/{name}")

    def abort(self, messages) -> None:
        system, root = _open(self.path)
        for message in messages:
            for name in message.names if message is not None else []:
                system.delete_file(f"{root}/_{name}")


@dataclass
class _Range(InputPartition):
    """Records whose members start in ``start`` to ``end`` of a file."""

    path: str
    start: int
    end: int


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: bool, skip_damaged: bool = False):
        self.path, self.payload, self.skip_damaged, self.tests = path, payload, skip_damaged, []

    def pushFilters(self, filters: list[Filter]):
        """Tests on header columns are made before a record is inflated; the others go back to Spark."""
        for test in filters:
            column = test.attribute[0] if len(getattr(test, "attribute", ())) == 1 else None
            if column in HEADERS and isinstance(test, (EqualTo, In, StringStartsWith, IsNotNull, IsNull)):
                self.tests.append(test)
            else:
                yield test

    def partitions(self) -> list[InputPartition]:
        system, root = _open(self.path)
        info = system.get_file_info(root)
        if info.type == fs.FileType.NotFound:
            return []
        files = [info] if info.is_file else system.get_file_info(fs.FileSelector(root, recursive=True))
        found = []
        for file in sorted(files, key=lambda f: f.path):
            if file.is_file and not file.base_name.startswith(("_", ".")) and file.base_name.endswith(".warc.gz"):
                found += [_Range(file.path, a, min(a + RANGE_BYTES, file.size)) for a in range(0, file.size, RANGE_BYTES)]
        return found

    def wanted(self, headers: dict[str, str]) -> bool:
        for test in self.tests:
            value = _plain(headers.get(HEADERS[test.attribute[0]]))
            if isinstance(test, IsNull):
                good = value is None
            elif isinstance(test, IsNotNull):
                good = value is not None
            elif isinstance(test, EqualTo):
                good = value is not None and value == test.value
            elif isinstance(test, In):
                good = value is not None and value in test.value
            else:
                good = value is not None and value.startswith(test.value)
            if not good:
                return False
        return True

    def read(self, partition: _Range | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # Spark reads one empty partition where none is planned
            return
        system, _ = _open(self.path)
        rows, size = [], 0
        with system.open_input_file(partition.path) as file:
            for headers, block in records(file, partition.start, partition.end, self.wanted, self.payload, self.skip_damaged):
                row = _row(headers, block, self.payload)
                rows.append(row)
                size += len(row["payload"] or b"") + 500
                if size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)


def _plain(value: str | None) -> str | None:
    return value[1:-1] if value and value[0] == "<" and value[-1] == ">" else value


def _row(headers: dict[str, str], block: bytes, payload: bool) -> dict:
    row: dict = {name: _plain(headers.get(header)) for name, header in HEADERS.items()}
    body, length = block, None
    if (row["content_type"] or "").startswith("application/http"):
        head, _, body = block.partition(b"\r\n\r\n")
        for line in head.split(b"\r\n")[1:]:
            name, _, value = line.partition(b":")
            if name.strip().lower() == b"content-length" and value.strip().isdigit():
                length = int(value)
    content = int(headers.get("content-length", 0))
    return row | {"content_length": content, "payload_length": content if length is None else length, "headers": list(headers.items()), "payload": body if payload else None}


def _starts_record(file, at: int) -> bool:
    """Whether a gzip member with a WARC record starts here; the magic bytes alone may occur inside one."""
    file.seek(at)
    try:
        return zlib.decompressobj(31).decompress(file.read(1024), 5) == b"WARC/"
    except zlib.error:
        return False


def _first_member(file, start: int, end: int) -> int | None:
    """Offset of the first member at or after ``start`` and before ``end``."""
    if start == 0:
        return 0
    at = start
    while at < end:
        file.seek(at)
        piece = file.read(1 << 16)
        if not piece:
            return None
        k = piece.find(_MAGIC)
        while k >= 0:
            if at + k >= end:
                return None
            if _starts_record(file, at + k):
                return at + k
            k = piece.find(_MAGIC, k + 1)
        at += max(1, len(piece) - len(_MAGIC) + 1)
    return None


class Damage(ValueError):
    """A record that cannot be read whole."""


def _record(file, at: int, wanted, payload: bool) -> tuple[dict[str, str] | None, bytes, int]:
    """Headers (None where the record is not wanted) and block of the record at ``at``, and where the next one starts."""
    file.seek(at)
    piece, size, skip = file.read(1 << 14), file.size(), 0
    if len(piece) >= 24 and piece[3] == 4 and piece[12:14] == b"sl":
        skip = struct.unpack_from("<I", piece, 16)[0]
        if at + skip > size:
            raise Damage("the file ends within it")
    inflate, out = zlib.decompressobj(31), bytearray()

    def more(limit: int) -> bool:
        """Inflate up to ``limit`` more bytes."""
        nonlocal piece
        if not piece and not inflate.unconsumed_tail:
            piece = file.read(1 << 16)
        got = inflate.decompress(inflate.unconsumed_tail or piece, limit)
        piece = b""
        out.extend(got)
        return not inflate.eof and (bool(got) or bool(inflate.unconsumed_tail) or bool(piece := file.read(1 << 16)))

    try:
        going = True
        while (split := out.find(b"\r\n\r\n")) < 0 and going:
            going = more(1 << 12)
        if split < 0:
            raise Damage("its headers do not end")
        headers = {}
        for line in bytes(out[:split]).decode("utf-8", "replace").split("\r\n")[1:]:
            name, _, value = line.partition(":")
            headers[name.strip().lower()] = value.strip()
        if not headers.get("content-length", "0").isdigit():
            raise Damage("its length is no number")
        length, first = int(headers.get("content-length", 0)), split + 4
        take = wanted(headers)
        if take and payload:
            while len(out) < first + length and more(1 << 20):
                pass
            if len(out) < first + length:
                raise Damage(f"it has {len(out) - first} of {length} bytes")
        elif take and headers.get("content-type", "").startswith("application/http"):
            while out.find(b"\r\n\r\n", first) < 0 and len(out) < first + length and more(1 << 12):
                pass
        block = bytes(out[first : first + length]) if take else b""
        if skip:
            return headers if take else None, block, at + skip
        while not inflate.eof and more(1 << 20):
            out.clear()
        if not inflate.eof:
            raise Damage("the file ends within it")
        return headers if take else None, block, file.tell() - len(inflate.unused_data)
    except zlib.error as error:
        raise Damage(f"it does not inflate: {error}") from error


def records(file, start: int, end: int, wanted, payload: bool = True, skip_damaged: bool = False) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and block of the wanted records whose members start in the range.

    Without ``payload`` only the head of the block is inflated. A record that is cut off, does not inflate, has no end of its headers or
    fewer bytes than it names raises ``Damage`` with its place; with ``skip_damaged`` it is left out with a warning, and
    reading goes on at the next member that starts a record. What is not read of an unwanted record is not checked.
    """
    at = _first_member(file, start, end)
    while at is not None and at < end:
        try:
            headers, block, following = _record(file, at, wanted, payload)
        except Damage as error:
            if not skip_damaged:
                raise Damage(f"The record at byte {at} is damaged: {error}.") from error
            warnings.warn(f"The record at byte {at} is left out: {error}.", stacklevel=2)
            at = _first_member(file, at + 1, end)
            continue
        if headers is not None:
            yield headers, block
        at = following


class WarcSource(DataSource):
    """Options: ``path``; ``payload`` ``false`` leaves payloads undecoded (the column is then NULL); ``damaged`` ``skip`` leaves out
    records that cannot be read whole, which are an error otherwise. Paths are those that Arrow's file systems know."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("payload", "true").lower() != "false", self.options.get("damaged", "fail") == "skip")

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], overwrite)


def register(spark: SparkSession) -> None:
    prepare(spark)
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_warc(spark: SparkSession, path: str, payload: bool = True, damaged: str = "fail") -> DataFrame:
    """Records below ``path``; no file gives an empty table. Filters on the columns of HEADERS reach the reader.

    A damaged record fails the job, or is left out when ``damaged`` is ``skip``.
    """
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).option("damaged", damaged).load(path)


def base32_hex(digest: Column) -> Column:
    """Bare lower-case hex of a base-32 digest: each four characters are five hex digits."""
    values = F.transform(F.split(digest, ""), lambda c: F.when(c == "", None).otherwise(F.instr(F.lit(_BASE32), c) - 1))
    bits = F.array_join(F.transform(F.filter(values, lambda v: v.isNotNull()), lambda v: F.lpad(F.bin(v), 5, "0")), "")
    groups = F.transform(F.sequence(F.lit(0), (F.length(bits) / 20).cast("int") - 1), lambda i: F.lower(F.lpad(F.conv(F.substring(bits, i * 20 + 1, F.lit(20)), 2, 16), 5, "0")))
    return F.array_join(groups, "")


def page_records(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html", least: int = 1000) -> DataFrame:
    """A record per page: the payload is the page in UTF-8, NULL counts as empty.

    Of pages with equal payloads of ``least`` bytes or more that with the largest id is a response and the others
    revisit it; rows that share this id are all responses, as are pages without id and shorter ones.
    """
    payload = F.coalesce(F.col(html_column), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_column).cast("long").alias("id"), F.col(url_column).alias("target_uri"), payload.alias("payload"))
    rows = rows.withColumns({"payload_digest": F.sha1("payload"), "payload_length": F.octet_length("payload").cast("long")})
    shared = rows.where(F.col("payload_length") >= least).groupBy(F.col("payload_digest").alias("digest")).agg(F.max("id").alias("first"), F.count("id").alias("n")).where("n > 1")
    joined = rows.join(shared, (F.col("payload_digest") == F.col("digest")) & (F.col("payload_length") >= least), "left")
    again = F.coalesce(F.col("id") < F.col("first"), F.lit(False))
    name = lambda c: F.concat(F.lit("urn:x-page:"), F.coalesce(F.col(c).cast("string"), F.lit("none")))
    return joined.select(
        name("id").alias("record_id"), F.when(again, "revisit").otherwise("response").alias("warc_type"), "target_uri", "payload_digest",
        F.when(again, name("first")).alias("refers_to"), "payload_length", F.when(~again, F.col("payload")).alias("payload"),
    )


def write_warc(recorded: DataFrame, path: str) -> None:
    """Write records (see ``page_records``) as WARC files below ``path``."""
    register(recorded.sparkSession)
    recorded.write.format("warc").mode("append").save(path)
