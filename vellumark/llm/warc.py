"""WARC archives as a Python data source.

Writing: each task appends gzip members, one per record, to files of bounded
size; a member's extra field holds its compressed length, so a reader can jump over
it. The commit lists the files of the tasks that succeeded in a manifest, so files
of lost attempts are never read.

Reading: one partition per run of files. Equality and IN filters on
``record_type`` and the other header columns are pushed down. The reader inflates the
header block of a record first and leaves the payload compressed when a filter rejects
the record or no payload column is wanted (option ``payload``).

Archives of other writers are read, too: plain ones and gzip without length fields, of a folder without
manifest or a single file; their payload is the record's whole block. Checksums of records whose payload is read
are verified. Header values that a line cannot hold are percent-quoted, and a header of our own
names the columns for which this was done; all others are written and read as they are.

Columns: record_type, record_id, target_uri, refers_to, payload_digest,
payload_length (as the headers say) and payload (null for revisits). Null header
values are not written. Null payloads are empty. A row without an id gets a random one in the file and is read back without.
"""

from __future__ import annotations

import gzip
import io
import json
import struct
import urllib.parse
import uuid
import zlib
from dataclasses import dataclass
from datetime import UTC, datetime

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, In, InputPartition, WriterCommitMessage
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from ..session import new_path
from .common import prepare

MANIFEST = "_manifest.json"
FILE_BYTES = 256 << 20
GZIP_LEVEL = 1
MIN_REVISIT_BYTES = 100

SCHEMA = StructType(
    [
        StructField("record_type", StringType()),
        StructField("record_id", StringType()),
        StructField("target_uri", StringType()),
        StructField("refers_to", StringType()),
        StructField("payload_digest", StringType()),
        StructField("payload_length", LongType()),
        StructField("payload", BinaryType()),
    ]
)
# Header names of the format, by column.
HEADERS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
    "payload_length": "X-Payload-Length",
}
_COLUMN = {header.lower(): column for column, header in HEADERS.items()}
_ARROW = pa.schema(
    [(f.name, {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}[f.dataType.simpleString()]) for f in SCHEMA]
)


def _store(path: str) -> tuple[fs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


# Forms of the format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID, _NO_ID, _DIGEST = "<urn:x-record:", "<urn:x-no-record:", "sha256:"
_ESCAPED = "X-Escaped"
_READ_AHEAD = 4096


def _header_lines(values: dict) -> list[str]:
    lines, escaped = ["WARC/1.1", f"WARC-Date: {datetime.now(UTC):%Y-%m-%dT%H:%M:%SZ}"], []
    for column, header in HEADERS.items():
        value = values.get(column)
        if value is None:
            if column == "record_id":
                lines.append(f"{header}: {_NO_ID}{uuid.uuid4()}>")
            continue
        text = str(value)
        if text != text.strip() or not text or any(c < " " or c in "\x7f\x85\u2028\u2029" for c in text):
            text = urllib.parse.quote(text, safe="")
            escaped.append(column)
        if column in ("record_id", "refers_to"):
            text = f"{_ID}{text}>"
        elif column == "payload_digest":
            text = _DIGEST + text
        lines.append(f"{header}: {text}")
    if values.get("record_type") == "revisit":
        lines.append(f"WARC-Profile: {REVISIT_PROFILE}")
    if escaped:
        lines.append(f"{_ESCAPED}: {','.join(escaped)}")
    return lines


def record_bytes(values: dict, payload: bytes) -> bytes:
    """A gzip member with one record; ``values`` by column name."""
    head = ("\r\n".join([*_header_lines(values), f"Content-Length: {len(payload)}"]) + "\r\n\r\n").encode()
    packer = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, -15)
    # A full flush after the headers lets a reader inflate them alone.
    body = packer.compress(head) + packer.flush(zlib.Z_FULL_FLUSH) + packer.compress(payload + b"\r\n\r\n") + packer.flush()
    size = 10 + 2 + 8 + len(body) + 8
    extra = b"SL" + struct.pack("<HI", 4, size)
    raw = head + payload + b"\r\n\r\n"
    start = b"\x1f\x8b\x08\x04" + struct.pack("<IBB", 0, 0, 255) + struct.pack("<H", len(extra)) + extra
    return start + body + struct.pack("<II", zlib.crc32(raw), len(raw) & 0xFFFFFFFF)


def _row(head: bytes) -> tuple[dict, int]:
    """Columns of a header block, without the payload, and the length of the record's block."""
    values, name = {}, ""
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t"):  # a folded line
            values[name] = f"{values.get(name, '')} {line.strip()}"
            continue
        name, _, value = line.partition(":")
        name = name.strip().lower()
        values[name] = value.strip(" \t")
    row = {column: values.get(header) for header, column in _COLUMN.items()}
    if (row["record_id"] or "").startswith(_NO_ID):
        row["record_id"] = None
    for column in ("record_id", "refers_to"):
        if (row[column] or "").startswith(_ID):
            row[column] = row[column][len(_ID) : -1]
    row["payload_digest"] = row["payload_digest"] and row["payload_digest"].removeprefix(_DIGEST)
    for column in filter(None, values.get(_ESCAPED.lower(), "").split(",")):
        row[column] = urllib.parse.unquote(row[column])
    length = int(values["content-length"])
    row["payload_length"] = length if row["payload_length"] is None else int(row["payload_length"])
    return row, length


def _block(out: bytes, length: int) -> bytes:
    if len(out) < length:
        raise ValueError("A record is shorter than its Content-Length.")
    return out[:length]


def read_records(file, wanted: dict[str, set], payload: bool):
    """Column values of the records that match ``wanted`` (column -> allowed values), from an open file that can seek."""

    def chosen(row):
        """Whether the record is wanted at all, and with its payload."""
        fits = all(row[column] in allowed for column, allowed in wanted.items())
        return fits, fits and payload and row["record_type"] != "revisit"

    while True:
        begin = file.tell()
        start = file.read(20)
        if not start:
            return
        if len(start) < 20 or start[:4] != b"\x1f\x8b\x08\x04" or start[12:14] != b"SL":
            file.seek(begin)
            yield from _foreign_records(gzip.GzipFile(fileobj=file) if start[:2] == b"\x1f\x8b" else file, chosen)
            return
        size = struct.unpack("<I", start[16:20])[0]
        inflater, out, left = zlib.decompressobj(-15), b"", size - 20
        while (end := out.find(b"\r\n\r\n")) < 0:
            part = file.read(min(left, _READ_AHEAD))
            if not part:
                raise ValueError("A record ends within its headers.")
            left -= len(part)
            out += inflater.decompress(part)
        row, length = _row(out[:end])
        fits, full = chosen(row)
        row["payload"] = None
        if full:
            out += inflater.decompress(file.read(left)) + inflater.flush()
            if inflater.unused_data != struct.pack("<II", zlib.crc32(out), len(out) & 0xFFFFFFFF):
                raise ValueError("The checksum of a record is wrong.")
            row["payload"] = _block(out[end + 4 :], length)
        else:
            # Payloads that nobody wants are neither read nor inflated.
            file.seek(begin + size)
        if fits:
            yield row


def _foreign_records(file, chosen):
    """The same from records one after the other, plain or as gzip inflates them."""
    while line := file.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("A record does not begin with the name of the format.")
        head = [line.rstrip(b"\r\n")]
        while (line := file.readline()).strip():
            head.append(line.rstrip(b"\r\n"))
        row, length = _row(b"\r\n".join(head))
        fits, full = chosen(row)
        row["payload"] = None
        if full:
            row["payload"] = _block(file.read(length), length)
        else:
            file.seek(length, io.SEEK_CUR)
        if fits:
            yield row


class FileRun(InputPartition):
    def __init__(self, paths: list[str]):
        super().__init__(paths)
        self.paths = paths


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")
        self.payload = options.get("payload", "true").lower() == "true"
        self.files = int(options.get("filesPerPartition", "1"))
        self.wanted: dict[str, set] = {}

    def pushFilters(self, filters):
        for f in filters:
            column = f.attribute[0] if isinstance(f, EqualTo | In) and len(f.attribute) == 1 else None
            if column in HEADERS and column is not None:
                allowed = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted[column] = self.wanted.get(column, allowed) & allowed
            else:
                yield f

    def partitions(self):
        store, base = _store(self.path)
        if store.get_file_info(f"{base}/{MANIFEST}").type == fs.FileType.File:
            with store.open_input_stream(f"{base}/{MANIFEST}", compression=None) as file:
                names = [f"{base}/{name}" for name in json.loads(file.read())]
        elif store.get_file_info(base).type == fs.FileType.File:
            names = [base]
        else:
            names = sorted(f.path for f in store.get_file_info(fs.FileSelector(base)) if f.path.endswith((".warc", ".warc.gz")))
        return [FileRun(names[i : i + self.files]) for i in range(0, len(names), self.files)] or [FileRun([])]

    def read(self, partition):
        store, _ = _store(self.path)
        for name in partition.paths:
            with io.BufferedReader(store.open_input_file(name), 1 << 20) as file:
                rows, size = [], 0
                for row in read_records(file, self.wanted, self.payload):
                    rows.append(row)
                    size += len(row["payload"] or b"")
                    if size > 8 << 20 or len(rows) >= 2000:
                        yield pa.RecordBatch.from_pylist(rows, _ARROW)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _ARROW)


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class ArchiveWriter(DataSourceWriter):
    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")
        self.limit = int(options.get("fileBytes", FILE_BYTES))

    def write(self, iterator):
        store, base = _store(self.path)
        store.create_dir(base, recursive=True)
        names, file, size = [], None, 0
        try:
            for row in iterator:
                if file is None:
                    name, size = f"{uuid.uuid4().hex}.warc.gz", 0
                    file = store.open_output_stream(f"{base}/{name}", compression=None, buffer_size=1 << 20)
                values = row.asDict()
                payload = values.pop("payload") or b""
                record = record_bytes(values, bytes(payload))
                file.write(record)
                size += len(record)
                if size >= self.limit:
                    file.close()
                    names.append(name)
                    file = None
        finally:
            if file is not None:
                file.close()
        return Written([*names, *([name] if file is not None else [])])

    def commit(self, messages):
        store, base = _store(self.path)
        store.create_dir(base, recursive=True)
        names = sorted(name for message in messages if message for name in message.names)
        with store.open_output_stream(f"{base}/{MANIFEST}", compression=None) as file:
            file.write(json.dumps(names).encode())

    def abort(self, messages):
        store, base = _store(self.path)
        for message in messages:
            for name in message.names if message else []:
                store.delete_file(f"{base}/{name}")


class ArchiveSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return ArchiveReader(self.options)

    def writer(self, schema, overwrite):
        return ArchiveWriter(self.options)


def register(spark: SparkSession) -> None:
    prepare(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ArchiveSource)


def archive_records(pages: DataFrame, ident: str = "page_id", uri: str = "url", html: str = "html") -> DataFrame:
    """Records of the pages, ready to be written.

    Of equal payloads of at least 100 bytes that with the smallest id is the
    response (so are rows that repeat this id, and rows without an id if no other
    has one). Digests are grouped with partial sums first; only digests that
    repeat are joined back, in a join that AQE may split.
    """
    payload = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    base = pages.select(
        F.col(ident).cast("string").alias("record_id"),
        F.col(uri).alias("target_uri"),
        F.col(ident).alias("id"),
        payload.alias("payload"),
    ).withColumn("payload_digest", F.sha2("payload", 256)).withColumn("payload_length", F.octet_length("payload").cast("long"))
    repeated = (
        base.filter(F.col("payload_length") >= MIN_REVISIT_BYTES)
        .groupBy(F.col("payload_digest").alias("digest"))
        .agg(F.min("id").alias("first"), F.count("*").alias("copies"))
        .filter("copies > 1 and first is not null")
    )
    joined = base.join(repeated, F.col("payload_digest") == F.col("digest"), "left")
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    return joined.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        "record_id",
        "target_uri",
        F.when(revisit, F.col("first").cast("string")).alias("refers_to"),
        "payload_digest",
        "payload_length",
        F.when(revisit, None).otherwise(F.col("payload")).alias("payload"),
    )


def write_archive(records: DataFrame, path: str) -> None:
    register(records.sparkSession)
    records.select(*SCHEMA.fieldNames()).write.format("warc").mode("append").save(path)


def read_archive(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def with_checked_payloads(records: DataFrame) -> DataFrame:
    """payload_bytes and payload_digest, computed where the record holds its payload, else as its headers say."""
    held = F.col("payload").isNotNull()
    return records.withColumns(
        {
            "payload_bytes": F.when(held, F.octet_length("payload").cast("long")).otherwise(F.col("payload_length")),
            "payload_digest": F.when(held, F.sha2("payload", 256)).otherwise(F.col("payload_digest")),
        }
    )


def archived_pages(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write the pages into an archive in the shared folder and read it back."""
    path = new_path(prepare(spark), "warc")
    write_archive(archive_records(pages), path)
    return with_checked_payloads(read_archive(spark, path))
