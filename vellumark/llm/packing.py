"""Token ids in files of fixed-width bits, with random access.

Encoding: where the tokenizer lowers case, drops white space and splits by a pattern, no token
crosses white space. Texts are then cut at ASCII white space, a batch's distinct pieces found,
and plain words taken apart from the points and commas behind them. The tokenizers
library encodes each part once; a worker remembers parts up to a limit, and the ids of the
texts are gathered from them by numpy. Every other tokenizer of that library encodes whole texts.

Files: every id takes the bits that the largest id of the vocabulary needs, least
significant bit first. ``BLOCK`` ids make a block, so each block starts at a byte; a
table of block offsets and checksums and an index of documents follow the blocks. A
reader takes the index, then only the blocks that hold the ids it wants, and unpacks
them with numpy.

    "VPK1" | blocks | offsets u64[blocks + 1] | crc32 u32[blocks]
           | doc ids i64[docs] | nulls u8[docs] | starts u64[docs + 1] | tail

The tail has fixed size: docs, ids (u64), block (u32), width (u16), "VPK1".

Documents are in ascending order of doc_id over all files: encoded rows are small, so
they are written once, ranged, sorted within their range, and each task writes files
of bounded size. The commit lists the files of the tasks that succeeded in a manifest with
the number of ids before each; files of lost attempts are never read.

Null and empty texts have the end id only. Null ids come first. Rows that repeat an id are
ordered by their number of ids and a checksum of them; equal rows are all kept. An
empty table makes a manifest without files. Columns other than the id and the text are
not stored, whatever their names. A text is encoded in slices, so only its ids have
to fit in memory.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, WriterCommitMessage
from tokenizers import Tokenizer

from ..session import new_path
from .common import discard, prepare, written
from .warc import _store

MANIFEST = "_manifest.json"
MAGIC = b"VPK1"
BLOCK = 4096
FILE_IDS = 1 << 27
# Ids that a reader unpacks at a time, unless one document has more.
READ_IDS = 1 << 19
MEMO_PARTS = 1_200_000
# How the tokenizer splits, by its file. And words of letters up to U+017F, all composed and of
# fixed lower case (U+0130 becomes two characters), with points and commas behind them.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PLAIN = "^(?P<word>[A-Za-zÀ-ÖØ-öø-įı-ſ]+)(?P<tail>[.,;:!?]*)$"
_TAIL = struct.Struct("<QQIH4s")

ENCODED = "doc_id long, n_tokens long, packed binary"
IDS_TYPES = {"bytes": "binary", "array": "array<int>"}


def id_width(vocabulary: int) -> int:
    """Bits that the ids 0 to ``vocabulary`` - 1 need."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids at ``width`` bits each, least significant first; the last byte is filled up with zeros."""
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    parts = []
    for start in range(0, len(ids), 16 * BLOCK):
        part = ids[start : start + 16 * BLOCK].astype("<u4")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 4), axis=1, count=width, bitorder="little")
        parts.append(np.packbits(bits, bitorder="little").tobytes())
    return b"".join(parts)


def unpack(data: bytes, width: int, count: int) -> np.ndarray:
    """The first ``count`` ids of packed bytes."""
    if width in (8, 16, 32):
        return np.frombuffer(data, f"<u{width // 8}", count).astype(np.uint32)
    out = np.empty(count, np.uint32)
    raw = np.frombuffer(data, np.uint8)
    for start in range(0, count, 16 * BLOCK):
        n = min(16 * BLOCK, count - start)
        part = raw[start * width // 8 : -(-(start + n) * width // 8)]
        bits = np.unpackbits(part, count=n * width, bitorder="little").reshape(n, width)
        words = np.zeros((n, 4), np.uint8)
        words[:, : -(-width // 8)] = np.packbits(bits, axis=1, bitorder="little")
        out[start : start + n] = words.view("<u4")[:, 0]
    return out


def drops_white_space(path: str) -> bool:
    """Whether a tokenizer composes, lowers case, and keeps only runs of letters, digits and other signs."""
    with open(path, encoding="utf-8") as file:
        kinds = json.load(file)
    normal, split = kinds["normalizer"] or {}, kinds["pre_tokenizer"] or {}
    if [n["type"] for n in normal.get("normalizers", [])] != ["NFC", "Replace", "Lowercase"]:
        return False
    steps = split.get("pretokenizers", [])
    if [step["type"] for step in steps] != ["Split", "ByteLevel"] or steps[1]["use_regex"] or steps[1]["add_prefix_space"]:
        return False
    keeps = steps[0]["behavior"] == "Removed" and steps[0]["invert"] and steps[0]["pattern"] == {"Regex": SPLIT}
    return keeps and normal["normalizers"][1]["pattern"] == {"Regex": r"\s+"}


class PieceEncoder:
    """Ids of a batch of texts, from those of their parts."""

    def __init__(self, path: str, limit: int = MEMO_PARTS):
        self.tokenizer = Tokenizer.from_file(path)
        self.limit = limit
        self.known: dict[str, bytes] = {"": b""}
        self.cuts = drops_white_space(path)

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        texts = texts.cast(pa.large_string()).fill_null("")
        if not self.cuts:
            return [np.frombuffer(self._ids(text)[0], "<u4") for text in texts.to_pylist()]
        pieces = pc.ascii_split_whitespace(texts)
        ends = pieces.offsets.to_numpy() - pieces.offsets[0].as_py()
        named = pieces.flatten().dictionary_encode()
        # A plain word and the signs behind it are two parts, any other piece is one.
        halves = pc.extract_regex(named.dictionary, PLAIN)
        plain = halves.is_valid()
        words = pc.if_else(plain, pc.utf8_lower(pc.struct_field(halves, "word")), named.dictionary)
        tails = pc.if_else(plain, pc.struct_field(halves, "tail"), "")
        parts = pa.chunked_array([words, tails]).combine_chunks().dictionary_encode()
        encoded = self._parts(parts.dictionary.to_pylist())
        sizes = np.fromiter(map(len, encoded), np.int64, len(encoded)) // 4
        ids = np.frombuffer(b"".join(encoded), "<u4")
        begins = np.cumsum(sizes) - sizes
        # The parts of the texts in order, and from them the places of their ids.
        part = parts.indices.to_numpy().reshape(2, -1)[:, named.indices.to_numpy()].T.ravel()
        lengths = sizes[part]
        after = np.concatenate([[0], np.cumsum(lengths)])
        gathered = ids[np.repeat(begins[part] - after[:-1], lengths) + np.arange(after[-1])]
        return np.split(gathered, after[2 * ends[1:-1]])[: len(texts)]

    def _parts(self, parts: list[str]) -> list[bytes]:
        known = self.known
        new = [part for part in parts if part not in known]
        if len(known) + len(new) > self.limit:
            known.clear()
            new = parts
        known.update(zip(new, self._encode(new), strict=True))
        return list(map(known.__getitem__, parts))

    def _ids(self, text: str):
        encoding = self.tokenizer.encode(text, add_special_tokens=False)
        return np.array(encoding.ids, "<u4").tobytes(), encoding

    def _encode(self, texts: list[str]) -> list[bytes]:
        """Ids of texts without white space at their ends, encoded as one; a token belongs to the text in which it starts."""
        if not texts:
            return []
        raw, encoding = self._ids(" ".join(texts))
        begins = np.cumsum([0, *[len(text) + 1 for text in texts]])
        first = 4 * np.searchsorted(np.array([start for start, _ in encoding.offsets], np.int64), begins)
        return [raw[a:b] for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]


_ENCODERS: dict[str, PieceEncoder] = {}


def worker_encoder(path: str) -> PieceEncoder:
    """One encoder per worker process, so its memo serves all tasks of that worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def encoded(docs: DataFrame, tokenizer: str, width: int, end_id: int | None, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, packed) per row, the end id included."""
    end = np.array([] if end_id is None else [end_id], np.uint32)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer)
        for batch in batches:
            ids = [np.concatenate([x, end]) for x in encoder(batch.column(1))]
            packed = [pack(x, width) for x in ids]
            counts = pa.array([len(x) for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), counts, pa.array(packed, pa.binary())], ["doc_id", "n_tokens", "packed"])

    return docs.select(F.col(ident).cast("long"), text).mapInArrow(encode, ENCODED)


class FileWriter:
    """One file of packed ids; blocks leave memory as soon as they are full."""

    def __init__(self, file, width: int):
        self.file, self.width = file, width
        self.offsets, self.sums = [len(MAGIC)], []
        self.docs, self.starts = [], [0]
        self.waiting, self.held = [], 0
        file.write(MAGIC)

    @property
    def ids(self) -> int:
        return self.starts[-1]

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc)
        self.starts.append(self.ids + len(ids))
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= 64 * BLOCK:
            self._flush(self.held // BLOCK * BLOCK)

    def _flush(self, count: int) -> None:
        ids = np.concatenate([*self.waiting, np.empty(0, np.uint32)])
        for start in range(0, count, BLOCK):
            block = pack(ids[start : min(start + BLOCK, count)], self.width)
            self.file.write(block)
            self.offsets.append(self.offsets[-1] + len(block))
            self.sums.append(zlib.crc32(block))
        self.waiting, self.held = [ids[count:]], len(ids) - count

    def close(self) -> None:
        self._flush(self.held)
        nulls = np.array([doc is None for doc in self.docs], np.uint8)
        for part in (
            np.array(self.offsets, "<u8"),
            np.array(self.sums, "<u4"),
            np.array([doc or 0 for doc in self.docs], "<i8"),
            nulls,
            np.array(self.starts, "<u8"),
        ):
            self.file.write(part.tobytes())
        self.file.write(_TAIL.pack(len(self.docs), self.ids, BLOCK, self.width, MAGIC))
        self.file.close()


class PackedFile:
    """Random access to a file of packed ids."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        file.seek(size - _TAIL.size)
        docs, self.ids, self.block, self.width, magic = _TAIL.unpack(file.read(_TAIL.size))
        if magic != MAGIC:
            raise ValueError("Not a file of packed ids, or it was cut off.")
        blocks = -(-self.ids // self.block)
        index = 8 * (blocks + 1) + 4 * blocks + 8 * docs + docs + 8 * (docs + 1)
        file.seek(size - _TAIL.size - index)
        raw, at = file.read(index), 0
        parts = []
        for kind, count in (("<u8", blocks + 1), ("<u4", blocks), ("<i8", docs), ("u1", docs), ("<u8", docs + 1)):
            parts.append(np.frombuffer(raw, kind, count, at))
            at += parts[-1].nbytes
        self.offsets, self.sums, self.docs, self.nulls, starts = parts
        self.starts = starts.astype(np.int64)

    def range(self, start: int, end: int) -> np.ndarray:
        """Ids ``start`` to ``end`` (exclusive) of the file; only their blocks are read."""
        if start >= end:
            return np.empty(0, np.uint32)
        first, last = start // self.block, (end - 1) // self.block
        self.file.seek(int(self.offsets[first]))
        data = self.file.read(int(self.offsets[last + 1] - self.offsets[first]))
        for i in range(first, last + 1):
            begin = int(self.offsets[i] - self.offsets[first])
            if zlib.crc32(data[begin : int(self.offsets[i + 1] - self.offsets[first])]) != self.sums[i]:
                raise ValueError(f"Block {i} is damaged.")
        count = min(self.ids, (last + 1) * self.block) - first * self.block
        return unpack(data, self.width, count)[start - first * self.block : end - first * self.block]

    def document(self, place: int) -> np.ndarray:
        return self.range(int(self.starts[place]), int(self.starts[place + 1]))


@dataclass
class Task(WriterCommitMessage):
    task: int
    files: list[dict]


class PackedWriter(DataSourceArrowWriter):
    """Writes rows of ``ENCODED``, in the order in which they come."""

    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")
        self.width = int(options["width"])
        self.limit = int(options.get("fileIds", FILE_IDS))

    def write(self, iterator):
        store, base = _store(self.path)
        store.create_dir(base, recursive=True)
        files, writer = [], None

        def finish():
            writer.close()
            known = [doc for doc in writer.docs if doc is not None]
            files[-1].update(docs=len(writer.docs), ids=writer.ids, first=min(known, default=None), last=max(known, default=None))

        for batch in iterator:
            columns = batch.to_pydict()
            for doc, n, packed in zip(columns["doc_id"], columns["n_tokens"], columns["packed"], strict=True):
                if writer is None:
                    files.append({"name": f"{uuid.uuid4().hex}.vpk"})
                    file = store.open_output_stream(f"{base}/{files[-1]['name']}", compression=None, buffer_size=1 << 20)
                    writer = FileWriter(file, self.width)
                writer.add(doc, unpack(packed, self.width, n))
                if writer.ids >= self.limit:
                    finish()
                    writer = None
        if writer is not None:
            finish()
        return Task(TaskContext.get().partitionId(), files)

    def commit(self, messages):
        files = [file for task in sorted((m for m in messages if m), key=lambda m: m.task) for file in task.files]
        start = 0
        for file in files:
            file["start"] = start
            start += file["ids"]
        store, base = _store(self.path)
        store.create_dir(base, recursive=True)
        with store.open_output_stream(f"{base}/{MANIFEST}", compression=None) as out:
            out.write(json.dumps({"width": self.width, "ids": start, "files": files}).encode())

    def abort(self, messages):
        store, base = _store(self.path)
        for message in messages:
            for file in message.files if message else []:
                store.delete_file(f"{base}/{file['name']}")


class OneFile(InputPartition):
    def __init__(self, entry: dict | None):
        super().__init__(entry)
        self.entry = entry


class PackedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")
        self.form = options.get("ids", "bytes")
        self.wanted: set[int] | None = None

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, EqualTo | In) and f.attribute == ("doc_id",):
                allowed = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted = allowed if self.wanted is None else self.wanted & allowed
            else:
                yield f

    def partitions(self):
        store, base = _store(self.path)
        with store.open_input_stream(f"{base}/{MANIFEST}", compression=None) as file:
            files = json.loads(file.read())["files"]
        if self.wanted is not None:
            files = [f for f in files if f["first"] is not None and any(f["first"] <= doc <= f["last"] for doc in self.wanted)]
        return [OneFile(f) for f in files] or [OneFile(None)]

    def read(self, partition):
        if partition.entry is None:
            return
        store, base = _store(self.path)
        with store.open_input_file(f"{base}/{partition.entry['name']}") as raw:
            file = PackedFile(raw)
            picked = np.arange(len(file.docs))
            if self.wanted is not None:
                picked = picked[np.isin(file.docs, np.array(sorted(self.wanted), np.int64)) & (file.nulls == 0)]
            for places in _runs(picked, file.starts):
                yield self._batch(file, places, partition.entry["start"])

    def _batch(self, file: PackedFile, places: np.ndarray, before: int) -> pa.RecordBatch:
        first, last = int(places[0]), int(places[-1])
        starts = file.starts[first : last + 2]
        ids = file.range(int(starts[0]), int(starts[-1]))
        columns = {
            "doc_id": pa.array(file.docs[first : last + 1], mask=file.nulls[first : last + 1] == 1),
            "start": pa.array(starts[:-1] + before),
            "n_tokens": pa.array(np.diff(starts)),
        }
        if self.form != "none":
            size = 4 if self.form == "bytes" else 1
            offsets = pa.py_buffer(((starts - starts[0]) * size).astype(np.int32))
            values = pa.py_buffer(ids.astype("<u4"))
            if self.form == "bytes":
                columns["ids"] = pa.Array.from_buffers(pa.binary(), len(places), [None, offsets, values])
            else:
                inner = pa.Array.from_buffers(pa.int32(), len(ids), [None, values])
                columns["ids"] = pa.Array.from_buffers(pa.list_(pa.int32()), len(places), [None, offsets], children=[inner])
        return pa.RecordBatch.from_pydict(columns)


def _runs(picked: np.ndarray, starts: np.ndarray) -> Iterator[np.ndarray]:
    """Neighbouring places that together have at most ``READ_IDS`` ids, or a single place."""
    begin = 0
    while begin < len(picked):
        limit = starts[picked[begin]] + READ_IDS
        end = begin + 1
        while end < len(picked) and picked[end] == picked[end - 1] + 1 and starts[picked[end] + 1] <= limit:
            end += 1
        yield picked[begin:end]
        begin = end


class PackedSource(DataSource):
    """Format ``packed_ids``: doc_id, start (ids of all documents before it), n_tokens, ids.

    Option ``ids``: ``bytes`` (little-endian, 4 bytes an id), ``array`` or ``none``.
    """

    @classmethod
    def name(cls):
        return "packed_ids"

    def schema(self):
        form = self.options.get("ids", "bytes")
        return "doc_id long, start long, n_tokens long" + ("" if form == "none" else f", ids {IDS_TYPES[form]}")

    def reader(self, schema):
        return PackedReader(self.options)

    def writer(self, schema, overwrite):
        return PackedWriter(self.options)


def register(spark: SparkSession) -> None:
    prepare(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PackedSource)


def write_packed(rows: DataFrame, path: str, width: int, file_ids: int = FILE_IDS) -> None:
    """Write rows of ``ENCODED`` in ascending order of doc_id.

    ``rows`` is a written table: ranging reads it twice. Rows that repeat an id and its ids
    are told apart by their place, so that no range holds all of them.
    """
    register(rows.sparkSession)
    order = [F.asc_nulls_first("doc_id"), F.asc("n_tokens"), F.asc("sum"), F.asc("place")]
    placed = rows.withColumns({"sum": F.crc32("packed"), "place": F.monotonically_increasing_id()})
    ranged = placed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "n_tokens", "packed")
    ranged.write.format("packed_ids").option("width", width).option("fileIds", file_ids).mode("append").save(path)


def read_packed(spark: SparkSession, path: str, ids: str = "bytes") -> DataFrame:
    register(spark)
    return spark.read.format("packed_ids").option("ids", ids).load(path)


def packed_documents(docs: DataFrame, tokenizer: str, end_id: int | None = 1, path: str | None = None, ids: str = "bytes") -> DataFrame:
    """Encode ``docs``, write the ids to ``path`` and read them back."""
    spark = prepare(docs.sparkSession)
    path = path or new_path(spark, "packed")
    size = Tokenizer.from_file(tokenizer).get_vocab_size()
    width = id_width(max(size, (end_id or 0) + 1))
    rows = written(encoded(docs, tokenizer, width, end_id), "packed-rows")
    write_packed(rows, path, width)
    discard(rows)
    return read_packed(spark, path, ids)
