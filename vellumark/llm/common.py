"""Helpers of the operators: settings, words, hashes, windows and written tables."""

from __future__ import annotations

import ctypes
import gc
import time
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_path, ship_package

# Rows and bytes that one Arrow batch may hold; bounds the memory of a Python worker.
BATCH_ROWS = 500
BATCH_BYTES = 8 << 20

_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def prepare(spark: SparkSession) -> SparkSession:
    """Settings for Arrow batches of long texts; workers get this package."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ship_package(spark)
    return spark


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/documents.parquet")


def written(df: DataFrame, name: str, **options) -> DataFrame:
    """``df`` as a table in the shared folder, with ``options`` of the writer."""
    spark = df.sparkSession
    _collect_garbage(spark)
    path, schema = new_path(spark, name), df.schema
    df.write.options(**options).option("compression", "zstd").parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out.written_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``written`` that no later step reads."""
    for table in tables:
        context = table.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(table.written_at)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps.

    It does once the driver has collected the plans that made them. A plan is still held
    for a moment after its job, hence the pause, and the last one until the next job, hence the smallest of jobs.
    """
    spark.range(1).count()
    time.sleep(1)
    _collect_garbage(spark)


def _collect_garbage(spark: SparkSession) -> None:
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shards_for(spark: SparkSession, amount: int, per_shard: int) -> int:
    """Groups that hold about ``per_shard`` each, at least one per shuffle partition."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(amount) // per_shard))


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes per row, null as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def _give_back() -> None:
    """Give the free memory of this worker back: it waits for its next task beside the others."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def trimmed(run):
    """``run`` for ``mapInArrow``, after which the worker gives its free memory back."""

    def tidy(batches):
        yield from run(batches)
        _give_back()

    return tidy


def trimmed_groups(run):
    """``run`` of one table for ``applyInArrow`` on groups, after each of which the worker gives its free memory back."""

    def tidy(table: pa.Table) -> pa.Table:
        out = run(table)
        _give_back()
        return out

    return tidy


def trimmed_pairs(run):
    """``trimmed_groups`` for two tables of a cogroup."""

    def tidy(left: pa.Table, right: pa.Table) -> pa.Table:
        out = run(left, right)
        _give_back()
        return out

    return tidy


class WordHash(dict):
    """64-bit hash by word, remembered for up to ``limit`` words."""

    def __init__(self, modulus: int = 0, limit: int = 300_000):
        super().__init__()
        self.modulus, self.limit = modulus, limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word)
        if self.modulus:
            value %= self.modulus
        self[word] = value
        return value

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (the finaliser of splitmix64)."""
    x = x + np.uint64(_ODD)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _joined(a: np.ndarray, a_len: int, b: np.ndarray, b_len: int, base: int) -> np.ndarray:
    n = max(0, len(b) - a_len)
    return a[:n] * np.uint64(pow(base, b_len, 1 << 64)) + b[a_len : a_len + n]


def gram_hashes(values: np.ndarray, k: int, base: int = _ODD) -> np.ndarray:
    """Polynomial hash of each run of ``k`` neighbouring values, by doubling."""
    out, out_len, part, part_len = None, 0, values, 1
    while True:
        if k & 1:
            out = part if out is None else _joined(out, out_len, part, part_len, base)
            out_len += part_len
        k >>= 1
        if not k:
            return out
        part = _joined(part, part_len, part, part_len, base)
        part_len *= 2


def sliding(reduce, values: np.ndarray, width: int) -> np.ndarray:
    """Minimum or maximum (``np.minimum``, ``np.maximum``) of each ``width`` neighbours."""
    size = 1
    while size * 2 <= width:
        values = reduce(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return reduce(values[:-rest], values[rest:]) if rest else values


def anchors(grams: np.ndarray, owner: np.ndarray, k: int, span: int) -> np.ndarray:
    """Positions whose ``k``-gram hash is the least of some window of ``span`` values.

    ``owner`` names the document of each value; windows stay within one. Equal
    windows select the same positions, so any repeated window shares an anchor.
    """
    width, n = span - k + 1, len(owner)
    if n < span:
        return np.empty(0, np.int64)
    least = sliding(np.minimum, grams, width)
    inside = owner[: n - span + 1] == owner[span - 1 :]
    least = np.where(inside, least, np.uint64(0))
    pad = np.zeros(width - 1, np.uint64)
    best = sliding(np.maximum, np.concatenate([pad, least, pad]), width)
    return np.flatnonzero((best == grams[: len(best)]) & (best != 0))


def chunks(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows that together stay below ``limit`` (or hold a single row)."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += int(size)
    if start < len(sizes):
        yield start, len(sizes)


def covered(starts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Mask of ``size`` positions that lie in any of the ranges."""
    step = np.zeros(size + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, ends, -1)
    return np.cumsum(step[:-1]) > 0


def as_signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64).view(np.int64)


def variant(text) -> F.Column:
    """32 bits of the text, so that rows that repeat a doc_id with another text stay apart."""
    return F.xxhash64(F.coalesce(text, F.lit(""))).bitwiseAND(F.lit((1 << 32) - 1))
