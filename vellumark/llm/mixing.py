"""Mixing sources to target weights.

The words of a source form one stream, its documents in a fixed order. The
stream is packed into blocks of equal length. A source gets as many slots as
its target needs; the slots are drawn over the output shards multinomially.
Slot number i of a source reads block P(i) of the source, P being a
pseudorandom permutation of the block numbers that is another one in each pass
over the source. Slots and blocks meet in a join on (source, block).

The draws are conditioned on the slots of a source, so its words differ from the
target by about a block at most. No block is read more than three times.

Null sources form one source of their own, last in order; null texts have no
words; documents without words are returned with nothing taken. Rows that
repeat a document are documents of their own.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import mix, prepare, shards_for, texts_of, written

WEIGHTS = (5.0, 2.0, 1.0)
MAX_PASSES = 3
BLOCK_WORDS = 64
SHARD_SLOTS = 8192
DOCUMENTS_PER_CHUNK = 20_000
SEED = 17


def word_counts(df: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` (as a struct ``row``) with the number of words ``size``."""
    prepare(df.sparkSession)
    plain = df.select(F.struct(*keep).alias("row"), F.col(text).alias("body"))

    def measure(batches):
        for batch in batches:
            sizes = pa.array([len(t.split()) for t in texts_of(batch.column(1))], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes], ["row", "size"])

    return plain.mapInArrow(measure, f"row {plain.schema['row'].dataType.simpleString()}, size long")


def ranked(sources: DataFrame) -> DataFrame:
    """Add ``position``: the row's number in code point order of ``source``, null last.

    Ranges of sources are sorted in parallel; only a count per range is gathered.
    """
    keyed = sources.withColumn("last", F.col("source").isNull())
    ranges = written(
        keyed.repartitionByRange("last", "source").withColumn("part", F.spark_partition_id()), "source-ranges"
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.groupBy("part").agg(F.count("*").alias("rows")).select(
        "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start")
    )
    within = Window.partitionBy("part").orderBy("last", "source")
    return (
        ranges.withColumn("within", F.row_number().over(within) - 1)
        .join(F.broadcast(starts), "part")
        .withColumn("position", F.col("start") + F.col("within"))
        .drop("part", "start", "within", "last")
    )


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, passes: float = MAX_PASSES) -> DataFrame:
    """(source, source_size, target) from rows of (source, size).

    Weights repeat over the sources in code point order. A target above
    ``passes`` times its source stops there; the excess goes to the others by
    weight until none is above. With level L, a target is the smaller of its
    cap and weight * L, and L grows to a fixed point: a few one-row aggregates.
    """
    spark = sizes.sparkSession
    sums = ranked(sizes.groupBy("source").agg(F.sum("size").alias("source_size")))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("position") % len(weights)).cast("int") + 1)
    table = written(
        sums.select("source", "source_size", weight.alias("weight"), (passes * F.col("source_size")).alias("cap")), "sources"
    )
    total, capped, level = None, -1, 0.0
    while True:
        over = F.col("weight") * level >= F.col("cap") if total is not None else F.lit(False)
        row = table.agg(
            F.sum("source_size").alias("total"),
            F.count_if(over).alias("capped"),
            F.sum(F.when(over, F.col("cap")).otherwise(0.0)).alias("fixed"),
            F.sum(F.when(over, 0.0).otherwise(F.col("weight"))).alias("free"),
        ).first()
        total = float(row.total or 0)
        if row.capped == capped or not row.free:
            break
        capped, level = row.capped, (total - row.fixed) / row.free
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.lit(level))
    return spark.createDataFrame([], "source string, source_size long, target double") if not total and not capped else table.select(
        "source", "source_size", target.alias("target")
    )


def positioned(sizes: DataFrame) -> DataFrame:
    """Add ``start``: the document's first word in the stream of its source.

    ``sizes`` has doc_id, source, mark (a hash of the text) and size, and no empty
    documents. A source is cut into chunks by a hash of doc_id and mark, so no window
    holds a whole source: the chunks are summed first, then the documents of each chunk.
    """
    chunks = shards_for(sizes.sparkSession, sizes.count(), DOCUMENTS_PER_CHUNK)
    dealt = sizes.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "mark", F.lit(SEED)), F.lit(chunks)))
    running = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("source", "chunk").agg(F.sum("size").alias("words")).select(
        F.col("source").alias("s"), F.col("chunk").alias("c"), F.coalesce(F.sum("words").over(running), F.lit(0)).alias("before")
    ).hint("merge")
    inside = Window.partitionBy("source", "chunk").orderBy("doc_id", "mark", "size").rowsBetween(Window.unboundedPreceding, -1)
    return (
        dealt.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("chunk") == F.col("c")))
        .select(*sizes.columns, (F.col("before") + F.col("inside")).alias("start"))
    )


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A pseudorandom permutation of 0 .. size - 1, chosen by ``key``.

    A four-round Feistel network over the next power of four; values outside
    are encrypted again until they fall inside.
    """
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(size, 2)) / 2)).astype(np.uint64))
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = index.astype(np.uint64), np.arange(len(index))
    while len(todo):
        h, m, k = half[todo], mask[todo], key[todo]
        left, right = out[todo] >> h, out[todo] & m
        for r in range(4):
            left, right = right, left ^ (mix(right ^ mix(k + np.uint64(r))) & m)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= size[todo].astype(np.uint64)]
    return out.astype(np.int64)


def block_takes(targets: DataFrame, block: int = BLOCK_WORDS, passes: int = MAX_PASSES, seed: int = SEED) -> DataFrame:
    """(source, block, times): how often the mix reads each block."""
    spark = targets.sparkSession
    blocks = F.ceil(F.col("source_size") / F.lit(block)).cast("long")
    wanted = targets.filter("source_size > 0").select(
        "source",
        blocks.alias("blocks"),
        F.least(F.round(F.col("target") / (F.col("source_size") / blocks)).cast("long"), passes * blocks).alias("slots"),
        F.xxhash64("source", F.lit(seed)).alias("key"),
    )
    everything = wanted.agg(F.sum("slots")).first()[0] or 0
    shards = max(1, -(-everything // SHARD_SLOTS))

    def draw(batches):
        for frame in batches:
            for row in frame.itertuples(index=False):
                counts = np.random.default_rng([seed, row.key & 0xFFFFFFFF, row.slots]).multinomial(row.slots, np.full(shards, 1 / shards))
                ends = np.cumsum(counts)
                some = np.flatnonzero(counts)
                yield pd.DataFrame(
                    {"source": row.source, "blocks": row.blocks, "key": row.key, "shard": some, "first": ends[some] - counts[some], "slots": counts[some]}
                )

    def read(batches):
        for frame in batches:
            for row in frame.itertuples(index=False):
                slot = np.arange(row.first, row.first + row.slots)
                turn = slot // row.blocks
                key = mix(np.full(len(slot), row.key, np.int64).view(np.uint64) + turn.astype(np.uint64))
                at = permuted(slot % row.blocks, np.full(len(slot), row.blocks), key)
                yield pd.DataFrame({"source": row.source, "block": at, "shard": row.shard})

    drawn = wanted.mapInPandas(draw, "source string, blocks long, key long, shard long, first long, slots long")
    slots = drawn.repartition(shards_for(spark, everything, 1 << 20), "shard", "source").mapInPandas(
        read, "source string, block long, shard long"
    )
    return slots.groupBy("source", "block").agg(F.count("*").alias("times"))


def _taken(df: DataFrame, keys: list[str], block: int, weights: tuple[float, ...]) -> DataFrame:
    """doc_id, source, mark, the columns ``keys``, size, source_size, target and taken of every row of ``df``."""
    names = ["doc_id", "source", "mark", *keys]
    marked = df.select("doc_id", "source", "text", F.xxhash64("text").alias("mark"), *keys)
    sizes = written(word_counts(marked, names).select("row.*", "size"), "mix-sizes")
    targets = written(source_targets(sizes, weights), "mix-targets")
    streams = positioned(sizes.filter("size > 0"))
    first, last = F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)
    pieces = streams.select("*", F.explode(F.sequence(first, last)).alias("block")).withColumn(
        "words",
        F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block) - F.greatest(F.col("start"), F.col("block") * block),
    )
    takes = block_takes(targets, block).select(F.col("source").alias("s"), F.col("block").alias("b"), "times").hint("merge")
    joined = pieces.join(takes, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")), "left")
    taken = joined.groupBy(*names, "size", "start").agg(F.coalesce(F.sum(F.col("words") * F.col("times")), F.lit(0)).alias("taken"))
    rest = sizes.filter("size = 0").select(*names, "size", F.lit(0).cast("long").alias("taken"))
    every = taken.drop("start").unionByName(rest)
    named = targets.select(F.col("source").alias("s"), "source_size", "target")
    return every.join(named, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")


def mixed(df: DataFrame, block: int = BLOCK_WORDS, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """doc_id, source, size, source_size, target and taken of every document of ``df``."""
    return _taken(df, [], block, weights).select(
        "doc_id", "source", "size", "source_size", "target", F.col("taken").cast("long").alias("taken")
    )


def mixed_documents(df: DataFrame) -> DataFrame:
    """The documents of the mix, whole: each repeated about taken / size times, at most three times.

    The fraction left by whole passes decides by a hash of doc_id and text, so the
    words of a source still come near its target. Every row is a document of its
    own, with or without a doc_id; rows without words are not in the mix.
    """
    rows = written(df.select(F.struct(*df.columns).alias("row"), F.monotonically_increasing_id().alias("place")), "mix-rows")
    share = F.pmod(F.xxhash64("doc_id", "mark", F.lit(SEED)), F.lit(1 << 20)) / F.lit(1 << 20)
    copies = F.floor(F.col("taken") / F.greatest("size", F.lit(1)) + share).cast("int")
    chosen = (
        _taken(rows.select("row.doc_id", "row.source", "row.text", "place"), ["place"], BLOCK_WORDS, WEIGHTS)
        .filter("size > 0")
        .select("place", copies.alias("copies"))
        .filter("copies > 0")
    )
    return rows.join(chosen, "place").select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
