"""Merkle manifest of a dataset with incremental witnesses.

A witness is the list of sibling digests from a node up to a root. Nodes are appended in order
to ``Appender``, which keeps the open subtrees, fewer than ``ARITY`` of each height. A
new node starts with an empty witness; whenever a later sibling completes a run, the
witnesses of all nodes under the run get their siblings' digests, and the run's parent is the
next append one level up. Closing completes the runs that are left short.

On Spark the leaves of a source are numbered in order and cut into aligned blocks of
``ARITY ** LEVELS`` leaves, complete subtrees all but the last. Tasks stream through sorted blocks
and hold one at a time. The roots of the blocks are numbered leaves of the next pass, until
every source has one root; the roots of the sources are appended likewise. Then witnesses are
extended from the top: those of block roots get what lies above them, and each leaf that of
its block. A source that holds a third of all rows is so many blocks, never one group.

Null sources come first, then UTF-8 byte order; within a source null ids first, then
ascending ids, equal ids by the digest of their leaf. Repeated rows are leaves of their
own. An empty table has no leaves and no root and gives no rows. Texts are hashed whole.
Columns other than the five hashed ones are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, written

ARITY = 3
LEVELS = 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_APPENDED = "tree string, block long, place long, node binary, other binary, id long, witness binary, shape binary, top binary"


def hash_of(digests: list[bytes]) -> bytes:
    """Digest of digests, which are concatenated as lowercase hex text."""
    return hashlib.sha256("".join(d.hex() for d in digests).encode()).digest()


def leaf_digest(values: list[Column]) -> Column:
    """SHA-256 of the values, each ``-`` if null, else its number of bytes, a colon and the value."""
    parts = []
    for value in values:
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


class Appender:
    """An append-only tree over a stream of digests that extends the witnesses of what it holds.

    ``open[h]`` lists the (digest, first, end) of subtrees of height h without a complete
    run; first and end are places of the nodes appended. ``witness`` and ``shape`` hold, per
    node, its sibling digests and for each level one byte, ARITY + 1 times its place in the run plus the run's size.
    """

    def __init__(self):
        self.open: list[list[tuple[bytes, int, int]]] = [[]]
        self.size = 0
        self.witness: list[list[bytes]] = []
        self.shape: list[bytearray] = []

    def append(self, digest: bytes) -> None:
        self.witness.append([])
        self.shape.append(bytearray())
        self.open[0].append((digest, self.size, self.size + 1))
        self.size += 1
        height = 0
        while len(self.open[height]) == ARITY:
            self._complete(height)
            height += 1

    def _complete(self, height: int) -> None:
        run = self.open[height]
        for place, (_, first, end) in enumerate(run):
            siblings = [digest for i, (digest, _, _) in enumerate(run) if i != place]
            mark = place * (ARITY + 1) + len(run)
            for node in range(first, end):
                self.witness[node].extend(siblings)
                self.shape[node].append(mark)
        if len(self.open) == height + 1:
            self.open.append([])
        self.open[height + 1].append((hash_of([digest for digest, _, _ in run]), run[0][1], run[-1][2]))
        self.open[height] = []

    def close(self, levels: int | None = None) -> bytes:
        """Complete what is open up to ``levels``, or until one node is left; its digest."""
        height = 0
        while height < (levels if levels is not None else height + 1):
            if levels is None and len(self.open[height]) == 1 and not any(self.open[height + 1 :]):
                break
            if self.open[height]:
                self._complete(height)
            height += 1
        return self.open[height][0][0]


def fold(node: bytes, witness: bytes, shape: bytes) -> bytes:
    """The root that a node and its witness lead to."""
    at = 0
    for mark in shape:
        place, size = divmod(mark, ARITY + 1)
        run = [witness[at + 32 * i : at + 32 * i + 32] for i in range(size - 1)]
        at += 32 * (size - 1)
        node = hash_of([*run[:place], node, *run[place:]])
    return node


def altered(ident: Column) -> Column:
    """The rows whose text is changed to see that their witness then fails."""
    return F.crc32(ident.cast("string").cast("binary")) % 2 == 0


def _numbered(nodes: DataFrame, order: list[str], name: str) -> DataFrame:
    """``nodes``, a written table, with ``place`` in its tree and the tree's ``size``.

    Rows are ranged by tree and order. The numbers of rows of each tree in earlier ranges
    shift the places within a range, so no task sorts a whole tree.
    """
    keys = ["tree", *order, "tie"]
    ranged = nodes.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*keys).withColumn("slab", F.spark_partition_id())
    # Range borders are sampled, so the placement is written once and reread.
    placed = written(ranged, name)
    cells = placed.groupBy("tree", "slab").agg(F.count("*").alias("rows"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("slab").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("tree", "slab", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"), F.sum("rows").over(whole).alias("size"))
    within = Window.partitionBy("tree", "slab").orderBy(*order, "tie")
    return (
        placed.withColumn("place", F.row_number().over(within) - 1)
        .join(cells, ["tree", "slab"])
        .withColumn("place", F.col("place") + F.col("before"))
        .drop("tie", "slab", "before")
    )


def appended(numbered: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Stream the nodes of each tree block by block through an ``Appender``.

    ``numbered`` has tree, place, size, node, other and id. Adds the block, the witness up to the
    block's root, its shape, and that root (``top``). In a tree of one block that is the tree's root.
    """
    whole = ARITY**levels
    # int64 division: blocks of a tree are numbered from 0.
    cut = numbered.withColumn("block", F.expr(f"place div {whole}")).select("tree", "block", "place", "size", "node", "other", "id")
    names = [part.split()[0] for part in _APPENDED.split(", ")]

    def finish(key: tuple, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts).combine_chunks()
        tree = Appender()
        for node in rows.column("node").to_pylist():
            tree.append(node)
        top = tree.close(None if key[2] <= whole else levels)
        columns = {name: rows.column(name) for name in names[:6]}
        columns["witness"] = pa.array([b"".join(w) for w in tree.witness], pa.binary())
        columns["shape"] = pa.array([bytes(s) for s in tree.shape], pa.binary())
        columns["top"] = pa.array([top] * tree.size, pa.binary())
        return pa.Table.from_pydict(columns).to_batches()[0]

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts = None, []
        for batch in batches:
            keys = list(zip(*(batch.column(name).to_pylist() for name in ("tree", "block", "size")), strict=True))
            start = 0
            for i in range(1, len(keys) + 1):
                if i < len(keys) and keys[i] == keys[start]:
                    continue
                if parts and keys[start] != key:
                    yield finish(key, parts)
                    parts = []
                key = keys[start]
                parts.append(batch.slice(start, i - start))
                start = i
        if parts:
            yield finish(key, parts)

    return cut.repartition("tree", "block").sortWithinPartitions("tree", "block", "place").mapInArrow(stream, _APPENDED)


def _roots(rows: DataFrame) -> DataFrame:
    """The root of each block, as a node in its place."""
    return rows.filter(F.col("place") % ARITY**LEVELS == 0)


def trees(numbered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Append all nodes; (nodes with witnesses within their block, one row per block with what lies above).

    The second table has tree, block, the witness (``up``) and shape from the block's root to the root of its
    tree, and that root.
    """
    rows = written(appended(numbered), "merkle-blocks")
    passes = [rows]
    while True:
        blocks = _roots(passes[-1]).select(
            "tree", F.col("block").alias("place"), F.col("top").alias("node"), F.lit(None).cast("binary").alias("other"), F.lit(None).cast("long").alias("id")
        )
        counts = blocks.groupBy("tree").agg(F.count("*").alias("size"))
        more = blocks.join(counts.filter("size > 1"), "tree")
        if more.isEmpty():
            break
        passes.append(written(appended(more), "merkle-blocks"))

    # From the highest pass down, block roots get the witness of the block they are in.
    nothing = F.lit(b"")
    above = _roots(passes[-1]).select("tree", "block", nothing.alias("up"), nothing.alias("up_shape"), F.col("top").alias("root"))
    for level in range(len(passes) - 1, 0, -1):
        extended = passes[level].join(above, ["tree", "block"]).select(
            "tree",
            F.col("place").alias("block"),
            F.concat("witness", "up").alias("up"),
            F.concat("shape", "up_shape").alias("up_shape"),
            "root",
        )
        # Trees that had one block already are not in the higher pass.
        done = _roots(passes[level - 1]).select("tree", "block", nothing.alias("up"), nothing.alias("up_shape"), F.col("top").alias("root"))
        above = extended.unionByName(done.join(extended.select("tree").distinct(), "tree", "left_anti"))
    return rows, above


def manifest(docs: DataFrame) -> DataFrame:
    """Leaf, root of its source, root of all, and witness of every row.

    Columns: doc_id, leaf, other (the digest of the leaf after the change that ``altered`` makes, null where
    it makes none), subroot, root, witness (sibling digests, 32 bytes each, from the leaf up) and shape.
    """
    prepare(docs.sparkSession)
    plain = [F.col(name) for name in FIELDS]
    changed = [*plain[:-1], F.translate("text", "\n", "")]
    touched = altered(F.col("doc_id")) & F.contains(F.col("text"), F.lit("\n"))
    leaves = docs.select(
        # Sorts null first, then the bytes of the source.
        F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("")).alias("tree"),
        F.col("doc_id").cast("long").alias("id"),
        leaf_digest(plain).alias("node"),
        F.when(touched, leaf_digest(changed)).alias("other"),
    )
    leaves = written(leaves, "merkle-rows")
    rows, above = trees(_numbered(leaves, ["id", "node"], "merkle-leaves"))

    # The roots of the sources are the leaves of the last tree, whose order is that of their names.
    subroots = above.filter("block = 0").select(
        F.lit("").alias("tree"),
        F.col("tree").alias("source"),
        F.col("root").alias("node"),
        F.lit(None).cast("binary").alias("other"),
        F.lit(None).cast("long").alias("id"),
    )
    subroots = written(subroots, "merkle-subroots")
    ranked = written(_numbered(subroots, ["source"], "merkle-sources"), "merkle-ranked")
    rows_top, above_top = trees(ranked)
    sources = (
        ranked.select("place", F.col("source"), F.col("node").alias("subroot"))
        .join(rows_top.select("place", "block", "witness", "shape"), "place")
        .join(above_top.select("block", F.col("up").alias("high"), F.col("up_shape").alias("high_shape"), F.col("root").alias("whole")), "block")
        .select(
            F.col("source").alias("tree"),
            "subroot",
            F.concat("witness", "high").alias("top_witness"),
            F.concat("shape", "high_shape").alias("top_shape"),
            "whole",
        )
    )
    full = written(
        above.drop("root")
        .join(sources, "tree")
        .select(
            "tree",
            "block",
            F.concat("up", "top_witness").alias("up"),
            F.concat("up_shape", "top_shape").alias("up_shape"),
            "subroot",
            F.col("whole").alias("root"),
        ),
        "merkle-above",
    )
    return rows.join(full, ["tree", "block"]).select(
        F.col("id").alias("doc_id"),
        F.col("node").alias("leaf"),
        "other",
        "subroot",
        "root",
        F.concat("witness", "up").alias("witness"),
        F.concat("shape", "up_shape").alias("shape"),
    )


def verified(rows: DataFrame) -> DataFrame:
    """Fold the leaf, or the altered leaf where there is one, up its witness and compare with the root."""

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = [batch.column(name).to_pylist() for name in ("start", "witness", "shape")]
            roots = pa.array([fold(*node) for node in zip(*nodes, strict=True)], pa.binary())
            kept = [name for name in batch.schema.names if name not in ("start", "shape")]
            yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in kept), roots], [*kept, "folded"])

    started = rows.select("doc_id", "leaf", F.coalesce("other", "leaf").alias("start"), "subroot", "root", "witness", "shape")
    out = started.mapInArrow(folded, "doc_id long, leaf binary, subroot binary, root binary, witness binary, folded binary")
    text = {name: F.lower(F.hex(name)) for name in ("leaf", "subroot", "root", "witness", "folded")}
    return out.select(
        "doc_id",
        text["leaf"].alias("leaf"),
        text["subroot"].alias("subroot"),
        text["root"].alias("root"),
        F.sha2(text["witness"], 256).alias("proof_sha256"),
        text["folded"].alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )
