"""Prefix trie of conversations by van Emde Boas recursion.

A node is a distinct sequence of first turns; its name is a digest chained over them, so
equal prefixes have equal names wherever they are cut. Building goes by halves:

1. Down. Equal sequences are one item with a count. A round cuts every item at half its depth:
   the part above goes to the upper trie of the item's root, the part below to the lower
   trie of the cut prefix. Both kinds are grouped at once, so all upper and
   lower tries of a round shrink side by side. After log2(depth) rounds an item is one turn
   under its parent: a node. Copies are combined in the first round already, before any
   sequence is spread over its prefixes.
2. Up. Totals of a node are first its own. Undoing the rounds, from the smallest tries, the total
   of each lower trie is grafted on its cut prefix and on the prefixes above it in
   the upper trie. After the last round every node has the total of its subtree.

Nothing is held per group: counts and totals are sums with partial aggregation. The join
of nodes with their parents treats parents with at least one in ``HEAVY`` of all nodes as
children apart (so at most ``HEAVY``), by broadcast. One row holds one conversation's turns,
24 bytes each. The digest of a node's ends reads the ids in chunks that many tasks join; only
hashing the joined text, which is sequential, is one task's stream for each node.

Null conv_ids take no part. Null turns come first, equal turns of a conversation are
ordered by their digest, and repeated rows are turns of their own. Null roles and texts are
empty. An empty table has no members and gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, prepare, written

# Fixed value: a word of the contract.
WORD = r"[^\x20\x09-\x0D]+"
ROOT = hashlib.sha256(b"").digest()[:16]
HEAVY = 10_000
CHUNK_IDS = 20_000
HEADS = 4
STEP = 20

_PATH = "array<struct<name: binary, words: int>>"


def turn_lists(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns) with the digest and the words of each turn, in order."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    turn = F.struct(
        "turn",
        F.unhex(F.substring(digest, 1, 32)).alias("name"),
        F.regexp_count(text, F.lit(WORD)).alias("words"),
    )
    rows = conversations.filter(F.col("conv_id").isNotNull()).select("conv_id", turn.alias("t"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t")).select(
        "conv_id", F.transform("t", lambda t: F.struct(t["name"], t["words"])).alias("turns")
    )


def rebuilt(lists: DataFrame) -> DataFrame:
    """Each conversation with the first turns of the one at the last multiple of ``STEP`` in place of its own."""
    heads = lists.filter(F.col("conv_id") % STEP == 0).select(
        F.col("conv_id").alias("donor"), F.slice("turns", 1, HEADS - 1).alias("head")
    )
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    joined = lists.withColumns({"taken": taken, "donor": F.col("conv_id") - F.col("conv_id") % STEP}).join(heads, "donor", "left")
    none = F.array().cast(_PATH)
    return joined.select(
        "conv_id",
        F.concat(
            F.coalesce(F.slice("head", F.lit(1), F.col("taken")), none),
            F.slice("turns", F.col("taken") + 1, F.size("turns")),
        ).alias("turns"),
    )


def with_names(sequences: DataFrame) -> DataFrame:
    """(conv_id, ends, depth, path): the name of every prefix in place of the digests of the turns."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turns = batch.column(1)
            flat = turns.flatten()
            digests, names, ends = flat.field("name").to_pylist(), [], []
            lengths = turns.value_lengths().to_pylist()
            at = 0
            for length in lengths:
                last = ROOT
                for digest in digests[at : at + length]:
                    last = hashlib.sha256(last + digest).digest()[:16]
                    names.append(last)
                at += length
                ends.append(last)
            offsets = pa.array([0, *lengths], pa.int32()).to_numpy().cumsum().astype("int32")
            fields = [pa.field("name", pa.binary()), pa.field("words", pa.int32())]
            nodes = pa.StructArray.from_arrays([pa.array(names, pa.binary()), flat.field("words")], fields=fields)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ends, pa.binary()), pa.array(lengths, pa.int32()), pa.ListArray.from_arrays(offsets, nodes)],
                ["conv_id", "ends", "depth", "path"],
            )

    return sequences.select(F.col("conv_id").cast("long"), "turns").mapInArrow(name, f"conv_id long, ends binary, depth int, path {_PATH}")


def _cut(items: DataFrame, half: int) -> DataFrame:
    """Upper and lower parts of all items, equal ones combined."""
    parts = F.array(
        F.struct("root", "at", F.slice("seq", 1, half).alias("seq")),
        F.struct(
            F.get("seq", F.lit(half - 1))["name"].alias("root"),
            (F.col("at") + half).alias("at"),
            F.slice("seq", half + 1, half).alias("seq"),
        ),
    )
    both = items.select(F.explode(parts).alias("part"), "n", "least").filter(F.size("part.seq") > 0)
    return both.groupBy("part.root", "part.at", "part.seq").agg(F.sum("n").alias("n"), F.min("least").alias("least"))


def _grafted(totals: DataFrame, items: DataFrame, half: int) -> DataFrame:
    """Totals within tries of height 2 * ``half`` from those within ``half``; ``items`` are those of the round."""
    below = (
        totals.filter((F.col("depth") - 1) % (2 * half) == half)
        .groupBy(F.col("parent").alias("cut"))
        .agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
    )
    cuts = items.filter((F.col("at") % (2 * half) == 0) & (F.size("seq") == half)).select(
        F.get("seq", F.lit(half - 1))["name"].alias("cut"), F.transform("seq", lambda x: x["name"]).alias("above")
    )
    grafts = (
        cuts.join(below, "cut")
        .select(F.explode("above").alias("name"), "more_leaves", "more_saved")
        .groupBy("name")
        .agg(F.sum("more_leaves").alias("more_leaves"), F.sum("more_saved").alias("more_saved"))
    )
    zero = F.lit(0).cast("long")
    return totals.join(grafts, "name", "left").select(
        "name",
        "parent",
        "depth",
        (F.col("leaves") + F.coalesce("more_leaves", zero)).alias("leaves"),
        (F.col("saved") + F.coalesce("more_saved", zero)).alias("saved"),
    )


def ends_digests(named: DataFrame) -> DataFrame:
    """(name, ends_sha256) of the nodes at which conversations end."""

    def chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, ids = None, []

        def row():
            return pa.RecordBatch.from_pydict({"name": [name], "first": [ids[0]], "ids": [",".join(map(str, ids))]})

        for batch in batches:
            for end, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if ids and (end != name or len(ids) >= CHUNK_IDS):
                    yield row()
                    ids = []
                name = end
                ids.append(conv)
        if ids:
            yield row()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, state = None, None
        for batch in batches:
            done = {"name": [], "ends_sha256": []}
            for end, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if state is not None and end == name:
                    state.update(b"," + text.encode())
                    continue
                if state is not None:
                    done["name"].append(name)
                    done["ends_sha256"].append(state.hexdigest())
                name, state = end, hashlib.sha256(text.encode())
            yield pa.RecordBatch.from_arrays([pa.array(done["name"], pa.binary()), pa.array(done["ends_sha256"], pa.string())], ["name", "ends_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([name], pa.binary()), pa.array([state.hexdigest()])], ["name", "ends_sha256"])

    ranged = named.select("ends", "conv_id").repartitionByRange("ends", "conv_id").sortWithinPartitions("ends", "conv_id")
    chunks = ranged.mapInArrow(chunk, "name binary, first long, ids string")
    gathered = chunks.repartition("name").sortWithinPartitions("name", "first").select("name", "ids")
    return gathered.mapInArrow(digest, "name binary, ends_sha256 string")


def prefix_trie(sequences: DataFrame) -> DataFrame:
    """One row per node of the trie over (conv_id, turns); see the module's text.

    Columns: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256, and the node's and its parent's name.
    """
    prepare(sequences.sparkSession)
    named = written(with_names(sequences), "trie-paths")
    items = (
        named.filter("depth > 0")
        .groupBy(F.col("path").alias("seq"))
        .agg(F.count("*").alias("n"), F.min("conv_id").alias("least"))
        .select(F.lit(ROOT).alias("root"), F.lit(0).alias("at"), "seq", "n", "least")
    )
    size = named.agg(F.max("depth")).first()[0] or 0
    half = 1
    while 2 * half < size:
        half *= 2
    rounds = []
    if size > 1:
        while half >= 1:
            items = written(_cut(items, half), "trie-items")
            rounds.append((half, items))
            half //= 2
    else:
        items = written(items, "trie-items")

    last = F.get("seq", F.lit(0))
    nodes = items.select(
        last["name"].alias("name"), F.col("root").alias("parent"), (F.col("at") + 1).alias("depth"), "n", "least", last["words"].alias("words")
    )
    children = nodes.groupBy(F.col("parent").alias("name")).agg(F.count("*").alias("n_children"))
    zero = F.lit(0).cast("long")
    base = written(nodes.join(children, "name", "left").withColumn("n_children", F.coalesce("n_children", zero)), "trie-nodes")

    totals = base.select(
        "name",
        "parent",
        "depth",
        (F.col("n_children") == 0).cast("long").alias("leaves"),
        ((F.col("n") - 1) * F.col("words")).alias("saved"),
    )
    for half, cut in reversed(rounds):
        more = written(_grafted(totals, cut, half), "trie-totals")
        discard(*([totals] if hasattr(totals, "written_at") else []), cut)
        totals = more
    return _described(named, base, totals)


def _described(named: DataFrame, base: DataFrame, totals: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("long")
    top = totals.filter("depth = 1").agg(
        F.count("*").alias("n_children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")
    )
    root = (
        named.agg(F.count("*").alias("n"), F.min("conv_id").alias("least"))
        .filter("n > 0")
        .crossJoin(F.broadcast(top))  # one row each
        .select(
            F.lit(ROOT).alias("name"),
            F.lit(None).cast("binary").alias("parent"),
            F.lit(0).alias("depth"),
            "n",
            "least",
            "n_children",
            F.coalesce("leaves", F.lit(1).cast("long")).alias("leaves"),
            F.coalesce("saved", zero).alias("saved"),
        )
    )
    root = written(root, "trie-root")
    nodes = base.drop("words").join(totals.select("name", "leaves", "saved"), "name")
    parents = base.select(F.col("name").alias("parent"), F.col("least").alias("parent_least"), "n_children").unionByName(
        root.select(F.col("name").alias("parent"), F.col("least").alias("parent_least"), "n_children")
    )
    # A parent's children are counted among all nodes, so at most HEAVY parents pass.
    heavy = F.broadcast(parents.filter(F.col("n_children") * HEAVY >= F.lit(base.count())).drop("n_children"))
    parents = parents.drop("n_children")
    below = nodes.join(heavy, "parent").unionByName(nodes.join(heavy, "parent", "left_anti").join(parents, "parent"))
    every = below.unionByName(root.withColumn("parent_least", F.lit(None).cast("long")))
    none = hashlib.sha256(b"").hexdigest()
    return every.join(ends_digests(named), "name", "left").select(
        F.col("least").alias("conv_id"),
        F.col("depth").cast("long").alias("depth"),
        F.col("parent_least").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        "n_children",
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
        "name",
        "parent",
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations."""
    prepare(conversations.sparkSession)
    lists = written(turn_lists(conversations.select("conv_id", "turn", "role", "text")), "trie-turns")
    return prefix_trie(rebuilt(lists))

