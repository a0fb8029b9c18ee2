"""Pairs of similar items by the distance of their unit vectors.

The plain method compares blocks of items wherever bounds allow a pair. The probing
method looks into the likeliest buckets of narrow hashes. The bucket method compares items that share
a bucket of a random-projection hash; it runs on blocks too: each bucket is cut into
blocks of consecutive ids of bounded size, a task compares two blocks with one matrix product, and
only pairs that can be in the result leave the task. A bucket that holds a third of
all items is so many blocks, never one group. In it, an item that found its full number of neighbours of similarity
1 in its own block and the next is settled, because any other such neighbour has a larger
id and would rank behind.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise, ship_package
from .blocks import best_pairs, exact_pairs, merged, pair_columns, search
from .probing import Probing, probed_pairs

MAX_DISTANCE = 0.75
MIN_COSINE = 0.7
NEIGHBOURS = 3
BLOCK_ROWS = 2048
MAX_SLABS = 10_000
# Blocks on each side of a task that compares blocks far from each other: how often a vector travels falls by it.
FAR_BLOCKS = 16

PAIR_SCHEMA = "left_id string, right_id string, cosine_similarity double, embedding_distance double"
_PAIR_NAMES = ["left_id", "right_id", "cosine_similarity", "embedding_distance"]


@dataclass(frozen=True)
class Hashing:
    """Random-projection hashing: items meet that share all hashes of a table.

    More hashes per table make smaller buckets, more tables find more of the
    pairs that a bucket border would separate. The values are the caller's and
    never follow the number of items, which would lose pairs as it grows.
    """

    bucket_length: float = 0.25
    tables: int = 8
    hashes_per_table: int = 4
    seed: int = 42


# The wide single hashes of the title job.
WIDE_HASHING = Hashing(bucket_length=1.5, tables=3, hashes_per_table=1)


def _unit_rows(items: DataFrame, vector: str) -> DataFrame:
    """(id, unit) without null ids, and without zero vectors, which have no direction to compare."""
    is_ml = dict(items.dtypes)[vector] == "vector"
    values = vector_to_array(vector) if is_ml else F.col(vector).cast("array<double>")
    norm = F.sqrt(F.aggregate("unit", F.lit(0.0), lambda total, x: total + x * x))
    return (
        items.select(F.col("content_id").cast("string").alias("id"), values.alias("unit"))
        .withColumn("norm", norm)
        .filter((F.col("norm") > 0) & F.col("id").isNotNull())
        .select("id", F.transform("unit", lambda x: x / F.col("norm")).alias("unit"))
    )


def _buckets(rows: DataFrame, hashing: Hashing | None) -> DataFrame:
    """Add ``buckets``, those that an item belongs to."""
    if hashing is None:
        return rows.withColumn("buckets", F.array(F.lit("")))
    vectors = rows.withColumn("vector", array_to_vector("unit"))
    model = BucketedRandomProjectionLSH(
        inputCol="vector",
        outputCol="hashes",
        bucketLength=hashing.bucket_length,
        numHashTables=hashing.tables * hashing.hashes_per_table,
        seed=hashing.seed,
    ).fit(vectors)
    width = hashing.hashes_per_table
    values = F.transform("hashes", lambda h: F.get(vector_to_array(h), F.lit(0)).cast("int").cast("string"))
    keys = [
        F.concat_ws("_", F.lit(str(i)), F.slice("values", i * width + 1, width)) for i in range(hashing.tables)
    ]
    hashed = model.transform(vectors).withColumn("values", values)
    return hashed.select("id", "unit", F.array(*keys).alias("buckets"))


def _blocks(rows: DataFrame, total: int, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """Cut each bucket into blocks of ``block_rows`` consecutive ids: (row, id, bucket, block, last_block), and (row, unit).

    Items are numbered without their vectors, which lie in one row each, however many buckets they are in.

    Ids are ranged into slabs, each small enough to number its rows per bucket
    in one task; the sizes of the earlier slabs shift these numbers, so no
    task ever sorts a whole bucket. Buckets of a single item are left out.
    """
    slabs = min(MAX_SLABS, max(1, math.ceil(total / block_rows)))
    ranged = rows.repartitionByRange(slabs, "id").withColumn("slab", F.spark_partition_id())
    # Range borders are sampled, so the placement is written once and reread.
    written = materialise(ranged.withColumn("row", F.monotonically_increasing_id()), "similar-rows")
    placed = written.select("row", "id", "slab", F.explode_outer("buckets").alias("bucket"))
    cells = placed.groupBy("bucket", "slab").agg(F.count("*").alias("cell_rows"))
    whole = Window.partitionBy("bucket")
    before = whole.orderBy("slab").rowsBetween(Window.unboundedPreceding, -1)
    sized = (
        cells.withColumn("before", F.coalesce(F.sum("cell_rows").over(before), F.lit(0)))
        .withColumn("bucket_rows", F.sum("cell_rows").over(whole))
        .filter(F.col("bucket_rows") > 1)
        .drop("cell_rows")
    )
    within = Window.partitionBy("bucket", "slab").orderBy("id")
    place = F.col("before") + F.col("in_cell") - 1
    numbered = (
        placed.withColumn("in_cell", F.row_number().over(within))
        .join(sized, ["bucket", "slab"])
        .select(
            "row",
            "id",
            "bucket",
            F.floor(place / block_rows).alias("block"),
            F.floor((F.col("bucket_rows") - 1) / block_rows).alias("last_block"),
        )
    )
    return materialise(numbered, "similar-places"), written.select("row", "unit")


def _search(left: pd.DataFrame, right: pd.DataFrame, limits: dict) -> pd.DataFrame:
    """Pairs within the limits, at most ``neighbours`` per left row if that is set."""
    right = right.sort_values("id", kind="stable")
    left_ids, right_ids = left["id"].to_numpy(object), right["id"].to_numpy(object)
    found = search(left_ids, np.vstack(left["unit"].to_numpy()), right_ids, np.vstack(right["unit"].to_numpy()), limits)
    return pa.table(pair_columns(left_ids, found)).to_pandas()


def _near_pairs(blocks: DataFrame, units: DataFrame, limits: dict) -> DataFrame:
    """Each block against itself and the block after it."""
    placed = blocks.select(
        "bucket",
        F.explode_outer(
            F.array(
                F.struct(F.col("block").alias("group"), F.lit(True).alias("own")),
                F.struct((F.col("block") - 1).alias("group"), F.lit(False).alias("own")),
            )
        ).alias("place"),
        "row",
        "id",
    ).select("bucket", "place.group", "place.own", "row", "id").filter(F.col("group") >= 0)
    placed = placed.join(units, "row").drop("row")

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        own = rows[rows["own"]]
        pairs = _search(own, rows, limits) if len(own) else pd.DataFrame(columns=_PAIR_NAMES)
        return pairs.assign(bucket=key[0])

    return placed.groupBy("bucket", "group").applyInPandas(compare, PAIR_SCHEMA + ", bucket string")


def _far_places(open_rows: DataFrame, blocks: DataFrame, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """(bucket, tile, against, block, row, id) of the left and of the right rows of each task.

    A tile is a run of blocks with about ``FAR_BLOCKS`` blocks of open rows; it meets the later blocks of its bucket by as many.
    """
    counted = open_rows.groupBy("bucket", "block", "last_block").agg(F.count("*").alias("open"))
    before = Window.partitionBy("bucket").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    tiled = counted.withColumn(
        "tile", F.floor(F.coalesce(F.sum("open").over(before), F.lit(0)) / (FAR_BLOCKS * block_rows))
    )
    against = F.sequence(F.floor((F.col("first_block") + 2) / FAR_BLOCKS), F.floor(F.col("last_block") / FAR_BLOCKS))
    meetings = (
        tiled.groupBy("bucket", "tile", "last_block")
        .agg(F.min("block").alias("first_block"))
        .select("bucket", "tile", "first_block", F.explode_outer(against).alias("against"))
    )
    left = (
        open_rows.join(tiled.select("bucket", "block", "tile"), ["bucket", "block"])
        .join(meetings, ["bucket", "tile"])
        .filter(F.floor((F.col("block") + 2) / FAR_BLOCKS) <= F.col("against"))
    )
    right = (
        blocks.withColumn("against", F.floor(F.col("block") / FAR_BLOCKS))
        .join(meetings, ["bucket", "against"])
        .filter(F.col("block") >= F.col("first_block") + 2)
    )
    columns = ["bucket", "tile", "against", "block", "row", "id"]
    return left.select(columns), right.select(columns)


def _far_pairs(blocks: DataFrame, units: DataFrame, near: DataFrame, limits: dict, block_rows: int) -> DataFrame:
    """Items that are not settled against the blocks from the second next on."""
    open_rows = blocks.filter(F.col("block") <= F.col("last_block") - 2)
    if limits["neighbours"] is not None:
        settled = (
            near.groupBy("bucket", F.col("left_id").alias("id"))
            .agg(F.count_if(F.col("cosine_similarity") >= 1.0).alias("equal"))
            .filter(F.col("equal") >= limits["neighbours"])
            .select("bucket", "id")
        )
        open_rows = open_rows.join(settled, ["bucket", "id"], "left_anti")
    left, right = (side.join(units, "row").drop("row") for side in _far_places(open_rows, blocks, block_rows))

    def compare(key: tuple, lefts: pd.DataFrame, rights: pd.DataFrame) -> pd.DataFrame:
        if not len(lefts) or not len(rights):
            return pd.DataFrame(columns=_PAIR_NAMES)
        lefts = lefts.sort_values(["block", "id"], kind="stable")
        ids, vectors, held = lefts["id"].to_numpy(object), np.vstack(lefts["unit"].to_numpy()), lefts["block"].to_numpy()
        found = []
        for block, part in rights.groupby("right_block"):
            part = part.sort_values("right_id", kind="stable")
            # The left rows of the blocks up to the one before the last lie in front.
            n = np.searchsorted(held, block - 2, side="right")
            found += search(ids[:n], vectors[:n], part["right_id"].to_numpy(object), np.vstack(part["right_unit"].to_numpy()), limits)
        return pa.table(pair_columns(ids, merged(ids, found, limits["neighbours"]))).to_pandas()

    right = right.select(*[F.col(name).alias(f"right_{name}") for name in right.columns])
    right_groups = right.groupBy("right_bucket", "right_tile", "right_against")
    return left.groupBy("bucket", "tile", "against").cogroup(right_groups).applyInPandas(compare, PAIR_SCHEMA)


def _bucket_pairs(rows: DataFrame, limits: dict, hashing: Hashing, block_rows: int) -> DataFrame:
    """Pairs that share a bucket of a table of whole hashes."""
    total = rows.count()
    blocks, units = _blocks(_buckets(rows, hashing), total, block_rows)
    near = _near_pairs(blocks, units, limits)
    pairs = near.drop("bucket")
    if total > 2 * block_rows:
        near = materialise(near, "similar-near")
        pairs = near.drop("bucket").unionByName(_far_pairs(blocks, units, near, limits, block_rows))
    return best_pairs(pairs, limits["neighbours"])


def pruning_report(
    items: DataFrame,
    vector: str,
    max_distance: float = MAX_DISTANCE,
    min_cosine: float = MIN_COSINE,
    neighbours: int | None = NEIGHBOURS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """What the exact method spares on these items: blocks, ordered pairs of blocks, those that met, the share skipped."""
    ship_package(items.sparkSession)
    limits = {"max_distance": max_distance, "min_cosine": min_cosine, "neighbours": neighbours}
    return exact_pairs(materialise(_unit_rows(items, vector).distinct(), "similar-items"), limits, block_rows)[1]


def similar_pairs(
    items: DataFrame,
    vector: str,
    max_distance: float = MAX_DISTANCE,
    min_cosine: float = MIN_COSINE,
    neighbours: int | None = NEIGHBOURS,
    hashing: Hashing | Probing | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Pairs ``left id < right id`` nearer than ``max_distance``.

    ``neighbours`` keeps the best of each left item, by rounded similarity and
    then right id; ``None`` keeps all pairs. Rows of one id are one item, whose similarity to another is that
    of their nearest vectors. Without ``hashing`` the result is exact: blocks of items meet unless bounds rule out
    a pair (``operators.blocks``). ``Probing`` compares an item with buckets of bounded size (``operators.probing``),
    ``Hashing`` with those that share all hashes of a table.
    """
    ship_package(items.sparkSession)
    limits = {"max_distance": max_distance, "min_cosine": min_cosine, "neighbours": neighbours}
    rows = _unit_rows(items, vector).distinct()
    if hashing is None:
        pairs, _ = exact_pairs(materialise(rows, "similar-items"), limits, block_rows)
    elif isinstance(hashing, Probing):
        pairs = probed_pairs(materialise(rows, "similar-items"), limits, hashing, block_rows)
    else:
        pairs = _bucket_pairs(rows, limits, hashing, block_rows)
    return pairs.select(
        F.col("left_id").alias("left_content_id"),
        F.col("right_id").alias("right_content_id"),
        "cosine_similarity",
        "embedding_distance",
    )


def describe_pairs(pairs: DataFrame, items: DataFrame) -> DataFrame:
    """Add title, type and topic of both items."""

    def side(name: str) -> DataFrame:
        return items.select(
            *[
                F.col(column).alias(f"{name}_{column}")
                for column in ("content_id", "title", "content_type", "topic_cluster")
            ]
        )

    described = pairs.join(side("left"), "left_content_id").join(side("right"), "right_content_id")
    return described.select(
        *[
            f"{name}_{column}"
            for name in ("left", "right")
            for column in ("content_id", "title", "content_type", "topic_cluster")
        ],
        "cosine_similarity",
        "embedding_distance",
    )
