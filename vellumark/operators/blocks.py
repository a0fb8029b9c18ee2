"""Exact pairs of near unit vectors from blocks that meet only where they can.

1. Cells: every vector goes to the nearest of some pivots, so near vectors share a cell.
2. Blocks: a cell is cut into blocks of consecutive ids of bounded size; a block is one row
   with its ids, its vectors as bytes, their centroid and the radius around it. A cell that
   holds a third of all rows is so many blocks.
3. First meetings: with a neighbour limit, a block meets itself and the next of its cell, and
   of the cells it can reach the first blocks of the ``FIRST_CELLS`` nearest. That gives most items
   their full number of neighbours, and so a distance that further neighbours must not exceed.
4. Other meetings: by the triangle inequality two blocks hold no pair nearer than the
   distance of their centroids less both radii. A block is held first against whole cells and then
   against the blocks of those left; it meets a block only if the bound is below what its items
   still need, and if ids larger than its least are there. Items that found their full
   number at similarity 1 in their own cell cannot do better there: ids in a cell are
   consecutive, so all others rank behind. Copies, however many, are done after the first meetings.

Rows of one id are one item: equal rows count once, and a pair of ids has the similarity of its nearest
vectors. Null ids and zero vectors take no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

MAX_SLABS = 10_000
# Pivots are held by every task: at most this many vectors.
MAX_CELLS = 4096
CELLS_PER_BLOCK = 2
# Pivots nearer than this are one, so that copies do not share out a cell.
PIVOT_GAP = 0.2
FIRST_CELLS = 2
SLACK = 1e-9

PACKED = (
    "cell long, block long, ids array<string>, units binary, centroid binary, radius double, "
    "first_id string, last_id string"
)
PAIRS = "left_id string, right_id string, cosine_similarity double, embedding_distance double"
_FOUND = f"cell long, block long, {PAIRS}"
_PLACE = "struct<to_cell: bigint, to_block: bigint>"
# Items on each side of a tile: what one task holds. Small inputs make smaller tiles, so that all cores have some.
TILE_ROWS = 32_768
TILE_LEAST = 512


def numbered_blocks(rows: DataFrame, bucket: list[str], total: int, block_rows: int) -> DataFrame:
    """Cut each bucket into blocks of ``block_rows`` consecutive ids.

    Ids are ranged into slabs, each small enough to number its rows per bucket
    in one task; the sizes of the earlier slabs shift these numbers, so no
    task ever sorts a whole bucket.
    """
    slabs = min(MAX_SLABS, max(1, math.ceil(total / block_rows)))
    ranged = rows.repartitionByRange(slabs, "id").withColumn("slab", F.spark_partition_id())
    # Range borders are sampled, so the placement is written once and reread.
    placed = materialise(ranged, "similar-rows")
    cells = placed.groupBy(*bucket, "slab").agg(F.count("*").alias("cell_rows"))
    before = Window.partitionBy(*bucket).orderBy("slab").rowsBetween(Window.unboundedPreceding, -1)
    sized = cells.withColumn("before", F.coalesce(F.sum("cell_rows").over(before), F.lit(0))).drop("cell_rows")
    within = Window.partitionBy(*bucket, "slab").orderBy("id", "unit")
    place = F.col("before") + F.col("in_cell") - 1
    return (
        placed.withColumn("in_cell", F.row_number().over(within))
        .join(sized, [*bucket, "slab"])
        .select(*bucket, F.floor(place / block_rows).alias("block"), "id", "unit")
    )


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    flat = column.combine_chunks().flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _pivots(rows: DataFrame, total: int, block_rows: int) -> np.ndarray:
    """Vectors of the ids with the least hashes, without near copies; at most ``MAX_CELLS``."""
    wanted = min(MAX_CELLS, CELLS_PER_BLOCK * math.ceil(total / block_rows))
    if wanted <= CELLS_PER_BLOCK:
        wanted = 1
    picked = rows.orderBy(F.xxhash64("id"), "id", "unit").limit(wanted).collect()
    kept: list[np.ndarray] = []
    for unit in np.array([r["unit"] for r in picked], np.float64):
        if not kept or np.min(np.linalg.norm(np.array(kept) - unit, axis=1)) > PIVOT_GAP:
            kept.append(unit)
    return np.array(kept)


def _in_cells(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Add the number of the nearest pivot."""
    squares = (pivots**2).sum(1)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, pivots.shape[1])
            cells = np.concatenate(
                [np.argmin(squares - 2 * units[i : i + 4096] @ pivots.T, axis=1) for i in range(0, len(units), 4096)]
                or [np.empty(0, np.int64)]
            )
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.int64())], ["id", "unit", "cell"])

    return rows.mapInArrow(assign, "id string, unit array<double>, cell long")


def packed_blocks(blocks: DataFrame, width: int) -> DataFrame:
    """One row per block, its items in the order of their ids."""

    def pack(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("id")
        units = _matrix(rows.column("unit"), width)
        centroid = units.mean(0)
        ids = rows.column("id").combine_chunks()
        return pa.table(
            {
                "cell": rows.column("cell").slice(0, 1),
                "block": rows.column("block").slice(0, 1),
                "ids": pa.array([ids.to_pylist()], pa.list_(pa.string())),
                "units": pa.array([units.tobytes()], pa.binary()),
                "centroid": pa.array([centroid.tobytes()], pa.binary()),
                "radius": pa.array([float(np.sqrt(((units - centroid) ** 2).sum(1).max()))]),
                "first_id": pa.array([ids[0].as_py()]),
                "last_id": pa.array([ids[len(ids) - 1].as_py()]),
            }
        )

    return blocks.groupBy("cell", "block").applyInArrow(pack, PACKED)


def _groups(ids: np.ndarray) -> np.ndarray:
    """Where a new id starts in sorted ids."""
    return np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))


def search(left_ids, left, right_ids, right, limits: dict, needed: np.ndarray | None = None, centre=None) -> list[tuple]:
    """(left places, right ids, similarity units, distances) of the pairs within the limits.

    Both sides are sorted by id. With ``neighbours`` at most that many ids per left row. ``needed`` is, per
    left row, the largest distance that can still matter, and ``centre`` the right side's (centroid, radius).
    """
    keep, found = limits["neighbours"], []
    open_rows = np.arange(len(left_ids))
    far = np.full(len(left_ids), limits["max_distance"])
    if needed is not None:
        far = np.minimum(far, needed)
        to_centre = np.sqrt(np.maximum(((left - centre[0]) ** 2).sum(1), 0))
        open_rows = open_rows[to_centre - centre[1] <= needed + SLACK]
    starts = _groups(right_ids)
    names = right_ids[starts]
    first = np.searchsorted(names, left_ids, side="right")
    open_rows = open_rows[first[open_rows] < len(names)]
    least_units = round(limits["min_cosine"] * 10000)
    # The least product of a pair that can count; the limits themselves are tested on the few that reach it.
    floor = np.maximum(1.0 - far**2 / 2.0, (least_units - 0.5) / 10000) - 1e-7
    for begin in range(0, len(open_rows), 512):
        rows = open_rows[begin : begin + 512]
        # Names that are larger than the least id of these rows.
        lowest = int(first[rows].min())
        products = left[rows] @ right[starts[lowest] :].T
        if len(starts) < len(right_ids):
            products = np.maximum.reduceat(products, starts[lowest:] - starts[lowest], axis=1)
        if keep is not None and keep < products.shape[1]:
            products[np.arange(lowest, len(names)) < first[rows, None]] = -2.0
            reached = products >= floor[rows, None]
            if np.count_nonzero(reached) > 4 * keep * len(rows):
                # Rounding is monotonous, so what is rounded below the last one wanted cannot be among them.
                last = np.partition(products, -keep, axis=1)[:, -keep] - 1.01 / 10000
                reached &= products >= last[:, None]
        else:
            reached = products >= floor[rows, None]
        i, j = np.nonzero(reached)
        squared = np.maximum(2.0 - 2.0 * products[i, j], 0.0)
        units = np.floor((1.0 - squared / 2.0) * 10000 + 0.5).astype(np.int64)
        distance = np.sqrt(squared)
        j = j + lowest
        valid = (j >= first[rows[i]]) & (distance < limits["max_distance"]) & (units >= least_units)
        i, j, units, distance = i[valid], j[valid], units[valid], distance[valid]
        if keep is not None:
            chosen = _leading(i, j, units, keep)
            i, j, units, distance = i[chosen], j[chosen], units[chosen], distance[chosen]
        found.append((rows[i], names[j], units, distance))
    return found


def _leading(i: np.ndarray, j: np.ndarray, units: np.ndarray, keep: int) -> np.ndarray:
    """Places of the first ``keep`` per ``i``: higher similarity first, then the smaller ``j``."""
    order = np.lexsort((j, -units, i))
    row = i[order]
    begins = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(row) else row
    rank = np.arange(len(row)) - np.repeat(begins, np.diff(np.append(begins, len(row))))
    return order[rank < keep]


def merged(left_ids: np.ndarray, found: list[tuple], keep: int | None) -> list[tuple]:
    """What several searches of the same left rows found, each pair of a row and an id once, the best ``keep`` per row."""
    if len(found) < 2 or keep is None:
        return found
    i, names, units, distance = (np.concatenate([f[k] for f in found]) for k in range(4))
    if not len(i):
        return []
    names, j = np.unique(names, return_inverse=True)
    order = np.lexsort((distance, -units, j, i))
    i, j, units, distance = i[order], j[order], units[order], distance[order]
    fresh = np.concatenate([[True], (i[1:] != i[:-1]) | (j[1:] != j[:-1])])
    i, j, units, distance = i[fresh], j[fresh], units[fresh], distance[fresh]
    chosen = _leading(i, j, units, keep)
    return [(i[chosen], names[j[chosen]], units[chosen], distance[chosen])]


def pair_columns(left_ids: np.ndarray, found: list[tuple]) -> dict:
    i = np.concatenate([f[0] for f in found] or [np.empty(0, np.int64)])
    return {
        "left_id": pa.array(left_ids[i], pa.string()),
        "right_id": pa.array(np.concatenate([f[1] for f in found] or [np.empty(0, object)]), pa.string()),
        "cosine_similarity": pa.array(np.concatenate([f[2] for f in found] or [np.empty(0)]) / 10000.0, pa.float64()),
        "embedding_distance": pa.array(
            np.floor(np.concatenate([f[3] for f in found] or [np.empty(0)]) * 10000 + 0.5) / 10000.0, pa.float64()
        ),
    }


def _tile_groups(packed: DataFrame) -> int:
    """Groups of about ``TILE_ROWS`` items, enough of them for all cores."""
    rows = packed.agg(F.sum(F.size("ids"))).first()[0] or 0
    cores = packed.sparkSession.sparkContext.defaultParallelism
    return max(math.ceil(rows / TILE_ROWS), min(math.ceil(math.sqrt(2 * cores)), math.ceil(rows / TILE_LEAST)), 1)


def _group(cell: str, block: str, groups: int):
    return F.pmod(F.xxhash64(cell, block), F.lit(groups))


def compared(
    packed: DataFrame,
    others: DataFrame,
    meetings: DataFrame,
    limits: dict,
    width: int,
    state: DataFrame | None = None,
    met: DataFrame | None = None,
) -> DataFrame:
    """Pairs of the blocks that meet: ``meetings`` has cell, block (of ``packed``), to_cell, to_block (of ``others``).

    Blocks are dealt into groups, and two groups are a tile: a block travels once to each tile in which it meets any
    other, not once per meeting, and a tile yields the best of a left row over all its meetings. Without
    ``to_block`` a meeting is with every block of a cell for which bounds leave room by the ``state`` of the left
    block, those of ``met`` apart.
    """
    left_groups, right_groups = _tile_groups(packed), _tile_groups(others)
    left_group, right_group = _group("cell", "block", left_groups), _group("to_cell", "to_block", right_groups)
    if "to_block" in meetings.columns:
        wanted = meetings.select("cell", "block", "to_cell", "to_block").withColumn("right", right_group)
    else:
        placed = others.select(F.col("cell").alias("to_cell"), F.col("block").alias("to_block")).withColumn("right", right_group)
        places = placed.select("to_cell", "right").distinct()
        wanted = meetings.select("cell", "block", "to_cell").join(places, "to_cell").withColumn("to_block", F.lit(-1).cast("long"))
    tiled = wanted.groupBy("cell", "block", "right").agg(F.collect_set(F.struct("to_cell", "to_block")).alias("partners"))
    tiled = materialise(tiled.withColumn("left", left_group), "similar-tiles")

    nothing = {"needs": "map<string,double>", "need": "double", "until": "string", "done": f"array<{_PLACE}>"}
    held = packed.select("cell", "block", "ids", "units", "centroid", "radius", "first_id", "last_id")
    if state is not None:
        until = F.when(F.col("same"), F.coalesce("until", F.lit(""))).alias("until")
        held = held.join(state.select("cell", "block", "needs", "need", until), ["cell", "block"])
    if met is not None:
        done = met.groupBy("cell", "block").agg(F.collect_set(F.struct("to_cell", "to_block")).alias("done"))
        held = held.join(done, ["cell", "block"], "left")
    left = held.withColumns({name: F.lit(None).cast(kind) for name, kind in nothing.items() if name not in held.columns})
    left = tiled.join(left, ["cell", "block"])
    # A right block is sent to the tiles of its group in which its cell or itself is wanted.
    asked = tiled.select("left", "right", F.explode("partners").alias("p")).select("left", "right", "p.to_cell", "p.to_block").distinct()
    right = others.select(
        F.col("cell").alias("to_cell"), F.col("block").alias("to_block"), "ids", "units", "centroid", "radius", "first_id", "last_id"
    )
    if "to_block" in meetings.columns:
        right = asked.join(right, ["to_cell", "to_block"])
    else:
        right = asked.drop("to_block").join(right.withColumn("right", right_group), ["to_cell", "right"])
    right = right.withColumnsRenamed({"to_cell": "cell", "to_block": "block"})
    right = right.withColumns({"partners": F.lit(None).cast(f"array<{_PLACE}>"), **{name: F.lit(None).cast(kind) for name, kind in nothing.items()}})
    both = left.withColumn("own", F.lit(True)).unionByName(right.withColumn("own", F.lit(False)))

    def compare(rows: pa.Table) -> pa.Table:
        sides: dict[bool, list] = {True: [], False: []}
        for row in rows.to_pylist():
            row["ids"] = np.array(row["ids"], object)
            row["units"] = np.frombuffer(row["units"]).reshape(-1, width)
            row["centroid"] = np.frombuffer(row["centroid"])
            sides[row["own"]].append(row)
        others = sides[False]
        centroids = np.array([r["centroid"] for r in others]).reshape(-1, width)
        radii = np.array([r["radius"] for r in others])
        out = []
        for own in sides[True]:
            partners, done = ({(p["to_cell"], p["to_block"]) for p in own[name] or ()} for name in ("partners", "done"))
            needed = None
            if own["needs"] is not None:
                needs = dict(own["needs"])
                needed = np.array([needs.get(name, limits["max_distance"]) for name in own["ids"]])
            need = limits["max_distance"] if own["need"] is None else own["need"]
            bound = np.sqrt(((centroids - own["centroid"]) ** 2).sum(1)) - radii - own["radius"]
            found = []
            for to in np.flatnonzero(bound <= need + SLACK).tolist():
                other = others[to]
                at = other["cell"], other["block"]
                if at not in partners and ((at[0], -1) not in partners or at in done):
                    continue
                if other["last_id"] <= own["first_id"]:
                    continue
                if own["until"] is not None and other["first_id"] >= own["until"]:
                    continue
                found += search(own["ids"], own["units"], other["ids"], other["units"], limits, needed, (other["centroid"], other["radius"]))
            columns = pair_columns(own["ids"], merged(own["ids"], found, limits["neighbours"]))
            n = len(columns["left_id"])
            out.append(pa.table({"cell": pa.array([own["cell"]] * n, pa.int64()), "block": pa.array([own["block"]] * n, pa.int64()), **columns}))
        names = ["cell", "block", "left_id", "right_id", "cosine_similarity", "embedding_distance"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        return pa.concat_tables([pa.schema(list(zip(names, kinds, strict=True))).empty_table(), *out])

    return both.groupBy("left", "right").applyInArrow(compare, _FOUND)


def best_pairs(pairs: DataFrame, neighbours: int | None, unique: bool = False) -> DataFrame:
    """Each pair of ids once, at its nearest; with ``neighbours`` the best of each left id.

    ``unique`` says that no pair occurs twice.
    """
    if unique and neighbours is None:
        return pairs
    once = pairs.groupBy("left_id", "right_id").agg(
        F.max("cosine_similarity").alias("cosine_similarity"), F.min("embedding_distance").alias("embedding_distance")
    )
    if neighbours is None:
        return once
    best = Window.partitionBy("left_id").orderBy(F.desc("cosine_similarity"), F.asc("right_id"))
    return once.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= neighbours).drop("rank")


def _state(packed: DataFrame, near: DataFrame, limits: dict) -> DataFrame:
    """Per block what its items still need: ``needs`` by id, the largest ``need``, and for blocks
    that are done with their own cell (``same``) the id from which on nothing matters (``until``).
    """
    keep, far = limits["neighbours"], limits["max_distance"]
    ranked = best_pairs(near.select("left_id", "right_id", "cosine_similarity", "embedding_distance"), keep)
    full = ranked.groupBy(F.col("left_id").alias("id")).agg(
        F.count("*").alias("found"), F.min("cosine_similarity").alias("least"), F.max("right_id").alias("last")
    )
    # A further neighbour must reach the rounded similarity of the last one found.
    need = F.least(F.lit(far), F.sqrt(F.greatest(F.lit(0.0), 2 * (1 - F.col("least") + 0.5 / 10000))) + SLACK)
    full = full.filter(F.col("found") >= keep).select("id", need.alias("need"), "least", "last")
    # Ids up to the end of the next block of the cell have been met.
    ends = packed.select("cell", (F.col("block") - 1).alias("block"), F.col("last_id").alias("end"))
    items = packed.select("cell", "block", F.explode("ids").alias("id")).distinct()
    held = items.join(ends, ["cell", "block"], "left").join(full, "id", "left")
    same = (F.col("least") >= 1.0) & (F.col("end").isNull() | (F.col("last") <= F.col("end")))
    return held.groupBy("cell", "block").agg(
        F.map_from_entries(F.collect_list(F.when(F.col("need").isNotNull(), F.struct("id", "need")))).alias("needs"),
        F.max(F.coalesce("need", F.lit(far))).alias("need"),
        F.min(F.coalesce(same, F.lit(False))).alias("same"),
        F.max("last").alias("until"),
    )


def _reach(summaries: DataFrame, pivots: np.ndarray, radii: np.ndarray, nearest: int | None) -> DataFrame:
    """Cells that a block can reach within its ``need``; with ``nearest`` only so many, its own apart."""

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.to_pydict()
            centroids = np.frombuffer(b"".join(columns["centroid"])).reshape(-1, pivots.shape[1])
            away = np.sqrt(np.maximum((centroids**2).sum(1)[:, None] + (pivots**2).sum(1) - 2 * centroids @ pivots.T, 0))
            bound = away - np.array(columns["radius"])[:, None] - radii
            can = bound <= np.array(columns["need"])[:, None] + SLACK
            own = np.array(columns["cell"])
            if nearest is not None:
                can[np.arange(len(own)), own] = False
                rank = np.argsort(np.argsort(np.where(can, bound, np.inf), axis=1, kind="stable"), axis=1)
                can &= rank < nearest
            i, j = np.nonzero(can)
            kept = [batch.column(k).take(pa.array(i)) for k, name in enumerate(batch.schema.names) if name in _REACH]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(j, pa.int64())], [*_REACH, "to_cell"])

    wanted = summaries.select("cell", "block", "first_id", "same", "centroid", "radius", "need")
    return wanted.mapInArrow(reach, "cell long, block long, first_id string, same boolean, to_cell long")


def _apart(width: int):
    """Distance of two packed centroids, for block summaries only."""

    def distance(a: pa.Array, b: pa.Array) -> np.ndarray:
        left, right = (np.frombuffer(b"".join(x.to_pylist())).reshape(-1, width) for x in (a, b))
        return np.sqrt(((left - right) ** 2).sum(1))

    return distance


def _within(candidates: DataFrame, width: int) -> DataFrame:
    """Keep the meetings whose bound is within the left block's need."""
    apart = _apart(width)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            bound = apart(at["centroid"], at["to_centroid"]) - at["radius"].to_numpy() - at["to_radius"].to_numpy()
            mask = pa.array(bound <= at["need"].to_numpy() + SLACK)
            yield pa.RecordBatch.from_arrays([at[name].filter(mask) for name in _MEET], _MEET)

    return candidates.mapInArrow(keep, "cell long, block long, to_cell long, to_block long")


_REACH = ["cell", "block", "first_id", "same"]
_MEET = ["cell", "block", "to_cell", "to_block"]


def exact_pairs(rows: DataFrame, limits: dict, block_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """(pairs, report) of distinct (id, unit) rows.

    The report has one row: blocks, the ordered pairs of blocks that ids allow, those that met, and the share skipped.
    """
    spark = rows.sparkSession
    total = rows.count()
    if not total:
        return spark.createDataFrame([], PAIRS), None
    pivots = _pivots(rows, total, block_rows)
    width = pivots.shape[1]
    packed = materialise(packed_blocks(numbered_blocks(_in_cells(rows, pivots), ["cell"], total, block_rows), width), "similar-blocks")
    plain = packed.drop("units", "ids", "last_id").withColumns({"need": F.lit(limits["max_distance"]), "same": F.lit(False), "until": F.lit(None).cast("string")})
    # How far a cell's vectors lie from its pivot: at most MAX_CELLS rows.
    radii = np.full(len(pivots), -np.inf)
    for row in _spread(plain, pivots).collect():
        radii[row["cell"]] = row["far"]

    # Each block meets itself and the next of its cell; the latter's ids are all larger.
    after = plain.select("cell", (F.col("block") - 1).alias("block"), F.col("block").alias("to_block"))
    own = plain.select("cell", "block", F.col("cell").alias("to_cell"), F.col("block").alias("to_block"))
    near = own.unionByName(after.withColumn("to_cell", F.col("cell")).filter("block >= 0"))
    others = packed.select(
        F.col("cell").alias("to_cell"),
        F.col("block").alias("to_block"),
        F.col("centroid").alias("to_centroid"),
        F.col("radius").alias("to_radius"),
        F.col("first_id").alias("to_first"),
        "last_id",
    )
    keep = limits["neighbours"]
    met, state = near, None
    if keep is not None:
        # Of the nearest other cells, the block that goes on from the least id.
        ahead = _reach(plain, pivots, radii, FIRST_CELLS).join(others, "to_cell").filter(F.col("last_id") > F.col("first_id"))
        some = ahead.groupBy("cell", "block", "to_cell").agg(F.min("to_block").alias("to_block"))
        met = materialise(near.unionByName(some.select(*_MEET)), "similar-first")
        found = materialise(compared(packed, packed, met, limits, width), "similar-near")
        state = materialise(_state(packed, found, limits), "similar-state")
        plain = plain.drop("need", "same", "until").join(state.drop("needs"), ["cell", "block"])
    # Blocks of which cells; which of those the bounds leave is settled where they meet.
    ahead = _reach(plain, pivots, radii, None).filter(~(F.col("same") & (F.col("to_cell") == F.col("cell"))))
    pairs = compared(packed, packed, ahead.select("cell", "block", "to_cell"), limits, width, state, None if keep is None else met)
    unique = False
    if keep is None:
        unique = rows.select("id").distinct().count() == total
    else:
        pairs = found.unionByName(pairs)
    # What the report counts, the same bounds once more; computed only if it is asked for.
    early = ~F.col("same") | (F.col("to_first") < F.col("until"))
    candidates = ahead.select("cell", "block", "to_cell").join(plain, ["cell", "block"]).join(others, "to_cell")
    further = _within(candidates.filter((F.col("last_id") > F.col("first_id")) & early), width)
    met = further if keep is None else met.unionByName(further.join(met, _MEET, "left_anti"))
    blocks = packed.select("cell", "block", "first_id", "last_id")
    counted = blocks.agg(F.count("*").alias("blocks")).crossJoin(met.agg(F.count("*").alias("met")))  # one row each
    allowed = F.col("blocks") * F.col("blocks")
    report = counted.select("blocks", allowed.alias("block_pairs"), "met", (1 - F.col("met") / allowed).alias("skipped"))
    return best_pairs(pairs.drop("cell", "block"), keep, unique), report


def _spread(plain: DataFrame, pivots: np.ndarray) -> DataFrame:
    def far(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = batch.column(0).to_numpy()
            centroids = np.frombuffer(b"".join(batch.column(1).to_pylist())).reshape(-1, pivots.shape[1])
            reach = np.sqrt(((centroids - pivots[cells]) ** 2).sum(1)) + batch.column(2).to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(reach)], ["cell", "far"])

    return plain.select("cell", "centroid", "radius").mapInArrow(far, "cell long, far double").groupBy("cell").agg(F.max("far").alias("far"))
