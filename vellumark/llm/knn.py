"""Exact top-k inner products by a Voronoi join.

Data vectors go to the cell of their nearest pivot. Each cell is summarised by
its size, its greatest distance from the pivot, and the least and greatest value per
component, from which follows an upper bound on the product of any vector of the cell
with a query. A first join solves each query in its most promising cells that hold at
least k candidates; its k-th score then is a lower bound. A second join sends the query
to just those other cells whose bound reaches it, and gives back only products that
reach it too. ``BUNDLE`` cells share their queries: a query goes there once, with the
set of cells to search as bits. Bundles are cut into blocks of bounded size, and so are the
queries of a bundle; every task multiplies two blocks.

Of equal vectors only the k + 1 with the smallest ids can be among anyone's k best, so
no more of them are searched, however many copies there are.

Vectors that are null, empty, or hold nulls, NaN or infinities take no part, nor do
rows without an id. Rows that repeat an id and vector count once; a query never
meets a row of its own id. Only vectors of equal length are compared. Scores
must lie above -2^62 and below 2^62.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import mix, prepare, written

PIVOTS = 256
BUNDLE = 16
SAMPLE = 4096
BLOCK = 4096
EXACT = float(1 << 52)
LEAST = -(1 << 62)


def integer_vectors(df: DataFrame, scale: int, ident: str, vector: str) -> DataFrame:
    """(id, size, packed): floor(scale * x) per component as little-endian integers, as wide as the vector needs."""
    prepare(df.sparkSession)
    value = F.col(vector)
    usable = (
        F.col(ident).isNotNull()
        & value.isNotNull()
        & (F.size(value) > 0)
        & F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    )
    plain = df.filter(F.coalesce(usable, F.lit(False))).select(
        F.col(ident).cast("long").alias("id"), F.transform(value, lambda x: x.cast("double")).alias("vector")
    )

    def pack(batches):
        for frame in batches:
            whole = [np.floor(scale * np.asarray(v, np.float64)).astype(np.int64) for v in frame["vector"]]
            packed = [v.astype(_narrowest(v)).tobytes() for v in whole]
            yield pd.DataFrame({"id": frame["id"], "size": [len(v) for v in whole], "packed": packed})

    return plain.mapInPandas(pack, "id long, size int, packed binary").dropDuplicates()


def _narrowest(values: np.ndarray) -> str:
    return next((t for t in ("<i1", "<i2", "<i4") if np.iinfo(t).min <= values.min() and values.max() <= np.iinfo(t).max), "<i8")


def matrix(packed, size: int) -> np.ndarray:
    """The vectors as rows of 64-bit integers; a vector's length in bytes tells its width."""
    packed = list(packed)
    widths = {len(p) // size for p in packed}
    if len(widths) == 1:
        return np.frombuffer(b"".join(packed), f"<i{widths.pop()}").reshape(-1, size).astype(np.int64)
    rows = [np.frombuffer(p, f"<i{len(p) // size}") for p in packed]
    return np.array(rows, np.int64).reshape(-1, size)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products; in floating point where that is exact."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def leading_products(score: np.ndarray, least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k largest of each row that are above LEAST and reach ``least``, ties to smaller columns."""
    rows, n = score.shape
    usable = (score > LEAST) & (score >= least[:, None])
    if n <= k or usable.sum(1).max(initial=0) <= k:
        return np.nonzero(usable)
    most = int(np.abs(np.where(usable, score, 0)).max(initial=0))
    if most < (1 << 61) // n:
        # One number orders by score and then by column.
        keys = np.where(usable, score * n + (n - 1 - np.arange(n)), LEAST)
        at = np.argpartition(keys, n - k, axis=1)[:, n - k :]
    else:
        at = np.argsort(-np.where(usable, score, LEAST), axis=1, kind="stable")[:, :k]
    row = np.repeat(np.arange(rows), k)
    column = at.ravel()
    keep = usable[row, column]
    return row[keep], column[keep]


class Cells:
    """Pivots of one vector length, and per cell the size, the reach and the box of its vectors."""

    def __init__(self, pivots: np.ndarray):
        self.pivots = pivots.astype(np.float64)
        self.half = (self.pivots**2).sum(1) / 2
        n, width = pivots.shape
        self.count = np.zeros(n, np.int64)
        self.far = np.zeros(n)
        self.low = np.full((n, width), np.inf)
        self.high = np.full((n, width), -np.inf)

    def nearest(self, vectors: np.ndarray) -> np.ndarray:
        return np.argmax(vectors.astype(np.float64) @ self.pivots.T - self.half, axis=1)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Upper bound of the product of each query with each cell; -inf for empty cells."""
        q = queries.astype(np.float64)
        plus, minus = np.maximum(q, 0), np.minimum(q, 0)
        full = self.count > 0
        out = np.full((len(q), len(self.count)), -np.inf)
        box = plus @ self.high[full].T + minus @ self.low[full].T
        length = np.sqrt((q**2).sum(1))[:, None]
        ball = q @ self.pivots[full].T + length * self.far[full]
        # The sums of the ball cancel, so its slack follows from what it adds up.
        ball += length * (self.far[full] + np.sqrt(2 * self.half[full])) * 1e-12
        out[:, full] = np.minimum(box + np.abs(box) * 1e-12, ball)
        return out


def choose_pivots(sample: np.ndarray, count: int, rounds: int = 5) -> np.ndarray:
    """Centres of a few rounds of k-means over the sample, started from rows spread over it."""
    centres = np.unique(sample, axis=0).astype(np.float64)
    order = np.argsort(mix(np.arange(len(centres), dtype=np.uint64)))
    centres = centres[order[:count]]
    for _ in range(rounds):
        cell = np.argmax(sample @ centres.T - (centres**2).sum(1) / 2, axis=1)
        sums, counts = np.zeros_like(centres), np.bincount(cell, minlength=len(centres))
        np.add.at(sums, cell, sample)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def _summaries(cells: DataFrame, known: dict[int, Cells]) -> list:
    """Per cell its size, reach and box, combined in tasks first; at most PIVOTS rows per length come back."""

    def part(batches):
        held = {}
        for frame in batches:
            for (size, cell), rows in frame.groupby(["size", "cell"]):
                m = matrix(rows["packed"], size)
                pivot = known[size].pivots[cell] if size in known else np.zeros(size)
                far = float(np.sqrt(((m - pivot) ** 2).sum(1).max()))
                n, most, low, high = held.get((size, cell), (0, far, m[0], m[0]))
                held[size, cell] = n + len(m), max(most, far), np.minimum(low, m.min(0)), np.maximum(high, m.max(0))
        for (size, cell), (n, far, low, high) in held.items():
            yield pd.DataFrame({"size": [size], "cell": [cell], "rows": [n], "far": [far], "low": [low.tolist()], "high": [high.tolist()]})

    parts = cells.select("size", "cell", "packed").mapInPandas(
        part, "size int, cell int, rows long, far double, low array<long>, high array<long>"
    )
    long = parts.select("size", "cell", "rows", "far", F.posexplode(F.arrays_zip("low", "high")).alias("at", "x"))
    boxes = long.groupBy("size", "cell", "at").agg(
        F.sum("rows").alias("rows"), F.max("far").alias("far"), F.min("x.low").alias("low"), F.max("x.high").alias("high")
    )
    return (
        boxes.groupBy("size", "cell")
        .agg(F.first("rows").alias("rows"), F.max("far").alias("far"), F.array_sort(F.collect_list(F.struct("at", "low", "high"))).alias("box"))
        .collect()
    )


def top_products(
    data: DataFrame, is_query, k: int = 20, scale: int = 64, ident: str = "vec_id", vector: str = "embedding", pivots: int = PIVOTS, block: int = BLOCK
) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest products of each query with the other rows, ties to the smaller id.

    ``is_query`` tells the queries by the id column ``id``.
    """
    spark = data.sparkSession
    vectors = written(integer_vectors(data, scale, ident, vector), "knn-vectors")
    sample = vectors.select("id", "size", "packed").orderBy(F.xxhash64("id", "packed")).limit(SAMPLE).collect()
    schema = "query_id long, rank int, vec_id long, score long"
    if not sample:
        return spark.createDataFrame([], schema)
    known = {}
    for size in {row.size for row in sample}:
        known[size] = Cells(choose_pivots(matrix([r.packed for r in sample if r.size == size], size).astype(np.float64), pivots))

    def assign(batches):
        for frame in batches:
            cell = np.zeros(len(frame), np.int32)
            for size in frame["size"].unique():
                at = np.flatnonzero(frame["size"] == size)
                if size in known:
                    cell[at] = known[size].nearest(matrix(frame["packed"].iloc[at], size))
            yield frame.assign(cell=cell)

    copy = Window.partitionBy("size", "packed").orderBy("id")
    searched = vectors.withColumn("copy", F.row_number().over(copy)).filter(F.col("copy") <= k + 1).drop("copy")
    cells = written(searched.mapInPandas(assign, "id long, size int, packed binary, cell int"), "knn-cells")
    for row in _summaries(cells, known):
        if row.size not in known:
            known[row.size] = Cells(np.zeros((1, row.size)))
        own = known[row.size]
        own.count[row.cell] = row.rows
        own.far[row.cell] = row.far
        own.low[row.cell] = [x.low for x in row.box]
        own.high[row.cell] = [x.high for x in row.box]
    shared = spark.sparkContext.broadcast(known)

    def targets(first_round: bool):
        def run(batches):
            for frame in batches:
                for size, rows in frame.groupby("size"):
                    own = shared.value[size]
                    bound = own.bounds(matrix(rows["packed"], size))
                    order = np.argsort(-bound, axis=1, kind="stable")
                    held = np.cumsum(own.count[order], axis=1)
                    # Cells of the first round: the best by bound that hold k rows beside the query.
                    early = np.concatenate([np.ones((len(rows), 1), bool), held[:, :-1] < k + 1], axis=1)
                    early &= np.take_along_axis(bound, order, 1) > -np.inf
                    chosen = np.zeros_like(early)
                    np.put_along_axis(chosen, order, early, 1)
                    if not first_round:
                        least = rows["least"].to_numpy(np.float64)
                        chosen = ~chosen & (bound >= least[:, None]) & (bound > -np.inf)
                    floor = rows["least"].to_numpy()
                    for first in range(0, chosen.shape[1], BUNDLE):
                        part = chosen[:, first : first + BUNDLE]
                        q = np.flatnonzero(part.any(1))
                        if not len(q):
                            continue
                        yield pd.DataFrame(
                            {
                                "id": rows["id"].to_numpy()[q],
                                "size": size,
                                "packed": rows["packed"].to_numpy()[q],
                                "bundle": first // BUNDLE,
                                "cells": part[q] @ (1 << np.arange(part.shape[1])),
                                "least": floor[q],
                            }
                        )

        return run

    shape = "id long, size int, packed binary, bundle int, cells long, least long"
    queries = vectors.filter(is_query)

    def solved(sent: DataFrame) -> DataFrame:
        sent = written(sent, "knn-sent")
        parts = {(r.size, r.bundle): -(-r.n // block) for r in sent.groupBy("size", "bundle").agg(F.count("*").alias("n")).collect()}
        held = {(s, b): int(known[s].count[b * BUNDLE : (b + 1) * BUNDLE].sum()) for s, b in parts}
        plan = spark.createDataFrame(
            [(s, b, parts[s, b], max(1, -(-held[s, b] // block))) for s, b in parts],
            "size int, bundle int, query_parts int, data_blocks int",
        )
        left = sent.join(F.broadcast(plan), ["size", "bundle"]).select(
            "size", "bundle", "id", "packed", "cells", "least",
            F.pmod(F.xxhash64("id"), F.col("query_parts")).cast("int").alias("part"),
            F.explode(F.sequence(F.lit(0), F.col("data_blocks") - 1)).alias("block"),
        )
        right = cells.withColumn("bundle", F.expr(f"cell div {BUNDLE}").cast("int")).join(F.broadcast(plan), ["size", "bundle"]).select(
            "size", "bundle", "id", "packed", "cell",
            F.explode(F.sequence(F.lit(0), F.col("query_parts") - 1)).alias("part"),
            F.pmod(F.xxhash64("id", F.lit(1)), F.col("data_blocks")).cast("int").alias("block"),
        )

        def solve(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
            out = [pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")]
            if not len(a) or not len(b):
                return out[0]
            size, first = int(a["size"].iloc[0]), int(a["bundle"].iloc[0]) * BUNDLE
            b = b.sort_values("id")
            ids, right_rows = b["id"].to_numpy(), matrix(b["packed"], size)
            members = {cell: np.flatnonzero(b["cell"] == cell) for cell in b["cell"].unique()}
            for start in range(0, len(a), 256):
                some = a.iloc[start : start + 256]
                rows, qid = matrix(some["packed"], size), some["id"].to_numpy()
                wanted = some["cells"].to_numpy()[:, None] >> np.arange(BUNDLE) & 1
                score = np.full((len(some), len(ids)), LEAST)
                for cell, at in members.items():
                    q = np.flatnonzero(wanted[:, cell - first])
                    score[np.ix_(q, at)] = products(rows[q], right_rows[at])
                score[qid[:, None] == ids] = LEAST
                q, at = leading_products(score, some["least"].to_numpy(), k)
                out.append(pd.DataFrame({"query_id": qid[q], "vec_id": ids[at], "score": score[q, at]}))
            return pd.concat(out)

        keys = ["size", "bundle", "part", "block"]
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(solve, "query_id long, vec_id long, score long")

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def leading(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)

    early = written(leading(solved(queries.withColumn("least", F.lit(LEAST)).mapInPandas(targets(True), shape))), "knn-early")
    least = early.filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("least"))
    late = solved(queries.join(least, "id", "left").withColumn("least", F.coalesce("least", F.lit(LEAST))).mapInPandas(targets(False), shape))
    both = early.select("query_id", "vec_id", "score").unionByName(late)
    return leading(both).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
