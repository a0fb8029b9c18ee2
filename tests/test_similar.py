import numpy as np
import pytest
from pyspark.sql import functions as F

from vellumark.operators import blocks, similar
from vellumark.operators.probing import Probing, likely_codes
from vellumark.operators.similar import WIDE_HASHING, Hashing, describe_pairs, pruning_report, similar_pairs
from vellumark.plans import transform


def vectors(n, copies=0.0, seed=1):
    random = np.random.RandomState(seed)
    shared = random.randn(6)
    return {
        f"{i * 7919 % 100003}": shared if random.rand() < copies else random.randn(6) for i in range(n)
    }


def frame(spark, items):
    return spark.createDataFrame(
        [(key, [float(x) for x in value]) for key, value in items.items()], "content_id string, v array<double>"
    )


def brute_force(items, max_distance, min_cosine, neighbours):
    units = {k: v / np.linalg.norm(v) for k, v in items.items() if np.linalg.norm(v) > 0}
    found = set()
    for left, a in units.items():
        near = []
        for right, b in units.items():
            distance = float(np.linalg.norm(a - b))
            cosine = np.floor((1 - distance**2 / 2) * 10000 + 0.5) / 10000
            if left < right and distance < max_distance and cosine >= min_cosine:
                near.append((-cosine, right))
        found |= {(left, right, round(-c, 4)) for c, right in sorted(near)[:neighbours]}
    return found


def pairs_of(df):
    rows = df.collect()
    found = {(r[0], r[1], round(r[2], 4)) for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("neighbours", [None, 3])
@pytest.mark.parametrize("copies, block_rows", [(0.0, 1000), (0.0, 16), (0.4, 16)])
def test_exact(spark, neighbours, copies, block_rows):
    items = vectors(180, copies)
    found = similar_pairs(frame(spark, items), "v", neighbours=neighbours, block_rows=block_rows)
    assert pairs_of(found) == brute_force(items, 0.75, 0.7, neighbours)


def test_zero_vectors_and_few_items(spark):
    items = {"a": np.zeros(6), "b": np.zeros(6), "c": np.ones(6)}
    assert pairs_of(similar_pairs(frame(spark, items), "v")) == set()
    items["d"] = 2 * np.ones(6)
    assert pairs_of(similar_pairs(frame(spark, items), "v")) == {("c", "d", 1.0)}


@pytest.mark.parametrize("hashing", [WIDE_HASHING, Hashing(bucket_length=0.8, tables=6, hashes_per_table=2)])
def test_hashed_pairs_are_true_and_mostly_found(spark, hashing):
    items = vectors(200, 0.3)
    every = brute_force(items, 0.75, 0.7, None)
    best = brute_force(items, 0.75, 0.7, 3)
    found = pairs_of(similar_pairs(frame(spark, items), "v", hashing=hashing, block_rows=32))
    assert found <= every
    assert len(found & best) >= 0.9 * len(best)


def test_recall_of_the_job_at_its_limit(spark):
    random = np.random.RandomState(5)
    items = {}
    for i in range(300):
        base = random.randn(64)
        base /= np.linalg.norm(base)
        side = random.randn(64)
        side -= side @ base * base
        side /= np.linalg.norm(side)
        angle = 2 * np.arcsin(0.7 / 2)
        items[f"a{i:03d}"], items[f"b{i:03d}"] = base, np.cos(angle) * base + np.sin(angle) * side
    found = pairs_of(similar_pairs(frame(spark, items), "v", hashing=WIDE_HASHING))
    planted = {(f"a{i:03d}", f"b{i:03d}") for i in range(300)}
    assert len(planted & {pair[:2] for pair in found}) >= 0.95 * 300


def test_described(spark):
    items = spark.createDataFrame(
        [("a", "A", "Movie", 0, [1.0, 0.1]), ("b", "B", "TV Show", 1, [1.0, 0.2])],
        "content_id string, title string, content_type string, topic_cluster int, v array<double>",
    )
    row = describe_pairs(similar_pairs(items, "v"), items).first().asDict()
    assert (row["left_title"], row["right_title"], row["right_topic_cluster"]) == ("A", "B", 1)


def clustered(groups, size, spread, seed=3):
    random = np.random.RandomState(seed)
    centres = random.randn(groups, 16)
    return {f"{i:05d}": centres[i % groups] + spread * random.randn(16) for i in range(groups * size)}


@pytest.mark.parametrize("neighbours", [None, 3])
def test_bounds_spare_far_blocks_and_change_nothing(spark, neighbours):
    items = clustered(12, 40, 0.08)
    found = similar_pairs(frame(spark, items), "v", neighbours=neighbours, block_rows=16)
    assert pairs_of(found) == brute_force(items, 0.75, 0.7, neighbours)
    report = pruning_report(frame(spark, items), "v", neighbours=neighbours, block_rows=16).first()
    assert report["met"] <= report["block_pairs"] and report["skipped"] > 0.7


def test_near_copies_that_tie_take_the_smallest_ids(spark):
    random = np.random.RandomState(4)
    base = random.randn(16)
    items = {f"{i:04d}": base + (1e-6 if i % 2 else 0.0) * random.randn(16) for i in range(300)}
    items |= {f"x{i}": random.randn(16) for i in range(20)}
    assert pairs_of(similar_pairs(frame(spark, items), "v", block_rows=16)) == brute_force(items, 0.75, 0.7, 3)
    report = pruning_report(frame(spark, items), "v", block_rows=16).first()
    assert report["met"] < 6 * report["blocks"]


def test_repeated_and_null_ids(spark):
    a, b, c = [1.0, 0.0, 0.1], [1.0, 0.1, 0.0], [0.9, 0.2, 0.0]
    rows = [("a", a), *[("b", b)] * 3, ("c", c), ("b", [0.0, 0.0, 1.0]), (None, a), (None, b), ("d", [0.0, 0.1, 1.0])]
    table = spark.createDataFrame(rows, "content_id string, v array<double>")
    for hashing in (None, Hashing(), WIDE_HASHING, Probing()):
        for block_rows in (1, 2, 100):
            found = {r[:2] for r in pairs_of(similar_pairs(table, "v", hashing=hashing, block_rows=block_rows))}
            if hashing is None:
                assert found == {("a", "b"), ("a", "c"), ("b", "c"), ("b", "d")}
            assert found <= {("a", "b"), ("a", "c"), ("b", "c"), ("b", "d")}
    assert similar_pairs(table.limit(0), "v").count() == 0
    assert similar_pairs(table.limit(0), "v", hashing=Probing()).count() == 0


def test_likely_codes_are_all_subsets_by_chance():
    margins = np.array([[0.05, -0.3, 0.01], [2.0, 2.0, 2.0]])
    row, code = likely_codes(margins, 0.7, 64, 0.999999)
    assert code[row == 0][0] == 0b101 and code[row == 0][1] == 0b001
    assert sorted(code[row == 0]) == list(range(8)) and list(code[row == 1]) == [0b111]
    row, code = likely_codes(margins, 0.7, 64, 0.0)
    assert list(code) == [0b101, 0b111]


def test_probing_finds_planted_pairs_and_only_true_ones(spark):
    random = np.random.RandomState(8)
    items = {}
    for i in range(250):
        base, side = random.randn(64), random.randn(64)
        base /= np.linalg.norm(base)
        side -= side @ base * base
        side /= np.linalg.norm(side)
        angle = 2 * np.arcsin(0.7 / 2)
        items[f"a{i:03d}"], items[f"b{i:03d}"] = base, np.cos(angle) * base + np.sin(angle) * side
    every = brute_force(items, 0.75, 0.7, None)
    found = pairs_of(similar_pairs(frame(spark, items), "v", hashing=Probing(), block_rows=32))
    assert found <= every
    planted = {(f"a{i:03d}", f"b{i:03d}") for i in range(250)}
    assert len(planted & {pair[:2] for pair in found}) >= 0.95 * 250


def test_probing_of_copies_splits_no_further(spark):
    items = {f"{i:04d}": np.ones(6) for i in range(400)} | {f"x{i}": v for i, v in enumerate(vectors(50).values())}
    found = pairs_of(similar_pairs(frame(spark, items), "v", hashing=Probing(tables=2), block_rows=16))
    copies = {(f"{i:04d}", f"{j:04d}", 1.0) for i in range(400) for j in range(i + 1, min(i + 4, 400))}
    assert copies <= found


def test_a_tile_yields_the_best_of_all_its_meetings(spark):
    random = np.random.RandomState(6)
    base = random.randn(8)
    rows = [(f"{i:03d}", [float(x) for x in unit / np.linalg.norm(unit)]) for i in range(160) for unit in [base + 0.1 * random.randn(8)]]
    units = spark.createDataFrame(rows, "id string, unit array<double>").withColumn("cell", F.lit(0).cast("long"))
    packed = blocks.packed_blocks(blocks.numbered_blocks(units, ["cell"], len(rows), 16), 8).cache()
    left, right = packed.select("cell", "block"), packed.select(F.col("cell").alias("to_cell"), F.col("block").alias("to_block"))
    limits = {"max_distance": 0.75, "min_cosine": 0.7, "neighbours": 3}
    found = blocks.compared(packed, packed, left.crossJoin(right), limits, 8)
    assert found.groupBy("left_id").count().agg(F.max("count")).first()[0] == 3
    expected = brute_force({name: np.array(unit) for name, unit in rows}, 0.75, 0.7, 3)
    assert pairs_of(found.select("left_id", "right_id", "cosine_similarity")) == expected


def test_the_title_job_looks_into_no_buckets(spark, monkeypatch):
    def none(*_):
        raise AssertionError("buckets in a dense cone hold nearly everything")

    monkeypatch.setattr("vellumark.operators.similar.probed_pairs", none)
    items = {name: 3 + vector for name, vector in vectors(40).items()}
    columns = {"title": F.col("content_id"), "content_type": F.lit("a"), "topic_cluster": F.lit(0)}
    titles = frame(spark, items).withColumnRenamed("v", "normalized_embedding").withColumns(columns)
    found = transform.similar_titles(titles).select("left_content_id", "right_content_id", "cosine_similarity")
    assert pairs_of(found) == brute_force(items, 0.75, 0.7, 3)


def test_vectors_of_far_blocks_travel_once_for_many_blocks(spark):
    """64 blocks of a bucket: a row goes to each run of 16 blocks, not to each block."""
    rows = [(i, f"{i:04}", "b", i // 4, 63) for i in range(256)]
    blocks = spark.createDataFrame(rows, "row long, id string, bucket string, block long, last_block long")
    left, right = similar._far_places(blocks.filter("block <= last_block - 2"), blocks, 4)
    assert left.count() + right.count() <= 256 * (64 // similar.FAR_BLOCKS + 2)
    met = left.alias("l").join(right.alias("r"), ["bucket", "tile", "against"]).filter("r.block >= l.block + 2")
    wanted = sum(64 - 2 - b for b in range(62)) * 16
    assert met.count() == wanted == met.select("l.row", "r.row").distinct().count()


def test_items_are_numbered_without_their_vectors(spark):
    rows = spark.createDataFrame([(f"{i:03}", [float(i)], ["a", "b"]) for i in range(30)], "id string, unit array<double>, buckets array<string>")
    blocks, units = similar._blocks(rows, 30, 8)
    assert units.count() == 30 and "unit" not in blocks.columns
    got = sorted((r["bucket"], r["id"], r["block"], r["last_block"]) for r in blocks.collect())
    assert got == [(b, f"{i:03}", i // 8, 3) for b in "ab" for i in range(30)]
