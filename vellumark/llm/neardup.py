"""Near-duplicate documents by BagMinHash.

A document is a multiset of word shingles. Weights are whole numbers, cut into the
levels [0, 1), [1, 2), [2, 4), [4, 8) ... Every (shingle, level) is a Poisson process
of random points, the same in all documents; a point has a time, a signature component
and a place in the level. A document sees the points of a level that lie below the
shingle's weight; a component's value is its earliest point. Two documents agree in a
component with a probability equal to their weighted Jaccard similarity. Points come
in order of time, and a process ends for a document once its next point is later
than all components found so far.

1. Signatures are cut into bands; equal texts count once from here on.
2. In each bucket of a band the other documents are held against its centre, the one that meets
   most documents in all its buckets, so an original comes before its copies; then those
   outside the centre's class against the one of them that meets most.
   Buckets of up to ``FEW`` documents that still hold several classes give their pairs of
   different classes. In larger ones only the shingles that tell a document from the
   centre are compared: a set S, the centre's shingles and those that over ``FEW`` documents
   add to them, splits the candidates in two. Documents that share a shingle outside S
   meet by it. Documents that do not can be similar only if enough of the shingles of
   both lie in S; they are found by their sizes and their numbers of shingles in S.
   So no bucket emits all its pairs, and none that could be similar is left out.
3. A pair is verified: the signatures must agree to a minimal degree (far below the
   threshold), then the multisets of shingles decide. Links join documents into classes.

Texts of fewer than five words are one shingle; texts without words are alike only if equal.
Null texts are a class of their own each. A class is named by its smallest doc_id. Rows
that repeat a doc_id count as one document, so classes of its texts are joined; rows without a
doc_id have no class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WordHash, as_signed, chunks, discard, gram_hashes, mix, prepare, release, texts_of, trimmed, written

WORDS = 5
SIMILARITY = 0.8
BANDS = 28
ROWS = 4
COMPONENTS = BANDS * ROWS
# Agreement of signatures below which a pair is not verified: more than five deviations below 0.8.
LEAST_AGREEMENT = 0.6
# Documents that may be compared with each other in a bucket, or share a shingle outside S.
FEW = 32
CHUNK_WORDS = 200_000


def shingles(words: np.ndarray, owner: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of all shingles; a row with fewer words than WORDS has one."""
    grams = mix(gram_hashes(words, WORDS))
    inside = owner[: len(grams)] == owner[WORDS - 1 :]
    counts = np.bincount(owner, minlength=n_rows)
    short = np.flatnonzero((counts > 0) & (counts < WORDS))
    starts = np.cumsum(counts) - counts
    alone = []
    for row in short.tolist():
        part = words[starts[row] : starts[row] + counts[row]]
        alone.append(xxhash.xxh3_64_intdigest(part.tobytes()))
    return (
        np.concatenate([owner[: len(grams)][inside], short]),
        np.concatenate([grams[inside], np.array(alone, np.uint64)]),
    )


def counted(rows: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, hash) with their numbers."""
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    return rows[at], hashes[at], np.diff(np.append(at, len(rows)))


def _uniform(bits: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from 64 random bits."""
    return ((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def signatures(rows: np.ndarray, hashes: np.ndarray, weights: np.ndarray, n_rows: int) -> np.ndarray:
    """Signature (n_rows x COMPONENTS) of the earliest point times; infinite for rows without shingles."""
    levels = np.zeros(len(weights), np.int64)
    parts = []
    # Level 0 is [0, 1), level j >= 1 is [2^(j-1), 2^j).
    for level in range(int(weights.max(initial=1)).bit_length() + 1):
        low = 0 if level == 0 else 1 << (level - 1)
        reach = np.flatnonzero(weights > low)
        if not len(reach):
            break
        high = 1 << level if level else 1
        parts.append((reach, np.full(len(reach), level), np.full(len(reach), low), np.full(len(reach), high)))
    if not parts:
        return np.full((n_rows, COMPONENTS), np.inf)
    element, levels, low, high = (np.concatenate(x) for x in zip(*parts, strict=True))
    row, weight = rows[element], weights[element]
    key = mix(hashes[element] + np.uint64(0x9E3779B97F4A7C15) * (levels.astype(np.uint64) + np.uint64(1)))
    rate = (high - low) * float(COMPONENTS)
    time = np.zeros(len(row))
    best = np.full(n_rows * COMPONENTS, np.inf)
    turn = np.uint64(0)
    while len(row):
        bits = mix(key + turn)
        time = time - np.log(_uniform(bits)) / rate
        limit = best.reshape(n_rows, COMPONENTS).max(1)
        alive = time < limit[row]
        row, weight, key, rate, time, low, high, bits = (x[alive] for x in (row, weight, key, rate, time, low, high, bits))
        if not len(row):
            break
        more = mix(bits + np.uint64(0xA0761D6478BD642F))
        component = ((more >> np.uint64(32)) % np.uint64(COMPONENTS)).astype(np.int64)
        place = low + _uniform(mix(more)) * (high - low)
        seen = place < weight
        np.minimum.at(best, row[seen] * COMPONENTS + component[seen], time[seen])
        turn += np.uint64(1)
    return best.reshape(n_rows, COMPONENTS)


def text_signatures(texts: list[bytes], memo: WordHash) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first row, last row, signatures) for runs of texts."""
    for first, last in chunks(np.array([len(t) // 5 for t in texts]), CHUNK_WORDS):
        lists = [t.split() for t in texts[first:last]]
        n = last - first
        owner = np.repeat(np.arange(n), [len(x) for x in lists])
        rows, hashes, weights = counted(*shingles(memo.array([w for x in lists for w in x]), owner, n))
        yield first, last, signatures(rows, hashes, weights, n)


def multiset_similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two sorted multisets (hashes, counts)."""
    _, at, bt = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][at], b[1][bt]).sum())
    every = int(a[1].sum() + b[1].sum()) - both
    return both / every if every else 0.0


def text_multiset(text: bytes, memo: WordHash) -> tuple[np.ndarray, np.ndarray]:
    words = memo.array(text.split())
    _, hashes, counts = counted(*shingles(words, np.zeros(len(words), np.int64), 1))
    return hashes, counts


def elements(text: bytes, memo: WordHash) -> np.ndarray:
    """The multiset as a set: a hash of each shingle and its running number."""
    hashes, counts = text_multiset(text, memo)
    number = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return mix(np.repeat(hashes, counts) + number.astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB))


def with_signatures(df: DataFrame) -> DataFrame:
    """(doc, digest, bands, brief) from (doc, digest, body): band hashes, and a byte per component."""

    def run(batches):
        memo = WordHash()
        for batch in batches:
            texts = texts_of(batch.column(2))
            bands, briefs = [], []
            for _, _, found in text_signatures(texts, memo):
                bits = mix(found.view(np.uint64))
                for i in range(len(found)):
                    if np.isinf(found[i, 0]):
                        bands.append([])
                        briefs.append(b"")
                    else:
                        band = bits[i].reshape(BANDS, ROWS)
                        mixed = mix(band[:, 0] + mix(band[:, 1] + mix(band[:, 2] + mix(band[:, 3]))))
                        bands.append(as_signed(mixed).tolist())
                        briefs.append((bits[i] >> np.uint64(56)).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(bands, pa.list_(pa.int64())), pa.array(briefs, pa.binary())],
                ["doc", "digest", "bands", "brief"],
            )

    return df.select("doc", "digest", "body").mapInArrow(trimmed(run), "doc long, digest string, bands array<long>, brief binary")


def verified(pairs: DataFrame, items: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose multisets are similar enough; ``items`` has doc and brief."""

    def side(name: str) -> DataFrame:
        return items.select(F.col("doc").alias(name), F.col("brief").alias(f"brief_{name}"))

    briefs = pairs.join(side("a"), "a").join(side("b"), "b")

    def screen(batches):
        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            one = np.frombuffer(b"".join(left.to_pylist()), np.uint8).reshape(-1, COMPONENTS)
            two = np.frombuffer(b"".join(right.to_pylist()), np.uint8).reshape(-1, COMPONENTS)
            keep = pa.array((one == two).mean(1) >= LEAST_AGREEMENT)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    near = written(briefs.select("a", "b", "brief_a", "brief_b").mapInArrow(trimmed(screen), "a long, b long"), "near-pairs")
    involved = near.select(F.explode(F.array("a", "b")).alias("doc")).distinct()
    bodies = written(texts.join(involved, "doc").select("doc", "body"), "near-texts")
    release(near.sparkSession)
    held = near.join(bodies.select(F.col("doc").alias("a"), F.col("body").alias("body_a")), "a").join(
        bodies.select(F.col("doc").alias("b"), F.col("body").alias("body_b")), "b"
    )

    def decide(batches):
        memo = WordHash()
        last, known = None, None
        for batch in batches:
            a, left, right = batch.column(0).to_pylist(), texts_of(batch.column(2)), texts_of(batch.column(3))
            keep = []
            for i, name in enumerate(a):
                if name != last:
                    last, known = name, text_multiset(left[i], memo)
                keep.append(multiset_similarity(known, text_multiset(right[i], memo)) >= SIMILARITY)
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    return held.select("a", "b", "body_a", "body_b").mapInArrow(trimmed(decide), "a long, b long")


def classes(links: DataFrame) -> DataFrame:
    """(doc, class) of every document with a link: the smallest document that it can reach.

    Links are turned towards small documents, in rounds that alternate between all
    and smaller neighbours, until every document points at the smallest of its class.
    """
    edges = written(links.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct(), "links")
    def state(e: DataFrame) -> tuple:
        return tuple(
            e.agg(F.count("*"), F.sum(F.xxhash64("low", "high").cast("decimal(38,0)")), F.sum(F.col("high").cast("decimal(38,0)"))).first()
        )

    before = state(edges)
    while True:
        # All neighbours above a document get its smallest neighbour (or itself).
        both = edges.union(edges.select("low", "high")).toDF("node", "other")
        least = both.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("least"))
        large = both.join(least, "node").filter("other > node").select(F.col("other").alias("high"), F.col("least").alias("low")).distinct()
        # A document and its smaller neighbours get the smallest of them.
        low = large.groupBy("high").agg(F.min("low").alias("least"))
        small = large.join(low, "high").select(F.when(F.col("low") == F.col("least"), F.col("high")).otherwise(F.col("low")).alias("high"), F.col("least").alias("low"))
        turned = written(small.distinct(), "links")
        edges, after = turned, state(turned)
        if before == after:
            break
        before = after
    lows = edges.select(F.col("low").alias("doc")).distinct()
    return edges.select(F.col("high").alias("doc"), F.col("low").alias("class")).unionByName(lows.withColumn("class", F.col("doc")))


def deviations(compared: DataFrame, texts: DataFrame) -> DataFrame:
    """(centre, doc, class, size, inside, outside): elements of a document that its centre has, and the others.

    ``compared`` has centre, doc and class, ``texts`` has doc and body.
    """
    bodies = [texts.select(F.col("doc").alias(name), F.col("body").alias(f"body_{name}")) for name in ("centre", "doc")]
    held = compared.join(bodies[0], "centre").join(bodies[1], "doc")

    def compare(batches):
        memo = WordHash()
        last, known = None, None
        for batch in batches:
            rows = []
            centres, docs = texts_of(batch.column(3)), texts_of(batch.column(4))
            for centre, text in zip(centres, docs, strict=True):
                if centre != last:
                    last, known = centre, elements(centre, memo)
                own = elements(text, memo)
                rows.append((len(own), as_signed(own[~np.isin(own, known)])))
            size = np.array([r[0] for r in rows], np.int64)
            outside = np.array([len(r[1]) for r in rows], np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3],
                    pa.array(size),
                    pa.array(size - outside),
                    pa.array([r[1] for r in rows], pa.list_(pa.int64())),
                ],
                ["centre", "doc", "class", "size", "inside", "outside"],
            )

    schema = "centre long, doc long, class long, size long, inside long, outside array<long>"
    return held.select("centre", "doc", "class", "body_centre", "body_doc").mapInArrow(trimmed(compare), schema)


def _sides(df: DataFrame, *keys: str) -> tuple[DataFrame, DataFrame]:
    """``df`` twice, with its columns but the keys renamed to ``*_x`` and ``*_y``."""
    return tuple(df.select(*keys, *(F.col(c).alias(f"{c}_{side}") for c in df.columns if c not in keys)) for side in "xy")


def candidates_by_deviation(rows: DataFrame) -> DataFrame:
    """Pairs (x, y) of different classes around a centre that could be similar, from ``deviations``."""
    unlike = F.col("class_x") != F.col("class_y")
    apart = rows.select("centre", "doc", "class", "size", F.explode("outside").alias("element"))
    number = apart.groupBy("centre", "element").agg(F.count("*").alias("n")).filter("n > 1")
    known = written(apart.join(number, ["centre", "element"]), "near-apart")
    # Shared by few: these documents meet. Similar documents differ in size by the similarity at most.
    left, right = _sides(known.filter(F.col("n") <= FEW).drop("n"), "centre", "element")
    near_size = F.least("size_x", "size_y") >= SIMILARITY * F.greatest("size_x", "size_y") - 1e-6
    meeting = left.join(right, ["centre", "element"]).filter((F.col("doc_x") < F.col("doc_y")) & unlike & near_size)
    # Shared by more: part of S. What two documents have in common then lies in S, and is at least 4/9 of both sizes together.
    common = known.filter(F.col("n") > FEW).groupBy("centre", "doc").agg(F.count("*").alias("more"))
    counts = rows.drop("outside").join(common, ["centre", "doc"], "left").withColumn("inside", F.col("inside") + F.coalesce("more", F.lit(0))).drop("more")
    counts = written(counts, "near-counts")
    profiles = counts.groupBy("centre", "size", "inside").agg(F.min("class").alias("low"), F.max("class").alias("high"))
    one, two = _sides(profiles.filter(F.col("inside") >= SIMILARITY * F.col("size") - 1e-6), "centre")
    enough = F.least("inside_x", "inside_y") * (1 + SIMILARITY) >= SIMILARITY * (F.col("size_x") + F.col("size_y")) - 1e-6
    several = (F.least("low_x", "low_y") < F.greatest("high_x", "high_y")) & (F.struct("size_x", "inside_x") <= F.struct("size_y", "inside_y"))
    fitting = one.join(two, "centre").filter(enough & several).select("centre", "size_x", "inside_x", "size_y", "inside_y")
    x, y = _sides(counts, "centre")
    alike = fitting.join(x, ["centre", "size_x", "inside_x"]).join(y, ["centre", "size_y", "inside_y"]).filter(unlike)
    return meeting.select(F.col("doc_x").alias("x"), F.col("doc_y").alias("y")).unionByName(alike.select(F.col("doc_x").alias("x"), F.col("doc_y").alias("y")))


def text_digest(ident: Column, body: Column) -> Column:
    """Equal for equal texts. A null text is like no other text."""
    return F.when(body.isNull(), F.concat(F.lit("null "), ident.cast("string"))).otherwise(F.sha2(body, 256))


def similar_texts(df: DataFrame, ident: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(doc, digest) for every row of ``df``, and (digest, first, item, class) for every text.

    ``first`` is the smallest document with the text. It stands for the text as
    its item; a document that is the smallest of several texts does so for one of
    them, and the others have a hash.
    """
    spark = prepare(df.sparkSession)
    body = F.col(text)
    digest = text_digest(F.col(ident), body)
    plain = df.select(F.col(ident).cast("long").alias("doc"), digest.alias("digest"), F.coalesce(body, F.lit("")).alias("body"))
    every = written(with_signatures(plain.filter("doc is not null")), "near-signatures")
    firsts = every.groupBy("digest").agg(F.min("doc").alias("first"), F.first("bands").alias("bands"), F.first("brief").alias("brief"))
    turn = F.row_number().over(Window.partitionBy("first").orderBy("digest"))
    items = written(firsts.withColumn("doc", F.when(turn == 1, F.col("first")).otherwise(F.xxhash64("digest"))), "near-items")
    named = items.select(F.col("first"), F.col("digest").alias("of"), F.col("doc").alias("item"))
    texts = (
        plain.join(named, (F.col("doc") == F.col("first")) & (F.col("digest") == F.col("of")))
        .select(F.col("item").alias("doc"), "body")
        .dropDuplicates(["doc"])
    )
    buckets = items.select("doc", F.posexplode("bands").alias("band", "hash"))
    size = buckets.groupBy("band", "hash").agg(F.count("*").alias("n")).filter("n > 1")
    crowded = written(buckets.join(size, ["band", "hash"]), "near-crowded")
    meets = crowded.groupBy("doc").agg(F.sum("n").alias("meets"))
    ranked = crowded.join(meets, "doc").withColumn("order", F.struct(-F.col("meets"), "doc"))
    centre = ranked.groupBy("band", "hash").agg(F.min("order").alias("order")).select("band", "hash", F.col("order.doc").alias("centre"))
    members = written(ranked.join(centre, ["band", "hash"]).select("band", "hash", "n", "doc", "order", "centre"), "near-buckets")
    discard(crowded)

    def pairs(found: DataFrame) -> DataFrame:
        return found.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).filter("a < b").distinct()

    def still_open(known: DataFrame) -> DataFrame:
        """Members of buckets of three or more that hold several classes; pairs of two are settled."""
        placed = members.filter("n > 2").join(known, "doc", "left").withColumn("class", F.coalesce("class", "doc"))
        split = placed.groupBy("band", "hash").agg(
            F.min("class").alias("least"), F.max("class").alias("most"), F.max(F.when(F.col("doc") == F.col("centre"), F.col("class"))).alias("main")
        )
        return written(placed.join(split.filter("least < most"), ["band", "hash"]).drop("least", "most"), "near-open")

    tried = written(pairs(members.select(F.col("centre").alias("x"), F.col("doc").alias("y"))), "near-tried")
    links = written(verified(tried, items, texts), "near-links")
    known = written(classes(links), "near-classes")

    rest = still_open(known).filter(F.col("class") != F.col("main"))
    leader = rest.groupBy("band", "hash").agg(F.min("order").alias("leader")).select("band", "hash", F.col("leader.doc").alias("x"))
    more = pairs(rest.join(leader, ["band", "hash"]).select("x", F.col("doc").alias("y")))
    more = written(more.join(tried, ["a", "b"], "left_anti"), "near-tried")
    found = written(verified(more, items, texts), "near-links")
    if not found.isEmpty():
        links = links.unionByName(found)
        known = written(classes(links), "near-classes")

    left = still_open(known)
    x, y = _sides(left.filter(F.col("n") <= FEW).select("band", "hash", "doc", "class"), "band", "hash")
    few = x.join(y, ["band", "hash"]).filter("doc_x < doc_y and class_x <> class_y").select(F.col("doc_x").alias("x"), F.col("doc_y").alias("y"))
    compared = written(left.filter(F.col("n") > FEW).select("centre", "doc", "class").distinct(), "near-compared")
    if not compared.isEmpty():
        # The centre is among the documents of its bucket.
        bodies = written(texts.join(compared.select("doc").distinct(), "doc", "left_semi"), "near-bodies")
        few = few.unionByName(candidates_by_deviation(written(deviations(compared, bodies), "near-deviations")))
    last = written(pairs(few).join(tried.unionByName(more), ["a", "b"], "left_anti"), "near-fresh")
    found = written(verified(last, items, texts), "near-links")
    if not found.isEmpty():
        known = written(classes(links.unionByName(found)), "near-classes")
    placed = items.select("digest", "first", F.col("doc").alias("item")).join(known, F.col("item") == F.col("doc"), "left").select(
        "digest", "first", "item", F.coalesce("class", "item").alias("class")
    )
    return every.select("doc", "digest"), written(placed, "near-placed")


def similar_classes(df: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, class) for every row of ``df``."""
    every, placed = similar_texts(df, ident, text)
    # Documents with several texts join the classes of these.
    lead = every.groupBy("doc").agg(F.min("digest").alias("lead"), F.max("digest").alias("last")).filter("lead < last").select("doc", "lead")
    same = every.join(lead, "doc").filter("digest <> lead").select("digest", "lead").distinct()
    held = placed.select("digest", F.col("class").alias("a"))
    other = placed.select(F.col("digest").alias("lead"), F.col("class").alias("b"))
    same = written(same.join(held, "digest").join(other, "lead").select("a", "b").filter("a <> b").distinct(), "near-same")
    if not same.isEmpty():
        joined = classes(same).select(F.col("doc").alias("class"), F.col("class").alias("joined"))
        placed = placed.join(joined, "class", "left").withColumn("class", F.coalesce("joined", "class")).drop("joined")
    names = placed.groupBy("class").agg(F.min("first").alias("name"))
    # Only a class with an item that is no document may have another name than its number.
    renamed = names.filter("name <> class")
    placed = placed.join(renamed, "class", "left").select("digest", F.coalesce("name", "class").alias("class"))
    return every.join(placed, "digest").select("doc", "class")


def near_duplicates(df: DataFrame) -> DataFrame:
    """doc_id and class_id of every row; class_id is null where doc_id is."""
    out = similar_classes(df).select(F.col("doc").alias("doc_id"), F.col("class").alias("class_id"))
    missing = df.filter("doc_id is null").select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(None).cast("long").alias("class_id"))
    return out.unionByName(missing)


def first_of_each_class(df: DataFrame) -> DataFrame:
    """One row of each class of similar texts, of its smallest doc_id; rows without a doc_id stay.

    A document with several texts that are not similar has a row for each that it is first to have.
    """
    _, placed = similar_texts(df)
    keep = placed.groupBy("class").agg(F.min(F.struct("first", "digest")).alias("kept")).select("kept.*").toDF("kept_id", "kept_digest")
    whole = df.select(F.struct(*df.columns).alias("row"))
    named = whole.filter("row.doc_id is not null").withColumn("ident", F.col("row.doc_id").cast("long"))
    named = named.withColumn("digest", text_digest(F.col("row.doc_id"), F.col("row.text")))
    same = (F.col("ident") == F.col("kept_id")) & (F.col("digest") == F.col("kept_digest"))
    chosen = named.join(keep, same, "left_semi").dropDuplicates(["ident", "digest"])
    return chosen.select("row.*").unionByName(whole.filter("row.doc_id is null").select("row.*"))
