"""Masked pseudo-likelihood of documents.

The words of all documents are counted. The most frequent ones have a class each; the
others are dealt by hash over the classes left, and a word's share of its class's
occurrences is the last factor of its probability. So every counted word has a probability
of its own, and those of all words add up to 1. There are ``clusters`` x ``clusters`` classes, and
they grow with the square root of the vocabulary. A network reads the classes of the
``REACH`` words on either side of a place, and not the word itself: their embeddings, one
table for all places, are joined, pass a hidden layer, and two softmax layers give the
upper and then, knowing that, the lower half of the number of the class in the middle. The sum
of the log-probabilities of all words is the document's pseudo-log-likelihood.

Every place of every document is a target in training, once: in turn t of ``ROUNDS`` the
places whose number is the shard's plus t modulo ``ROUNDS``. Documents are dealt by a hash of
their id into shards of a set number of words; each shard trains the common network further,
and the results are averaged by words after each turn. A shard is written as one row, so its words
are shuffled once, and neither a turn nor the scoring moves them again: for the shares only its distinct
words meet their counts, packed by ranges of the hash, and 4 bytes for each word that shares a class. Shards and their order follow from the
data alone, so runs agree. The vocabulary is a table; what is gathered is one network per
shard and the words that have a class of their own.

Words are told apart by 64-bit hashes. Null and empty texts have no words, sum 0 and a null
mean. Repeated rows are scored alike. Scoring an empty table gives no rows.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHash, as_signed, discard, mix, prepare, release, shards_for, texts_of, trimmed, trimmed_groups, trimmed_pairs, written

LEAST_CLUSTERS = 64
# Classes for each square root of the vocabulary, and the share of them that single words may have.
CLASSES_PER_ROOT = 8
OWN_CLASSES = 0.75
REACH = 2
WIDTH = 16
HIDDEN = 32
ROUNDS = 2
RATE = 0.02
BATCH = 1024
SCORE_ROWS = 16_384
WORDS_PER_SHARD = 2_000_000
COUNTED_AT_ONCE = 2_000_000
WORDS_PER_RANGE = 4_000_000
PACKED_AT_ONCE = 1_000_000
BLOCKS = 8
SEED = 11
# Bias of a class that no word has: its probability is 0, so training leaves it there.
NEVER = -1e4


class Vocabulary(NamedTuple):
    """Numbers of the classes: ``own`` has the hashes of words with one of their own, most frequent first.

    Behind these, ``occurrences`` has the number of words in each class that several words share.
    """

    clusters: int
    own: np.ndarray
    occurrences: np.ndarray
    total: int

    def classes(self, words: np.ndarray) -> np.ndarray:
        """Class numbers of hashes."""
        out = len(self.own) + np.mod(words, len(self.occurrences))
        if len(self.own):
            order = np.argsort(self.own)
            at = np.minimum(np.searchsorted(self.own, words, sorter=order), len(self.own) - 1)
            held = self.own[order[at]] == words
            out[held] = order[at[held]]
        return out


def word_counts(df: DataFrame, text: str) -> DataFrame:
    """(word, n): how often each word, by its hash, occurs in all rows."""

    def run(batches):
        memo, held, size = WordHash(), [], 0

        def summed():
            words, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(words), pa.array(n.astype(np.int64))], ["word", "n"])

        for batch in batches:
            for body in texts_of(batch.column(0)):
                held.append(as_signed(memo.array(body.split())))
                size += len(held[-1])
                if size >= COUNTED_AT_ONCE:
                    yield summed()
                    held, size = [], 0
        if size:
            yield summed()

    counted = df.select(F.col(text).alias("body")).mapInArrow(run, "word long, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame) -> Vocabulary:
    """The classes for the words of ``word_counts``; words as frequent as each other are treated alike."""
    sizes = sorted(((r.n, r.words) for r in counts.groupBy("n").agg(F.count("*").alias("words")).collect()), reverse=True)
    clusters = max(LEAST_CLUSTERS, math.ceil(math.sqrt(CLASSES_PER_ROOT * math.sqrt(sum(words for _, words in sizes)))))
    room, least = int(OWN_CLASSES * clusters**2), None
    for n, words in sizes:
        if words > room:
            break
        room, least = room - words, n
    rows = sorted((-r.n, r.word) for r in counts.filter(F.col("n") >= least).collect()) if least else []
    own = np.array([word for _, word in rows], np.int64)
    occurrences = np.zeros(clusters**2 - len(own), np.int64)
    others = counts.filter(F.col("n") < least) if least else counts
    for r in others.groupBy(F.pmod("word", F.lit(len(occurrences))).alias("at")).agg(F.sum("n").alias("n")).collect():
        occurrences[r["at"]] = r.n
    return Vocabulary(clusters, own, occurrences, sum(n * words for n, words in sizes))


def new_network(clusters: int, seed: int = SEED) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)

    def normal(*shape):
        return (rng.normal(0, 1, shape) / np.sqrt(shape[0])).astype(np.float32)

    return {
        "embed": (rng.normal(0, 0.3, (clusters**2 + 1, WIDTH))).astype(np.float32),
        "hidden": normal(2 * REACH * WIDTH, HIDDEN),
        "hidden_bias": np.zeros(HIDDEN, np.float32),
        "upper": normal(HIDDEN, clusters),
        "upper_bias": np.zeros(clusters, np.float32),
        "knowing": np.zeros((clusters, HIDDEN), np.float32),
        "lower": normal(HIDDEN, clusters),
        "lower_bias": np.zeros((clusters, clusters), np.float32),
    }


def without_empty(network: dict[str, np.ndarray], used: np.ndarray) -> None:
    """Take all probability from the classes that are not in ``used``, and from groups without any."""
    empty = np.ones(network["lower_bias"].shape, bool)
    empty.ravel()[used] = False
    network["lower_bias"][empty] = NEVER
    network["upper_bias"][empty.all(1)] = NEVER


def flat(network: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([v.ravel() for v in network.values()])


def shaped(values: np.ndarray, clusters: int) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, like in new_network(clusters).items():
        out[name] = values[at : at + like.size].reshape(like.shape).astype(np.float32)
        at += like.size
    return out


def _softmax(logits: np.ndarray) -> np.ndarray:
    logits -= logits.max(1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(1, keepdims=True)
    return logits


def contexts(ids: np.ndarray, owner: np.ndarray, pad: int) -> np.ndarray:
    """Class numbers around every place (places x 2 REACH); ``pad`` beyond the document."""
    columns = []
    for step in (*range(-REACH, 0), *range(1, REACH + 1)):
        moved = np.full(len(ids), pad, ids.dtype)
        if step < 0:
            moved[-step:] = np.where(owner[-step:] == owner[:step], ids[:step], pad)
        else:
            moved[:-step] = np.where(owner[step:] == owner[:-step], ids[step:], pad)
        columns.append(moved)
    return np.stack(columns, 1)


def _forward(network, around, upper):
    x = network["embed"].take(around, 0).reshape(len(around), -1)
    hidden = np.tanh(x @ network["hidden"] + network["hidden_bias"])
    first = _softmax(hidden @ network["upper"] + network["upper_bias"])
    told = np.tanh(hidden + network["knowing"].take(upper, 0))
    second = _softmax(told @ network["lower"] + network["lower_bias"].take(upper, 0))
    return x, hidden, first, told, second


def log_probabilities(network: dict[str, np.ndarray], ids: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Log-probability of every word's class given its neighbours."""
    clusters = len(network["upper_bias"])
    around = contexts(ids, owner, clusters**2)
    out = np.empty(len(ids))
    for start in range(0, len(ids), SCORE_ROWS):
        part = slice(start, start + SCORE_ROWS)
        upper, lower = ids[part] // clusters, ids[part] % clusters
        _, _, first, _, second = _forward(network, around[part], upper)
        at = np.arange(len(upper))
        out[part] = np.log(first[at, upper].astype(np.float64) + 1e-30) + np.log(second[at, lower].astype(np.float64) + 1e-30)
    return out


def trained(network: dict[str, np.ndarray], around: np.ndarray, target: np.ndarray) -> None:
    """One pass of AdaGrad over the places, changing ``network``."""
    clusters = len(network["upper_bias"])
    squares = {name: np.full_like(v, 1e-4) for name, v in network.items()}

    def update(name, slope, rows=None):
        if rows is None:
            squares[name] += slope**2
            network[name] -= RATE * slope / np.sqrt(squares[name])
        else:
            square = squares[name].take(rows, 0) + slope**2
            squares[name][rows] = square
            network[name][rows] = network[name].take(rows, 0) - RATE * slope / np.sqrt(square)

    def groups(keys, most):
        """An order of keys below ``most``, those that occur, and where each begins in it."""
        # Small numbers are sorted by their digits.
        order = np.argsort(keys.astype(np.uint16) if most <= 1 << 16 else keys, kind="stable")
        keys = keys[order]
        at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        return order, keys[at], at

    for start in range(0, len(target), BATCH):
        near, ids = around[start : start + BATCH], target[start : start + BATCH]
        upper, lower = ids // clusters, ids % clusters
        x, hidden, first, told, second = _forward(network, near, upper)
        at = np.arange(len(ids))
        first[at, upper] -= 1
        second[at, lower] -= 1
        first /= len(ids)
        second /= len(ids)
        back_told = second @ network["lower"].T * (1 - told**2)
        back = (first @ network["upper"].T + back_told) * (1 - hidden**2)
        back_x = (back @ network["hidden"].T).reshape(-1, WIDTH)
        slopes = {
            "upper": hidden.T @ first,
            "upper_bias": first.sum(0),
            "lower": told.T @ second,
            "hidden": x.T @ back,
            "hidden_bias": back.sum(0),
        }
        by_near, by_upper = groups(near.ravel(), clusters**2 + 1), groups(upper, clusters)
        rows = {"embed": (by_near, back_x), "knowing": (by_upper, back_told), "lower_bias": (by_upper, second)}
        for name, slope in slopes.items():
            update(name, slope)
        for name, ((order, which, at), slope) in rows.items():
            update(name, np.add.reduceat(slope.take(order, 0), at, axis=0), which)


def numbered(df: DataFrame, ident: str, text: str, words: Vocabulary) -> DataFrame:
    """One row for each shard of (doc, text): its documents in the order of their ids, and their words.

    ``docs``, ``sizes`` (words of each), ``ids`` (32-bit class numbers of all words), ``words`` (the distinct hashes, mixed and
    ascending, of those that share a class) and ``shared`` (which of these each word that shares one is).
    """
    known = df.sparkSession.sparkContext.broadcast(words)
    kind = df.schema[ident].dataType.simpleString()

    def run(batches):
        memo, own = WordHash(), known.value
        for batch in batches:
            lists = [as_signed(memo.array(t.split())) for t in texts_of(batch.column(1))]
            sizes = np.array([len(x) for x in lists], np.int64)
            every = np.concatenate([*lists, np.empty(0, np.int64)])
            ids = own.classes(every)
            behind = ids >= len(own.own)
            ends = np.cumsum(sizes)
            parts = [(slice(e - n, e)) for n, e in zip(sizes, ends, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes),
                    pa.array([ids[p].astype("<u4").tobytes() for p in parts], pa.binary()),
                    pa.array([every[p][behind[p]].astype("<i8").tobytes() for p in parts], pa.binary()),
                ],
                ["doc", "n", "ids", "shared"],
            )

    def packed(table: pa.Table) -> pa.Table:
        order = pd.DataFrame({"doc": table.column("doc").to_pandas(), "ids": table.column("ids").to_pandas()}).sort_values(["doc", "ids"], kind="stable").index
        table = table.take(pa.array(order.to_numpy()))
        hashes = np.frombuffer(b"".join(table.column("shared").to_pylist()), "<u8")
        distinct, which = np.unique(mix(hashes), return_inverse=True)
        columns = [
            table.column("shard")[:1],
            pa.array([table.column("doc").to_pylist()], pa.list_(table.schema.field("doc").type)),
            pa.array([table.column("n").to_pylist()], pa.list_(pa.int64())),
            *(pa.array([x], pa.binary()) for x in (b"".join(table.column("ids").to_pylist()), distinct.astype("<u8").tobytes(), which.astype("<u4").tobytes())),
        ]
        return pa.Table.from_arrays(columns, SHARD)

    plain = df.select(F.col(ident).alias("doc"), F.col(text).alias("body")).mapInArrow(trimmed(run), f"doc {kind}, n long, ids binary, shared binary")
    # A shard trains on its documents in the order of their ids; a repeated row counts each time.
    shards = max(1, -(-words.total // WORDS_PER_SHARD))
    shard = F.pmod(F.xxhash64("doc", F.lit(SEED), F.xxhash64("ids")), F.lit(shards)).cast("int")
    dealt = plain.select(shard.alias("shard"), "doc", "n", "ids", "shared").groupBy("shard")
    return dealt.applyInArrow(trimmed_groups(packed), f"shard int, docs array<{kind}>, sizes array<long>, ids binary, words binary, shared binary")


SHARD = ["shard", "docs", "sizes", "ids", "words", "shared"]


def _of(row: bytes | None, kind: str) -> np.ndarray:
    return np.frombuffer(row or b"", kind)


def targets(size: int, shard: int, turn: int) -> np.ndarray:
    """The places of a shard that are targets in a turn; all turns together have each place once."""
    return np.arange((shard + turn) % ROUNDS, size, ROUNDS)


def used_classes(rows: DataFrame) -> np.ndarray:
    """The classes that occur in rows of ``numbered``; at most as many as the network has."""

    def run(batches):
        for batch in batches:
            for ids in texts_of(batch.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(_of(ids, "<u4")).astype(np.int64))], ["used"])

    return np.array([r.used for r in rows.select("ids").mapInArrow(run, "used long").distinct().collect()], np.int64)


_PARTS = "shard int, block int, weight double, sums binary"


def _training(shared, clusters: int, turn: int):
    def train(batches):
        for batch in batches:
            for row, shard in enumerate(batch.column(0).to_pylist()):
                ids = _of(batch.column(2)[row].as_py(), "<u4").astype(np.int64)
                if not len(ids):
                    continue
                sizes = batch.column(1)[row].values.to_numpy()
                own = shaped(shared.value, clusters)
                picked = targets(len(ids), shard, turn)
                around = contexts(ids.astype(np.int32), np.repeat(np.arange(len(sizes)), sizes), clusters**2)[picked]
                order = np.random.default_rng([SEED, shard, turn]).permutation(len(picked))
                trained(own, around[order], ids[picked][order])
                weight = float(len(picked))
                parts = np.array_split(flat(own).astype(np.float64) * weight, BLOCKS)
                columns = [pa.array([shard] * BLOCKS, pa.int32()), pa.array(range(BLOCKS), pa.int32()), pa.array([weight] * BLOCKS)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([p.tobytes() for p in parts], pa.binary())], ["shard", "block", "weight", "sums"])

    return train


def _added(frame: pd.DataFrame) -> pd.DataFrame:
    """The sum of networks, in the order of their shards."""
    frame = frame.sort_values("shard")
    sums = sum(np.frombuffer(b) for b in frame["sums"])
    return pd.DataFrame(
        {"shard": [frame["shard"].iloc[0]], "block": [frame["block"].iloc[0]], "weight": [frame["weight"].sum()], "sums": [sums.tobytes()]}
    )


def fitted(rows: DataFrame, clusters: int) -> dict[str, np.ndarray]:
    """A network trained on all rows of ``numbered``."""
    spark = rows.sparkSession
    network = new_network(clusters)
    without_empty(network, used_classes(rows))
    dealt = rows.select("shard", "sizes", "ids")
    for turn in range(ROUNDS):
        shared = spark.sparkContext.broadcast(flat(network))
        parts = dealt.mapInArrow(trimmed(_training(shared, clusters, turn)), _PARTS)
        # Sums in two steps, so that no group holds a part of every shard.
        some = parts.withColumn("some", (F.col("shard") / 64).cast("int"))
        halves = some.groupBy("block", "some").applyInPandas(_added, _PARTS)
        whole = written(halves.groupBy("block").applyInPandas(_added, _PARTS), "lm-network")
        sums = sorted(whole.collect(), key=lambda r: r.block)
        # A turn without targets (a corpus of one word) leaves the network as it is.
        if sums and sums[0].weight:
            network = shaped(np.concatenate([np.frombuffer(r.sums) / r.weight for r in sums]), clusters)
        # What is written is held by no plan, so its shuffles can go.
        discard(whole)
        release(spark)
    return network


def _ranges(keys: np.ndarray, ranges: int):
    """(number, slice) for each range of hashes that ascending ``keys`` have some of."""
    number = ((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
    begin = np.flatnonzero(np.concatenate([[len(keys) > 0], number[1:] != number[:-1]])) if len(keys) else np.empty(0, np.int64)
    for first, last in zip(begin.tolist(), [*begin[1:].tolist(), len(keys)], strict=False):
        yield int(number[first]), slice(first, last)


def _batch(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], list(kinds))


_WANTED = {"at": pa.int32(), "shard": pa.int32(), "words": pa.binary()}
_COUNTED = {"at": pa.int32(), "words": pa.binary(), "often": pa.binary()}
_FOUND = {"shard": pa.int32(), "at": pa.int32(), "often": pa.binary()}


def _wanted(rows: DataFrame, ranges: int) -> DataFrame:
    """Distinct words of each shard that share a class, one row for each range of hashes."""

    def run(batches):
        for batch in batches:
            for shard, words in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                keys = _of(words, "<u8")
                yield from _batch([(at, shard, keys[part].tobytes()) for at, part in _ranges(keys, ranges)], _WANTED).to_batches()

    return rows.select("shard", "words").mapInArrow(trimmed(run), "at int, shard int, words binary")


def _counted(counts: DataFrame, ranges: int) -> DataFrame:
    """Rows of ``word_counts``, packed by ranges of hashes."""

    def run(batches):
        held, size = [], 0

        def packed():
            keys, often = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(keys)
            keys, often = keys[order], often[order]
            return _batch([(at, keys[part].tobytes(), often[part].tobytes()) for at, part in _ranges(keys, ranges)], _COUNTED).to_batches()

        for batch in batches:
            held.append((mix(batch.column(0).to_numpy().view(np.uint64)), batch.column(1).to_numpy()))
            size += batch.num_rows
            if size >= PACKED_AT_ONCE:
                yield from packed()
                held, size = [], 0
        if size:
            yield from packed()

    return counts.select("word", "n").mapInArrow(trimmed(run), "at int, words binary, often binary")


def _found(wanted: pa.Table, counted: pa.Table) -> pa.Table:
    """How often the wanted words of a range occur, in their order."""
    keys, often = (np.concatenate([np.empty(0, kind), *(_of(x, kind) for x in counted.column(name).to_pylist())]) for name, kind in (("words", "<u8"), ("often", "<i8")))
    order = np.argsort(keys)
    keys, often = keys[order], often[order]
    rows = zip(*(wanted.column(name).to_pylist() for name in ("shard", "at", "words")), strict=True)
    return _batch([(shard, at, often[np.searchsorted(keys, _of(words, "<u8"))].tobytes()) for shard, at, words in rows], _FOUND)


def scored(rows: DataFrame, counts: DataFrame, words: Vocabulary, network: dict[str, np.ndarray]) -> DataFrame:
    """(doc, n, total): the sum of log-probabilities of each document of ``numbered``."""
    spark = rows.sparkSession
    shared, known = spark.sparkContext.broadcast(flat(network)), spark.sparkContext.broadcast(words)
    kind = rows.schema["docs"].dataType.elementType.simpleString()

    def score(batches):
        vocabulary = known.value
        own = shaped(shared.value, vocabulary.clusters)
        first = len(vocabulary.own)
        for batch in batches:
            for row in range(batch.num_rows):
                sizes = batch.column(2)[row].values.to_numpy()
                every = _of(batch.column(3)[row].as_py(), "<u4")
                ends = np.cumsum(sizes)
                sums, number = np.zeros(len(sizes)), np.zeros(len(sizes), np.int64)
                start = 0
                while start < len(sizes):
                    begin = ends[start] - sizes[start]
                    end = max(start + 1, int(np.searchsorted(ends, begin + 200_000)))
                    ids = every[begin : ends[end - 1]].astype(np.int64)
                    if len(ids):
                        owner = np.repeat(np.arange(end - start), sizes[start:end])
                        behind = ids >= first
                        number[start:end] = np.bincount(owner[behind], minlength=end - start)
                        sums[start:end] = np.bincount(owner, log_probabilities(own, ids, owner), end - start)
                        group = np.log(vocabulary.occurrences[ids[behind] - first].astype(np.float64))
                        sums[start:end] -= np.bincount(owner[behind], group, end - start)
                    start = end
                columns = [x.slice(row, 1) for x in (batch.column(0), batch.column(1), batch.column(2), batch.column(4))]
                lists = [pa.array([x]) for x in (sums, number)]
                yield pa.RecordBatch.from_arrays([*columns, *lists], ["shard", "docs", "sizes", "shared", "sums", "number"])

    def with_shares(docs: pa.Table, found: pa.Table) -> pa.Table:
        at = np.argsort(found.column("at").to_numpy())
        lists = found.column("often").to_pylist()
        often = np.log(np.concatenate([np.empty(0, "<i8"), *(_of(lists[i], "<i8") for i in at)]).astype(np.float64))
        docs = docs.combine_chunks()
        which = _of(b"".join(docs.column("shared").to_pylist()), "<u4")
        doc, n, sums, number = (docs.column(name).combine_chunks().flatten() for name in ("docs", "sizes", "sums", "number"))
        owner = np.repeat(np.arange(len(number)), number.to_numpy())
        total = sums.to_numpy() + np.bincount(owner, often[which], len(number))
        return pa.Table.from_arrays([doc, n, pa.array(total)], ["doc", "n", "total"])

    ranges = shards_for(spark, counts.count(), WORDS_PER_RANGE)
    found = _wanted(rows, ranges).groupBy("at").cogroup(_counted(counts, ranges).groupBy("at")).applyInArrow(trimmed_pairs(_found), "shard int, at int, often binary")
    schema = f"shard int, docs array<{kind}>, sizes array<long>, shared binary, sums array<double>, number array<long>"
    docs = rows.select("shard", "docs", "sizes", "ids", "shared").mapInArrow(trimmed(score), schema)
    return docs.groupBy("shard").cogroup(found.groupBy("shard")).applyInArrow(trimmed_pairs(with_shares), f"doc {kind}, n long, total double")


def pseudo_likelihood(df: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, log_likelihood (sum) and mean_log_likelihood of every row."""
    prepare(df.sparkSession)
    counts = written(word_counts(df, text), "lm-counts")
    words = vocabulary(counts)
    # A file for each shard: readers deal them out evenly.
    rows = written(numbered(df, ident, text, words), "lm-words", maxRecordsPerFile=1)
    release(df.sparkSession)
    out = scored(rows, counts, words, fitted(rows, words.clusters))
    return out.select(
        F.col("doc").alias(ident),
        F.col("n").alias("n_tokens"),
        F.col("total").alias("log_likelihood"),
        F.when(F.col("n") > 0, F.col("total") / F.col("n")).alias("mean_log_likelihood"),
    )
