"""Quality classifier on random-indexing word vectors.

Words fall into ``BUCKETS`` by a hash. Each bucket has a sparse ternary index
vector; its context vector is the sum of the index vectors of the words up to
``REACH`` places away, over all documents. A document is the pool of the context
vectors of its words. A two-layer network learns the labels from a sample of at
most ``MAX_TRAINING_ROWS`` labelled documents, and a temperature, fitted on rows
the network did not see, turns its output into probabilities.

The table of context vectors has a fixed size (2 MB), whatever the corpus.
Null and empty texts pool to zeros and get the score of such a document. Without
labels of both kinds every score is 0.5. Repeated labels of a document count once, by
the largest; repeated rows are scored alike.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHash, chunks, mix, prepare, texts_of, trimmed

BUCKETS = 1 << 14
WIDTH = 32
NONZERO = 2
REACH = 2
BLOCKS = 16
MAX_TRAINING_ROWS = 20_000
HIDDEN = 32
EPOCHS = 30
THRESHOLD = 0.3
CHUNK_WORDS = 100_000


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """(places, signs) of the nonzero entries of each bucket's index vector."""
    noise = mix(np.arange(BUCKETS * NONZERO, dtype=np.uint64)).reshape(BUCKETS, NONZERO)
    return (noise % np.uint64(WIDTH)).astype(np.int64), np.where(noise >> np.uint64(63), 1.0, -1.0)


def _bucketed(texts: list[bytes], memo: WordHash):
    """Runs of (buckets, document numbers, row range) of bounded size."""
    sizes = np.array([len(t) // 4 for t in texts], np.int64)
    for first, last in chunks(sizes, CHUNK_WORDS):
        lists = [t.split() for t in texts[first:last]]
        counts = np.array([len(x) for x in lists], np.int64)
        words = memo.array([w for x in lists for w in x]).astype(np.int64)
        yield words, np.repeat(np.arange(last - first), counts), counts, first, last


def context_vectors(df: DataFrame, text: str = "text") -> np.ndarray:
    """Context vectors (BUCKETS x WIDTH), summed over all documents."""
    prepare(df.sparkSession)

    def gather(batches):
        memo = WordHash(BUCKETS)
        places, signs = index_vectors()
        total = np.zeros(BUCKETS * WIDTH)
        for batch in batches:
            for words, owner, _, _, _ in _bucketed(texts_of(batch.column(0)), memo):
                for step in range(1, REACH + 1):
                    same = owner[:-step] == owner[step:]
                    a, b = words[:-step][same], words[step:][same]
                    for near, far in ((a, b), (b, a)):
                        for j in range(NONZERO):
                            total += np.bincount(near * WIDTH + places[far, j], signs[far, j], BUCKETS * WIDTH)
        parts = total.astype(np.int64).reshape(BLOCKS, -1)
        blobs = [p.astype("<i8").tobytes() for p in parts]
        salt = int(np.abs(total).sum()) % 32
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(BLOCKS), pa.int32()), pa.array([salt] * BLOCKS, pa.int32()), pa.array(blobs, pa.binary())],
            ["block", "salt", "sums"],
        )

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(blob, "<i8") for blob in frame["sums"])
        return pd.DataFrame({"block": [frame["block"].iloc[0]], "salt": [0], "sums": [total.tobytes()]})

    partial = df.select(F.coalesce(F.col(text), F.lit("")).alias("body")).mapInArrow(trimmed(gather), "block int, salt int, sums binary")
    schema = partial.schema
    # In two rounds, so that no group holds a part of every partition.
    rows = partial.groupBy("block", "salt").applyInPandas(add, schema).groupBy("block").applyInPandas(add, schema).collect()
    out = np.zeros((BLOCKS, BUCKETS * WIDTH // BLOCKS), np.int64)
    for row in rows:
        out[row.block] = np.frombuffer(row.sums, "<i8")
    return out.reshape(BUCKETS, WIDTH).astype(np.float64)


def unit_vectors(context: np.ndarray) -> np.ndarray:
    """Context vectors with damped sizes, without what all share, at length 1."""
    damped = np.sign(context) * np.log1p(np.abs(context))
    damped -= damped.mean(0)
    norm = np.linalg.norm(damped, axis=1, keepdims=True)
    return (damped / np.where(norm > 0, norm, 1)).astype(np.float32)


FEATURES = 3 * WIDTH + 1


def pooled(texts: list[bytes], vectors: np.ndarray, memo: WordHash) -> np.ndarray:
    """Per text: mean vector, mean square, mean product of neighbours, log of the word count."""
    out = np.zeros((len(texts), FEATURES), np.float32)
    for words, owner, counts, first, last in _bucketed(texts, memo):
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
        full = counts > 0
        if full.any():
            at = starts[full]
            rows = vectors[words]
            size = counts[full, None]
            squares, products = rows * rows, np.zeros_like(rows)
            products[:-1] = rows[:-1] * rows[1:] * (owner[:-1] == owner[1:])[:, None]
            part = out[first:last]
            part[full, :WIDTH] = np.add.reduceat(rows, at, axis=0) / size
            part[full, WIDTH : 2 * WIDTH] = np.add.reduceat(squares, at, axis=0) / size
            part[full, 2 * WIDTH : 3 * WIDTH] = np.add.reduceat(products, at, axis=0) / size
        out[first:last, -1] = np.log1p(counts)
    return out


class Network:
    """Two dense layers on standardised features, with a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, held: np.ndarray, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = x[~held].mean(0), x[~held].std(0) + 1e-6
        z = ((x - self.mean) / self.scale).astype(np.float64)
        self.weights = [
            rng.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], HIDDEN)),
            np.zeros(HIDDEN),
            rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 1)),
            np.zeros(1),
        ]
        self.temperature = 1.0
        self._train(z[~held], y[~held].astype(np.float64), rng)
        if held.any():
            logits, truth = self._logits(z[held])[0], y[held]
            steps = np.exp(np.linspace(-1.5, 2.5, 81))
            self.temperature = min(steps, key=lambda t: float(np.mean(np.logaddexp(0, np.where(truth > 0, -logits, logits) / t))))

    def _logits(self, z):
        hidden = np.tanh(z @ self.weights[0] + self.weights[1])
        return (hidden @ self.weights[2] + self.weights[3])[:, 0], hidden

    def _train(self, z, y, rng, rate=3e-3, decay=1e-4, size=128):
        first = [np.zeros_like(w) for w in self.weights]
        second = [np.zeros_like(w) for w in self.weights]
        step = 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(z))
            for start in range(0, len(z), size):
                part = order[start : start + size]
                x, step = z[part], step + 1
                logits, hidden = self._logits(x)
                error = ((1 / (1 + np.exp(-logits)) - y[part]) / len(part))[:, None]
                back = error @ self.weights[2].T * (1 - hidden**2)
                slopes = [x.T @ back + decay * self.weights[0], back.sum(0), hidden.T @ error + decay * self.weights[2], error.sum(0)]
                for i, slope in enumerate(slopes):
                    first[i] = 0.9 * first[i] + 0.1 * slope
                    second[i] = 0.999 * second[i] + 0.001 * slope**2
                    self.weights[i] -= rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.zeros(0)
        logits = self._logits(((x - self.mean) / self.scale).astype(np.float64))[0]
        return 1 / (1 + np.exp(np.clip(-logits / self.temperature, -60, 60)))


def labelled_sample(labels: DataFrame, limit: int = MAX_TRAINING_ROWS) -> list:
    """Training labels: documents whose crc32 modulo 5 is not 0; beyond ``limit`` those of least hash."""
    usable = labels.filter("doc_id is not null and quality in (0, 1)").filter(~held_out("doc_id"))
    return (
        usable.groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(limit)
        .collect()
    )


def held_out(column) -> F.Column:
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0, F.lit(False))


class Model:
    """What scoring needs; a few MB."""

    def __init__(self, vectors: np.ndarray, network: Network | None):
        self.vectors, self.network = vectors, network

    def scores(self, texts: list[bytes], memo: WordHash) -> np.ndarray:
        if self.network is None:
            return np.full(len(texts), 0.5)
        return self.network.probabilities(pooled(texts, self.vectors, memo))


def fitted(df: DataFrame, labels: DataFrame, limit: int = MAX_TRAINING_ROWS) -> Model:
    """The model of a corpus ``df`` (doc_id, text) with labels (doc_id, quality)."""
    spark = prepare(df.sparkSession)
    vectors = unit_vectors(context_vectors(df))
    truth = {row.doc_id: row.quality for row in labelled_sample(labels, limit)}
    if len(set(truth.values())) < 2:
        return Model(vectors, None)
    sample = spark.createDataFrame([(i,) for i in truth], "sample_id long")
    chosen = df.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("sample_id"))

    def measure(batches):
        memo = WordHash(BUCKETS)
        for batch in batches:
            rows = pooled(texts_of(batch.column(1)), vectors, memo).astype("<f4")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in rows], pa.binary())], ["doc_id", "x"])

    found = chosen.select("doc_id", "text").mapInArrow(trimmed(measure), "doc_id long, x binary").collect()
    found.sort(key=lambda row: (row.doc_id, row.x))
    x = np.array([np.frombuffer(row.x, "<f4") for row in found], np.float32).reshape(-1, FEATURES)
    y = np.array([truth[row.doc_id] for row in found], np.int64)
    held = mix(np.array([row.doc_id for row in found], np.int64).view(np.uint64)) % np.uint64(5) == 0
    if min(np.bincount(y[~held], minlength=2)) == 0:
        return Model(vectors, None)
    return Model(vectors, Network(x, y, held))


def scored(df: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """A struct ``row`` of the columns ``keep``, and ``score``."""
    spark = prepare(df.sparkSession)
    # A text that is kept travels in its row only.
    row = F.struct(*keep).alias("row")
    plain = df.select(row) if text in keep else df.select(row, F.col(text).alias("body"))
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        memo = WordHash(BUCKETS)
        for batch in batches:
            body = batch.column(0).field(text) if text in keep else batch.column(1)
            score = shared.value.scores(texts_of(body), memo)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64())], ["row", "score"])

    return plain.mapInArrow(trimmed(run), f"row {plain.schema['row'].dataType.simpleString()}, score double")


def quality_scores(df: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    out = scored(df, fitted(df, labels), ["doc_id"]).select("row.doc_id", "score")
    return out.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
