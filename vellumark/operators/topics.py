"""Document embeddings and topic clusters with Spark ML."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import Normalizer, Word2Vec
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VECTOR_SIZE = 64
MIN_COUNT = 2
WINDOW_SIZE = 5
TOPICS = 8
SEED = 42
# Tasks that train word vectors at the same time, and tasks of a k-means step. Both are
# part of the result, so they are set here and follow neither the input nor the machine.
TRAINING_PARTITIONS = 8
CLUSTER_PARTITIONS = 64


def _laid_out(df: DataFrame, partitions: int, *columns: str) -> DataFrame:
    """``df`` in an order and partitions that follow from its rows alone."""
    return df.repartition(partitions, *columns).sortWithinPartitions(*columns)


def embed_documents(
    stats: DataFrame,
    vector_size: int = VECTOR_SIZE,
    min_count: int = MIN_COUNT,
    window_size: int = WINDOW_SIZE,
    seed: int = SEED,
    partitions: int = TRAINING_PARTITIONS,
) -> DataFrame:
    """Add ``embedding`` (mean word vector) and its unit-length copy.

    The rows are laid out anew, so the model does not depend on how they are stored. With
    ``partitions=1`` equal rows train equal models. With more, Spark's training tasks of
    one executor update a shared array, so vectors differ somewhat from run to run; one
    task for a large corpus would take too long, hence the default. The word vectors lie in one array on the driver and in each task: a
    vocabulary beyond that is an error, whose remedy is a larger ``min_count``.
    Documents without a word of the vocabulary get the zero vector.
    """
    model = Word2Vec(
        vectorSize=vector_size,
        minCount=min_count,
        windowSize=window_size,
        numPartitions=partitions,
        inputCol="tokens",
        outputCol="embedding",
        seed=seed,
    ).fit(_laid_out(stats.select("content_id", "tokens"), partitions, "content_id", "tokens"))
    unit = Normalizer(inputCol="embedding", outputCol="normalized_embedding", p=2.0)
    return unit.transform(model.transform(stats))


def assign_topics(
    embedded: DataFrame,
    topics: int = TOPICS,
    seed: int = SEED,
    max_iter: int = 30,
    partitions: int = CLUSTER_PARTITIONS,
) -> DataFrame:
    """Add ``topic_cluster``, from k-means on the embeddings before scaling."""
    rows = embedded.select("content_id", vector_to_array("embedding").alias("values"))
    laid_out = _laid_out(rows, partitions, "content_id", "values").select(array_to_vector("values").alias("embedding"))
    model = KMeans(
        k=topics, seed=seed, maxIter=max_iter, featuresCol="embedding", predictionCol="topic_cluster"
    ).fit(laid_out)
    return model.transform(embedded)


def topic_table(clustered: DataFrame, features: DataFrame) -> DataFrame:
    """Clusters with the main features of each document."""
    return clustered.select("content_id", "content_type", "country", "title", "topic_cluster").join(
        features.select(
            "content_id",
            "dominant_term",
            "top_tfidf_term",
            "top_tfidf_score",
            "sentiment_label",
            "sentiment_score",
        ),
        "content_id",
        "left",
    )


def unit_vectors(df: DataFrame, vector: str) -> DataFrame:
    """Scale an array column to length 1; a zero vector stays zero."""
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda total, x: total + x * x))
    return df.withColumn("norm", norm).withColumn(
        vector, F.when(F.col("norm") > 0, F.transform(vector, lambda x: x / F.col("norm"))).otherwise(F.col(vector))
    ).drop("norm")


def cluster_count(topic_rows: DataFrame) -> DataFrame:
    return topic_rows.agg(F.count_distinct("topic_cluster").alias("topic_cluster_count"))
