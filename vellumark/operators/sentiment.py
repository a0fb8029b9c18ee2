"""Lexicon sentiment per document."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.lexicon import NEGATIVE_TERMS, POSITIVE_TERMS
from ..functions.porter2 import stem
from ..functions.text import lexicon_hits, sentiment_label, sentiment_score
from .tokens import DOCUMENT_COLUMNS

POSITIVE_STEMS = sorted({stem(word) for word in POSITIVE_TERMS})
NEGATIVE_STEMS = sorted({stem(word) for word in NEGATIVE_TERMS})

SENTIMENT_COLUMNS = ["positive_hits", "negative_hits", "sentiment_score", "sentiment_label"]


def with_sentiment(
    documents: DataFrame,
    positive: Iterable[str] = POSITIVE_STEMS,
    negative: Iterable[str] = NEGATIVE_STEMS,
) -> DataFrame:
    """Add hits, score and label to documents that have a ``tokens`` column."""
    return (
        documents.withColumn("positive_hits", lexicon_hits(F.col("tokens"), positive))
        .withColumn("negative_hits", lexicon_hits(F.col("tokens"), negative))
        .withColumn(
            "sentiment_score",
            sentiment_score(F.col("positive_hits"), F.col("negative_hits"), F.size("tokens")),
        )
        .withColumn("sentiment_label", sentiment_label(F.col("sentiment_score")))
    )


def sentiment_table(scored: DataFrame) -> DataFrame:
    return scored.select(
        *DOCUMENT_COLUMNS, F.size("tokens").cast("long").alias("token_count"), *SENTIMENT_COLUMNS
    )


def label_counts(scored: DataFrame) -> DataFrame:
    """One row; a label that never occurs counts 0."""
    labels = ("positive", "neutral", "negative")
    return scored.agg(
        *[F.count_if(F.col("sentiment_label") == label).alias(f"{label}_document_count") for label in labels]
    )
