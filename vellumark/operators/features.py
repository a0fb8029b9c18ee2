"""Per-document text features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rounding import round_half_up
from .sentiment import SENTIMENT_COLUMNS
from .tokens import DOCUMENT_COLUMNS

PREVIEW_TERMS = 5


def document_profile(scored: DataFrame) -> DataFrame:
    """Counts, mean token length, dominant term and term preview, all row-local.

    ``scored`` holds term statistics and sentiment. Equally frequent terms
    rank by their first occurrence in the document.
    """
    letters = F.aggregate(
        "terms", F.lit(0).cast("long"), lambda total, e: total + e["term_count"] * F.length(e["term"])
    )
    ranked = F.sort_array(
        F.transform(
            "terms",
            lambda e: F.struct(
                (-e["term_count"]).alias("rank"), e["first_position"].alias("at"), e["term"].alias("term")
            ),
        )
    )
    mean_length = F.coalesce(round_half_up(letters / F.nullif("token_count", F.lit(0)), 2), F.lit(0.0))
    profiled = scored.withColumn("leading", F.slice(ranked, 1, PREVIEW_TERMS)["term"])
    return profiled.select(
        *DOCUMENT_COLUMNS,
        "token_count",
        F.size("terms").cast("long").alias("unique_token_count"),
        mean_length.alias("avg_token_length"),
        F.get("leading", F.lit(0)).alias("dominant_term"),
        F.array_join("leading", ", ").alias("term_preview"),
        *SENTIMENT_COLUMNS,
    )


def text_features(scored: DataFrame, top: DataFrame) -> DataFrame:
    """Profiles with the top TF-IDF term; a document without one gets nulls."""
    return document_profile(scored).join(top, "content_id", "left")
