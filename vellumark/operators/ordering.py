"""Total presentation orders and top-n reports.

Sorting a whole table costs a range shuffle, so operators return unsorted
rows; these orders are applied where a report asks for them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise


def _order(table: str):
    # The keys by which each table is presented.
    mentions = [F.desc("title_mentions"), F.asc("content_type")]
    return {
        "agg": [F.desc("title_count"), F.desc("avg_release_year"), F.asc("content_type"), F.asc("country")],
        "text_features": [F.desc("token_count"), F.asc("content_id")],
        "keywords": [*mentions, F.asc("keyword")],
        "bigrams": [*mentions, F.asc("bigram")],
        "tfidf": [F.desc("avg_tfidf"), F.desc("max_tfidf"), F.asc("content_type"), F.asc("term")],
        "tfidf_records": [F.desc("tfidf_score"), F.asc("content_type"), F.asc("term"), F.asc("content_id")],
        "sentiment": [F.desc(F.abs("sentiment_score")), F.asc("content_id")],
        "topic_clusters": [F.asc("topic_cluster"), F.desc_nulls_last("top_tfidf_score"), F.asc("content_id")],
        "similarity_pairs": [F.desc("cosine_similarity"), F.asc("left_content_id"), F.asc("right_content_id")],
        "cleaned": [F.asc("content_id")],
    }[table]


def ordered(df: DataFrame, table: str) -> DataFrame:
    """``df`` in the order its table is presented in."""
    return df.orderBy(*_order(table))


def ranked(df: DataFrame, table: str, place: str = "place") -> DataFrame:
    """``df`` with the place of each row in presentation order, from 1, without one task that sorts all.

    Rows are ranged by the order; a row's place is its place in its range behind all earlier ranges, whose
    sizes are one row each. So a table in kept order can be checked, cut into pages and joined by place.
    """
    order = _order(table)
    # Range borders are sampled, so the placement is written once and reread.
    ranged = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    placed = materialise(ranged, f"ranked-{table}")
    sizes = placed.groupBy("_range").agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    numbered = placed.withColumn("_within", within).join(starts, "_range")
    return numbered.withColumn(place, F.col("_before") + F.col("_within")).drop("_range", "_within", "_before")


def top_rows(df: DataFrame, table: str, n: int) -> DataFrame:
    """First ``n`` rows in presentation order, without sorting the rest."""
    return ordered(df, table).limit(n)


def sample_rows(df: DataFrame, n: int = 10) -> DataFrame:
    """Some ``n`` rows, for inspection."""
    return df.limit(n)


def preview_documents(df: DataFrame, n: int = 5, characters: int = 90, tokens: int = 8) -> DataFrame:
    """A few documents with shortened text or tokens, for inspection only."""
    shortened = {
        "text": lambda: F.substring("text", 1, characters),
        "tokens": lambda: F.slice("tokens", 1, tokens),
    }
    present = {name: make() for name, make in shortened.items() if name in df.columns}
    return df.limit(n).withColumns(present)
