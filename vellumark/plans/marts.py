"""Report queries over the derived tables.

Rows whose group key is null are left out, and each top-n has a total order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rounding import round_half_up
from ..operators.clean import admitted, project_catalogue
from ..operators.ordering import top_rows
from ..operators.quality import flagged_columns, quality_band


def _group_counts(df: DataFrame, *keys: str, count: str = "titles") -> DataFrame:
    present = df
    for key in keys:
        present = present.filter(F.col(key).isNotNull())
    return present.groupBy(*keys).agg(F.count("*").alias(count))


def _top_groups(df: DataFrame, n: int, *keys: str) -> DataFrame:
    return _group_counts(df, *keys).orderBy(F.desc("titles"), *keys).limit(n)


def _rows(df: DataFrame):
    return df.agg(F.count("*").alias("n")).scalar()


def retention(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """One row: rows of both stages, share kept and rows dropped."""
    return _retained(raw.agg(F.count("*").alias("raw_rows")).withColumn("cleaned_rows", _rows(cleaned)))


def retention_of_raw(raw: DataFrame) -> DataFrame:
    """``retention`` from one pass over the raw table."""
    both = project_catalogue(raw).agg(F.count("*").alias("raw_rows"), F.count_if(admitted()).alias("cleaned_rows"))
    return _retained(both)


def _retained(counted: DataFrame) -> DataFrame:
    kept = F.col("cleaned_rows") / F.nullif("raw_rows", F.lit(0)) * 100
    return counted.select(
        "raw_rows",
        "cleaned_rows",
        F.greatest(F.col("raw_rows") - F.col("cleaned_rows"), F.lit(0)).alias("dropped_rows"),
        F.coalesce(round_half_up(kept, 2), F.lit(0.0)).alias("retained_pct"),
    )


def type_mix(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Rows per type before and after cleaning; a missing type is ``Unknown``."""

    def stage(df: DataFrame, column: str, name: str) -> DataFrame:
        kind = F.coalesce(column, F.lit("Unknown")).alias("content_type")
        return df.groupBy(kind).agg(F.count("*").alias("rows")).withColumn("stage", F.lit(name))

    return stage(raw, "type", "Raw").unionByName(stage(cleaned, "content_type", "Cleaned"))


def type_mix_of_raw(raw: DataFrame) -> DataFrame:
    """``type_mix`` from one pass over the raw table."""
    kind = F.coalesce("content_type", F.lit("Unknown")).alias("content_type")
    both = project_catalogue(raw).groupBy(kind).agg(F.count("*").alias("raw"), F.count_if(admitted()).alias("cleaned"))
    stages = F.array(*[F.struct(F.col(name.lower()).alias("rows"), F.lit(name).alias("stage")) for name in ("Raw", "Cleaned")])
    return both.select("content_type", F.inline(stages)).filter("rows > 0")


def top_countries(agg: DataFrame, n: int = 15) -> DataFrame:
    return top_rows(agg, "agg", n)


def top_markets(agg: DataFrame, n: int = 12) -> DataFrame:
    return top_rows(agg, "agg", n).select("content_type", "country", "title_count", "avg_release_year")


def release_trend(cleaned: DataFrame) -> DataFrame:
    return _group_counts(cleaned, "release_year", "content_type")


def recency_mix(cleaned: DataFrame) -> DataFrame:
    bucket = F.when(F.col("is_recent"), "Recent (>= 2020)").otherwise("Back catalog")
    return _group_counts(cleaned.withColumn("recent_bucket", bucket), "content_type", "recent_bucket")


def top_keywords(keywords: DataFrame, n: int = 20) -> DataFrame:
    return top_rows(keywords, "keywords", n)


def top_bigrams(bigrams: DataFrame, n: int = 20) -> DataFrame:
    return top_rows(bigrams, "bigrams", n)


def top_tfidf_terms(tfidf: DataFrame, n: int = 20) -> DataFrame:
    return top_rows(tfidf, "tfidf", n)


def sentiment_mix(sentiment: DataFrame) -> DataFrame:
    return _group_counts(sentiment, "content_type", "sentiment_label")


def cluster_mix(topics: DataFrame) -> DataFrame:
    return _group_counts(topics, "topic_cluster", "content_type")


def cluster_sizes(topics: DataFrame) -> DataFrame:
    return _group_counts(topics, "topic_cluster")


def cluster_terms(topics: DataFrame, n: int = 20) -> DataFrame:
    return _top_groups(topics, n, "topic_cluster", "top_tfidf_term")


def text_density(features: DataFrame) -> DataFrame:
    """Mean token counts per type in long form."""
    means = (
        features.filter(F.col("content_type").isNotNull())
        .groupBy("content_type")
        .agg(
            *[
                round_half_up(F.sum(name) / F.count(name), 2).alias(name)
                for name in ("token_count", "unique_token_count")
            ]
        )
    )
    return means.unpivot("content_type", ["token_count", "unique_token_count"], "metric", "value")


def dominant_terms(features: DataFrame, n: int = 15) -> DataFrame:
    return _top_groups(features, n, "content_type", "dominant_term")


def top_pairs(pairs: DataFrame, n: int = 20) -> DataFrame:
    label = F.concat("left_title", F.lit(" <> "), "right_title")
    return top_rows(pairs, "similarity_pairs", n).withColumn("pair_label", label)


def cluster_pair_similarity(pairs: DataFrame, n: int = 20) -> DataFrame:
    """Mean similarity per pair of topics."""
    keys = ["left_topic_cluster", "right_topic_cluster"]
    # Four-decimal similarities are summed as whole numbers, free of order.
    units = F.sum(F.floor(F.col("cosine_similarity") * 10000 + 0.5))
    return (
        pairs.filter(F.col(keys[0]).isNotNull() & F.col(keys[1]).isNotNull())
        .groupBy(*keys)
        .agg((units / F.count("*") / 10000.0).alias("avg_similarity"))
        .orderBy(F.desc("avg_similarity"), *keys)
        .limit(n)
        .withColumn(
            "cluster_pair",
            F.concat(F.col(keys[0]).cast("string"), F.lit(" -> "), F.col(keys[1]).cast("string")),
        )
    )


def explore_cluster_size(topics: DataFrame, cluster: int) -> DataFrame:
    return topics.filter(F.col("topic_cluster") == cluster).agg(F.count("*").alias("titles"))


def explore_cluster_terms(topics: DataFrame, cluster: int, n: int = 10) -> DataFrame:
    return _top_groups(topics.filter(F.col("topic_cluster") == cluster), n, "top_tfidf_term")


def explore_cluster_titles(topics: DataFrame, cluster: int, n: int = 5) -> DataFrame:
    chosen = topics.filter(F.col("topic_cluster") == cluster)
    return chosen.orderBy("content_id").limit(n).select(
        "content_id", "title", "content_type", "country", "sentiment_label"
    )


def quality_bands(report: DataFrame) -> DataFrame:
    return report.select("quality_score", quality_band(F.col("quality_score")).alias("band"))


def null_alerts(stats: DataFrame) -> DataFrame:
    return flagged_columns(stats)


def table_sample(df: DataFrame, table: str, n: int = 25) -> DataFrame:
    return top_rows(df, table, n)
