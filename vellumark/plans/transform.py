"""The whole run: raw catalogue in, derived tables, preview and metrics out.

    spark-submit --py-files vellumark.zip vellumark/plans/transform.py CSV OUT
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumark.functions.lexicon import NEGATIVE_TERMS, POSITIVE_TERMS
from vellumark.operators.clean import catalogue_summary, clean_catalogue
from vellumark.operators.features import text_features
from vellumark.operators.ordering import ordered
from vellumark.operators.sentiment import sentiment_table, with_sentiment
from vellumark.operators.clusters import stable_topics
from vellumark.operators.probing import Probing
from vellumark.operators.similar import Hashing, describe_pairs, similar_pairs
from vellumark.operators.spectral import spectral_embeddings
from vellumark.operators.terms import (
    bigram_counts,
    keyword_counts,
    tfidf_records,
    tfidf_summary,
    top_terms,
    with_term_stats,
)
from vellumark.operators.tokens import (
    content_documents,
    has_tokens,
    stemmed_documents,
    text_documents,
    tokenised_documents,
)
from vellumark.operators.topics import assign_topics, embed_documents, topic_table
from vellumark.plans.metrics import RunMeter
from vellumark.session import build_session, materialise
from vellumark.sources.catalogue import read_catalogue_csv
from vellumark.sources.sinks import write_preview_csv, write_report, write_table


def analysed(documents: DataFrame, stem: bool = True, name: str = "stats", meter: RunMeter | None = None) -> DataFrame:
    """Scored documents with term statistics, written once for the passes that follow.

    A ``meter`` counts the documents of each step in the same pass.
    """
    if meter:
        documents = meter.watch(documents, "tokenised", has_tokens(F.col("text")))
    content = content_documents(documents)
    if meter:
        content = meter.watch(content, "filtered")
    scored = with_sentiment(stemmed_documents(content)) if stem else with_sentiment(content, POSITIVE_TERMS, NEGATIVE_TERMS)
    stats = with_term_stats(scored)
    return materialise(meter.watch(stats, "stemmed") if meter else stats, name)


def topics(stats: DataFrame, reproducible: bool = True) -> DataFrame:
    """Documents with vectors and topic numbers.

    Vectors come from co-occurrence and clusters from whole numbers, equal in every run; without
    ``reproducible`` from Spark's Word2Vec and KMeans, which differ somewhat from run to run.
    """
    if reproducible:
        clustered = stable_topics(materialise(spectral_embeddings(stats), "embedded"))
    else:
        clustered = assign_topics(materialise(embed_documents(stats), "embedded"))
    return materialise(clustered.select(
        "content_id", "content_type", "country", "title", "topic_cluster", "embedding", "normalized_embedding"
    ), "clustered")


def similar_titles(clustered: DataFrame, hashing: Hashing | Probing | None = None) -> DataFrame:
    """Described pairs of documents, exact; with ``hashing`` those that it brings together."""
    pairs = similar_pairs(clustered, "normalized_embedding", hashing=hashing)
    return describe_pairs(pairs, clustered)


def text_tables(raw: DataFrame, cleaned: DataFrame | None = None, meter: RunMeter | None = None) -> dict[str, DataFrame]:
    """Cleaned, grouped and text tables by name; no model is trained.

    ``cleaned`` is the cleaned table where it has been written already.
    """
    cleaned = clean_catalogue(raw) if cleaned is None else cleaned
    documents = text_documents(cleaned)
    stats = analysed(documents, meter=meter)
    records = tfidf_records(stats)
    return {
        "raw": raw,
        "cleaned": cleaned,
        "agg": catalogue_summary(cleaned),
        "tokenised": tokenised_documents(documents),
        "filtered": content_documents(documents),
        "stemmed": stats,
        "text_features": materialise(text_features(stats, top_terms(records)), "features"),
        "keywords": keyword_counts(stats),
        "bigrams": bigram_counts(stats),
        "tfidf": tfidf_summary(records),
        "sentiment": sentiment_table(stats),
    }


def run_tables(raw: DataFrame, cleaned: DataFrame | None = None, meter: RunMeter | None = None) -> dict[str, DataFrame]:
    """Every table of a run by name.

    Without any document there is nothing to train on, and the tables that
    need a model are left out.
    """
    tables = text_tables(raw, cleaned, meter)
    if tables["stemmed"].isEmpty():
        return tables
    clustered = topics(tables["stemmed"])
    return {
        **tables,
        "topic_clusters": topic_table(clustered, tables["text_features"]),
        "similarity_pairs": similar_titles(clustered),
    }


OUTPUTS = [
    "cleaned", "agg", "text_features", "keywords", "bigrams", "tfidf", "sentiment", "topic_clusters",
    "similarity_pairs",
]


def run(spark: SparkSession, source: str, out: str, sort: bool = False) -> None:
    """Write all tables below ``out``; ``sort`` stores them in presentation order."""
    meter = RunMeter()
    raw = read_catalogue_csv(spark, source)
    write_table(meter.watch(clean_catalogue(meter.watch(raw, "raw")), "cleaned"), f"{out}/cleaned")
    tables = run_tables(raw, spark.read.parquet(f"{out}/cleaned"), meter)
    for name in OUTPUTS[1:]:
        if name in tables:
            df = ordered(tables[name], name) if sort else tables[name]
            write_table(meter.watch(df, name), f"{out}/{name}")
    write_preview_csv(ordered(spark.read.parquet(f"{out}/agg"), "agg"), f"{out}/preview.csv")
    write_report(meter.row(spark, source), f"{out}/metrics.json")


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("source")
    parser.add_argument("out")
    parser.add_argument("--sort", action="store_true")
    options = parser.parse_args()
    spark = build_session("catalogue-transform")
    run(spark, options.source, options.out, options.sort)
    spark.stop()


if __name__ == "__main__":
    main()
