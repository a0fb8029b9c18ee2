"""Registered queries over a folder of test tables."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cleaning import first_integer
from ..functions.lexicon import NEGATIVE_TERMS, POSITIVE_TERMS
from ..functions.text import bigrams
from ..operators import clean, clusters, features, ordering, quality, sentiment, similar, terms, tokens, topics
from ..session import built_once, materialise, new_path
from ..sources import sinks
from ..sources.catalogue import RAW_COLUMNS, quarantined_csv, read_catalogue_csv, read_report, read_table, table
from . import marts, transform
from .metrics import METRICS_SCHEMA, RunMeter, headline_counts, run_metrics
from .views import document_catalogue, raw_catalogue, vector_items

# Frequent words of the test texts, so that all three labels occur.
FREQUENT_POSITIVE = ["des", "les", "und", "ered", "del", "una"]
FREQUENT_NEGATIVE = ["der", "die", "ment", "tion", "que", "ing"]

# The given vectors lie far apart; at the default distance no pair is found.
VECTOR_DISTANCE = 1.2
VECTOR_COSINE = 0.28
VECTOR_PAIR_LIMITS = {"max_distance": VECTOR_DISTANCE, "min_cosine": VECTOR_COSINE}

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- derived tables that several queries read -------------------------------


def _documents(spark, folder):
    return tokens.text_documents(document_catalogue(spark, folder))


def _content(spark, folder):
    return tokens.content_documents(_documents(spark, folder))


def _scored(spark, folder, positive=POSITIVE_TERMS, negative=NEGATIVE_TERMS):
    return sentiment.with_sentiment(_content(spark, folder), positive, negative)


def _stats(spark, folder):
    """Unstemmed documents with term statistics."""
    return built_once(spark, "stats", folder, lambda: terms.with_term_stats(_scored(spark, folder)))


def _features(spark, folder):
    stats = _stats(spark, folder)
    return features.text_features(stats, terms.top_terms(terms.tfidf_records(stats)))


def _stemmed_stats(spark, folder):
    def build():
        return terms.with_term_stats(
            sentiment.with_sentiment(tokens.stemmed_documents(_content(spark, folder)))
        )

    return built_once(spark, "stemmed-stats", folder, build)


def _stemmed_features(spark, folder):
    stats = _stemmed_stats(spark, folder)
    return built_once(
        spark,
        "stemmed-features",
        folder,
        lambda: features.text_features(stats, terms.top_terms(terms.tfidf_records(stats))),
    )


def _clustered(spark, folder):
    return built_once(
        spark, "clustered", folder, lambda: transform.topics(_stemmed_stats(spark, folder))
    )


def _topics(spark, folder):
    return topics.topic_table(_clustered(spark, folder), _stemmed_features(spark, folder))


def _title_pairs(spark, folder):
    return built_once(spark, "title-pairs", folder, lambda: transform.similar_titles(_clustered(spark, folder)))


def _labelled_topics(spark, folder):
    """Topic rows whose cluster is the given label pair of a document."""
    labels = table(spark, folder, "labels").select(
        F.col("doc_id").cast("string").alias("content_id"),
        (F.col("quality") * 2 + F.col("toxic")).alias("topic_cluster"),
    )
    documents = _stats(spark, folder).select("content_id", "content_type", "country", "title")
    written = built_once(spark, "features", folder, lambda: _features(spark, folder))
    return topics.topic_table(documents.join(labels, "content_id"), written)


def _vector_pairs(spark, folder):
    items = vector_items(spark, folder)
    return built_once(
        spark,
        "vector-pairs",
        folder,
        lambda: similar.describe_pairs(similar.similar_pairs(items, "embedding", **VECTOR_PAIR_LIMITS), items),
    )


def _cleaned(spark, folder):
    return clean.clean_catalogue(raw_catalogue(spark, folder))


def _joined_tokens(df):
    return df.select("content_id", F.array_join("tokens", " ").alias("tokens"))


# --- sources and sinks ------------------------------------------------------


@query
def csv_scan(spark, folder):
    """The raw catalogue written as CSV and scanned again; empty cells read as null."""
    path = new_path(spark, "raw-csv")
    (
        raw_catalogue(spark, folder)
        .write.option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return read_catalogue_csv(spark, path, RAW_COLUMNS)


@query
def csv_quarantine(spark, folder):
    """The raw catalogue as CSV lines, of which three in ten are damaged: each id with the reason of its rejection."""
    path = new_path(spark, "damaged-csv")
    raw = raw_catalogue(spark, folder).select(*RAW_COLUMNS)
    cells = [F.concat(F.lit('"'), F.regexp_replace(F.coalesce(c, F.lit("")), r'(["\\\\])', r"\\$1"), F.lit('"')) for c in RAW_COLUMNS]
    damage = F.pmod(F.col("show_id").cast("long"), F.lit(10))
    line = (
        F.when(damage == 1, F.concat_ws(",", *cells[:3]))
        .when(damage == 2, F.concat_ws(",", *cells, F.lit("more"), F.lit("cells")))
        .when(damage == 3, F.concat(F.concat_ws(",", *cells[:2]), F.lit(',"cut')))
        .otherwise(F.concat_ws(",", *cells))
    )
    # Lines as they are, each file with the header: a sink without quotes and with a separator that no line holds.
    (
        raw.select(line.alias(",".join(RAW_COLUMNS)))
        .write.option("header", True)
        .option("sep", "\u0001")
        .option("quote", "\u0000")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    kept, rejected = quarantined_csv(spark, path)
    lost = rejected.select(F.regexp_extract("line", '^"([^"]*)"', 1).alias("show_id"), "reason")
    return kept.select("show_id", F.lit(None).cast("string").alias("reason")).union(lost)


@query
def parquet_sink(spark, folder):
    path = new_path(spark, "agg")
    summary = clean.catalogue_summary(_cleaned(spark, folder))
    sinks.write_table(summary, path)
    return read_table(spark, path, summary.schema)


@query
def preview_csv_sink(spark, folder):
    path = new_path(spark, "preview")
    summary = clean.catalogue_summary(_cleaned(spark, folder))
    sinks.write_preview_csv(ordering.ordered(summary, "agg"), path)
    return spark.read.schema(summary.schema).option("header", True).csv(path)


@query
def metrics_sink(spark, folder):
    path = new_path(spark, "metrics")
    raw = raw_catalogue(spark, folder)
    cleaned = clean.clean_catalogue(raw)
    sinks.write_report(run_metrics({"raw": raw, "cleaned": cleaned}, "tables"), path)
    return read_report(spark, path, METRICS_SCHEMA).select(
        "source_file", "raw_row_count", "cleaned_row_count", "dropped_row_count"
    )


@query
def quality_report_sink(spark, folder):
    path = new_path(spark, "quality")
    report = quality.quality_report(table(spark, folder, "customer"), ["c_custkey"])
    sinks.write_report(report, path)
    stored = read_report(spark, path, report.schema)
    return stored.select("total_rows", "quality_score", F.inline("columns"))


# --- cleaning ---------------------------------------------------------------


@query
def catalogue_parsed(spark, folder):
    parsed = clean.project_catalogue(raw_catalogue(spark, folder))
    return parsed.withColumn("date_added", F.col("date_added").cast("string"))


@query
def catalogue_clean(spark, folder):
    return _cleaned(spark, folder).withColumn("date_added", F.col("date_added").cast("string"))


@query
def catalogue_summary(spark, folder):
    return clean.catalogue_summary(_cleaned(spark, folder))


@query
def brand_numbers(spark, folder):
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("content_id"), first_integer(F.col("p_brand")).alias("brand_number")
    )


# --- text chain -------------------------------------------------------------


@query
def text_documents(spark, folder):
    return _documents(spark, folder)


@query
def normalised_documents(spark, folder):
    return tokens.normalised_documents(_documents(spark, folder)).select("content_id", "text")


@query
def tokenised_documents(spark, folder):
    return _joined_tokens(tokens.tokenised_documents(_documents(spark, folder)))


@query
def filtered_documents(spark, folder):
    tokenised = tokens.tokenised_documents(_documents(spark, folder))
    return _joined_tokens(tokens.filtered_documents(tokenised))


@query
def content_documents(spark, folder):
    return _joined_tokens(_content(spark, folder))


@query
def stemmed_documents(spark, folder):
    return _joined_tokens(_stemmed_stats(spark, folder))


@query
def document_bigrams(spark, folder):
    pairs = F.explode_outer(bigrams(F.col("tokens"))).alias("bigram")
    return _content(spark, folder).select("content_id", pairs).filter(F.col("bigram").isNotNull())


@query
def document_terms(spark, folder):
    """Distinct terms per document with count and first position."""
    return _stats(spark, folder).select("content_id", F.inline("terms"))


# --- sentiment --------------------------------------------------------------


@query
def sentiment_table(spark, folder):
    return sentiment.sentiment_table(_scored(spark, folder))


@query
def sentiment_table_frequent_lexicon(spark, folder):
    return sentiment.sentiment_table(_scored(spark, folder, FREQUENT_POSITIVE, FREQUENT_NEGATIVE))


@query
def sentiment_label_counts(spark, folder):
    return sentiment.label_counts(_scored(spark, folder, FREQUENT_POSITIVE, FREQUENT_NEGATIVE))


@query
def sentiment_table_stemmed(spark, folder):
    return sentiment.sentiment_table(_stemmed_stats(spark, folder))


# --- terms ------------------------------------------------------------------


@query
def keyword_counts(spark, folder):
    return terms.keyword_counts(_content(spark, folder))


@query
def keyword_counts_stemmed(spark, folder):
    return terms.keyword_counts(_stemmed_stats(spark, folder))


@query
def bigram_counts(spark, folder):
    return terms.bigram_counts(_content(spark, folder))


@query
def bigram_counts_stemmed(spark, folder):
    return terms.bigram_counts(_stemmed_stats(spark, folder))


@query
def term_frequencies(spark, folder):
    return terms.term_frequencies(_stats(spark, folder))


@query
def document_frequencies(spark, folder):
    return terms.document_frequencies(terms.term_frequencies(_stats(spark, folder)))


@query
def tfidf_records(spark, folder):
    return terms.tfidf_records(_stats(spark, folder))


@query
def top_terms(spark, folder):
    return terms.top_terms(terms.tfidf_records(_stats(spark, folder)))


@query
def tfidf_summary(spark, folder):
    return terms.tfidf_summary(terms.tfidf_records(_stats(spark, folder)))


@query
def tfidf_summary_stemmed(spark, folder):
    return terms.tfidf_summary(terms.tfidf_records(_stemmed_stats(spark, folder)))


@query
def document_profile(spark, folder):
    return features.document_profile(_stats(spark, folder))


@query
def text_features(spark, folder):
    return _features(spark, folder)


@query
def text_features_stemmed(spark, folder):
    return _stemmed_features(spark, folder)


# --- orders and top-n -------------------------------------------------------


@query
def top_keyword_counts(spark, folder):
    return ordering.top_rows(terms.keyword_counts(_content(spark, folder)), "keywords", 10)


@query
def top_bigram_counts(spark, folder):
    return ordering.top_rows(terms.bigram_counts(_content(spark, folder)), "bigrams", 10)


@query
def top_tfidf_records(spark, folder):
    return ordering.top_rows(terms.tfidf_records(_stats(spark, folder)), "tfidf_records", 10)


@query
def catalogue_preview(spark, folder):
    return ordering.top_rows(clean.catalogue_summary(_cleaned(spark, folder)), "agg", 50)


@query
def ordered_sentiment(spark, folder):
    scored = _scored(spark, folder, FREQUENT_POSITIVE, FREQUENT_NEGATIVE)
    return ordering.ranked(sentiment.sentiment_table(scored), "sentiment")


@query
def ordered_text_features(spark, folder):
    return ordering.ranked(_features(spark, folder), "text_features")


@query
def ordered_keywords(spark, folder):
    return ordering.ranked(terms.keyword_counts(_content(spark, folder)), "keywords")


@query
def ordered_tfidf(spark, folder):
    return ordering.ranked(terms.tfidf_summary(terms.tfidf_records(_stats(spark, folder))), "tfidf")


@query
def ordered_topics(spark, folder):
    return ordering.ranked(_labelled_topics(spark, folder), "topic_clusters")


@query
def ordered_pairs(spark, folder):
    return ordering.ranked(_vector_pairs(spark, folder), "similarity_pairs")


# --- quality ----------------------------------------------------------------


@query
def quality_columns(spark, folder):
    return quality.column_stats(clean.project_catalogue(raw_catalogue(spark, folder)))


@query
def quality_columns_lineitem(spark, folder):
    return quality.column_stats(table(spark, folder, "lineitem"))


@query
def profile_of_parts(spark, folder):
    """Profile from the merged states of two parts, with integers above 2 ** 53 and arrays that look alike as text."""
    events = table(spark, folder, "events").select(
        (F.col("event_id") + (1 << 53)).alias("large"),
        F.when(F.col("event_id") % 3 == 0, F.array(F.lit("a, b"))).otherwise(F.array(F.lit("a"), F.lit("b"))).alias("names"),
        F.nullif("user_id", F.lit(1)).alias("user_id"),
        "event_type",
    )
    first, second = events.filter("large % 2 = 0"), events.filter("large % 2 = 1")
    state = quality.merged_states(quality.profile_state(first), quality.profile_state(second))
    return quality.stats_of_state(state, events.columns)


@query
def quality_duplicates(spark, folder):
    found = quality.key_duplicates(table(spark, folder, "orders"), ["o_custkey", "o_orderstatus"])
    return found.withColumn("key_columns", F.array_join("key_columns", ","))


@query
def quality_report(spark, folder):
    report = quality.quality_report(clean.project_catalogue(raw_catalogue(spark, folder)), ["title"])
    return report.select(
        "total_rows",
        "column_count",
        F.col("duplicates.distinct_rows").alias("distinct_rows"),
        F.col("duplicates.duplicate_rows").alias("duplicate_rows"),
        F.col("duplicates.duplicate_pct").alias("duplicate_pct"),
        "quality_score",
    )


@query
def quality_bands(spark, folder):
    return marts.quality_bands(
        quality.quality_report(clean.project_catalogue(raw_catalogue(spark, folder)), ["title"])
    )


@query
def quality_null_alerts(spark, folder):
    return marts.null_alerts(quality.column_stats(clean.project_catalogue(raw_catalogue(spark, folder))))


# --- catalogue reports ------------------------------------------------------


@query
def retention(spark, folder):
    return marts.retention_of_raw(raw_catalogue(spark, folder))


@query
def type_mix(spark, folder):
    return marts.type_mix_of_raw(raw_catalogue(spark, folder))


@query
def top_countries(spark, folder):
    return marts.top_countries(clean.catalogue_summary(_cleaned(spark, folder)))


@query
def top_markets(spark, folder):
    return marts.top_markets(clean.catalogue_summary(_cleaned(spark, folder)))


@query
def release_trend(spark, folder):
    return marts.release_trend(_cleaned(spark, folder))


@query
def recency_mix(spark, folder):
    return marts.recency_mix(_cleaned(spark, folder))


@query
def cleaned_sample(spark, folder):
    sample = marts.table_sample(_cleaned(spark, folder), "cleaned", 10)
    return sample.withColumn("date_added", F.col("date_added").cast("string"))


# --- text reports -----------------------------------------------------------


@query
def report_keywords(spark, folder):
    return marts.top_keywords(terms.keyword_counts(_content(spark, folder)))


@query
def report_bigrams(spark, folder):
    return marts.top_bigrams(terms.bigram_counts(_content(spark, folder)))


@query
def report_tfidf_terms(spark, folder):
    return marts.top_tfidf_terms(terms.tfidf_summary(terms.tfidf_records(_stats(spark, folder))))


@query
def sentiment_mix(spark, folder):
    scored = _scored(spark, folder, FREQUENT_POSITIVE, FREQUENT_NEGATIVE)
    return marts.sentiment_mix(scored.select("content_type", "sentiment_label"))


@query
def text_density(spark, folder):
    return marts.text_density(features.document_profile(_stats(spark, folder)))


@query
def dominant_terms(spark, folder):
    return marts.dominant_terms(features.document_profile(_stats(spark, folder)))


# --- vectors, topics and pairs ----------------------------------------------


@query
def unit_vectors(spark, folder):
    scaled = topics.unit_vectors(vector_items(spark, folder), "embedding")
    return scaled.select("content_id", F.posexplode("embedding").alias("position", "value")).withColumn(
        "value", F.round("value", 6)
    )


@query
def similar_pairs_all(spark, folder):
    return similar.similar_pairs(vector_items(spark, folder), "embedding", neighbours=None, **VECTOR_PAIR_LIMITS)


@query
def similar_pairs_nearest(spark, folder):
    return similar.similar_pairs(vector_items(spark, folder), "embedding", **VECTOR_PAIR_LIMITS)


@query
def similar_pairs_hashed(spark, folder):
    return similar.similar_pairs(
        vector_items(spark, folder), "embedding", hashing=similar.WIDE_HASHING, **VECTOR_PAIR_LIMITS
    )


def _repeated_items(spark, folder):
    """Vectors of which every id divisible by 3 has the vectors of two rows, and one id in four occurs three times."""
    vectors = table(spark, folder, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    moved = vectors.filter("vec_id % 3 = 1").select((F.col("vec_id") - 1).alias("vec_id"), "embedding")
    again = vectors.filter("vec_id % 4 = 0")
    every = vectors.unionByName(moved).unionByName(again).unionByName(again)
    return every.select(F.col("vec_id").cast("string").alias("content_id"), "embedding")


@query
def similar_pairs_repeated(spark, folder):
    """Nearest neighbours where ids repeat with the same and with other vectors."""
    return similar.similar_pairs(_repeated_items(spark, folder), "embedding", block_rows=128, **VECTOR_PAIR_LIMITS)


@query
def similar_pairs_probed(spark, folder):
    """The pairs of all items, how many probing finds beside them (none), and whether it finds 95 % of them."""
    items = vector_items(spark, folder)
    probing = similar.Probing(radius=VECTOR_DISTANCE)
    exact = similar.similar_pairs(items, "embedding", neighbours=None, block_rows=64, **VECTOR_PAIR_LIMITS)
    probed = similar.similar_pairs(items, "embedding", neighbours=None, hashing=probing, block_rows=64, **VECTOR_PAIR_LIMITS)
    names = ["left_content_id", "right_content_id"]
    both = exact.select(*names, F.lit(True).alias("exact")).join(probed.select(*names, F.lit(True).alias("probed")), names, "full")
    return both.agg(
        F.count("exact").alias("exact_pairs"),
        F.count_if(F.col("exact").isNull()).alias("surplus"),
        (F.count_if(F.col("exact") & F.col("probed")) >= 0.95 * F.count("exact")).alias("reached"),
    )


@query
def similar_pairs_described(spark, folder):
    return _vector_pairs(spark, folder)


@query
def similar_titles(spark, folder):
    return _title_pairs(spark, folder)


@query
def topic_clusters(spark, folder):
    return _topics(spark, folder)


@query
def topic_cluster_count(spark, folder):
    return topics.cluster_count(_clustered(spark, folder))


@query
def topic_cluster_mix(spark, folder):
    return marts.cluster_mix(_clustered(spark, folder))


@query
def topic_cluster_mix_word2vec(spark, folder):
    """The same mix from Spark's own models."""
    return marts.cluster_mix(transform.topics(_stemmed_stats(spark, folder), reproducible=False))


@query
def vector_lloyd_step(spark, folder):
    """Sums of one step of k-means from the vectors of the eight least ids."""
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    largest = clusters.largest_component(vectors, "embedding")
    first = vectors.orderBy("vec_id").limit(8).select(clusters.whole(vectors, "embedding", largest).alias("point")).collect()
    points = clusters.whole_vectors(vectors, "vec_id", "embedding", largest)
    sums = clusters.cluster_sums(points, np.array([r["point"] for r in first], float))
    return sums.filter("items > 0").withColumnRenamed("cluster", "topic_cluster")


@query
def vector_clusters(spark, folder):
    """Topic of every vector."""
    vectors = vector_items(spark, folder).select("content_id", "embedding")
    return clusters.stable_topics(materialise(vectors, "vectors")).select("content_id", "topic_cluster")


@query
def topic_cluster_terms(spark, folder):
    return marts.cluster_terms(_topics(spark, folder))


@query
def top_title_pairs(spark, folder):
    return marts.top_pairs(_title_pairs(spark, folder))


@query
def topic_pair_similarity(spark, folder):
    return marts.cluster_pair_similarity(_title_pairs(spark, folder))


@query
def topic_explorer_titles(spark, folder):
    return marts.explore_cluster_titles(_topics(spark, folder), 0)


@query
def labelled_topics(spark, folder):
    return _labelled_topics(spark, folder)


@query
def labelled_cluster_mix(spark, folder):
    return marts.cluster_mix(_labelled_topics(spark, folder))


@query
def labelled_cluster_sizes(spark, folder):
    return marts.cluster_sizes(_labelled_topics(spark, folder))


@query
def labelled_cluster_terms(spark, folder):
    return marts.cluster_terms(_labelled_topics(spark, folder))


@query
def labelled_explorer_size(spark, folder):
    return marts.explore_cluster_size(_labelled_topics(spark, folder), 2)


@query
def labelled_explorer_terms(spark, folder):
    return marts.explore_cluster_terms(_labelled_topics(spark, folder), 2)


@query
def labelled_explorer_titles(spark, folder):
    return marts.explore_cluster_titles(_labelled_topics(spark, folder), 2)


@query
def vector_top_pairs(spark, folder):
    return marts.top_pairs(_vector_pairs(spark, folder))


@query
def vector_group_similarity(spark, folder):
    return marts.cluster_pair_similarity(_vector_pairs(spark, folder))


# --- run metrics ------------------------------------------------------------


def _metric_tables(spark, folder):
    """Tables of a run; the costly ones are read back as written."""

    def written(name, build):
        return built_once(spark, f"run-{name}", folder, build)

    raw = raw_catalogue(spark, folder)
    cleaned = clean.clean_catalogue(raw)
    stats = _stats(spark, folder)
    return {
        "raw": raw,
        "cleaned": cleaned,
        "agg": clean.catalogue_summary(cleaned),
        "tokenised": tokens.tokenised_documents(_documents(spark, folder)),
        "filtered": stats,
        "stemmed": stats,
        "text_features": stats,
        "keywords": written("keywords", lambda: terms.keyword_counts(stats)),
        "bigrams": written("bigrams", lambda: terms.bigram_counts(stats)),
        "tfidf": written("tfidf", lambda: terms.tfidf_summary(terms.tfidf_records(stats))),
        "sentiment": stats,
        "topic_clusters": written("topics", lambda: _labelled_topics(spark, folder)),
        "similarity_pairs": _vector_pairs(spark, folder),
    }


@query
def run_metrics_row(spark, folder):
    return run_metrics(_metric_tables(spark, folder), "tables", stamp=False).drop("generated_at_utc")


@query
def headline_numbers(spark, folder):
    """No stored metrics: every number falls back on its table."""
    return headline_counts(spark.createDataFrame([], METRICS_SCHEMA), _metric_tables(spark, folder))


@query
def run_metrics_observed(spark, folder):
    """Every metric from the writes of the tables themselves, through the report sink.

    Text tables are the unstemmed ones; topics are labels and pairs are vectors, which SQL can follow.
    """
    meter = RunMeter()

    def store(name, df):
        path = new_path(spark, f"observed-{name}")
        sinks.write_table(meter.watch(df, name), path)
        return spark.read.schema(df.schema).parquet(path)

    cleaned = store("cleaned", clean.clean_catalogue(meter.watch(raw_catalogue(spark, folder), "raw")))
    store("agg", clean.catalogue_summary(cleaned))
    stats = transform.analysed(_documents(spark, folder), stem=False, name="observed-stats", meter=meter)
    records = terms.tfidf_records(stats)
    store("text_features", features.text_features(stats, terms.top_terms(records)))
    store("keywords", terms.keyword_counts(stats))
    store("bigrams", terms.bigram_counts(stats))
    store("tfidf", terms.tfidf_summary(records))
    store("sentiment", sentiment.sentiment_table(stats))
    store("topic_clusters", _labelled_topics(spark, folder))
    store("similarity_pairs", _vector_pairs(spark, folder))
    path = new_path(spark, "observed-metrics")
    sinks.write_report(meter.row(spark, "tables"), path)
    return read_report(spark, path, METRICS_SCHEMA).drop("generated_at_utc")


@query
def headline_numbers_stored(spark, folder):
    """Headline numbers where a run has stored its metrics."""
    found = _metric_tables(spark, folder)
    metrics = built_once(spark, "stored-metrics", folder, lambda: run_metrics(found, "tables", stamp=False))
    return headline_counts(metrics, found)
