import pytest

from vellumark.operators.clean import catalogue_summary, clean_catalogue
from vellumark.operators.ordering import ordered, preview_documents, sample_rows
from vellumark.plans import marts
from vellumark.plans.metrics import METRICS_SCHEMA, headline_counts, run_metrics


def test_retention(raw):
    row = marts.retention(raw, clean_catalogue(raw)).first()
    assert tuple(row) == (16, 10, 6, 62.5)
    assert tuple(marts.retention(raw.filter("false"), clean_catalogue(raw).filter("false")).first()) == (0, 0, 0, 0.0)


def test_type_mix_names_missing_types(raw):
    rows = {(r["stage"], r["content_type"]): r["rows"] for r in marts.type_mix(raw, clean_catalogue(raw)).collect()}
    assert rows == {
        ("Raw", "Movie"): 14, ("Raw", "TV Show"): 1, ("Raw", "Unknown"): 1,
        ("Cleaned", "Movie"): 8, ("Cleaned", "TV Show"): 1, ("Cleaned", "Unknown"): 1,
    }


def test_reports_leave_out_missing_keys(raw):
    cleaned = clean_catalogue(raw)
    assert sum(r["titles"] for r in marts.release_trend(cleaned).collect()) == 9
    mix = {(r[0], r[1]): r[2] for r in marts.recency_mix(cleaned).collect()}
    assert mix == {("Movie", "Recent (>= 2020)"): 1, ("Movie", "Back catalog"): 7, ("TV Show", "Back catalog"): 1}


def test_top_groups(raw):
    agg = catalogue_summary(clean_catalogue(raw))
    assert marts.top_countries(agg, 1).first()["title_count"] == 8
    assert marts.top_markets(agg).columns == ["content_type", "country", "title_count", "avg_release_year"]
    assert marts.table_sample(clean_catalogue(raw), "cleaned", 3).count() == 3
    assert sample_rows(raw, 2).count() == 2
    shown = preview_documents(raw.selectExpr("show_id", "repeat('ab', 99) text", "array_repeat('t', 20) tokens"), 3)
    assert [(len(r["text"]), len(r["tokens"])) for r in shown.collect()] == [(90, 8)] * 3


TOPICS = [
    ("a", "A", "Movie", "Peru", 0, "sea", "sea", 0.5, "neutral", 0.0),
    ("b", "B", "Movie", "Peru", 0, "sea", "sea", None, "positive", 0.2),
    ("c", "C", "TV Show", "Peru", 1, "sky", None, 0.1, "neutral", 0.0),
    ("d", "D", "TV Show", "Peru", 0, None, "sky", 0.9, "neutral", 0.0),
]


@pytest.fixture(scope="module")
def topic_rows(spark):
    return spark.createDataFrame(
        TOPICS,
        "content_id string, title string, content_type string, country string, topic_cluster int, "
        "dominant_term string, top_tfidf_term string, top_tfidf_score double, sentiment_label string, "
        "sentiment_score double",
    )


def test_clusters(topic_rows):
    assert {tuple(r) for r in marts.cluster_mix(topic_rows).collect()} == {
        (0, "Movie", 2), (0, "TV Show", 1), (1, "TV Show", 1),
    }
    assert {tuple(r) for r in marts.cluster_sizes(topic_rows).collect()} == {(0, 3), (1, 1)}
    assert [tuple(r) for r in marts.cluster_terms(topic_rows).collect()] == [(0, "sea", 2), (0, "sky", 1)]
    assert [tuple(r) for r in marts.explore_cluster_terms(topic_rows, 0, 1).collect()] == [("sea", 2)]
    assert marts.explore_cluster_size(topic_rows, 0).first()[0] == 3
    assert [r["title"] for r in marts.explore_cluster_titles(topic_rows, 0, 2).collect()] == ["A", "B"]
    assert [r["content_id"] for r in ordered(topic_rows, "topic_clusters").collect()] == ["d", "a", "b", "c"]


def test_pairs(spark):
    pairs = spark.createDataFrame(
        [("a", "A", 0, "b", "B", 1, 0.9), ("a", "A", 0, "c", "C", 1, 0.8), ("b", "B", 1, "c", "C", 1, 0.95)],
        "left_content_id string, left_title string, left_topic_cluster int, right_content_id string, "
        "right_title string, right_topic_cluster int, cosine_similarity double",
    )
    assert [r["pair_label"] for r in marts.top_pairs(pairs, 2).collect()] == ["B <> C", "A <> B"]
    mix = marts.cluster_pair_similarity(pairs).collect()
    assert [(r["cluster_pair"], r["avg_similarity"]) for r in mix] == [("1 -> 1", 0.95), ("0 -> 1", 0.85)]


def test_metrics_of_partial_runs(raw):
    cleaned = clean_catalogue(raw)
    keywords = cleaned.selectExpr("content_type", "title keyword", "1L title_mentions").filter("false")
    tables = {"raw": raw, "cleaned": cleaned, "agg": catalogue_summary(cleaned), "keywords": keywords}
    row = run_metrics(tables, "in.csv").first()
    assert len(row) == 23 and list(row.asDict()) == METRICS_SCHEMA.names
    assert (row["raw_row_count"], row["cleaned_row_count"], row["dropped_row_count"]) == (16, 10, 6)
    assert row["keyword_row_count"] == 0 and row["top_keyword"] is None and row["bigram_row_count"] is None
    assert row["generated_at_utc"].endswith("+00:00")


def test_headlines_prefer_stored_metrics(spark, raw):
    tables = {"raw": raw, "cleaned": clean_catalogue(raw)}
    stored = spark.createDataFrame(
        [tuple({"raw_row_count": 99, "positive_document_count": 4}.get(name) for name in METRICS_SCHEMA.names)],
        METRICS_SCHEMA,
    )
    row = headline_counts(stored, tables).first()
    assert (row["raw_row_count"], row["cleaned_row_count"], row["dropped_row_count"]) == (99, 10, 89)
    assert (row["positive_document_count"], row["negative_document_count"]) == (4, 0)
    assert headline_counts(spark.createDataFrame([], METRICS_SCHEMA), tables).first()["dropped_row_count"] == 6
    nothing = headline_counts(stored, {"raw": raw, "cleaned": tables["cleaned"].filter("false")}).first()
    assert (nothing["cleaned_row_count"], nothing["dropped_row_count"]) == (0, 0)


def test_one_pass_over_the_raw_table_gives_the_same(raw):
    cleaned = clean_catalogue(raw)
    assert marts.retention_of_raw(raw).collect() == marts.retention(raw, cleaned).collect()
    assert marts.retention_of_raw(raw.filter("false")).collect() == marts.retention(raw.filter("false"), cleaned.filter("false")).collect()
    columns = ["content_type", "rows", "stage"]
    assert sorted(marts.type_mix_of_raw(raw).select(columns).collect()) == sorted(marts.type_mix(raw, cleaned).select(columns).collect())
