import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array

from tests.conftest import token_documents
from vellumark.operators import sentiment, terms, topics


@pytest.fixture(scope="module")
def stats(spark):
    groups = [["sea", "ship", "sail", "wave"], ["code", "byte", "loop", "data"]]
    random = np.random.RandomState(3)
    documents = {
        f"d{i:03d}": ("Movie", list(random.choice(groups[i % 2], size=12))) for i in range(80)
    }
    documents["rare"] = ("Movie", ["unseen"])
    return terms.with_term_stats(sentiment.with_sentiment(token_documents(spark, documents))).cache()


def test_embeddings(stats):
    embedded = topics.embed_documents(stats, vector_size=8)
    rows = {
        r[0]: np.array(r[1])
        for r in embedded.select("content_id", vector_to_array("normalized_embedding")).collect()
    }
    assert np.allclose([np.linalg.norm(v) for k, v in rows.items() if k != "rare"], 1.0)
    # Its only word is below the minimum count.
    assert not rows["rare"].any()


def test_topics_cover_all_documents(stats):
    clustered = topics.assign_topics(topics.embed_documents(stats, vector_size=8), topics=3)
    table = topics.topic_table(
        clustered,
        stats.selectExpr(
            "content_id", "'x' dominant_term", "'x' top_tfidf_term", "1.0D top_tfidf_score", "sentiment_label",
            "sentiment_score",
        ),
    )
    assert table.count() == 81
    assert topics.cluster_count(table).first()[0] <= 3
    assert {r[0] for r in table.select("topic_cluster").distinct().collect()} <= {0, 1, 2}


def test_training_does_not_depend_on_the_storage(stats):
    def run(rows):
        clustered = topics.assign_topics(topics.embed_documents(rows, vector_size=8, partitions=1), topics=3)
        return sorted((r[0], r[1], tuple(r[2])) for r in clustered.select(
            "content_id", "topic_cluster", vector_to_array("embedding")
        ).collect())

    first = run(stats.repartition(1))
    for again in (run(stats.repartition(1)), run(stats.repartition(5, "title"))):
        assert [r[:2] for r in again] == [r[:2] for r in first]
        assert np.allclose([r[2] for r in again], [r[2] for r in first], atol=1e-5)


def test_unit_vectors(spark):
    df = spark.createDataFrame([("a", [3.0, 4.0]), ("b", [0.0, 0.0])], "content_id string, v array<double>")
    assert {r[0]: r[1] for r in topics.unit_vectors(df, "v").collect()} == {"a": [0.6, 0.8], "b": [0.0, 0.0]}
