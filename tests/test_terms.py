import math
import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import token_documents
from vellumark.operators import features, sentiment, terms

WORDS = [f"w{i:02d}" for i in range(30)]


def corpus():
    random.seed(7)
    # The first word is in every document, the last ones are rare.
    weights = [30] + [1 + 29 // (i + 1) for i in range(1, 30)]
    return {
        f"d{i:02d}": (random.choice(["Movie", "TV Show"]), ["w00"] + random.choices(WORDS, weights, k=random.randint(0, 25)))
        for i in range(40)
    }


def half_up(value, digits):
    return math.floor(value * 10**digits + 0.5) / 10**digits


def expected_scores(documents):
    df = Counter(t for _, tokens in documents.values() for t in set(tokens))
    scores = {}
    for key, (kind, tokens) in documents.items():
        for term, n in Counter(tokens).items():
            value = n / len(tokens) * (math.log((len(documents) + 1) / (df[term] + 1)) + 1)
            scores[key, term] = (kind, n, len(tokens), df[term], half_up(value, 4))
    return scores


@pytest.fixture(scope="module")
def stats(spark):
    documents = token_documents(spark, corpus())
    return terms.with_term_stats(sentiment.with_sentiment(documents, ["w01"], ["w02"]))


def test_term_stats(stats):
    for row in stats.collect():
        tokens = row["tokens"]
        expected = [(t, n, tokens.index(t)) for t, n in sorted(Counter(tokens).items())]
        assert [tuple(entry) for entry in row["terms"]] == expected
        assert row["token_count"] == len(tokens)


def test_keywords_and_bigrams(stats):
    keywords, pairs = Counter(), Counter()
    for kind, tokens in corpus().values():
        keywords.update((kind, t) for t in set(tokens))
        pairs.update((kind, f"{a} {b}") for a, b in set(zip(tokens, tokens[1:])))
    assert {tuple(r[:2]): r[2] for r in terms.keyword_counts(stats).collect()} == keywords
    assert {tuple(r[:2]): r[2] for r in terms.bigram_counts(stats).collect()} == pairs


@pytest.mark.parametrize("hot_terms", [1, 8, 30, 10**6])
def test_tfidf(stats, hot_terms):
    rows = terms.tfidf_records(stats, hot_terms).collect()
    found = {
        (r["content_id"], r["term"]): (
            r["content_type"], r["term_count"], r["token_count"], r["document_frequency"], r["tfidf_score"]
        )
        for r in rows
    }
    assert len(found) == len(rows)
    assert found == expected_scores(corpus())


def test_long_terms(spark):
    long = ["a" * 200, "a" * 199 + "b"]
    documents = token_documents(spark, {"1": ("M", [*long, "x"]), "2": ("M", long[:1])})
    records = terms.tfidf_records(terms.with_term_stats(documents))
    found = {(r["content_id"], r["term"]): r["document_frequency"] for r in records.collect()}
    assert found == {("1", long[0]): 2, ("2", long[0]): 2, ("1", long[1]): 1, ("1", "x"): 1}


def test_top_terms_and_summary(stats):
    records = terms.tfidf_records(stats, 2)
    scores = expected_scores(corpus())
    best = {}
    for (key, term), value in scores.items():
        best[key] = min(best.get(key, (1, "")), (-value[4], term))
    assert {r[0]: (-r[2], r[1]) for r in terms.top_terms(records).collect()} == best

    groups = {}
    for (_, term), value in scores.items():
        groups.setdefault((value[0], term), []).append(value[4])
    summary = {tuple(r[:2]): tuple(r[2:]) for r in terms.tfidf_summary(records).collect()}
    assert summary.keys() == groups.keys()
    for key, values in groups.items():
        mean, highest, count = summary[key]
        assert mean == pytest.approx(sum(values) / len(values), abs=0.000051)
        assert (highest, count) == (max(values), len(values))
    assert len(summary) == terms.keyword_counts(stats).count()


def test_profile(stats):
    profile = {r["content_id"]: r for r in features.document_profile(stats).collect()}
    for key, (_, tokens) in corpus().items():
        counter = Counter(tokens)
        row = profile[key]
        assert row["dominant_term"] == counter.most_common(1)[0][0]
        assert row["term_preview"] == ", ".join(t for t, _ in counter.most_common(5))
        assert (row["token_count"], row["unique_token_count"]) == (len(tokens), len(counter))
        assert row["avg_token_length"] == 3.0
        assert row["positive_hits"] == counter["w01"] and row["negative_hits"] == counter["w02"]


def test_features_without_top_term(spark, stats):
    top = terms.top_terms(terms.tfidf_records(stats)).filter("content_id <> 'd03'")
    rows = {r["content_id"]: r for r in features.text_features(stats, top).collect()}
    assert len(rows) == 40 and rows["d03"]["top_tfidf_term"] is None and rows["d04"]["top_tfidf_score"] > 0


def test_no_documents(spark):
    empty = terms.with_term_stats(sentiment.with_sentiment(token_documents(spark, {"x": ("M", ["a"])}).filter("false")))
    assert terms.tfidf_records(empty).count() == 0
    assert terms.keyword_counts(empty).count() == 0
    assert features.text_features(empty, terms.top_terms(terms.tfidf_records(empty))).count() == 0


@pytest.mark.parametrize(
    "tokens, score, label",
    [
        (["good"] * 1 + ["x"] * 9, 0.1, "positive"),
        (["bad"] * 3 + ["good"] + ["x"] * 6, -0.2, "negative"),
        (["good"] * 3 + ["x"] * 97, 0.03, "neutral"),
        ([], 0.0, "neutral"),
    ],
)
def test_sentiment(spark, tokens, score, label):
    row = sentiment.with_sentiment(token_documents(spark, {"1": ("M", tokens)}), ["good"], ["bad"]).first()
    assert (row["sentiment_score"], row["sentiment_label"]) == (score, label)


def test_label_counts(spark):
    scored = sentiment.with_sentiment(token_documents(spark, {"1": ("M", ["joy"]), "2": ("M", ["sun"])}))
    assert sentiment.label_counts(scored).first().asDict() == {
        "positive_document_count": 1, "neutral_document_count": 1, "negative_document_count": 0,
    }


def test_a_term_that_looks_like_the_key_of_another(spark):
    import hashlib

    long = "a" * 70
    digest = hashlib.sha256(long.encode()).hexdigest()
    documents = token_documents(spark, {"1": ("x", [long, digest]), "2": ("x", [long, "b"])})
    rows = terms.attach_document_frequency(
        documents.select("content_id", F.explode("tokens").alias("term")),
        documents.select(F.explode("tokens").alias("term")).groupBy("term").agg(F.count("*").alias("document_frequency")),
    )
    assert sorted((r.content_id, r.term[:1], r.document_frequency) for r in rows.collect()) == sorted(
        [("1", "a", 2), ("1", digest[:1], 1), ("2", "a", 2), ("2", "b", 1)]
    )


def test_terms_of_lists_are_counted_in_one_arrow_step():
    lists = [["b", "a", "b"], None, [], ["é", "z", None, "z", "a"]]
    found = terms.term_lists(pa.array([["x"], *lists], pa.list_(pa.string())).slice(1)).to_pylist()
    plain = [[(e["term"], e["term_count"], e["first_position"]) for e in row] if row is not None else None for row in found]
    assert plain == [[("a", 1, 1), ("b", 2, 0)], None, [], [(None, 1, 2), ("a", 1, 4), ("z", 2, 1), ("é", 1, 0)]]
    assert terms.term_lists(pa.array([], pa.list_(pa.string()))).to_pylist() == []
