import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import token_documents
from vellumark.functions import text
from vellumark.functions.lexicon import NEGATIVE_TERMS, POSITIVE_TERMS, STOP_WORDS
from vellumark.operators import tokens
from vellumark.operators.clean import clean_catalogue


def expected_tokens(value):
    found = re.findall("[a-z0-9]+", value.lower())
    return [t for t in found if len(t) >= 3 and not t.isdigit() and t not in STOP_WORDS]


def test_word_lists():
    assert (len(STOP_WORDS), len(POSITIVE_TERMS), len(NEGATIVE_TERMS)) == (59, 30, 26)
    for words in (STOP_WORDS, POSITIVE_TERMS, NEGATIVE_TERMS):
        assert len(set(words)) == len(words)


def test_document_text(raw):
    rows = {r["content_id"]: r for r in tokens.text_documents(clean_catalogue(raw)).collect()}
    assert rows["b3"]["text"] == "A quiet harbour keeps an old secret." and rows["b3"]["title"] == ""
    assert rows["b6"]["text"] == "?!"
    assert rows["b8"]["text"] == "of to in 12345 the with"


def test_normalise_and_split(spark):
    df = spark.createDataFrame([("Hello, World! 123",), ("too   many\n\tgaps ",), ("",), ("Café-Noir",)], "text string")
    normal = text.normalise_text(F.col("text"))
    rows = df.select(normal.alias("n"), text.split_tokens(normal).alias("t")).collect()
    assert [r["n"] for r in rows] == ["hello world 123", "too many gaps", "", "caf noir"]
    assert [r["t"] for r in rows] == [["hello", "world", "123"], ["too", "many", "gaps"], [], ["caf", "noir"]]


def test_empty_documents_are_dropped(raw):
    documents = tokens.text_documents(clean_catalogue(raw))
    tokenised = tokens.tokenised_documents(documents)
    kept = {r["content_id"] for r in tokenised.collect()}
    assert "b6" not in kept and "b8" in kept
    filtered = {r["content_id"]: r["tokens"] for r in tokens.filtered_documents(tokenised).collect()}
    assert "b8" not in filtered
    assert filtered["b5"] == expected_tokens("Été à Paris Dramas Crème brûlée, naïve café 24 12 007 x9 the and")
    fused = {r["content_id"]: r["tokens"] for r in tokens.content_documents(documents).collect()}
    assert fused == filtered


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aAbz019 éİK-\n the", max_size=60), min_size=1, max_size=60))
def test_one_pass_tokens_equal_the_steps(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "text string")
    steps = text.filter_tokens(text.split_tokens(text.normalise_text(F.col("text"))))
    rows = df.select(
        "text",
        steps.alias("steps"),
        text.content_tokens(F.col("text")).alias("fused"),
        text.has_content(F.col("text")).alias("any"),
    ).collect()
    for row in rows:
        assert row["steps"] == row["fused"] == expected_tokens(row["text"])
        assert row["any"] == bool(row["fused"])


def test_bigrams(spark):
    df = token_documents(
        spark, {"1": ("M", ["b", "a", "b", "a"]), "2": ("M", ["x"]), "3": ("M", [])}
    ).select("content_id", text.bigrams(F.col("tokens")).alias("pairs"))
    assert {r["content_id"]: r["pairs"] for r in df.collect()} == {"1": ["b a", "a b"], "2": [], "3": []}


def test_ties_of_both_signs_round_alike(spark):
    from pyspark.sql import functions as F

    from vellumark.functions.rounding import round_half_up

    row = spark.sql("SELECT 601 / 20000D AS x, -601 / 20000D AS y, -0.00001D AS z").select(
        *(round_half_up(F.col(c), 4).alias(c) for c in "xyz")
    ).first()
    assert (row.x, row.y) == (0.0301, -0.0301) and str(row.z) == "0.0"
