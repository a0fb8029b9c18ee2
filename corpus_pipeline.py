"""A training corpus from documents, in five stages.

Each stage takes what its predecessor kept and, but for the last, returns the
columns of documents. Empty tables pass all stages and give no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumark.llm import bpe, classifier, mixing, neardup, suffixes
from vellumark.llm.common import documents, prepare, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on this input, does not reject."""
    labels = prepare(spark).read.parquet(f"{sf_dir}/labels.parquet")
    scored = classifier.scored(docs, classifier.fitted(docs, labels), docs.columns)
    return scored.filter(F.col("score") >= classifier.THRESHOLD).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one with the smallest doc_id."""
    return neardup.first_of_each_class(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the byte strings that an earlier document has; a character cut apart goes whole."""
    cut = suffixes.without_copies(docs, docs.columns, kept="string")
    row = F.col("row").withField("text", F.when(F.col("row.text").isNotNull(), F.col("kept")))
    return cut.select(row.withField("n_chars", F.length("kept").cast("long")).alias("row")).select("row.*")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, checked by decoding them."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoded = bpe.encoded(docs, ranks, public_tokenizers.PATTERN, ["doc_id", "source"])
    return bpe.decoded(encoded, ranks, ["doc_id", "source", "n_tokens"], text=False)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_strings", repeated_strings),
    ("mixture", mixture),
    ("tokens", tokens),
]

# The first stage trains a network, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
