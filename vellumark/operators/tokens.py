"""Text documents and their token chain. Every step is row-local."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lexicon import STOP_WORDS
from ..functions.porter2 import stem_tokens
from ..functions.text import (
    MIN_TERM_LENGTH,
    content_tokens,
    document_text,
    filter_tokens,
    has_content,
    normalise_text,
    split_tokens,
)
from ..session import ship_package

DOCUMENT_COLUMNS = ["content_id", "content_type", "country", "title"]


def text_documents(cleaned: DataFrame) -> DataFrame:
    return cleaned.select(
        "content_id",
        "content_type",
        "country",
        F.coalesce("title", F.lit("")).alias("title"),
        document_text(F.col("title"), F.col("listed_in"), F.col("description")).alias("text"),
    )


def normalised_documents(documents: DataFrame) -> DataFrame:
    return documents.withColumn("text", normalise_text(F.col("text")))


def has_tokens(text: Column) -> Column:
    """Whether a text that is not split yet holds any token."""
    return F.lower(text).rlike("[a-z0-9]")


def tokenised_documents(documents: DataFrame) -> DataFrame:
    """Documents as token arrays, without those that hold no token."""
    tokens = split_tokens(normalise_text(F.col("text")))
    return documents.filter(has_tokens(F.col("text"))).select(*DOCUMENT_COLUMNS, tokens.alias("tokens"))


def filtered_documents(tokenised: DataFrame, stop_words: Iterable[str] = STOP_WORDS) -> DataFrame:
    kept = tokenised.withColumn("tokens", filter_tokens(F.col("tokens"), stop_words))
    return kept.filter(F.size("tokens") > 0)


def content_documents(documents: DataFrame, stop_words: Iterable[str] = STOP_WORDS) -> DataFrame:
    """The tokenise and filter steps in one pass over the text."""
    stop = list(stop_words)
    tokens = content_tokens(F.col("text"), stop)
    return documents.filter(has_content(F.col("text"), stop)).select(*DOCUMENT_COLUMNS, tokens.alias("tokens"))


def stemmed_documents(filtered: DataFrame) -> DataFrame:
    """Stem the tokens and drop stems under three letters and emptied documents."""
    ship_package(filtered.sparkSession)
    stemmed = filtered.withColumn("tokens", stem_tokens(F.col("tokens"), MIN_TERM_LENGTH))
    return stemmed.filter(F.size("tokens") > 0)


def analysed_documents(documents: DataFrame, stem: bool = True, stop_words: Iterable[str] = STOP_WORDS) -> DataFrame:
    content = content_documents(documents, stop_words)
    return stemmed_documents(content) if stem else content
