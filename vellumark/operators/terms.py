"""Term statistics, keyword and bigram counts, and TF-IDF.

Terms of one document are counted inside its row, so no shuffle carries token
occurrences. Frequent terms never meet in one task: their document frequency
comes by a broadcast of fixed size, and only the remaining terms are joined
through a shuffle.

The generators are outer ones on purpose: for an inner ``explode`` Spark adds
a size test below it, which would build the token array a second time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rounding import round_half_up
from ..functions.text import bigrams
from ..session import ship_package
from .tokens import DOCUMENT_COLUMNS

# A term is frequent if it has at least one in HOT_TERMS of all term rows. So
# there are at most HOT_TERMS frequent terms, of at most SHORT_TERM characters
# once longer ones stand by their digest: what is broadcast is bounded whatever
# the corpus, and every other term has few rows.
HOT_TERMS = 1_000_000
SHORT_TERM = 64

TERM_FIELDS = [
    T.StructField("term", T.StringType()),
    T.StructField("term_count", T.LongType()),
    T.StructField("first_position", T.IntegerType()),
]


def term_lists(tokens: pa.Array) -> pa.Array:
    """Per list of tokens its distinct terms in the order of their bytes, each with count and first position."""
    lengths = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    encoded = tokens.flatten().dictionary_encode()
    order = pc.sort_indices(encoded.dictionary).to_numpy().astype(np.int64)
    rank = np.empty(len(order) + 1, np.int64)
    rank[order] = np.arange(1, len(order) + 1)
    # A token that is null comes first.
    rank[-1] = 0
    codes = rank[pc.fill_null(encoded.indices, len(order)).to_numpy()]
    owner = np.repeat(np.arange(len(lengths)), lengths)
    keys = owner * (len(order) + 1) + codes
    sequence = np.argsort(keys, kind="stable")
    keys = keys[sequence]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else sequence
    at = sequence[first]
    starts = np.cumsum(lengths) - lengths
    words = encoded.dictionary.take(pa.array(np.where(codes[at] > 0, np.append(0, order)[codes[at]], 0), mask=codes[at] == 0))
    entries = pa.StructArray.from_arrays(
        [words.cast(pa.string()), pa.array(np.diff(np.append(first, len(keys))), pa.int64()), pa.array(at - starts[owner[at]], pa.int32())],
        ["term", "term_count", "first_position"],
    )
    offsets = np.concatenate([[0], np.cumsum(np.bincount(owner[at], minlength=len(lengths)))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), entries, mask=tokens.is_null() if tokens.null_count else None)


def with_term_stats(documents: DataFrame) -> DataFrame:
    """Add ``token_count`` and ``terms``: per distinct term its count and first position.

    Terms are counted in an Arrow step, per batch of bounded size and within each row.
    """
    ship_package(documents.sparkSession)

    def run(batch: pa.Array) -> pa.Array:
        return term_lists(batch)

    # Nondeterministic, so that the step is not run once for each field of the terms.
    counted = F.arrow_udf(run, T.ArrayType(T.StructType(TERM_FIELDS))).asNondeterministic()
    return documents.withColumn("terms", counted(F.col("tokens"))).withColumn("token_count", F.size("tokens").cast("long"))


def keyword_counts(documents: DataFrame) -> DataFrame:
    """Number of documents per (type, term)."""
    return (
        documents.select("content_type", F.explode_outer(F.array_distinct("tokens")).alias("keyword"))
        .filter(F.col("keyword").isNotNull())
        .groupBy("content_type", "keyword")
        .agg(F.count("*").alias("title_mentions"))
    )


def bigram_counts(documents: DataFrame) -> DataFrame:
    """Number of documents per (type, pair of neighbouring terms)."""
    return (
        documents.select("content_type", F.explode_outer(bigrams(F.col("tokens"))).alias("bigram"))
        .filter(F.col("bigram").isNotNull())
        .groupBy("content_type", "bigram")
        .agg(F.count("*").alias("title_mentions"))
    )


def term_frequencies(stats: DataFrame) -> DataFrame:
    """One row per (document, term)."""
    return stats.select(*DOCUMENT_COLUMNS, "token_count", F.explode_outer("terms").alias("entry")).select(
        *DOCUMENT_COLUMNS, "entry.term", "entry.term_count", "token_count"
    )


def document_frequencies(frequencies: DataFrame) -> DataFrame:
    """Number of documents per term, over all types."""
    return frequencies.groupBy("term").agg(F.count("*").alias("document_frequency"))


def _term_key(term: Column) -> Column:
    # No term holds a space, so no term equals another one's key.
    return F.when(F.length(term) > SHORT_TERM, F.concat(F.lit(" "), F.sha2(term, 256))).otherwise(term)


def attach_document_frequency(rows: DataFrame, df: DataFrame, hot_terms: int = HOT_TERMS) -> DataFrame:
    """Inner join on term that does not gather the rows of a frequent term."""
    total = df.agg(F.sum("document_frequency").alias("n")).scalar()
    hot = df.filter(F.col("document_frequency") * hot_terms >= total).select(
        _term_key(F.col("term")).alias("term_key"), "document_frequency"
    )
    marked = rows.withColumn("term_key", _term_key(F.col("term"))).join(F.broadcast(hot), "term_key", "left")
    frequent = marked.filter(F.col("document_frequency").isNotNull())
    rest = marked.filter(F.col("document_frequency").isNull()).drop("document_frequency").join(df, "term")
    return frequent.drop("term_key").unionByName(rest.drop("term_key"))


def tfidf_score(term_count: Column, token_count: Column, document_frequency: Column, documents: Column) -> Column:
    rarity = F.log((documents + 1) / (document_frequency + 1)) + F.lit(1.0)
    return round_half_up(term_count / token_count * rarity, 4)


def _document_total(stats: DataFrame) -> Column:
    return stats.agg(F.count("*").alias("n")).scalar()


def tfidf_records(stats: DataFrame, hot_terms: int = HOT_TERMS) -> DataFrame:
    """One scored row per (document, term)."""
    frequencies = term_frequencies(stats)
    joined = attach_document_frequency(frequencies, document_frequencies(frequencies), hot_terms)
    score = tfidf_score(
        F.col("term_count"), F.col("token_count"), F.col("document_frequency"), _document_total(stats)
    )
    return joined.select(
        *DOCUMENT_COLUMNS, "term", "term_count", "token_count", "document_frequency", score.alias("tfidf_score")
    )


def top_terms(records: DataFrame) -> DataFrame:
    """Highest scored term per document; equal scores go to the smallest term."""
    best = F.min_by(
        F.struct("term", "tfidf_score"), F.struct((-F.col("tfidf_score")).alias("s"), F.col("term").alias("t"))
    )
    return (
        records.select("content_id", "term", "tfidf_score")
        .groupBy("content_id")
        .agg(best.alias("best"))
        .select(
            "content_id",
            F.col("best.term").alias("top_tfidf_term"),
            F.col("best.tfidf_score").alias("top_tfidf_score"),
        )
    )


def tfidf_summary(records: DataFrame) -> DataFrame:
    """Mean and maximum of the rounded scores per (type, term)."""
    # Scores have four decimals: whole ten-thousandths add up without error.
    units = F.floor(F.col("tfidf_score") * 10000 + 0.5)
    return (
        records.groupBy("content_type", "term")
        .agg(
            F.sum(units).alias("units"),
            F.max("tfidf_score").alias("max_tfidf"),
            F.count("*").alias("document_count"),
        )
        .select(
            "content_type",
            "term",
            (F.floor(F.col("units") / F.col("document_count") + 0.5) / 10000.0).alias("avg_tfidf"),
            "max_tfidf",
            "document_count",
        )
    )
