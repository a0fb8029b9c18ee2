"""Row-local text expressions. None of them shuffles or leaves the JVM."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .lexicon import STOP_WORDS
from .rounding import round_half_up

MIN_TERM_LENGTH = 3
LABEL_MARGIN = 0.03


def document_text(*parts: Column) -> Column:
    """Join the parts by a space, leaving out null and empty ones."""
    return F.concat_ws(" ", *[F.nullif(part, F.lit("")) for part in parts])


def normalise_text(text: Column) -> Column:
    """Lower case with each run outside ``[a-z0-9]`` turned into one space."""
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def split_tokens(normalised: Column) -> Column:
    return F.array_remove(F.split(normalised, " "), "")


def filter_tokens(tokens: Column, stop_words: Iterable[str] = STOP_WORDS) -> Column:
    """Drop short tokens, numbers and stop words; order and repeats stay."""
    stop = list(stop_words)
    return F.filter(
        tokens,
        lambda t: (F.length(t) >= MIN_TERM_LENGTH) & ~t.rlike("^[0-9]+$") & ~t.isin(stop),
    )


def content_tokens(text: Column, stop_words: Iterable[str] = STOP_WORDS) -> Column:
    """Normalise, split and filter in one regular-expression pass over the text.

    Equal to ``filter_tokens(split_tokens(normalise_text(text)))``: the pattern
    takes whole runs of ``[a-z0-9]`` of length 3 or more that hold a letter.
    """
    stop = list(stop_words)
    runs = F.regexp_extract_all(F.lower(text), F.lit("(?=[0-9]*[a-z])[a-z0-9]{3,}"), F.lit(0))
    return F.filter(runs, lambda t: ~t.isin(stop))


def has_content(text: Column, stop_words: Iterable[str] = STOP_WORDS) -> Column:
    """Whether ``content_tokens`` would find any token; stops at the first one.

    A size test on the token array would be pushed below the projection that
    builds it and so build it twice.
    """
    stop = "|".join(stop_words)
    unlisted = f"(?!(?:{stop})(?![a-z0-9]))" if stop else ""
    return F.lower(text).rlike(f"(?<![a-z0-9]){unlisted}(?=[0-9]*[a-z])[a-z0-9]{{3,}}")


def lexicon_hits(tokens: Column, lexicon: Iterable[str]) -> Column:
    words = list(lexicon)
    return F.size(F.filter(tokens, lambda t: t.isin(words))).cast("long")


def sentiment_score(positive: Column, negative: Column, token_count: Column) -> Column:
    share = (positive - negative) / F.nullif(token_count, F.lit(0))
    return F.coalesce(round_half_up(share, 4), F.lit(0.0))


def sentiment_label(score: Column) -> Column:
    return (
        F.when(score > LABEL_MARGIN, "positive")
        .when(score < -LABEL_MARGIN, "negative")
        .otherwise("neutral")
    )


def bigrams(tokens: Column) -> Column:
    """Distinct pairs of neighbouring tokens, joined by a space."""
    followers = F.slice(tokens, F.lit(2), F.greatest(F.size(tokens), F.lit(1)))
    pairs = F.zip_with(tokens, followers, lambda a, b: F.when(b.isNotNull(), F.concat_ws(" ", a, b)))
    return F.array_distinct(F.array_compact(pairs))
