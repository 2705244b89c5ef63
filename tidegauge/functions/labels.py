"""Sentiment score, labels and index value as column functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper bounds and labels of the published classes.
EXTREME_FEAR_SCORE, FEAR_SCORE, NEUTRAL_SCORE, GREED_SCORE = -0.6, -0.1, 0.1, 0.6
# Lexicon of the default scorer: frequent words of the sample texts.
POSITIVE = ("the", "and", "for", "with", "that", "la", "und", "le", "by", "this")
NEGATIVE = ("of", "to", "in", "was", "de", "der", "que", "die", "on", "as")


def word_count(text: Column, words: tuple[str, ...]) -> Column:
    """Occurrences of whole lower-case words, in one pass of the text."""
    return F.regexp_count(text, F.lit(f"(?<![a-z])(?:{'|'.join(words)})(?![a-z])"))


def lexicon_score(text: Column) -> Column:
    """(positive - negative) / (positive + negative) words, 0 without any; in [-1, 1]."""
    lower = F.lower(text)
    good, bad = word_count(lower, POSITIVE), word_count(lower, NEGATIVE)
    return (good - bad) / F.greatest(good + bad, F.lit(1))


Scorer = Callable[[Column], Column]


def sentiment_label(score: Column) -> Column:
    """Five classes; a missing score falls into the last one."""
    return (
        F.when(score <= EXTREME_FEAR_SCORE, "EXTREMELY FEAR")
        .when(score <= FEAR_SCORE, "FEAR")
        .when(score < NEUTRAL_SCORE, "NEUTRAL")
        .when(score < GREED_SCORE, "GREED")
        .otherwise("EXTREMELY GREED")
    )


def index_value(mean_score: Column) -> Column:
    return (mean_score + 1) / 2 * 100


def index_label(value: Column) -> Column:
    return (
        F.when(value <= 24, "EXTREME FEAR")
        .when(value <= 44, "FEAR")
        .when(value <= 55, "NEUTRAL")
        .when(value <= 75, "GREED")
        .otherwise("EXTREME GREED")
    )
