"""Calendar buckets, sentiment scores and labels."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from guestbook.functions import fixed_values as fv
from guestbook.functions.text import SPACE


def season(date: Column) -> Column:
    month = F.month(date)
    return (
        F.when(month.isin(12, 1, 2), "Winter")
        .when(month.isin(3, 4, 5), "Spring")
        .when(month.isin(6, 7, 8), "Summer")
        .when(month.isin(9, 10, 11), "Autumn")
    )


def year_month(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def compound(total: Column) -> Column:
    """Sum of word valences squeezed into (-1, 1)."""
    return total / F.sqrt(total * total + fv.COMPOUND_ALPHA)


def compound_class(score: Column) -> Column:
    return F.when(score >= fv.COMPOUND_CUTOFF, 1).when(score <= -fv.COMPOUND_CUTOFF, -1).otherwise(0)


def has_strong_word(text: Column, strong_words: Sequence[str] = fv.STRONG_WORDS) -> Column:
    """Whether one of the words stands in the text as a whole whitespace-separated piece."""
    either = "|".join(re.escape(word) for word in strong_words)
    # The words come first: a text is searched for their first letters, and what surrounds one is looked at then.
    return text.rlike(f"(?U)(?:{either})(?![^{SPACE}])(?<=(?:^|[{SPACE}])(?:{either}))")


def review_class(
    positive_strong: Column,
    negative_strong: Column,
    positive_length: Column,
    negative_length: Column,
    positive_class: Column,
    negative_class: Column,
) -> Column:
    """Class -1/0/1 of a review from its two texts.

    A strong word in one text only decides; then the only text that is not empty; otherwise the mean of
    the two classes weighted by text length, an empty text counting as length 1.
    """
    positive_weight = F.greatest(positive_length, F.lit(1))
    negative_weight = F.greatest(negative_length, F.lit(1))
    total = positive_weight + negative_weight
    mixed = positive_class * (positive_weight / total) + negative_class * (negative_weight / total)
    return (
        F.when(negative_strong & ~positive_strong, -1)
        .when(positive_strong & ~negative_strong, 1)
        .when((positive_length > 0) & (negative_length == 0), positive_class)
        .when((negative_length > 0) & (positive_length == 0), negative_class)
        .when(mixed > fv.REVIEW_CUTOFF, 1)
        .when(mixed < -fv.REVIEW_CUTOFF, -1)
        .otherwise(0)
    )


def class_name(value: Column) -> Column:
    return F.when(value > 0, "positive").when(value < 0, "negative").otherwise("neutral")


def entity_label(mean_class: Column) -> Column:
    """Label of the mean review class. Means in (-0.4, -0.3] are neutral, as in the original rule."""
    return (
        F.when(mean_class.isNull(), fv.NO_REVIEWS)
        .when((mean_class > 0.2) & (mean_class < 0.4), fv.FAIRLY_POSITIVE)
        .when(mean_class >= 0.4, fv.VERY_POSITIVE)
        .when((mean_class < -0.2) & (mean_class > -0.3), fv.FAIRLY_NEGATIVE)
        .when(mean_class <= -0.4, fv.VERY_NEGATIVE)
        .otherwise(fv.NEUTRAL)
    )


def year_label(mean_sentiment: Column) -> Column:
    return (
        F.when(mean_sentiment >= fv.YEAR_POSITIVE_FROM, fv.YEAR_POSITIVE)
        .when(mean_sentiment < 0, fv.YEAR_NEGATIVE)
        .otherwise(fv.NEUTRAL)
    )


def trend_label(difference: Column) -> Column:
    return F.when(F.round(difference, 5) > 0, fv.IMPROVING).otherwise(fv.WORSENING)
