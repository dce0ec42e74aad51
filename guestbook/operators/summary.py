"""Per-entity corpora and extractive summaries."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from guestbook.functions.fixed_values import NO_NEGATIVE, NO_POSITIVE
from guestbook.functions.text import without_reasoning
from guestbook.operators.topk import first_k_per_group
from guestbook.schema import REVIEWS, Columns


def summary_reviews(df: DataFrame, k: int = 50, c: Columns = REVIEWS) -> DataFrame:
    """Per entity the first ``k`` reviews with both texts, by their authors' number of reviews, and their place."""
    both = df.filter((F.col(c.positive_text) != NO_POSITIVE) & (F.col(c.negative_text) != NO_NEGATIVE))
    slim = both.select(c.entity, c.reviewer_reviews, *c.key, c.positive_text, c.negative_text)
    return first_k_per_group(slim, [c.entity], [c.reviewer_reviews, *c.key], k, rank="place")


def corpus(picked: DataFrame, c: Columns = REVIEWS) -> DataFrame:
    """The picked reviews of each entity as one text, in their order. At most k reviews come together."""
    piece = F.concat(F.col(c.positive_text), F.lit(" ; "), F.col(c.negative_text), F.lit(". "))
    pieces = F.array_sort(F.collect_list(F.struct("place", piece.alias("text"))))
    return picked.groupBy(c.entity).agg(
        F.array_join(F.transform(pieces, lambda piece: piece["text"]), "").alias("corpus")
    )


def sentence_weights(picked: DataFrame, c: Columns = REVIEWS) -> DataFrame:
    """Sentences of the picked reviews with their mean TF-IDF weight, a sentence being a document.

    The weight of a sentence is the mean over its words of ln(sentences of the entity / sentences with the
    word). All windows run within the at most k reviews of an entity.
    """
    lines = F.array(
        F.struct(F.lit(1).alias("side"), F.col(c.positive_text).alias("text")),
        F.struct(F.lit(2).alias("side"), F.col(c.negative_text).alias("text")),
    )
    sentences = (
        picked.select(c.entity, "place", F.explode(lines).alias("_line"))
        .select(
            c.entity,
            "place",
            F.col("_line.side").alias("side"),
            F.posexplode(F.regexp_extract_all(F.col("_line.text"), F.lit(r"[^.!?\n]+"), F.lit(0))).alias("at", "_raw"),
        )
        .withColumn("sentence", F.trim("_raw"))
        .withColumn("_words", F.regexp_extract_all(F.lower("sentence"), F.lit(r"\p{L}+"), F.lit(0)))
        .filter(F.size("_words") > 0)
        .withColumn("_sentences", F.count("*").over(Window.partitionBy(c.entity)))
    )
    where = [c.entity, "place", "side", "at"]
    words = sentences.select(
        *where, "sentence", "_sentences", F.size("_words").alias("_length"), F.explode("_words").alias("_word")
    )
    counted = words.groupBy(*where, "_sentences", "_length", "_word").agg(
        F.count("*").alias("_times"), F.any_value("sentence").alias("sentence")
    )
    seen_in = F.count("*").over(Window.partitionBy(c.entity, "_word"))
    return (
        counted.withColumn("_weight", F.col("_times") / F.col("_length") * F.log(F.col("_sentences") / seen_in))
        .groupBy(*where)
        .agg(F.any_value("sentence").alias("sentence"), F.round(F.sum("_weight"), 6).alias("weight"))
    )


def extractive_summary(df: DataFrame, sentences: int = 3, k: int = 50, c: Columns = REVIEWS) -> DataFrame:
    """Per entity the heaviest sentences of its picked reviews, in reading order."""
    weighted = sentence_weights(summary_reviews(df, k, c), c)
    heaviest = first_k_per_group(weighted, [c.entity], [F.desc("weight"), "place", "side", "at"], sentences)
    ordered = F.array_sort(F.collect_list(F.struct("place", "side", "at", "sentence")))
    return heaviest.groupBy(c.entity).agg(
        F.array_join(F.transform(ordered, lambda line: line["sentence"]), ". ").alias("summary")
    )


def model_summary(text: Column, load_model: Callable[[], Callable[[pd.Series], pd.Series]]) -> Column:
    """Summary of a corpus column by a user's own model, its reasoning block removed.

    ``load_model`` runs once per task and returns a function from a batch of corpora to texts.
    """

    @F.pandas_udf("string")
    def summarise(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        answer = load_model()
        for batch in batches:
            yield answer(batch)

    return without_reasoning(summarise(text))
