"""Tags: their influence on scores, their frequency and share, and the entities that carry them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guestbook.functions.parsing import in_city
from guestbook.operators.prepare import reviews_in_city
from guestbook.schema import REVIEWS, Columns


def _tag_scores(df: DataFrame, min_count: int, c: Columns) -> DataFrame:
    return (
        df.select(c.score, F.explode(c.tags).alias("tag"))
        .groupBy("tag")
        .agg(F.avg(c.score).alias("avg_score"), F.count("*").alias("tag_count"))
        .filter(F.col("tag_count") >= min_count)
    )


def tag_influence(df: DataFrame, min_count: int = 1000, c: Columns = REVIEWS) -> DataFrame:
    return _tag_scores(df, min_count, c).orderBy(F.desc("avg_score"), "tag")


def best_tags(df: DataFrame, n: int = 10, min_count: int = 1000, c: Columns = REVIEWS) -> DataFrame:
    return tag_influence(df, min_count, c).limit(n)


def worst_tags(df: DataFrame, n: int = 10, min_count: int = 1000, c: Columns = REVIEWS) -> DataFrame:
    return _tag_scores(df, min_count, c).orderBy("avg_score", "tag").limit(n)


def _tag_counts(df: DataFrame, c: Columns) -> DataFrame:
    return df.select(F.explode(c.tags).alias("tag")).groupBy("tag").agg(F.count("*").alias("count"))


def most_used_tags(df: DataFrame, c: Columns = REVIEWS) -> DataFrame:
    return _tag_counts(df, c).orderBy(F.desc("count"), "tag").select("tag")


def tag_share(df: DataFrame, city: str, n: int = 10, c: Columns = REVIEWS) -> DataFrame:
    """The n most frequent tags of a city and one row ``Other`` for the rest, if there is a rest.

    Only the n leaders (bounded by n) are broadcast; the rest is summed where it lies.
    """
    counts = _tag_counts(reviews_in_city(df, city, c), c)
    leaders = counts.orderBy(F.desc("count"), "tag").limit(n)
    names = F.broadcast(leaders.select(F.col("tag").alias("_leader")))
    rest = (
        counts.join(names, F.col("tag").eqNullSafe(F.col("_leader")), "left_anti")
        .agg(F.sum("count").alias("count"))
        .filter(F.col("count") > 0)
        .select(F.lit("Other").alias("tag"), "count")
    )
    return leaders.unionByName(rest)


def entities_with_tag(df: DataFrame, city: str, tag: str, c: Columns = REVIEWS) -> DataFrame:
    """Entities of a city with reviews under a tag, by mean score of those reviews."""
    return (
        df.filter(in_city(F.col(c.address), city) & F.array_contains(c.tags, tag))
        .groupBy(c.entity, c.address)
        .agg(F.avg(c.score).alias("avg_score"))
        .orderBy(F.desc("avg_score"), c.entity, c.address)
    )
