"""Scores by entity, length, month and nationality; reputation and anomalies."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from guestbook.functions.fixed_values import POSITIVE_SCORE
from guestbook.functions.labels import trend_label, year_month
from guestbook.operators.joins import BROADCAST_BYTES, join_lookup
from guestbook.operators.topk import first_k_per_group
from guestbook.schema import REVIEWS, Columns
from guestbook.shared import settled


def review_length(df: DataFrame, c: Columns = REVIEWS) -> DataFrame:
    """Mean number of positive and negative words per score, over reviews that have any."""
    return (
        df.filter((F.col(c.positive_words) > 0) | (F.col(c.negative_words) > 0))
        .groupBy(c.score)
        .agg(F.avg(c.positive_words).alias("avg_positive_length"), F.avg(c.negative_words).alias("avg_negative_length"))
        .orderBy(c.score)
    )


def of_entity(df: DataFrame, entity: str, c: Columns = REVIEWS) -> DataFrame:
    return df.filter(F.col(c.entity) == entity)


def reputation(df: DataFrame, recent_reviews: int = 30, c: Columns = REVIEWS) -> DataFrame:
    """Per entity, mean score of all reviews and of the newest ones, and their difference.

    The overall mean and the newest rows are computed apart: both shrink before their shuffle, whereas one
    window over the history would bring every review of an entity into one task.
    """
    slim = df.select(c.entity, c.score, c.date, *c.key)
    historical = slim.groupBy(c.entity).agg(F.avg(c.score).alias("avg_historical_score"))
    newest = first_k_per_group(slim, [c.entity], [F.desc(c.date), *c.key], recent_reviews)
    recent = newest.groupBy(F.col(c.entity).alias("_entity")).agg(F.avg(c.score).alias("avg_recent_score"))
    return historical.join(recent, F.col(c.entity).eqNullSafe(F.col("_entity"))).select(
        c.entity,
        "avg_historical_score",
        "avg_recent_score",
        (F.col("avg_recent_score") - F.col("avg_historical_score")).alias("score_difference"),
    )


def entity_reputation(df: DataFrame, entity: str, recent_reviews: int = 30, c: Columns = REVIEWS) -> DataFrame:
    """Reputation of one entity; no row when it has no reviews."""
    return reputation(of_entity(df, entity, c), recent_reviews, c)


def moving_reputation(df: DataFrame, recent_reviews: int = 30, c: Columns = REVIEWS) -> DataFrame:
    """For every review, the mean score of the newest ``recent_reviews`` of its entity up to that review.

    Rows are sorted by entity and age over all partitions, so that an entity with much of the table fills as many
    partitions as its rows need. The frame of a partition's last rows reaches into the partitions after it: their
    first rows are handed back to it (the halo), and a window over one partition's part of an entity sees all it needs.
    Where a partition's rows begin is known from one count for each.
    """
    halo, order = recent_reviews - 1, [F.desc(c.date), *[F.col(name) for name in c.key]]
    columns = list(dict.fromkeys([c.entity, c.date, c.score, *c.key]))
    placed = df.select(*columns).repartitionByRange(F.col(c.entity), *order).sortWithinPartitions(F.col(c.entity), *order)
    at = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    placed = settled(placed.withColumns({"_part": F.spark_partition_id(), "_at": at}), "by-age")
    sizes = sorted((row["_part"], row["n"]) for row in placed.groupBy("_part").agg(F.count("*").alias("n")).collect())
    handed = []
    for k, (part, _) in enumerate(sizes):
        left = halo
        for later, n in sizes[k + 1 :]:
            if left <= 0:
                break
            handed.append((later, part, left))
            left -= n
    halos = df.sparkSession.createDataFrame(handed, "_part int, _to int, _rows int")
    heads = placed.filter(F.col("_at") < halo).join(F.broadcast(halos), "_part").filter("_at < _rows")
    heads = heads.select(*columns, F.col("_to").alias("_part"), F.lit(True).alias("_lent"))
    frame = Window.partitionBy("_part", c.entity).orderBy(*order).rowsBetween(0, halo)
    both = placed.select(*columns, "_part", F.lit(False).alias("_lent")).unionByName(heads)
    moving = both.withColumn("avg_recent_score", F.avg(c.score).over(frame))
    return moving.filter(~F.col("_lent")).select(*columns, "avg_recent_score")


def with_trend(reputations: DataFrame) -> DataFrame:
    """Add the direction; a difference that rounds to 0 counts as worsening."""
    return reputations.withColumn("trend", trend_label(F.col("score_difference")))


def anomalies(df: DataFrame, c: Columns = REVIEWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Reviews more than two sample standard deviations from the mean score of their entity.

    Means and deviations are one row per entity. Where they fit a broadcast, the reviews and their texts
    are not shuffled at all. An entity with one review has no deviation and no anomaly.
    """
    stats = df.groupBy(c.entity).agg(F.avg(c.score).alias("Avg_Score"), F.stddev_samp(c.score).alias("_deviation"))
    joined = join_lookup(df, stats, c.entity, costly=True, max_bytes=max_bytes)
    return joined.filter(F.abs(F.col(c.score) - F.col("Avg_Score")) > 2 * F.col("_deviation")).drop("_deviation")


def entity_anomalies(df: DataFrame, entity: str, c: Columns = REVIEWS) -> DataFrame:
    """Anomalies of one entity, lowest score first. Mean and deviation are one scalar pair; nothing is joined."""
    own = of_entity(df, entity, c)
    stats = own.agg(F.struct(F.avg(c.score).alias("mean"), F.stddev_samp(c.score).alias("deviation"))).scalar()
    return (
        own.withColumn("_stats", stats)
        .withColumn("Avg_Score", F.col("_stats.mean"))
        .filter(F.abs(F.col(c.score) - F.col("Avg_Score")) > 2 * F.col("_stats.deviation"))
        .orderBy(c.score, *c.key)
        .select(c.score, "Avg_Score", c.positive_text, c.negative_text)
    )


def monthly_trend(df: DataFrame, c: Columns = REVIEWS) -> DataFrame:
    """Mean score per entity and month of any review table: one entity, nearby ones or all."""
    return (
        df.groupBy(c.entity, year_month(F.col(c.date)).alias("YearMonth"))
        .agg(F.avg(c.score).alias("Average_Score"))
        .orderBy(c.entity, "YearMonth")
    )


def entity_statistics(df: DataFrame, c: Columns = REVIEWS) -> DataFrame:
    """Review counts, extremes and mean of the score, and a position, per entity.

    A review without a score counts in the total only.
    """
    score = F.col(c.score)
    return df.groupBy(c.entity).agg(
        F.count("*").alias("Total_Reviews"),
        F.count_if(score >= POSITIVE_SCORE).alias("Total_Positive_Reviews"),
        F.count_if(score < POSITIVE_SCORE).alias("Total_Negative_Reviews"),
        F.max(score).alias("Max_Reviewer_Score"),
        F.min(score).alias("Min_Reviewer_Score"),
        F.avg(score).alias("Avg_Reviewer_Score"),
        F.min(c.lat).alias("Latitude"),
        F.min(c.lng).alias("Longitude"),
    )


def nationality_counts(df: DataFrame, min_reviews: int = 1, c: Columns = REVIEWS) -> DataFrame:
    return (
        df.groupBy(c.nationality).agg(F.count("*").alias("review_count")).filter(F.col("review_count") >= min_reviews)
    )


def nationality_reviews(df: DataFrame, nationality: str, c: Columns = REVIEWS) -> DataFrame:
    return df.filter(F.col(c.nationality) == nationality).select(
        c.entity,
        c.date,
        c.nationality,
        c.score,
        c.negative_text,
        c.negative_words,
        c.positive_text,
        c.positive_words,
        c.tags,
    )


def entity_locations(df: DataFrame, c: Columns = REVIEWS) -> DataFrame:
    return df.select(c.entity, c.address, c.lat, c.lng).distinct()
