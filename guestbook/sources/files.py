"""Review and point-of-interest files, and the word-score export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from guestbook.functions.fixed_values import POINTS_OF_INTEREST
from guestbook.operators.prepare import typed_reviews
from guestbook.schema import POI, REVIEW_RAW


def read_review_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw reviews, every field as text. A header that differs from the schema is an error, not a shift."""
    return spark.read.schema(REVIEW_RAW).option("header", True).option("enforceSchema", False).csv(path)


def read_poi_csv(spark: SparkSession, path: str) -> DataFrame:
    """Points of interest. A header that differs from the schema is an error here too."""
    return spark.read.schema(POI).option("header", True).option("enforceSchema", False).option("sep", ";").csv(path)


def points_of_interest(spark: SparkSession) -> DataFrame:
    """The built-in points of interest."""
    return spark.createDataFrame(list(POINTS_OF_INTEREST), POI)


def land_reviews(spark: SparkSession, csv_path: str, parquet_path: str) -> DataFrame:
    """Type the raw file and store it once as Parquet, each review with a ``review_id``.

    The ids are handed out while the file is scanned, before any shuffle, and are data from then on, so a
    lost task gives the same ids again. They depend on how the file is split: landing it again with another
    split size gives other ids, and ties that only the id breaks may then fall otherwise. Queries on the
    stored table prune columns and push filters.
    """
    typed = typed_reviews(read_review_csv(spark, csv_path))
    typed.withColumn("review_id", F.monotonically_increasing_id()).write.parquet(parquet_path)
    return spark.read.parquet(parquet_path)


def export_word_scores(scores: DataFrame, path: str) -> None:
    """Write a word table with its ``polarity`` as CSV, one folder per polarity."""
    scores.write.partitionBy("polarity").option("header", True).csv(path)
