"""Schemas of the inputs and the binding of operators to column names."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The raw review file, in file order. Every field is read as text and typed afterwards,
# which saves the extra pass of schema inference and turns malformed fields into NULL instead of errors.
REVIEW_COLUMNS = (
    "Hotel_Address",
    "Additional_Number_of_Scoring",
    "Review_Date",
    "Average_Score",
    "Hotel_Name",
    "Reviewer_Nationality",
    "Negative_Review",
    "Review_Total_Negative_Word_Counts",
    "Total_Number_of_Reviews",
    "Positive_Review",
    "Review_Total_Positive_Word_Counts",
    "Total_Number_of_Reviews_Reviewer_Has_Given",
    "Reviewer_Score",
    "Tags",
    "days_since_review",
    "lat",
    "lng",
)

INT_COLUMNS = (
    "Additional_Number_of_Scoring",
    "Review_Total_Negative_Word_Counts",
    "Total_Number_of_Reviews",
    "Review_Total_Positive_Word_Counts",
    "Total_Number_of_Reviews_Reviewer_Has_Given",
)

DOUBLE_COLUMNS = ("Average_Score", "Reviewer_Score", "lat", "lng")

REVIEW_RAW = T.StructType([T.StructField(name, T.StringType()) for name in REVIEW_COLUMNS])

POI = T.StructType(
    [
        T.StructField("Monument", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("long", T.DoubleType()),
        T.StructField("City", T.StringType()),
    ]
)


@dataclass(frozen=True)
class Columns:
    """Names of the review columns an operator reads.

    ``key`` identifies one review inside its entity. It breaks ties wherever "the newest" or "the
    first" rows are asked for, and is what token sums are grouped back on.
    """

    entity: str = "Hotel_Name"
    address: str = "Hotel_Address"
    score: str = "Reviewer_Score"
    date: str = "Review_Date"
    positive_text: str = "Positive_Review"
    negative_text: str = "Negative_Review"
    positive_words: str = "Review_Total_Positive_Word_Counts"
    negative_words: str = "Review_Total_Negative_Word_Counts"
    tags: str = "Tags"
    nationality: str = "Reviewer_Nationality"
    reviewer_reviews: str = "Total_Number_of_Reviews_Reviewer_Has_Given"
    lat: str = "lat"
    lng: str = "lng"
    key: tuple[str, ...] = ("review_id",)


REVIEWS = Columns()
