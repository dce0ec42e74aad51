"""Data-quality profiles. Each is one pass over the table, whatever the number of columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from guestbook.schema import REVIEWS, Columns


def _profile(df: DataFrame, columns: list[str], measures: dict) -> DataFrame:
    """One row per column, with the given aggregate measures of it."""
    rows = [
        F.struct(F.lit(name).alias("column_name"), *[make(F.col(name)).alias(label) for label, make in measures.items()])
        for name in columns
    ]
    return df.agg(F.array(*rows).alias("_rows")).select(F.inline("_rows"))


def blank_counts(df: DataFrame) -> DataFrame:
    """Per text column, the number of rows that are NULL or a single space."""
    texts = [field.name for field in df.schema.fields if isinstance(field.dataType, T.StringType)]
    return _profile(df, texts, {"blank_count": lambda x: F.count_if(x.isNull() | (x == " "))})


def presence_counts(df: DataFrame) -> DataFrame:
    """Per column, the number of values and of missing values."""

    def missing(x: Column) -> Column:
        return F.count("*") - F.count(x)

    return _profile(df, df.columns, {"non_null_count": F.count, "missing_count": missing})


def null_counts(df: DataFrame) -> DataFrame:
    return _profile(df, df.columns, {"null_count": lambda x: F.count_if(x.isNull())})


def out_of_range_coordinates(df: DataFrame, c: Columns = REVIEWS) -> DataFrame:
    return df.filter(~F.col(c.lat).between(-90, 90) | ~F.col(c.lng).between(-180, 180))
