"""Registered queries: a name, the Spark form and, where there is one, the equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Run = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Run] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def register(run: Run) -> Run:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def plain(df: DataFrame) -> DataFrame:
    """Dates as text and arrays as JSON, which keeps their sizes and NULLs, so that results compare the same
    way in any engine."""
    shown = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, T.ArrayType):
            column = F.to_json(column)
        shown.append(column.alias(field.name))
    return df.select(*shown)


def rounded(df: DataFrame, *names: str, places: int = 6) -> DataFrame:
    return df.withColumns({name: F.round(name, places) for name in names})
