"""Joins of a large table with a lookup table.

A lookup is broadcast only after its size has been measured. A larger one is joined by a sort-merge join,
which its hint makes certain, where adaptive execution splits the partitions of hot keys
(``spark.sql.adaptive.skewJoin.enabled``).
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from guestbook.shared import settled

BROADCAST_BYTES = 32 * 1024 * 1024
INLINE_BYTES = 2 * 1024 * 1024
ROW_OVERHEAD = 32
NESTED = (T.ArrayType, T.MapType, T.StructType)


def measured_bytes(df: DataFrame) -> int:
    """Size of a table as rows: text and binary by their length, nested values by the length of their JSON,
    anything else by 16 bytes, and an overhead per row."""
    size = F.lit(ROW_OVERHEAD).cast("long")
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, NESTED):
            column = F.to_json(F.struct(column))
        if isinstance(field.dataType, (T.StringType, T.BinaryType, *NESTED)):
            size = size + F.coalesce(F.octet_length(column), F.lit(0)) + 16
        else:
            size = size + 16
    return df.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]


def _spread_without_key(df: DataFrame, on: list[str]) -> Column:
    """0 for rows with a key; a number from the row's own values for rows without, which match nothing and
    would otherwise all meet in one partition."""
    own = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    lacks_key = F.lit(False)
    for name in on:
        lacks_key = lacks_key | F.col(f"`{name}`").isNull()
    return F.when(lacks_key, F.pmod(F.xxhash64(*own), F.lit(65_521)) + 1).otherwise(F.lit(0).cast("long"))


def join_lookup(
    df: DataFrame,
    lookup: DataFrame,
    on: str | list[str],
    how: str = "inner",
    costly: bool = False,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join ``df`` with ``lookup`` on equal columns; ``how`` is inner, left or left_semi.

    ``costly`` says that the lookup is itself computed from a large table: it is then written once, so that
    measuring it does not compute it twice.
    """
    on = [on] if isinstance(on, str) else on
    if costly:
        lookup = settled(lookup, "lookup")
    if measured_bytes(lookup) <= max_bytes:
        return df.join(F.broadcast(lookup), on, how)
    if how == "left":
        df, lookup = df.withColumn("_without", _spread_without_key(df, on)), lookup.withColumn("_without", F.lit(0).cast("long"))
        return df.join(lookup.hint("merge"), [*on, "_without"], how).drop("_without")
    return df.join(lookup.hint("merge"), on, how)


def inline_lookup(lookup: DataFrame, key: str, value: str, max_bytes: int = BROADCAST_BYTES) -> Callable[[Column], Column] | None:
    """A function from a column of texts to what ``lookup`` has for them, or NULL, for use inside arrays, whose rows
    then neither grow in number nor move. None where the lookup is over ``INLINE_BYTES`` or ``max_bytes``, has a key
    twice or a very long one.

    The table stands in the plan, as an array of small maps that a text's hash leads to.
    """
    listed = lookup.filter(F.col(key).isNotNull() & F.col(value).isNotNull()).select(F.col(key).alias("key"), F.col(value).alias("value"))
    if measured_bytes(listed) > min(max_bytes, INLINE_BYTES):
        return None
    found = listed.select("key", "value", F.xxhash64("key").alias("hash")).collect()
    if len({row.key for row in found}) < len(found) or max((len(row.key) for row in found), default=0) > 10_000:
        return None
    size = 1 << len(found).bit_length()
    maps: list[dict] = [{} for _ in range(size)]
    for row in found:
        maps[row.hash % size][row.key] = row.asDict(recursive=True)["value"]
    held = F.from_json(F.lit(json.dumps(maps)), T.ArrayType(T.MapType(T.StringType(), listed.schema["value"].dataType)))
    return lambda text: F.try_element_at(F.get(held, F.pmod(F.xxhash64(text), F.lit(size)).cast("int")), text)
