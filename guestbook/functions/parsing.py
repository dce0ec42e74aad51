"""Parsing of raw text fields. A malformed field becomes NULL; it never fails the job under ANSI mode."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from guestbook.functions.fixed_values import ADDRESS_REPAIRS


# A text that a cast or a format cannot read throws inside Spark, which takes some twenty times as long as reading one.
# So what cannot be a date or an integer is told by a pattern first; what the patterns let through is still checked.
DATE_LIKE = r"^0*(?:[1-9]|1[0-2])/0*(?:[1-9]|[12][0-9]|3[01])/[+-]?[0-9]{4}"
INTEGER_LIKE = r"^[\x00-\x20\x7f]*[+-]?[0-9]+[\x00-\x20\x7f]*$"


def us_date(text: Column) -> Column:
    return F.when(text.rlike(DATE_LIKE), F.try_to_date(text, "M/d/yyyy"))


def first_number(text: Column) -> Column:
    """``"12 days"`` -> 12; a text without digits -> NULL."""
    return F.nullif(F.regexp_extract(text, r"(\d+)", 1), F.lit("")).try_cast("int")


def whole_number(text: Column) -> Column:
    """An integer, also one that is written with decimals: ``"7.0"`` -> 7. Further decimals are cut off."""
    return F.coalesce(text.try_cast("double").try_cast("int"), F.when(text.rlike(INTEGER_LIKE), text.try_cast("int")))


def tag_list(text: Column) -> Column:
    """``"[' A ', ' B ']"`` -> ``["A", "B"]``; ``"[]"`` -> ``[""]``."""
    bare = reduce(lambda left, mark: F.replace(left, F.lit(mark), F.lit("")), "[]'", text)
    return F.transform(F.split(bare, ", "), lambda tag: F.trim(tag))


def repaired_address(address: Column) -> Column:
    """Apply every spelling repair in turn; each sees the result of the ones before."""
    return reduce(
        lambda text, repair: F.replace(text, F.lit(repair[0]), F.lit(repair[1])), ADDRESS_REPAIRS, address
    )


def in_city(address: Column, city: str) -> Column:
    return address.contains(city)


def cities_of(address: Column, cities: tuple[str, ...]) -> Column:
    """Array of the given cities whose name occurs in the address."""
    return F.filter(F.array(*[F.lit(city) for city in cities]), lambda city: address.contains(city))
