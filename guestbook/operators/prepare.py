"""From raw text fields to clean, typed reviews with coordinates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guestbook.functions.fixed_values import CITIES
from guestbook.functions.parsing import cities_of, first_number, in_city, repaired_address, tag_list, us_date, whole_number
from guestbook.functions.text import grams
from guestbook.operators.joins import BROADCAST_BYTES, join_lookup, measured_bytes
from guestbook.schema import DOUBLE_COLUMNS, INT_COLUMNS, REVIEWS, Columns
from guestbook.shared import settled


def typed_reviews(raw: DataFrame) -> DataFrame:
    """Type every known raw column in one projection; other columns pass through."""
    typed = {name: whole_number(F.col(name)) for name in INT_COLUMNS}
    typed |= {name: F.col(name).try_cast("double") for name in DOUBLE_COLUMNS}
    typed |= {
        "Review_Date": us_date(F.col("Review_Date")),
        "days_since_review": first_number(F.col("days_since_review")),
        "Tags": tag_list(F.col("Tags")),
    }
    return raw.select(*[typed[name].alias(name) if name in typed else F.col(name) for name in raw.columns])


def with_known_nationality(df: DataFrame, c: Columns = REVIEWS) -> DataFrame:
    """Drop reviews whose nationality is blank; NULL goes with them."""
    return df.filter(F.col(c.nationality) != " ")


def lacks_coordinates(c: Columns = REVIEWS):
    return F.col(c.lat).isNull() | F.col(c.lng).isNull()


def addresses_without_coordinates(df: DataFrame, c: Columns = REVIEWS) -> DataFrame:
    return df.filter(lacks_coordinates(c)).select(c.address).distinct()


def unique_gazetteer(gazetteer: DataFrame) -> DataFrame:
    """One position per address, so that a join with it never multiplies rows."""
    return (
        gazetteer.filter(F.col("address").isNotNull())
        .groupBy("address")
        .agg(F.min(F.struct("g_lat", "g_lng")).alias("_position"))
        .select("address", "_position.g_lat", "_position.g_lng")
    )


def located_addresses(
    addresses: DataFrame, gazetteer: DataFrame, c: Columns = REVIEWS, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Look each (distinct) address up under its repaired spelling; unknown ones get NULL coordinates."""
    spelled = addresses.withColumn("address", repaired_address(F.col(c.address)))
    return join_lookup(spelled, unique_gazetteer(gazetteer), "address", "left", costly=True, max_bytes=max_bytes).select(
        c.address, F.col("g_lat").alias("lat_f"), F.col("g_lng").alias("lng_f")
    )


def fill_coordinates(
    df: DataFrame, gazetteer: DataFrame, c: Columns = REVIEWS, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Fill missing coordinates from ``gazetteer(address, g_lat, g_lng)``, each coordinate on its own.

    A gazetteer that fits is looked up in one pass over the reviews, and only rows that lack a coordinate
    have their address repaired. Of a larger one, only the addresses that occur here are kept.
    """
    if measured_bytes(gazetteer) <= max_bytes:
        key, lookup, address = "_spelling", unique_gazetteer(gazetteer), repaired_address(F.col(c.address))
        lookup = lookup.select(
            F.col("address").alias(key), F.col("g_lat").alias("_lat_f"), F.col("g_lng").alias("_lng_f")
        )
        joined = df.withColumn(key, F.when(lacks_coordinates(c), address)).join(F.broadcast(lookup), key, "left")
    else:
        key, address = "_address", F.col(c.address)
        lookup = located_addresses(addresses_without_coordinates(df, c), gazetteer, c, max_bytes).select(
            F.col(c.address).alias(key), F.col("lat_f").alias("_lat_f"), F.col("lng_f").alias("_lng_f")
        )
        lookup = lookup.filter(F.col("_lat_f").isNotNull() | F.col("_lng_f").isNotNull())
        joined = join_lookup(
            df.withColumn(key, F.when(lacks_coordinates(c), address)), lookup, key, "left", costly=True, max_bytes=max_bytes
        )
    filled = {
        c.lat: F.coalesce(F.col(c.lat), F.col("_lat_f")),
        c.lng: F.coalesce(F.col(c.lng), F.col("_lng_f")),
    }
    return joined.select(*[filled[name].alias(name) if name in filled else F.col(name) for name in df.columns])


def prepare(raw: DataFrame, gazetteer: DataFrame, c: Columns = REVIEWS) -> DataFrame:
    """Type, clean and locate raw reviews. Persist or store the result where several queries read it."""
    return fill_coordinates(with_known_nationality(typed_reviews(raw), c), gazetteer, c)


def with_total_review(df: DataFrame, c: Columns = REVIEWS) -> DataFrame:
    """Both texts as one, a space between them so that the words at the seam stay apart."""
    return df.withColumn("Total_Review", F.concat_ws(" ", c.positive_text, c.negative_text))


def reviews_in_city(df: DataFrame, city: str, c: Columns = REVIEWS) -> DataFrame:
    return df.filter(in_city(F.col(c.address), city))


def reviews_by_city(df: DataFrame, cities: tuple[str, ...] = CITIES, c: Columns = REVIEWS) -> DataFrame:
    """One row per review and city of the list that its address names."""
    return df.withColumn("city", F.explode(cities_of(F.col(c.address), cities)))


CITY_GRAM = 4


def cities_in_addresses(
    addresses: DataFrame, cities: DataFrame, c: Columns = REVIEWS, gram: int = CITY_GRAM, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """(address, city) for every distinct address and every city of ``cities(city)`` that it names.

    A name can only be in an address that has all its grams of ``gram`` characters. Of these the one that the fewest
    addresses have is the key under which a name is joined with the addresses; what meets there is then searched for
    the whole name. So a list of any length takes an equi join, and no address is held against all names. A shorter
    name is its own gram; an empty one is in every address.
    """
    texts = settled(addresses.select(F.col(c.address).alias("_text")).filter(F.col("_text").isNotNull()).distinct(), "addresses")
    names = cities.select(F.col("city")).filter(F.col("city").isNotNull()).distinct()
    names = settled(names.withColumn("_size", F.least(F.length("city"), F.lit(gram))), "city-names")
    sizes = sorted(row._size for row in names.select("_size").distinct().collect())  # at most gram + 1
    own = names.select("city", "_size", F.explode(F.array_distinct(grams(F.col("city"), F.col("_size")))).alias("_gram"))
    every = F.array_distinct(F.flatten(F.array(*[grams(F.col("_text"), F.lit(size)) for size in sizes] or [F.array().cast("array<string>")])))
    of_text = texts.select("_text", F.explode(every).alias("_gram"))
    wanted = own.select("_gram").distinct()
    held = settled(join_lookup(of_text, wanted, "_gram", "left_semi", costly=True, max_bytes=max_bytes), "address-grams")
    times = join_lookup(own, held.groupBy("_gram").agg(F.count("*").alias("_times")), "_gram", "left", costly=True, max_bytes=max_bytes)
    times = times.withColumn("_times", F.coalesce("_times", F.lit(0)))
    keys = times.groupBy("city").agg(F.min(F.struct("_times", "_gram")).alias("_key")).filter("_key._times > 0")
    keys = keys.select("city", F.col("_key._gram").alias("_gram"))
    found = join_lookup(held, keys, "_gram", costly=True, max_bytes=max_bytes).filter(F.contains("_text", "city"))
    return found.select(F.col("_text").alias(c.address), "city")


def reviews_by_listed_city(
    df: DataFrame, cities: DataFrame, c: Columns = REVIEWS, gram: int = CITY_GRAM, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """One row per review and city of the table ``cities(city)`` that its address names."""
    found = cities_in_addresses(df, cities, c, gram, max_bytes)
    named = found.groupBy(c.address).agg(F.collect_list("city").alias("city"))
    return join_lookup(df, named, c.address, costly=True, max_bytes=max_bytes).withColumn("city", F.explode("city")).select(*df.columns, "city")
