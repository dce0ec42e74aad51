"""Radius search around points of interest, and neighbours of entities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guestbook.functions.geo import distance_band, haversine, home_cell, near_box, reached_cells, wholly_within
from guestbook.functions.labels import year_month
from guestbook.operators.joins import BROADCAST_BYTES, join_lookup
from guestbook.operators.scores import monthly_trend, reputation
from guestbook.schema import REVIEWS, Columns
from guestbook.shared import settled


def nearby_reviews(df: DataFrame, lat: float, lng: float, max_distance: float, c: Columns = REVIEWS) -> DataFrame:
    """Reviews within ``max_distance`` metres of a point, with their ``distance``."""
    here = haversine(F.col(c.lat), F.col(c.lng), F.lit(float(lat)), F.lit(float(lng)))
    return (
        df.filter(near_box(F.col(c.lat), F.col(c.lng), lat, lng, max_distance))
        .withColumn("distance", here)
        .filter(F.col("distance") <= max_distance)
    )


def nearby_entities(
    df: DataFrame, lat: float, lng: float, max_distance: float = 2000, c: Columns = REVIEWS
) -> DataFrame:
    """Distinct entities around a point; the distance is computed once per position, not once per review."""
    near = df.select(c.entity, c.lat, c.lng).filter(near_box(F.col(c.lat), F.col(c.lng), lat, lng, max_distance))
    return nearby_reviews(near.distinct(), lat, lng, max_distance, c)


def with_band(df: DataFrame) -> DataFrame:
    return df.withColumn("band", distance_band(F.col("distance")))


def nearby_reputation(
    df: DataFrame,
    lat: float,
    lng: float,
    max_distance: float = 2000,
    recent_reviews: int = 30,
    c: Columns = REVIEWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Entities around a point with the mean of all and of their newest reviews.

    The reviews are first cut down to the entities found, wherever else those were reviewed.
    """
    near = settled(nearby_entities(df, lat, lng, max_distance, c).select(c.entity, "distance"), "nearby")
    names = near.select(c.entity).distinct()
    slim = df.select(c.entity, c.score, c.date, *c.key)
    means = reputation(join_lookup(slim, names, c.entity, "left_semi", max_bytes=max_bytes), recent_reviews, c)
    return near.select(c.entity, "distance").join(means, c.entity).select(
        c.entity, "avg_historical_score", "avg_recent_score", "distance"
    )


def points_in_city(poi: DataFrame, city: str) -> DataFrame:
    return poi.filter(F.col("City") == city)


def point_named(poi: DataFrame, monument: str) -> DataFrame:
    return poi.filter(F.col("Monument") == monument)


def entities_near_points(
    entities: DataFrame,
    poi: DataFrame,
    max_distance: float = 2000,
    c: Columns = REVIEWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Every point of interest with the entities around it, for all points at once.

    Each point lists the grid cells its circle can touch and meets the entities of those cells in an equi
    join, so only close pairs are ever formed. Poles and the date line are handled by the grid.
    """
    cells = poi.withColumn("_cell", F.explode(reached_cells(F.col("lat"), F.col("long"), max_distance, max_distance)))
    cells = cells.select(
        "Monument", "City", F.col("lat").alias("_poi_lat"), F.col("long").alias("_poi_lng"), "_cell.band", "_cell.slot"
    )
    placed = (
        entities.select(c.entity, c.lat, c.lng)
        .distinct()
        .withColumn("_cell", home_cell(F.col(c.lat), F.col(c.lng), max_distance))
        .select(c.entity, c.lat, c.lng, "_cell.band", "_cell.slot")
    )
    found = join_lookup(placed, cells, ["band", "slot"], max_bytes=max_bytes)
    found = found.withColumn(
        "distance", haversine(F.col(c.lat), F.col(c.lng), F.col("_poi_lat"), F.col("_poi_lng"))
    ).filter(F.col("distance") <= max_distance)
    return with_band(found.select("Monument", "City", c.entity, c.lat, c.lng, "distance"))


def neighbour_check(
    df: DataFrame, max_distance: float = 1000, c: Columns = REVIEWS, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """For every position of an entity, whether another entity lies within ``max_distance`` metres.

    In a grid whose cells are nowhere wider than the radius, two entities of one cell are neighbours, which
    settles every crowded cell by one aggregate and without pairs. Only positions whose cell holds a single
    entity look at the positions in the cells around them; entities at one position count there once.
    """
    side = max_distance / 2 * (1 - 1e-9)
    positions = (
        df.select(F.col(c.entity).alias("_entity"), F.col(c.lat).alias("_lat"), F.col(c.lng).alias("_lng"))
        .filter(F.col(c.entity).isNotNull() & F.col(c.lat).isNotNull() & F.col(c.lng).isNotNull())
        .distinct()
    )
    placed = settled(positions, "positions").withColumn("_cell", home_cell(F.col("_lat"), F.col("_lng"), side))
    placed = placed.select("_entity", "_lat", "_lng", "_cell.band", "_cell.slot")
    cells = placed.groupBy("band", "slot").agg(F.min("_entity").alias("_least"), F.max("_entity").alias("_most"))
    cells = settled(cells, "cells")
    known = join_lookup(placed, cells, ["band", "slot"], max_bytes=max_bytes)
    known = known.withColumn("_crowded", F.col("_least") != F.col("_most")).drop("_least", "_most")
    lone = known.filter(~F.col("_crowded")).select("_entity", "_lat", "_lng")
    asking = (
        lone.withColumn("_cell", F.explode(reached_cells(F.col("_lat"), F.col("_lng"), side, max_distance)))
        .withColumnsRenamed({"_lat": "_from_lat", "_lng": "_from_lng"})
        .select("_entity", "_from_lat", "_from_lng", "_cell.band", "_cell.slot")
    )
    # Cells that hold no other entity have nothing to say: the own cell and the own positions around it go here.
    asking = join_lookup(asking, cells, ["band", "slot"], max_bytes=max_bytes)
    asking = asking.filter((F.col("_least") != F.col("_entity")) | (F.col("_most") != F.col("_entity"))).drop("_least", "_most")
    spots = placed.groupBy("band", "slot", "_lat", "_lng").agg(F.min("_entity").alias("_low"), F.max("_entity").alias("_high"))
    hits = (
        join_lookup(spots, asking, ["band", "slot"], costly=True, max_bytes=max_bytes)
        .filter((F.col("_low") != F.col("_entity")) | (F.col("_high") != F.col("_entity")))
        .filter(haversine(F.col("_from_lat"), F.col("_from_lng"), F.col("_lat"), F.col("_lng")) <= max_distance)
        .select("_entity", F.col("_from_lat").alias("_lat"), F.col("_from_lng").alias("_lng"))
        .distinct()
        .withColumn("_hit", F.lit(True))
    )
    checked = lone.join(hits, ["_entity", "_lat", "_lng"], "left").withColumn("has_neighbours", F.col("_hit").isNotNull())
    crowded = known.filter("_crowded").withColumn("has_neighbours", F.lit(True))
    names = [F.col("_entity").alias(c.entity), F.col("_lat").alias(c.lat), F.col("_lng").alias(c.lng), "has_neighbours"]
    return crowded.select(*names).unionByName(checked.select(*names))


def neighbour_trend(
    df: DataFrame, lat: float, lng: float, max_distance: float = 1000, c: Columns = REVIEWS
) -> DataFrame:
    """Monthly trends of the entities around a point, if there is more than one of them."""
    near = nearby_reviews(df, lat, lng, max_distance, c)
    several = near.agg(F.min(c.entity) != F.max(c.entity)).scalar()
    return monthly_trend(near, c).filter(several)


CELLS_A_RADIUS = 4


def surroundings_trend(
    df: DataFrame, max_distance: float = 1000, c: Columns = REVIEWS, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """For every position of an entity that has neighbours, the monthly mean score of all reviews within
    ``max_distance`` metres (its own among them), their number, and the mean of its own reviews there.

    Reviews are first summed by position and month, and these sums by grid cell. An entity takes a cell that lies
    wholly within its circle as one sum; only in the cells that the circle's edge crosses are positions measured, each
    once however many entities and reviews it has. Entities at one position ask once.
    """
    side = max_distance / CELLS_A_RADIUS
    month = year_month(F.col(c.date)).alias("YearMonth")
    placed = df.filter(F.col(c.lat).isNotNull() & F.col(c.lng).isNotNull())
    sums = [F.sum(c.score).alias("_sum"), F.count(c.score).alias("_scored"), F.count("*").alias("_reviews")]
    own = placed.groupBy(F.col(c.entity).alias("_entity"), F.col(c.lat).alias("_lat"), F.col(c.lng).alias("_lng"), month).agg(*sums)
    own = settled(own, "own-months")
    more = [F.sum(name).alias(name) for name in ("_sum", "_scored", "_reviews")]
    spots = own.groupBy("_lat", "_lng", "YearMonth").agg(*more)
    spots = spots.withColumn("_cell", home_cell(F.col("_lat"), F.col("_lng"), side)).select("*", "_cell.band", "_cell.slot").drop("_cell")
    spots = settled(spots, "spot-months")
    cells = spots.groupBy("band", "slot", "YearMonth").agg(*more)
    checked = neighbour_check(df, max_distance, c, max_bytes).filter("has_neighbours")
    asking = settled(checked.select(F.col(c.lat).alias("_from_lat"), F.col(c.lng).alias("_from_lng")).distinct(), "asking")
    reached = asking.withColumn("_cell", F.explode(reached_cells(F.col("_from_lat"), F.col("_from_lng"), side, max_distance)))
    reached = reached.select("_from_lat", "_from_lng", "_cell.band", "_cell.slot")
    filled = spots.select("band", "slot").distinct()
    reached = join_lookup(reached, filled, ["band", "slot"], "left_semi", costly=True, max_bytes=max_bytes)
    inside = wholly_within(F.col("_from_lat"), F.col("_from_lng"), F.col("band"), F.col("slot"), side, max_distance)
    reached = settled(reached.withColumn("_inside", F.coalesce(inside, F.lit(False))), "reached-cells")
    whole = join_lookup(reached.filter("_inside"), cells, ["band", "slot"], costly=True, max_bytes=max_bytes)
    places = spots.select("band", "slot", "_lat", "_lng").distinct()
    edge = join_lookup(reached.filter("not _inside"), places, ["band", "slot"], costly=True, max_bytes=max_bytes)
    edge = edge.filter(haversine(F.col("_from_lat"), F.col("_from_lng"), F.col("_lat"), F.col("_lng")) <= max_distance)
    edge = join_lookup(edge.drop("band", "slot"), spots.drop("band", "slot"), ["_lat", "_lng"], max_bytes=max_bytes)
    found = ["_from_lat", "_from_lng", "YearMonth", "_sum", "_scored", "_reviews"]
    around = whole.select(*found).unionByName(edge.select(*found)).groupBy("_from_lat", "_from_lng", "YearMonth").agg(*more)
    around = around.select(
        F.col("_from_lat").alias("_lat"),
        F.col("_from_lng").alias("_lng"),
        "YearMonth",
        F.try_divide("_sum", "_scored").alias("surroundings_score"),
        F.col("_reviews").alias("surroundings_reviews"),
    )
    named = checked.select(F.col(c.entity).alias("_entity"), F.col(c.lat).alias("_lat"), F.col(c.lng).alias("_lng"))
    found = join_lookup(named, around, ["_lat", "_lng"], costly=True, max_bytes=max_bytes)
    own = own.select("_entity", "_lat", "_lng", "YearMonth", F.try_divide("_sum", "_scored").alias("own_score"))
    # Months without a date are months too; positions and names are never null here.
    both = (F.col("f.YearMonth").eqNullSafe(F.col("o.YearMonth"))) & (F.col("f._entity") == F.col("o._entity"))
    both = both & (F.col("f._lat") == F.col("o._lat")) & (F.col("f._lng") == F.col("o._lng"))
    compared = found.alias("f").hint("merge").join(own.alias("o"), both, "left")
    return compared.select(
        F.col("f._entity").alias(c.entity),
        F.col("f._lat").alias(c.lat),
        F.col("f._lng").alias(c.lng),
        "f.YearMonth",
        "own_score",
        "surroundings_score",
        "surroundings_reviews",
    )
