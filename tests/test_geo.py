import math
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from guestbook.functions import geo as columns
from guestbook.operators import geo
from guestbook.schema import Columns

C = Columns(key=("id",))


def unit(lat, lng):
    lat, lng = math.radians(lat), math.radians(lng)
    return math.cos(lat) * math.cos(lng), math.cos(lat) * math.sin(lng), math.sin(lat)


def metres(lat1, lng1, lat2, lng2):
    """By the angle between the two directions from the centre of the earth."""
    (a, b, c), (x, y, z) = unit(lat1, lng1), unit(lat2, lng2)
    across = math.hypot(b * z - c * y, c * x - a * z, a * y - b * x)
    return 6371000 * math.atan2(across, a * x + b * y + c * z)


def cloud(seed, lat, lng, degrees, n):
    """Points around a centre, longitudes wrapped, with some exact copies."""
    rng = random.Random(seed)
    points = []
    for i in range(n):
        y = max(-90.0, min(90.0, lat + rng.uniform(-degrees, degrees)))
        x = lng + rng.uniform(-degrees, degrees) / max(0.02, math.cos(math.radians(y)))
        points.append((f"e{i % (n - n // 8)}", y, (x + 180) % 360 - 180))
    return points + [("copy", *points[0][1:])]


CENTRES = [(45.46, 9.19), (0.0, 0.0), (-33.9, 151.2), (52.0, 179.999), (52.0, -179.999), (89.99, 10.0), (-89.995, 0.0)]


@pytest.fixture(params=CENTRES, ids=str)
def centre(request):
    return request.param


def entities(spark, points):
    return spark.createDataFrame(points, "Hotel_Name string, lat double, lng double")


def test_distance(spark):
    pairs = [(45.464098, 9.191926, 45.48378709120793, 9.18994), (1.0, 2.0, 1.0, 2.0), (None, 2.0, 1.0, 2.0)]
    df = spark.createDataFrame(pairs, "a double, b double, c double, d double")
    got = [r[0] for r in df.select(columns.haversine(*map(F.col, "abcd"))).collect()]
    assert got[0] == pytest.approx(metres(45.464098, 9.191926, 45.48378709120793, 9.18994), abs=1e-6)
    assert got[1:] == [0.0, None]


def test_bands(spark):
    df = spark.createDataFrame([(x,) for x in (500.0, 500.1, 1000.0, 1000.5, 2000.0, 2000.1)], "distance double")
    got = [r.band for r in geo.with_band(df).collect()]
    near, middle, far = "Entro 500 metri", "Tra 500 e 1000 metri", "Tra 1000 e 2000 metri"
    assert got == [near, middle, middle, far, far, None]


def test_nearby_equals_brute_force(spark, centre):
    points = cloud(1, *centre, 0.03, 200)
    got = geo.nearby_entities(entities(spark, points), *centre, 2000)
    expected = {p for p in points if metres(*p[1:], *centre) <= 2000}
    assert 0 < len(expected) < 200
    assert {tuple(r)[:3] for r in got.collect()} == expected


def test_points_of_interest_equal_brute_force(spark, centre):
    points = cloud(2, *centre, 0.03, 150)
    spots = [(f"m{i}", y, x, "c") for i, (_, y, x) in enumerate(cloud(3, *centre, 0.03, 12))]
    poi = spark.createDataFrame(spots, "Monument string, lat double, long double, City string")
    expected = {(m, *p) for m, y, x, _ in spots for p in points if metres(*p[1:], y, x) <= 1500}
    for max_bytes in (1 << 25, 0):
        got = geo.entities_near_points(entities(spark, points), poi, 1500, max_bytes=max_bytes)
        found = [(r.Monument, r.Hotel_Name, r.lat, r.lng) for r in got.collect()]
        assert len(found) == len(set(found)) and set(found) == expected


@pytest.mark.parametrize("radius", [60, 400, 1000])
def test_neighbours_equal_brute_force(spark, centre, radius):
    points = set(cloud(4, *centre, 0.03, 60))
    expected = {p: any(q[0] != p[0] and metres(*p[1:], *q[1:]) <= radius for q in points) for p in points}
    got = {tuple(r)[:3]: r.has_neighbours for r in geo.neighbour_check(entities(spark, list(points)), radius).collect()}
    assert got == expected


def test_neighbours_of_a_crowded_place(spark):
    crowd = spark.range(20000).select(
        F.concat(F.lit("e"), "id").alias("Hotel_Name"), (45.0 + F.col("id") % 10 * 1e-5).alias("lat"), F.lit(9.0).alias("lng")
    )
    edge = entities(spark, [("near", 45.005, 9.0), ("far", 46.0, 9.0), ("far", 46.001, 9.0)])
    got = geo.neighbour_check(crowd.unionByName(edge), 1000)
    assert rows(got.groupBy("has_neighbours").count()) == [(False, 2), (True, 20001)]


def test_positions_of_one_entity_do_not_meet_each_other(spark):
    """A cell full of one entity's own positions, and one other entity far away."""
    crowd = spark.range(30000).select(
        F.lit("e").alias("Hotel_Name"), (45.0 + F.col("id") * 1e-9).alias("lat"), F.lit(9.0).alias("lng")
    )
    got = geo.neighbour_check(crowd.unionByName(entities(spark, [("far", 46.0, 9.0)])), 1000)
    assert rows(got.groupBy("has_neighbours").count()) == [(False, 30001)]


def test_neighbour_trend_needs_company(spark):
    df = entities(spark, [("a", 45.0, 9.0), ("b", 45.001, 9.0), ("c", 46.0, 9.0)]).withColumns(
        {"Review_Date": F.lit("2017-03-01").cast("date"), "Reviewer_Score": F.lit(8.0)}
    )
    assert rows(geo.neighbour_trend(df, 45.0, 9.0)) == [("a", "2017-03", 8.0), ("b", "2017-03", 8.0)]
    assert rows(geo.neighbour_trend(df, 46.0, 9.0)) == []


def test_nearby_reputation_sees_all_reviews_of_an_entity(spark):
    df = spark.createDataFrame(
        [("a", 45.0, 9.0, 8.0, 1), ("a", None, None, 4.0, 2), ("b", 46.0, 9.0, 1.0, 3)],
        "Hotel_Name string, lat double, lng double, Reviewer_Score double, id int",
    ).withColumn("Review_Date", F.lit("2017-03-01").cast("date"))
    for max_bytes in (1 << 25, 0):
        assert rows(geo.nearby_reputation(df, 45.0, 9.0, c=C, max_bytes=max_bytes)) == [("a", 6.0, 6.0, 0.0)]


def plain_surroundings(points, radius):
    """(entity, lat, lng, month, own mean, mean around, reviews around) by measuring every pair."""
    out, spots = [], sorted({(name, lat, lng) for name, lat, lng, _, _ in points})
    for name, lat, lng in spots:
        near = [p for p in points if metres(lat, lng, p[1], p[2]) <= radius]
        if len({p[0] for p in near}) < 2:
            continue
        for month in {p[3][:7] for p in near}:
            around = [p[4] for p in near if p[3][:7] == month]
            own = [p[4] for p in near if p[3][:7] == month and p[:3] == (name, lat, lng)]
            mean = [sum(x for x in held if x is not None) / n if (n := sum(x is not None for x in held)) else None for held in (own, around)]
            out.append((name, lat, lng, month, *mean, len(around)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("max_bytes", [0, 1 << 25])
def test_surroundings(spark, centre, max_bytes):
    rng = random.Random(5)
    places = cloud(6, *centre, 0.03, 60)
    points = [(*rng.choice(places), f"2017-0{rng.randint(1, 3)}-1{rng.randint(0, 9)}", rng.choice([2.5, 5.0, 9.0, None])) for _ in range(400)]
    df = spark.createDataFrame(points + [("gone", None, 1.0, "2017-01-01", 5.0)], "Hotel_Name string, lat double, lng double, day string, Reviewer_Score double")
    df = df.withColumn("Review_Date", F.to_date("day"))
    got = geo.surroundings_trend(df, 1000, C, max_bytes)
    assert got.columns == ["Hotel_Name", "lat", "lng", "YearMonth", "own_score", "surroundings_score", "surroundings_reviews"]
    assert rows(got) == plain_surroundings(points, 1000)


def test_cells_within_a_circle_hold_no_point_outside(spark, centre):
    """Of points drawn in the reached cells, all those in cells taken whole are near."""
    places = cloud(9, *centre, 0.05, 300)
    df = entities(spark, places).withColumn("cell", columns.home_cell(F.col("lat"), F.col("lng"), 250.0))
    pairs = df.alias("a").crossJoin(df.alias("b"))
    inside = columns.wholly_within(F.col("a.lat"), F.col("a.lng"), F.col("b.cell.band"), F.col("b.cell.slot"), 250.0, 1000.0)
    far = columns.haversine(*[F.col(name) for name in ("a.lat", "a.lng", "b.lat", "b.lng")])
    counted = pairs.withColumn("inside", inside).withColumn("far", far).agg(F.count_if("inside"), F.count_if(F.expr("inside and far > 1000")), F.count_if(F.expr("inside and far > 500"))).first()
    assert counted[1] == 0 and (abs(centre[0]) > 80 or counted[0] > 300 and counted[2] > 0)


def test_crowds_are_not_listed_in_pairs(spark):
    """500 entities within a hundred metres: sums of cells meet them, never each other's positions."""
    rng = random.Random(1)
    points = [(f"e{i}", 45.46 + rng.uniform(0, 0.0005), 9.19 + rng.uniform(0, 0.0005), 5.0) for i in range(500)]
    df = spark.createDataFrame(points, "Hotel_Name string, lat double, lng double, Reviewer_Score double")
    df = df.withColumn("Review_Date", F.lit("2017-01-01").cast("date"))
    got = geo.surroundings_trend(df, 1000, C)
    assert got.select("surroundings_reviews").distinct().collect() == [(500,)] and got.count() == 500
