import datetime
import time

import pytest
from conftest import rows
from pyspark.sql import functions as F

from guestbook.functions import parsing
from guestbook.functions.fixed_values import ADDRESS_REPAIRS, POINTS_OF_INTEREST
from guestbook.operators import prepare, quality
from guestbook.schema import REVIEW_COLUMNS
from guestbook.sources import export_word_scores, land_reviews, points_of_interest, read_poi_csv, read_review_csv

RAW = {
    "Hotel_Address": "Via Roma 1 Milan",
    "Additional_Number_of_Scoring": "194",
    "Review_Date": "8/3/2017",
    "Average_Score": "7.7",
    "Hotel_Name": "Hotel A",
    "Reviewer_Nationality": " Russia ",
    "Negative_Review": "No Negative",
    "Review_Total_Negative_Word_Counts": "0",
    "Total_Number_of_Reviews": "1403",
    "Positive_Review": "Nice, \"quiet\" place",
    "Review_Total_Positive_Word_Counts": "11",
    "Total_Number_of_Reviews_Reviewer_Has_Given": "7",
    "Reviewer_Score": "9.2",
    "Tags": "[' Leisure trip ', ' Couple ']",
    "days_since_review": "12 days",
    "lat": "45.5",
    "lng": "9.2",
}


def raw(spark, *changes):
    return spark.createDataFrame(
        [tuple((RAW | change)[name] for name in REVIEW_COLUMNS) for change in changes],
        ", ".join(f"{name} string" for name in REVIEW_COLUMNS),
    )


def test_typed_fields(spark):
    row = prepare.typed_reviews(raw(spark, {})).first()
    assert row.Review_Date == datetime.date(2017, 8, 3)
    assert row.Tags == ["Leisure trip", "Couple"]
    assert (row.days_since_review, row.Reviewer_Score, row.lat, row.Total_Number_of_Reviews) == (12, 9.2, 45.5, 1403)


def test_malformed_fields_become_null(spark):
    bad = {"Reviewer_Score": "NA", "Review_Date": "13/45/2017", "days_since_review": "days", "lat": "NA", "Tags": "[]"}
    row = prepare.typed_reviews(raw(spark, bad)).first()
    assert (row.Reviewer_Score, row.Review_Date, row.days_since_review, row.lat) == (None, None, None, None)
    assert row.Tags == [""]


def test_blank_and_null_nationality_are_dropped(spark):
    df = raw(spark, {}, {"Reviewer_Nationality": " "}, {"Reviewer_Nationality": None})
    assert prepare.with_known_nationality(df).count() == 1


def test_address_repairs_run_in_order(spark):
    cases = {
        "Landstra er G rtel 5 03 Vienna": "5 Landstrasser Guertel Vienna",
        "Landstra e 1": "Landstraße 1",
        "Marriott": "MArrondissementiott",
        "Josefst dter Stra e 10 12 08 Josefstadt": "10 Josefstädter Straße Josefstadt",
        "untouched": "untouched",
    }
    df = spark.createDataFrame([(x,) for x in cases], "address string")
    got = {r[0]: r[1] for r in df.select("address", parsing.repaired_address(F.col("address"))).collect()}
    assert got == cases
    assert len(ADDRESS_REPAIRS) == 23


def test_fill_keeps_rows_and_each_known_coordinate(spark):
    df = spark.createDataFrame(
        [(1, "x arr", None, None), (2, "x arr", None, 5.0), (3, "y", 1.0, 2.0), (4, "z", None, None), (5, None, None, None)],
        "id int, Hotel_Address string, lat double, lng double",
    )
    gazetteer = spark.createDataFrame(
        [("x Arrondissement", 10.0, 20.0), ("x Arrondissement", 11.0, 21.0), ("y", 99.0, 99.0)],
        "address string, g_lat double, g_lng double",
    )
    expected = [
        (1, "x arr", 10.0, 20.0), (2, "x arr", 10.0, 5.0), (3, "y", 1.0, 2.0), (4, "z", None, None), (5, None, None, None),
    ]
    assert rows(prepare.fill_coordinates(df, gazetteer)) == expected
    assert rows(prepare.fill_coordinates(df, gazetteer, max_bytes=0)) == expected
    assert rows(prepare.addresses_without_coordinates(df)) == [("x arr",), ("z",), (None,)]


def test_prepare_end_to_end(spark):
    df = raw(spark, {}, {"lat": "NA", "lng": "NA", "Hotel_Address": "Pau Clar s 1"}, {"Reviewer_Nationality": " "})
    gazetteer = spark.createDataFrame([("Pau Claris 1", 41.0, 2.0)], "address string, g_lat double, g_lng double")
    done = prepare.prepare(df, gazetteer)
    assert done.columns == list(REVIEW_COLUMNS)
    assert rows(done.select("lat", "lng")) == [(41.0, 2.0), (45.5, 9.2)]


def test_total_review_keeps_words_apart(spark):
    df = spark.createDataFrame([("good", "bad"), (None, "bad"), (None, None)], "Positive_Review string, Negative_Review string")
    assert [r[0] for r in prepare.with_total_review(df).select("Total_Review").collect()] == ["good bad", "bad", ""]


def test_cities(spark):
    df = spark.createDataFrame([("Via Roma Milan",), ("milan",), ("Paris Milan",)], "Hotel_Address string")
    assert prepare.reviews_in_city(df, "Milan").count() == 2
    assert rows(prepare.reviews_by_city(df, ("Milan", "Paris")).groupBy("city").count()) == [("Milan", 2), ("Paris", 1)]


def test_quality_profiles(spark):
    df = spark.createDataFrame([("a", 1.0), (" ", None), (None, 95.0)], "name string, lat double").withColumn("lng", F.lit(0.0))
    assert rows(quality.blank_counts(df)) == [("name", 2)]
    assert rows(quality.presence_counts(df)) == [("lat", 2, 1), ("lng", 3, 0), ("name", 2, 1)]
    assert rows(quality.null_counts(df)) == [("lat", 1), ("lng", 0), ("name", 1)]
    assert rows(quality.out_of_range_coordinates(df).select("lat")) == [(95.0,)]


def test_review_csv_and_landing(spark, tmp_path):
    source, target = str(tmp_path / "csv"), str(tmp_path / "parquet")
    frame = raw(spark, {}, {"lat": "NA"}, {"Reviewer_Nationality": " "})
    frame.coalesce(1).write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(source)
    assert rows(read_review_csv(spark, source)) == rows(frame)
    landed = land_reviews(spark, source, target)
    assert landed.select("review_id").distinct().count() == 3
    assert rows(landed.select("lat")) == [(45.5,), (45.5,), (None,)]


def test_reordered_header_is_refused(spark, tmp_path):
    path = str(tmp_path / "csv")
    frame = raw(spark, {})
    frame.select(*reversed(frame.columns)).write.option("header", True).csv(path)
    try:
        read_review_csv(spark, path).collect()
    except Exception as error:
        assert "header" in str(error)
    else:
        raise AssertionError("a reordered file was read")


def test_poi_csv(spark, tmp_path):
    path = str(tmp_path / "poi.csv")
    with open(path, "w") as out:
        out.write("Monument;lat;long;City\nDuomo, Milano;45.464098;9.191926;Milan\n")
    assert rows(read_poi_csv(spark, path)) == [("Duomo, Milano", 45.464098, 9.191926, "Milan")]
    assert points_of_interest(spark).count() == len(POINTS_OF_INTEREST) == 35


def test_export_word_scores(spark, tmp_path):
    path = str(tmp_path / "words")
    schema = "word string, avg_score double, word_count bigint"
    scores = [("good", 9.5, 10, "positive"), ("bad", 3.5, 7, "negative")]
    export_word_scores(spark.createDataFrame(scores, f"{schema}, polarity string"), path)
    back = spark.read.schema(f"{schema}, polarity string").option("header", True).csv(path)
    assert rows(back) == [("bad", 3.5, 7, "negative"), ("good", 9.5, 10, "positive")]


ADDRESSES = ["Via Roma 1 Milan", "Milano Road, London", "Parisian Way 3", "", "Lo", None, "a" * 50, "São Paulo", "漢字 Tokyo", "Via Roma 1 Milan"]


@pytest.mark.parametrize("gram", [1, 2, 4, 9])
@pytest.mark.parametrize("max_bytes", [0, 1 << 25])
def test_reviews_by_listed_city(spark, gram, max_bytes):
    names = ["Milan", "Milano", "Lo", "L", "", "Paris", "paris", "Rome", "São Paulo", "漢", None, "aaaa", "Via Roma 1 Milan!", "Milan", "n"]
    df = spark.createDataFrame(list(enumerate(ADDRESSES)), "id int, Hotel_Address string").withColumn("city_of", F.lit(1))
    cities = spark.createDataFrame([(name,) for name in names], "city string")
    want = [(i, text, 1, name) for i, text in enumerate(ADDRESSES) if text is not None for name in {n for n in names if n is not None} if name in text]
    got = prepare.reviews_by_listed_city(df, cities, gram=gram, max_bytes=max_bytes)
    assert got.columns == [*df.columns, "city"] and rows(got) == sorted(want, key=repr)


def test_no_address_is_held_against_all_names(spark, monkeypatch):
    joined, join = [], prepare.join_lookup
    monkeypatch.setattr(prepare, "join_lookup", lambda *args, **how: joined.append(join(*args, **how)) or joined[-1])
    cities = spark.range(10_000).select(F.concat(F.lit("City of "), F.sha2(F.col("id").cast("string"), 256)).alias("city"))
    df = spark.range(300).select(F.concat(F.lit("1 Main Road, City of "), F.sha2((F.col("id") * 7).cast("string"), 256)).alias("Hotel_Address"))
    found = prepare.cities_in_addresses(df, cities)
    assert found.count() == 300
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert joined[-1].count() < 10 * 300  # what meets on a key


def test_no_city_or_no_address(spark):
    cities, df = spark.createDataFrame([("a",)], "city string"), spark.createDataFrame([("a",)], "Hotel_Address string")
    assert prepare.reviews_by_listed_city(df, cities.filter("false")).count() == 0
    assert prepare.reviews_by_listed_city(df.filter("false"), cities).count() == 0


def large_gazetteer(spark, tmp_path):
    """More than the limit as rows, little as Parquet."""
    path = str(tmp_path / "gazetteer")
    place = spark.range(600_000).select(F.concat(F.lit("address "), "id").alias("address"), F.lit(1.0).alias("g_lat"), F.lit(2.0).alias("g_lng"))
    place.write.parquet(path)
    return spark.read.parquet(path)


def test_large_gazetteer_is_not_broadcast(spark, tmp_path):
    gazetteer = large_gazetteer(spark, tmp_path)
    df = spark.createDataFrame([("address 5", None, 9.0), ("address 6", 3.0, 4.0), ("nowhere", None, None)], "Hotel_Address string, lat double, lng double")
    located = prepare.located_addresses(prepare.addresses_without_coordinates(df), gazetteer)
    assert rows(located) == [("address 5", 1.0, 2.0), ("nowhere", None, None)]
    assert "BroadcastHashJoin" not in located._jdf.queryExecution().executedPlan().toString()
    filled = prepare.fill_coordinates(df, gazetteer)
    assert rows(filled) == [("address 5", 1.0, 9.0), ("address 6", 3.0, 4.0), ("nowhere", None, None)]


def test_landing_writes_small_compressed_files(spark):
    """The file on the way has every row, in less than half of its bytes."""
    import glob
    import gzip
    import os

    from conftest import SMALL

    from __spark_entry__ import queries
    from guestbook import shared

    with shared.scope(spark):
        assert queries()["s1_review_csv_landing"](spark, SMALL).count() == 6000
        (folder,) = shared._WRITTEN[spark.sparkContext.applicationId]
        files = glob.glob(f"{folder.removeprefix('file:')}/csv/part-*.csv.gz")
        texts = [gzip.open(name).read() for name in files]
        assert sum(text.count(b"\n") - 1 for text in texts) == 6000
        assert 2 * sum(map(os.path.getsize, files)) < sum(map(len, texts))


INTEGERS = {
    "7": 7, "7.0": 7, " 7 ": 7, "7\x7f": 7, "\x007": 7, "+7": 7, "-7.9": -7, "2147483647": 2147483647, "2147483648": None, "99999999999": None,
    "1e3": 1000, "1e10": None, "NaN": None, "Infinity": None, "7d": 7, "": None, "many": None, "1,403": None, "٣": None, "+": None, "5.": 5,
}
DATES = {
    "8/3/2017": "2017-08-03", "08/03/2017": "2017-08-03", "008/003/2017": "2017-08-03", "2/29/2016": "2016-02-29", "2/29/2015": None, "13/45/2017": None,
    "12/31/9999": "9999-12-31", "8/3/17": None, "8/3/2017 ": None, "8/3/2017 0:00": None, "8/3/-2017": "-2017-08-03", "0/3/2017": None, "8/32/2017": None, "": None,
}
TAGS = {"[' A ', ' B ']": ["A", "B"], "[]": [""], "[' Couple's [x] ', ' b']": ["Couples x", "b"], ", ,": ["", ","], "a ,b": ["a ,b"], "a, ": ["a", ""]}


def test_odd_fields_read_as_before(spark):
    def read(cases, function):
        df = spark.createDataFrame([(i, text) for i, text in enumerate([*cases, None])], "i int, x string")
        return [r[0] for r in df.orderBy("i").select(function(F.col("x"))).collect()]

    assert read(INTEGERS, parsing.whole_number) == [*INTEGERS.values(), None]
    assert read(DATES, lambda x: parsing.us_date(x).cast("string")) == [*DATES.values(), None]
    assert read(["12 days", "a1b2", "long ago", ""], parsing.first_number) == [12, 1, None, None, None]
    assert read(TAGS, parsing.tag_list) == [*TAGS.values(), None]


@pytest.mark.parametrize(
    ("function", "good", "bad"),
    [(parsing.whole_number, "7", "7.0"), (parsing.first_number, "12 days", "long ago"), (parsing.us_date, "8/3/2017", "13/45/2017")],
)
def test_malformed_fields_take_no_longer(spark, function, good, bad):
    """Of many times as long, which an exception for every field takes."""

    def seconds(text):
        raw = F.when(F.col("id") >= 0, text).otherwise(F.col("id").cast("string"))
        df = spark.range(0, 1_000_000, 1, 4).select(function(raw).alias("x"))
        taken = []
        for _ in range(2):
            start = time.perf_counter()
            df.write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        return min(taken)

    assert seconds(bad) < 2 * seconds(good) + 0.3
