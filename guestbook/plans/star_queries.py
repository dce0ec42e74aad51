"""Queries on the star relation: preparation, quality, tags, scores and places."""

from __future__ import annotations

from pyspark.sql import functions as F

from guestbook.functions import labels, parsing
from guestbook.functions.fixed_values import ADDRESS_REPAIRS
from guestbook.operators import geo, prepare, quality, scores, tags
from guestbook.plans.registry import plain, query, rounded
from guestbook.plans.relations import (
    GAZETTEER_SQL,
    STAR,
    STAR_KEY,
    gazetteer,
    poi_values_sql,
    reviews,
    star_sql,
    table,
)
from guestbook.schema import REVIEW_COLUMNS
from guestbook.shared import new_table_path
from guestbook.sources import land_reviews, points_of_interest, read_poi_csv

KEY = ", ".join(STAR_KEY)
NEWEST = f"Review_Date desc, {KEY}"
TAG_LIST = "list_transform(string_split(regexp_replace(Tags_Raw, '[\\[\\]'']', '', 'g'), ', '), lambda x: trim(x))"
DUOMO = (45.464098, 9.191926)


def star(*columns: str) -> str:
    """``with r as (...)`` over the given star columns, in the oracle's SQL."""
    return f"with r as ({star_sql(columns, 'varchar')})"


def distance_sql(lat1: str, lng1: str, lat2: str, lng2: str) -> str:
    return (
        f"(2 * cast(6371000 as double) * asin(sqrt(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2)"
        f" + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin((radians({lng2}) - radians({lng1})) / 2), 2))))"
    )


FROM_DUOMO = distance_sql("lat", "lng", *[f"cast({x!r} as double)" for x in DUOMO])
BAND = (
    "case when distance <= 500 then 'Entro 500 metri' when distance <= 1000 then 'Tra 500 e 1000 metri'"
    " when distance <= 2000 then 'Tra 1000 e 2000 metri' end"
)
GAZETTEER = GAZETTEER_SQL.replace("{S}", "varchar").format(supplier="supplier", nation="nation", region="region")
REPAIRED = "Hotel_Address"
for _wrong, _right in ADDRESS_REPAIRS:
    REPAIRED = f"replace({REPAIRED}, '{_wrong}', '{_right}')"


# --- sources and preparation ---------------------------------------------------------------------------


def raw_reviews(spark, sf_dir):
    """All raw text columns of a review file, with some malformed fields."""
    df = reviews(
        spark, sf_dir, "Hotel_Address", "Review_Date_Raw", "Hotel_Name", "Reviewer_Nationality", "Negative_Review",
        "Review_Total_Negative_Word_Counts", "Positive_Review", "Review_Total_Positive_Word_Counts",
        "Reviewer_Score_Raw", "Tags_Raw", "days_since_review_raw", "lat", "lng", *STAR_KEY,
    )
    bad_date = F.when(F.col("l_linenumber") == 6, "13/45/2017").otherwise(F.col("Review_Date_Raw"))
    text = {
        "Additional_Number_of_Scoring": F.col("l_linenumber").cast("string"),
        "Review_Date": bad_date,
        "Average_Score": F.lit("8.5"),
        "Total_Number_of_Reviews": F.concat(F.col("l_partkey"), F.when(F.col("l_linenumber") == 5, ".0").otherwise("")),
        "Total_Number_of_Reviews_Reviewer_Has_Given": F.when(F.col("l_linenumber") == 2, "many").otherwise(
            F.col("l_linenumber").cast("string")
        ),
        "Reviewer_Score": F.col("Reviewer_Score_Raw"),
        "Tags": F.col("Tags_Raw"),
        "days_since_review": F.col("days_since_review_raw"),
        "lat": F.coalesce(F.col("lat").cast("string"), F.lit("NA")),
        "lng": F.coalesce(F.col("lng").cast("string"), F.lit("NA")),
    }
    columns = [text.get(name, F.col(name)).cast("string").alias(name) for name in REVIEW_COLUMNS]
    return df.select(*columns, *STAR_KEY)


TYPED_FIELDS = f"""
  Hotel_Address, l_linenumber as Additional_Number_of_Scoring,
  case when l_linenumber = 6 then null else cast(Review_Date as varchar) end as Review_Date,
  cast(8.5 as double) as Average_Score, Hotel_Name, Reviewer_Nationality, Negative_Review,
  Review_Total_Negative_Word_Counts, cast(l_partkey as integer) as Total_Number_of_Reviews, Positive_Review,
  Review_Total_Positive_Word_Counts,
  case when l_linenumber = 2 then null else l_linenumber end as Total_Number_of_Reviews_Reviewer_Has_Given,
  cast(case when Reviewer_Score_Raw = 'NA' then null else Reviewer_Score_Raw end as double) as Reviewer_Score,
  cast(to_json({TAG_LIST}) as varchar) as Tags, l_linenumber as days_since_review, lat, lng"""

RAW_SQL = star(
    "Hotel_Address", "Review_Date", "Hotel_Name", "Reviewer_Nationality", "Negative_Review",
    "Review_Total_Negative_Word_Counts", "Positive_Review", "Review_Total_Positive_Word_Counts",
    "Reviewer_Score_Raw", "Tags_Raw", "lat", "lng", *STAR_KEY,
)


@query("s1_review_csv_landing", f"{RAW_SQL} select {TYPED_FIELDS} from r")
def _(spark, sf_dir):
    folder = new_table_path(spark, "landing")
    raw = raw_reviews(spark, sf_dir).select(*REVIEW_COLUMNS)
    # Small files, since a compressed one is read by one task.
    raw.write.option("header", True).option("compression", "gzip").option("maxRecordsPerFile", 1 << 16).option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(f"{folder}/csv")
    return plain(land_reviews(spark, f"{folder}/csv", f"{folder}/parquet").drop("review_id"))


@query(
    "s2_poi_csv",
    f"""{star("Hotel_Name", "lat", "lng")}, e as (select distinct Hotel_Name, lat, lng from r),
    poi as ({poi_values_sql()})
    select Monument, City, count(*) as entities
    from e join poi on {distance_sql("lat", "lng", "poi_lat", "poi_lng")} <= 2000 group by Monument, City""",
)
def _(spark, sf_dir):
    path = new_table_path(spark, "poi")
    points_of_interest(spark).write.option("header", True).option("sep", ";").csv(path)
    near = geo.entities_near_points(reviews(spark, sf_dir, "Hotel_Name", "lat", "lng"), read_poi_csv(spark, path))
    return near.groupBy("Monument", "City").agg(F.count("*").alias("entities"))


@query("p1_typed_projection", f"{RAW_SQL} select {TYPED_FIELDS}, l_orderkey, l_partkey from r")
def _(spark, sf_dir):
    return plain(prepare.typed_reviews(raw_reviews(spark, sf_dir)).drop("l_linenumber"))


@query(
    "p2_review_dates",
    f"""{star("Review_Date", "l_linenumber")}
    select case when l_linenumber = 6 then null else cast(Review_Date as varchar) end as Review_Date,
    count(*) as reviews from r group by 1""",
)
def _(spark, sf_dir):
    df = reviews(spark, sf_dir, "Review_Date_Raw", "l_linenumber")
    raw = F.when(F.col("l_linenumber") == 6, "13/45/2017").otherwise(F.col("Review_Date_Raw"))
    return plain(df.groupBy(parsing.us_date(raw).alias("Review_Date")).agg(F.count("*").alias("reviews")))


@query(
    "p3_days_since_review",
    f"""{star("l_linenumber")}
    select case when l_linenumber = 4 then null else l_linenumber end as days_since_review, count(*) as reviews
    from r group by 1""",
)
def _(spark, sf_dir):
    df = reviews(spark, sf_dir, "days_since_review_raw", "l_linenumber")
    raw = F.when(F.col("l_linenumber") == 4, "long ago").otherwise(F.col("days_since_review_raw"))
    return df.groupBy(parsing.first_number(raw).alias("days_since_review")).agg(F.count("*").alias("reviews"))


@query("p4_tag_lists", f"{star('Tags_Raw', *STAR_KEY)} select {KEY}, cast(to_json({TAG_LIST}) as varchar) as Tags from r")
def _(spark, sf_dir):
    return plain(reviews(spark, sf_dir, *STAR_KEY, "Tags"))


@query(
    "p5_known_nationality",
    f"{star('Reviewer_Nationality', *STAR_KEY)} select * from r where Reviewer_Nationality <> ' '",
)
def _(spark, sf_dir):
    return prepare.with_known_nationality(reviews(spark, sf_dir, "Reviewer_Nationality", *STAR_KEY))


@query(
    "p6_addresses_without_coordinates",
    f"{star('Hotel_Address', 'lat', 'lng')} select distinct Hotel_Address from r where lat is null or lng is null",
)
def _(spark, sf_dir):
    return prepare.addresses_without_coordinates(reviews(spark, sf_dir, "Hotel_Address", "lat", "lng"))


@query(
    "p7_repaired_addresses",
    f"{star('Hotel_Address')} select distinct Hotel_Address, {REPAIRED} as repaired from r",
)
def _(spark, sf_dir):
    addresses = reviews(spark, sf_dir, "Hotel_Address").distinct()
    return addresses.withColumn("repaired", parsing.repaired_address(F.col("Hotel_Address")))


@query(
    "p8_located_addresses",
    f"""{star("Hotel_Address", "lat", "lng")}, g as ({GAZETTEER})
    select Hotel_Address, g_lat as lat_f, g_lng as lng_f
    from (select distinct Hotel_Address from r where lat is null or lng is null) a
    left join g on g.address = {REPAIRED}""",
)
def _(spark, sf_dir):
    df = reviews(spark, sf_dir, "Hotel_Address", "lat", "lng")
    return prepare.located_addresses(prepare.addresses_without_coordinates(df), gazetteer(spark, sf_dir))


FILLED_SQL = f"""{star("Hotel_Name", "Hotel_Address", "lat", "lng", *STAR_KEY)}, g as ({GAZETTEER})
    select Hotel_Name, Hotel_Address, coalesce(lat, g_lat) as lat, coalesce(lng, g_lng) as lng, {KEY}
    from r left join g on g.address = {REPAIRED}"""


@query("p9_filled_coordinates", FILLED_SQL)
def _(spark, sf_dir):
    df = reviews(spark, sf_dir, "Hotel_Name", "Hotel_Address", "lat", "lng", *STAR_KEY)
    return prepare.fill_coordinates(df, gazetteer(spark, sf_dir))


@query("p9_filled_coordinates_large_gazetteer", FILLED_SQL)
def _(spark, sf_dir):
    df = reviews(spark, sf_dir, "Hotel_Name", "Hotel_Address", "lat", "lng", *STAR_KEY)
    return prepare.fill_coordinates(df, gazetteer(spark, sf_dir), max_bytes=0)


@query(
    "p11_reviews_in_city",
    f"{star('Hotel_Address', 'Reviewer_Score', *STAR_KEY)} select * from r where contains(Hotel_Address, 'AFRICA')",
)
def _(spark, sf_dir):
    return prepare.reviews_in_city(reviews(spark, sf_dir, "Hotel_Address", "Reviewer_Score", *STAR_KEY), "AFRICA")


@query(
    "p11_reviews_by_city",
    f"""{star("Hotel_Address", "Reviewer_Score")}
    select city, count(*) as reviews, avg(Reviewer_Score) as avg_score
    from r join (values ('AFRICA'), ('ASIA'), ('EUROPE'), ('A')) as t(city) on contains(Hotel_Address, city)
    group by city""",
)
def _(spark, sf_dir):
    df = reviews(spark, sf_dir, "Hotel_Address", "Reviewer_Score")
    placed = prepare.reviews_by_city(df, ("AFRICA", "ASIA", "EUROPE", "A"))
    return placed.groupBy("city").agg(F.count("*").alias("reviews"), F.avg("Reviewer_Score").alias("avg_score"))


# --- data quality --------------------------------------------------------------------------------------

QUALITY = ("Hotel_Name", "Hotel_Address", "Reviewer_Nationality", "Tags_Raw", "Reviewer_Score", "lat", "lng")


def _per_column(names: tuple[str, ...], measures: str) -> str:
    return " union all ".join(f"select '{n}' as column_name, {measures.replace('?', n)} from r" for n in names)


@query(
    "dq1_blank_counts",
    f"{star(*QUALITY)} " + _per_column(QUALITY[:4], "count(*) filter (where ? is null or ? = ' ') as blank_count"),
)
def _(spark, sf_dir):
    return quality.blank_counts(reviews(spark, sf_dir, *QUALITY))


@query(
    "dq2_presence_counts",
    f"{star(*QUALITY)} " + _per_column(QUALITY, "count(?) as non_null_count, count(*) - count(?) as missing_count"),
)
def _(spark, sf_dir):
    return quality.presence_counts(reviews(spark, sf_dir, *QUALITY))


@query("dq3_null_counts", f"{star(*QUALITY)} " + _per_column(QUALITY, "count(*) filter (where ? is null) as null_count"))
def _(spark, sf_dir):
    return quality.null_counts(reviews(spark, sf_dir, *QUALITY))


@query(
    "dq4_out_of_range_coordinates",
    f"""{star("lat", "lng", *STAR_KEY)},
    b as (select case when l_linenumber = 7 then lat + 100 else lat end as lat,
      case when l_linenumber = 1 then lng - 200 else lng end as lng, {KEY} from r)
    select * from b where lat < -90 or lat > 90 or lng < -180 or lng > 180""",
)
def _(spark, sf_dir):
    df = reviews(spark, sf_dir, "lat", "lng", *STAR_KEY)
    line = F.col("l_linenumber")
    broken = df.withColumn("lat", F.when(line == 7, F.col("lat") + 100).otherwise(F.col("lat"))).withColumn(
        "lng", F.when(line == 1, F.col("lng") - 200).otherwise(F.col("lng"))
    )
    return quality.out_of_range_coordinates(broken)


# --- tags ----------------------------------------------------------------------------------------------

TAG_ROWS = f"{star('Reviewer_Score', 'Tags_Raw')}, t as (select Reviewer_Score, unnest({TAG_LIST}) as tag from r)"
TAG_SCORES = "select tag, avg(Reviewer_Score) as avg_score, count(*) as tag_count from t group by tag"


@query("q2_tag_influence", f"{TAG_ROWS} {TAG_SCORES} having count(*) >= 1000")
def _(spark, sf_dir):
    return tags.tag_influence(reviews(spark, sf_dir, "Reviewer_Score", "Tags"))


@query("q2b_best_tags", f"{TAG_ROWS} {TAG_SCORES} having count(*) >= 100 order by avg_score desc, tag limit 10")
def _(spark, sf_dir):
    return tags.best_tags(reviews(spark, sf_dir, "Reviewer_Score", "Tags"), min_count=100)


@query("q2b_worst_tags", f"{TAG_ROWS} {TAG_SCORES} having count(*) >= 100 order by avg_score, tag limit 10")
def _(spark, sf_dir):
    return tags.worst_tags(reviews(spark, sf_dir, "Reviewer_Score", "Tags"), min_count=100)


@query(
    "q11_entities_with_tag",
    f"""{star("Hotel_Name", "Hotel_Address", "Reviewer_Score", "Tags_Raw")}
    select Hotel_Name, Hotel_Address, avg(Reviewer_Score) as avg_score from r
    where contains(Hotel_Address, 'AFRICA') and list_contains({TAG_LIST}, 'ECONOMY') group by 1, 2""",
)
def _(spark, sf_dir):
    df = reviews(spark, sf_dir, "Hotel_Name", "Hotel_Address", "Reviewer_Score", "Tags")
    return tags.entities_with_tag(df, "AFRICA", "ECONOMY")


@query("q14_most_used_tags", f"{TAG_ROWS} select tag from t group by tag order by count(*) desc, tag")
def _(spark, sf_dir):
    return tags.most_used_tags(reviews(spark, sf_dir, "Tags"))


@query(
    "q14b_tag_share",
    f"""{star("Hotel_Address", "Tags_Raw")},
    t as (select unnest({TAG_LIST}) as tag from r where contains(Hotel_Address, 'AFRICA')),
    n as (select tag, count(*) as n, row_number() over (order by count(*) desc, tag) as place from t group by tag)
    select tag, n as count from n where place <= 10
    union all
    select 'Other' as tag, cast(sum(n) as bigint) as count from n where place > 10 having sum(n) > 0""",
)
def _(spark, sf_dir):
    return tags.tag_share(reviews(spark, sf_dir, "Hotel_Address", "Tags"), "AFRICA")


# --- scores --------------------------------------------------------------------------------------------


@query(
    "q3_review_length",
    f"""{star("Reviewer_Score", "Review_Total_Positive_Word_Counts", "Review_Total_Negative_Word_Counts")}
    select Reviewer_Score, avg(Review_Total_Positive_Word_Counts) as avg_positive_length,
      avg(Review_Total_Negative_Word_Counts) as avg_negative_length
    from r where Review_Total_Positive_Word_Counts > 0 or Review_Total_Negative_Word_Counts > 0 group by 1""",
)
def _(spark, sf_dir):
    return scores.review_length(
        reviews(
            spark, sf_dir, "Reviewer_Score", "Review_Total_Positive_Word_Counts", "Review_Total_Negative_Word_Counts"
        )
    )


DATED = ("Hotel_Name", "Reviewer_Score", "Review_Date", *STAR_KEY)
REPUTATION = f"""{star(*DATED)},
    n as (select *, row_number() over (partition by Hotel_Name order by {NEWEST}) as place from r),
    m as (select Hotel_Name, avg(Reviewer_Score) as avg_historical_score,
      avg(case when place <= 30 then Reviewer_Score end) as avg_recent_score from n group by Hotel_Name),
    rep as (select *, avg_recent_score - avg_historical_score as score_difference from m)"""
ONE_ENTITY = "Supplier#000000007"


@query("q4_reputation", f"{REPUTATION} select * from rep")
def _(spark, sf_dir):
    return scores.reputation(reviews(spark, sf_dir, *DATED), c=STAR)


@query("q4_reputation_of_many_recent", f"{REPUTATION.replace('place <= 30', 'place <= 2000')} select * from rep")
def _(spark, sf_dir):
    return scores.reputation(reviews(spark, sf_dir, *DATED), recent_reviews=2000, c=STAR)


@query(
    "q4_moving_reputation",
    f"""{star(*DATED)} select {KEY}, Hotel_Name, Reviewer_Score, avg(Reviewer_Score) over (partition by Hotel_Name
      order by {NEWEST} rows between current row and 29 following) as avg_recent_score from r""",
)
def _(spark, sf_dir):
    return scores.moving_reputation(reviews(spark, sf_dir, *DATED), c=STAR).drop("Review_Date")


@query(
    "q4_moving_reputation_of_many_recent",
    f"""{star(*DATED)} select {KEY}, Hotel_Name, Reviewer_Score, avg(Reviewer_Score) over (partition by Hotel_Name
      order by {NEWEST} rows between current row and 1999 following) as avg_recent_score from r""",
)
def _(spark, sf_dir):
    return scores.moving_reputation(reviews(spark, sf_dir, *DATED), recent_reviews=2000, c=STAR).drop("Review_Date")


@query("q4s_entity_reputation", f"{REPUTATION} select * from rep where Hotel_Name = '{ONE_ENTITY}'")
def _(spark, sf_dir):
    return scores.entity_reputation(reviews(spark, sf_dir, *DATED), ONE_ENTITY, c=STAR)


@query(
    "q4t_reputation_trend",
    f"""{REPUTATION} select Hotel_Name, case when round(score_difference, 5) > 0 then 'L''hotel sta migliorando'
    else 'L''hotel sta peggiorando' end as trend from rep""",
)
def _(spark, sf_dir):
    return scores.with_trend(scores.reputation(reviews(spark, sf_dir, *DATED), c=STAR)).select("Hotel_Name", "trend")


@query(
    "q5b_seasons",
    f"""{star("Hotel_Name", "Hotel_Address", "Review_Date", "Reviewer_Score")}
    select Hotel_Name, Hotel_Address, case when month(Review_Date) in (12, 1, 2) then 'Winter'
      when month(Review_Date) in (3, 4, 5) then 'Spring' when month(Review_Date) in (6, 7, 8) then 'Summer'
      else 'Autumn' end as Season, avg(Reviewer_Score) as avg_reviewer_score, count(*) as review_count
    from r group by 1, 2, 3""",
)
def _(spark, sf_dir):
    df = reviews(spark, sf_dir, "Hotel_Name", "Hotel_Address", "Review_Date", "Reviewer_Score")
    return df.groupBy("Hotel_Name", "Hotel_Address", labels.season(F.col("Review_Date")).alias("Season")).agg(
        F.avg("Reviewer_Score").alias("avg_reviewer_score"), F.count("*").alias("review_count")
    )


SCORED = ("Hotel_Name", "Reviewer_Score", "Positive_Review", "Negative_Review", *STAR_KEY)
ANOMALIES = f"""{star(*SCORED)},
    m as (select Hotel_Name, avg(Reviewer_Score) as Avg_Score, stddev_samp(Reviewer_Score) as dev from r group by 1),
    a as (select r.*, Avg_Score from r join m using (Hotel_Name) where abs(Reviewer_Score - Avg_Score) > 2 * dev)"""


@query("q6_anomalies", f"{ANOMALIES} select * from a")
def _(spark, sf_dir):
    return scores.anomalies(reviews(spark, sf_dir, *SCORED), STAR)


@query("q6_anomalies_many_entities", f"{ANOMALIES} select * from a")
def _(spark, sf_dir):
    return scores.anomalies(reviews(spark, sf_dir, *SCORED), STAR, max_bytes=0)


@query(
    "q6_entity_anomalies",
    f"""{ANOMALIES} select Reviewer_Score, Avg_Score, Positive_Review, Negative_Review from a
    where Hotel_Name = '{ONE_ENTITY}'""",
)
def _(spark, sf_dir):
    return scores.entity_anomalies(reviews(spark, sf_dir, *SCORED), ONE_ENTITY, STAR)


MONTHLY = "select Hotel_Name, strftime(Review_Date, '%Y-%m') as YearMonth, avg(Reviewer_Score) as Average_Score"
MONTH_COLUMNS = ("Hotel_Name", "Review_Date", "Reviewer_Score")


@query("q7_monthly_trend", f"{star(*MONTH_COLUMNS)} {MONTHLY} from r group by 1, 2")
def _(spark, sf_dir):
    return scores.monthly_trend(reviews(spark, sf_dir, *MONTH_COLUMNS))


@query("q7_entity_monthly_trend", f"{star(*MONTH_COLUMNS)} {MONTHLY} from r where Hotel_Name = '{ONE_ENTITY}' group by 1, 2")
def _(spark, sf_dir):
    return scores.monthly_trend(scores.of_entity(reviews(spark, sf_dir, *MONTH_COLUMNS), ONE_ENTITY))


STATISTICS = f"""{star("Hotel_Name", "Reviewer_Score", "lat", "lng")},
    st as (select Hotel_Name, count(*) as Total_Reviews,
      count(*) filter (where Reviewer_Score >= 6) as Total_Positive_Reviews,
      count(*) filter (where Reviewer_Score < 6) as Total_Negative_Reviews,
      max(Reviewer_Score) as Max_Reviewer_Score, min(Reviewer_Score) as Min_Reviewer_Score,
      avg(Reviewer_Score) as Avg_Reviewer_Score, min(lat) as Latitude, min(lng) as Longitude from r group by 1)"""


@query("q8_entity_statistics", f"{STATISTICS} select * from st")
def entity_statistics(spark, sf_dir):
    return scores.entity_statistics(reviews(spark, sf_dir, "Hotel_Name", "Reviewer_Score", "lat", "lng"))


@query("q8b_one_entity_statistics", f"{STATISTICS} select * from st where Hotel_Name = '{ONE_ENTITY}'")
def _(spark, sf_dir):
    return scores.of_entity(entity_statistics(spark, sf_dir), ONE_ENTITY)


@query(
    "q15_nationality_counts",
    f"""{star("Reviewer_Nationality")} select Reviewer_Nationality, count(*) as review_count from r
    where Reviewer_Nationality <> ' ' group by 1 having count(*) >= 200""",
)
def _(spark, sf_dir):
    df = prepare.with_known_nationality(reviews(spark, sf_dir, "Reviewer_Nationality"))
    return scores.nationality_counts(df, 200)


NATIONALITY = (
    "Hotel_Name", "Review_Date", "Reviewer_Nationality", "Reviewer_Score", "Negative_Review",
    "Review_Total_Negative_Word_Counts", "Positive_Review", "Review_Total_Positive_Word_Counts",
)


@query(
    "q16_nationality_reviews",
    f"""{star(*NATIONALITY, "Tags_Raw")}
    select {", ".join(n for n in NATIONALITY if n != "Review_Date")}, cast(Review_Date as varchar) as Review_Date,
    cast(to_json({TAG_LIST}) as varchar) as Tags from r where Reviewer_Nationality = 'NATION_3'""",
)
def _(spark, sf_dir):
    return plain(scores.nationality_reviews(reviews(spark, sf_dir, *NATIONALITY, "Tags"), "NATION_3"))


@query(
    "q17_entity_locations",
    f"{star('Hotel_Name', 'Hotel_Address', 'lat', 'lng')} select distinct Hotel_Name, Hotel_Address, lat, lng from r",
)
def _(spark, sf_dir):
    return scores.entity_locations(reviews(spark, sf_dir, "Hotel_Name", "Hotel_Address", "lat", "lng"))


# --- places --------------------------------------------------------------------------------------------

PLACED = ("Hotel_Name", "lat", "lng")
NEAR = f"""{star(*PLACED)},
    near as (select * from (select *, {FROM_DUOMO} as distance from (select distinct Hotel_Name, lat, lng from r))
      where distance <= 2000)"""


@query(
    "q12_nearby_reviews",
    f"""{star(*PLACED, "Reviewer_Score", *STAR_KEY)}
    select * replace (round(distance, 6) as distance)
    from (select *, {FROM_DUOMO} as distance from r) where distance <= 1500""",
)
def _(spark, sf_dir):
    df = reviews(spark, sf_dir, *PLACED, "Reviewer_Score", *STAR_KEY)
    return rounded(geo.nearby_reviews(df, *DUOMO, 1500), "distance")


@query("q12b_nearby_entities", f"{NEAR} select * replace (round(distance, 6) as distance) from near")
def _(spark, sf_dir):
    return rounded(geo.nearby_entities(reviews(spark, sf_dir, *PLACED), *DUOMO), "distance")


@query("q12c_distance_bands", f"{NEAR} select Hotel_Name, {BAND} as band from near")
def _(spark, sf_dir):
    near = geo.nearby_entities(reviews(spark, sf_dir, *PLACED), *DUOMO)
    return geo.with_band(near).select("Hotel_Name", "band")


REPUTED_NEAR = f"""{REPUTATION.replace(star(*DATED), star(*DATED, "lat", "lng"))},
    near as (select distinct Hotel_Name, {FROM_DUOMO} as distance from r)
    select Hotel_Name, avg_historical_score, avg_recent_score, round(distance, 6) as distance
    from near join rep using (Hotel_Name) where distance <= 2000"""


@query("q12d_nearby_reputation", REPUTED_NEAR)
def _(spark, sf_dir):
    df = reviews(spark, sf_dir, *DATED, "lat", "lng")
    return rounded(geo.nearby_reputation(df, *DUOMO, c=STAR), "distance")


@query("q12d_nearby_reputation_many_entities", REPUTED_NEAR)
def _(spark, sf_dir):
    df = reviews(spark, sf_dir, *DATED, "lat", "lng")
    return rounded(geo.nearby_reputation(df, *DUOMO, c=STAR, max_bytes=0), "distance")


POINTS_NEAR = f"""{star(*PLACED)}, e as (select distinct Hotel_Name, lat, lng from r),
    poi as ({poi_values_sql()}),
    d as (select Monument, City, Hotel_Name, lat, lng, {distance_sql("lat", "lng", "poi_lat", "poi_lng")} as distance
      from e cross join poi)
    select * replace (round(distance, 6) as distance), {BAND} as band from d where distance <= 2000"""


@query("q12e_entities_near_points", POINTS_NEAR)
def _(spark, sf_dir):
    near = geo.entities_near_points(reviews(spark, sf_dir, *PLACED), points_of_interest(spark))
    return rounded(near, "distance")


@query("q12e_entities_near_points_shuffled", POINTS_NEAR)
def _(spark, sf_dir):
    near = geo.entities_near_points(reviews(spark, sf_dir, *PLACED), points_of_interest(spark), max_bytes=0)
    return rounded(near, "distance")


@query("q12e_points_of_a_city", f"{POINTS_NEAR} and City = 'Milan' and Monument = 'Bosco Verticale'")
def _(spark, sf_dir):
    poi = geo.point_named(geo.points_in_city(points_of_interest(spark), "Milan"), "Bosco Verticale")
    return rounded(geo.entities_near_points(reviews(spark, sf_dir, *PLACED), poi), "distance")


COMPARED = f"""{star(*PLACED, "Review_Date", "Reviewer_Score")},
    near as (select * from r where {FROM_DUOMO} <= 1000) {MONTHLY} from near
    where (select count(distinct Hotel_Name) from near) > 1 group by 1, 2"""


@query("q13_trend_of_nearby", COMPARED.replace("where (select count(distinct Hotel_Name) from near) > 1 ", ""))
def _(spark, sf_dir):
    df = reviews(spark, sf_dir, *PLACED, "Review_Date", "Reviewer_Score")
    return scores.monthly_trend(geo.nearby_reviews(df, *DUOMO, 1000))


@query("q13b_neighbour_trend", COMPARED)
def _(spark, sf_dir):
    return geo.neighbour_trend(reviews(spark, sf_dir, *PLACED, "Review_Date", "Reviewer_Score"), *DUOMO)


def neighbours_sql(metres: int) -> str:
    near = distance_sql("a.lat", "a.lng", "b.lat", "b.lng")
    return f"""{star(*PLACED)},
    e as (select distinct Hotel_Name, lat, lng from r where lat is not null and lng is not null)
    select a.*, exists (select 1 from e b where b.Hotel_Name <> a.Hotel_Name and {near} <= {metres}) as has_neighbours
    from e a"""


@query("q13b_neighbour_check", neighbours_sql(1000))
def _(spark, sf_dir):
    return geo.neighbour_check(reviews(spark, sf_dir, *PLACED))


@query("q13b_close_neighbour_check", neighbours_sql(150))
def _(spark, sf_dir):
    return geo.neighbour_check(reviews(spark, sf_dir, *PLACED), 150, max_bytes=0)


def surroundings_sql(metres: int) -> str:
    near = distance_sql("a.lat", "a.lng", "b.lat", "b.lng")
    return f"""{star(*PLACED, "Review_Date", "Reviewer_Score")},
    p as (select lat, lng, Hotel_Name, strftime(Review_Date, '%Y-%m') as YearMonth, sum(Reviewer_Score) as s, count(*) as n
      from r where lat is not null and lng is not null group by all),
    e as (select distinct Hotel_Name, lat, lng from p),
    a as (select a.Hotel_Name, a.lat, a.lng, b.YearMonth, sum(b.s) / sum(b.n) as surroundings_score,
        cast(sum(b.n) as bigint) as surroundings_reviews
      from e a join p b on {near} <= {metres}
      where exists (select 1 from e x where x.Hotel_Name <> a.Hotel_Name and {near.replace("b.", "x.")} <= {metres}) group by all)
    select a.*, p.s / p.n as own_score from a left join p on p.Hotel_Name = a.Hotel_Name and p.lat = a.lat and p.lng = a.lng
      and p.YearMonth = a.YearMonth"""


@query("q13b_surroundings_trend", surroundings_sql(1000))
def _(spark, sf_dir):
    return geo.surroundings_trend(reviews(spark, sf_dir, *PLACED, "Review_Date", "Reviewer_Score"))


@query("q13b_close_surroundings_trend", surroundings_sql(150))
def _(spark, sf_dir):
    return geo.surroundings_trend(reviews(spark, sf_dir, *PLACED, "Review_Date", "Reviewer_Score"), 150, max_bytes=0)


CITY_TABLE = "select r_name as city from region union select s_name from supplier union select right(s_name, 3) from supplier"


@query(
    "p11_reviews_by_city_table",
    f"""{star("Hotel_Address", "Reviewer_Score")}, cities as ({CITY_TABLE})
    select city, count(*) as reviews, avg(Reviewer_Score) as avg_score from r join cities on contains(Hotel_Address, city)
    group by city""",
)
def _(spark, sf_dir):
    names = {name: table(spark, sf_dir, name) for name in ("region", "supplier")}
    cities = spark.sql(CITY_TABLE.replace("from region", "from {region}").replace("from supplier", "from {supplier}"), **names)
    named = prepare.reviews_by_listed_city(reviews(spark, sf_dir, "Hotel_Address", "Reviewer_Score"), cities)
    return named.groupBy("city").agg(F.count("*").alias("reviews"), F.avg("Reviewer_Score").alias("avg_score"))
