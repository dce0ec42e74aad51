import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from guestbook.functions import labels
from guestbook.operators import scores, tags, words
from guestbook.schema import Columns

C = Columns(key=("id",))


def day(n):
    return datetime.date(2017, 1, 1) + datetime.timedelta(days=n)


@pytest.fixture
def reviews(spark):
    data = [("a", day(i % 7), 1.0 + i % 5, i) for i in range(40)] + [("b", day(0), 4.0, 100), ("b", None, None, 101)]
    data += [(None, day(1), 2.0, 200)]
    return spark.createDataFrame(data, "Hotel_Name string, Review_Date date, Reviewer_Score double, id int")


def test_reputation(reviews):
    got = {r.Hotel_Name: r for r in scores.reputation(reviews, 5, C).collect()}
    newest = sorted(((-(i % 7), i) for i in range(40)))[:5]
    assert got["a"].avg_recent_score == sum(1.0 + i % 5 for _, i in newest) / 5
    assert got["a"].avg_historical_score == 3.0
    assert got["b"].score_difference == 0.0
    assert got[None].avg_recent_score == 2.0


def test_reputation_over_everything_has_no_difference(reviews):
    assert {r.score_difference for r in scores.reputation(reviews, 100, C).collect()} == {0.0}


def test_entity_reputation(reviews):
    assert scores.entity_reputation(reviews, "a", 5, C).count() == 1
    assert scores.entity_reputation(reviews, "nobody", 5, C).count() == 0


def test_zero_difference_counts_as_worsening(spark):
    df = spark.createDataFrame([(0.1,), (0.0,), (0.000004,), (-1.0,)], "score_difference double")
    got = [r.trend.split()[-1] for r in scores.with_trend(df).collect()]
    assert got == ["migliorando", "peggiorando", "peggiorando", "peggiorando"]


@pytest.mark.parametrize("max_bytes", [1 << 20, 0])
def test_anomalies(spark, max_bytes):
    data = [("a", 9.0, i) for i in range(20)] + [("a", 1.0, 99), ("single", 5.0, 100), ("a", None, 101)]
    df = spark.createDataFrame(data, "Hotel_Name string, Reviewer_Score double, id int")
    assert rows(scores.anomalies(df, C, max_bytes).select("Hotel_Name", "Reviewer_Score", "id")) == [("a", 1.0, 99)]
    texts = df.withColumns({"Positive_Review": F.lit("p"), "Negative_Review": F.lit("n")})
    single = scores.entity_anomalies(texts, "a", C)
    assert single.columns == ["Reviewer_Score", "Avg_Score", "Positive_Review", "Negative_Review"]
    assert single.count() == 1


def test_statistics(spark):
    df = spark.createDataFrame(
        [("a", 6.0, None, 1.0), ("a", 5.9, 2.0, 3.0), ("a", None, 1.0, 3.0)],
        "Hotel_Name string, Reviewer_Score double, lat double, lng double",
    )
    row = scores.entity_statistics(df).first()
    assert (row.Total_Reviews, row.Total_Positive_Reviews, row.Total_Negative_Reviews) == (3, 1, 1)
    assert (row.Max_Reviewer_Score, row.Min_Reviewer_Score, row.Latitude, row.Longitude) == (6.0, 5.9, 1.0, 1.0)


def test_review_length_needs_words(spark):
    df = spark.createDataFrame(
        [(9.0, 3, 0), (9.0, 0, 0), (9.0, 1, None), (2.0, None, 4)],
        "Reviewer_Score double, Review_Total_Positive_Word_Counts int, Review_Total_Negative_Word_Counts int",
    )
    assert [tuple(r) for r in scores.review_length(df).collect()] == [(2.0, None, 4.0), (9.0, 2.0, 0.0)]


def test_monthly_trend(reviews):
    got = scores.monthly_trend(scores.of_entity(reviews, "a")).collect()
    assert [tuple(r) for r in got] == [("a", "2017-01", 3.0)]


def test_seasons(spark):
    df = spark.createDataFrame([(datetime.date(2017, m, 1),) for m in range(1, 13)] + [(None,)], "d date")
    got = [r[0] for r in df.select(labels.season(F.col("d"))).collect()]
    assert got == ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Autumn"] * 3 + ["Winter", None]


def test_nationalities(spark):
    df = spark.createDataFrame([("x",), ("x",), ("y",)], "Reviewer_Nationality string")
    assert rows(scores.nationality_counts(df)) == [("x", 2), ("y", 1)]
    assert rows(scores.nationality_counts(df, 2)) == [("x", 2)]


TAGGED = "Hotel_Name string, Hotel_Address string, Reviewer_Score double, Tags array<string>"


@pytest.fixture
def tagged(spark):
    data = [
        ("a", "Milan", 8.0, ["x", "y"]),
        ("a", "Milan", 6.0, ["x", None]),
        ("b", "Paris", 2.0, ["y", "z"]),
        ("b", "Milan", 4.0, None),
    ]
    return spark.createDataFrame(data, TAGGED)


def test_tags(tagged):
    assert [tuple(r) for r in tags.tag_influence(tagged, 2).collect()] == [("x", 7.0, 2), ("y", 5.0, 2)]
    assert [r.tag for r in tags.best_tags(tagged, 1, 1).collect()] == ["x"]
    assert [r.tag for r in tags.worst_tags(tagged, 1, 1).collect()] == ["z"]
    assert [r.tag for r in tags.most_used_tags(tagged).collect()][:2] == ["x", "y"]
    assert rows(tags.entities_with_tag(tagged, "Milan", "y")) == [("a", "Milan", 8.0)]


def test_tag_share(spark, tagged):
    many = spark.createDataFrame(
        [("a", "Milan", 1.0, [f"t{i}" for i in range(12)]), ("a", "Milan", 1.0, ["Other", "t0"])], TAGGED
    )
    share = [tuple(r) for r in tags.tag_share(many, "Milan").collect()]
    assert sum(n for _, n in share) == 14 and len(share) == 11 and ("t0", 2) in share
    assert share.count(("Other", 1)) == 1 and share.count(("Other", 3)) == 1
    assert [r.tag for r in tags.tag_share(tagged, "Milan").collect() if r.tag == "Other"] == []


LEXICON = [("good", "a"), ("good", "n"), ("well", "r"), ("fresh", "s"), ("room", "n"), ("bad", "a")]


def test_words(spark):
    df = spark.createDataFrame(
        [(9.0, " Good  room\tWELL", "bad BAD"), (7.0, "good fresh", None), (1.0, None, "bad room")],
        "Reviewer_Score double, Positive_Review string, Negative_Review string",
    )
    lexicon = spark.createDataFrame(LEXICON, "word string, pos string")
    assert [tuple(r) for r in words.positive_words(df, lexicon, 1).collect()] == [("well", 9.0, 1), ("good", 8.0, 2)]
    assert [tuple(r) for r in words.negative_words(df, lexicon, 2).collect()] == [("bad", 19 / 3, 3)]
    assert rows(words.word_scores(df, lexicon, 2)) == [("negative", "bad", 19 / 3, 3), ("positive", "good", 8.0, 2)]
    assert rows(words.top_words(df, lexicon, 1, 1).select("polarity", "word")) == [("negative", "bad"), ("positive", "well")]


@pytest.fixture
def hot(spark):
    """An entity with a third of the rows, many small ones, equal dates, missing scores, dates and names."""
    data = [("hot" if i % 3 == 0 else f"e{i % 61}", day(i * 37 % 11), 1.0 + i % 9 if i % 13 else None, i) for i in range(3000)]
    data += [("hot", None, 5.0, 9000 + i) for i in range(5)] + [(None, day(1), 2.0, 9100), (None, day(2), 3.0, 9101)]
    schema = "Hotel_Name string, Review_Date date, Reviewer_Score double, id int"
    return data, spark.createDataFrame(data, schema).repartition(6)


def moving(data, n):
    groups, out = {}, []
    for row in data:
        groups.setdefault(row[0], []).append(row)
    for name, group in groups.items():
        group.sort(key=lambda row: (row[1] is None, -row[1].toordinal() if row[1] else 0, row[3]))
        for k, row in enumerate(group):
            held = [score for _, _, score, _ in group[k : k + n] if score is not None]
            out.append((name, row[1], row[2], row[3], sum(held) / len(held) if held else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("partitions, n", [(1, 30), (4, 1), (7, 30), (40, 30), (40, 700), (5, 100_000)])
def test_moving_reputation(spark, hot, partitions, n):
    data, df = hot
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert rows(scores.moving_reputation(df, n, C)) == moving(data, n)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_hot_entity_fills_many_windows(spark, hot, monkeypatch):
    from guestbook import shared

    written = []
    monkeypatch.setattr(scores, "settled", lambda df, name: written.append(shared.settled(df, name)) or written[-1])
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        scores.moving_reputation(hot[1], 30, C)
        parts = written[0].filter("Hotel_Name = 'hot'").groupBy("_part").count().collect()
        assert len(parts) >= 4 and max(row["count"] for row in parts) < 400
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_moving_reputation_of_nothing(hot):
    assert rows(scores.moving_reputation(hot[1].filter("false"), 30, C)) == []


def large_lexicon(spark, tmp_path):
    """More than the limit as rows, little as Parquet."""
    path = str(tmp_path / "lexicon")
    spark.range(700_000).select(F.concat(F.lit("w"), "id").alias("word"), F.lit("a").alias("pos")).write.parquet(path)
    return spark.read.parquet(path)


def test_large_lexicon_is_not_broadcast(spark, tmp_path):
    texts = [("w1 w2 w2 w999999999 good", "w3", 8.0), ("w1", "w3 bad", 6.0)]
    df = spark.createDataFrame(texts, "Positive_Review string, Negative_Review string, Reviewer_Score double")
    found = words.word_scores(df, large_lexicon(spark, tmp_path), 1)
    assert rows(found) == [("negative", "w3", 7.0, 2), ("positive", "w1", 7.0, 2), ("positive", "w2", 8.0, 2)]
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    small = words.word_scores(df, large_lexicon(spark, tmp_path / "again").limit(9), 1)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()


def test_inflected_words(spark):
    lexicon = spark.createDataFrame([("big", "a"), ("quick", "a"), ("nice", "a"), ("good", "a"), ("bett", "a"), ("fast", "r"), ("her", "n"), ("rest", "n"), ("h", "n"), ("well", "r"), ("clev", "r")], "word string, pos string")
    exceptions = spark.createDataFrame([("bigger", "big"), ("better", "good"), ("better", "well"), ("worser", "nothing"), (None, "good")], "form string, base string")
    names = ["big", "bigger", "quickest", "nicer", "nicest", "better", "faster", "clever", "her", "rest", "er", "est", "hotel", "worser", "quicker"]
    table = spark.createDataFrame([(name, i) for i, name in enumerate(names)] * 2, "word string, n int")
    for max_bytes in (0, 1 << 25):
        got = words.descriptive_forms(table, lexicon, exceptions, max_bytes)
        assert rows(got) == sorted([(name, names.index(name)) for name in ("big", "bigger", "quickest", "nicer", "nicest", "better", "quicker")] * 2)
        bare = words.descriptive_forms(table, lexicon, None, max_bytes).select("word").distinct()
        assert {row.word for row in bare.collect()} == {"big", "quickest", "nicer", "nicest", "better", "quicker"}  # "bett" is in the lexicon
    df = spark.createDataFrame([("bigger nicer hotel", "quickest her", 8.0)], "Positive_Review string, Negative_Review string, Reviewer_Score double")
    got = words.word_scores(df, lexicon, 1, inflected=True, exceptions=exceptions)
    assert rows(got) == [("negative", "quickest", 8.0, 1), ("positive", "bigger", 8.0, 1), ("positive", "nicer", 8.0, 1)]
