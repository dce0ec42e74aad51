import pytest
from conftest import rows
from pyspark.sql import functions as F

from guestbook.operators.joins import BROADCAST_BYTES, join_lookup, measured_bytes
from guestbook.operators.topk import first_k_per_group
from guestbook.shared import settled, shared_folder


@pytest.fixture
def big(spark):
    """A third of the rows under one key, some without a key."""
    number = F.col("id")
    other = F.concat(F.lit("k"), number % 40)
    key = F.when(number % 3 == 0, "hot").when(number % 50 == 1, None).otherwise(other)
    return spark.range(9000).select("id", key.alias("key"))


@pytest.fixture
def lookup(spark):
    return spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(0, 40, 2)], "key string, value int")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_both_ways_of_a_lookup_agree(big, lookup, how):
    broadcast = join_lookup(big, lookup, "key", how)
    shuffled = join_lookup(big, lookup, "key", how, max_bytes=0)
    assert "BroadcastExchange" in broadcast._jdf.queryExecution().executedPlan().toString()
    assert broadcast.columns == shuffled.columns
    assert rows(broadcast) == rows(shuffled)


def test_costly_lookup_is_written_once(spark, big, lookup):
    counted = lookup.groupBy("key").agg(F.sum("value").alias("value"))
    joined = join_lookup(big, counted, "key", costly=True)
    assert shared_folder(spark).replace("file:", "") in joined._jdf.queryExecution().executedPlan().toString()
    assert rows(joined) == rows(big.join(counted, "key"))


def test_measured_bytes_grow_with_text(spark):
    short = spark.createDataFrame([("a", 1)], "word string, n int")
    long = spark.createDataFrame([("a" * 1000, 1), (None, 2)], "word string, n int")
    assert measured_bytes(short) < measured_bytes(long) < BROADCAST_BYTES
    assert measured_bytes(short.filter("false")) == 0


def test_hot_key_is_split_in_the_shuffled_join(spark, tmp_path):
    path = str(tmp_path / "big")
    wide = spark.range(0, 60000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 997)).alias("key"),
        F.sha2(F.col("id").cast("string"), 512).alias("text"),
    )
    wide.write.parquet(path)
    keys = spark.read.parquet(path).groupBy("key").agg(F.count("*").alias("n"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        joined = join_lookup(spark.read.parquet(path), keys, "key", costly=True, max_bytes=0)
        assert joined.count() == 60000
        collected = joined.select("n", "text")
        assert len(collected.collect()) == 60000
        assert "skew=true" in collected._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


def test_first_k_of_a_hot_group(spark):
    df = spark.range(0, 30000, 1, 16).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 100)).alias("key")
    )
    got = first_k_per_group(df, ["key"], [F.desc("id")], 5, rank="place")
    hot = [(row.id, row.place) for row in got.filter("key = 'hot'").orderBy("place").collect()]
    assert hot == [(29997 - 3 * i, i + 1) for i in range(5)]
    assert got.groupBy("key").count().filter("count <> 5").count() == 0


def test_first_k_keeps_small_and_null_groups(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "key string, id int")
    assert rows(first_k_per_group(df, ["key"], ["id"], 5)) == [("a", 1), ("a", 2), (None, 3)]


def test_settled_table_starts_a_new_lineage(spark):
    df = settled(spark.range(10).groupBy((F.col("id") % 3).alias("g")).count(), "t")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" not in plan and "parquet" in plan
    assert rows(df) == [(0, 4), (1, 3), (2, 3)]
