import os
from types import SimpleNamespace

import pytest
from conftest import SMALL
from guestbook import shared
from guestbook.plans import star_queries, text_queries  # noqa: F401  (they register the queries)
from guestbook.plans.registry import QUERIES


@pytest.fixture
def folder(tmp_path, monkeypatch):
    monkeypatch.setattr(shared, "shared_folder", lambda spark: f"file://{tmp_path}")
    return f"{tmp_path}/guestbook"


def tables(folder):
    return sorted(name.rpartition("-")[0] for name in os.listdir(folder)) if os.path.isdir(folder) else []


def test_tables_go_with_their_scope(spark, folder):
    outside = shared.settled(spark.range(3), "outside")
    with shared.scope(spark) as block:
        shared.settled(spark.range(4), "inside")
        kept = block.keep(shared.settled(spark.range(5), "kept"))
        with shared.scope(spark):
            shared.settled(spark.range(6), "deeper")
        assert tables(folder) == ["inside", "kept", "outside"]
    assert tables(folder) == ["kept", "outside"] and kept.count() == 5
    shared.drop_tables(kept, outside, spark.range(1))
    assert tables(folder) == []


def test_tables_go_after_an_error(spark, folder):
    with pytest.raises(ZeroDivisionError), shared.scope(spark):
        shared.settled(spark.range(4), "inside")
        raise ZeroDivisionError
    assert tables(folder) == []


@pytest.mark.parametrize("name", ["q13b_neighbour_check", "q6_anomalies", "q12d_nearby_reputation"])
def test_no_table_is_left_of_a_query(spark, folder, name):
    with shared.scope(spark):
        assert QUERIES[name](spark, SMALL).count() >= 0
        assert tables(folder)
    assert tables(folder) == []


def test_settled_rows_are_those_written(spark, folder):
    df = spark.createDataFrame([(1, "a"), (None, None)], "x int, y string")
    assert sorted(map(tuple, shared.settled(df, "some").collect()), key=repr) == [(1, "a"), (None, None)]


def test_the_drivers_own_disk_is_refused_on_a_cluster(spark, tmp_path):
    def session(master, named=None, warehouse=f"file:{tmp_path}"):
        settings = {"spark.checkpoint.dir": named, "spark.sql.warehouse.dir": warehouse}
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        return SimpleNamespace(conf=settings, sparkContext=context, _jvm=spark._jvm, _jsc=spark._jsc)

    assert shared.shared_folder(session("local[8]")) == f"file:{tmp_path}/checkpoints"
    assert shared.shared_folder(session("yarn", named="hdfs://all/tables/")) == "hdfs://all/tables"
    assert shared.shared_folder(session("spark://head:7077", named="file:///mounted")) == "file:///mounted"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared.shared_folder(session("yarn"))
