"""The plans stay native, and no join degrades to a cross product."""

import sys

import pytest
from conftest import SMALL

from __spark_entry__ import queries
from guestbook import shared
from guestbook.plans.registry import QUERIES

WITH_MODEL = {"q9c_model_sentiment", "q9c_model_sentiment_within_tokens", "q9c_model_sentiment_of_lemmas", "q10c_model_summary"}
NOT_NATIVE = "BatchEvalPython ArrowEvalPython MapInPandas MapInArrow InPandas InArrow CartesianProduct BroadcastNestedLoopJoin".split()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WITH_MODEL))
def test_native_plan(spark, name, monkeypatch):
    """The last plan, and the plans of the tables that are written on the way to it."""
    plans, write = [], shared.settled
    for module in [module for key, module in sys.modules.items() if key.startswith("guestbook.") and hasattr(module, "settled")]:
        monkeypatch.setattr(module, "settled", lambda df, name: plans.append(plan_of(df)) or write(df, name))
    plans.append(plan_of(QUERIES[name](spark, SMALL)))
    for plan in plans:
        assert [word for word in NOT_NATIVE if word in plan] == []


def test_model_hook_is_batched(spark):
    plan = plan_of(queries()["q9c_model_sentiment"](spark, SMALL))
    assert "ArrowEvalPython" in plan and "BatchEvalPython" not in plan and "Exchange" not in plan.replace(
        "REPARTITION_BY_NUM", ""
    ).replace("Exchange hashpartitioning(doc_id", "")


def test_entity_filter_reaches_the_scan(spark, tmp_path):
    from guestbook.operators.scores import entity_statistics, of_entity

    path = str(tmp_path / "reviews")
    spark.createDataFrame(
        [("a", 8.0, 1.0, 2.0)], "Hotel_Name string, Reviewer_Score double, lat double, lng double"
    ).write.parquet(path)
    df = of_entity(entity_statistics(spark.read.parquet(path)), "a")
    assert "EqualTo(Hotel_Name,a)" in plan_of(df)


def test_bounding_box_reaches_the_scan(spark, tmp_path):
    from guestbook.operators.geo import nearby_entities

    path = str(tmp_path / "reviews")
    spark.createDataFrame([("a", 45.0, 9.0)], "Hotel_Name string, lat double, lng double").write.parquet(path)
    plan = plan_of(nearby_entities(spark.read.parquet(path), 45.0, 9.0))
    assert "GreaterThanOrEqual(lat," in plan and "LessThanOrEqual(lng," in plan


def test_newest_rows_are_limited_before_each_shuffle(spark):
    plan = plan_of(queries()["q4_reputation"](spark, SMALL))
    assert plan.count("row_number(), 30, Partial") == 2


def test_scans_read_only_needed_columns(spark):
    plan = plan_of(queries()["q3_review_length"](spark, SMALL))
    assert "ReadSchema: struct<l_linenumber:int,l_quantity:double>" in plan
