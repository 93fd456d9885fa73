"""What the plans must and must not hold."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from basketflow.operators import baskets as bk
from basketflow.operators import source_items as si
from basketflow.plans import jobs
from basketflow.plans.queries import shop
from basketflow.plans.standin import shop_events
from basketflow.session import ADVISORY, small_tasks

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["pairs_ranked", "user_affinity", "user_source_items", "user_profiles_nested", "user_recommendations_wide", "flag_abandoned_items", "lookup_batch"],
)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(driver.queries()[name](spark, SF_DIR))
    for forbidden in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert forbidden not in text


def test_rank_limit_is_applied_before_the_shuffle(spark):
    text = plan(si.user_source_items(si.user_item_scores(shop(spark, SF_DIR))))
    assert text.count("WindowGroupLimit") == 2


def test_top_pairs_need_no_global_sort(spark):
    text = plan(driver.queries()["top_pairs"](spark, SF_DIR))
    assert "TakeOrderedAndProject" in text


def test_only_needed_columns_and_kinds_are_read(spark):
    text = plan(bk.session_baskets(shop(spark, SF_DIR, "purchase")))
    assert "ReadSchema: struct<session_id:string,event_type:string,product_id:string>" in text
    assert "EqualTo(event_type,purchase)" in text
    assert "kind" in text.split("PartitionFilters: [")[1].split("]")[0]


def test_category_is_not_parsed_where_it_is_not_used(spark):
    assert "from_json" not in plan(bk.session_baskets(shop_events(spark, SF_DIR)))


def test_filter_on_category_keeps_the_plan_small(spark):
    assert len(plan(shop_events(spark, SF_DIR).where("category IS NOT NULL"))) < 100_000


def test_giant_sessions_are_broadcast_only_if_small(spark):
    events = shop(spark, SF_DIR, "purchase")
    giants = spark.range(10).selectExpr("cast(id AS STRING) AS session_id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    text = plan(bk.basket_pairs(events, giants))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in text and "LeftAnti" in text


def test_wide_rows_are_gathered_after_the_shuffle_only(spark):
    """No array is built on the way to a shuffle, and AQE cannot join the partitions of wide rows."""
    text = plan(driver.queries()["user_recommendations_nested"](spark, SF_DIR)).split("Initial Plan")[-1]
    gathered, moved = text.split("REPARTITION_BY_NUM", 1)[0], text.split("REPARTITION_BY_NUM", 1)[1]
    assert "partial_collect_list(struct(source_rank" in gathered
    assert "partial_collect_list(struct(source_rank" not in moved


def test_a_job_reads_its_shuffles_in_tasks_of_few_bytes(spark, tmp_path):
    """More than 16 MB in all, which AQE would join to one partition of at most 64 MB."""
    settings = {
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        rows = 300_000
        events = spark.range(rows).select("id", F.sha2(F.col("id").cast("string"), 512).alias("product_id"))
        users = spark.range(rows).select("id", F.concat(F.lit("u"), "id").alias("user_id"))
        log = events.join(users, "id").select(
            F.col("id").cast("string").alias("session_id"), "user_id", F.lit("purchase").alias("event_type"), "product_id", F.lit("c").alias("category")
        )
        jobs.store_events(log, str(tmp_path / "events"))
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert len(list(Path(tmp_path / "events" / "kind=purchase").glob("*.parquet"))) > 1
    assert spark.read.parquet(str(tmp_path / "events")).count() == rows


def test_small_tasks_leave_the_session_as_it_was(spark):
    given = spark.conf.get(ADVISORY, None)
    with pytest.raises(KeyError), small_tasks(spark, 1 << 20):
        assert spark.conf.get(ADVISORY) == str(1 << 20)
        raise KeyError
    assert spark.conf.get(ADVISORY, None) == given
    spark.conf.set(ADVISORY, "512k")
    try:
        with small_tasks(spark, 1 << 20):
            assert spark.conf.get(ADVISORY) == str(512 << 10)
        assert spark.conf.get(ADVISORY) == "512k"
    finally:
        spark.conf.unset(ADVISORY)
