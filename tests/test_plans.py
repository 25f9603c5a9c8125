"""Plans that must hold at a thousand times the data."""

import re

import pytest
from pyspark.sql import functions as F

from tillflow.functions.records import parse_records
from tillflow.schemas import ORDER_INFO
from tillflow.operators import allocation, marts, orders, visits, wide
from tillflow.operators.routing import route_canal, route_maxwell
from tillflow.plans import adapters as a
from tillflow.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def final_plan(frame):
    frame.write.format("noop").mode("overwrite").save()
    frame.collect()
    return plan(frame)


BATCH = sorted(n for n in QUERIES if not n.endswith("_stream"))


@pytest.mark.parametrize("name", BATCH)
def test_no_pair_join_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert operator not in text


def test_scan_reads_only_what_is_needed(spark):
    text = plan(visits.dau_total(visits.visit_starts(a.app_logs(a.table(spark, SF, "events")))))
    assert re.findall(r"ReadSchema: struct<([^>]*)>", text) == ["ts:timestamp_ntz,user_id:bigint"]


def test_day_prunes_partitions(spark, tmp_path):
    path = f"{tmp_path}/wide"
    spark.createDataFrame([("2021-04-01", 1.0), ("2021-04-02", 2.0)], "dt string, final_detail_amount double").write.partitionBy("dt").parquet(path)
    text = plan(marts.order_amount(spark.read.schema("final_detail_amount double, dt string").parquet(path), "2021-04-01"))
    assert "PartitionFilters: [isnotnull(dt" in text and "= 2021-04-01)]" in text


def test_join_and_allocation_share_one_shuffle_of_the_lines(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    o = a.order_info(a.table(spark, SF, "orders"))
    l = a.order_detail(a.table(spark, SF, "lineitem"))
    text = plan(allocation.allocate_in_windows(wide.join_lines(o, l)))
    assert text.count("Exchange hashpartitioning") == 2  # orders and lines, nothing between join and windows
    assert text.count("Window [") == 2


def test_without_hot_orders_their_branch_vanishes(spark):
    o = a.order_info(a.table(spark, SF, "orders"))
    l = a.order_detail(a.table(spark, SF, "lineitem"))
    text = final_plan(allocation.paid_lines(o, l))
    final = text[: text.index("Initial Plan")]
    assert "Union" not in final and "LeftAnti" not in final
    assert final.count("Window [") == 2


def test_hot_orders_never_reach_a_window(spark, settings):
    """With every order hot, no window runs and the lines are not shuffled by order."""
    o = a.order_info(a.table(spark, SF, "orders"))
    l = a.order_detail(a.table(spark, SF, "lineitem"))
    text = plan(allocation.allocate_by_sums(wide.join_lines(F.broadcast(o), l)))
    assert "Window" not in text and "SortMergeJoin" not in text


def test_one_row_per_key_is_combined_before_the_shuffle(spark):
    logs = a.app_logs(a.table(spark, SF, "events"))
    assert "partial_min_by" in plan(visits.first_visits(logs))
    flagged = orders.flag_first_orders(a.order_info(a.table(spark, SF, "orders")))
    text = plan(flagged)
    assert "partial_min" in text and "Window" not in text


def test_skewed_join_is_split(spark, settings):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    many = spark.range(0, 40_000, 1, 8)
    lines = many.select(
        F.col("id"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("order_id"),
        F.lit(1.0).alias("order_price"), F.lit(1).cast("bigint").alias("sku_num"),
    )
    o = spark.range(5000).select("id", F.lit(1.0).alias("final_total_amount"))
    for how in ("inner", "left"):
        joined = wide.join_lines(o, lines, how=how)
        assert joined.count() == 40_000
        assert "skew=true" in final_plan(joined)


def test_one_parse_per_message(rows):
    messages = rows("value string", ("{}",))
    needs = {"id": "bigint", "create_time": "timestamp"}
    assert plan(parse_records(messages, ORDER_INFO, required=needs)).count("from_json") == 1
    for route in (route_canal, route_maxwell):
        assert plan(route(messages)).count("from_json") == 1
