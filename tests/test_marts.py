import pytest
from conftest import as_set
from pyspark.sql import functions as F

from tillflow.operators import marts
from tillflow.operators.search import search

WIDE = "tm_id bigint, tm_name string, final_detail_amount double, dt string, create_time string"


@pytest.fixture
def paid(rows):
    return rows(
        WIDE,
        (1, "a:b", 0.1, "2021-04-02", "2021-04-02 09:10:00"), (1, "a:b", 0.2, "2021-04-02", "2021-04-02 09:59:59"),
        (2, "c", 5.0, "2021-04-02", "2021-04-02 13:00:00"), (2, "c", 7.0, "2021-04-01", "2021-04-01 13:00:00"),
        (None, None, 1.0, "2021-04-01", "2021-04-01 00:00:00"),
    )


def test_trademark_names_stay_whole(paid):
    assert as_set(marts.trademark_amount(paid)) == {(1, "a:b", 0.3), (2, "c", 12.0), (None, None, 1.0)}


def test_amounts_by_day_and_hour(paid):
    assert as_set(marts.order_amount(paid, "2021-04-02")) == {(5.3,)}
    assert as_set(marts.order_amount(paid, "2020-01-01")) == {(None,)}
    by_hour = marts.order_amount_by_hour(paid)
    assert ("2021-04-02", 9, 0.3) in as_set(by_hour)
    maps = {r.dt: r.by_hour for r in marts.hour_map(by_hour, "order_amount").collect()}
    assert maps["2021-04-02"] == {"9": 0.3, "13": 5.0}
    compared = marts.hour_compare(by_hour, "2021-04-02", "order_amount")
    assert as_set(compared) == {("9", 0.3, None), ("13", 5.0, 7.0), ("0", None, 1.0)}


def test_time_range_leaves_out_both_ends_and_top_is_ordered(rows):
    stat = rows(
        "stat_time string, trademark_id string, trademark_name string, amount double",
        ("2021-04-01 00:00:00", "1", "a", 100.0), ("2021-04-01 00:00:01", "1", "a", 1.0),
        ("2021-04-01 12:00:00", "2", "b", 3.0), ("2021-04-01 12:00:00", "3", "c", 3.0),
        ("2021-04-02 00:00:00", "2", "b", 100.0),
    ).withColumn("stat_time", F.col("stat_time").cast("timestamp")).withColumn("amount", F.col("amount").cast("decimal(38,2)"))
    top = marts.top_trademarks(stat, "2021-04-01 00:00:00", "2021-04-02 00:00:00", 2)
    assert [tuple(r) for r in top.collect()] == [("2", "b", 3.0), ("3", "c", 3.0)]


def test_report_rows(paid):
    stat = marts.trademark_stat(paid, F.lit("2021-04-02 00:00:00").cast("timestamp"))
    assert {(r.trademark_id, float(r.amount)) for r in stat.collect()} == {("1", 0.3), ("2", 12.0), (None, 1.0)}


def test_totals_of_a_day(rows):
    dau = rows("dt string, dau bigint", ("2021-04-02", 7))
    new = rows("dt string, new_devices bigint", ("2021-04-01", 3))
    amount = rows("dt string, order_amount double", ("2021-04-02", 5.5))
    got = as_set(marts.realtime_total("2021-04-02", dau, new, amount), "id", "value")
    assert got == {("dau", 7.0), ("new_mid", 0.0), ("order_amount", 5.5)}
    empty = as_set(marts.realtime_total("2020-01-01", dau, new, amount), "id", "value")
    assert empty == {("dau", 0.0), ("new_mid", 0.0), ("order_amount", None)}


def test_unknown_metric_and_bad_day(rows):
    hours = rows("dt string, hr string, dau bigint", ("2021-04-02", "01", 7))
    assert as_set(marts.realtime_hour("dau", "2021-04-03", hours, None)) == {("01", None, 7.0)}
    with pytest.raises(ValueError):
        marts.realtime_hour("other", "2021-04-02", hours, None)
    with pytest.raises(ValueError):
        marts.realtime_hour("dau", "soon", hours, None)


def test_windows_tumble_and_slide(rows):
    frame = rows("ts string, k int, paid double", ("2021-01-01 00:04:00", 1, 1.0), ("2021-01-01 00:06:00", 1, 2.0)).withColumn("ts", F.col("ts").cast("timestamp"))
    tumbling = marts.amount_by_window(frame, "ts", "paid", ["k"], "5 minutes")
    assert sorted(r.amount for r in tumbling.collect()) == [1.0, 2.0]
    sliding = marts.amount_by_window(frame, "ts", "paid", [], "10 minutes", "5 minutes")
    assert sorted(r.amount for r in sliding.collect()) == [1.0, 2.0, 3.0]


def test_search_terms_may_meet_different_elements(rows):
    films = rows(
        "name string, actors array<struct<id:string,name:string>>",
        ("Red Sea", [("1", "x"), ("3", "y")]), ("red", [("1", "x")]), ("bored", [("1", "x"), ("3", "y")]), ("red", None),
    )
    assert as_set(search(films, "actors", "id", ["1", "3"], "name", "red"), "name") == {("Red Sea",)}
