import random

import pytest
from conftest import as_set
from pyspark.sql import functions as F

from tillflow import schemas
from tillflow.operators import allocation, wide
from tillflow.operators.skew import hot_keys, split_hot
from tillflow.plans.catalog import QUERIES

ORDER = "id bigint, final_total_amount double, at timestamp_ntz"
LINE = "id string, order_id bigint, order_price double, sku_num bigint, at timestamp_ntz"


def ts(day, hour=0, minute=0, second=0):
    from datetime import datetime

    return datetime(2021, 4, day, hour, minute, second)


@pytest.fixture
def crowd(rows):
    """Orders of 1 to 5 lines, one of 400 lines, some without lines, lines without order."""
    rng = random.Random(7)
    orders = [(i, rng.randint(0, 10**6) / 100, ts(1 + i % 20)) for i in range(60)]
    lines = []
    for order in [*range(50), *[3] * 400, *[99] * 4]:
        for _ in range(1 if order in (3, 99) else rng.randint(1, 5)):
            n = len(lines)
            lines.append((f"l{n:05d}", order, rng.randint(0, 10**5) / 100, rng.randint(0, 4), ts(1 + n % 25)))
    return orders, lines, rows(ORDER, *orders), rows(LINE, *lines)


def cents(x):
    return int(x * 100 + 0.5)


def expected_shares(orders, lines):
    paid = {o[0]: cents(o[1]) for o in orders}
    by_order = {}
    for line in sorted(lines):
        if line[1] in paid:
            by_order.setdefault(line[1], []).append((line[0], cents(line[2]) * line[3]))
    shares = {}
    for order, amounts in by_order.items():
        whole, left = sum(a for _, a in amounts), paid[order]
        for line, amount in amounts[:-1]:
            share = (2 * amount * paid[order] + whole) // (2 * whole) if whole else None
            shares[line] = share
            left -= share or 0
        shares[amounts[-1][0]] = left
    return shares


@pytest.mark.parametrize("hot_rows", [10**6, 100, 3])
def test_shares_of_ordinary_and_hot_orders(crowd, hot_rows):
    orders, lines, order_frame, line_frame = crowd
    got = allocation.paid_lines(order_frame, line_frame, hot_rows)
    shares = {r.order_detail_id: r.final_detail_amount for r in got.collect()}
    expected = {k: None if v is None else v / 100 for k, v in expected_shares(orders, lines).items()}
    assert shares == expected
    again = allocation.allocate(wide.join_lines(order_frame, line_frame), hot_rows=hot_rows)
    assert {r.order_detail_id: r.final_detail_amount for r in again.collect()} == expected
    assert got.columns == schemas.ORDER_WIDE.fieldNames() == again.columns


@pytest.mark.parametrize("hot_rows", [10**6, 100, 3])
def test_running_sums_of_ordinary_and_hot_orders(crowd, hot_rows):
    orders, lines, order_frame, line_frame = crowd
    paid = allocation.paid_lines(order_frame, line_frame)
    got = {
        r.order_detail_id: (r.origin_before, r.split_before)
        for r in allocation.running_sums(paid, hot_rows=hot_rows).collect()
    }
    shares, expected, sums = expected_shares(orders, lines), {}, {}
    for line in sorted(lines):
        if line[0] in shares:
            origin, split = sums.get(line[1], (0, 0))
            expected[line[0]] = (origin / 100, split / 100)
            sums[line[1]] = (origin + cents(line[2]) * line[3], split + (shares[line[0]] or 0))
    assert got == expected


@pytest.mark.parametrize(
    "paid, prices, expected",
    [
        (100.0, [40.0, 40.0, 40.0], [33.33, 33.33, 33.34]),
        (7.5, [3.0], [7.5]),
        (90.0, [60.0, 40.0], [54.0, 36.0]),
        (110.0, [60.0, 40.0], [66.0, 44.0]),
        (5.0, [0.0, 0.0], [None, 5.0]),
        (0.0, [1.0, 2.0], [0.0, 0.0]),
    ],
)
def test_shares_add_up_to_what_was_paid(rows, paid, prices, expected):
    orders = rows(ORDER, (1, paid, ts(1)))
    lines = rows(LINE, *[(f"l{i}", 1, p, 1, ts(1)) for i, p in enumerate(prices)])
    for hot_rows in (10**6, 0):
        got = allocation.paid_lines(orders, lines, hot_rows).orderBy("order_detail_id").collect()
        assert [r.final_detail_amount for r in got] == expected


def test_hot_keys_are_bounded_and_the_split_is_whole(rows):
    frame = rows("k int, v int", *[(1, i) for i in range(50)], *[(i, 0) for i in range(2, 30)], (None, 1))
    hot = hot_keys(frame, ["k"], 10)
    assert as_set(hot) == {(1,)}
    few, many = split_hot(frame, hot, ["k"])
    assert many.count() == 50 and few.count() == 29
    without = frame.unionByName(rows("k int, v int", *[(None, i) for i in range(40)]))
    hot = hot_keys(without, ["k"], 10)
    few, many = split_hot(without, hot, ["k"])
    assert as_set(hot) == {(1,), (None,)} and many.count() == 91 and few.count() == 28


def test_lines_without_an_order_are_kept_whatever_the_branch(rows):
    orders = rows(ORDER, (1, 10.0, ts(1)), (None, 5.0, ts(1)))
    lines = rows(LINE, *[(f"l{i}", None, 1.0, 1, ts(1)) for i in range(20)], ("m", 1, 1.0, 1, ts(1)))
    for hot_rows in (10**6, 5, 0):
        got = [(r.order_detail_id, r.order_id) for r in wide.join_sales(orders, lines, hot_rows=hot_rows).collect()]
        assert sorted(got, key=str) == sorted([(f"l{i}", None) for i in range(20)] + [("m", "1"), (None, None)], key=str)
        paid = allocation.allocate(wide.join_lines(orders, lines, how="left"), hot_rows=hot_rows)
        sums = allocation.running_sums(paid, hot_rows=hot_rows)
        assert as_set(sums, "order_detail_id", "origin_before") == {(f"l{i}", None) for i in range(0)} | {
            ("m", 0.0), *[(f"l{n}", float(k)) for k, n in enumerate(sorted(range(20), key=lambda i: f"l{i}"))]
        }


def test_a_repeated_last_line_leaves_the_rest_once(rows):
    orders = rows(ORDER, (1, 10.0, ts(1)))
    lines = rows(LINE, ("a", 1, 1.0, 1, ts(1)), ("b", 1, 1.0, 1, ts(1)), ("b", 1, 1.0, 1, ts(1)))
    for hot_rows in (10**6, 0):
        got = allocation.paid_lines(orders, lines, hot_rows).collect()
        assert sorted(r.final_detail_amount for r in got) == [3.33, 3.33, 3.34]


def test_sales_keep_each_pair_once_and_all_unmatched(crowd):
    orders, lines, order_frame, line_frame = crowd
    bound = 5 * 86_400
    near = wide.seconds_apart("at", "at", bound)
    pairs = {
        (l[0], str(o[0])) for l in lines for o in orders
        if l[1] == o[0] and abs((l[4] - o[2]).total_seconds()) <= bound
    }
    met_lines, met_orders = {p[0] for p in pairs}, {p[1] for p in pairs}
    expected = (
        pairs
        | {(l[0], None) for l in lines if l[0] not in met_lines}
        | {(None, str(o[0])) for o in orders if str(o[0]) not in met_orders}
    )
    for hot_rows in (10**6, 100, 2):
        got = wide.join_sales(order_frame, line_frame, near, hot_rows=hot_rows)
        assert as_set(got, "order_detail_id", "order_id") == expected
        assert got.columns == schemas.SALE_DETAIL.fieldNames()


def test_left_join_shows_lost_lines(crowd):
    orders, lines, order_frame, line_frame = crowd
    got = wide.join_lines(order_frame, line_frame, how="left")
    assert got.count() == len(lines)
    assert got.filter(F.col("order_id").isNull()).count() == 4


def test_bound_is_inclusive(rows):
    orders = rows(ORDER, (1, 1.0, ts(1, 12)))
    lines = rows(LINE, *[(n, 1, 1.0, 1, t) for n, t in [
        ("early", ts(1, 11, 58, 59)), ("first", ts(1, 11, 59)), ("last", ts(1, 12, 1)), ("late", ts(1, 12, 1, 1)),
    ]])
    got = wide.join_lines(orders, lines, wide.seconds_apart("at", "at", 60))
    assert as_set(got, "order_detail_id") == {("first",), ("last",)}


def test_sliding_windows_agree_with_windows_written_out(crowd):
    orders, lines, order_frame, line_frame = crowd
    day = 86_400
    for window, slide in [(10, 5), (6, 2), (4, 4)]:
        got = wide.join_lines(
            order_frame, line_frame, wide.share_a_window("at", "at", window * day, slide * day)
        )
        o, l = (
            f.select("*", F.window("at", f"{window} days", f"{slide} days").alias("w"))
            for f in (order_frame, line_frame)
        )
        expected = o.alias("o").join(
            l.alias("l"), (F.col("o.id") == F.col("l.order_id")) & (F.col("o.w") == F.col("l.w"))
        ).select("l.id").distinct()
        assert as_set(got, "order_detail_id") == as_set(expected)
    with pytest.raises(ValueError):
        wide.share_a_window("at", "at", 7, 2)


def spread(frame):
    """Rows by task."""
    return sorted(r["count"] for r in frame.groupBy(F.spark_partition_id()).count().collect())


@pytest.mark.parametrize("copies", [False, True])
def test_a_hot_order_without_line_ids_spreads_over_all_tasks(spark, settings, copies):
    """40,000 lines of one order, all without an id: some with columns that differ, some wholly equal."""
    settings(spark__sql__adaptive__coalescePartitions__enabled="false")
    n = F.lit(1) if copies else F.col("n") % 977
    lines = spark.range(40_000).select(
        F.lit(None).cast("string").alias("order_detail_id"), F.lit(7).cast("bigint").alias("order_id"),
        F.lit(1.0).alias("sku_price"), F.lit(2).cast("bigint").alias("sku_num"), F.lit(80_000.01).alias("final_total_amount"),
        F.col("id").alias("n"), F.lit(None).cast("double").alias("final_detail_amount"),
    ).withColumn("n", n)
    paid = allocation.allocate(lines, hot_rows=100)
    shares = {r.final_detail_amount: r["count"] for r in paid.groupBy("final_detail_amount").count().collect()}
    assert shares == {2.0: 39_999, 2.01: 1}
    summed = allocation.running_sums(paid, hot_rows=100)
    assert sorted(r.origin_before for r in summed.select("origin_before").collect()) == [2.0 * i for i in range(40_000)]
    by_task = spread(summed)
    assert len(by_task) >= 4 and by_task[-1] < 20_000


def test_running_sums_without_hot_orders_have_one_window_branch(spark):
    """The look-up of hot orders happens before, so no scan is in the plan for a branch without rows."""
    rows = QUERIES["order_running_sums"](spark, "/root/testdata/sf0.001")
    assert rows._jdf.queryExecution().executedPlan().toString().count("FileScan") < 20
