"""What streams and joins hold, write and shuffle, on tables of their own."""

from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import as_set

from tillflow.plans import streams
from tillflow.plans.catalog import QUERIES
from tillflow.sources.topic_log import TopicLog

ORDERS = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
LINES = (
    "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
)
DAYS = 1000


@pytest.fixture
def tables(rows, tmp_path):
    """An order every day for years; its lines follow a day and half a year later, the first one comes twice."""
    start = datetime(1995, 1, 1)
    made = [(n, n % 7, "O", 50.0, start + timedelta(days=n), "5-LOW") for n in range(DAYS)]
    made += [(DAYS, 1, "O", 50.0, None, "5-LOW")]
    lines = [
        (n, n % 5, 1, number, 2.0, 10.0, 0.0, 0.0, "N", "O", start + timedelta(days=n + later))
        for n in range(DAYS) for number, later in ((1, 1), (1, 1), (2, 180))
    ]
    rows(ORDERS, *made).write.parquet(f"{tmp_path}/orders.parquet")
    rows(LINES, *lines).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


@pytest.fixture
def started(monkeypatch):
    queries, start = [], streams.start_append

    def record(*args, **kwargs):
        queries.append(start(*args, **kwargs))
        return queries[-1]

    monkeypatch.setattr(streams, "start_append", record)
    return queries


def _removed(query):
    return sum(state["numRowsRemoved"] for at in query.recentProgress for state in at["stateOperators"])


def test_joined_feeds_do_not_stay_in_the_state(spark, tables, started):
    found = as_set(QUERIES["order_wide_stream"](spark, tables), "order_id", "order_detail_id")
    assert {int(order) for order, _ in found} == set(range(DAYS)) and len(found) == DAYS
    assert len(started) == 1 and _removed(started[0]) > DAYS


def test_full_outer_runs_through_in_parts(spark, tables, started):
    found = as_set(QUERIES["sale_full_outer_stream"](spark, tables), "order_id", "order_detail_id")
    assert sum(order is None for order, _ in found) == DAYS and sum(line is None for _, line in found) == 0
    assert len(found) == 2 * DAYS
    assert len(started) == 1 and len({at["batchId"] for at in started[0].recentProgress if at["numInputRows"]}) > 4


def test_sale_interval_runs_no_batch_without_data(spark, tables, monkeypatch):
    from tillflow.streaming import run

    queries, start = [], run.start_append
    monkeypatch.setattr(run, "start_append", lambda *args, **named: queries.append(start(*args, **named)) or queries[-1])
    assert QUERIES["sale_interval_stream"](spark, tables).count() == DAYS
    assert [at["batchId"] for at in queries[0].recentProgress] == [0]


def test_ids_are_kept_for_good_on_demand(spark, rows, tmp_path):
    from tillflow.streaming.run import start_append
    from tillflow.streaming.wide import join_lines_stream

    def go(order, line):
        o, l = "id long, create_time string", "id long, order_id long, create_time string"
        for name, schema, row in (("o", o, order), ("l", l, line)):
            rows(schema, row).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")
        feeds = [spark.readStream.schema(s).parquet(f"{tmp_path}/{n}") for n, s in (("o", o), ("l", l))]
        joined = join_lines_stream(*feeds, bound=10, forget=False)
        start_append(joined, f"{tmp_path}/out", f"{tmp_path}/c").awaitTermination()
        return [r.order_detail_id for r in spark.read.parquet(f"{tmp_path}/out").collect()]

    assert go((1, "2021-01-01 00:00:00"), (7, 1, "2021-01-01 00:00:00")) == [7]
    assert go((2, "2022-01-01 00:00:00"), (8, 2, "2022-01-01 00:00:00")) == [7, 8]
    assert sorted(go((1, "2023-01-01 00:00:00"), (7, 1, "2023-01-01 00:00:00"))) == [7, 8]


def test_the_chain_holds_what_the_shares_need(spark, tables):
    assert set(streams._joined_with_totals(spark, tables).columns) == {
        "order_id", "order_detail_id", "sku_price", "sku_num",
        "final_total_amount", "original_total_amount", "final_detail_amount",
    }


@pytest.mark.parametrize("name", ["order_split_amount_stream", "order_split_amount_batch_stream"])
def test_the_chain_still_shares_all(spark, tables, name):
    """The stored total counts the line that comes twice: 20 of 60 for each of the two that are left."""
    shares = QUERIES[name](spark, tables).collect()
    assert len(shares) == 2 * DAYS and {r.final_detail_amount for r in shares} == {16.67}


def test_a_topic_file_has_few_row_groups(tmp_path):
    log = TopicLog(str(tmp_path))
    batch = pa.RecordBatch.from_pydict(
        {"topic": ["T"] * 3, "key": [None, "k", None], "value": ["a", "b", None], "at": [1, 2, 3]},
        schema=pa.schema([("topic", pa.string()), ("key", pa.string()), ("value", pa.string()), ("at", pa.int64())]),
    )
    files = log.write(iter([batch] * 50), 1)
    assert [(f.topic, f.partition, f.rows) for f in files] == [("T", 0, 150)]
    held = pq.ParquetFile(f"{tmp_path}/{files[0].path}")
    assert held.num_row_groups == 1 and held.read()["value"].to_pylist() == ["a", "b", None] * 50


def test_lines_meet_their_sku_before_texts_are_made(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    wide = QUERIES["order_wide"](spark, "/root/testdata/sf0.001")
    plan = wide._jdf.queryExecution().sparkPlan().treeString().split("\n")
    joins = [i for i, text in enumerate(plan) if "Join [sku_id" in text]
    assert len(joins) == 1

    def depth(text):
        return len(text) - len(text.lstrip(" :+-|"))

    below = []
    for text in plan[joins[0] + 1:]:
        if depth(text) <= depth(plan[joins[0]]):
            break
        below.append(text)
    assert below and not any("concat_ws" in text for text in below)


class _Handle:
    """Counts the calls to a bucket's state."""

    def __init__(self):
        self.entries, self.calls = [], 0

    def getListState(self, name, schema, ttl_ms):
        return self

    def get(self):
        self.calls += 1
        return iter(list(self.entries))

    def appendList(self, entries):
        self.calls += 1
        self.entries += entries

    def put(self, entries):
        self.calls += 1
        self.entries = entries


def test_orders_meet_the_state_in_buckets(spark):
    """Sums of many orders are one entry a batch, and few calls; what is replaced does not pile up."""
    from pyspark.sql import Row

    from tillflow.streaming.allocation import _Allocation

    processor, handle = _Allocation("bigint", None), _Handle()
    processor.init(handle)
    for number in range(4):
        lines = (
            Row(order_id=order, order_detail_id=number, sku_price=10.0, sku_num=1, final_total_amount=10.0,
                original_total_amount=40.0, final_detail_amount=0.0, _bucket=7)
            for order in range(100)
        )
        shares = [r.final_detail_amount for r in processor.handleInputRows((7,), lines, None)]
        assert shares == [2.5] * 100
    assert handle.calls == 8 and sum(len(orders) for orders, _, _ in handle.entries) <= 200


@pytest.mark.parametrize("forget", [False, True])
def test_joined_with_state_in_tables(spark, rows, tmp_path, forget):
    """Pairs across batches once, copies and late rows left out, a batch that runs again replaces itself."""
    from tillflow.streaming.wide import JoinTables, join_lines_stream

    o, l = "id long, create_time string", "id string, order_id long, create_time string"

    def go(number, orders, lines):
        for _ in range(1 + (number == 2)):
            joined = join_lines_stream(
                rows(o, *orders), rows(l, *lines), bound=60, delay="1 hour", forget=forget, salts=3,
                tables=JoinTables(f"{tmp_path}/state", number, tail_batches=4),
            )
            found = sorted((r.order_id, r.order_detail_id) for r in joined.collect())
        return found

    day = "2021-01-01 "
    assert go(0, [(1, day + "00:00:00"), (2, day + "00:00:00"), (3, None)], [("a", 1, day + "00:01:00"), ("a", 1, day + "00:01:00"), ("b", 1, day + "00:01:01")]) == [(1, "a")]
    assert go(1, [(1, day + "00:00:01"), (4, day + "00:00:30")], [("a", 1, day + "00:00:00"), ("c", 2, day + "00:00:10"), ("d", None, day + "00:00:10")]) == [(2, "c")]
    assert go(2, [(5, day + "00:02:00")], [("e", 4, day + "00:00:40"), ("f", 5, day + "00:02:00")]) == [(4, "e"), (5, "f")]
    assert go(3, [(6, day + "12:00:00")], [("g", 6, day + "12:00:00")]) == [(6, "g")]
    assert go(4, [(7, day + "10:59:59")], [("h", 7, day + "11:00:00"), ("i", 6, day + "11:59:59")]) == [(6, "i")]
    assert go(5, [], []) == []  # the tables are folded: what can't be met is cut to its id, or dropped
    held = spark.read.parquet(*[str(p) for p in (tmp_path / "state/lines").glob("snapshot-*")])
    assert held.filter("create_time is not null").count() == 2
    assert held.count() == (2 if forget else 8)


def test_the_chain_leaves_no_rows_of_both_feeds_in_the_state_store(spark, tables, monkeypatch):
    from tillflow.streaming import run

    queries, start = [], run.start_append
    monkeypatch.setattr(run, "start_append", lambda *args, **named: queries.append(start(*args, **named)) or queries[-1])
    assert QUERIES["order_split_amount_stream"](spark, tables).count() == 2 * DAYS
    assert {state["operatorName"] for at in queries[0].recentProgress for state in at["stateOperators"]} == {"transformWithStateInPySparkExec"}


def test_full_outer_runs_no_batch_without_data(spark, tables, started):
    """Eight parts and two closing commits, each a batch: none before the first part, none that only searches the state."""
    assert QUERIES["sale_full_outer_stream"](spark, tables).count() == 2 * DAYS
    batches = {at["batchId"]: at["numInputRows"] for at in started[0].recentProgress if "addBatch" in at["durationMs"]}
    assert sorted(batches) == list(range(10)) and all(batches.values())
