import json

import pytest
from conftest import as_set
from pyspark.sql import functions as F

from tillflow import schemas
from tillflow.operators import allocation, marts, orders, visits, wide
from tillflow.operators.routing import route_maxwell, split_app_log
from tillflow.plans import dashboard
from tillflow.sources import tables, topics
from tillflow.streaming import jobs, run
from tillflow.streaming.allocation import allocate_batch, allocate_stream, order_sums
from tillflow.streaming.orders import flag_batch, flag_first_orders_stream, seed_state, user_state
from tillflow.streaming.visits import first_visits_stream
from tillflow.streaming.wide import join_lines_stream, join_sales_stream


@pytest.fixture
def feed(spark, tmp_path):
    """A stream over files that are added one by one, and a way to run it on."""

    class Feed:
        def __init__(self, name, schema):
            self.path, self.schema, self.files = f"{tmp_path}/{name}", schema, 0

        def add(self, *data):
            spark.createDataFrame(list(data), self.schema).coalesce(1).write.mode("append").parquet(self.path)

        def stream(self):
            schema = spark.createDataFrame([], self.schema).schema
            return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(self.path)

        def table(self):
            return spark.read.parquet(self.path)

    return Feed


@pytest.fixture
def finish(spark, tmp_path):
    """Runs a stream to the end of its input, from where it stopped, and reads the output."""

    def go(stream, name="out"):
        query = run.start_append(stream, f"{tmp_path}/{name}", f"{tmp_path}/{name}_checkpoint")
        query.awaitTermination()
        return spark.read.schema(stream.schema).parquet(f"{tmp_path}/{name}")

    return go


LOG = "common struct<mid:string,uid:string,ar:string,ch:string,vc:string>, start string, ts bigint"
HOUR = 3_600_000


def log(mid, ts):
    return ((mid, "u", "a", "c", "v"), None, ts)


@pytest.mark.parametrize("salts", [1, 3])
def test_visits_equal_batch_across_files_and_restart(feed, finish, salts):
    logs = feed("logs", LOG)
    logs.add(log("m", 1 * HOUR), log("m", 2 * HOUR), log("n", 3 * HOUR))
    logs.add(log("m", 20 * HOUR), log("n", 25 * HOUR))
    first = finish(first_visits_stream(logs.stream(), salts=salts))
    assert as_set(first, "dt", "mid") == as_set(visits.visit_starts(logs.table()), "dt", "mid")
    logs.add(log("m", 23 * HOUR), log("m", 30 * HOUR), log("n", 31 * HOUR))
    again = finish(first_visits_stream(logs.stream(), salts=salts))
    assert as_set(again, "dt", "mid") == as_set(visits.visit_starts(logs.table()), "dt", "mid")
    assert again.columns == schemas.DAU_INFO.fieldNames()


ORDERS = "id bigint, user_id bigint, create_time string"


def test_first_order_flag_goes_to_the_first_to_arrive(feed, finish, rows):
    feed_ = feed("orders", ORDERS)
    known = rows("user_id string, if_consumed string", ("7", "1"), ("8", "0"))
    feed_.add((3, 1, "2021-04-01 10"), (2, 1, "2021-04-01 10"), (4, 1, "2021-04-02 10"), (5, 7, "2021-04-01 10"), (6, 8, "2021"))
    got = as_set(finish(flag_first_orders_stream(feed_.stream(), known)), "id", "if_first_order")
    assert got == {(3, "0"), (2, "1"), (4, "0"), (5, "0"), (6, "1")}
    assert got == as_set(orders.flag_first_orders(feed_.table(), known), "id", "if_first_order")
    feed_.add((1, 1, "2021-03-01 10"), (9, 9, "2021"))
    later = as_set(finish(flag_first_orders_stream(feed_.stream(), known)), "id", "if_first_order")
    assert later == got | {(1, "0"), (9, "1")}
    # The batch form knows all orders at once and moves the flag.
    assert (1, "1") in as_set(orders.flag_first_orders(feed_.table(), known), "id", "if_first_order")


def test_first_order_flag_with_unknown_times_and_ids(feed, finish):
    feed_ = feed("orders", ORDERS)
    feed_.add((3, 1, "2021-04-01"), (2, 1, None), (None, 1, "2021"), (4, 2, "2021"), (5, 2, "2020"))
    got = as_set(finish(flag_first_orders_stream(feed_.stream())), "id", "if_first_order")
    assert got == {(3, "0"), (2, "1"), (None, "0"), (4, "0"), (5, "1")}
    assert got == as_set(orders.flag_first_orders(feed_.table()), "id", "if_first_order")


def test_flag_with_state_in_a_table(feed, rows, spark, tmp_path):
    feed_ = feed("orders", ORDERS)
    state, out = f"{tmp_path}/state", f"{tmp_path}/flags"
    seed_state(rows("user_id string, if_consumed string", ("7", "1")), state)

    def write(batch, batch_id):
        for _ in range(2):  # as if the batch ran again after its state was written
            tables.replace_batch(flag_batch(batch, batch_id, state), batch_id, out)

    feed_.add((3, 1, "2021-04-01"), (2, 1, "2021-04-01"), (5, 7, "2021-04-01"))
    run.start_batches(feed_.stream(), write, f"{tmp_path}/c").awaitTermination()
    feed_.add((1, 1, "2021-03-01"), (9, 9, "2021"))
    run.start_batches(feed_.stream(), write, f"{tmp_path}/c").awaitTermination()
    got = as_set(spark.read.parquet(out), "id", "if_first_order")
    assert got == {(3, "0"), (2, "1"), (5, "0"), (1, "0"), (9, "1")}


ORDER = "id bigint, create_time string, create_date string, final_total_amount double, original_total_amount double"
LINE = "id bigint, order_id bigint, order_price double, sku_num bigint, create_time string"


def order(n, at, paid=100.0, original=120.0):
    return (n, at, at[:10], paid, original)


def line(n, order_id, at, price=40.0, num=1):
    return (n, order_id, price, num, at)


T = "2021-04-08 10:00:{:02d}"
END = "2021-04-09 00:00:00"


@pytest.fixture
def two_feeds(feed):
    o, l = feed("o", ORDER), feed("l", LINE)
    o.add(order(1, T.format(5)), order(1, T.format(5)), order(3, T.format(6)))
    l.add(line(10, 1, T.format(1)), line(11, 1, T.format(5)), line(20, 2, T.format(5)))
    l.add(line(11, 1, T.format(5)), line(12, 1, T.format(9)), line(30, 3, T.format(50)))
    return o, l


def test_pairs_come_once_and_only_within_the_bound(two_feeds, finish, spark):
    o, l = two_feeds
    joined = finish(join_lines_stream(o.stream(), l.stream(), bound=10))
    assert as_set(joined, "order_id", "order_detail_id") == {(1, 10), (1, 11), (1, 12)}
    salted = finish(join_lines_stream(o.stream(), l.stream(), bound=10, salts=3), "salted")
    assert as_set(salted) == as_set(joined)
    with pytest.raises(ValueError):
        join_sales_stream(o.stream(), l.stream(), salts=2)
    at = F.to_timestamp("create_time")
    batch = wide.join_lines(
        o.table().distinct().withColumn("at", at), l.table().distinct().withColumn("at", at),
        wide.seconds_apart("at", "at", 10),
    )
    assert as_set(batch) == as_set(joined)


def test_lost_lines_show_in_the_left_form(two_feeds, finish):
    o, l = two_feeds
    o.add(order(98, END))
    l.add(line(99, 99, END))
    joined = finish(join_lines_stream(o.stream(), l.stream(), bound=10, how="left"))
    assert as_set(joined, "order_id", "order_detail_id") == {
        (1, 10), (1, 11), (1, 12), (None, 20), (None, 30)
    }


def test_full_outer_keeps_unmatched_rows_of_both_sides(two_feeds, finish):
    o, l = two_feeds
    o.add(order(98, END))
    l.add(line(99, 99, END))
    sales = finish(join_sales_stream(o.stream(), l.stream(), bound=10))
    assert as_set(sales, "order_id", "order_detail_id") == {
        ("1", "10"), ("1", "11"), ("1", "12"), (None, "20"), (None, "30"), ("3", None)
    }


def test_allocation_carries_its_sums_from_batch_to_batch(feed, finish):
    lines = feed("wide", "order_id bigint, order_detail_id bigint, sku_price double, sku_num bigint, final_total_amount double, original_total_amount double, final_detail_amount double")

    def wide_line(order_id, n, price, paid, original):
        return (order_id, n, price, 1, paid, original, 0.0)

    lines.add(wide_line(1, 2, 40.0, 100.0, 120.0), wide_line(1, 1, 40.0, 100.0, 120.0), wide_line(2, 9, 0.0, 5.0, 0.0))
    finish(allocate_stream(lines.stream()))
    lines.add(wide_line(1, 3, 40.0, 100.0, 120.0), wide_line(3, 5, 60.0, 90.0, 100.0), wide_line(3, 6, 40.0, 90.0, 100.0))
    got = as_set(finish(allocate_stream(lines.stream())), "order_id", "order_detail_id", "final_detail_amount")
    assert got == {(1, 1, 33.33), (1, 2, 33.33), (1, 3, 33.34), (2, 9, 5.0), (3, 5, 54.0), (3, 6, 36.0)}
    assert got == as_set(allocation.allocate(lines.table()), "order_id", "order_detail_id", "final_detail_amount")


@pytest.mark.parametrize("hot_rows", [10**6, 1])
def test_allocation_with_its_sums_in_a_table(feed, spark, tmp_path, hot_rows):
    lines = feed("wide", "order_id bigint, order_detail_id bigint, sku_price double, sku_num bigint, final_total_amount double, original_total_amount double, final_detail_amount double")
    state, out = f"{tmp_path}/state", f"{tmp_path}/shares"

    def write(batch, batch_id):
        for _ in range(2):  # as if the batch ran again after its sums were written
            tables.replace_batch(allocate_batch(batch, batch_id, state, hot_rows), batch_id, out)

    def add(*data):
        lines.add(*[(o, n, price, 1, paid, original, 0.0) for o, n, price, paid, original in data])
        run.start_batches(lines.stream(), write, f"{tmp_path}/c").awaitTermination()

    add((1, 2, 40.0, 100.0, 120.0), (1, 1, 40.0, 100.0, 120.0), (2, 9, 0.0, 5.0, 0.0), (2, 10, 0.0, 5.0, 0.0))
    add((1, 3, 40.0, 100.0, 120.0), (1, 4, 0.0, 100.0, 120.0), (3, 6, 40.0, 90.0, 100.0), (3, 5, 60.0, 90.0, 100.0))
    got = as_set(spark.read.parquet(out), "order_id", "order_detail_id", "final_detail_amount")
    assert got == {
        (1, 1, 33.33), (1, 2, 33.33), (1, 3, 33.34), (1, 4, 0.0), (2, 9, 5.0), (2, 10, 0.0),
        (3, 5, 54.0), (3, 6, 36.0),
    }


WIDE = "order_id bigint, order_detail_id bigint, sku_price double, sku_num bigint, final_total_amount double, original_total_amount double, final_detail_amount double"


def test_one_rule_for_stream_and_batch_whatever_the_ids(feed, finish, spark, tmp_path):
    """Repeated and missing line ids, and lines that arrive in falling order."""
    lines = feed("wide", WIDE)
    ids = [9, 9, 9, 5, 4, 4, 3, None, None, None]
    lines.add(*[(1, n, 10.0, 1, 66.66, 100.0, 0.0) for n in ids])
    expected = sorted((str(n), 6.67) for n in ids if n != 9) + [("9", 6.63), ("9", 6.67), ("9", 6.67)]
    forms = [finish(allocate_stream(lines.stream())), *[allocation.allocate(lines.table(), hot_rows=h) for h in (10**6, 3)],
             *[allocate_batch(lines.table(), 0, f"{tmp_path}/state", h) for h in (10**6, 3)]]
    for shares in forms:
        got = [(str(r.order_detail_id), r.final_detail_amount) for r in shares.collect()]
        assert sorted(got) == sorted(expected)


def test_a_very_long_order_is_handled_by_line_id(spark):
    from pyspark.sql import Row

    from tillflow.streaming.allocation import _in_line_order

    lines = (Row(order_detail_id=n, sku_price=1.0, sku_num=1) for n in range(100_001, 0, -1))
    assert [line.order_detail_id for line in _in_line_order(lines)] == list(range(1, 100_002))


def test_windows_come_out_behind_the_watermark(feed, finish):
    events = feed("events", "at string, k int, paid double")
    events.add(("2021-01-01 00:10:00", 1, 1.0), ("2021-01-01 00:50:00", 1, 2.0))
    events.add(("2021-01-01 03:00:00", 1, 4.0))
    stream = events.stream().withColumn("ts", F.col("at").cast("timestamp")).withWatermark("ts", "10 minutes")
    got = finish(marts.amount_by_window(stream, "ts", "paid", ["k"], "1 hour"))
    assert [r.amount for r in got.collect()] == [3.0]


def test_a_batch_that_runs_again_replaces_itself(spark, rows, tmp_path):
    path = f"{tmp_path}/log"
    tables.replace_batch(rows("id int, v string", (1, "a"), (2, "b")), 0, path)
    tables.replace_batch(rows("id int, v string", (1, "c")), 1, path)
    tables.replace_batch(rows("id int, v string", (1, "c"), (3, "d")), 1, path)
    assert as_set(tables.latest_rows(spark, path, ["id"])) == {(1, "c"), (2, "b"), (3, "d")}
    tables.compact(spark, path, f"{tmp_path}/small", ["id"])
    tables.replace_batch(rows("id int, v string", (2, "e")), 2, f"{tmp_path}/small")
    assert as_set(tables.latest_rows(spark, f"{tmp_path}/small", ["id"])) == {(1, "c"), (2, "e"), (3, "d")}


def test_topics_and_kafka_options(spark, rows, tmp_path):
    root = f"{tmp_path}/topics"
    topics.write_topics(rows("topic string, value string", ("A", "1"), ("B", "2")), root)
    topics.write_topics(rows("topic string, key string, value string", ("A", "k", "3")), root)
    assert as_set(topics.read_topic(spark, root, "A")) == {(None, "1"), ("k", "3")}
    options = topics.kafka_options("host:9092", "T", {0: 5, 1: 7}, maxOffsetsPerTrigger="1000")
    assert json.loads(options["startingOffsets"]) == {"T": {"0": 5, "1": 7}}
    assert topics.kafka_options("host:9092", "T")["startingOffsets"] == "latest"


def test_session_settings_come_back_after_a_start(spark, feed, finish):
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.shuffle.partitions", "spark.sql.streaming.stateStore.providerClass")}
    logs = feed("logs", LOG)
    logs.add(log("m", 1))
    finish(first_visits_stream(logs.stream()))
    assert before == {k: spark.conf.get(k, None) for k in before}


@pytest.mark.parametrize(
    "settings, start",
    [
        ({"spark.checkpoint.dir": "hdfs://shared/"}, "hdfs://shared/tillflow/x-"),
        ({"spark.master": "local[4]"}, "/"),
        ({"spark.master": "spark://host:7077"}, None),
    ],
)
def test_folder_is_the_one_the_cluster_names(settings, start):
    class Session:
        class conf:
            @staticmethod
            def get(name, default):
                return settings.get(name, default)

    if start:
        assert run.new_folder(Session, "x").startswith(start)
    else:
        with pytest.raises(ValueError):
            run.new_folder(Session, "x")


def test_plain_append(spark, rows, tmp_path):
    for _ in range(2):
        tables.append_rows(rows("dt string, x int", ("d", 1)), f"{tmp_path}/t", by=["dt"])
    assert [tuple(r) for r in spark.read.parquet(f"{tmp_path}/t").collect()] == [(1, "d"), (1, "d")]


def change(table, **data):
    return (json.dumps({"table": table, "type": "insert", "data": data}),)


@pytest.mark.parametrize("in_tables", [False, True])
def test_all_jobs_from_change_messages_to_dashboard(spark, rows, tmp_path, in_tables):
    house = jobs.Warehouse(f"{tmp_path}/house")
    incoming = f"{tmp_path}/incoming"
    start = spark.createDataFrame(
        [
            change("base_province", id="5", name="Hebei", area_code="13", iso_code="CN-13", iso_3166_2="CN-HE"),
            change("user_info", id="1", user_level="2", birthday="1999-01-01", gender="M"),
            change("base_category3", id="61", name="phones", category2_id="13"),
            change("base_trademark", id="3", tm_name="x:y"),
            change("spu_info", id="4", spu_name="spu"),
            change("sku_info", id="7", spu_id="4", price="40", sku_name="thing", tm_id="3", category3_id="61", create_time="t"),
            change("order_info", id="100", province_id="5", order_status="1", user_id="1", final_total_amount="100", benefit_reduce_amount="20", original_total_amount="120", feight_fee="0", create_time="2021-04-08 10:00:00"),
            *[change("order_detail", id=str(n), order_id="100", sku_id="7", order_price="40", sku_num="1", sku_name="thing", create_time="2021-04-08 10:00:01") for n in (1, 2, 3, 3)],
        ],
        "value string",
    )
    start.write.parquet(incoming)

    def messages(path=incoming):
        return spark.readStream.schema("value string").parquet(path)

    def ods(table):
        return house.messages(spark, "ods", f"ODS_{table.upper()}")

    def topic(layer, name):
        return house.messages(spark, layer, name)

    def done(query):
        query.awaitTermination()

    done(jobs.start_router(messages(), route_maxwell, house, "ods"))
    for name, schema in [("base_province", schemas.PROVINCE), ("base_category3", schemas.CATEGORY3), ("base_trademark", schemas.TRADEMARK), ("spu_info", schemas.SPU_INFO)]:
        done(jobs.start_dimension(ods(name), schema, house, name))
    done(jobs.start_users(ods("user_info"), house, "2021-04-08"))
    done(jobs.start_skus(ods("sku_info"), house))
    done(jobs.start_orders(ods("order_info"), house, state_in_table=in_tables))
    done(jobs.start_details(ods("order_detail"), house))
    done(jobs.start_wide(topic("dwd_order", "DWD_ORDER_INFO"), topic("dwd_detail", "DWD_ORDER_DETAIL"), house, sums_in_table=in_tables))
    done(jobs.start_trademark_report(topic("dws", "DWS_ORDER_WIDE"), house))

    mart = spark.read.parquet(house.table("order_wide"))
    assert as_set(mart, "order_detail_id", "final_detail_amount", "if_first_order", "province_name", "user_gender", "tm_name", "spu_name", "category3_name") == {
        (n, share, "1", "Hebei", "男", "x:y", "spu", "phones") for n, share in [(1, 33.33), (2, 33.33), (3, 33.34)]
    }
    state = user_state(house.table("user_state")).now(spark)
    assert as_set(state, "user_id", "if_consumed") == {("1", "1")}

    logs = f"{tmp_path}/logs"
    spark.createDataFrame(
        [(json.dumps({"common": {"mid": m}, "start": {"entry": "icon"}, "ts": ts}),) for m, ts in [("m", 1617876000000), ("m", 1617876001000), ("n", 1617789600000)]]
        + [('{"page":1,"ts":1}',)],
        "value string",
    ).write.parquet(logs)
    done(jobs.start_router(messages(logs), split_app_log, house, "log"))
    done(jobs.start_visits(topic("log", "APP_START"), house))

    totals = dashboard.realtime_total(spark, house, "2021-04-08")
    assert as_set(totals, "id", "value") == {("dau", 1.0), ("new_mid", 1.0), ("order_amount", 100.0)}
    assert as_set(dashboard.realtime_hour(spark, house, "dau", "2021-04-08")) == {("10", 1.0, 1.0)}
    assert as_set(dashboard.realtime_hour(spark, house, "order_amount", "2021-04-08")) == {("10", 100.0, None)}
    top = dashboard.top_trademarks(spark, house, "2021-01-01 00:00:00", "2999-01-01 00:00:00", 5)
    assert as_set(top) == {("3", "x:y", 100.0)}


def test_jdbc_options(rows, monkeypatch):
    """No database here: what is handed to the writer is all that is checked."""
    seen = {}

    class Writer:
        def __getattr__(self, name):
            def call(*args, **kwargs):
                seen[name] = args or kwargs
                return self
            return call

    class Rows:
        write = Writer()

    tables.append_jdbc(Rows(), "jdbc:x", "order_wide", partitions=4, driver="d")
    assert seen["mode"] == ("append",) and seen["format"] == ("jdbc",)
    assert seen["options"] == {
        "url": "jdbc:x", "dbtable": "order_wide", "batchsize": "100", "numPartitions": "4",
        "isolationLevel": "NONE", "driver": "d",
    }
    tables.append_jdbc(Rows(), "jdbc:x", "order_wide")
    assert "numPartitions" not in seen["options"]


def test_last_write_wins_inside_a_batch_and_across_batches(spark, rows, tmp_path):
    house, incoming = jobs.Warehouse(f"{tmp_path}/house"), f"{tmp_path}/in"
    assert house.dimension(spark, "spu_info").count() == 0

    def version(name, at, position):
        return (json.dumps({"id": "1", "spu_name": name}), at, position)

    def go(*changes):
        schema = "value string, at bigint, position bigint"
        rows(schema, *changes).write.mode("append").parquet(incoming)
        feed = spark.readStream.schema(schema).parquet(incoming)
        jobs.start_dimension(feed, schemas.SPU_INFO, house, "spu_info").awaitTermination()
        return house.dimension(spark, "spu_info")

    assert as_set(go(*[version(f"v{n}", 1000, n) for n in (5, 0, 3, 9, 1)], ("5", 0, 0), ('{"spu_name":"x"}', 0, 0))) == {("1", "v9")}
    assert as_set(house.rejects(spark, "spu_info"), "value") == {("5",), ('{"spu_name":"x"}',)}
    assert as_set(go(version("old", 900, 99))) == {("1", "v9")}
    assert as_set(go(version("new", 1001, 0))) == {("1", "new")}


def test_messages_of_a_folder_have_the_order_of_their_file(spark, rows, tmp_path):
    house, root = jobs.Warehouse(f"{tmp_path}/house"), f"{tmp_path}/topics"
    changes = [("T", json.dumps({"id": "1", "spu_name": f"v{n}"})) for n in (3, 1, 7, 2, 5)]
    topics.write_topics(rows("topic string, value string", *changes).coalesce(1), root)
    feed = topics.read_topic_stream(spark, root, "T")
    jobs.start_dimension(feed, schemas.SPU_INFO, house, "spu_info").awaitTermination()
    assert as_set(house.dimension(spark, "spu_info")) == {("1", "v5")}


@pytest.mark.parametrize("in_tables", [False, True])
def test_jobs_without_dimensions_with_rejects_and_a_publisher(spark, rows, tmp_path, in_tables):
    house, incoming, sent = jobs.Warehouse(f"{tmp_path}/house"), f"{tmp_path}/in", []
    good = json.dumps({"id": "1", "user_id": "4", "province_id": "5", "create_time": "2021-04-08 10:00:00"})
    bad = ["[1]", '{"user_id":"4"}', "{broken", '{"id":"x"}']
    rows("value string", (good,), *[(b,) for b in bad]).write.parquet(incoming)

    def feed():
        return spark.readStream.schema("value string").parquet(incoming)

    def publish(batch):
        sent.extend(batch.collect())

    jobs.start_orders(feed(), house, state_in_table=in_tables, publish=publish).awaitTermination()
    if not in_tables:
        jobs.start_rejects(feed(), schemas.ORDER_INFO, house, "dwd_order", {"id": "bigint"}).awaitTermination()
    assert [(r.topic, r.key, json.loads(r.value)["if_first_order"]) for r in sent] == [("DWD_ORDER_INFO", "1", "1")]
    assert as_set(house.rejects(spark, "dwd_order"), "value") == {(b,) for b in bad}
    routed = []
    jobs.start_router(feed(), split_app_log, house, "log", publish=lambda b: routed.extend(b.collect())).awaitTermination()
    assert len(routed) == 1 + len(bad)


def test_preview_with_a_timed_trigger(spark, feed, capfd):
    numbers = feed("numbers", "id bigint")
    numbers.add((4711,))
    query = run.start_preview(numbers.stream(), "1 second")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert query.exception() is None and query.lastProgress["sink"]["numOutputRows"] >= 0
