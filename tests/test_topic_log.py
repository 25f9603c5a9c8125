"""The topic log: committed batches, positions, restarts, reruns upstream; keyed state tables."""

import json

import pytest
from conftest import as_set
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tillflow import fixed_values as fv
from tillflow.sources.files import Folder
from tillflow.sources.state import KeyedState
from tillflow.sources.topic_log import MessageFile, TopicLog, commit_batch, read_committed, read_positions, run_of
from tillflow.streaming import jobs, run

MESSAGE = "topic string, key string, value string, at bigint"


@pytest.fixture
def log(rows, tmp_path):
    class Log:
        root = f"{tmp_path}/topics"

        def commit(self, name, batch, *values, topic="T"):
            commit_batch(rows(MESSAGE, *[(topic, str(v), str(v), None) for v in values]), self.root, name, batch)

    return Log()


@pytest.fixture
def turn(spark, tmp_path):
    """Runs a stream over the log to its end, from where it stopped, and gives all it ever wrote."""

    def go(root, starting="earliest", name="out"):
        stream = read_positions(spark, root, "T", starting).select("value", "partition", "position")
        run.start_append(stream, f"{tmp_path}/{name}", f"{tmp_path}/{name}_c").awaitTermination()
        return sorted(r.value for r in spark.read.schema(stream.schema).parquet(f"{tmp_path}/{name}").collect())

    return go


# --- the log ----------------------------------------------------------------------------


def test_a_batch_is_committed_once(tmp_path):
    log = TopicLog(str(tmp_path))
    a, b = MessageFile("T", 0, "data/a", 3), MessageFile("T", 0, "data/b", 2)
    assert log.commit("r", 0, [a, MessageFile("U", 1, "data/u", 1)]) and not log.commit("r", 0, [b]) and not log.commit("r", 0, [])
    assert log.commit("r", 1, []) and log.commit("s", 0, [b])
    assert log.last() == 3 and log.ends("T", 3) == {"0": 5} and log.ends("T", 1) == {"0": 3} and log.ends("U", 3) == {"1": 1}
    assert [(s.path, s.first, s.skip) for s in log.since("T", 0, 3, {"0": 4})] == [("data/b", 3, 1)]
    assert log.since("T", 3, 3, {}) == []
    assert [log.number_before("T", {"0": n}) for n in (0, 2, 3, 4, 5, 9)] == [0, 0, 2, 2, 3, 3]


def test_a_lost_hint_and_a_second_writer(tmp_path):
    log = TopicLog(str(tmp_path))
    for n in range(4):
        log.commit("r", n, [])
    Folder(str(tmp_path)).put("commits/_last", "1")
    assert log.last() == 4
    assert not Folder(str(tmp_path)).put(log._name(4), "{}", only_new=True)
    assert log.commit("r", 4, []) and log.last() == 5


def test_files_of_a_batch_that_was_there_are_removed(spark, log, tmp_path):
    log.commit("r", 0, 1, 2, 3)
    count = len(list((tmp_path / "topics" / "data").iterdir()))
    log.commit("r", 0, 4, 5)
    assert len(list((tmp_path / "topics" / "data").iterdir())) == count
    assert as_set(read_committed(spark, log.root, "T"), "value") == {("1",), ("2",), ("3",)}


# --- positions --------------------------------------------------------------------------


def test_restart_without_loss_or_repeat(log, turn):
    log.commit("r", 0, *range(20))
    log.commit("r", 0, 99, topic="other")
    assert turn(log.root) == sorted(map(str, range(20)))
    assert turn(log.root) == sorted(map(str, range(20)))
    log.commit("r", 1, *range(20, 30))
    log.commit("r", 0, *range(50))  # the first batch ran again upstream, with other rows
    log.commit("r", 1)  # and the second came back empty
    assert turn(log.root) == sorted(map(str, range(30)))
    log.commit("new checkpoint", 0, 30)  # another run counts from 0 again
    assert turn(log.root) == sorted(map(str, range(31)))


def test_starting_positions(spark, log, turn):
    log.commit("r", 0, *range(20))
    ends = {int(p): n for p, n in TopicLog(log.root).ends("T", 1).items()}
    assert turn(log.root, "latest", "late") == []
    log.commit("r", 1, *range(20, 40))
    assert turn(log.root, "latest", "late") == sorted(map(str, range(20, 40)))
    assert turn(log.root, ends, "given") == sorted(map(str, range(20, 40)))
    one = {p: n - 1 for p, n in ends.items()}
    last = read_committed(spark, log.root, "T").filter(" OR ".join(f"partition = {p} AND position >= {n}" for p, n in one.items()))
    assert turn(log.root, one, "inside") == sorted(r.value for r in last.collect())


def test_places_are_dense_and_keys_keep_their_partition(spark, log):
    for n in range(3):
        log.commit("r", n, *range(50))
    rows = read_committed(spark, log.root, "T")
    for r in rows.groupBy("partition").agg(F.count("*").alias("n"), F.max("position").alias("high"), F.countDistinct("position").alias("d")).collect():
        assert r.n == r.d == r.high + 1
    assert rows.groupBy("key").agg(F.countDistinct("partition").alias("n")).filter("n > 1").count() == 0
    assert rows.filter("at IS NULL").count() == 0


def test_only_new_manifests_are_opened(log, spark, monkeypatch):
    for n in range(6):
        log.commit("r", n, n)
    opened, real = [], TopicLog.manifest
    monkeypatch.setattr(TopicLog, "manifest", lambda self, number: opened.append(number) or real(self, number))
    assert len(TopicLog(log.root).since("T", 4, 6, {})) == 2 and opened == [5, 6]


def test_a_stream_of_topics_is_committed_by_batch(spark, rows, tmp_path):
    house, incoming = jobs.Warehouse(f"{tmp_path}/house"), f"{tmp_path}/in"

    def route(messages):
        return messages.select(F.lit("T").alias("topic"), F.col("value"))

    for n in range(2):
        rows("value string", (f"v{n}",)).write.mode("append").parquet(incoming)
        feed = spark.readStream.schema("value string").parquet(incoming)
        jobs.start_router(feed, route, house, "ods").awaitTermination()
    assert as_set(read_committed(spark, house.topics("ods"), "T"), "value") == {("v0",), ("v1",)}
    runs = TopicLog(house.topics("ods")).manifest(TopicLog(house.topics("ods")).last())["runs"]
    assert list(runs) == [house.run("route_ods")] and run_of(house.checkpoint("route_ods")) == house.run("route_ods")


def test_report_is_unchanged_by_reruns_and_adds_for_a_new_checkpoint(spark, rows, tmp_path):
    house = jobs.Warehouse(f"{tmp_path}/house")

    def send(name, batch, *amounts):
        lines = [(fv.TOPIC_ORDER_WIDE, None, json.dumps({"tm_id": 3, "tm_name": "x", "final_detail_amount": x}), None) for x in amounts]
        commit_batch(rows(MESSAGE, *lines), house.topics("dws"), name, batch)
        jobs.start_trademark_report(house.messages(spark, "dws", fv.TOPIC_ORDER_WIDE), house).awaitTermination()
        stat = spark.read.parquet(house.table("trademark_amount_stat"))
        return stat.agg(F.sum("amount").cast("double")).first()[0]

    assert send("a", 0, 1.25, 2.0) == 3.25
    assert send("a", 0, 1.25, 2.0) == 3.25
    assert send("a", 0) == 3.25
    assert send("a", 1, 1.0) == 4.25
    assert send("b", 0, 1.0) == 5.25


# --- state ------------------------------------------------------------------------------

SUMS = StructType([StructField("k", LongType()), StructField("n", LongType())])


def sums(path, **more):
    return KeyedState(str(path), SUMS, ("k",), lambda rows: rows.groupBy("k").agg(F.sum("n").alias("n")), **more)


def test_state_does_not_grow_with_the_number_of_batches(spark, rows, tmp_path):
    state, sizes = sums(tmp_path / "s", buckets=4, tail_batches=2), []
    for batch in range(12):
        state.compact(spark, "r", batch)
        here = rows("k bigint, n bigint", *[(k, 1) for k in range(40)], (None, 1))
        known = {r.k: r.n for r in state.before(here, "r", batch).collect()}
        assert known == ({k: batch for k in [*range(40), None]} if batch else {})
        for _ in range(2):  # as if the batch ran again
            state.add(here, "r", batch)
        sizes.append(state.live_bytes())
    assert max(sizes[6:]) <= max(sizes[3:6]) * 1.2
    assert {r.k: r.n for r in state.now(spark).collect()} == {k: 12 for k in [*range(40), None]}


def test_state_of_several_runs_and_expiry(spark, rows, tmp_path):
    state = sums(tmp_path / "s", tail_batches=0, expired=F.col("n") < 0)
    assert state.now(spark).count() == 0 and state.before(rows("k bigint", (1,)), "a", 0).count() == 0
    state.add(rows("k bigint, n bigint", (1, 5), (2, -1)), "seed", -1)
    state.add(rows("k bigint, n bigint", (1, 2)), "a", 0)
    assert as_set(state.before(rows("k bigint", (1,), (3,)), "b", 0)) == {(1, 7)}
    assert state.compact(spark, "b", 0) and not state.compact(spark, "b", 0)
    assert as_set(state.now(spark)) == {(1, 7)}
    state.add(rows("k bigint, n bigint", (1, 1)), "b", 0)
    assert as_set(state.before(rows("k bigint", (1,)), "b", 0)) == {(1, 7)}
    assert as_set(state.before(rows("k bigint", (1,)), "b", 1)) == {(1, 8)}
    assert state.compact(spark, "b", 1) and as_set(state.now(spark)) == {(1, 8)}
