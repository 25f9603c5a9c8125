"""Catalog queries that run the streaming operators over the given tables.

Each runs a stream over all rows of its tables to the end and returns what was
written. The files of a table are not in time order. Some queries give the
watermark a delay longer than the tables' time span, so no row is late; others
first commit the rows as messages in parts by time and run the stream after each
part, from where it stopped, so the watermark moves and state is dropped; a closing
record at the end lets out what is still held.
"""

from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tillflow import fixed_values as fv
from tillflow import schemas
from tillflow.functions.records import to_messages
from tillflow.operators import marts, orders, routing
from tillflow.plans import adapters as a
from tillflow.plans.catalog import _paid, _window_texts, query
from tillflow.plans.parameters import (
    CHAIN_DAYS, INTERVAL_DAYS, NEVER_LATE, STATE_BEFORE, STREAM_SALTS,
)
from tillflow.scratch import written
from tillflow.sources.tables import replace_batch
from tillflow.sources.topic_log import TopicLog, commit_batch, read_positions
from tillflow.sources.topics import with_key
from tillflow.streaming import jobs
from tillflow.streaming.allocation import allocate_batch, allocate_stream
from tillflow.streaming.orders import flag_batch, flag_first_orders_stream, seed_state
from tillflow.streaming.run import END_OF_INPUT, new_folder, run_to_table, start_append, start_batches
from tillflow.streaming.visits import first_visits_by_time
from tillflow.streaming.wide import JoinTables, join_lines_stream, join_sales_stream

_DAY = 86_400
_AT = "_at"
# Parts by time of the feeds that are joined. A part's rows are in the state at once.
TURNS = 8
_POLL = "1 second"
_FEED = "feed"


@query
def log_route_stream(spark, sf_dir):
    logs = a.as_text(a.app_logs(a.table_stream(spark, sf_dir, "events")))
    return run_to_table(routing.split_app_log(logs), "log_route").select(
        "topic",
        F.get_json_object("value", "$.common.mid").alias("mid"),
        F.get_json_object("value", "$.ts").cast("bigint").alias("ts"),
    )


def _parts(rows, by: str, count: int = 3):
    """``rows`` in parts by time, of about equal length in time."""
    bounds = rows.agg(F.min(by).alias("low"), F.max(by).alias("high")).first()
    step = (bounds.high - bounds.low) / count
    cuts = [bounds.low + step * i for i in range(1, count)]
    edges = [None, *cuts, None]
    for low, high in zip(edges, edges[1:], strict=False):
        part = rows if low is None else rows.filter(F.col(by) >= F.lit(low))
        yield part if high is None else part.filter(F.col(by) < F.lit(high))


def _cuts(feeds, by, count):
    """Microseconds that cut the rows of all feeds together into ``count`` parts of about as
    many rows, and the seconds that the longest part may take."""
    times = reduce(DataFrame.unionByName, [rows.select(by) for rows in feeds])
    shares = [i / count for i in range(count + 1)]
    found = times.agg(F.percentile_approx(by, shares).alias("cuts"), F.min(by).alias("low"), F.max(by).alias("high")).first()
    if found.low is None:
        return [], 0
    cuts = sorted(set(found.cuts[1:-1]))
    edges = [found.low, *cuts, found.high]
    return cuts, max(high - low for low, high in zip(edges, edges[1:], strict=False)) // 1_000_000 + 1


def _between(rows, by, cuts):
    """``rows`` in parts by time; those without one are in the first."""
    for low, high in zip([None, *cuts], [*cuts, None], strict=True):
        part = rows if low is None else rows.filter(F.col(by) >= low)
        yield part if high is None else part.filter((F.col(by) < high) | F.col(by).isNull())


class _Turns:
    """Messages committed in parts, and a stream over them that runs on after each part.

    A run takes all that is committed as one micro-batch; the next one starts with the
    watermark that it left.
    """

    def __init__(self, spark, name):
        self.spark, self.folder, self.number = spark, new_folder(spark, name), 0
        self.root = f"{self.folder}/topics"

    def commit(self, topic, rows, key, batch=None):
        """The rows as JSON; returns the number of the batch."""
        message = F.to_json(F.struct("*")).alias("value")
        messages = rows.select(F.lit(topic).alias("topic"), F.col(key).cast("string").alias("key"), message)
        self.number += batch is None
        commit_batch(with_key(messages), self.root, "turns", self.number if batch is None else batch)
        return self.number if batch is None else batch

    def commit_all(self, feeds):
        """Rows of several topics (topic, rows, key) as one batch: a stream meets all of them at once."""
        messages = [
            rows.select(
                F.lit(topic).alias("topic"), F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value")
            )
            for topic, rows, key in feeds
        ]
        self.number += 1
        commit_batch(with_key(reduce(DataFrame.unionByName, messages)), self.root, "turns", self.number)

    @contextmanager
    def running(self, rows):
        """The stream ``rows`` makes, running until the end of the block: its state stays open between parts.

        What the watermark lets out comes with the next part, so the state is searched once a part.
        """
        query = start_append(rows, f"{self.folder}/rows", f"{self.folder}/checkpoint", every=_POLL, trailing=False)
        try:
            yield query
        finally:
            query.stop()

    def rows(self, rows):
        return self.spark.read.schema(rows.schema).parquet(f"{self.folder}/rows")

    def stream(self, topic, schema, starting="earliest"):
        parsed = F.from_json("value", schema).alias("row")
        return read_positions(self.spark, self.root, topic, starting).select(parsed).select("row.*")

    def close(self, run, *ends):
        """Commits closing records (topic, row, key), and what they let out comes with the next message."""
        for _ in range(2):
            for topic, row, key in ends:
                self.commit(topic, row, key)
            rows = run()
        return rows

    def run(self, rows):
        """One run of the stream ``rows`` makes, to the end of what is committed."""
        query = start_append(rows, f"{self.folder}/rows", f"{self.folder}/checkpoint")
        query.awaitTermination()
        return self.rows(rows)


def _end(spark, schema, **values):
    """A closing record: its time, else nothing."""
    free = StructType([StructField(f.name, f.dataType) for f in schema.fields])
    return spark.createDataFrame([tuple(values.get(n) for n in schema.names)], free)


@query
def dau_first_visit_stream(spark, sf_dir):
    """Earliest visits by event time; a day comes out when it is over."""
    logs = a.app_logs(a.table(spark, sf_dir, "events"))
    turns, schema = _Turns(spark, "first_visit"), logs.schema

    def run():
        return turns.run(first_visits_by_time(turns.stream("APP_LOG", schema)))

    for part in _parts(logs, "ts"):
        turns.commit("APP_LOG", part, "ts")
        run()
    return turns.close(run, ("APP_LOG", _end(spark, schema, ts=int(END_OF_INPUT.timestamp() * 1000)), "ts"))


@query
def topic_positions_stream(spark, sf_dir):
    """Events from given positions on; a restart and a repeated batch upstream bring nothing twice."""
    events = a.table(spark, sf_dir, "events").select("event_id", "user_id", a.instant("ts").alias("ts"))
    before, first, second = _parts(events, "ts")
    turns = _Turns(spark, "topic_positions")
    turns.commit("EVENTS", before, "user_id")
    log = TopicLog(turns.root)
    positions = {int(p): at for p, at in log.ends("EVENTS", log.last()).items()}

    def run():
        return turns.run(turns.stream("EVENTS", events.schema, positions))

    number = turns.commit("EVENTS", first, "user_id")
    run()
    turns.commit("EVENTS", first, "user_id", batch=number)
    turns.commit("EVENTS", second, "user_id")
    return run().select("event_id", "user_id")


@query
def dim_changelog_stream(spark, sf_dir):
    """Every line as a change of its part: many versions of an id in a batch, in no order."""
    rows = a.table_stream(spark, sf_dir, "lineitem")
    change = F.struct(
        F.col("l_partkey").alias("id"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("sku_name"),
    )
    messages = rows.select(
        F.to_json(change).alias("value"),
        F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("at"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("bigint").alias("position"),
    )
    house = jobs.Warehouse(new_folder(spark, "dim_changelog"))
    jobs.start_dimension(messages, schemas.SKU_INFO, house, "sku_info").awaitTermination()
    return house.dimension(spark, "sku_info").select("id", "sku_name")


def _known_and_new(spark, sf_dir):
    """Users who ordered before a date, and the orders since then as a stream."""
    before = orders.add_order_dates(a.order_info(a.table(spark, sf_dir, "orders")))
    known = orders.new_customers(
        orders.flag_first_orders(before.filter(F.col("create_date") < STATE_BEFORE))
    )
    stream = orders.add_order_dates(a.order_info(a.table_stream(spark, sf_dir, "orders")))
    rows = stream.filter(F.col("create_date") >= STATE_BEFORE)
    return known, rows.select("id", "user_id", "create_time")


@query
def order_first_flag_stream(spark, sf_dir):
    """The flag with its state in the state store."""
    known, rows = _known_and_new(spark, sf_dir)
    return run_to_table(flag_first_orders_stream(rows, known), "first_flag").drop("create_time")


@query
def order_first_flag_batch_stream(spark, sf_dir):
    """The flag with its state in a table."""
    known, rows = _known_and_new(spark, sf_dir)
    folder = new_folder(spark, "first_flag_batches")
    seed_state(known, f"{folder}/state")

    def write(batch, batch_id):
        flagged = flag_batch(batch, batch_id, f"{folder}/state")
        replace_batch(flagged, batch_id, f"{folder}/rows")

    start_batches(rows, write, f"{folder}/checkpoint").awaitTermination()
    written = spark.read.schema("id bigint, user_id bigint, if_first_order string")
    return written.parquet(f"{folder}/rows").select("id", "user_id", "if_first_order")


def _in_turns(spark, sf_dir, name, join):
    """What ``join`` makes of both feeds, whose rows come as files in parts by time.

    One stream runs through; a part is written when it has handled the one before. The
    watermark's delay is the longest part, so no row is late even if a part is met in
    pieces, and what no later row can meet is dropped: the state holds some parts and
    the reach of the join, not both feeds. Of the others their ids are kept for good.
    """
    folder, query = new_folder(spark, name), None
    tables = {
        "orders": a.table(spark, sf_dir, "orders").withColumn(_AT, a.order_time()),
        "lineitem": a.table(spark, sf_dir, "lineitem").withColumn(_AT, a.line_time()),
    }
    feeds = [rows.withColumn(_FEED, F.lit(feed)) for feed, rows in tables.items()]
    both = feeds[0].unionByName(feeds[1], allowMissingColumns=True)
    cuts, longest = _cuts([both], _AT, TURNS)
    try:
        for part in _between(both, _AT, cuts):
            part.drop(_AT).write.mode("append").partitionBy(_FEED).parquet(f"{folder}/feeds")
            if query is None:
                came = spark.readStream.schema(both.drop(_AT).schema).parquet(f"{folder}/feeds")
                o, l = [came.filter(F.col(_FEED) == feed).select(*rows.drop(_AT).columns) for feed, rows in tables.items()]
                rows = join(orders.add_order_dates(a.order_info(o)), a.order_detail(l), f"{longest} seconds")
                query = start_append(rows, f"{folder}/rows", f"{folder}/checkpoint", every=_POLL, trailing=False)
            query.processAllAvailable()
    finally:
        if query is not None:
            query.stop()
    return spark.read.schema(rows.schema).parquet(f"{folder}/rows")


@query
def order_wide_stream(spark, sf_dir):
    def join(o, l, delay):
        return join_lines_stream(
            o, a.with_sku_name(l), bound=INTERVAL_DAYS * _DAY, delay=delay, salts=STREAM_SALTS, forget=False
        )

    return _in_turns(spark, sf_dir, "order_wide", join)


def _sides(spark, sf_dir):
    o = orders.add_order_dates(a.order_info(a.table_stream(spark, sf_dir, "orders")))
    l = a.order_detail(a.table_stream(spark, sf_dir, "lineitem"))
    return o, l


@query
def sale_interval_stream(spark, sf_dir):
    joined = join_sales_stream(
        *_sides(spark, sf_dir), bound=INTERVAL_DAYS * _DAY, delay=NEVER_LATE, how="inner",
        salts=STREAM_SALTS, forget=False,
    )
    rows = joined.select("order_id", "order_detail_id", "user_id", "sku_price", "dt")
    return run_to_table(rows, "sale", trailing=False)


def _joined_with_totals(spark, sf_dir):
    """Both feeds, each without repeats, joined to wide records, as a stream.

    A stream tells the last line by the order's original total, so the orders
    are first written with the sum of their lines as that total.
    """
    line = a.order_detail(a.table(spark, sf_dir, "lineitem"))
    totals = line.groupBy(F.col("order_id").alias("id")).agg(
        marts.sum_amount(F.col("order_price") * F.col("sku_num")).alias("original_total_amount")
    )
    written = new_folder(spark, "orders_with_totals")
    complete = a.order_info(a.table(spark, sf_dir, "orders")).drop("original_total_amount")
    complete.join(totals, "id").write.parquet(written)
    schema = spark.read.parquet(written).schema
    files = spark.readStream.schema(schema).option("maxFilesPerTrigger", a.FILES_PER_BATCH)
    stream = files.parquet(written).select(F.struct(*_ORDER_NEEDS).alias("order"))
    lines = a.order_detail(a.table_stream(spark, sf_dir, "lineitem")).select(F.struct(*_LINE_NEEDS).alias("line"))
    both, folder = stream.unionByName(lines, allowMissingColumns=True), new_folder(spark, "joined_with_totals")

    def join(batch, batch_id):
        joined = join_lines_stream(
            batch.filter(F.col("order").isNotNull()).select("order.*"),
            batch.filter(F.col("line").isNotNull()).select("line.*"),
            bound=CHAIN_DAYS * _DAY, delay=NEVER_LATE, salts=STREAM_SALTS, forget=False,
            tables=JoinTables(f"{folder}/state", batch_id),
        )
        replace_batch(joined.select(*_SPLIT, *_SPLIT_BY), batch_id, f"{folder}/rows")

    start_batches(both, join, f"{folder}/checkpoint", trailing=False).awaitTermination()
    joined = spark.read.parquet(f"{folder}/rows").select(*_SPLIT, *_SPLIT_BY)
    return spark.readStream.schema(joined.schema).parquet(f"{folder}/rows").select(*joined.columns)


_SPLIT = ("order_id", "order_detail_id", "final_detail_amount")
# What the shares depend on besides. The state of both feeds holds what these need.
_SPLIT_BY = ("sku_price", "sku_num", "final_total_amount", "original_total_amount")
_ORDER_NEEDS = ("id", "create_time", "final_total_amount", "original_total_amount")
_LINE_NEEDS = ("id", "order_id", "create_time", "order_price", "sku_num")


@query
def order_split_amount_stream(spark, sf_dir):
    """The whole chain with the sums per order in the state store."""
    paid = allocate_stream(_joined_with_totals(spark, sf_dir))
    return run_to_table(paid, "split_amount", trailing=False).select(*_SPLIT)


@query
def order_split_amount_batch_stream(spark, sf_dir):
    """The whole chain with the sums per order in a table."""
    joined = _joined_with_totals(spark, sf_dir)
    folder = new_folder(spark, "split_amount_batches")

    def write(batch, batch_id):  # the joined rows are files, so nothing is kept to read them again
        paid = allocate_batch(batch, batch_id, f"{folder}/state")
        replace_batch(paid, batch_id, f"{folder}/rows")

    start_batches(joined, write, f"{folder}/checkpoint", trailing=False).awaitTermination()
    return spark.read.schema(joined.schema).parquet(f"{folder}/rows").select(*_SPLIT)


@query
def trademark_window_stream(spark, sf_dir):
    """Hourly amounts; windows come out once the watermark has passed their end, the last ones behind a closing record.

    The sums are combined before the shuffle, whatever a key's share of it.
    """
    rows = a.table(spark, sf_dir, "events").select(
        a.instant("ts").alias("ts"),
        F.get_json_object("props", "$.k").cast("bigint").alias("tm_id"),
        F.col("value").alias("paid"),
    )
    turns, schema = _Turns(spark, "trademark_window"), rows.schema

    def run():
        timed = turns.stream("PAID", schema).withWatermark("ts", "10 minutes").filter(F.col("ts") < END_OF_INPUT)
        return turns.run(marts.amount_by_window(timed, "ts", "paid", ["tm_id"], "1 hour"))

    for part in _parts(rows, "ts"):
        turns.commit("PAID", part, "tm_id")
        run()
    return _window_texts(turns.close(run, ("PAID", _end(spark, schema, ts=END_OF_INPUT), "tm_id")))


@query
def sale_full_outer_stream(spark, sf_dir):
    """Pairs, and rows of either side that met none, which come out when their time is over.

    Both feeds come in parts by time, both parts in one commit, to one stream that runs
    through. The closing records move the watermark, and let out the rest when they come again.
    """
    o = orders.add_order_dates(a.order_info(a.table(spark, sf_dir, "orders")))
    l = a.with_sku_name(a.order_detail(a.table(spark, sf_dir, "lineitem")))
    turns, feeds = _Turns(spark, "sale_full_outer"), {"ORDERS": (o, "id"), "LINES": (l, "order_id")}
    timed = [rows.withColumn(_AT, F.unix_micros(F.to_timestamp("create_time"))) for rows, _ in feeds.values()]
    cuts, _ = _cuts(timed, _AT, TURNS)
    joined = join_sales_stream(
        turns.stream("ORDERS", o.schema), turns.stream("LINES", l.schema), bound=INTERVAL_DAYS * _DAY
    )
    end = END_OF_INPUT.strftime("%Y-%m-%d %H:%M:%S")
    ends = [_end(spark, rows.schema, create_time=end) for rows, _ in feeds.values()]

    def commit(parts):
        turns.commit_all([(topic, part.drop(_AT), key) for (topic, (_, key)), part in zip(feeds.items(), parts, strict=True)])

    first, *others = [*zip(*[_between(rows, _AT, cuts) for rows in timed], strict=True), ends, ends]
    commit(first)  # a stream that meets no message yet would open all of its state for nothing
    with turns.running(joined) as query:
        query.processAllAvailable()
        for parts in others:
            commit(parts)
            query.processAllAvailable()
    return turns.rows(joined)


@query
def trademark_stat_stream(spark, sf_dir):
    """Report rows per batch; a batch that is run again upstream changes none.

    Two batches of paid lines are committed, the first of them twice, and the
    report runs after each. Its rows add up to the amounts per trademark.
    """
    part = a.table(spark, sf_dir, "part")
    brands = a.sku_info(part).select(F.col("id").cast("bigint").alias("sku_id"), F.col("tm_id").cast("bigint").alias("tm_id"))
    names = a.trademarks(part).select(F.col("id").cast("bigint").alias("tm_id"), "tm_name")
    lines = _paid(spark, sf_dir).select("order_id", "order_detail_id", "sku_id", "final_detail_amount")
    lines = lines.join(brands, "sku_id", "left").join(names, "tm_id", "left").drop("sku_id", "order_detail_id")
    lines = written(lines, "paid_lines")  # each commit reads them
    house = jobs.Warehouse(new_folder(spark, "trademark_stat"))
    messages = with_key(to_messages(lines, fv.TOPIC_ORDER_WIDE))
    halves = [with_key(to_messages(lines.filter(F.col("order_id") % 2 == i), fv.TOPIC_ORDER_WIDE)) for i in (0, 1)]
    for batch, half in ((0, halves[0]), (0, halves[0]), (1, halves[1]), (1, messages.limit(0))):
        commit_batch(half, house.topics("dws"), "upstream", batch)
        jobs.start_trademark_report(house.messages(spark, "dws", fv.TOPIC_ORDER_WIDE), house).awaitTermination()
    stat = spark.read.schema(schemas.TRADEMARK_STAT).parquet(house.table("trademark_amount_stat"))
    return stat.groupBy("trademark_id", "trademark_name").agg(F.sum("amount").cast("double").alias("amount"))
