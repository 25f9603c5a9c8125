"""The query catalog: every operator as a query over the given tables.

Each query takes (spark, sf_dir), reads whole tables and returns a DataFrame.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.functions.records import malformed, parse_records, rejects, to_messages
from tillflow.operators import allocation, dims, keyed, marts, orders, routing, search, visits, wide
from tillflow.operators.skew import hot_keys
from tillflow.plans import adapters as a
from tillflow.plans.parameters import (
    AS_OF, COMPARE_DAY, INTERVAL_DAYS, SLIDE_DAYS, STATE_BEFORE, TOP, TOP_END, TOP_START,
    VISIT_DAY, WINDOW_DAYS, WORD_ONE, WORD_TWO, WORD_TEXT,
)
from tillflow.schemas import APP_LOG, ORDER_INFO
from tillflow.scratch import written

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
_DAY = 86_400


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- shared parts -----------------------------------------------------------------


def _orders(spark, sf_dir) -> DataFrame:
    return orders.add_order_dates(a.order_info(a.table(spark, sf_dir, "orders")))


def _details(spark, sf_dir) -> DataFrame:
    return a.order_detail(a.table(spark, sf_dir, "lineitem"))


def _skus(spark, sf_dir) -> DataFrame:
    part = a.table(spark, sf_dir, "part")
    return dims.name_skus(a.sku_info(part), a.categories(part), a.trademarks(part), a.spus(part))


def _users(spark, sf_dir) -> DataFrame:
    users = a.user_info(a.table(spark, sf_dir, "customer"))
    return dims.label_users(users, F.lit(AS_OF).cast("date"))


def _logs(spark, sf_dir) -> DataFrame:
    return a.app_logs(a.table(spark, sf_dir, "events"))


def _enriched_orders(spark, sf_dir, rows: DataFrame | None = None) -> DataFrame:
    found = a.with_province(_orders(spark, sf_dir) if rows is None else rows, a.table(spark, sf_dir, "customer"))
    provinces = a.province(a.table(spark, sf_dir, "nation"))
    return orders.add_user(orders.add_province(found, provinces), _users(spark, sf_dir))


def _paid(spark, sf_dir, hot: DataFrame | None = None) -> DataFrame:
    """Allocated lines; brand columns are left to those who join them."""
    paid = allocation.paid_lines(_orders(spark, sf_dir), _details(spark, sf_dir), hot=hot)
    return paid.drop("tm_id", "tm_name")


def _by_brand(spark, sf_dir, by_sku: DataFrame) -> DataFrame:
    """Sums per SKU with their brand; only sums are joined, never lines."""
    part = a.table(spark, sf_dir, "part")
    brand = a.sku_info(part).select(F.col("id").cast("bigint").alias("sku_id"), "tm_id").join(
        a.trademarks(part).withColumnRenamed("id", "tm_id"), "tm_id", "left"
    )
    return by_sku.join(brand.withColumn("tm_id", F.col("tm_id").cast("bigint")), "sku_id", "left")


def _purchases(spark, sf_dir) -> DataFrame:
    """Events as dated amounts of a brand."""
    brand = F.get_json_object("props", "$.k")
    return a.table(spark, sf_dir, "events").select(
        a.instant("ts").alias("ts"), brand.cast("bigint").alias("tm_id"), F.col("value").alias("paid")
    )


# --- routing and parsing -------------------------------------------------------------


@query
def log_route(spark, sf_dir):
    routed = routing.split_app_log(a.as_text(_logs(spark, sf_dir)))
    return routed.select(
        "topic",
        F.get_json_object("value", "$.common.mid").alias("mid"),
        F.get_json_object("value", "$.ts").cast("bigint").alias("ts"),
    )


def _routed(messages: DataFrame) -> DataFrame:
    return messages.select("topic", F.json_tuple("value", "id", "note").alias("id", "note"))


@query
def cdc_maxwell_route(spark, sf_dir):
    changes = a.row_changes(*[a.table(spark, sf_dir, t) for t in ("orders", "lineitem", "customer", "region")])
    return _routed(routing.route_maxwell(changes))


@query
def cdc_canal_route(spark, sf_dir):
    changes = a.array_changes(*[a.table(spark, sf_dir, t) for t in ("orders", "lineitem")])
    return _routed(routing.route_canal(changes))


@query
def cdc_typed_parse(spark, sf_dir):
    rows = a.order_info(a.table(spark, sf_dir, "orders"))
    quoted = rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns])
    messages = to_messages(quoted, "ODS_ORDER_INFO", key="id")
    return parse_records(messages, ORDER_INFO).select(
        "id", "user_id", "order_status", "final_total_amount", "feight_fee", "create_time"
    )


@query
def malformed_messages(spark, sf_dir):
    texts = a.table(spark, sf_dir, "documents").select(F.col("text").alias("value"))
    sound = a.table(spark, sf_dir, "events").select(F.col("props").alias("value"))
    return malformed(texts.unionByName(sound)).select(
        F.md5("value").alias("digest"), F.length("value").alias("n_chars")
    )


@query
def message_rejects(spark, sf_dir):
    """Texts that hold no single JSON object: prose, lists, plain values, objects with a tail."""
    props = F.col("props")
    forms = F.array(
        props, F.concat(F.lit("["), props, F.lit("]")), F.get_json_object(props, "$.k"),
        F.concat(props, F.lit(","), props), F.concat(props, F.lit(" end")), F.lit("null"),
    )
    events = a.table(spark, sf_dir, "events").select(F.explode(forms).alias("value"))
    texts = a.table(spark, sf_dir, "documents").select(F.col("text").alias("value"))
    found = rejects(texts.unionByName(events), ORDER_INFO)
    return found.select(F.md5("value").alias("digest"), F.length("value").alias("n_chars"))


# --- visits -----------------------------------------------------------------------


@query
def dau_first_visit(spark, sf_dir):
    messages = a.as_text(_logs(spark, sf_dir))
    return visits.first_visits(parse_records(messages, APP_LOG))


@query
def dau_total(spark, sf_dir):
    return visits.dau_total(visits.visit_starts(_logs(spark, sf_dir)))


@query
def dau_hour(spark, sf_dir):
    return visits.dau_by_hour(visits.visit_starts(_logs(spark, sf_dir)))


@query
def dau_hour_map(spark, sf_dir):
    by_day = marts.hour_map(dau_hour(spark, sf_dir), "dau")
    keys = F.array_sort(F.map_keys("by_hour"))
    pairs = F.transform(keys, lambda h: F.concat(h, F.lit("="), F.col("by_hour")[h].cast("string")))
    return by_day.select("dt", F.array_join(pairs, ",").alias("by_hour"))


@query
def dau_hour_compare(spark, sf_dir):
    return marts.realtime_hour("dau", VISIT_DAY, dau_hour(spark, sf_dir), None)


@query
def dau_busiest_hours(spark, sf_dir):
    one_day = marts.on_day(dau_hour(spark, sf_dir), VISIT_DAY)
    return visits.busiest_hours(one_day)


@query
def new_devices(spark, sf_dir):
    return visits.new_devices(_logs(spark, sf_dir).select("common.mid", "ts"))


# --- dimensions -------------------------------------------------------------------


@query
def dim_user(spark, sf_dir):
    return _users(spark, sf_dir)


@query
def dim_sku(spark, sf_dir):
    return _skus(spark, sf_dir)


@query
def dim_latest(spark, sf_dir):
    events = a.table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return keyed.latest_by_key(events, ["user_id"], ["ts", "event_id"]).drop("ts")


@query
def dim_batch_lookup(spark, sf_dir):
    users = a.user_info(a.table(spark, sf_dir, "customer"))
    return dims.rows_for_batch(users, "id", _orders(spark, sf_dir).select(F.col("user_id").cast("string")), "user_id")


# --- orders and lines ----------------------------------------------------------------


@query
def order_dates(spark, sf_dir):
    return _orders(spark, sf_dir).select("id", "create_time", "create_date", "create_hour")


@query
def order_first_flag(spark, sf_dir):
    return orders.flag_first_orders(_orders(spark, sf_dir)).select("id", "user_id", "if_first_order")


@query
def order_first_flag_state(spark, sf_dir):
    rows = _orders(spark, sf_dir)
    known = orders.new_customers(orders.flag_first_orders(rows.filter(F.col("create_date") < STATE_BEFORE)))
    later = rows.filter(F.col("create_date") >= STATE_BEFORE)
    return orders.flag_first_orders(later, known).select("id", "user_id", "if_first_order")


@query
def new_customer_state(spark, sf_dir):
    return orders.new_customers(orders.flag_first_orders(_orders(spark, sf_dir)))


@query
def order_enriched(spark, sf_dir):
    return _enriched_orders(spark, sf_dir).select(
        "id", "user_id", "province_id", "province_name", "province_area_code",
        "province_iso_code", "province_iso_3166_2", "user_age_group", "user_gender",
    )


@query
def detail_enriched(spark, sf_dir):
    return orders.add_sku(_details(spark, sf_dir), _skus(spark, sf_dir)).select(
        "id", "order_id", "sku_id", "spu_id", "tm_id", "category3_id",
        "spu_name", "tm_name", "category3_name",
    )


# --- wide orders ------------------------------------------------------------------


@query
def order_wide(spark, sf_dir):
    flagged = _enriched_orders(spark, sf_dir, orders.flag_first_orders(_orders(spark, sf_dir)))
    # The lines meet their SKU as they are in the table: ids and names, which are texts made
    # of those numbers, come after that shuffle.
    skus, lines = _skus(spark, sf_dir), a.table(spark, sf_dir, "lineitem").withColumn("sku_id", F.col("l_partkey"))
    found = orders.add_sku(lines, skus)
    added = tuple(c for c in found.columns if c not in lines.columns)
    return wide.join_lines(flagged, a.with_sku_name(a.order_detail(found, keep=added)))


def _dated(spark, sf_dir):
    """Orders and lines with only ids and times, as ``at``."""
    o = a.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), a.instant("o_orderdate").alias("at"))
    l = a.table(spark, sf_dir, "lineitem").select(
        a.detail_id().alias("id"), F.col("l_orderkey").alias("order_id"), a.instant("l_shipdate").alias("at")
    )
    return o, l


@query
def order_wide_interval(spark, sf_dir):
    o, l = _dated(spark, sf_dir)
    twice = [keyed.distinct_by_id(side.unionByName(side), ["id"]) for side in (o, l)]
    near = wide.seconds_apart("at", "at", INTERVAL_DAYS * _DAY)
    return wide.join_lines(*twice, near).select("order_id", "order_detail_id")


@query
def order_wide_left(spark, sf_dir):
    o, l = _dated(spark, sf_dir)
    near = wide.seconds_apart("at", "at", INTERVAL_DAYS * _DAY)
    return wide.join_lines(o, l, near, how="left").select("order_id", "order_detail_id")


@query
def order_wide_sliding(spark, sf_dir):
    shared = wide.share_a_window("at", "at", WINDOW_DAYS * _DAY, SLIDE_DAYS * _DAY)
    return wide.join_lines(*_dated(spark, sf_dir), shared).select("order_id", "order_detail_id")


@query
def sale_full_outer(spark, sf_dir):
    o = _orders(spark, sf_dir).withColumn("at", F.to_timestamp("create_time"))
    l = a.with_sku_name(_details(spark, sf_dir)).withColumn("at", F.to_timestamp("create_time"))
    near = wide.seconds_apart("at", "at", INTERVAL_DAYS * _DAY)
    return wide.join_sales(o, l, near)


@query
def order_split_amount(spark, sf_dir):
    return _paid(spark, sf_dir).select("order_id", "order_detail_id", "final_detail_amount")


@query
def order_running_sums(spark, sf_dir):
    hot = written(hot_keys(_details(spark, sf_dir), ["order_id"]), "hot-orders")  # looked up more than once
    return allocation.running_sums(_paid(spark, sf_dir, hot), hot).select(
        "order_id", "order_detail_id", "origin_before", "split_before"
    )


# --- reports ----------------------------------------------------------------------


@query
def trademark_amount(spark, sf_dir):
    sums = _by_brand(spark, sf_dir, marts.amount_by_sku(_paid(spark, sf_dir)))
    return sums.groupBy("tm_id", "tm_name").agg(F.sum("amount").cast("double").alias("amount"))


@query
def trademark_window(spark, sf_dir):
    windows = marts.amount_by_window(_purchases(spark, sf_dir), "ts", "paid", ["tm_id"], "1 hour")
    return _window_texts(windows)


@query
def amount_sliding(spark, sf_dir):
    windows = marts.amount_by_window(
        _purchases(spark, sf_dir), "ts", "paid", [], "10 minutes", "5 minutes"
    )
    return _window_texts(windows)


def _window_texts(windows: DataFrame) -> DataFrame:
    pattern = "yyyy-MM-dd HH:mm:ss"
    return windows.withColumns(
        {c: F.date_format(c, pattern) for c in ("window_start", "window_end")}
    )


@query
def trademark_topn(spark, sf_dir):
    stats = _by_brand(spark, sf_dir, marts.amount_by_sku(_paid(spark, sf_dir), "dt")).select(
        F.col("dt").cast("timestamp").alias("stat_time"),
        F.col("tm_id").cast("string").alias("trademark_id"),
        F.col("tm_name").alias("trademark_name"),
        "amount",
    )
    return marts.top_trademarks(stats, TOP_START, TOP_END, TOP)


@query
def order_amount_day(spark, sf_dir):
    return marts.order_amount_by_day(_paid(spark, sf_dir))


@query
def order_amount_hour(spark, sf_dir):
    return marts.order_amount_by_hour(_paid(spark, sf_dir))


@query
def order_amount_hour_compare(spark, sf_dir):
    return marts.realtime_hour(
        "order_amount", COMPARE_DAY, None, order_amount_hour(spark, sf_dir)
    )


@query
def realtime_total(spark, sf_dir):
    amount = (
        _purchases(spark, sf_dir)
        .groupBy(F.date_format("ts", "yyyy-MM-dd").alias("dt"))
        .agg(marts.sum_amount(F.col("paid")).alias("order_amount"))
    )
    return marts.realtime_total(
        VISIT_DAY, dau_total(spark, sf_dir), new_devices(spark, sf_dir), amount
    )


@query
def doc_search(spark, sf_dir):
    documents = a.table(spark, sf_dir, "documents").withColumn(
        "words",
        F.transform(F.split(F.lower("text"), " "), lambda w: F.struct(w.alias("id"))),
    )
    found = search.search(documents, "words", "id", [WORD_ONE, WORD_TWO], "text", WORD_TEXT)
    return found.select("doc_id", "lang")
