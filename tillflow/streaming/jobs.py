"""The running jobs: routers, dimensions, orders, lines, wide orders, reports, visits.

Each job starts one streaming query. Input is a stream of (key, value) messages
from Kafka or a topic folder; progress and state live in the checkpoint. Without
``every`` a job handles what there is and ends.

Output of the order jobs goes through ``foreachBatch``: the dimension tables are
read anew for every batch, so their updates are seen, and every batch replaces
its own partition of the output. Topics between jobs are logs of committed batches
(``sources.topic_log``): a batch that is run again upstream is seen once, and a job
with a new checkpoint is a new run, which adds and replaces nothing.

Messages a job can't use (not one JSON object, or without a readable id or time)
go to the table ``rejects``, by job; they are neither lost nor do they stop it.
"""

import time
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from tillflow import fixed_values as fv
from tillflow import schemas
from tillflow.functions.records import parse_records, rejects, to_messages
from tillflow.operators import dims, marts, orders
from tillflow.operators.keyed import latest_by_key
from tillflow.sources.state import KeyedState
from tillflow.sources.tables import replace_batch
from tillflow.sources.topic_log import commit_batch, read_positions, run_of
from tillflow.sources.topics import VERSION, with_key
from tillflow.streaming.allocation import allocate_batch, allocate_stream
from tillflow.streaming.orders import flag_batch, flag_first_orders_stream, seed_state, user_state
from tillflow.streaming.run import start_append, start_batches, start_topics
from tillflow.streaming.visits import first_visits_stream
from tillflow.streaming.wide import join_lines_stream


_HAS_ID = {"id": "bigint"}
# When a row of a dimension was written, in nanoseconds.
_WRITTEN = "written"
# What a message of the wide join must have.
WIDE_NEEDS = {"id": "bigint", "create_time": "timestamp"}


@dataclass(frozen=True)
class Warehouse:
    """Where the tables of one warehouse live, below a folder all executors share."""

    root: str

    def table(self, name: str) -> str:
        return f"{self.root}/tables/{name}"

    def topics(self, layer: str) -> str:
        return f"{self.root}/topics/{layer}"

    def checkpoint(self, job: str) -> str:
        return f"{self.root}/checkpoints/{job}"

    def run(self, job: str) -> str:
        """The run that a job's checkpoint stands for."""
        return run_of(self.checkpoint(job))

    def messages(
        self, spark: SparkSession, layer: str, topic: str, starting: str | dict[int, int] = "earliest"
    ) -> DataFrame:
        """A topic of a layer as a stream of committed messages, from given positions."""
        return read_positions(spark, self.topics(layer), topic, starting)

    def dimension_state(self, name: str) -> KeyedState:
        """The newest row per id of a dimension, as a table of state.

        The newest is the one whose change came last at the source; among equal or
        missing places the one that was written last.
        """
        added = StructType([StructField(c, LongType()) for c in (*VERSION, _WRITTEN)])
        schema = StructType([*schemas.DIMENSIONS[name].fields, *added.fields])

        def merge(rows: DataFrame) -> DataFrame:
            return latest_by_key(rows, ["id"], added.names)

        return KeyedState(self.table(name), schema, ("id",), merge)

    def dimension(self, spark: SparkSession, name: str) -> DataFrame:
        """The rows of a dimension; none before its job has first written."""
        return self.dimension_state(name).now(spark).drop(*VERSION, _WRITTEN)

    def keep_rejects(
        self, batch: DataFrame, batch_id: int, job: str, schema: StructType, required: dict[str, str]
    ) -> None:
        """Writes the messages of a batch that ``parse_records`` leaves out."""
        replace_batch(
            _message(rejects(batch, schema, required=required)), batch_id, self._rejects(job), run=self.run(job)
        )

    def rejects(self, spark: SparkSession, job: str) -> DataFrame:
        """The messages a job could not use."""
        return spark.read.schema("key string, value string").parquet(self._rejects(job))

    def _rejects(self, job: str) -> str:
        return f"{self.table('rejects')}/job={job}"


def _message(messages: DataFrame) -> DataFrame:
    key = F.col("key") if "key" in messages.columns else F.lit(None)
    return messages.select(key.cast("string").alias("key"), "value")


Publish = Callable[[DataFrame], None]


def _send(messages: DataFrame, batch_id: int, house: Warehouse, job: str, publish: Publish | None) -> None:
    """Messages of a batch to the topics of a layer, once, and to ``publish`` as well."""
    keyed = with_key(messages)
    commit_batch(keyed, house.topics(job), house.run(job), batch_id)
    if publish:
        publish(keyed)


def start_rejects(
    messages: DataFrame,
    schema: StructType,
    house: Warehouse,
    job: str,
    required: dict[str, str] | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Keeps what a job over a stream-to-stream operator can't use.

    For ``start_wide`` and ``start_visits``, whose input does not pass a batch
    function; the other jobs keep their rejects themselves.
    """
    return start_append(
        _message(rejects(messages, schema, required=required)),
        house._rejects(job), house.checkpoint(f"rejects_{job}"), every,
    )


# --- routing ----------------------------------------------------------------------


def start_router(
    messages: DataFrame,
    route: Callable[[DataFrame], DataFrame],
    house: Warehouse,
    layer: str,
    every: str | None = None,
    publish: Publish | None = None,
) -> StreamingQuery:
    """Routes messages to the topics of a layer, as committed batches.

    ``route`` is one of ``split_app_log``, ``route_canal`` and ``route_maxwell``.
    With ``publish`` (for example ``write_kafka`` with its servers) each batch of
    routed messages goes there instead, at least once.
    """
    routed = with_key(route(messages))
    if publish:
        return start_batches(
            routed, lambda batch, _: publish(batch), house.checkpoint(f"route_{layer}"), every
        )
    return start_topics(
        routed, house.topics(layer), house.run(f"route_{layer}"), house.checkpoint(f"route_{layer}"), every
    )


# --- dimensions -------------------------------------------------------------------


def start_dimension(
    messages: DataFrame,
    schema: StructType,
    house: Warehouse,
    name: str,
    every: str | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Keeps a dimension up to date from its change messages: last write wins per id.

    The last write is told by the messages' columns ``at`` and ``position``
    (``topics.VERSION``), which stay in the changelog. Messages without them are
    told by batch only. ``prepare`` adds columns to a batch, for example
    ``label_users``.
    """
    required = {"id": "string"}
    keep = [name for name in VERSION if name in messages.columns]

    def write(batch: DataFrame, batch_id: int) -> None:
        house.keep_rejects(batch, batch_id, name, schema, required)
        rows = parse_records(batch, schema, required=required, keep=keep)
        rows = (prepare(rows) if prepare else rows).withColumn(_WRITTEN, F.lit(time.time_ns()))
        state, run = house.dimension_state(name), house.run(name)
        for field in state.schema.fields:
            if field.name not in rows.columns:
                rows = rows.withColumn(field.name, F.lit(None).cast(field.dataType))
        state.compact(batch.sparkSession, run, batch_id)
        state.add(state.merge(rows.select(*state.schema.names)), run, batch_id)

    return start_batches(messages, write, house.checkpoint(name), every)


def start_users(
    messages: DataFrame, house: Warehouse, as_of: str, every: str | None = None
) -> StreamingQuery:
    """Users with age group and gender name as of a date."""

    def label(users: DataFrame) -> DataFrame:
        return dims.label_users(users, F.lit(as_of).cast("date"))

    return start_dimension(messages, schemas.USER_INFO, house, "user_info", every, label)


def start_skus(messages: DataFrame, house: Warehouse, every: str | None = None) -> StreamingQuery:
    """SKUs with the names of their category, trademark and SPU."""

    def name(skus: DataFrame) -> DataFrame:
        spark = skus.sparkSession
        lookups = (
            house.dimension(spark, table)
            for table in ("base_category3", "base_trademark", "spu_info")
        )
        return dims.name_skus(skus, *lookups)

    return start_dimension(messages, schemas.SKU_INFO, house, "sku_info", every, name)


# --- orders and lines ----------------------------------------------------------------


def start_orders(
    messages: DataFrame,
    house: Warehouse,
    known: DataFrame | None = None,
    every: str | None = None,
    state_in_table: bool = True,
    publish: Publish | None = None,
) -> StreamingQuery:
    """Orders with dates, first-order flag, province and user, as keyed messages.

    Also keeps the table of users who have ordered. ``known`` are users who
    ordered before the job's first start. With ``state_in_table`` that table is
    the state itself, so one user may bring much of a batch; without it the state
    store holds a mark per user, and ``start_rejects`` keeps the rejects.
    """

    def parsed(feed: DataFrame) -> DataFrame:
        return orders.add_order_dates(parse_records(feed, schemas.ORDER_INFO, required=_HAS_ID))

    state = house.table("user_state")
    if state_in_table:
        rows = messages
        empty = rows.sparkSession.createDataFrame([], schemas.USER_STATE)
        seed_state(empty if known is None else known, state)
    else:
        rows = flag_first_orders_stream(parsed(messages), known)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if state_in_table:
            house.keep_rejects(batch, batch_id, "dwd_order", schemas.ORDER_INFO, _HAS_ID)
            batch = parsed(batch)
        batch.persist()
        try:
            if state_in_table:
                flagged = flag_batch(batch, batch_id, state, house.run("dwd_order"))
            else:
                flagged = batch
                user_state(state).add(orders.new_customers(batch), house.run("dwd_order"), batch_id)
            full = orders.add_user(
                orders.add_province(flagged, house.dimension(spark, "base_province")),
                house.dimension(spark, "user_info"),
            )
            _send(
                to_messages(full, fv.TOPIC_ORDER_INFO, key="id"), batch_id, house, "dwd_order", publish,
            )
        finally:
            batch.unpersist()

    return start_batches(rows, write, house.checkpoint("dwd_order"), every)


def start_details(
    messages: DataFrame,
    house: Warehouse,
    every: str | None = None,
    publish: Publish | None = None,
) -> StreamingQuery:
    """Order lines with their SKU's ids and names, as messages keyed by order."""

    def write(batch: DataFrame, batch_id: int) -> None:
        house.keep_rejects(batch, batch_id, "dwd_detail", schemas.ORDER_DETAIL, _HAS_ID)
        rows = parse_records(batch, schemas.ORDER_DETAIL, required=_HAS_ID)
        full = orders.add_sku(rows, house.dimension(batch.sparkSession, "sku_info"))
        _send(
            to_messages(full, fv.TOPIC_ORDER_DETAIL, key="order_id"), batch_id, house, "dwd_detail", publish,
        )

    return start_batches(messages, write, house.checkpoint("dwd_detail"), every)


# --- wide orders and reports ---------------------------------------------------------


def start_wide(
    order_messages: DataFrame,
    detail_messages: DataFrame,
    house: Warehouse,
    every: str | None = None,
    bound: int = fv.JOIN_WINDOW_SECONDS,
    delay: str = "1 minute",
    ttl_ms: int | None = None,
    salts: int = 1,
    sums_in_table: bool = True,
    also: Callable[[DataFrame], None] | None = None,
    publish: Publish | None = None,
) -> StreamingQuery:
    """Both feeds without repeats, joined, allocated; to messages and to the mart.

    ``also`` gets every batch as well, for example to append it over JDBC. With
    ``sums_in_table`` the sums per order are kept in a table, else in the state
    store, where ``ttl_ms`` lets them expire. That table and ``salts`` are for
    feeds where one order may bring much of a batch. Orders and lines need an id
    and a time; ``start_rejects`` with ``WIDE_NEEDS`` keeps the others.
    """
    joined = join_lines_stream(
        parse_records(order_messages, schemas.ENRICHED_ORDER, required=WIDE_NEEDS),
        parse_records(detail_messages, schemas.ENRICHED_DETAIL, required=WIDE_NEEDS),
        bound=bound,
        delay=delay,
        salts=salts,
    )
    sums = house.table("order_sums")
    rows = joined if sums_in_table else allocate_stream(joined, ttl_ms)

    def write(batch: DataFrame, batch_id: int) -> None:
        paid = batch.persist()
        try:
            if sums_in_table:
                paid = allocate_batch(batch, batch_id, sums, run=house.run("dws")).persist()
            _send(to_messages(paid, fv.TOPIC_ORDER_WIDE), batch_id, house, "dws", publish)
            replace_batch(paid, batch_id, house.table("order_wide"), by=["dt"], run=house.run("dws"))
            if also:
                also(paid)
        finally:
            paid.unpersist()
            batch.unpersist()

    return start_batches(rows, write, house.checkpoint("dws"), every)


def start_trademark_report(
    messages: DataFrame,
    house: Warehouse,
    every: str | None = None,
    clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
) -> StreamingQuery:
    """Paid amount per trademark of every batch, stamped with the batch's time."""

    def write(batch: DataFrame, batch_id: int) -> None:
        house.keep_rejects(batch, batch_id, "ads_trademark", schemas.ORDER_WIDE, {})
        rows = parse_records(batch, schemas.ORDER_WIDE)
        replace_batch(
            marts.trademark_stat(rows, F.lit(clock()).cast("timestamp")), batch_id,
            house.table("trademark_amount_stat"), run=house.run("ads_trademark"),
        )

    return start_batches(messages, write, house.checkpoint("ads_trademark"), every)


# --- visits -----------------------------------------------------------------------


def start_visits(
    messages: DataFrame, house: Warehouse, every: str | None = None, salts: int = 1
) -> StreamingQuery:
    """First visit per device and day, to a table partitioned by the day of the visit."""
    first = first_visits_stream(parse_records(messages, schemas.APP_LOG), salts=salts)
    return start_append(
        first, house.table("dau_info"), house.checkpoint("dau_info"), every, by=["dt"]
    )
