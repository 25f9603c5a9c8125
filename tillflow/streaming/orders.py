"""First-order flag on a stream of orders."""

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StringType, StructField, StructType

from tillflow import fixed_values as fv
from tillflow.operators.orders import flag_first_orders, new_customers
from tillflow.schemas import USER_STATE
from tillflow.sources.state import ONLY_RUN, SEED, KeyedState

_FLAG = "if_first_order"


def _flagged(order: Row, flag: str) -> Row:
    return Row(**order.asDict(), **{_FLAG: flag})


def _place(order: Row) -> tuple:
    """By time, then id, NULLs first, as in ``first_orders``."""
    at, number = order.create_time, order.id
    return (at is not None, at or "", number is not None, number or 0)


class _FirstOrder(StatefulProcessor):
    """Per user one mark: has ordered before."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._ordered = handle.getValueState("ordered", "yes boolean")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self._ordered.update((True,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = self._ordered.exists()
        # Of a new user only the earliest order so far is held back; the others
        # are later ones and leave at once, so a user may have any number.
        held = None
        for order in rows:
            if known:
                yield _flagged(order, fv.LATER_ORDER)
            elif held is None:
                held = order
            elif _place(order) < _place(held):
                yield _flagged(held, fv.LATER_ORDER)
                held = order
            else:
                yield _flagged(order, fv.LATER_ORDER)
        if held is not None:
            self._ordered.update((True,))
            yield _flagged(held, fv.FIRST_ORDER)

    def close(self) -> None:
        pass


def user_state(path: str) -> KeyedState:
    """The table of users who have ordered."""

    def merge(rows: DataFrame) -> DataFrame:
        return rows.groupBy("user_id").agg(F.max("if_consumed").alias("if_consumed"))

    return KeyedState(path, USER_STATE, ("user_id",), merge)


def seed_state(known: DataFrame, state_path: str) -> None:
    """Writes the users who ordered before the first batch; there may be none."""
    user_state(state_path).add(known, SEED, -1)


def flag_batch(rows: DataFrame, batch_id: int, state_path: str, run: str = ONLY_RUN) -> DataFrame:
    """``if_first_order`` for one micro-batch, with the state in a table.

    For ``foreachBatch``, where one user may bring a large part of a batch: the
    flag is found by a combined aggregation and nothing passes through Python.
    The users whose first order is in this batch are added to ``user_state``
    under the run and the batch's number, and only what earlier batches wrote
    counts, so a batch that runs again comes to the same result. Persist the
    batch first: it is read more than once.
    """
    state = user_state(state_path)
    state.compact(rows.sparkSession, run, batch_id)
    known = state.before(rows.select(F.col("user_id").cast("string").alias("user_id")), run, batch_id)
    flagged = flag_first_orders(rows, known)
    state.add(new_customers(flagged), run, batch_id)
    return flagged


def flag_first_orders_stream(orders: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """Adds ``if_first_order`` to a stream of orders.

    The first order to *arrive* gets the flag; among those that arrive in one
    batch the earliest. An earlier order that comes in a later batch does not
    take it over, unlike in the batch form. ``state`` (a batch table of user_id,
    if_consumed) tells which users ordered before the stream began.
    """
    kept = [f for f in orders.schema.fields if f.name != _FLAG]
    initial = None
    if state is not None:
        initial = (
            state.filter(F.col("if_consumed") == fv.FIRST_ORDER)
            .select(F.col("user_id").try_cast("bigint").alias("user_id"))
            .groupBy("user_id")
        )
    return (
        orders.select(*[f.name for f in kept])
        .groupBy("user_id")
        .transformWithState(
            statefulProcessor=_FirstOrder(),
            outputStructType=StructType([*kept, StructField(_FLAG, StringType())]),
            outputMode="Append",
            timeMode="None",
            initialState=initial,
        )
    )
