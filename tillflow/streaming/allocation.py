"""Splitting the paid amount over the lines of an order as they arrive."""

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

from tillflow.functions.money import from_cents, share_cents, to_cents
from tillflow.operators.allocation import line_cents, paid_cents, sums_before
from tillflow.operators.skew import HOT_ROWS, hot_keys
from tillflow.sources.state import ONLY_RUN, KeyedState

_SHARE = "final_detail_amount"
_SUMS = ("origin", "split", "lines")
_BUCKET = "_bucket"
# Groups of orders in the state store. Each costs some calls to Python per micro-batch.
ORDER_BUCKETS = 8192
_STATE = StructType([StructField(c, LongType()) for c in ("order_id", *_SUMS)])


def _cents(amount: float) -> int:
    return math.floor(amount * 100 + 0.5)


def _in_line_order(rows: Iterator[Row]) -> list[Row]:
    """Lines of one order and batch by id, price and number, NULLs first, as in the batch operators."""

    def place(line: Row) -> tuple:
        values = (line.order_detail_id, line.sku_price, line.sku_num)
        return tuple(part for v in values for part in (v is not None, v if v is not None else 0))

    return sorted(rows, key=place)


def _entry(sums: dict) -> tuple[list, list, list]:
    return list(sums), [origin for origin, _ in sums.values()], [split for _, split in sums.values()]


class _Allocation(StatefulProcessor):
    """Per order two running sums in cents: line amounts and shares given out.

    A key is a bucket of orders, and its state a list of entries, one for each micro-batch, with
    the orders of the batch and their sums; of an order the last ones count. So the calls to the
    state and the batches of rows that come back are as many as there are buckets, not orders.
    """

    def __init__(self, order_type: str, ttl_ms: int | None):
        self._order_type, self._ttl_ms = order_type, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        entry = f"orders array<{self._order_type}>, origins array<bigint>, splits array<bigint>"
        self._sums = handle.getListState("sums", entry, self._ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        orders: dict[object, list[Row]] = {}
        for line in rows:
            orders.setdefault(line.order_id, []).append(line)
        held, sums = 0, {}
        for known, origins, splits in self._sums.get():
            sums.update(zip(known, zip(origins, splits)))
            held += len(known)
        now = {}
        names = [n for n in next(iter(orders.values()))[0].__fields__ if n != _BUCKET]
        place, made = names.index(_SHARE), Row(*names)
        for order, lines in orders.items():
            origin, split = sums.get(order, (0, 0))
            for line in _in_line_order(lines):
                share = None
                if None not in (line.sku_price, line.sku_num, line.final_total_amount,
                                line.original_total_amount):
                    amount = _cents(line.sku_price) * line.sku_num
                    paid, whole = _cents(line.final_total_amount), _cents(line.original_total_amount)
                    origin += amount
                    if origin == whole:
                        share = paid - split
                    elif whole:
                        share = (2 * amount * paid + whole) // (2 * whole)
                    split += share or 0
                values = [line[n] for n in names]
                values[place] = None if share is None else share / 100
                yield made(*values)
            now[order] = (origin, split)
        everything = sums | now
        # What expires is written once; else an entry takes the place of all when half is replaced.
        if self._ttl_ms is None and held + len(now) > 2 * len(everything):
            self._sums.put([_entry(everything)])
        else:
            self._sums.appendList([_entry(now)])

    def close(self) -> None:
        pass


def allocate_stream(wide: DataFrame, ttl_ms: int | None = None) -> DataFrame:
    """Fills ``final_detail_amount`` on a stream of wide records.

    A stream cannot count an order's lines, so the last one is the line with
    which the running amount reaches ``original_total_amount``; it gets what is
    left. When that stored total does not match the lines, no line is the last
    and all shares are by ratio. With ``ttl_ms`` the sums of an order are
    forgotten that long after its last line.

    Orders meet the state in buckets by their id. A task holds the lines that one
    bucket has in one micro-batch, to sort them by order. Where an order may bring
    more than fits, use ``allocate_batch``, the default of the jobs: it has the same
    rule and no such group.
    """
    bucket = F.pmod(F.xxhash64("order_id"), F.lit(ORDER_BUCKETS)).cast("int")
    order_type = wide.schema["order_id"].dataType.simpleString()
    return wide.withColumn(_BUCKET, bucket).groupBy(_BUCKET).transformWithState(
        statefulProcessor=_Allocation(order_type, ttl_ms),
        outputStructType=wide.schema,
        outputMode="Append",
        timeMode="ProcessingTime" if ttl_ms else "None",
    )


def order_sums(path: str) -> KeyedState:
    """The table of the sums per order."""

    def merge(rows: DataFrame) -> DataFrame:
        return rows.groupBy("order_id").agg(*[F.sum(n).alias(n) for n in _SUMS])

    return KeyedState(path, _STATE, ("order_id",), merge)


def allocate_batch(
    wide: DataFrame, batch_id: int, state_path: str, hot_rows: int = HOT_ROWS, run: str = ONLY_RUN
) -> DataFrame:
    """``allocate_stream`` for one micro-batch, with the state in a table.

    For ``foreachBatch``, where one order may bring a large part of a batch: the
    running sums inside the batch are those of the batch operators, by line id
    and whatever the size, and nothing passes through Python. Every batch adds
    its sums per order to ``order_sums`` under the run and its own number, and
    only those of earlier batches count, so a batch that runs again comes to the
    same result. Persist the batch first: it is read more than once.
    """
    state = order_sums(state_path)
    state.compact(wide.sparkSession, run, batch_id)
    whole = to_cents(F.col("original_total_amount"))
    earlier = state.before(wide, run, batch_id).select("order_id", *[F.col(n).alias(f"_earlier_{n}") for n in _SUMS])
    lines = wide.withColumns(
        {
            "_origin": line_cents(),
            "_split": share_cents(line_cents(), whole, paid_cents()),
            "_lines": F.lit(1).cast("bigint"),
        }
    )
    summed = sums_before(lines, _SUMS, hot_keys(wide, ["order_id"], hot_rows))

    def before(name: str):
        return F.col(f"_before_{name}") + F.coalesce(f"_earlier_{name}", F.lit(0))

    # The last line is the one that reaches the total; of an order that is all
    # free it is the first.
    reaches = before("origin") + F.col("_origin") == whole
    is_last = reaches & ((F.col("_origin") > 0) | (before("lines") == 0))
    share = (
        F.when(is_last, paid_cents() - before("split"))
        .when(whole == 0, F.lit(0))
        .otherwise(F.col("_split"))
    )
    paid = summed.join(earlier, "order_id", "left").withColumn("_share", share)
    sums = paid.groupBy("order_id").agg(
        F.sum("_origin").alias("origin"),
        F.coalesce(F.sum("_share"), F.lit(0)).alias("split"),
        F.count(F.lit(1)).alias("lines"),
    )
    state.add(sums, run, batch_id)
    others = [c for c in wide.columns if c != _SHARE]
    return paid.select(*others, from_cents(F.col("_share")).alias(_SHARE)).select(*wide.columns)
