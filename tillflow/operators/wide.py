"""Orders joined with their lines: wide records and sale records.

Inputs have the shape of ``schemas.ENRICHED_ORDER`` and ``ENRICHED_DETAIL``; a
column that an input lacks comes out as NULL.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillflow import schemas
from tillflow.operators.skew import HOT_ROWS, hot_keys, split_hot

# Output column -> source column.
_WIDE_FROM_ORDER = {
    "order_id": "id",
    "order_status": "order_status",
    "create_time": "create_time",
    "user_id": "user_id",
    "benefit_reduce_amount": "benefit_reduce_amount",
    "original_total_amount": "original_total_amount",
    "feight_fee": "feight_fee",
    "final_total_amount": "final_total_amount",
    "if_first_order": "if_first_order",
    "province_name": "province_name",
    "province_area_code": "province_area_code",
    "user_age_group": "user_age_group",
    "user_gender": "user_gender",
    "dt": "create_date",
}
_WIDE_FROM_LINE = {
    "order_detail_id": "id",
    "sku_id": "sku_id",
    "sku_price": "order_price",
    "sku_num": "sku_num",
    "sku_name": "sku_name",
    "spu_id": "spu_id",
    "tm_id": "tm_id",
    "category3_id": "category3_id",
    "spu_name": "spu_name",
    "tm_name": "tm_name",
    "category3_name": "category3_name",
}
_SALE_FROM_ORDER = {
    "order_id": "id",
    "order_status": "order_status",
    "create_time": "create_time",
    "user_id": "user_id",
    "dt": "create_date",
}
_SALE_FROM_LINE = {
    "order_detail_id": "id",
    "sku_id": "sku_id",
    "sku_price": "order_price",
    "sku_name": "sku_name",
}
_SALE_TEXT = ("order_detail_id", "order_id", "user_id", "sku_id")


def _record(
    schema: StructType,
    orders: DataFrame,
    lines: DataFrame,
    from_order: dict[str, str],
    from_line: dict[str, str],
    fixed: dict[str, str],
) -> list[str]:
    """``schema`` as SQL expressions over inputs aliased ``o`` and ``l``.

    A field comes from its side if that has it, else it is a fixed value or NULL.
    """
    present = {"o": set(orders.columns), "l": set(lines.columns)}
    source = {
        **{output: ("o", name) for output, name in from_order.items()},
        **{output: ("l", name) for output, name in from_line.items()},
    }
    expressions = []
    for field in schema.fields:
        side, name = source.get(field.name, (None, None))
        if side and name in present[side]:
            value = f"{side}.{name}"
            if field.name in _SALE_TEXT and schema is schemas.SALE_DETAIL:
                value = f"CAST({value} AS STRING)"
        else:
            value = f"CAST({fixed.get(field.name, 'NULL')} AS {field.dataType.simpleString()})"
        expressions.append(f"{value} AS {field.name}")
    return expressions


def wide_columns(orders: DataFrame, lines: DataFrame) -> list[str]:
    """The wide record, from inputs aliased ``o`` and ``l``."""
    return _record(
        schemas.ORDER_WIDE, orders, lines, _WIDE_FROM_ORDER, _WIDE_FROM_LINE,
        {"final_detail_amount": "0"},
    )


def sale_columns(orders: DataFrame, lines: DataFrame) -> list[str]:
    """The sale record; ids are text, gender, age and level stay unset."""
    return _record(
        schemas.SALE_DETAIL, orders, lines, _SALE_FROM_ORDER, _SALE_FROM_LINE, {"user_age": "0"}
    )


def same_order() -> Column:
    return F.col("o.id") == F.col("l.order_id")


def seconds_apart(order_time: str, line_time: str, bound: int) -> Column:
    """Order and line at most ``bound`` seconds apart, as a range on the line's time.

    The interval is a literal: only then can a stream tell how long to keep rows.
    """
    reach = F.expr(f"INTERVAL {int(bound)} SECOND")
    at, line_at = F.col(f"o.{order_time}"), F.col(f"l.{line_time}")
    return (line_at >= at - reach) & (line_at <= at + reach)


def share_a_window(order_time: str, line_time: str, window: int, slide: int) -> Column:
    """Order and line fall into at least one common sliding window (lengths in seconds).

    With windows a whole number of slides long this only asks how many slides
    lie between the two, so no row is copied per window, and each pair comes
    out once without removing duplicates.
    """
    if window % slide:
        raise ValueError("the window must be a whole number of slides")

    def slot(ts: str) -> Column:
        return F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / F.lit(slide))

    return F.abs(slot(f"o.{order_time}") - slot(f"l.{line_time}")) < F.lit(window // slide)


def join_lines(
    orders: DataFrame, lines: DataFrame, condition: Column | None = None, how: str = "inner"
) -> DataFrame:
    """Wide records of orders and lines.

    ``how="left"`` also keeps the lines whose order is missing, so lost lines
    can be seen. The lines are the left side: a hot order is then a skewed
    partition that adaptive execution can split for both kinds of join.
    """
    on = same_order() if condition is None else same_order() & condition
    return (
        lines.alias("l").join(orders.alias("o"), on, how).selectExpr(*wide_columns(orders, lines))
    )


def join_sales(
    orders: DataFrame,
    lines: DataFrame,
    condition: Column | None = None,
    hot: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Full outer join to sale records: each pair once, unmatched rows of both sides kept.

    Spark cannot split a skewed partition of a full outer join, so the lines of
    hot orders take another way: a left join against those few orders, plus the
    hot orders that met no line.
    """
    on = same_order() if condition is None else same_order() & condition
    hot = hot_keys(lines, ["order_id"], hot_rows) if hot is None else hot
    few_lines, many_lines = split_hot(lines, hot, ["order_id"])
    cold_orders, hot_orders = split_hot(orders, hot.withColumnRenamed("order_id", "id"), ["id"])
    columns = sale_columns(orders, lines)

    ordinary = few_lines.alias("l").join(cold_orders.alias("o"), on, "full").selectExpr(*columns)
    crowded = many_lines.alias("l").join(
        F.broadcast(hot_orders.alias("o")), on, "left"
    )
    met = crowded.filter(F.col("o.id").isNotNull()).select(F.col("o.id").alias("id")).distinct()
    alone = hot_orders.join(F.broadcast(met), "id", "left_anti").alias("o")
    nothing = few_lines.limit(0).alias("l")
    return (
        ordinary.unionByName(crowded.selectExpr(*columns))
        .unionByName(alone.join(nothing, same_order(), "left").selectExpr(*columns))
    )
