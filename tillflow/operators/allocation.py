"""Splitting the paid amount of an order exactly over its lines.

Every line gets ``round(amount * paid / sum of amounts)``, and the last line of
the order gets what is left, so the shares of an order always add up to the
amount paid. The sum of amounts is taken over the lines themselves, so a wrong
stored total cannot break this. Lines are ordered by id, then by price and
number, NULLs first, so a line that occurs twice has one place for each copy and
one copy is the last; ``distinct_by_id`` removes copies. Amounts must not be
negative.

An order whose lines are all free has no ratio: its last line gets everything.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillflow.functions.money import from_cents, share_cents, to_cents
from tillflow.operators.skew import HOT_ROWS, hot_keys, join_by_key, split_hot, spread_copies
from tillflow.operators.wide import join_lines
from tillflow.scratch import written

_ORDER = "order_id"
_SHARE = "final_detail_amount"
# The order of an order's lines. Rows equal in all three have equal shares.
_BY_LINE = ("order_detail_id", "sku_price", "sku_num")


def line_cents() -> Column:
    """Line amount before discounts, in cents."""
    return to_cents(F.col("sku_price")) * F.col("sku_num")


def paid_cents() -> Column:
    return to_cents(F.col("final_total_amount"))


def _with_share(rows: DataFrame, is_last: Column, share_sum: Column) -> DataFrame:
    """Fills in ``_share``, or for the last line what all others leave of the paid amount."""
    share, none = F.col("_share"), F.lit(0)
    rest = paid_cents() - (F.coalesce(share_sum, none) - F.coalesce(share, none))
    final = from_cents(F.when(is_last, rest).otherwise(share))
    return rows.withColumn(_SHARE, final)


def allocate_in_windows(wide: DataFrame) -> DataFrame:
    """Shares by windows over each order: one shuffle, shared with the join before it."""
    order = W.partitionBy(_ORDER).orderBy(*_BY_LINE)
    whole = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    amount, share = F.col("_amount"), F.col("_share")
    summed = wide.select("*", line_cents().alias("_amount")).select(
        "*", share_cents(amount, F.sum(amount).over(whole), paid_cents()).alias("_share")
    )
    return _with_share(
        summed,
        is_last=F.lead(F.lit(True)).over(order).isNull(),
        share_sum=F.sum(share).over(whole),
    ).drop("_amount", "_share")


def allocate_by_sums(wide: DataFrame) -> DataFrame:
    """The same shares for orders with very many lines, which no task could hold.

    Sums are combined before the shuffle and go back to the lines by broadcast.
    There is one row of sums per hot order, so at most ``MAX_HOT_KEYS``. No line is
    dealt by its order, and none is put in order: the last line is a maximum, and
    where it occurs more than once its copies are equal in all columns, so they
    are counted, left out, and come back as one that gets the rest and others
    that get their share.
    """
    others = [c for c in wide.columns if c not in _BY_LINE]
    line = F.struct(*_BY_LINE, *others)
    lines = wide.withColumn("_amount", line_cents())
    sums = lines.groupBy(_ORDER).agg(F.sum("_amount").alias("_sum"), F.max(line).alias("_last"))
    shared = join_by_key(lines, sums, [_ORDER], small=True).withColumns(
        {
            "_share": share_cents(F.col("_amount"), F.col("_sum"), paid_cents()),
            "_is_last": line.eqNullSafe(F.col("_last")),
        }
    )
    columns = [c for c in wide.columns if c != _SHARE]
    ends = shared.groupBy(_ORDER).agg(
        F.sum("_share").alias("_share_sum"),
        F.count_if("_is_last").alias("_copies"),
        F.max(F.when(F.col("_is_last"), line)).alias("_line"),
        F.max(F.when(F.col("_is_last"), F.col("_share"))).alias("_last_share"),
    )
    last = spread_copies(ends.select("_line.*", "_share_sum", "_copies", F.col("_last_share").alias("_share")), "_copies")
    place = wide.columns if _SHARE in wide.columns else [*wide.columns, _SHARE]
    plain = shared.filter(~F.col("_is_last")).select(*columns, from_cents(F.col("_share")).alias(_SHARE))
    rest = _with_share(last, is_last=F.col("_copy") == 1, share_sum=F.col("_share_sum"))
    return plain.select(*place).unionByName(rest.select(*place))


def allocate(
    wide: DataFrame, hot: DataFrame | None = None, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Wide records with ``final_detail_amount`` filled.

    ``hot`` names the orders with very many lines; pass
    ``hot_keys(lines, ["order_id"])`` of the base table to spare counting over
    the joined rows.
    """
    hot = hot_keys(wide, [_ORDER], hot_rows) if hot is None else hot
    few, many = split_hot(wide, hot, [_ORDER])
    return allocate_in_windows(few).unionByName(allocate_by_sums(many))


def paid_lines(
    orders: DataFrame, lines: DataFrame, hot_rows: int = HOT_ROWS, hot: DataFrame | None = None
) -> DataFrame:
    """Join and allocation in one plan: wide records with their share of the paid amount.

    The lines are split before the join. Ordinary orders are joined and
    allocated on one shuffle by order id; hot orders are few by construction
    and are broadcast to their lines, which are never dealt by order. A given ``hot``
    is looked up at once: without hot orders the plan has no branch for them.
    """
    if hot is not None and hot.isEmpty():
        return allocate_in_windows(join_lines(orders, lines))
    hot = hot_keys(lines, [_ORDER], hot_rows) if hot is None else hot
    few, many = split_hot(lines, hot, [_ORDER])
    hot_orders = orders.join(
        F.broadcast(hot.withColumnRenamed(_ORDER, "id")), "id", "left_semi"
    )
    return allocate_in_windows(join_lines(orders, few)).unionByName(
        allocate_by_sums(join_lines(F.broadcast(hot_orders), many))
    )


# --- running sums -----------------------------------------------------------------

def _sums_before(
    rows: DataFrame, keys: list[str], order: tuple[str, ...], names: tuple[str, ...], prefix: str
) -> DataFrame:
    before = (
        W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow - 1)
    )
    return rows.withColumns(
        {f"{prefix}{n}": F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)) for n in names}
    )


def _sums_before_by_ranges(rows: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """The same for orders with very many lines: a scan in two passes.

    Equal lines become one with their number. They are dealt by range over order
    and all columns, so lines with the same or no id spread as well; the ranges
    are written, as both passes must see the same ones. Sums of whole ranges give
    where a range begins, running sums inside it do the rest, and the copies of a
    line come back one after the other.
    """
    others = [c for c in rows.columns if c not in (_ORDER, *_BY_LINE)]
    by_line = (*_BY_LINE, *others)
    combined = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_copies"))
    ranges = written(
        combined.repartitionByRange(*[F.asc_nulls_first(c) for c in (_ORDER, *by_line)])
        .withColumn("_range", F.spark_partition_id()),
        "line-ranges",
    )
    # Sums are of all copies of a line; its own columns stay as they are.
    whole = ranges.withColumns({f"_all_{n}": F.col(f"_{n}") * F.col("_copies") for n in names})
    range_sums = whole.groupBy(_ORDER, "_range").agg(*[F.sum(f"_all_{n}").alias(f"_{n}") for n in names])
    earlier = _sums_before(range_sums, [_ORDER], ("_range",), names, "_base_").drop(
        *[f"_{n}" for n in names]
    )
    inside = _sums_before(
        whole, [_ORDER, "_range"], by_line, tuple(f"all_{n}" for n in names), "_in_"
    )
    met = spread_copies(join_by_key(inside, earlier, [_ORDER, "_range"]), "_copies")
    return met.select(
        *rows.columns,
        *[
            (F.col(f"_base_{n}") + F.col(f"_in_all_{n}") + (F.col("_copy") - 1) * F.coalesce(f"_{n}", F.lit(0)))
            .alias(f"_before_{n}")
            for n in names
        ],
    )


def sums_before(rows: DataFrame, names: tuple[str, ...], hot: DataFrame) -> DataFrame:
    """Adds ``_before_x`` for every x in ``names``: the sum of ``_x`` over the order's
    lines before this one, by line id.

    ``_x`` must not be NULL. ``hot`` is looked up at once: without hot orders the
    plan has one window and no other branch.
    """
    if hot.isEmpty():
        return _sums_before(rows, [_ORDER], _BY_LINE, names, "_before_")
    hot = written(hot, "hot-orders")
    few, many = split_hot(rows, hot, [_ORDER])
    ordinary = _sums_before(few, [_ORDER], _BY_LINE, names, "_before_")
    return ordinary.unionByName(_sums_before_by_ranges(many, names).select(*ordinary.columns))


def running_sums(
    paid: DataFrame, hot: DataFrame | None = None, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Adds ``origin_before`` and ``split_before`` to allocated lines.

    These are the order's line amounts and shares over the lines before this
    one, by line id: the two sums an allocation that meets the lines one by one
    would carry.
    """
    hot = hot_keys(paid, [_ORDER], hot_rows) if hot is None else hot
    amounts = paid.withColumns(
        {"_origin": line_cents(), "_split": to_cents(F.col(_SHARE))}
    )
    names = ("origin", "split")
    return sums_before(amounts, names, hot).select(
        *paid.columns, *[from_cents(F.col(f"_before_{n}")).alias(f"{n}_before") for n in names]
    )
