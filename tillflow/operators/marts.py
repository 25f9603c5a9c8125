"""Reports: paid amount per brand, day and hour, top brands, dashboard results.

All sums are exact: cents are summed as integers and leave as doubles.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow import fixed_values as fv
from tillflow.functions.dates import hour_number, previous_day
from tillflow.functions.money import sum_amount, sum_cents, to_cents

_PAID = "final_detail_amount"


def on_day(rows: DataFrame, day: str) -> DataFrame:
    """Rows of one day; prunes partitions when the table is partitioned by ``dt``."""
    return rows.filter(F.col("dt") == day)


def between(rows: DataFrame, column: str, start: str, end: str) -> DataFrame:
    """Rows strictly inside a time range: rows at either end are left out."""
    at = F.col(column)
    return rows.filter((at > F.lit(start).cast("timestamp")) & (at < F.lit(end).cast("timestamp")))


def trademark_amount(wide: DataFrame) -> DataFrame:
    """Paid amount per trademark.

    Grouped by id and name as two columns, so a name may hold any character.
    """
    return wide.groupBy("tm_id", "tm_name").agg(sum_amount(F.col(_PAID)).alias("amount"))


def amount_by_sku(wide: DataFrame, *more: str) -> DataFrame:
    """Exact paid amount (decimal) per SKU and further columns.

    Few rows for any number of lines, so brands are joined to these sums.
    """
    cents = sum_cents(to_cents(F.col(_PAID)))
    return wide.groupBy(*more, "sku_id").agg(
        (cents * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(38,2)").alias("amount")
    )


def trademark_stat(wide: DataFrame, stat_time: Column) -> DataFrame:
    """Report rows of one batch, stamped with a time handed in so that runs repeat."""
    cents = sum_cents(to_cents(F.col(_PAID)))
    return wide.groupBy("tm_id", "tm_name").agg(cents.alias("cents")).select(
        stat_time.alias("stat_time"),
        F.col("tm_id").cast("string").alias("trademark_id"),
        F.col("tm_name").alias("trademark_name"),
        (F.col("cents") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(38,2)").alias("amount"),
    )


def top_trademarks(stat: DataFrame, start: str, end: str, top: int) -> DataFrame:
    """The brands with the highest amount inside a time range; ties by id and name."""
    return (
        between(stat, "stat_time", start, end)
        .groupBy("trademark_id", "trademark_name")
        .agg(F.sum("amount").cast("double").alias("order_amount"))
        .orderBy(F.desc("order_amount"), "trademark_id", "trademark_name")
        .limit(top)
    )


def order_amount(wide: DataFrame, day: str) -> DataFrame:
    """Paid amount of a day as one row; NULL on a day without orders."""
    return on_day(wide, day).agg(sum_amount(F.col(_PAID)).alias("order_amount"))


def order_amount_by_day(wide: DataFrame) -> DataFrame:
    return wide.groupBy("dt").agg(sum_amount(F.col(_PAID)).alias("order_amount"))


def order_amount_by_hour(wide: DataFrame) -> DataFrame:
    """Paid amount per day and hour; ``hr`` is a number, not zero padded."""
    return wide.groupBy("dt", hour_number(F.col("create_time")).alias("hr")).agg(
        sum_amount(F.col(_PAID)).alias("order_amount")
    )


def hour_map(by_hour: DataFrame, value: str) -> DataFrame:
    """Per day a map from hour text to value. A day has at most 24 hours to collect.

    Values without an hour (an unreadable time) are in no map.
    """
    entry = F.struct(F.col("hr").cast("string"), F.col(value))
    return by_hour.filter(F.col("hr").isNotNull()).groupBy("dt").agg(
        F.map_from_entries(F.collect_list(entry)).alias("by_hour")
    )


def hour_compare(by_hour: DataFrame, day: str, value: str) -> DataFrame:
    """A day beside the day before, per hour; NULL where one of them has nothing."""
    before = previous_day(day)
    amount = F.col(value).cast("double")
    return (
        by_hour.filter(F.col("dt").isin(day, before))
        .groupBy(F.col("hr").cast("string").alias("hr"))
        .agg(
            F.max(F.when(F.col("dt") == day, amount)).alias("today"),
            F.max(F.when(F.col("dt") == before, amount)).alias("yesterday"),
        )
    )


def realtime_hour(metric: str, day: str, dau: DataFrame, amount: DataFrame) -> DataFrame:
    """The hourly comparison named by a dashboard metric id.

    ``dau`` and ``amount`` are the per-hour tables. An unknown id raises.
    """
    if metric == fv.TOTAL_DAU[0]:
        return hour_compare(dau, day, "dau")
    if metric == fv.TOTAL_ORDER_AMOUNT[0]:
        return hour_compare(amount, day, "order_amount")
    raise ValueError(f"unknown metric: {metric}")


def realtime_total(
    day: str, dau: DataFrame, new_devices: DataFrame, amount: DataFrame
) -> DataFrame:
    """The three totals of a day as rows (id, name, value).

    Inputs are the per-day tables. Counts of a day without data are 0, its
    amount is NULL. New devices are counted, not a fixed figure.
    """

    def row(table: DataFrame, column: str, label: tuple[str, str], empty) -> DataFrame:
        value = F.coalesce(F.max(column).cast("double"), F.lit(empty).cast("double"))
        return on_day(table, day).agg(value.alias("value")).select(
            F.lit(label[0]).alias("id"), F.lit(label[1]).alias("name"), "value"
        )

    return (
        row(dau, "dau", fv.TOTAL_DAU, 0)
        .unionByName(row(new_devices, "new_devices", fv.TOTAL_NEW_DEVICES, 0))
        .unionByName(row(amount, "order_amount", fv.TOTAL_ORDER_AMOUNT, None))
    )


def amount_by_window(
    rows: DataFrame, ts: str, amount: str, keys: list[str], window: str, slide: str | None = None
) -> DataFrame:
    """Amount per key and tumbling or sliding window of event time.

    Takes a batch, or a stream that carries a watermark on ``ts``.
    """
    bounds = F.window(F.col(ts), window, slide) if slide else F.window(F.col(ts), window)
    return (
        rows.groupBy(bounds.alias("window"), *keys)
        .agg(sum_amount(F.col(amount)).alias("amount"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            *keys,
            "amount",
        )
    )
