"""Orders: dates, first-order flag, province and user lookups; lines: SKU lookup."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow import fixed_values as fv
from tillflow.functions.dates import date_part_of, hour_part_of


def add_order_dates(orders: DataFrame) -> DataFrame:
    """Adds ``create_date`` and ``create_hour`` from the text ``create_time``."""
    return orders.withColumns(
        {
            "create_date": date_part_of(F.col("create_time")),
            "create_hour": hour_part_of(F.col("create_time")),
        }
    )


def first_orders(orders: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """(user_id, id) of each user's earliest order, for users not yet in ``state``.

    Ties in ``create_time`` go to the lower id.
    """
    earliest = (
        orders.groupBy("user_id")
        .agg(F.min(F.struct("create_time", "id")).alias("first"))
        .select("user_id", F.col("first.id").alias("id"))
    )
    if state is None:
        return earliest
    consumed = state.filter(F.col("if_consumed") == fv.FIRST_ORDER)
    return earliest.join(
        consumed.select(F.col("user_id").try_cast("bigint").alias("user_id")),
        "user_id",
        "left_anti",
    )


def flag_first_orders(orders: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """Adds ``if_first_order``: "1" for a user's first order, "0" for all others.

    ``state`` holds users who have ordered before; none of their orders is a
    first one. One user may hold a large part of all orders, so orders are never
    grouped by user: the earliest order per user is found by a combined
    aggregation, and the flag goes back by order id, which is unique (apply
    ``distinct_by_id`` to feeds that may repeat an order). The order id is also
    the key of the join with the lines.
    """
    flags = first_orders(orders, state).select(
        F.col("id"), F.lit(fv.FIRST_ORDER).alias("if_first_order")
    )
    return orders.join(flags, "id", "left").withColumn(
        "if_first_order", F.coalesce("if_first_order", F.lit(fv.LATER_ORDER))
    )


def new_customers(flagged: DataFrame) -> DataFrame:
    """State rows for the users whose first order is among ``flagged``."""
    return flagged.filter(F.col("if_first_order") == fv.FIRST_ORDER).select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("if_first_order").alias("if_consumed"),
    )


def add_province(orders: DataFrame, provinces: DataFrame) -> DataFrame:
    """Adds the province columns by ``province_id``; a miss keeps the order."""
    lookup = provinces.select(
        F.col("id").try_cast("bigint").alias("province_id"),
        F.col("name").alias("province_name"),
        F.col("area_code").alias("province_area_code"),
        F.col("iso_code").alias("province_iso_code"),
        F.col("iso_3166_2").alias("province_iso_3166_2"),
    )
    return orders.join(lookup, "province_id", "left")


def add_user(orders: DataFrame, users: DataFrame) -> DataFrame:
    """Adds age group and gender by ``user_id``; a miss keeps the order."""
    lookup = users.select(
        F.col("id").try_cast("bigint").alias("user_id"),
        F.col("age_group").alias("user_age_group"),
        F.col("gender_name").alias("user_gender"),
    )
    return orders.join(lookup, "user_id", "left")


def add_sku(details: DataFrame, skus: DataFrame) -> DataFrame:
    """Adds SPU, trademark and category ids and names by ``sku_id``.

    A line of an unknown SKU is kept with NULLs; it does not fail the job.
    """
    lookup = skus.select(
        F.col("id").try_cast("bigint").alias("sku_id"),
        F.col("spu_id").try_cast("bigint").alias("spu_id"),
        F.col("tm_id").try_cast("bigint").alias("tm_id"),
        F.col("category3_id").try_cast("bigint").alias("category3_id"),
        "spu_name",
        "tm_name",
        "category3_name",
    )
    return details.join(lookup, "sku_id", "left")
