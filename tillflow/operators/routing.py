"""Routing of app logs and database change messages to topics.

All three routers are one projection each. The topic is a column, so one query
serves every table, and the same function takes a batch or a stream of messages
with a ``value`` text column.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow import fixed_values as fv


def split_app_log(
    messages: DataFrame, start_topic: str = "APP_START", event_topic: str = "APP_EVENT"
) -> DataFrame:
    """A log with a non-empty ``start`` member is a start log, any other an event log."""
    start = F.get_json_object(F.col("value"), "$.start")
    topic = F.when(F.length(start) > 0, F.lit(start_topic)).otherwise(F.lit(event_topic))
    return messages.select(topic.alias("topic"), "value")


def ods_topic(table: Column) -> Column:
    return F.concat(F.lit(fv.ODS_PREFIX), F.upper(table))


def _places(messages: DataFrame) -> list[Column]:
    """Time and position of the incoming messages; missing ones are NULL."""
    return [
        F.col(name) if name in messages.columns else F.lit(None).cast("bigint").alias(name)
        for name in ("at", "position")
    ]


def route_canal(messages: DataFrame) -> DataFrame:
    """One message per element of ``data[]``; the change type is not looked at.

    A message without ``data`` gives no row. ``at`` is the time of the change.
    As in ``route_maxwell``, ``inline`` makes columns of the parsed message, so
    that what follows does not parse it again.
    """
    change = F.from_json(F.col("value"), "`table` string, data array<string>, es bigint")
    return messages.select(*_places(messages), F.inline(F.array(change))).select(
        ods_topic(F.col("table")).alias("topic"),
        F.explode("data").alias("value"),
        F.coalesce("es", "at").alias("at"),
        "position",
    )


def maxwell_passes(table: Column, kind: Column, data: Column) -> Column:
    """Which change messages are routed; ``data`` is the row image as JSON text.

    The row image must be an object with something in it and the change must not
    be a delete. Orders pass on insert only, so an order that is updated later is
    not counted twice; a bootstrap load of orders does not pass either. The other
    tables pass with every change, bootstrap included, since that is how they are
    first loaded.
    """
    table_passes = table.isin(*fv.ROUTED_TABLES) | (
        (table == fv.INSERT_ONLY_TABLE) & kind.eqNullSafe(F.lit(fv.INSERT))
    )
    has_data = data.startswith("{") & (data != "{}")
    return has_data & ~kind.eqNullSafe(F.lit(fv.DELETE)) & table_passes


def route_maxwell(messages: DataFrame) -> DataFrame:
    """The passing change messages, one row image each, ``at`` the time of its change.

    ``inline`` over a filtered one-element array parses each message once; a
    filter on the parsed columns would be pushed down and parse it again.
    """
    change = F.from_json(F.col("value"), "`table` string, type string, data string, ts bigint")
    passing = F.filter(
        F.array(change), lambda c: maxwell_passes(c["table"], c["type"], c["data"])
    )
    return messages.select(*_places(messages), F.inline(passing)).select(
        ods_topic(F.col("table")).alias("topic"),
        F.col("data").alias("value"),
        F.coalesce(F.col("ts") * 1000, "at").alias("at"),
        "position",
    )
