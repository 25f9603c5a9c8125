"""Daily visits of devices: first visit, active devices, new devices.

Logs are rows with ``common`` (mid, uid, ar, ch, vc) and ``ts`` in epoch
milliseconds, the shape of ``schemas.APP_LOG``.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow import fixed_values as fv
from tillflow.functions.dates import day_text, hour_text, moment
from tillflow.operators.keyed import first_by_key


def add_day_hour(logs: DataFrame) -> DataFrame:
    """Adds ``dt`` and ``hr`` from the epoch milliseconds in ``ts``."""
    at = moment(F.col("ts"))
    return logs.withColumns({"dt": day_text(at), "hr": hour_text(at)})


def flatten_visit(logs: DataFrame) -> DataFrame:
    """Nested log with ``dt`` and ``hr`` to the flat visit record; minute is fixed."""
    return logs.select(
        "common.mid", "common.uid", "common.ar", "common.ch", "common.vc",
        "dt", "hr", F.lit(fv.VISIT_MINUTE).alias("mi"), "ts",
    )


def first_visits(logs: DataFrame, tie: list[str] | None = None) -> DataFrame:
    """The first visit of each device on each day.

    Batch knows all records, so "first" is by ``ts`` and then ``tie`` (all the
    flat columns by default). Each visit lands on the day it happened on.
    """
    visits = flatten_visit(add_day_hour(logs))
    return first_by_key(visits, ["dt", "mid"], ["ts", *(tie or ["uid", "ar", "ch", "vc"])])


def visit_starts(logs: DataFrame) -> DataFrame:
    """Only day, device and time of the first visit.

    All that counting needs. The buffer is a single number, so Spark hashes
    instead of sorting.
    """
    day = day_text(moment(F.col("ts")))
    return logs.groupBy(day.alias("dt"), F.col("common.mid").alias("mid")).agg(
        F.min("ts").alias("ts")
    )


def dau_total(starts: DataFrame) -> DataFrame:
    """Active devices per day, from rows unique by (dt, mid)."""
    return starts.groupBy("dt").agg(F.count(F.lit(1)).alias("dau"))


def dau_by_hour(starts: DataFrame) -> DataFrame:
    """Active devices per day and hour of the first visit; ``hr`` is zero padded."""
    hour = hour_text(moment(F.col("ts")))
    return starts.groupBy("dt", hour.alias("hr")).agg(F.count(F.lit(1)).alias("dau"))


def busiest_hours(by_hour: DataFrame, size: int = fv.HOURS_PER_DAY) -> DataFrame:
    """Hour buckets of one day, largest first, at most ``size`` of them."""
    return by_hour.orderBy(F.desc("dau"), "hr").limit(size)


def new_devices(rows: DataFrame) -> DataFrame:
    """Devices per day of their first visit ever, from any rows with ``mid`` and ``ts``."""
    first = rows.groupBy("mid").agg(F.min("ts").alias("ts"))
    return first.groupBy(day_text(moment(F.col("ts"))).alias("dt")).agg(
        F.count(F.lit(1)).alias("new_devices")
    )
