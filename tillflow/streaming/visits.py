"""First visits of a day on a stream."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow import fixed_values as fv
from tillflow.functions.dates import moment
from tillflow.operators.visits import add_day_hour, flatten_visit
from tillflow.streaming.run import END_OF_INPUT

_SALT = "_salt"
_AT = "_at"


def first_visits_stream(
    logs: DataFrame, delay: str = fv.VISIT_TTL, salts: int = 1
) -> DataFrame:
    """The first visit to arrive, per device and day.

    All rows of one (day, device) lie within 24 hours, so with a delay of at
    least that no key is dropped from the state before its last row.

    With ``salts`` above 1 a first removal on (day, device, salt) lets many
    tasks thin out a hot device before the second one meets it.
    """
    rows = add_day_hour(logs).withColumn(_AT, moment(F.col("ts"))).withWatermark(_AT, delay)
    rows = rows.withColumn("_mid", F.col("common.mid"))
    if salts > 1:
        salted = rows.withColumn(_SALT, F.pmod(F.xxhash64("ts"), F.lit(salts)))
        rows = salted.dropDuplicatesWithinWatermark(["dt", "_mid", _SALT])
    return flatten_visit(rows.dropDuplicatesWithinWatermark(["dt", "_mid"]))


_DAY_END = "_day_end"


def first_visits_by_time(logs: DataFrame, delay: str = "0 seconds") -> DataFrame:
    """The earliest visit per device and day, all columns, whatever order the logs arrive in.

    A day's visits come out once the watermark says the day is over: when a log
    of a later day has arrived and ``delay`` has passed since that day began.
    Equal times go by the other columns, as in ``visits.first_visits``. The state
    is one row per device of the open days, and every task sends one row per
    device, so a hot device needs no salt.
    """
    rows = flatten_visit(add_day_hour(logs))
    day_end = F.date_trunc("day", moment(F.col("ts"))) + F.expr("INTERVAL 1 DAY")
    # The event time is the end of the day: groups by it are whole days of the session's time zone.
    open_days = rows.withColumn(_DAY_END, day_end).withWatermark(_DAY_END, "24 hours" if delay == "0 seconds" else f"24 hours {delay}")
    visit = F.struct(*[F.col(c) for c in rows.columns])
    earliest = open_days.filter(F.col(_DAY_END) < END_OF_INPUT).groupBy(_DAY_END, "dt", "mid").agg(
        F.min_by(visit, F.struct("ts", "uid", "ar", "ch", "vc")).alias("visit")
    )
    return earliest.select("visit.*")
