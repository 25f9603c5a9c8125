"""Dates and times as the zero-padded texts the tables are keyed by."""

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = "yyyy-MM-dd"
HOUR = "HH"
SECOND = "yyyy-MM-dd HH:mm:ss"


def moment(epoch_ms: Column) -> Column:
    """Epoch milliseconds to a timestamp."""
    return F.timestamp_millis(epoch_ms)


def day_text(ts: Column) -> Column:
    return F.date_format(ts, DAY)


def hour_text(ts: Column) -> Column:
    return F.date_format(ts, HOUR)


def second_text(ts: Column) -> Column:
    return F.date_format(ts, SECOND)


def date_part_of(text: Column) -> Column:
    """``yyyy-MM-dd`` of a ``yyyy-MM-dd HH:mm:ss`` text."""
    return F.split_part(text, F.lit(" "), F.lit(1))


def hour_part_of(text: Column) -> Column:
    """``HH`` of a ``yyyy-MM-dd HH:mm:ss`` text."""
    return F.split_part(F.split_part(text, F.lit(" "), F.lit(2)), F.lit(":"), F.lit(1))


def hour_number(text: Column) -> Column:
    """Hour of day as a number, not zero padded; NULL when the text has none."""
    hour = hour_part_of(text).try_cast("int")
    return F.when(hour.between(0, 23), hour)


def previous_day(day: str) -> str:
    """The day before. Text that is no date raises ``ValueError``."""
    return (date.fromisoformat(day) - timedelta(days=1)).isoformat()
