"""The dashboard's queries over the marts the jobs keep."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.functions.dates import previous_day
from tillflow.operators import marts, visits
from tillflow.streaming.jobs import Warehouse


def _visits(spark: SparkSession, house: Warehouse) -> DataFrame:
    # The partition column would be read as a date otherwise.
    return spark.read.parquet(house.table("dau_info")).withColumn("dt", F.col("dt").cast("string"))


def _wide(spark: SparkSession, house: Warehouse) -> DataFrame:
    return spark.read.parquet(house.table("order_wide")).withColumn("dt", F.col("dt").cast("string"))


def realtime_total(spark: SparkSession, house: Warehouse, day: str) -> DataFrame:
    """Active devices, new devices and paid amount of a day."""
    seen = _visits(spark, house)
    return marts.realtime_total(
        day,
        visits.dau_total(seen),
        visits.new_devices(seen.filter(F.col("dt") <= day)),
        marts.order_amount_by_day(_wide(spark, house)),
    )


def realtime_hour(spark: SparkSession, house: Warehouse, metric: str, day: str) -> DataFrame:
    """A metric of a day beside the day before, per hour. An unknown metric raises."""
    days = [day, previous_day(day)]
    dau = _visits(spark, house).filter(F.col("dt").isin(days))
    paid = _wide(spark, house).filter(F.col("dt").isin(days))
    return marts.realtime_hour(
        metric, day, visits.dau_by_hour(dau), marts.order_amount_by_hour(paid)
    )


def top_trademarks(
    spark: SparkSession, house: Warehouse, start: str, end: str, top: int
) -> DataFrame:
    """The brands with the highest amount between two report times."""
    stat = spark.read.parquet(house.table("trademark_amount_stat"))
    return marts.top_trademarks(stat, start, end, top)
