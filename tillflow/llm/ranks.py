"""Places of rows in the order of their group, without gathering a group in one task."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillflow.llm.common import staged


def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` plus ``place`` (from 0, by ``order``, null first) and ``total``, the number of rows, in each group.

    Equal rows take neighbouring places in the order in which they were written.
    A null group is a group. Rows are dealt by range over group, order and their
    number, so a hot group, or one row that comes very often, spreads over tasks;
    the counts of each range give where its rows begin.
    """
    numbered = staged(rows.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    by = [F.asc_nulls_first(c) for c in (*order, "__row")]
    dealt = numbered.repartitionByRange(F.asc_nulls_first(group), *by).withColumn("__part", F.spark_partition_id())
    dealt = staged(dealt, "dealt-by-range")
    counts = dealt.groupBy(F.col(group).alias("__group"), F.col("__part").alias("__at")).agg(F.count(F.lit(1)).alias("__n"))
    earlier = W.partitionBy("__group").orderBy("__at").rowsBetween(W.unboundedPreceding, -1)
    begins = counts.select(
        "__group", "__at", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__begin"),
        F.sum("__n").over(W.partitionBy("__group")).alias("total"),
    )
    met = dealt.withColumn("__own", F.row_number().over(W.partitionBy(group, "__part").orderBy(*by))).join(
        staged(begins, "range-begins"), F.col(group).eqNullSafe(F.col("__group")) & (F.col("__part") == F.col("__at"))
    )
    return met.select(*rows.columns, "total", (F.col("__begin") + F.col("__own") - 1).alias("place"))
