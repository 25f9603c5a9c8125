"""Dimension tables: user labels and SKU names."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.functions.people import age_group, age_in_years, gender_name


def label_users(users: DataFrame, as_of: Column) -> DataFrame:
    """Adds ``age_group`` and ``gender_name`` to users with ``birthday`` and ``gender``."""
    return users.withColumns(
        {
            "age_group": age_group(age_in_years(F.col("birthday"), as_of)),
            "gender_name": gender_name(F.col("gender")),
        }
    )


def name_skus(
    skus: DataFrame, categories: DataFrame, trademarks: DataFrame, spus: DataFrame
) -> DataFrame:
    """Adds category, trademark and SPU names to SKUs; a miss leaves NULL.

    Each name follows its own id: ``tm_name`` by ``tm_id`` and ``spu_name`` by
    ``spu_id``. (The design this replaces looked the two up crosswise.)
    The joins carry no broadcast hint: Spark broadcasts a side it has measured
    to be small, and splits skewed partitions of a sort-merge join otherwise.
    """
    category = categories.select(
        F.col("id").alias("category3_id"), F.col("name").alias("category3_name")
    )
    trademark = trademarks.select(F.col("id").alias("tm_id"), "tm_name")
    spu = spus.select(F.col("id").alias("spu_id"), "spu_name")
    return (
        skus.join(category, "category3_id", "left")
        .join(trademark, "tm_id", "left")
        .join(spu, "spu_id", "left")
    )


def rows_for_batch(dim: DataFrame, dim_key: str, batch: DataFrame, batch_key: str) -> DataFrame:
    """The dimension rows a batch refers to.

    The batch's keys are made distinct first, so a hot key crosses the network
    once per task.
    """
    wanted = batch.select(F.col(batch_key).alias(dim_key)).distinct()
    return dim.join(wanted, dim_key, "left_semi")
