"""One row per key: first, latest, and plain distinct by id."""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pick(rows: DataFrame, keys: list[str], order: list[Column], chooser) -> DataFrame:
    # min_by/max_by keep one row per key and task before the shuffle, so a key
    # with a third of all rows costs one row per task. A window would send every
    # row of that key to a single task.
    chosen = chooser(F.struct(*[F.col(c) for c in rows.columns]), F.struct(*order))
    grouped = rows.groupBy(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)])
    return grouped.agg(chosen.alias("row")).select("row.*")


def first_by_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key that comes first by ``order``."""
    return _pick(rows, keys, [F.col(c) for c in order], F.min_by)


def latest_by_key(rows: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """The row of each key with the highest ``version``: last write wins."""
    return _pick(rows, keys, [F.col(c) for c in version], F.max_by)


def distinct_by_id(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per id, for messages that were sent more than once.

    Which copy is kept does not depend on the partitioning: the least by all
    columns. Rows that lack an id are nobody's copies: all of them stay.
    """
    others = [c for c in rows.columns if c not in keys]
    named = reduce(and_, [F.col(k).isNotNull() for k in keys])
    return first_by_key(rows.filter(named), keys, others or keys).unionByName(rows.filter(~named))
