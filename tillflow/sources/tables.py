"""Dimension and report tables: reads, upserts, repeatable batch writes, JDBC."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow import fixed_values as fv
from tillflow.operators.keyed import latest_by_key
from tillflow.sources.state import BATCH, RUN



def read_jdbc(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """The result of a query run by a database.

    Give ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions``
    with ``dbtable`` for tables too large for one connection.
    """
    source = {} if "dbtable" in options else {"query": query}
    return spark.read.format("jdbc").options(url=url, **source, **options).load()


def append_jdbc(
    rows: DataFrame,
    url: str,
    table: str,
    batch_rows: int = fv.JDBC_BATCH_ROWS,
    partitions: int | None = None,
    **properties: str,
) -> None:
    """Appends rows over JDBC in batches, without a transaction.

    ``partitions`` bounds the connections by merging tasks, for a database that
    takes no more; without it every task has its own.
    """
    connections = {"numPartitions": str(partitions)} if partitions else {}
    rows.write.format("jdbc").mode("append").options(
        url=url,
        dbtable=table,
        batchsize=str(batch_rows),
        isolationLevel="NONE",
        **connections,
        **properties,
    ).save()


def replace_batch(
    rows: DataFrame, batch_id: int, path: str, by: list[str] | None = None, run: str | None = None
) -> None:
    """Writes a batch as its own partition, replacing all that an earlier try left.

    This makes a ``foreachBatch`` sink idempotent: progress is in the query's
    checkpoint, and a batch that is run again overwrites its own rows, also
    where the new try has fewer partitions or none. With ``run``, which stands
    for the checkpoint, a new checkpoint that counts from 0 again replaces nothing.
    """
    folder = f"{path.rstrip('/')}/{RUN}={run}" if run else path.rstrip("/")
    writer = rows.drop(BATCH, RUN).write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*by) if by else writer).parquet(f"{folder}/{BATCH}={batch_id}")


def append_rows(rows: DataFrame, path: str, by: list[str] | None = None) -> None:
    """Appends rows as they are, without a key."""
    rows.write.mode("append").partitionBy(*(by or [])).parquet(path)


def latest_rows(
    spark: SparkSession, path: str, keys: list[str], version: list[str] | None = None
) -> DataFrame:
    """A changelog written by ``replace_batch`` as a table: the newest row per key.

    The newest is the one with the highest ``version`` columns, whatever batch
    brought it; the batch decides between equal or missing versions.
    """
    log = spark.read.parquet(path)
    return latest_by_key(log, keys, [*(version or []), BATCH]).drop(BATCH, RUN)


def compact(
    spark: SparkSession, path: str, new_path: str, keys: list[str], version: list[str] | None = None
) -> None:
    """Writes the newest rows of a changelog to a new folder, as batch -1.

    Later batches appended there win over it.
    """
    replace_batch(latest_rows(spark, path, keys, version), -1, new_path)
