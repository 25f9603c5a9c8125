"""Starting streaming queries: checkpoints, state store, triggers."""

from collections.abc import Callable
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tillflow import fixed_values as fv
from tillflow.scratch import new_folder
from tillflow.sources.topic_log import FORMAT, TopicLogSource

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# State is packed closely, its rows aren't counted (that would read a key before each
# write), and only the versions a restart may need are kept. Shuffle files go when the
# micro-batch that wrote them ends, not when the driver happens to collect its garbage.
_STATE = {
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.join.stateFormatVersion": "3",
    "spark.sql.streaming.minBatchesToRetain": "2",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

# The event time of a closing record: the last message of a feed that ends. Windows, days
# and buffers come out when it has passed. Operators leave it out after the watermark.
END_OF_INPUT = datetime(9000, 1, 1, tzinfo=timezone.utc)


@contextmanager
def _query_settings(spark: SparkSession, trailing: bool = True):
    """Settings a query takes over when it starts; the session's own come back after.

    State lives in RocksDB, on disk and outside the heap. The session's number of
    shuffle partitions is fixed in the checkpoint when a query first starts. Without
    ``trailing`` no batch without data follows when the watermark has moved: state is
    then dropped with the next data. For queries that let nothing out by the watermark.
    """
    wanted = {"spark.sql.streaming.stateStore.providerClass": _ROCKSDB, **_STATE}
    wanted["spark.sql.streaming.noDataMicroBatches.enabled"] = str(trailing).lower()
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _trigger(every: str | None) -> dict:
    return {"processingTime": every} if every else {"availableNow": True}


def start_append(
    rows: DataFrame, path: str, checkpoint: str, every: str | None = None, by: list[str] | None = None,
    trailing: bool = True,
) -> StreamingQuery:
    """Streams finished rows to parquet files, exactly once.

    Without ``every`` the query handles all data there is and ends.
    """
    with _query_settings(rows.sparkSession, trailing):
        writer = (
            rows.writeStream.format("parquet")
            .outputMode("append")
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .trigger(**_trigger(every))
        )
        return (writer.partitionBy(*by) if by else writer).start()


def start_batches(
    rows: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = None,
    trailing: bool = True,
) -> StreamingQuery:
    """Hands every micro-batch to ``handle(rows, batch_id)``."""
    with _query_settings(rows.sparkSession, trailing):
        return (
            rows.writeStream.foreachBatch(handle)
            .outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(**_trigger(every))
            .start()
        )


def start_topics(
    messages: DataFrame, root: str, run: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Streams (topic, key, value, at) messages to a topic log, each batch committed once."""
    messages.sparkSession.dataSource.register(TopicLogSource)
    with _query_settings(messages.sparkSession):
        return (
            messages.select("topic", "key", "value", "at").writeStream.format(FORMAT)
            .outputMode("append")
            .option("path", root)
            .option("run", run)
            .option("checkpointLocation", checkpoint)
            .trigger(**_trigger(every))
            .start()
        )


def start_preview(rows: DataFrame, every: str = fv.LONG_BATCH) -> StreamingQuery:
    """Prints the first rows of every batch."""
    with _query_settings(rows.sparkSession):
        return (
            rows.writeStream.format("console")
            .option("numRows", fv.PREVIEW_ROWS)
            .option("truncate", False)
            .trigger(processingTime=every)
            .start()
        )


def run_to_table(rows: DataFrame, name: str, trailing: bool = True) -> DataFrame:
    """Runs a stream over all data there is and returns what it wrote, as a table."""
    spark = rows.sparkSession
    folder = new_folder(spark, name)
    query = start_append(rows, f"{folder}/rows", f"{folder}/checkpoint", trailing=trailing)
    query.awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{folder}/rows")
