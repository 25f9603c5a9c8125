"""Tables written on the way, in the folder that all executors share."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it.

    Only where none is named, and only on a single machine, a local one is made.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        return named
    master = spark.conf.get("spark.master", "hidden")
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    return tempfile.mkdtemp(prefix="tillflow-")


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own for one run, below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/tillflow/{name}-{uuid.uuid4().hex}"


def written(rows: DataFrame, name: str) -> DataFrame:
    """``rows``, written once and read back: what follows sees one and the same result, also after a lost executor."""
    path = new_folder(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
