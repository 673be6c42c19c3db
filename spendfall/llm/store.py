"""Intermediate tables in the shared folder, so that a lost executor costs no more than its own tasks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from spendfall.session import scratch_dir


#: Rows that are handed to Python at once; texts can be long and executors small.
BATCH_ROWS = 500


def small_batches(spark: SparkSession) -> None:
    """Let Spark hand rows to Python in small batches, unless the session already says so."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write ``frame`` as Parquet to the shared scratch folder and return it read from there."""
    spark = frame.sparkSession
    path = f"{scratch_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def dropped(*frames: DataFrame | None) -> None:
    """Delete tables that ``stored`` made and nothing reads any more."""
    for frame in frames:
        if frame is not None:
            _delete(frame.sparkSession, {path.rsplit("/", 1)[0] for path in frame.inputFiles()})


def _delete(spark: SparkSession, folders: set[str]) -> None:
    jvm = spark._jvm
    for folder in folders:
        if "/llm-" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
