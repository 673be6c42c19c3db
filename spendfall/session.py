"""Session settings and the durable scratch space used to cut lineage."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

#: Setting by which Spark deletes the shuffle files of a query that has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app_name: str = "spendfall", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs are tuned for; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may fall
    back to a temporary folder of this machine.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if current is None:
        if configured is None:
            if not context.master.startswith("local"):
                raise RuntimeError("Set spark.checkpoint.dir to a folder every executor can reach.")
            configured = tempfile.mkdtemp(prefix="spendfall-")
        context.setCheckpointDir(configured)
        current = context.getCheckpointDir()
    return configured or current


def materialize(frame: DataFrame) -> DataFrame:
    """Write ``frame`` once to the shared scratch folder and read it from there afterwards.

    Its shuffle files go as soon as it is written, not when the driver happens to collect its garbage.
    """
    spark = frame.sparkSession
    path = f"{scratch_dir(spark)}/table-{uuid4().hex}"
    kept = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        frame.write.parquet(path, compression="zstd")
    finally:
        spark.conf.unset(CLEANUP) if kept is None else spark.conf.set(CLEANUP, kept)
    _made.append(path)
    return spark.read.schema(frame.schema).parquet(path)


#: Folders that this process has made in the scratch folder.
_made: list[str] = []


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete folders, through the file system they are on."""
    jvm = spark._jvm
    for path in paths:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def discard_materialized(spark: SparkSession) -> None:
    """Delete all that ``materialize`` has written; what was read from it must be finished."""
    discard(spark, *_made)
    _made.clear()
