"""Stored tables: scan, overwrite by rule version, and the list of what a stage needs."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendfall.schemas import PARTITIONED_BY_VERSION, SORT_KEYS

# The schema a table was written with, beside its files; Spark passes over names like this.
SCHEMA_FILE = "_table_schema.json"
# In place of files: the name of the table whose rows these are.
SAME_AS_FILE = "_same_as.txt"


class MissingTable(FileNotFoundError):
    """A table that a stage needs has not been written yet."""


def _files(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path for it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _note(spark: SparkSession, path: str) -> str | None:
    """Text of a small file, if there is one."""
    files, where = _files(spark, path)
    if not files.exists(where):
        return None
    stream = files.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _keep_note(spark: SparkSession, path: str, text: str) -> None:
    files, where = _files(spark, path)
    stream = files.create(where, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def link_table(spark: SparkSession, folder: str, table: str, same_as: str) -> str:
    """Let ``table`` be the rows of another table of the folder, without a copy of them."""
    path = f"{folder}/{table}"
    _keep_note(spark, f"{path}/{SAME_AS_FILE}", same_as)
    return path


def read_table(spark: SparkSession, folder: str, table: str, fmt: str = "parquet") -> DataFrame:
    """Lazy scan of one stored table, with the types it was written with.

    So version ids stay text even where they look like numbers, and a table without rows
    is a table.
    """
    path = f"{folder}/{table}"
    if (same_as := _note(spark, f"{path}/{SAME_AS_FILE}")) is not None:
        return read_table(spark, folder, same_as, fmt)
    stored = _note(spark, f"{path}/{SCHEMA_FILE}")
    try:
        if stored is not None:
            schema = T.StructType.fromJson(json.loads(stored))
            return spark.read.format(fmt).schema(schema).load(path).select(*schema.names)
        frame = spark.read.format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise MissingTable(f"Table {table} has not been written: {path}") from error
        raise
    if "rule_version" in frame.columns:
        frame = frame.withColumn("rule_version", F.col("rule_version").cast("string"))
    return frame


def read_tables(spark: SparkSession, folder: str, tables: Iterable[str], fmt: str = "parquet") -> dict[str, DataFrame]:
    return {table: read_table(spark, folder, table, fmt) for table in tables}


def _version_files(spark: SparkSession, path: str) -> dict[str, set[str]]:
    """Names of the files in each version's folder."""
    files, where = _files(spark, path)
    if not files.exists(where):
        return {}
    folders = [x.getPath() for x in files.listStatus(where) if x.isDirectory() and x.getPath().getName().startswith("rule_version=")]
    return {folder.getName(): {x.getPath().getName() for x in files.listStatus(folder)} for folder in folders}


def write_table(
    frame: DataFrame, folder: str, table: str, fmt: str = "parquet", versions: Sequence[str] | None = None
) -> str:
    """Overwrite a table, rows sorted inside each file.

    Tables with a rule version are split into one folder per version. Only the versions
    present in ``frame`` are replaced; of those in ``versions`` that have no rows any
    more, the old rows go too.
    """
    spark = frame.sparkSession
    path = f"{folder}/{table}"
    keys = [key for key in SORT_KEYS[table] if key != "rule_version"]
    if table in PARTITIONED_BY_VERSION:
        before = _version_files(spark, path)
        (
            frame.sortWithinPartitions("rule_version", *keys)
            .write.format(fmt)
            .mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("rule_version")
            .save(path)
        )
        after = _version_files(spark, path)
        for version in versions or ():
            name = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString("rule_version", version)
            # a folder that was written has files of this job only
            if name in before and after.get(name) == before[name]:
                files, where = _files(spark, f"{path}/{name}")
                files.delete(where, True)
    else:
        frame.sortWithinPartitions(*keys).write.format(fmt).mode("overwrite").save(path)
    _keep_note(spark, f"{path}/{SCHEMA_FILE}", frame.schema.json())
    return path


def publish(frames: Mapping[str, DataFrame], folder: str) -> dict[str, str]:
    """Replace several tables of ``folder`` together: all are written beside it before the first is touched.

    A write that fails leaves every table as it was. Then folders are renamed, table by
    table; if that fails halfway, those already replaced are put back. Should even that
    fail, what there was lies in the folder ``_earlier-...`` beside them.
    """
    spark = next(iter(frames.values())).sparkSession
    staged, earlier = f"{folder}/_staged-{uuid4().hex}", f"{folder}/_earlier-{uuid4().hex}"
    files, _ = _files(spark, folder)
    at = spark._jvm.org.apache.hadoop.fs.Path
    moved = []

    def move(source: str, target: str) -> None:
        files.mkdirs(at(target).getParent())
        if not files.rename(at(source), at(target)):
            raise OSError(f"{source} cannot be renamed to {target}.")
        moved.append((source, target))

    try:
        for table, frame in frames.items():
            write_table(frame, staged, table)
        for table in frames:
            if files.exists(at(f"{folder}/{table}")):
                move(f"{folder}/{table}", f"{earlier}/{table}")
            move(f"{staged}/{table}", f"{folder}/{table}")
    except BaseException:
        back = [files.rename(at(target), at(source)) for source, target in reversed(moved)]
        if all(back):
            files.delete(at(earlier), True)
            files.delete(at(staged), True)
        raise
    files.delete(at(earlier), True)
    files.delete(at(staged), True)
    return {table: f"{folder}/{table}" for table in frames}
