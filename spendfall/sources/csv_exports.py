"""CSV exports of the six source tables: header check, all-text scan, typed result."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendfall.operators.contracts import typed
from spendfall.schemas import CONTRACTS, raw_schema

MALFORMED = "_malformed"


class HeaderError(ValueError):
    """A CSV export does not have exactly the columns of its contract, in order."""


def export_path(source_dir: str, table: str, overrides: Mapping[str, str] | None = None) -> str:
    return (overrides or {}).get(table) or f"{source_dir}/{table}.csv"


def check_header(spark: SparkSession, path: str, table: str) -> list[str]:
    """Compare the header of every file at ``path`` with the contract before any row is read."""
    expected = list(CONTRACTS[table])
    try:
        first_lines = spark.read.option("header", False).option("escape", '"').csv(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"No export of {table} at {path}") from error
        raise
    if not first_lines.columns:
        raise HeaderError(f"{path} has no header: the file is empty.")
    header = spark.read.option("header", True).option("escape", '"').csv(path).columns
    if header != expected:
        raise HeaderError(f"{path} has the header {header} instead of {expected}.")
    return header


def scan_raw(spark: SparkSession, path: str, table: str, *, multi_line: bool = False) -> DataFrame:
    """All columns as text, empty cells as NULL, plus the file name and the text of bad records.

    ``enforceSchema`` off makes every single file of a folder prove its header as well.
    """
    schema = raw_schema(table).add(MALFORMED, "string")
    raw = (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", MALFORMED)
        .schema(schema)
        .csv(path)
    )
    return raw.select(
        *[F.nullif(F.col(name), F.lit("")).alias(name) for name in CONTRACTS[table]],
        F.col("_metadata.file_name").alias("_source_file"),
        MALFORMED,
    )


def scan_csv(spark: SparkSession, path: str, table: str, *, multi_line: bool = False) -> DataFrame:
    """Header-checked typed scan; rows that break the contract come out with NULL fields."""
    check_header(spark, path, table)
    return typed(scan_raw(spark, path, table, multi_line=multi_line), table)
