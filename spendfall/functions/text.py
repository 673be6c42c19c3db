"""Text cleaning shared by the contracts and the conformance step."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(value: Column) -> Column:
    """Remove white space of every kind from both ends."""
    return F.regexp_replace(value, r"(?U)^\s+|\s+$", "")


def blank_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))
