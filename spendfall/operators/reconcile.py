"""Proof that ledger = allocated + residual, in total and line by line.

``ends`` is the table of end points (see ``cascade.ends_of``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendfall.schemas import ALLOCATED, MONEY, RESIDUAL


class ReconciliationError(ValueError):
    """Allocated plus residual does not equal the ledger."""


def _per_version(frame: DataFrame, versions: Sequence[str]) -> DataFrame:
    return frame.withColumn("rule_version", F.explode(F.array(*[F.lit(v) for v in versions])))


def reconciliation(gl: DataFrame, ends: DataFrame, versions: Sequence[str]) -> DataFrame:
    """One row per version; a version without any end points is reported too.

    Ledger and end points are summed in one grouping: the ledger is first reduced to
    one row, so only sums are repeated per version.
    """
    ledger = _per_version(gl.agg(F.sum("amount_eur").alias("amount")), versions).withColumn("side", F.lit("ledger"))
    outcomes = ends.where(F.col("rule_version").isin(*versions)).select(
        F.col("amount_eur").alias("amount"), "rule_version", F.col("outcome").alias("side")
    )
    zero = F.lit(0).cast(MONEY)
    sums = {
        "total_gl_eur": "ledger",
        "total_allocated_eur": ALLOCATED,
        "total_residual_eur": RESIDUAL,
    }
    money = "decimal(38,2)"
    totals = (
        ledger.select(F.col("amount").cast(money).alias("amount"), "rule_version", "side")
        .unionByName(
            outcomes.groupBy("rule_version", "side").agg(F.sum("amount").cast(money).alias("amount"))
        )
        .groupBy("rule_version")
        .agg(
            *[
                F.coalesce(F.sum(F.when(F.col("side") == side, F.col("amount"))), zero).cast(MONEY).alias(name)
                for name, side in sums.items()
            ]
        )
    )
    difference = F.col("total_gl_eur") - F.col("total_allocated_eur") - F.col("total_residual_eur")
    return totals.withColumn("difference_eur", difference.cast(MONEY)).select(
        "rule_version", *sums, (F.col("difference_eur") == 0).alias("balanced"), "difference_eur"
    )


def line_reconciliation(gl: DataFrame, ends: DataFrame, versions: Sequence[str]) -> DataFrame:
    """Per ledger line and version: input, sum of end points, and whether they agree.

    Ledger and end points are summed in one grouping by line, with a sum for each version;
    rows of a line collapse before they are shuffled, and the ledger is not repeated per
    version. A line that is not in the ledger is reported for the versions that have it.
    """
    sums = [f"actual_{k}" for k in range(len(versions))]
    nothing = F.lit(None).cast(MONEY)
    expected = gl.select("gl_line_id", F.col("amount_eur").alias("expected"), *(nothing.alias(name) for name in sums))
    own = [F.when(F.col("rule_version") == v, F.col("amount_eur")).alias(name) for v, name in zip(versions, sums, strict=True)]
    actual = ends.where(F.col("rule_version").isin(*versions)).select("gl_line_id", nothing.alias("expected"), *own)
    lines = expected.unionByName(actual).groupBy("gl_line_id").agg(F.sum("expected").cast(MONEY).alias("expected_eur"), *(F.sum(name).cast(MONEY).alias(name) for name in sums))
    per_version = [
        F.when(
            F.col("expected_eur").isNotNull() | F.col(name).isNotNull(),
            F.struct(F.lit(v).alias("rule_version"), F.coalesce(F.col(name), F.lit(0).cast(MONEY)).alias("actual_eur")),
        )
        for v, name in zip(versions, sums, strict=True)
    ]
    rows = lines.select("gl_line_id", "expected_eur", F.inline(F.array_compact(F.array(*per_version))))
    return rows.select(
        "rule_version",
        "gl_line_id",
        "expected_eur",
        "actual_eur",
        F.coalesce(F.col("expected_eur") == F.col("actual_eur"), F.lit(False)).alias("balanced"),
    )


def require_balanced(totals: DataFrame) -> list:
    """Run the totals (one row per version) and raise on the first that is off."""
    rows = totals.collect()
    for row in rows:
        if not row.balanced:
            raise ReconciliationError(
                f"{row.rule_version} is out of balance by {row.difference_eur}: ledger {row.total_gl_eur}, "
                f"allocated {row.total_allocated_eur}, residual {row.total_residual_eur}"
            )
    return rows


def require_lines_balanced(lines: DataFrame) -> None:
    """Raise with one ledger line that is lost, doubled or changed, if there is any."""
    for row in lines.where(~F.col("balanced")).limit(1).collect():
        raise ReconciliationError(
            f"Ledger line {row.gl_line_id} is out of balance under {row.rule_version}: "
            f"{row.expected_eur} went in, {row.actual_eur} came out"
        )
