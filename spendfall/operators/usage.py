"""Driver signals: usage rows summed per step, source, metric and target."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usage_index(usage: DataFrame) -> DataFrame:
    """Signal per (step, from_id, metric_name, to_id), over all periods; a null value counts as 0."""
    return usage.groupBy("step", "from_id", "metric_name", "to_id").agg(
        F.sum(F.coalesce(F.col("value"), F.lit(0).cast("decimal(18,2)"))).cast("decimal(26,2)").alias("signal")
    )


def metrics_by_step(index: DataFrame) -> DataFrame:
    """Which metrics each step can be driven by, and how many sources report them."""
    return index.groupBy("step", "metric_name").agg(
        F.count_distinct("from_id").alias("source_count"),
        F.sum("signal").cast("decimal(26,2)").alias("signal_total"),
    )
