"""Running numbers within groups of any size, without a window over a group.

Rows are dealt out by ranges of their order, sorted in each range, numbered there, and the
ranges' counts are added up. A group that holds most rows is spread over many ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendfall.llm.store import stored


def numbered(frame: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    """``frame`` with ``idx``, counted from 0 in each group by ``order``, and ``total``, the group's rows.

    Group columns must not be null. Rows that are equal in group and order are numbered in
    any order. The numbers are written down once, so they never differ between two uses.
    """
    ranged = frame.repartitionByRange(*(F.col(name) for name in group), *order).sortWithinPartitions(*(F.col(name) for name in group), *order)
    # the place in the sorted ranges: the range above, the row within it below
    placed = stored(ranged.withColumn("place", F.monotonically_increasing_id()), "numbered").withColumn("range", F.shiftright("place", 33))
    counts = placed.groupBy("range", *group).agg(F.min("place").alias("first"), F.count("*").alias("n"))
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("range", *group, "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"), F.sum("n").over(whole).alias("total"))
    return placed.join(starts, ["range", *group]).withColumn("idx", F.col("place") - F.col("first") + F.col("before")).select(*frame.columns, "idx", "total")
