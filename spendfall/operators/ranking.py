"""Ranks within groups of any size, without a window over a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spendfall.session import materialize


def ranked(frame: DataFrame, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """``frame`` with ``rank``, from 0 in every group by ``order``, which must be unique in a group.

    Rows are dealt out by ranges of group and order and numbered where they lie; only the
    ranges' counts, one row for each range and group, are added up. The numbers are
    written once, so a task that is run again cannot change them. Groups are not null.
    """
    keys = [F.col(name) for name in group]
    placed = materialize(frame.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order).withColumn("at", F.monotonically_increasing_id()))
    # the range stands in the upper bits of the number, the place in it in the lower ones
    placed = placed.withColumn("range", F.shiftright("at", 33))
    counts = placed.groupBy("range", *group).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    earlier = W.partitionBy(*group).orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("range", *group, "first", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"))
    return placed.join(starts, ["range", *group]).select(*frame.columns, (F.col("at") - F.col("first") + F.col("before")).alias("rank"))
