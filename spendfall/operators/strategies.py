"""The four split strategies, worked out for all rule versions, steps and sources at once.

Every strategy reduces to integer raw weights per (rule_version, step, from_id, to_id).
``split_outcomes`` turns them into shares that add up to exactly one, or into the
reason why the source cannot be split. Sources of up to ``WINDOW_TARGETS`` targets, after
usage rows have been summed, are worked out by windows over a source; for larger ones the
same result comes from histograms of remainders and ranks by ranges, over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from spendfall.functions.money import UNITS_PER_ONE, from_units
from spendfall.operators.ranking import ranked
from spendfall.schemas import (
    CONSUMPTION,
    DRIVER_ZERO,
    EVEN_SPREAD,
    GL_TO_TOWER,
    MANUAL_OVERRIDE,
    WEIGHTED,
)
from spendfall.session import materialize
from spendfall.sources.rule_files import RuleSet

NODE = ["rule_version", "step", "from_id"]
# Source id standing for every unmapped ledger line in the fallback of the first step.
ANY_LINE = "*"
#: Targets of a source that one window sorts, and slots of the histogram of a larger one's remainders.
WINDOW_TARGETS = 100_000
SLOTS = 4096


def _raw_signal() -> "F.Column":
    return (F.coalesce(F.col("signal"), F.lit(0)) * 100).cast("decimal(26,0)")


def usage_candidates(index: DataFrame, rules: RuleSet) -> DataFrame:
    """Raw weights at the two usage-driven steps, for every version in ``rules``.

    Targets come from all metrics of a source, not only from the metric of the rule.
    A source with no usage rows yields no candidates under any strategy.
    """
    spark = index.sparkSession
    steps = F.broadcast(
        rules.rules(spark)
        .where(F.col("step") != GL_TO_TOWER)
        .select(F.col("version_id").alias("rule_version"), "step", "strategy", F.col("metric_name").alias("wanted"))
    )
    ruled = index.join(steps, "step")
    signal = F.when(
        (F.col("strategy") == CONSUMPTION) & (F.col("metric_name") == F.col("wanted")), _raw_signal()
    ).otherwise(F.lit(0).cast("decimal(26,0)"))
    targets = ruled.groupBy(*NODE, "strategy", "to_id").agg(F.sum(signal).alias("measured"))
    from_usage = targets.where(F.col("strategy") != MANUAL_OVERRIDE).select(
        *NODE,
        "strategy",
        "to_id",
        F.when(F.col("strategy") == EVEN_SPREAD, F.lit(1)).otherwise(F.col("measured")).cast("decimal(26,0)").alias("raw"),
    )
    if not rules.has_params:
        return from_usage
    params = F.broadcast(
        rules.params(spark).select(
            F.col("version_id").alias("rule_version"), "step", F.col("target_id").alias("to_id"), "raw"
        )
    )
    from_params = (
        targets.where(F.col("strategy").isin(WEIGHTED, MANUAL_OVERRIDE))
        .select(*NODE, "strategy")
        .distinct()
        .join(params, ["rule_version", "step"])
        .select(*NODE, "strategy", "to_id", "raw")
    )
    return (
        from_usage.unionByName(from_params)
        .groupBy(*NODE, "strategy", "to_id")
        .agg(F.sum("raw").cast("decimal(26,0)").alias("raw"))
    )


def fallback_candidates(towers: DataFrame, rules: RuleSet) -> DataFrame:
    """Raw weights for unmapped ledger lines in versions that opt into a fallback.

    Weights of unknown towers are ignored; declared proportions are used as they are.
    """
    spark = towers.sparkSession
    steps = F.broadcast(
        rules.rules(spark)
        .where((F.col("step") == GL_TO_TOWER) & F.col("strategy").isNotNull())
        .select(F.col("version_id").alias("rule_version"), "step", "strategy", F.lit(ANY_LINE).alias("from_id"))
    )
    params = F.broadcast(
        rules.params(spark)
        .where(F.col("step") == GL_TO_TOWER)
        .select(F.col("version_id").alias("rule_version"), F.col("target_id").alias("to_id"), F.col("raw").alias("param"))
    )
    tower_ids = towers.select(F.col("tower_id").alias("to_id"), F.lit(GL_TO_TOWER).alias("step")).distinct()
    spread = (
        tower_ids.join(steps.where(F.col("strategy") != MANUAL_OVERRIDE), "step")
        .join(params, ["rule_version", "to_id"], "left")
        .select(
            *NODE,
            "strategy",
            "to_id",
            F.when(F.col("strategy") == EVEN_SPREAD, F.lit(1))
            .otherwise(F.coalesce(F.col("param"), F.lit(0)))
            .cast("decimal(26,0)")
            .alias("raw"),
        )
    )
    declared = steps.where(F.col("strategy") == MANUAL_OVERRIDE).join(params, "rule_version").select(
        *NODE, "strategy", "to_id", F.col("param").alias("raw")
    )
    return spread.unionByName(declared)


def normalize_shares(candidates: DataFrame) -> DataFrame:
    """Share units of every target, adding up to exactly 10^12 per source.

    Each share is rounded down; the units left over go to the largest remainders, ties
    to the larger raw weight, then to the smaller id. Declared proportions are kept as
    they are. A source whose weights add up to zero gets NULL units.
    """
    node = W.partitionBy(*NODE)
    by_remainder = node.orderBy(F.desc("remainder"), F.desc("raw"), F.asc("to_id"))
    scaled = F.col("raw") * F.lit(UNITS_PER_ONE).cast("decimal(13,0)")
    declared = F.col("strategy") == MANUAL_OVERRIDE
    shared = ~declared & (F.col("total") > 0)
    split = (
        candidates.withColumn("total", F.sum("raw").over(node).cast("decimal(26,0)"))
        .withColumn(
            "floor_units",
            F.when(declared, F.col("raw").cast("bigint")).when(shared, F.call_function("div", scaled, F.col("total"))),
        )
        .withColumn("remainder", F.when(shared, (scaled % F.col("total")).cast("decimal(26,0)")))
        .withColumn("place", F.row_number().over(by_remainder))
        .withColumn("spare", F.when(declared, F.lit(0)).otherwise(F.lit(UNITS_PER_ONE) - F.sum("floor_units").over(node)))
    )
    units = F.col("floor_units") + F.when(F.col("place") <= F.col("spare"), 1).otherwise(0)
    return split.select(*NODE, "strategy", "to_id", "raw", units.cast("bigint").alias("units"))


def normalize_large_shares(candidates: DataFrame) -> DataFrame:
    """The result of :func:`normalize_shares` for sources of any number of targets.

    The remainders of a source are counted in slots. The units left over go to whole slots
    from the top, as far as they reach; only the targets of the slot in which they run out
    are ranked, by ranges, as thousands of them may have the same remainder.
    ``candidates`` are read several times and should be stored.
    """
    scaled = F.col("raw") * F.lit(UNITS_PER_ONE).cast("decimal(13,0)")
    declared = F.col("strategy") == MANUAL_OVERRIDE
    totals = candidates.groupBy(*NODE).agg(F.sum("raw").cast("decimal(26,0)").alias("total"))
    shared = ~declared & (F.col("total") > 0)
    slot = F.call_function("div", F.col("remainder") * F.lit(SLOTS).cast("decimal(5,0)"), F.col("total"))
    parts = (
        candidates.join(totals, NODE)
        .withColumn("floor_units", F.when(declared, F.col("raw").cast("bigint")).when(shared, F.call_function("div", scaled, F.col("total"))))
        .withColumn("remainder", F.when(shared, (scaled % F.col("total")).cast("decimal(26,0)")))
        .withColumn("slot", F.when(shared, slot))
    )
    slots = parts.where("slot IS NOT NULL").groupBy(*NODE, "slot").agg(F.count(F.lit(1)).alias("targets"), F.sum("floor_units").alias("units"))
    node = W.partitionBy(*NODE)
    above = F.coalesce(F.sum("targets").over(node.orderBy(F.desc("slot")).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    cuts = (
        slots.withColumn("above", above)
        .withColumn("spare", F.lit(UNITS_PER_ONE) - F.sum("units").over(node))
        .where("above < spare AND spare <= above + targets")
        .select(*NODE, F.col("slot").alias("cut"), (F.col("spare") - F.col("above")).alias("needed"))
    )
    marked = parts.join(cuts, NODE, "left")
    columns = [*NODE, "strategy", "to_id", "raw"]
    clear = marked.where("slot IS NULL OR cut IS NULL OR slot <> cut").select(
        *columns, (F.col("floor_units") + F.when(F.col("slot") > F.col("cut"), 1).otherwise(0)).cast("bigint").alias("units")
    )
    tied = marked.where("slot = cut").select(*columns, "floor_units", "remainder", "needed")
    placed = ranked(tied, NODE, [F.desc("remainder"), F.desc("raw"), F.asc("to_id")])
    return clear.unionByName(placed.select(*columns, (F.col("floor_units") + F.when(F.col("rank") < F.col("needed"), 1).otherwise(0)).cast("bigint").alias("units")))


def _placed_by_ranges(shares: DataFrame) -> DataFrame:
    """``shares`` with the place of every target in its source, and what the source lacks to one."""
    missing = shares.groupBy(*NODE).agg((F.lit(UNITS_PER_ONE) - F.sum("units")).alias("missing"))
    placed = ranked(shares, NODE, [F.desc("units"), F.asc("to_id")]).withColumn("place", F.col("rank").cast("int")).drop("rank")
    return placed.join(missing, NODE)


def split_large_outcomes(candidates: DataFrame, window_targets: int = WINDOW_TARGETS) -> DataFrame:
    """:func:`split_outcomes` for stored candidates: sources of more targets than a window should sort go by ranges."""
    sizes = candidates.groupBy(*NODE).agg(F.count(F.lit(1)).alias("targets"))
    large = sizes.where(F.col("targets") > window_targets).select(*NODE)
    if large.isEmpty():
        return split_outcomes(candidates)
    large = materialize(large)
    shares = materialize(normalize_large_shares(candidates.join(large, NODE, "left_semi")))
    return split_outcomes(candidates.join(large, NODE, "left_anti")).unionByName(_outcomes(_placed_by_ranges(shares)))


def split_outcomes(candidates: DataFrame) -> DataFrame:
    """One row per source and target, or one row with a reason and no target.

    ``place`` numbers the targets of a source by share, largest first, then by id: the
    order in which equal cent remainders are served. ``missing`` is what the shares of a
    source lack to one (not zero only for declared proportions). Targets with no share
    are kept only for declared proportions, where they may still be handed a cent.
    """
    node = W.partitionBy(*NODE)
    return _outcomes(
        normalize_shares(candidates)
        .withColumn("place", F.row_number().over(node.orderBy(F.desc("units"), F.asc("to_id"))) - 1)
        .withColumn("missing", F.lit(UNITS_PER_ONE) - F.sum("units").over(node))
    )


def _outcomes(placed: DataFrame) -> DataFrame:
    dead = F.col("units").isNull()
    return placed.where(
        F.when(dead, F.col("place") == 0).otherwise((F.col("units") > 0) | (F.col("strategy") == MANUAL_OVERRIDE))
    ).select(
        *NODE,
        F.when(~dead, F.col("to_id")).alias("to_id"),
        "units",
        from_units(F.col("units")).alias("share"),
        F.when(~dead, F.col("place")).alias("place"),
        "missing",
        F.when(dead, F.lit(DRIVER_ZERO)).alias("reason_code"),
    )


def strategy_shares(candidates: DataFrame, strategy: str) -> DataFrame:
    """Outcome of one strategy as shown to users: every target with its share, or the reason."""
    shares = normalize_shares(candidates.where(F.col("strategy") == strategy))
    return shares.select(
        *NODE,
        "to_id",
        from_units(F.col("units")).alias("share"),
        F.when(F.col("units").isNull(), F.lit(DRIVER_ZERO)).alias("reason_code"),
    )
