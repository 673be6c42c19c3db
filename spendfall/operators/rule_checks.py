"""Governance of rule versions: checks over the rule tables, and the difference of two versions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendfall.schemas import (
    CONSUMPTION,
    GL_TO_TOWER,
    MANUAL_OVERRIDE,
    STEPS,
    STRATEGIES,
    WEIGHTED,
)
from spendfall.sources.rule_files import BASIS, PROPORTION_TOLERANCE, RuleViolation

__all__ = ["RuleViolation", "require_governed", "rule_coverage", "rule_diff", "rule_violations"]

# Broken checks that an error names; the total is always told.
NAMED = 20


def _found(frame: DataFrame, code: str) -> DataFrame:
    return frame.select("version_id", "step", F.lit(code).alias("violation"))


def rule_violations(rules: DataFrame, params: DataFrame, usage_metrics: DataFrame) -> DataFrame:
    """Broken checks as (version_id, step, violation).

    ``usage_metrics`` has ``step`` and ``metric_name`` of the signals that really exist;
    a consumption rule must name one of its own step.
    """
    no_step = F.lit(None).cast("string")
    steps = rules.groupBy("version_id", "step").agg(F.count(F.lit(1)).alias("rows"))
    complete = rules.groupBy("version_id").agg(
        F.count_distinct(F.when(F.col("step").isin(*STEPS), F.col("step"))).alias("known")
    )
    heads = rules.select("version_id", "description", "created").distinct().withColumn("step", no_step)
    split = F.col("step") != GL_TO_TOWER
    strategy = F.col("strategy")
    with_params = rules.where(strategy.isin(WEIGHTED, MANUAL_OVERRIDE)).select("version_id", "step", "strategy")
    values = with_params.join(params, ["version_id", "step"], "left").groupBy("version_id", "step", "strategy").agg(
        F.count("value").alias("value_count"),
        F.min("value").alias("smallest"),
        F.sum("value").alias("total"),
    )
    off_by = F.abs(F.col("total") - F.lit(1)) > F.lit(str(PROPORTION_TOLERANCE)).cast("decimal(7,6)")
    known_metrics = usage_metrics.select("step", "metric_name").distinct()
    parts = [
        _found(complete.where(F.col("known") != len(STEPS)).withColumn("step", no_step), "steps_incomplete"),
        _found(rules.where(~F.col("step").isin(*STEPS)), "step_unknown"),
        _found(steps.where(F.col("rows") > 1), "version_duplicated"),
        _found(
            rules.where((split & strategy.isNull()) | (strategy.isNotNull() & ~strategy.isin(*STRATEGIES))),
            "strategy_unknown",
        ),
        _found(heads.where(F.coalesce(F.trim("version_id"), F.lit("")) == ""), "version_id_blank"),
        _found(heads.where(F.coalesce(F.trim("description"), F.lit("")) == ""), "description_blank"),
        _found(
            heads.where(~F.coalesce(F.col("created").rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.lit(False))),
            "created_not_a_date",
        ),
        _found(rules.where(~split & ~F.col("basis").eqNullSafe(F.lit(BASIS))), "basis_unknown"),
        _found(rules.where(~split & (strategy == CONSUMPTION)), "fallback_cannot_be_consumption"),
        _found(rules.where((strategy != CONSUMPTION) & F.col("metric_name").isNotNull()), "metric_not_allowed"),
        _found(values.where(F.col("value_count") == 0), "values_empty"),
        _found(values.where(F.col("smallest") < 0), "values_negative"),
        _found(values.where((F.col("strategy") == MANUAL_OVERRIDE) & off_by), "proportions_do_not_sum_to_one"),
        _found(
            rules.where(split & (strategy == CONSUMPTION)).join(known_metrics, ["step", "metric_name"], "left_anti"),
            "metric_unknown_for_step",
        ),
    ]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def require_governed(found: DataFrame) -> None:
    """Raise if any check is broken. The rule tables hold a few rows per version."""
    total = found.count()
    if total:
        rows = found.orderBy("version_id", "step", "violation").limit(NAMED).collect()
        lines = [f"- {row.version_id} {row.step or ''}: {row.violation}" for row in rows]
        lines += [f"and {total - NAMED} more"] * (total > NAMED)
        raise RuleViolation("Rule versions break governance checks:\n" + "\n".join(lines))


def rule_coverage(rules: DataFrame, index: DataFrame) -> DataFrame:
    """Rule table with what each rule's metric really offers: sources, targets, signal."""
    offered = index.groupBy("step", "metric_name").agg(
        F.count_distinct("from_id").alias("source_count"),
        F.count_distinct("to_id").alias("target_count"),
        F.sum("signal").cast("decimal(26,2)").alias("signal_total"),
    )
    return rules.join(offered, ["step", "metric_name"], "left").select(
        "version_id",
        "step",
        "basis",
        "strategy",
        "metric_name",
        F.coalesce("source_count", F.lit(0)).alias("source_count"),
        F.coalesce("target_count", F.lit(0)).alias("target_count"),
        F.coalesce("signal_total", F.lit(0)).cast("decimal(26,2)").alias("signal_total"),
    )


def rule_diff(rules: DataFrame, params: DataFrame, first: str, second: str) -> DataFrame:
    """Steps at which two versions differ, in strategy, metric, basis or declared values."""
    values = params.groupBy("version_id", "step").agg(
        F.array_sort(F.collect_list(F.struct("target_id", "value"))).alias("declared")
    )
    body = F.struct("basis", "strategy", "metric_name", "declared")
    full = rules.join(values, ["version_id", "step"], "left").select("version_id", "step", body.alias("body"))
    one = full.where(F.col("version_id") == first).select("step", F.col("body").alias("one"))
    two = full.where(F.col("version_id") == second).select("step", F.col("body").alias("two"))
    return (
        one.join(two, "step", "full")
        .where(~F.col("one").eqNullSafe(F.col("two")))
        .select("step", F.to_json("one").alias(first), F.to_json("two").alias(second))
    )
