"""Lineage: one row per end point with its path, and the questions asked of it."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendfall.operators.lookup import lookup_join
from spendfall.schemas import ALLOCATED, LINEAGE_COLUMNS, MANUAL_OVERRIDE, MONEY, RESIDUAL, STEPS
from spendfall.sources.rule_files import PROPORTION_DIGITS, RuleSet

# What rounding may move at one hop.
CENT = "0.01"
HOP_SHARES = dict(zip(STEPS, ("prop_gl_to_tower", "prop_tower_to_app", "prop_app_to_bu")))

# Fixed text of the worked example.
ROUNDING_NOTE = (
    "Terminal cents derive from staged rounding with deterministic remainder "
    "distribution. Proportions explain the split shape; allocated amounts are authoritative."
)


class LineageError(ValueError):
    """Lineage drops, doubles or distorts money."""


def _names(dim_cost_center: DataFrame) -> DataFrame:
    return dim_cost_center.select("cost_center_id", F.col("name").alias("cost_center_name"))


def with_names(gl: DataFrame, dim_cost_center: DataFrame) -> DataFrame:
    """The ledger with the names of its cost centres: it is much shorter than its end points."""
    return lookup_join(gl, _names(dim_cost_center), ["cost_center_id"], spread_by=["gl_line_id"])


def lineage(ends: DataFrame, gl: DataFrame, dim_cost_center: DataFrame, *, sliced: bool = False) -> DataFrame:
    """Allocated and residual end points with ledger context, in one join.

    End points that come straight from the cascade already carry their ledger amount, and
    the names if the cascade has run on a ledger with names; then nothing is joined or
    shuffled. Stored ones are joined to the ledger on its unique id. End points of a ledger
    that has been ``sliced`` by it (``cascade.spread_lines``) are neither shuffled nor sorted:
    the lines of a slice, few beside their end points, are hashed.
    """
    context = ["period", "gl_account", "cost_center_id"]
    if "cost_center_name" in ends.columns:
        named = ends
    elif "gl_amount_eur" in ends.columns:
        named = lookup_join(ends, _names(dim_cost_center), ["cost_center_id"], spread_by=["gl_line_id", "app_id", "bu_id"])
    else:
        ledger = gl if "cost_center_name" in gl.columns else with_names(gl, dim_cost_center)
        ledger = ledger.select("gl_line_id", *context, F.col("amount_eur").alias("gl_amount_eur"), "cost_center_name")
        named = ends.drop(*context).join(ledger.hint("shuffle_hash") if sliced else ledger, "gl_line_id")
    is_allocated = F.col("outcome") == ALLOCATED
    shares = {
        "prop_gl_to_tower": "gl_to_tower_proportion",
        "prop_tower_to_app": "tower_to_app_proportion",
        "prop_app_to_bu": "app_to_bu_proportion",
    }
    return named.select(
        "*",
        *[F.when(is_allocated, F.col(source)).alias(name) for name, source in shares.items()],
        F.when(is_allocated, F.col("amount_eur")).alias("allocated_amount_eur"),
        F.when(~is_allocated, F.col("amount_eur")).alias("residual_amount_eur"),
        F.col("amount_eur").alias("terminal_amount_eur"),
    ).select(*LINEAGE_COLUMNS)


def trace_forward(edges: DataFrame, rule_version: str, lines: DataFrame | str) -> DataFrame:
    """All end points of one ledger line, or of every line listed in ``lines``."""
    of_version = edges.where(F.col("rule_version") == rule_version)
    if isinstance(lines, str):
        return of_version.where(F.col("gl_line_id") == lines)
    return of_version.join(lines.select("gl_line_id"), "gl_line_id", "left_semi").select(*edges.columns)


def trace_backward(
    edges: DataFrame, rule_version: str, *, bu_id: str | None = None, app_id: str | None = None
) -> DataFrame:
    """The allocated rows behind a business unit, an application, or both."""
    if bu_id is None and app_id is None:
        raise ValueError("Give a bu_id, an app_id, or both.")
    rows = edges.where((F.col("rule_version") == rule_version) & (F.col("outcome") == ALLOCATED))
    if bu_id is not None:
        rows = rows.where(F.col("bu_id") == bu_id)
    if app_id is not None:
        rows = rows.where(F.col("app_id") == app_id)
    return rows


def raw_product() -> Column:
    """Ledger amount times the three shares; shares are multiplied first to keep their digits."""
    narrow = "decimal(13,12)"
    shares = F.col("prop_gl_to_tower").cast(narrow) * F.col("prop_tower_to_app").cast(narrow)
    return (F.col("gl_amount_eur") * (shares * F.col("prop_app_to_bu").cast(narrow))).cast("decimal(38,16)")


def _lacking(rules: RuleSet | None, step: str) -> Column | None:
    """What the declared proportions of a row's version lack to one at a step; None if no version declares any."""
    if not rules or all((of_step, strategy) != (step, MANUAL_OVERRIDE) for _, *_, of_step, _, strategy, _ in rules.rule_rows):
        return None
    lacking = F.lit(0).cast("decimal(13,12)")
    for version, *_, of_step, _, strategy, _ in rules.rule_rows:
        if of_step == step and strategy == MANUAL_OVERRIDE:
            units = sum(int(row[4]) for row in rules.param_rows if row[:2] == (version, step))
            share = Decimal(10**PROPORTION_DIGITS - units).scaleb(-PROPORTION_DIGITS)
            lacking = F.when(F.col("rule_version") == version, F.lit(str(share)).cast("decimal(13,12)")).otherwise(lacking)
    return lacking


def drift_bound(rules: RuleSet | None = None) -> Column:
    """The most that the booked cents of a path may differ from its product of shares.

    Carried along the hops: a split adds less than a cent of rounding, and what the
    declared proportions lack to one times the amount that is split; what has been added
    before is split on. An undivided amount (share of one) adds nothing. Where no version
    declares proportions the amount is not needed, and a bound of nothing is not split:
    this is worked out for every end point.
    """
    wide = "decimal(30,12)"
    amount, bound, split_before = F.col("gl_amount_eur").cast(wide), F.lit(0).cast(wide), False
    for step, column in HOP_SHARES.items():
        share, lacking = F.col(column).cast("decimal(13,12)"), _lacking(rules, step)
        added = F.lit(CENT).cast("decimal(38,17)")
        if lacking is not None:
            added = F.lit(CENT).cast(MONEY) + (F.abs(amount) + bound) * lacking
        bound = F.when(share == 1, bound).otherwise((bound * share + added if split_before else added).cast(wide))
        amount, split_before = (amount * share).cast(wide), True
    return bound.cast("decimal(28,10)")


def proportion_drift(edges: DataFrame, rules: RuleSet | None = None) -> DataFrame:
    """Allocated rows with the distance between the product of shares and the booked cents.

    ``rules`` are needed where declared proportions do not add up to one exactly.
    """
    drift = F.abs(F.col("raw_product_eur") - F.col("allocated_amount_eur")).cast("decimal(28,10)")
    return (
        edges.where(F.col("outcome") == ALLOCATED)
        .withColumn("raw_product_eur", raw_product())
        .withColumn("drift_eur", drift)
        .withColumn("within_bound", F.col("drift_eur") <= drift_bound(rules))
    )


def line_completeness(edges: DataFrame) -> DataFrame:
    """Per line and version, from lineage alone: does the sum of end points equal the line?"""
    return (
        edges.groupBy("rule_version", "gl_line_id")
        .agg(
            F.max("gl_amount_eur").alias("expected_eur"),
            F.sum("terminal_amount_eur").cast(MONEY).alias("actual_eur"),
        )
        .withColumn("balanced", F.col("expected_eur") == F.col("actual_eur"))
    )


def round_trip(edges: DataFrame, totals: DataFrame) -> DataFrame:
    """Lineage sums against the reconciliation ``totals``, one row per version."""
    sums = edges.groupBy("rule_version").agg(
        F.sum("allocated_amount_eur").cast(MONEY).alias("allocated"),
        F.sum("residual_amount_eur").cast(MONEY).alias("residual"),
    )
    zero = F.lit(0).cast(MONEY)
    difference = F.col("total_gl_eur") - F.col("total_lineage_allocated_eur") - F.col("total_lineage_residual_eur")
    return (
        totals.join(sums, "rule_version", "left")
        .withColumn("total_lineage_allocated_eur", F.coalesce("allocated", zero))
        .withColumn("total_lineage_residual_eur", F.coalesce("residual", zero))
        .withColumn("difference_eur", difference.cast(MONEY))
        .select(
            "rule_version",
            "total_gl_eur",
            "total_lineage_allocated_eur",
            "total_lineage_residual_eur",
            (F.col("difference_eur") == 0).alias("balanced"),
            "difference_eur",
            (F.col("total_lineage_allocated_eur") == F.col("total_allocated_eur")).alias("matches_allocation"),
            (F.col("total_lineage_residual_eur") == F.col("total_residual_eur")).alias("matches_residual"),
        )
    )


def require_round_trip(rows: DataFrame) -> list:
    """Run the round trip (one row per version) and raise if money went missing on the way."""
    found = rows.collect()
    for row in found:
        if not (row.balanced and row.matches_allocation and row.matches_residual):
            raise LineageError(f"Lineage and gold disagree under {row.rule_version}: {row.asDict()}")
    return found


def require_traceable(edges: DataFrame, rules: RuleSet | None = None) -> None:
    """Raise if a line is incomplete or the shares drift too far from the booked cents."""
    for row in line_completeness(edges).where(~F.col("balanced")).limit(1).collect():
        raise LineageError(
            f"Lineage of {row.gl_line_id} is incomplete: {row.expected_eur} went in, {row.actual_eur} came out"
        )
    for row in proportion_drift(edges, rules).where(~F.col("within_bound")).limit(1).collect():
        raise LineageError(
            f"Shares of {row.gl_line_id} drift {row.drift_eur} from the booked cents: "
            f"{row.raw_product_eur} against {row.allocated_amount_eur}"
        )


def first_fan_out(edges: DataFrame) -> DataFrame:
    """Smallest ledger line id with more than one allocated path, per version."""
    return (
        edges.where(F.col("outcome") == ALLOCATED)
        .groupBy("rule_version", "gl_line_id")
        .agg(F.count(F.lit(1)).alias("path_count"))
        .where(F.col("path_count") > 1)
        .groupBy("rule_version")
        .agg(F.min("gl_line_id").alias("gl_line_id"))
    )


def example_rows(edges: DataFrame, residual_cost_center: str) -> DataFrame:
    """Rows of the worked example: the paths of the first line that fans out, and the
    first residual line of a cost centre. One version yields one or a few dozen rows."""
    paths = first_fan_out(edges).withColumn("outcome", F.lit(ALLOCATED))
    left_over = edges.where((F.col("outcome") == RESIDUAL) & (F.col("cost_center_id") == residual_cost_center))
    first_left_over = (
        left_over.groupBy("rule_version").agg(F.min("gl_line_id").alias("gl_line_id")).withColumn("outcome", F.lit(RESIDUAL))
    )
    # Two rows per version, but a hint on the parts of a union is not one on the union.
    chosen = F.broadcast(paths.unionByName(first_left_over))
    product = F.when(F.col("outcome") == ALLOCATED, raw_product()).cast("decimal(28,10)")
    return (
        edges.join(chosen, ["rule_version", "outcome", "gl_line_id"], "left_semi")
        .withColumn("raw_product_eur", product)
        .withColumn(
            "difference_from_raw_eur",
            (F.col("allocated_amount_eur") - F.col("raw_product_eur")).cast("decimal(28,10)"),
        )
        .select(*LINEAGE_COLUMNS, "raw_product_eur", "difference_from_raw_eur")
    )


def worked_example(edges: DataFrame, rules: DataFrame, residual_cost_center: str) -> DataFrame:
    """The example as one JSON document per version: (rule_version, example_json)."""
    text = lambda name: F.col(name).cast("string").alias(name)
    path = F.struct(
        "gl_line_id",
        "tower_id",
        "app_id",
        "bu_id",
        *[text(c) for c in ("gl_amount_eur", "prop_gl_to_tower", "prop_tower_to_app", "prop_app_to_bu", "raw_product_eur")],
        F.col("allocated_amount_eur").cast("string").alias("rounded_terminal_amount_eur"),
        text("difference_from_raw_eur"),
    )
    steps = rules.groupBy(F.col("version_id").alias("rule_version")).agg(
        F.max(F.when(F.col("step") == "gl_to_tower", F.col("basis"))).alias("basis"),
        F.max(F.when(F.col("step") == "tower_to_app", F.col("metric_name"))).alias("app_driver"),
        F.max(F.when(F.col("step") == "app_to_bu", F.col("metric_name"))).alias("bu_driver"),
    )
    rows = example_rows(edges, residual_cost_center)
    allocated = (
        rows.where(F.col("outcome") == ALLOCATED)
        .groupBy("rule_version", "gl_line_id", "gl_account", "cost_center_id", "gl_amount_eur")
        .agg(
            F.array_sort(F.collect_list(path)).alias("paths"),
            F.sum("allocated_amount_eur").cast("string").alias("terminal_total_eur"),
        )
        .join(steps, "rule_version")
        .select(
            "rule_version",
            F.struct(
                "gl_line_id",
                "gl_account",
                "cost_center_id",
                text("gl_amount_eur"),
                F.col("basis").alias("gl_to_tower_basis"),
                F.col("app_driver").alias("tower_to_app_driver"),
                F.col("bu_driver").alias("app_to_bu_driver"),
                "paths",
                "terminal_total_eur",
            ).alias("allocated_example"),
        )
    )
    residual = rows.where(F.col("outcome") == RESIDUAL).groupBy("rule_version").agg(
        F.min(
            F.struct(
                "gl_line_id",
                "gl_account",
                "cost_center_id",
                text("gl_amount_eur"),
                "outcome",
                "reason_code",
                "failed_step",
                "tower_id",
                "app_id",
                "bu_id",
                text("terminal_amount_eur"),
            )
        ).alias("residual_example")
    )
    document = F.struct(
        "rule_version",
        F.lit(ROUNDING_NOTE).alias("rounding_note"),
        "allocated_example",
        "residual_example",
    )
    return allocated.join(residual, "rule_version", "full").select(
        "rule_version", F.to_json(document, {"ignoreNullFields": "false"}).alias("example_json")
    )
