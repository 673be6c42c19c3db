"""The nineteen data-quality checks of the conformed tables.

All checks come out of one grouping: a row of a table tells the keys it has and the keys it
refers to, each in the domain of the dimension that should know it. Summed by domain and key,
these rows say how often a key stands in its table and how often it is referred to. Each
table is read once, nothing is joined, and a hot key is one row before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendfall.operators.conform import Conformed
from spendfall.schemas import APP_TO_BU, TOWER_TO_APP

# Fixed check texts.
UNRESOLVED_TOWER = "NULL tower_id is intentionally allowed; only non-null tower keys must resolve."
UNMAPPED_LINE = "NULL tower_id is intentionally allowed for the unmapped residual anchor."

# Dimension -> (key, attributes).
DIMENSIONS = {
    "dim_cost_center": ("cost_center_id", ["name", "tower_id"]),
    "dim_resource_tower": ("tower_id", ["name", "type"]),
    "dim_application": ("app_id", ["name", "criticality"]),
    "dim_business_unit": ("bu_id", ["name"]),
}


class QualityError(ValueError):
    """At least one check failed; nothing has been written."""


def duplicate_keys(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)


def conflicting_keys(frame: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """Keys with more than one distinct set of attributes; NULL is a value of its own."""
    return (
        frame.select(key, F.struct(*attributes).alias("variant"))
        .distinct()
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("variant_count"))
        .where(F.col("variant_count") > 1)
    )


def unresolved_keys(
    left: DataFrame, left_key: str, right: DataFrame, right_key: str, *, skip_null: bool = False
) -> DataFrame:
    """Left keys without a partner on the right, with their rows. NULL matches NULL."""
    source = left.where(F.col(left_key).isNotNull()) if skip_null else left
    counted = source.groupBy(F.col(left_key).alias("key_value")).agg(F.count(F.lit(1)).alias("row_count"))
    known = right.select(F.col(right_key).alias("known_value")).distinct()
    return counted.join(known, F.col("key_value").eqNullSafe(F.col("known_value")), "left_anti")


# Tags of rows: a row of a table, a distinct row of a dimension before DISTINCT, or both.
ROW, VARIANT, BOTH, NEGATIVE = "row", "variant", "both", "negative"
# Foreign keys: check -> dimension that should know the key.
FOREIGN_KEYS = {
    "dim_cost_center_tower_fk": "dim_resource_tower",
    "fact_gl_cost_cost_center_fk": "dim_cost_center",
    "fact_gl_cost_tower_fk": "dim_resource_tower",
    "fact_usage_metric_tower_to_app_from_fk": "dim_resource_tower",
    "fact_usage_metric_tower_to_app_to_fk": "dim_application",
    "fact_usage_metric_app_to_bu_from_fk": "dim_application",
    "fact_usage_metric_app_to_bu_to_fk": "dim_business_unit",
}
DETAILS = {"dim_cost_center_tower_fk": UNRESOLVED_TOWER, "fact_gl_cost_tower_fk": UNMAPPED_LINE}


def _told(domain: str, key: str | None, tag: str, amount: str | None = None, where: Column | None = None) -> Column:
    told = F.struct(
        F.lit(domain).alias("domain"),
        (F.col(key).cast("string") if key else F.lit(None).cast("string")).alias("key"),
        F.lit(tag).alias("tag"),
        (F.col(amount) if amount else F.lit(None)).cast("decimal(18,2)").alias("amount"),
    )
    return told if where is None else F.when(where, told)


def _refers(check: str, key: str, where: Column | None = None) -> Column:
    return _told(FOREIGN_KEYS[check], key, check, where=where)


def _tell(frame: DataFrame, *told: Column) -> DataFrame:
    """One row per table row and thing it tells, in one scan."""
    return frame.select(F.inline(F.array(*told))).where("tag IS NOT NULL")


def _dimension_rows(conformed: Conformed, name: str) -> list[DataFrame]:
    key, attributes = DIMENSIONS[name]
    table, candidates = conformed.tables[name], conformed.candidates[name]
    more = []
    if name == "dim_cost_center":
        more.append(_refers("dim_cost_center_tower_fk", "tower_id", F.col("tower_id").isNotNull()))
    if set(table.columns) == {key, *attributes} and table.sameSemantics(candidates.distinct()):
        # the table is the distinct candidates: one read tells both
        return [_tell(table, _told(name, key, BOTH), *more)]
    variants = candidates.select(key, *attributes).distinct()
    return [_tell(table, _told(name, key, ROW), *more), _tell(variants, _told(name, key, VARIANT))]


def _ledger_rows(ledger: DataFrame) -> DataFrame:
    return _tell(
        ledger,
        _told("fact_gl_cost", "gl_line_id", ROW, "amount_eur"),
        _refers("fact_gl_cost_cost_center_fk", "cost_center_id"),
        _refers("fact_gl_cost_tower_fk", "tower_id", F.col("tower_id").isNotNull()),
        _told("fact_gl_cost", None, NEGATIVE, where=F.col("amount_eur") < 0),
    )


def _usage_rows(usage: DataFrame) -> DataFrame:
    second, third = F.col("step") == TOWER_TO_APP, F.col("step") == APP_TO_BU
    return _tell(
        usage,
        _refers("fact_usage_metric_tower_to_app_from_fk", "from_id", second),
        _refers("fact_usage_metric_tower_to_app_to_fk", "to_id", second),
        _refers("fact_usage_metric_app_to_bu_from_fk", "from_id", third),
        _refers("fact_usage_metric_app_to_bu_to_fk", "to_id", third),
        _told("fact_usage_metric", None, NEGATIVE, where=F.col("value") < 0),
    )


def _in_domain(domain: str, condition: Column) -> Column:
    return F.count_if((F.col("domain") == domain) & condition)


def quality_report(conformed: Conformed, control_total: Decimal | Column) -> DataFrame:
    """All checks as (name, passed, failure_count, detail), nineteen rows.

    ``control_total`` is the ledger total the source system reports: a number, or a
    scalar subquery over the source. NULL is a key like any other, but for tower keys of
    cost centres and ledger lines, which may be NULL.
    """
    parts = [frame for name in DIMENSIONS for frame in _dimension_rows(conformed, name)]
    parts += [_ledger_rows(conformed.tables["fact_gl_cost"]), _usage_rows(conformed.tables["fact_usage_metric"])]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    by_key = rows.groupBy("domain", "key").agg(
        F.count_if(F.col("tag").isin(ROW, BOTH)).alias("row_count"),
        F.count_if(F.col("tag").isin(VARIANT, BOTH)).alias("variant_count"),
        F.count_if(F.col("tag") == NEGATIVE).alias("negative_count"),
        *(F.count_if(F.col("tag") == check).alias(check) for check in FOREIGN_KEYS),
        F.sum("amount").alias("amount"),
    )
    repeated, unknown, money = F.col("row_count") > 1, F.col("row_count") == 0, "decimal(38,2)"
    negative = {name: F.sum(F.when(F.col("domain") == name, F.col("negative_count"))) for name in ("fact_gl_cost", "fact_usage_metric")}
    keys = {check: F.sum(F.when(unknown, F.col(check))) for check in FOREIGN_KEYS}
    counts = {
        **{f"{name}_conflicting_pk": _in_domain(name, F.col("variant_count") > 1) for name in DIMENSIONS},
        **{f"{name}_pk_unique": _in_domain(name, repeated) for name in [*DIMENSIONS, "fact_gl_cost"]},
        **{check: count for check, count in keys.items() if not check.startswith("fact_usage")},
        "fact_gl_cost_non_negative_amount": negative["fact_gl_cost"],
        "fact_gl_cost_reconciliation": F.lit(None).cast("bigint"),
        **{check: count for check, count in keys.items() if check.startswith("fact_usage")},
        "fact_usage_metric_non_negative_value": negative["fact_usage_metric"],
    }
    expected = control_total if isinstance(control_total, Column) else F.lit(control_total)
    measures = by_key.agg(
        *(count.alias(name) for name, count in counts.items()), F.coalesce(F.sum("amount"), F.lit(0)).cast(money).alias("actual")
    ).select("*", expected.cast(money).alias("expected"))
    balanced = F.when(F.col("actual") == F.col("expected"), 0).otherwise(1)
    totals = F.concat(F.lit("expected="), F.col("expected").cast("string"), F.lit(" actual="), F.col("actual").cast("string"))
    details = {name: F.lit(DETAILS.get(name)).cast("string") for name in counts} | {"fact_gl_cost_reconciliation": totals}
    return _as_checks(measures.withColumn("fact_gl_cost_reconciliation", balanced), details)


def _as_checks(measures: DataFrame, details: dict[str, Column]) -> DataFrame:
    """One row of failure counts turned into one row per check."""
    checks = [
        F.struct(
            F.lit(name).alias("name"),
            (F.coalesce(F.col(name), F.lit(0)) == 0).alias("passed"),
            F.coalesce(F.col(name), F.lit(0)).cast("bigint").alias("failure_count"),
            detail.alias("detail"),
        )
        for name, detail in details.items()
    ]
    return measures.select(F.inline(F.array(*checks)))


def require_passed(report: DataFrame) -> list:
    """Run the report (nineteen rows) and raise if any check failed."""
    rows = report.collect()
    failed = [row for row in rows if not row.passed]
    if failed:
        lines = ["Data-quality checks failed:"]
        for row in failed:
            detail = f" ({row.detail})" if row.detail else ""
            lines.append(f"  {row.name}: {row.failure_count} failures{detail}")
        raise QualityError("\n".join(lines))
    return rows
