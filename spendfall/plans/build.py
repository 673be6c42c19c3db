"""Stages from CSV exports to reports. Each reads what the one before has written.

``bronze`` -> ``silver`` -> ``gold`` -> ``residual`` -> ``lineage`` -> ``reports``.
Nothing of a stage is written before its gate has passed, and an allocation is only
written for rule versions that pass governance.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendfall.operators import lineage as lin
from spendfall.operators import reports as rep
from spendfall.operators.cascade import allocation, ends_of, residual, run_cascade, split_table
from spendfall.operators.conform import conform
from spendfall.operators.contracts import require_sound, typed
from spendfall.operators.quality import quality_report, require_passed
from spendfall.operators.reconcile import (
    line_reconciliation,
    reconciliation,
    require_balanced,
    require_lines_balanced,
)
from spendfall.operators.quarantine import require_none_broken, split_sound
from spendfall.operators.rule_checks import require_governed, rule_violations
from spendfall.schemas import CONTRACTS, SILVER_TABLES
from spendfall.session import discard, discard_materialized, materialize, scratch_dir
from spendfall.sources.csv_exports import check_header, export_path, scan_raw
from spendfall.sources.rule_files import RuleSet, load_rules
from spendfall.sources.tables import link_table, publish, read_table, read_tables, write_table

STAGES = ("bronze", "silver", "gold", "residual", "lineage", "reports")
ALONE = ("gold", "residual", "lineage", "reports")


@dataclass(frozen=True)
class Folders:
    """Where the stages read and write; every folder must be reachable by all executors."""

    source: str
    bronze: str
    silver: str
    gold: str
    rules: str
    examples: str | None = None


def ingest(
    spark: SparkSession,
    source_dir: str,
    bronze_dir: str,
    overrides: Mapping[str, str] | None = None,
    *,
    multi_line: bool = False,
    quarantine_dir: str | None = None,
) -> dict[str, str]:
    """CSV exports to bronze, all tables or none.

    All are checked before the first write. With ``quarantine_dir`` each export is read
    once and its broken rows stay there with the codes of the rules they break; without,
    only the first of them are told. ``multi_line`` allows line breaks in quoted cells.
    """
    paths = {table: export_path(source_dir, table, overrides) for table in CONTRACTS}
    for table, path in paths.items():
        check_header(spark, path, table)
    raws = {table: scan_raw(spark, path, table, multi_line=multi_line) for table, path in paths.items()}
    if not quarantine_dir:
        require_sound(raws)
        return publish({table: typed(raw, table) for table, raw in raws.items()}, bronze_dir)
    checked = [split_sound(raw, table, quarantine_dir) for table, raw in raws.items()]
    try:
        require_none_broken(checked)
        return publish({source.table: typed(source.sound, source.table) for source in checked}, bronze_dir)
    finally:
        discard(spark, *(f"{source.path}/broken=false" if source.broken_count else source.path for source in checked))


def build_silver(spark: SparkSession, bronze_dir: str, silver_dir: str, control_total: Decimal) -> list:
    """Bronze to silver behind the data-quality gate; returns the passed report."""
    conformed = conform(read_tables(spark, bronze_dir, CONTRACTS))
    report = require_passed(quality_report(conformed, control_total))
    publish({table: conformed.tables[table] for table in SILVER_TABLES}, silver_dir)
    return report


def allocate(spark: SparkSession, silver_dir: str, gold_dir: str, rules: RuleSet) -> list[str]:
    """Silver to the gold allocation and residual tables, all given versions in one pass.

    End points are stored once in the shared scratch folder; the checks and both tables
    read them from there.
    """
    silver = read_tables(spark, silver_dir, ["fact_gl_cost", "fact_usage_metric", "dim_resource_tower"])
    gl, usage = silver["fact_gl_cost"], silver["fact_usage_metric"]
    require_governed(rule_violations(rules.rules(spark), rules.params(spark), usage))
    splits = split_table(usage, silver["dim_resource_tower"], rules)
    folder = f"{scratch_dir(spark)}/ends-{uuid4().hex}"
    frame = run_cascade(gl, splits, rules)
    try:
        frame.write.mode("overwrite").partitionBy("outcome").parquet(folder)
        ends = spark.read.schema(frame.schema).parquet(folder)
        require_balanced(reconciliation(gl, ends, rules.versions))
        require_lines_balanced(line_reconciliation(gl, ends, rules.versions))
        return [
            write_table(allocation(ends), gold_dir, "allocation", versions=rules.versions),
            write_table(residual(ends), gold_dir, "residual", versions=rules.versions),
        ]
    finally:
        discard(spark, folder)
        discard_materialized(spark)


def _stored_ends(spark: SparkSession, gold_dir: str, versions: Sequence[str]) -> DataFrame:
    of_versions = F.col("rule_version").isin(*versions)
    gold = read_tables(spark, gold_dir, ["allocation", "residual"])
    return ends_of(gold["allocation"].where(of_versions), gold["residual"].where(of_versions))


def build_residual(spark: SparkSession, silver_dir: str, gold_dir: str, versions: Sequence[str]) -> list[str]:
    """Residual detail, residual report and reconciliation of the stored versions."""
    silver = read_tables(spark, silver_dir, ["fact_gl_cost", "dim_cost_center"])
    gl = silver["fact_gl_cost"]
    totals = reconciliation(gl, _stored_ends(spark, gold_dir, versions), versions)
    require_balanced(totals)
    stored = read_table(spark, gold_dir, "residual").where(F.col("rule_version").isin(*versions))
    written = [write_table(rep.residual_detail(stored, gl, silver["dim_cost_center"]), gold_dir, "residual_detail", versions=versions)]
    detail = read_table(spark, gold_dir, "residual_detail").where(F.col("rule_version").isin(*versions))
    written.append(write_table(rep.residual_report(detail, gl), gold_dir, "residual_report", versions=versions))
    written.append(write_table(totals, gold_dir, "reconciliation", versions=versions))
    return written


def build_lineage(
    spark: SparkSession,
    silver_dir: str,
    gold_dir: str,
    rules: RuleSet,
    *,
    examples_dir: str | None = None,
    example_cost_center: str | None = None,
) -> str:
    """Lineage of the stored versions, checked after it has been written and read back."""
    versions = rules.versions
    silver = read_tables(spark, silver_dir, ["fact_gl_cost", "dim_cost_center"])
    gl = silver["fact_gl_cost"]
    ends = _stored_ends(spark, gold_dir, versions)
    path = write_table(lin.lineage(ends, gl, silver["dim_cost_center"]), gold_dir, "lineage", versions=versions)
    edges = read_table(spark, gold_dir, "lineage").where(F.col("rule_version").isin(*versions))
    lin.require_traceable(edges, rules)
    lin.require_round_trip(lin.round_trip(edges, reconciliation(gl, ends, versions)))
    if examples_dir and example_cost_center:
        example = lin.worked_example(edges, rules.rules(spark), example_cost_center)
        example.coalesce(1).write.mode("overwrite").json(f"{examples_dir}/lineage_worked_example")
    return path


def build_reports(
    spark: SparkSession, silver_dir: str, gold_dir: str, compared: RuleSet, first: str, second: str
) -> list[str]:
    """The six reports. The comparison reruns both versions, so it does not depend on
    which versions are stored; the other reports show what is stored."""
    silver = read_tables(
        spark,
        silver_dir,
        ["dim_application", "dim_business_unit", "dim_resource_tower", "fact_gl_cost", "fact_usage_metric"],
    )
    gold = read_tables(spark, gold_dir, ["allocation", "residual_report", "lineage"])
    gl = silver["fact_gl_cost"]
    both = compared.only(first, second)
    splits = split_table(silver["fact_usage_metric"], silver["dim_resource_tower"], both)
    ends = run_cascade(gl, splits, both)
    # One pass over the cascade: everything the comparison needs is this small.
    summed = (
        ends.groupBy("rule_version", "outcome", "app_id", "bu_id")
        .agg(F.sum("amount_eur").cast("decimal(18,2)").alias("amount_eur"))
    )
    summed = materialize(summed)
    require_balanced(reconciliation(gl, summed, both.versions))
    allocated = summed.where(F.col("outcome") == "allocated").withColumnRenamed("amount_eur", "allocated_amount_eur")
    apps, units = silver["dim_application"], silver["dim_business_unit"]
    tables = {
        "report_application_tco": rep.application_tco(gold["allocation"], apps),
        "report_bu_showback": rep.bu_showback(gold["allocation"], units),
        "report_residual": gold["residual_report"],
        "report_driver_comparison": rep.driver_comparison(allocated, units, first, second),
        "report_driver_comparison_by_app": rep.driver_comparison_by_app(allocated, apps, units, first, second),
    }
    written = [write_table(frame, gold_dir, table, versions=compared.versions) for table, frame in tables.items()]
    return [*written, link_table(spark, gold_dir, "report_lineage", "lineage")]


def stages_to_run(target: str | None) -> list[str]:
    """All stages; or bronze and silver up to the target; or a later stage alone."""
    if target is None:
        return list(STAGES)
    if target not in STAGES:
        raise ValueError(f"There is no stage '{target}', only {', '.join(STAGES)}")
    return [target] if target in ALONE else list(STAGES[: STAGES.index(target) + 1])


def run_stages(
    spark: SparkSession,
    folders: Folders,
    *,
    control_total: Decimal,
    default_version: str,
    compared: tuple[str, str],
    target: str | None = None,
    example_cost_center: str | None = None,
) -> list[str]:
    """Run the stages through (or only) ``target`` for the default rule version."""
    rules = load_rules(folders.rules, spark)
    chosen = rules.only(default_version)
    scratch_dir(spark)
    ran = stages_to_run(target)
    for stage in ran:
        if stage == "bronze":
            ingest(spark, folders.source, folders.bronze)
        elif stage == "silver":
            build_silver(spark, folders.bronze, folders.silver, control_total)
        elif stage == "gold":
            allocate(spark, folders.silver, folders.gold, chosen)
        elif stage == "residual":
            build_residual(spark, folders.silver, folders.gold, chosen.versions)
        elif stage == "lineage":
            build_lineage(
                spark,
                folders.silver,
                folders.gold,
                chosen,
                examples_dir=folders.examples,
                example_cost_center=example_cost_center,
            )
        else:
            build_reports(spark, folders.silver, folders.gold, rules, *compared)
    return ran


