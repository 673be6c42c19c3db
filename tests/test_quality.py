"""Conformance and the nineteen data-quality checks."""

from __future__ import annotations

from decimal import Decimal

import pytest

from conftest import GL_TOTAL
from spendfall.operators.conform import Conformed, conform
from spendfall.operators.quality import QualityError, duplicate_keys, quality_report, require_passed, unresolved_keys
from spendfall.session import materialize


def _failures(report) -> dict:
    return {row.name: row.failure_count for row in report.collect() if not row.passed}


def test_clean_fixture_passes_all_checks(conformed):
    rows = require_passed(quality_report(conformed, GL_TOTAL))
    assert len(rows) == 19 and len({row.name for row in rows}) == 19
    detail = {row.name: row.detail for row in rows}
    assert detail["fact_gl_cost_reconciliation"] == "expected=61813.95 actual=61813.95"


def test_conformed_tables_are_trimmed_and_distinct(spark, bronze):
    doubled = dict(bronze)
    padded = spark.createDataFrame([(" BU-CORP ", " Corp", "x")], bronze["business_units"].schema)
    doubled["business_units"] = bronze["business_units"].unionByName(padded)
    doubled["cost_centers"] = bronze["cost_centers"].fillna({"tower_id": "  "})
    found = conform(doubled)
    assert found.candidates["dim_business_unit"].count() == 4
    assert found.tables["dim_business_unit"].count() == 3
    assert found.tables["fact_gl_cost"].where("tower_id IS NULL").count() == 8
    assert found.tables["fact_gl_cost"].columns == ["gl_line_id", "period", "gl_account", "cost_center_id", "amount_eur", "tower_id"]


def test_wrong_control_total_fails_one_check(conformed):
    assert _failures(quality_report(conformed, Decimal("1.00"))) == {"fact_gl_cost_reconciliation": 1}


def test_conflicting_dimension_rows_are_found(spark, bronze):
    broken = dict(bronze)
    extra = spark.createDataFrame([("CC-BIZ-APPS", "Other", "TWR-COMPUTE", "x")], bronze["cost_centers"].schema)
    broken["cost_centers"] = bronze["cost_centers"].unionByName(extra)
    failed = _failures(quality_report(conform(broken), GL_TOTAL))
    assert failed["dim_cost_center_conflicting_pk"] == 1 and failed["dim_cost_center_pk_unique"] == 1
    with pytest.raises(QualityError, match="dim_cost_center_conflicting_pk: 1 failures"):
        require_passed(quality_report(conform(broken), GL_TOTAL))


def test_null_attribute_conflicts_with_a_value(spark, bronze):
    broken = dict(bronze)
    extra = spark.createDataFrame([("CC-LEGACY", "Legacy Shared Services", "TWR-LABOR", "x")], bronze["cost_centers"].schema)
    broken["cost_centers"] = bronze["cost_centers"].unionByName(extra)
    assert _failures(quality_report(conform(broken), GL_TOTAL))["dim_cost_center_conflicting_pk"] == 1


def test_every_foreign_key_and_sign_is_checked(spark, bronze):
    broken = dict(bronze)
    broken["gl_costs"] = bronze["gl_costs"].unionByName(
        spark.createDataFrame(
            [("GL-A", "2026-01", "7000", "CC-NONE", Decimal("-1.00"), "d", "x"), ("GL-000001", "2026-01", "7000", "CC-LEGACY", Decimal("1.00"), "d", "x")],
            bronze["gl_costs"].schema,
        )
    )
    broken["resource_towers"] = bronze["resource_towers"].where("tower_id <> 'TWR-NETWORK'")
    broken["applications"] = bronze["applications"].where("app_id <> 'APP-CRM'")
    broken["business_units"] = bronze["business_units"].where("bu_id <> 'BU-CORP'")
    broken["usage_metrics"] = bronze["usage_metrics"].unionByName(
        spark.createDataFrame([("X", "2026-01", "app_to_bu", "APP-ERP", "BU-RETAIL", "m", Decimal("-2.00"), "x")], bronze["usage_metrics"].schema)
    )
    assert _failures(quality_report(conform(broken), GL_TOTAL)) == {
        "fact_gl_cost_pk_unique": 1,
        "dim_cost_center_tower_fk": 1,
        "fact_gl_cost_cost_center_fk": 1,
        "fact_gl_cost_tower_fk": 8,
        "fact_gl_cost_non_negative_amount": 1,
        "fact_usage_metric_tower_to_app_from_fk": 6,
        "fact_usage_metric_tower_to_app_to_fk": 6,
        "fact_usage_metric_app_to_bu_from_fk": 6,
        "fact_usage_metric_app_to_bu_to_fk": 10,
        "fact_usage_metric_non_negative_value": 1,
    }


def test_null_matches_null_in_key_checks(spark):
    left = spark.createDataFrame([(None,), ("a",), ("b",), ("b",)], "k string")
    right = spark.createDataFrame([(None,), ("a",)], "r string")
    found = unresolved_keys(left, "k", right, "r")
    assert [(row.key_value, row.row_count) for row in found.collect()] == [("b", 2)]
    assert unresolved_keys(left, "k", right.where("r IS NOT NULL"), "r").count() == 2
    assert unresolved_keys(left, "k", right.where("r IS NOT NULL"), "r", skip_null=True).count() == 1
    assert [(row.k, row.row_count) for row in duplicate_keys(left, ["k"]).collect()] == [("b", 2)]


def test_every_table_is_read_once(conformed):
    """Stored tables stand in the plan once each, and nothing is joined."""
    dimensions = {name: materialize(frame) for name, frame in conformed.candidates.items()}
    facts = {name: materialize(conformed.tables[name]) for name in ("fact_gl_cost", "fact_usage_metric")}
    report = quality_report(Conformed(dimensions, {name: frame.distinct() for name, frame in dimensions.items()} | facts), GL_TOTAL)
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 6 and "Join" not in plan
    assert len(require_passed(report)) == 19


def test_tables_apart_from_their_candidates_are_read_for_themselves(conformed):
    tables = dict(conformed.tables)
    tables["dim_business_unit"] = tables["dim_business_unit"].unionAll(tables["dim_business_unit"])
    assert _failures(quality_report(Conformed(conformed.candidates, tables), GL_TOTAL)) == {"dim_business_unit_pk_unique": 3}
