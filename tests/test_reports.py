"""Residual, reconciliation, lineage and comparison reports on the ledger fixture."""

from __future__ import annotations

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import GL_TOTAL
from spendfall.operators import lineage as lin
from spendfall.operators import reports as rep
from spendfall.operators.cascade import allocation, cascade, ends_of, residual
from spendfall.operators.reconcile import (
    ReconciliationError,
    line_reconciliation,
    reconciliation,
    require_balanced,
    require_lines_balanced,
)
from spendfall.schemas import LINEAGE_COLUMNS
from spendfall.sources.rule_files import rule_set

V1, V2 = "v1_transactions", "v2_named_users"
VERSIONS = [V1, V2]


@pytest.fixture(scope="module")
def ends(silver, rules):
    return cascade(silver["fact_gl_cost"], silver["fact_usage_metric"], silver["dim_resource_tower"], rules).cache()


@pytest.fixture(scope="module")
def gl(silver):
    return silver["fact_gl_cost"]


@pytest.fixture(scope="module")
def edges(ends, gl, silver):
    return lin.lineage(ends, gl, silver["dim_cost_center"]).cache()


def test_reconciliation_is_exact(gl, ends):
    rows = require_balanced(reconciliation(gl, ends, VERSIONS))
    assert {row.rule_version: str(row.total_allocated_eur) for row in rows} == {V1: "3568.14", V2: "11150.42"}
    assert {row.total_gl_eur for row in rows} == {GL_TOTAL}
    require_lines_balanced(line_reconciliation(gl, ends, VERSIONS))


def test_lost_changed_or_foreign_rows_are_noticed(gl, ends):
    lost = ends.where("NOT (gl_line_id = 'GL-000025')")
    with pytest.raises(ReconciliationError, match="by 1449.37"):
        require_balanced(reconciliation(gl, lost, VERSIONS))
    with pytest.raises(ReconciliationError, match="GL-000025"):
        require_lines_balanced(line_reconciliation(gl, lost, VERSIONS))
    foreign = ends.withColumn("gl_line_id", F.when(F.col("gl_line_id") == "GL-000025", "GL-X").otherwise(F.col("gl_line_id")))
    lines = line_reconciliation(gl, foreign, [V1]).where("NOT balanced").collect()
    assert {row.gl_line_id for row in lines} == {"GL-X", "GL-000025"}


def test_version_without_rows_is_reported(gl, ends):
    rows = {row.rule_version: row for row in reconciliation(gl, ends, [V1, "v3"]).collect()}
    assert rows[V1].balanced and not rows["v3"].balanced and rows["v3"].total_allocated_eur == 0


def test_residual_reports(gl, ends, silver):
    detail = rep.residual_detail(residual(ends), gl, silver["dim_cost_center"])
    assert detail.count() == residual(ends).count()
    assert detail.where("cost_center_name IS NULL").count() == 0
    rows = {(r.rule_version, r.failed_step): r for r in rep.residual_report(detail, gl).collect()}
    row = rows[V1, "app_to_bu"]
    assert (str(row.residual_amount_eur), row.gl_line_count, str(row.pct_of_total_gl)) == ("7582.28", 8, "0.122663")
    assert rows[V1, "tower_to_app"].gl_line_count == 32


def test_application_and_unit_reports(ends, silver):
    apps = {(r.rule_version, r.app_id): r for r in rep.application_tco(allocation(ends), silver["dim_application"]).collect()}
    billing = apps[V1, "APP-BILLING"]
    assert (str(billing.allocated_amount_eur), billing.contributing_gl_line_count, billing.business_criticality) == ("3568.14", 8, "med")
    assert billing.pct_of_allocated == 1
    units = {(r.rule_version, r.bu_id): r for r in rep.bu_showback(allocation(ends), silver["dim_business_unit"]).collect()}
    corp = units[V2, "BU-CORP"]
    assert (str(corp.allocated_amount_eur), corp.contributing_app_count, corp.contributing_gl_line_count) == ("4852.04", 4, 8)
    for version in VERSIONS:
        assert abs(sum(r.pct_of_allocated for k, r in units.items() if k[0] == version) - 1) <= Decimal("0.000003")


def test_unknown_dimension_keys_fall_back_to_the_id(ends, silver):
    none = silver["dim_application"].where("false")
    row = rep.application_tco(allocation(ends), none).where("app_id = 'APP-ERP'").first()
    assert row.app_name == "APP-ERP" and row.business_criticality == ""


def test_driver_comparison(ends, silver):
    compared = rep.driver_comparison(allocation(ends), silver["dim_business_unit"], V1, V2)
    rows = {r.bu_id: r for r in compared.collect()}
    retail = rows["BU-RETAIL"]
    assert (str(retail[f"amount_{V1}"]), str(retail[f"amount_{V2}"])) == ("2854.52", "3351.49")
    assert (str(retail.share_v1), str(retail.share_v2)) == ("0.800002", "0.300571")
    assert str(rep.max_share_swing(compared).first()[0]) == "0.499432"
    assert str(retail.delta_pct) == "0.174099"
    by_app = rep.driver_comparison_by_app(allocation(ends), silver["dim_application"], silver["dim_business_unit"], V1, V2)
    assert by_app.agg(F.sum("delta_eur")).first()[0] == Decimal("7582.28")
    flips = {r.app_id: (r.top_bu_v1, r.top_bu_v2, r.flipped) for r in rep.top_bu_flip(by_app, V1, V2).collect()}
    assert flips["APP-BILLING"] == ("BU-RETAIL", "BU-CORP", True)
    assert flips["APP-ERP"] == (None, "BU-WHOLESALE", True)


def test_comparison_with_an_empty_version(ends, silver):
    rows = rep.driver_comparison(allocation(ends), silver["dim_business_unit"], "none", V2).collect()
    for row in rows:
        assert row.delta_pct is None and row.share_v1 == 0 and row.share_delta_pp == row.share_v2


def test_lineage_is_the_same_from_cascade_and_from_stored_tables(ends, gl, silver, edges):
    stored = lin.lineage(ends_of(allocation(ends), residual(ends)), gl, silver["dim_cost_center"])
    assert stored.columns == edges.columns == LINEAGE_COLUMNS
    assert sorted(map(str, stored.collect())) == sorted(map(str, edges.collect()))


def test_traces(edges):
    assert lin.trace_forward(edges, V1, "GL-000025").count() == 1
    keys = edges.where("cost_center_id = 'CC-CLOUD-COMPUTE'").select("gl_line_id").distinct()
    assert lin.trace_forward(edges, V1, keys).count() == 8 * (3 + 3)
    assert lin.trace_backward(edges, V2, bu_id="BU-CORP").agg(F.sum("allocated_amount_eur")).first()[0] == Decimal("4852.04")
    assert lin.trace_backward(edges, V1, bu_id="BU-CORP", app_id="APP-ERP").count() == 0
    with pytest.raises(ValueError, match="bu_id"):
        lin.trace_backward(edges, V1)


def test_lineage_checks_pass_and_notice_tampering(ends, gl, edges):
    totals = reconciliation(gl, ends, VERSIONS)
    lin.require_traceable(edges)
    lin.require_round_trip(lin.round_trip(edges, totals))
    drift = lin.proportion_drift(edges).agg(F.max("drift_eur")).first()[0]
    assert 0 < drift <= Decimal("0.03")
    bound = edges.where("outcome = 'allocated'").agg(F.max(lin.drift_bound())).first()[0]
    assert drift <= bound <= Decimal("0.02")
    lost = edges.where("NOT (gl_line_id = 'GL-000009' AND bu_id = 'BU-CORP')")
    with pytest.raises(lin.LineageError, match="GL-000009"):
        lin.require_traceable(lost)
    with pytest.raises(lin.LineageError, match="disagree"):
        lin.require_round_trip(lin.round_trip(lost, totals))
    moved = edges.withColumn("prop_app_to_bu", F.when(F.col("bu_id") == "BU-CORP", F.lit(0).cast("decimal(18,12)")).otherwise(F.col("prop_app_to_bu")))
    with pytest.raises(lin.LineageError, match="drift"):
        lin.require_traceable(moved)


def _declared(spark, proportions, amounts):
    """Rules of one declared last hop, and the lineage of single-tower lines under them."""
    rules = rule_set(
        [
            {
                "version_id": "v",
                "description": "d",
                "created": "2026-01-01",
                "gl_to_tower": {"basis": "cost_center_mapping"},
                "tower_to_app": {"strategy": "even_spread"},
                "app_to_bu": {"strategy": "manual_override", "proportions": proportions},
            }
        ]
    )
    ledger = [(f"G{k}", "2026-01", "7000", "C", Decimal(amount), "T") for k, amount in enumerate(amounts)]
    gl = spark.createDataFrame(ledger, "gl_line_id string, period string, gl_account string, cost_center_id string, amount_eur decimal(18,2), tower_id string")
    found = [("tower_to_app", "T", "A0"), ("tower_to_app", "T", "A1"), ("app_to_bu", "A0", "B"), ("app_to_bu", "A1", "C")]
    usage = spark.createDataFrame(
        [(f"M{k}", "2026-01", *row, "m", Decimal(1)) for k, row in enumerate(found)],
        "metric_id string, period string, step string, from_id string, to_id string, metric_name string, value decimal(18,2)",
    )
    towers = spark.createDataFrame([("T", "t", "c")], "tower_id string, name string, type string")
    centers = spark.createDataFrame([("C", "c", "T")], "cost_center_id string, name string, tower_id string")
    return rules, lin.lineage(cascade(gl, usage, towers, rules), gl, centers).cache()


@pytest.mark.parametrize("proportions", [{"B": "0.999999"}, {"B": "0.4", "C": "0.5999995"}, {"B": "1"}, {"B": "0.5", "C": "0.500001"}])
def test_the_bound_follows_what_proportions_lack(spark, proportions):
    rules, edges = _declared(spark, proportions, ["1000000.00", "0.01", "123456.79", "9999999999999999.99"])
    lin.require_traceable(edges, rules)
    drift = lin.proportion_drift(edges, rules)
    if sum(map(Decimal, proportions.values())) < 1:
        with pytest.raises(lin.LineageError, match="drift"):
            lin.require_traceable(edges)
    # a cent above the bound, on one path of the line of a million, and as much less on the other path
    limit = drift.where("gl_line_id = 'G0'").select(lin.drift_bound(rules)).first()[0]
    path = drift.where("gl_line_id = 'G0' and app_id = 'A0' and bu_id = 'B'").first()
    wrong = (path.raw_product_eur + limit).quantize(Decimal("0.01")) + Decimal("0.01")
    more = F.when(F.col("bu_id") == "B", F.when(F.col("app_id") == "A0", F.lit(wrong - path.allocated_amount_eur)).otherwise(F.lit(path.allocated_amount_eur - wrong)))
    changed = F.when(F.col("gl_line_id") == "G0", F.coalesce(more, F.lit(0))).otherwise(F.lit(0))
    moved = edges.withColumns({name: (F.col(name) + changed).cast("decimal(18,2)") for name in ("allocated_amount_eur", "terminal_amount_eur")})
    with pytest.raises(lin.LineageError, match="G0 drift"):
        lin.require_traceable(moved, rules)


def test_worked_example(spark, edges, rules):
    documents = {r.rule_version: json.loads(r.example_json) for r in lin.worked_example(edges, rules.rules(spark), "CC-LEGACY").collect()}
    example = documents[V1]["allocated_example"]
    assert example["gl_line_id"] == "GL-000009" and example["terminal_total_eur"] == "626.55"
    assert (example["gl_to_tower_basis"], example["tower_to_app_driver"], example["app_to_bu_driver"]) == (
        "cost_center_mapping",
        "cpu_hours",
        "transactions",
    )
    assert [p["rounded_terminal_amount_eur"] for p in example["paths"]] == ["62.66", "501.24", "62.65"]
    assert Decimal(example["paths"][1]["raw_product_eur"]) == Decimal("501.24544")
    assert Decimal(example["paths"][1]["difference_from_raw_eur"]) == Decimal("-0.00544")
    left_over = documents[V1]["residual_example"]
    assert left_over == {
        "gl_line_id": "GL-000025",
        "gl_account": "7000",
        "cost_center_id": "CC-LEGACY",
        "gl_amount_eur": "1449.37",
        "outcome": "residual",
        "reason_code": "unmapped",
        "failed_step": "gl_to_tower",
        "tower_id": None,
        "app_id": None,
        "bu_id": None,
        "terminal_amount_eur": "1449.37",
    }
