"""Field contracts: every rule, good and bad."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from spendfall.operators.contracts import typed, violation_rows, with_violations

GOOD = ("GL-1", "2026-01", "7000", "CC-1", "12.50", "text")
COLUMNS = ["gl_line_id", "period", "gl_account", "cost_center_id", "amount_eur", "description"]


def _codes(spark, **changes):
    row = [changes.get(name, value) for name, value in zip(COLUMNS, GOOD)]
    frame = spark.createDataFrame([row], ", ".join(f"{name} string" for name in COLUMNS))
    return with_violations(frame, "gl_costs").first().violations


@pytest.mark.parametrize(
    "changes, codes",
    [
        ({}, []),
        ({"amount_eur": " 12.500 "}, []),
        ({"amount_eur": "1e3"}, []),
        ({"amount_eur": "9999999999999999.99"}, []),
        ({"gl_line_id": None}, ["gl_line_id:required"]),
        ({"gl_line_id": " \t "}, ["gl_line_id:required"]),
        ({"period": "2026-1"}, ["period:pattern"]),
        ({"period": " 2026-01"}, ["period:pattern"]),
        ({"gl_account": "70000"}, ["gl_account:pattern"]),
        ({"amount_eur": "oops"}, ["amount_eur:not_a_number"]),
        ({"amount_eur": None}, ["amount_eur:not_a_number"]),
        ({"amount_eur": "NaN"}, ["amount_eur:not_a_number"]),
        ({"amount_eur": "1.005"}, ["amount_eur:not_whole_cents"]),
        ({"amount_eur": "1e-3"}, ["amount_eur:not_whole_cents"]),
        ({"amount_eur": "0.0000000000000000000001"}, ["amount_eur:not_whole_cents", "amount_eur:out_of_range"]),
        ({"amount_eur": "1e-30"}, ["amount_eur:not_whole_cents", "amount_eur:out_of_range"]),
        ({"amount_eur": "10000000000000000.00"}, ["amount_eur:not_whole_cents"]),
        ({"amount_eur": "0.00"}, ["amount_eur:out_of_range"]),
        ({"amount_eur": "-3"}, ["amount_eur:out_of_range"]),
        ({"cost_center_id": None, "amount_eur": "oops"}, ["cost_center_id:required", "amount_eur:not_a_number"]),
    ],
)
def test_ledger_contract(spark, changes, codes):
    assert _codes(spark, **changes) == codes


def test_optional_and_enum_fields(spark):
    centers = spark.createDataFrame([("a", "n", None), ("b", "n", "  "), ("c", "n", "T")], "cost_center_id string, cost_center_name string, tower_id string")
    assert [row.violations for row in with_violations(centers, "cost_centers").collect()] == [[], ["tower_id:blank"], []]
    apps = spark.createDataFrame([("a", "n", "med"), ("b", "n", "Medium"), ("c", "n", None)], "app_id string, app_name string, business_criticality string")
    found = [row.violations for row in with_violations(apps, "applications").collect()]
    assert found == [[], ["business_criticality:not_allowed"], ["business_criticality:not_allowed"]]


def test_usage_value_may_be_zero_but_not_negative(spark):
    schema = "metric_id string, period string, step string, from_id string, to_id string, metric_name string, value string"
    rows = [("m", "2026-01", "app_to_bu", "a", "b", "x", v) for v in ("0", "-0.01")]
    rows.append(("m", "2026-01", "gl_to_tower", "a", "b", "x", "1"))
    found = [row.violations for row in with_violations(spark.createDataFrame(rows, schema), "usage_metrics").collect()]
    assert found == [[], ["value:out_of_range"], ["step:not_allowed"]]


def test_bad_rows_are_reported_with_their_content(spark):
    frame = spark.createDataFrame([GOOD, ("GL-2", "2026-01", "7000", None, "x", "t")], ", ".join(f"{c} string" for c in COLUMNS))
    row = violation_rows(frame, "gl_costs").collect()
    assert len(row) == 1 and '"GL-2"' in row[0].row_json and row[0].table_name == "gl_costs"


def test_typed_strips_and_converts(spark):
    frame = spark.createDataFrame([(" GL-1\t", "2026-01", "7000", "CC", " 5 ", "t")], ", ".join(f"{c} string" for c in COLUMNS))
    row = typed(frame, "gl_costs").first()
    assert row.gl_line_id == "GL-1" and str(row.amount_eur) == "5.00"
    assert typed(frame, "gl_costs").schema["amount_eur"].dataType.simpleString() == "decimal(18,2)"
    assert typed(frame, "gl_costs").select(F.col("description")).first()[0] == "t"
