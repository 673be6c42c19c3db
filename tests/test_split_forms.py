"""The forms of a split: few targets, arrays, and amounts split by a shuffle."""

from __future__ import annotations

from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from spendfall.operators import cascade as cas
from spendfall.schemas import STEPS


def _plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def splits(silver, rules):
    return cas.split_table(silver["fact_usage_metric"], silver["dim_resource_tower"], rules)


def _flows(spark, rules):
    # Amounts of all sizes, nothing, less than nothing and null; a hot amount, an unknown source and none.
    cents = "CASE id % 9 WHEN 0 THEN 1001L WHEN 1 THEN id WHEN 2 THEN 999999999999999999L - id WHEN 3 THEN 0L WHEN 4 THEN -id WHEN 5 THEN NULL ELSE 123457L * id END"
    sources = "element_at(array('TWR-COMPUTE', 'TWR-STORAGE', 'TWR-NETWORK', 'unknown', NULL), cast(id % 5 + 1 AS int))"
    return spark.range(900).selectExpr(
        "cast(id as string) AS gl_line_id", f"'{rules.versions[0]}' AS rule_version", f"{sources} AS from_id", f"{cents} AS cents"
    )


def test_few_targets_and_arrays_give_the_same_parts(spark, rules, splits):
    known = [row.from_id for row in splits.outcomes.where("step = 'tower_to_app'").select("from_id").distinct().collect()]
    sources = ", ".join(f"'{name}'" for name in [*known, "unknown"])
    flows = _flows(spark, rules).withColumn("from_id", F.expr(f"element_at(array({sources}, NULL), cast(gl_line_id AS int) % {len(known) + 2} + 1)"))
    few = cas.distribute(flows, splits, "tower_to_app", ["gl_line_id"])
    arrays = cas.distribute(flows, replace(splits, widest={}), "tower_to_app", ["gl_line_id"])
    assert "transform(unit_list" not in _plan(few) and splits.widest["tower_to_app"] <= cas.FEW_TARGETS
    assert few.exceptAll(arrays).isEmpty() and arrays.exceptAll(few).isEmpty() and few.count() > 900


def test_parts_are_not_shuffled_after_the_amounts_are_split(spark, rules, splits):
    flows = _flows(spark, rules)
    wide = cas.distribute(flows, replace(splits, wide_steps=frozenset(STEPS)), "tower_to_app", ["gl_line_id"])
    lines = [(len(line) - len(line.lstrip(" :+-")), line.lstrip(" :+-")) for line in _plan(wide).splitlines()]
    at = next(i for i, (_, line) in enumerate(lines) if line.startswith("Window"))
    depth, above = lines[at][0], []
    for indent, line in reversed(lines[:at]):
        if indent < depth:
            depth = indent
            above.append(line.split()[0])
    assert "SortMergeJoin" in above
    assert not {"Exchange", "Sort"} & set(above[: above.index("SortMergeJoin")])
    known = F.col("cents").isNotNull() & F.col("from_id").isNotNull()
    flows = flows.where(known & (F.col("cents") >= 0))
    wide, narrow = (cas.distribute(flows, form, "tower_to_app", ["gl_line_id"]) for form in (replace(splits, wide_steps=frozenset(STEPS)), splits))
    assert wide.exceptAll(narrow).isEmpty() and narrow.exceptAll(wide).isEmpty()


def test_sums_by_strategy_are_taken_in_cents(silver, rules, splits):
    ends = cas.run_cascade(silver["fact_gl_cost"], splits, rules)
    in_cents = cas.run_cascade(silver["fact_gl_cost"], splits, rules, in_cents=True)
    assert "amount_eur" not in in_cents.columns and in_cents.agg(F.sum("cents")).first()[0] == ends.agg((F.sum("amount_eur") * Decimal(100)).cast("bigint")).first()[0]


@pytest.mark.parametrize("flows_per_task", [100_000, 10])
def test_widened_rows_are_not_shuffled_by_merge_joins(spark, rules, splits, monkeypatch, flows_per_task):
    monkeypatch.setattr(cas, "FLOWS_PER_TASK", flows_per_task)
    flows = _flows(spark, rules)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wide = cas.distribute(flows, replace(splits, wide_steps=frozenset(STEPS)), "tower_to_app", ["gl_line_id"])
        names = [line.lstrip(" :+-").split()[0] for line in _plan(wide).splitlines() if line.strip(" :+-")]
        below = names[names.index("Window") :]
        assert "Exchange" not in below[: below.index("SortMergeJoin")]
        found = wide.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    narrow = {(row.gl_line_id, row.to_id): row for row in cas.distribute(flows, splits, "tower_to_app", ["gl_line_id"]).collect()}
    split = [row for row in found if row.to_id is not None]
    assert split and all(narrow[row.gl_line_id, row.to_id].part == row.part and narrow[row.gl_line_id, row.to_id].share == row.share for row in split)
    assert sorted({int(row.gl_line_id) for row in found}) == list(range(900))


@pytest.mark.parametrize("shared", [["v1", "v2"], ["v1", "v2", "w"]])
def test_versions_part_with_the_amounts(spark, shared):
    """A flow of versions that have been one up to here is dealt out once, and split by the rules of each."""
    targets = [("v1", "A", 600000000000, Decimal("0.6"), 0, 0, None), ("v1", "B", 400000000000, Decimal("0.4"), 1, 0, None), ("v2", "B", 10**12, Decimal(1), 0, 0, None), ("w", None, None, None, None, None, "driver_zero")]
    outcomes = spark.createDataFrame(
        [("app_to_bu", "S", *row) for row in targets],
        "step string, from_id string, rule_version string, to_id string, units long, share decimal(18,12), place int, missing long, reason_code string",
    )
    finer = {"v1": ["v1", "v2"], **({"w": ["w"]} if "w" in shared else {})}
    flows = spark.createDataFrame(
        [(f"L{k}", version, source, cents) for version in finer for k, (source, cents) in enumerate([("S", 7), ("S", 7), ("S", 100), ("unknown", 5), (None, 3), ("S", 0)])],
        "gl_line_id string, rule_version string, from_id string, cents long",
    )
    narrow = cas.Splits(outcomes, frozenset())
    forms = (narrow, replace(narrow, wide_steps=frozenset(STEPS)))
    one, other = (cas.distribute(flows, form, "app_to_bu", ["gl_line_id", "rule_version"], finer).select("rule_version", "gl_line_id", "cents", "found_reason", "to_id", "share", "part") for form in forms)
    assert one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()
    parts = {(row.rule_version, row.to_id): row.part for row in other.where("gl_line_id = 'L2'").collect()}
    assert parts == {("v1", "A"): 60, ("v1", "B"): 40, ("v2", "B"): 100, **({("w", None): 100} if "w" in shared else {})}
    exchanged = [line for line in _plan(other).splitlines() if "Exchange hashpartitioning(rule_version" in line and "slice" in line]
    assert exchanged and not any("finer_version" in line for line in exchanged)
