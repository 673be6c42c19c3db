"""The cascade on the ledger fixture, and against a row-by-row model on random data."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import brute
from spendfall.operators import reports
from spendfall.operators.cascade import allocation, cascade, distribute, residual, run_cascade, split_amounts, split_table
from spendfall.schemas import STEPS
from spendfall.sources.rule_files import rule_set

V1, V2 = "v1_transactions", "v2_named_users"


_RULES_EVEN = {
    "version_id": "even", "description": "all to all", "created": "2026-01-01",
    "gl_to_tower": {"basis": "cost_center_mapping", "on_unmapped": {"strategy": "even_spread"}},
    "tower_to_app": {"strategy": "even_spread"}, "app_to_bu": {"strategy": "even_spread"},
}


@pytest.fixture(scope="module")
def ends(silver, rules):
    return cascade(silver["fact_gl_cost"], silver["fact_usage_metric"], silver["dim_resource_tower"], rules).cache()


def _sum(frame, column):
    return frame.agg(F.sum(column)).first()[0]


@pytest.mark.parametrize(
    "version, allocated, left_over, rows", [(V1, "3568.14", "58245.81", 24), (V2, "11150.42", "50663.53", 96)]
)
def test_published_totals(ends, version, allocated, left_over, rows):
    chosen = ends.where(F.col("rule_version") == version)
    assert _sum(allocation(chosen), "allocated_amount_eur") == Decimal(allocated)
    assert _sum(residual(chosen), "amount_eur") == Decimal(left_over)
    assert allocation(chosen).count() == rows


def test_published_residual_by_reason(ends):
    found = {
        (row.failed_step, row.reason_code): (row.row_count, row.amount_eur)
        for row in reports.residual_by_reason(residual(ends)).where(F.col("rule_version") == V1).collect()
    }
    assert found == {
        ("gl_to_tower", "unmapped"): (8, Decimal("8303.00")),
        ("tower_to_app", "driver_zero"): (32, Decimal("42360.53")),
        ("app_to_bu", "driver_zero"): (24, Decimal("7582.28")),
    }


def test_published_amounts_by_business_unit(ends):
    sums = allocation(ends).groupBy("rule_version", "bu_id").agg(F.sum("allocated_amount_eur").alias("s")).collect()
    found = {(row.rule_version, row.bu_id): str(row.s) for row in sums}
    assert found == {
        (V1, "BU-CORP"): "356.82",
        (V1, "BU-RETAIL"): "2854.52",
        (V1, "BU-WHOLESALE"): "356.80",
        (V2, "BU-CORP"): "4852.04",
        (V2, "BU-RETAIL"): "3351.49",
        (V2, "BU-WHOLESALE"): "2946.89",
    }


def test_published_split_of_one_line(ends):
    rows = ends.where((F.col("gl_line_id") == "GL-000009") & (F.col("rule_version") == V1) & (F.col("app_id") == "APP-BILLING"))
    assert {row.bu_id: str(row.amount_eur) for row in rows.collect()} == {
        "BU-CORP": "62.66",
        "BU-RETAIL": "501.24",
        "BU-WHOLESALE": "62.65",
    }


def _version(name, tower_to_app, app_to_bu, on_unmapped=None):
    first = {"basis": "cost_center_mapping", **({"on_unmapped": on_unmapped} if on_unmapped else {})}
    return {
        "version_id": name,
        "description": name,
        "created": "2026-01-01",
        "gl_to_tower": first,
        "tower_to_app": tower_to_app,
        "app_to_bu": app_to_bu,
    }


def _use(metric):
    return {"strategy": "consumption", "metric_name": metric}


def test_source_without_usage_rows_is_unattributable(silver):
    rules = rule_set([_version("email", _use("named_users"), _use("named_users")), _version("storage", _use("cpu_hours"), _use("storage_gb"))])
    ends = cascade(silver["fact_gl_cost"], silver["fact_usage_metric"], silver["dim_resource_tower"], rules)
    found = {
        (row.rule_version, row.app_id, row.reason_code)
        for row in residual(ends).where("failed_step = 'app_to_bu'").select("rule_version", "app_id", "reason_code").distinct().collect()
    }
    assert ("email", "APP-EMAIL", "shared_unattributable") in found
    assert ("storage", "APP-ANALYTICS", "driver_zero") in found


def test_fallback_splits_unmapped_lines(silver):
    even = {"strategy": "even_spread"}
    zero = {"strategy": "weighted", "weights": {"TWR-NOWHERE": "1"}}
    rules = rule_set([_version("even", even, even, even), _version("zero", even, even, zero), _version("none", even, even)])
    gl = silver["fact_gl_cost"].where("tower_id IS NULL")
    ends = cascade(gl, silver["fact_usage_metric"], silver["dim_resource_tower"], rules).cache()
    towers = ends.where("rule_version = 'even'").select("gl_line_id", "tower_id").distinct().groupBy("gl_line_id").count()
    assert {row["count"] for row in towers.collect()} == {4}
    reasons = {
        row.rule_version: row.reason_code
        for row in residual(ends).where("failed_step = 'gl_to_tower'").select("rule_version", "reason_code").distinct().collect()
    }
    assert reasons == {"zero": "driver_zero", "none": "unmapped"}
    total = _sum(gl, "amount_eur")
    assert {row["t"] for row in ends.groupBy("rule_version").agg(F.sum("amount_eur").alias("t")).collect()} == {total}


def test_fallback_without_towers_is_unattributable(silver):
    even = {"strategy": "even_spread"}
    rules = rule_set([_version("even", even, even, even)])
    gl = silver["fact_gl_cost"].where("tower_id IS NULL")
    ends = cascade(gl, silver["fact_usage_metric"], silver["dim_resource_tower"].where("false"), rules)
    assert {(row.failed_step, row.reason_code) for row in ends.collect()} == {("gl_to_tower", "shared_unattributable")}


def test_result_does_not_depend_on_partitioning(spark, silver, rules, ends):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        gl = silver["fact_gl_cost"].repartition(7, "amount_eur")
        again = cascade(gl, silver["fact_usage_metric"], silver["dim_resource_tower"], rules)
        assert Counter(again.select(*ends.columns).collect()) == Counter(ends.collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_proportions_are_staged(ends):
    row = ends.where("gl_line_id = 'GL-000009' AND app_id = 'APP-BILLING' AND bu_id = 'BU-RETAIL'").where(
        F.col("rule_version") == V1
    ).first()
    assert (row.gl_to_tower_proportion, row.tower_to_app_proportion, row.app_to_bu_proportion) == (
        Decimal(1),
        Decimal("0.32"),
        Decimal("0.8"),
    )


def _random_case(seed: int):
    generator = random.Random(seed)
    towers = [f"T{i}" for i in range(5)]
    apps = [f"A{i}" for i in range(8)]
    units = [f"B{i}" for i in range(6)]
    lines = [
        (f"L{i:03d}", generator.choice([1, 7, generator.randint(1, 10**6), generator.randint(1, 10**15)]), generator.choice([*towers, None]))
        for i in range(60)
    ]
    usage = []
    for source in towers[:4]:
        for metric in ("m1", "m2"):
            if source == "T1" and metric == "m1":
                continue
            usage += [("tower_to_app", source, t, metric, generator.choice([0, 100, generator.randint(1, 10**9)])) for t in generator.sample(apps, 5)]
    for source in apps[:6]:
        for metric in ("m1", "m2"):
            value = 0 if source == "A2" and metric == "m1" else generator.randint(1, 10**7)
            usage += [("app_to_bu", source, t, metric, value and generator.randint(0, 10**7)) for t in generator.sample(units, 4)]
    # Repeated rows add up.
    return lines, usage + usage[:7], towers


RANDOM_RULES = {
    "use": (None, _use("m1"), _use("m1")),
    "mixed": ({"strategy": "even_spread"}, {"strategy": "weighted", "weights": {"A0": "3", "A9": "1.5", "A3": "0"}}, _use("m2")),
    "declared": (
        {"strategy": "weighted", "weights": {"T0": "1", "T2": "2", "T9": "5"}},
        {"strategy": "even_spread"},
        {"strategy": "manual_override", "proportions": {"B0": "0.3333333", "B1": "0.3333333", "B8": "0.3333333", "B9": "0"}},
    ),
    "fixed": (
        {"strategy": "manual_override", "proportions": {"T0": "0.1", "T4": "0.9"}},
        {"strategy": "manual_override", "proportions": {"A1": "0.999999", "A7": "0"}},
        {"strategy": "weighted", "weights": {"B0": "0"}},
    ),
}


def _as_model(rule):
    if rule is None:
        return None
    scaled = {k: {t: int(Decimal(v) * 10**12) for t, v in rule[k].items()} for k in ("weights", "proportions") if k in rule}
    return {**rule, **scaled}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_cases_match_the_row_by_row_model(spark, seed):
    lines, usage, towers = _random_case(seed)
    cents = lambda value: Decimal(value).scaleb(-2)
    gl = spark.createDataFrame(
        [(i, "2026-01", "7000", "C", cents(c), t) for i, c, t in lines],
        "gl_line_id string, period string, gl_account string, cost_center_id string, amount_eur decimal(18,2), tower_id string",
    )
    signals = spark.createDataFrame(
        [(s, f, t, m, cents(v)) for s, f, t, m, v in usage],
        "step string, from_id string, to_id string, metric_name string, value decimal(18,2)",
    )
    tower_frame = spark.createDataFrame([(t,) for t in towers], "tower_id string")
    rules = rule_set([_version(name, b, c, a) for name, (a, b, c) in RANDOM_RULES.items()])
    splits = split_table(signals, tower_frame, rules)
    expected = defaultdict(Counter)
    for name, (a, b, c) in RANDOM_RULES.items():
        rule = {"gl_to_tower": _as_model(a), "tower_to_app": _as_model(b), "app_to_bu": _as_model(c)}
        expected[name] = Counter(brute.cascade(lines, usage, towers, rule))
    for form in (splits, replace(splits, wide_steps=frozenset(STEPS))):
        found = defaultdict(Counter)
        for row in run_cascade(gl, form, rules).collect():
            found[row.rule_version][
                (row.gl_line_id, row.tower_id, row.app_id, row.bu_id, int(row.amount_eur * 100), row.failed_step, row.reason_code)
            ] += 1
        for name in RANDOM_RULES:
            assert found[name] == expected[name], name


def test_every_accepted_rule_gives_out_what_there_is(spark):
    """Random proportions that miss one or exceed it by the tolerance at most, for large and small amounts, in both forms."""
    draw = random.Random(11)
    versions = []
    for k in range(12):
        targets = draw.randint(1, 6)
        units = [draw.randrange(10**12) for _ in range(targets)]
        units = [u * 10**12 // sum(units) for u in units]
        units[0] += 10**12 - sum(units) + (draw.randint(-(10**6), 10**6) if k else 10**6)
        shares = {f"B{n}": str(Decimal(u).scaleb(-12)) for n, u in enumerate(units) if u >= 0}
        if abs(sum(map(Decimal, shares.values())) - 1) > Decimal("0.000001"):
            continue
        versions.append({"version_id": f"v{k}", "description": "d", "created": "2026-01-01", "gl_to_tower": {"basis": "cost_center_mapping"}, "tower_to_app": {"strategy": "even_spread"}, "app_to_bu": {"strategy": "manual_override", "proportions": shares}})
    versions[0]["app_to_bu"]["proportions"] = {"B": "0.5", "C": "0.500001"}
    rules = rule_set(versions)
    ledger = spark.createDataFrame([(f"G{k}", "2026-01", "7000", "C", Decimal(amount), "T") for k, amount in enumerate(["1000000.00", "0.01", "9999999999999999.99", "123456.78"])], "gl_line_id string, period string, gl_account string, cost_center_id string, amount_eur decimal(18,2), tower_id string")
    usage = spark.createDataFrame([(f"M{k}", "2026-01", step, a, b, "m", Decimal(1)) for k, (step, a, b) in enumerate([("tower_to_app", "T", "A"), ("app_to_bu", "A", "B")])], "metric_id string, period string, step string, from_id string, to_id string, metric_name string, value decimal(18,2)")
    towers = spark.createDataFrame([("T", "t", "c")], "tower_id string, tower_name string, category string")
    whole = {r.gl_line_id: r.amount_eur for r in ledger.collect()}
    for form in ({}, {"array_targets": 0}):
        ends = run_cascade(ledger, split_table(usage, towers, rules, **form), rules)
        sums = allocation(ends).groupBy("rule_version", "gl_line_id").agg(F.sum("allocated_amount_eur").alias("s"), F.min("allocated_amount_eur").alias("least")).collect()
        found = {(r.rule_version, r.gl_line_id): r.s for r in sums}
        assert found == {(v["version_id"], line): amount for v in versions for line, amount in whole.items()}
        assert min(r.least for r in sums) >= 0


def test_equal_amounts_are_split_once(spark, silver):
    rules = rule_set([_RULES_EVEN])
    splits = split_table(silver["fact_usage_metric"], silver["dim_resource_tower"], rules, array_targets=0)
    n_towers = silver["dim_resource_tower"].count()
    # a third of all flows is one amount; two amounts of a source that is not known
    flows = spark.range(300).selectExpr(
        "cast(id as string) AS gl_line_id", "'even' AS rule_version",
        "CASE WHEN id % 50 = 7 THEN 'unknown' WHEN id % 50 <> 8 THEN '*' END AS from_id",
        "CASE WHEN id % 3 = 0 THEN 1001L ELSE id % 5 END AS cents",
    )
    outcomes = splits.outcomes.where("step = 'gl_to_tower'")
    distinct = flows.where("from_id = '*'").select("cents").distinct().count()
    memo = split_amounts(flows, outcomes)
    assert memo.count() == distinct * n_towers == 6 * n_towers
    narrow = split_table(silver["fact_usage_metric"], silver["dim_resource_tower"], rules)
    assert splits.wide_steps and not narrow.wide_steps
    wide, array = (distribute(flows, s, "gl_to_tower", ["gl_line_id"]).select("gl_line_id", "to_id", "share", "part") for s in (splits, narrow))
    assert wide.exceptAll(array).count() == array.exceptAll(wide).count() == 0
    whole = wide.groupBy("gl_line_id").agg(F.sum("part").alias("cents")).join(flows, ["gl_line_id", "cents"])
    assert whole.count() == 300
