"""Split strategies on the published small cases."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from spendfall.operators.cascade import Splits, distribute, measured
from spendfall.operators.strategies import normalize_shares, split_large_outcomes, split_outcomes, strategy_shares, usage_candidates
from spendfall.operators.usage import usage_index
from spendfall.session import materialize
from spendfall.sources.rule_files import rule_set


def _rules(rule: dict):
    return rule_set(
        [
            {
                "version_id": "v",
                "description": "d",
                "created": "2026-01-01",
                "gl_to_tower": {"basis": "cost_center_mapping"},
                "tower_to_app": rule,
                "app_to_bu": {"strategy": "even_spread"},
            }
        ]
    )


def _usage(spark, signals: dict[str, str], metric: str = "m"):
    rows = [("tower_to_app", "T", target, metric, Decimal(value)) for target, value in signals.items()]
    return usage_index(
        spark.createDataFrame(rows, "step string, from_id string, to_id string, metric_name string, value decimal(18,2)")
    )


def _shares(spark, rule: dict, signals: dict[str, str]) -> dict:
    found = strategy_shares(usage_candidates(_usage(spark, signals), _rules(rule)), rule["strategy"]).collect()
    return {row.to_id: row.share if row.reason_code is None else row.reason_code for row in found}


def test_even_spread_gives_the_spare_unit_to_the_first_id(spark):
    assert _shares(spark, {"strategy": "even_spread"}, {"B": "1", "A": "0", "C": "2"}) == {
        "A": Decimal("0.333333333334"),
        "B": Decimal("0.333333333333"),
        "C": Decimal("0.333333333333"),
    }


def test_weights_keep_a_zero_target(spark):
    rule = {"strategy": "weighted", "weights": {"A": "5", "B": "3", "C": "0"}}
    assert _shares(spark, rule, {"A": "1"}) == {"A": Decimal("0.625"), "B": Decimal("0.375"), "C": Decimal("0")}


def test_weights_add_to_usage_targets(spark):
    rule = {"strategy": "weighted", "weights": {"A": "1"}}
    assert _shares(spark, rule, {"Z": "9"}) == {"A": Decimal(1), "Z": Decimal(0)}


def test_weights_of_zero_are_driver_zero(spark):
    rule = {"strategy": "weighted", "weights": {"A": "0", "B": "0"}}
    assert set(_shares(spark, rule, {"A": "1"}).values()) == {"driver_zero"}


def test_consumption_follows_the_signal(spark):
    rule = {"strategy": "consumption", "metric_name": "m"}
    assert _shares(spark, rule, {"A": "10", "B": "30", "C": "60"}) == {
        "A": Decimal("0.1"),
        "B": Decimal("0.3"),
        "C": Decimal("0.6"),
    }


def test_consumption_without_signal_is_driver_zero(spark):
    rule = {"strategy": "consumption", "metric_name": "m"}
    assert set(_shares(spark, rule, {"A": "0", "B": "0"}).values()) == {"driver_zero"}
    other = {"strategy": "consumption", "metric_name": "unseen"}
    assert set(_shares(spark, other, {"A": "5", "B": "1"}).values()) == {"driver_zero"}


def test_declared_proportions_are_kept(spark):
    rule = {"strategy": "manual_override", "proportions": {"X": ".15", "Y": ".35", "Z": ".50"}}
    assert _shares(spark, rule, {"A": "1"}) == {"X": Decimal("0.15"), "Y": Decimal("0.35"), "Z": Decimal("0.50")}


def test_equal_remainders_are_ordered_exactly(spark):
    rule = {"strategy": "consumption", "metric_name": "m"}
    found = _shares(spark, rule, {"A": "10", "B": "1", "C": "19"})
    assert sum(found.values()) == 1
    # 1/3, 1/30 and 19/30 leave equal remainders: the spare unit goes to the largest.
    assert found["C"] == Decimal("0.633333333334")


def test_source_without_usage_has_no_candidates(spark):
    empty = _usage(spark, {"A": "1"}).where("from_id = 'nowhere'")
    assert usage_candidates(empty, _rules({"strategy": "even_spread"})).count() == 0


@pytest.mark.parametrize("as_arrays", [True, False])
def test_five_cents_over_three(spark, as_arrays):
    outcomes = split_outcomes(usage_candidates(_usage(spark, {"A": "1", "B": "1", "C": "1"}), _rules({"strategy": "even_spread"})))
    splits = measured(materialize(outcomes), array_targets=4096 if as_arrays else 1)
    assert bool(splits.wide_steps) is not as_arrays
    flows = spark.createDataFrame([("L", "v", "T", 5)], "gl_line_id string, rule_version string, from_id string, cents long")
    parts = {row.to_id: row.part for row in distribute(flows, splits, "tower_to_app", ["gl_line_id"]).collect()}
    assert parts == {"A": 2, "B": 2, "C": 1}


def test_shares_add_up_to_one_for_many_targets(spark):
    signals = {f"T{i:04d}": str(i * i % 97) for i in range(1000)}
    rule = {"strategy": "consumption", "metric_name": "m"}
    units = normalize_shares(usage_candidates(_usage(spark, signals), _rules(rule))).agg({"units": "sum"}).first()[0]
    assert units == 10**12


def test_one_wide_source_leaves_other_steps_as_they_are(spark):
    rows = [("v", "tower_to_app", "T", f"A{k}", 1, Decimal("0.1"), k, 0, None) for k in range(10)] + [("v", "app_to_bu", "A", "B", 1, Decimal("0.1"), 0, 0, None)]
    outcomes = spark.createDataFrame(
        rows, "rule_version string, step string, from_id string, to_id string, units long, share decimal(18,12), place int, missing long, reason_code string"
    )
    assert measured(outcomes, array_targets=5).wide_steps == {"tower_to_app"}


def test_places_beyond_the_packed_key(spark):
    """The shuffled form orders by remainder and place, however many targets there are."""
    half = 500_000_000_001
    outcomes = spark.createDataFrame(
        [("v", "app_to_bu", "A", "LOW", 10**12 - half, Decimal("0.5"), 0, 0, None), ("v", "app_to_bu", "A", "HIGH", half, Decimal("0.5"), 5_000_000, 0, None)],
        "rule_version string, step string, from_id string, to_id string, units long, share decimal(18,12), place int, missing long, reason_code string",
    )
    flows = spark.createDataFrame([("G", "v", "A", 1)], "gl_line_id string, rule_version string, from_id string, cents long")
    parts = distribute(flows, Splits(outcomes, frozenset(["app_to_bu"])), "app_to_bu", ["gl_line_id", "rule_version"]).collect()
    assert {r.to_id: r.part for r in parts} == {"HIGH": 1, "LOW": 0}


CANDIDATES = "rule_version string, step string, from_id string, strategy string, to_id string, raw decimal(26,0)"


def test_large_sources_by_ranges_are_as_by_windows(spark):
    """Ties by the thousand, one weight for all, dead and declared sources, and one that is alone."""
    draw = random.Random(3)
    rows = [("v", "s", "mixed", "weighted", f"T{k}", Decimal(draw.choice([0, 1, 2, 3, 10**9, draw.randrange(10**20)]))) for k in range(3000)]
    rows += [("v", "s", "even", "even_spread", f"T{k:05d}", Decimal(1)) for k in range(2999)]
    rows += [("w", "s", "few", "consumption", f"T{k}", Decimal(k % 7)) for k in range(900)]
    rows += [("w", "s", "dead", "consumption", f"T{k}", Decimal(0)) for k in range(200)]
    rows += [("w", "s", "declared", "manual_override", f"T{k}", Decimal(10**12 // 700 + (k == 3))) for k in range(700)]
    rows += [("w", "s", "alone", "even_spread", "T", Decimal(1))]
    candidates = materialize(spark.createDataFrame(rows, CANDIDATES).repartition(5))
    by_windows = sorted(map(tuple, split_outcomes(candidates).collect()), key=str)
    for most in (0, 500, 10_000):
        assert sorted(map(tuple, split_large_outcomes(candidates, most).collect()), key=str) == by_windows


def test_a_source_of_very_many_targets_uses_many_tasks(spark):
    candidates = materialize(spark.range(300_000).selectExpr("'v' AS rule_version", "'s' AS step", "'T' AS from_id", "'weighted' AS strategy", "concat('A', id) AS to_id", "cast(id % 1000 AS decimal(26,0)) AS raw"))
    by_ranges = materialize(split_large_outcomes(candidates, 1000))
    assert by_ranges.agg(F.sum("units")).first()[0] == 10**12
    assert by_ranges.agg(F.count("place"), F.countDistinct("place"), F.max("place")).first()[0:2] == (299_700, 299_700)
    assert split_outcomes(candidates).exceptAll(by_ranges).isEmpty()
