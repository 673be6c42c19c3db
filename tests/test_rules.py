"""Rule files and governance checks."""

from __future__ import annotations

from decimal import Decimal

import pytest

from conftest import FIXTURES
from spendfall.operators.rule_checks import RuleViolation, require_governed, rule_coverage, rule_diff, rule_violations
from spendfall.operators.usage import usage_index
from spendfall.sources.rule_files import RuleError, load_rules, raw_rule_set, rule_set

V1, V2 = "v1_transactions", "v2_named_users"


def _version(**changes) -> dict:
    version = {
        "version_id": "v",
        "description": "d",
        "created": "2026-01-01",
        "gl_to_tower": {"basis": "cost_center_mapping"},
        "tower_to_app": {"strategy": "consumption", "metric_name": "cpu_hours"},
        "app_to_bu": {"strategy": "consumption", "metric_name": "transactions"},
    }
    return {k: v for k, v in {**version, **changes}.items() if v is not None}


def _codes(spark, silver, version: dict) -> list[str]:
    rules = raw_rule_set([version])
    found = rule_violations(rules.rules(spark), rules.params(spark), silver["fact_usage_metric"])
    return sorted(row.violation for row in found.collect())


def test_shipped_fixture_versions_are_sound(spark, silver, rules):
    assert rules.versions == [V1, V2]
    require_governed(rule_violations(rules.rules(spark), rules.params(spark), silver["fact_usage_metric"]))


def test_versions_differ_at_one_step(spark, rules):
    rows = rule_diff(rules.rules(spark), rules.params(spark), V1, V2).collect()
    assert [row.step for row in rows] == ["app_to_bu"]
    assert "transactions" in rows[0][V1] and "named_users" in rows[0][V2]


def test_unknown_version_lists_the_known_ones(rules):
    with pytest.raises(RuleError, match=f"Known versions: {V1}, {V2}"):
        rules.only("v9")


@pytest.mark.parametrize(
    "changes, message",
    [
        ({"app_to_bu": None}, "missing"),
        ({"owner": "me"}, "unknown"),
        ({"gl_to_tower": {"strategy": "weighted", "weights": {"T": 1}}}, "follows the cost centre"),
        ({"tower_to_app": {"strategy": "consumption"}}, "needs metric_name"),
        ({"tower_to_app": {"strategy": "even_spread", "metric_name": "cpu_hours"}}, "unknown fields"),
        ({"tower_to_app": {"strategy": "weighted", "weights": {"A": 1}, "extra": 1}}, "unknown fields"),
    ],
)
def test_malformed_files_are_refused(changes, message):
    with pytest.raises(RuleError, match=message):
        rule_set([_version(**changes)])


@pytest.mark.parametrize(
    "changes, codes",
    [
        ({"tower_to_app": {"strategy": "by_mood"}}, ["strategy_unknown"]),
        ({"tower_to_app": {"strategy": "consumption", "metric_name": "transactions"}}, ["metric_unknown_for_step"]),
        ({"app_to_bu": {"strategy": "manual_override", "proportions": {"A": "0.4", "B": "0.4"}}}, ["proportions_do_not_sum_to_one"]),
        ({"app_to_bu": {"strategy": "manual_override", "proportions": {"A": "0.5", "B": "0.4999999"}}}, []),
        ({"app_to_bu": {"strategy": "weighted", "weights": {"A": "-1"}}}, ["values_negative"]),
        ({"app_to_bu": {"strategy": "weighted", "weights": {}}}, ["values_empty"]),
        (
            {"gl_to_tower": {"basis": "cost_center_mapping", "on_unmapped": {"strategy": "consumption", "metric_name": "cpu_hours"}}},
            ["fallback_cannot_be_consumption"],
        ),
        ({"gl_to_tower": {"basis": "guess"}}, ["basis_unknown"]),
        ({"created": "July"}, ["created_not_a_date"]),
        ({"description": " "}, ["description_blank"]),
    ],
)
def test_governance_checks(spark, silver, changes, codes):
    assert _codes(spark, silver, _version(**changes)) == codes


def test_broken_rules_raise(spark, silver):
    rules = raw_rule_set([_version(app_to_bu={"strategy": "weighted", "weights": {"A": "-1"}})])
    with pytest.raises(RuleViolation, match="values_negative"):
        require_governed(rule_violations(rules.rules(spark), rules.params(spark), silver["fact_usage_metric"]))


@pytest.mark.parametrize(
    "body, code",
    [
        ({"strategy": "weighted", "weights": {"A": "-1", "B": 2}}, "values_negative"),
        ({"strategy": "weighted", "weights": {}}, "values_empty"),
        ({"strategy": "manual_override", "proportions": {"A": "0.4"}}, "proportions_do_not_sum_to_one"),
        ({"strategy": "by_mood"}, "strategy_unknown"),
    ],
)
def test_no_path_takes_broken_rules(body, code):
    with pytest.raises(RuleViolation, match=code):
        rule_set([_version(app_to_bu=body)])


def test_values_that_cannot_be_exact_are_refused():
    fine = {"strategy": "manual_override", "proportions": {"A": "0.5000000000001", "B": "0.4999999999999"}}
    far = {"strategy": "weighted", "weights": {"A": "100000000000000000000", "B": "0.000000000000000001"}}
    for body, message in ((fine, "more than 12 decimals"), (far, "too many digits"), ({"strategy": "weighted", "weights": {"A": "x"}}, "not a number")):
        with pytest.raises(RuleError, match=message):
            rule_set([_version(app_to_bu=body)])


def test_weights_of_any_size_are_exact():
    rules = rule_set([_version(app_to_bu={"strategy": "weighted", "weights": {"A": 5000000, "B": "0.0000000000001"}})])
    assert [(row[2], int(row[4])) for row in rules.param_rows] == [("A", 5 * 10**19), ("B", 1)]


def test_rules_from_a_path_of_any_file_system(spark, tmp_path):
    uri = (FIXTURES / "rules").as_uri()
    assert load_rules(uri, spark) == load_rules(FIXTURES / "rules")
    with pytest.raises(RuleError, match="No such"):
        load_rules(f"{tmp_path.as_uri()}/none", spark)
    with pytest.raises(RuleError, match="No rule files"):
        load_rules(tmp_path.as_uri(), spark)
    (tmp_path / "a.yaml").write_bytes(b"\xff\xfe")
    with pytest.raises(RuleError, match="not valid YAML"):
        load_rules(tmp_path.as_uri(), spark)
    (tmp_path / "a.yaml").write_bytes(b"")
    with pytest.raises(RuleError, match="No rule files"):
        load_rules(tmp_path.as_uri(), spark)


def test_folder_errors(tmp_path):
    with pytest.raises(RuleError, match="No such"):
        load_rules(tmp_path / "none")
    with pytest.raises(RuleError, match="No rule files"):
        load_rules(tmp_path)
    text = (FIXTURES / "rules" / "v1_transactions.yaml").read_text()
    (tmp_path / "a.yaml").write_text(text)
    (tmp_path / "b.yml").write_text(text)
    with pytest.raises(RuleError, match="share the version_id"):
        load_rules(tmp_path)
    (tmp_path / "b.yml").write_text("version_id: [")
    with pytest.raises(RuleError, match="not valid YAML"):
        load_rules(tmp_path)


def test_coverage_shows_what_a_metric_offers(spark, silver, rules):
    rows = rule_coverage(rules.rules(spark), usage_index(silver["fact_usage_metric"])).collect()
    found = {(row.version_id, row.step): (row.source_count, row.target_count, str(row.signal_total)) for row in rows}
    assert found[V1, "tower_to_app"] == (1, 4, "10000.00")
    assert found[V2, "app_to_bu"] == (5, 3, "470.00")
    assert found[V1, "gl_to_tower"] == (0, 0, "0.00")


@pytest.mark.parametrize(
    "value, raw",
    [("1.0000000000000000000000000000001", None), ("1e21", None), ("1e24", None), ("1e-19", None), ("99999999999999999999", 99999999999999999999), ("1.50", 15), ("12345678901234567890.12345", 1234567890123456789012345), ("1e3", 1000)],
)
def test_declared_digits_are_exact_or_refused(spark, value, raw):
    version = _version(tower_to_app={"strategy": "weighted", "weights": {"A": value}})
    if raw is None:
        with pytest.raises(RuleError, match="too many digits"):
            rule_set([version])
    else:
        row = rule_set([version]).params(spark).first()
        assert (int(row.raw), row.value) == (raw, Decimal(value))
