"""Rule versions: read from a folder of YAML files, handed on as two small DataFrames."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from decimal import Decimal, InvalidOperation
from pathlib import Path

import yaml
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from spendfall.schemas import (
    CONSUMPTION,
    GL_TO_TOWER,
    MANUAL_OVERRIDE,
    RULE_PARAMS_SCHEMA,
    RULES_SCHEMA,
    STEPS,
    STRATEGIES,
    WEIGHTED,
)

_PARAM_FIELDS = {"weighted": "weights", "manual_override": "proportions"}
_VERSION_FIELDS = {"version_id", "description", "created", *STEPS}


class RuleError(ValueError):
    """A rule file cannot be read, or a version is missing or given twice."""


class RuleViolation(ValueError):
    """A rule version breaks a governance check."""


# How far declared proportions may be from adding up to one, and their finest unit.
PROPORTION_TOLERANCE = Decimal("0.000001")
PROPORTION_DIGITS = 12
# Whole numbers that the weights of one step may add up to on their common scale.
LARGEST_TOTAL = Decimal(10) ** 25
#: Digits before the point that a declared value can have, as its column holds no more.
WHOLE_DIGITS = 20
BASIS = "cost_center_mapping"


@dataclass(frozen=True)
class RuleSet:
    """Rows of the ``rules`` and ``rule_params`` tables: a handful per rule file."""

    rule_rows: tuple[tuple, ...]
    param_rows: tuple[tuple, ...]

    @property
    def versions(self) -> list[str]:
        return sorted({row[0] for row in self.rule_rows})

    @property
    def has_params(self) -> bool:
        return bool(self.param_rows)

    @property
    def fallback_versions(self) -> list[str]:
        """Versions that split unmapped lines instead of leaving them as residual."""
        return sorted({row[0] for row in self.rule_rows if row[3] == GL_TO_TOWER and row[5] is not None})

    def shared(self, steps: Sequence[str]) -> dict[str, str]:
        """For each version, the first version with the same rules at all of ``steps``."""
        first: dict[tuple, str] = {}
        result = {}
        for version in self.versions:
            body = tuple(
                tuple(sorted((row[3:] for row in self.rule_rows if row[0] == version and row[3] == step), key=str))
                + tuple(sorted(row[1:] for row in self.param_rows if row[0] == version and row[1] == step))
                for step in steps
            )
            result[version] = first.setdefault(body, version)
        return result

    def rules(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.rule_rows), RULES_SCHEMA)

    def params(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.param_rows), RULE_PARAMS_SCHEMA)

    def only(self, *version_ids: str) -> "RuleSet":
        """The named versions; an unknown one is an error that lists what there is."""
        for version_id in version_ids:
            if version_id not in self.versions:
                raise RuleError(f"There is no rule version '{version_id}'. Known versions: {', '.join(self.versions)}")
        return RuleSet(
            tuple(row for row in self.rule_rows if row[0] in version_ids),
            tuple(row for row in self.param_rows if row[0] in version_ids),
        )


def _step_rows(version: dict, step: str) -> tuple[tuple, list[tuple]]:
    body = version[step]
    if not isinstance(body, dict):
        raise RuleError(f"{version.get('version_id')}: {step} must be a mapping.")
    head = (version["version_id"], version["description"], str(version["created"]), step)
    basis, rule = None, body
    if step == GL_TO_TOWER:
        if "strategy" in body:
            raise RuleError(
                "gl_to_tower follows the cost centre; name a fallback under on_unmapped instead of a strategy."
            )
        if set(body) - {"basis", "on_unmapped"}:
            raise RuleError(f"{version['version_id']}: unknown fields in {step}: {sorted(body)}.")
        basis, rule = body.get("basis"), body.get("on_unmapped") or {}
    strategy = rule.get("strategy")
    param_field = _PARAM_FIELDS.get(strategy)
    allowed = {"strategy", param_field} if param_field else {"strategy"}
    if strategy == "consumption":
        allowed.add("metric_name")
        if not rule.get("metric_name"):
            raise RuleError(f"{version['version_id']}: {step} needs metric_name.")
    if set(rule) - allowed:
        raise RuleError(f"{version['version_id']}: unknown fields in {step}: {sorted(set(rule) - allowed)}.")
    params = (rule.get(param_field) or {}) if param_field else {}
    return (
        (*head, basis, strategy, rule.get("metric_name")),
        _param_rows(version["version_id"], step, strategy, params),
    )


def _number(value: object, where: str) -> Decimal:
    try:
        number = Decimal(str(value))
    except InvalidOperation as error:
        raise RuleError(f"{where}: {value!r} is not a number.") from error
    if not number.is_finite():
        raise RuleError(f"{where}: {value!r} is not a number.")
    return number


def _decimals(value: Decimal) -> int:
    """Places after the point that are needed, however many digits the number has."""
    _, digits, exponent = value.as_tuple()
    zeros = len(digits) - len("".join(map(str, digits)).rstrip("0"))
    return max(0, -(exponent + zeros)) if value else 0


def _scaled(value: Decimal, digits: int) -> int:
    """value * 10^digits, in whole numbers; the value needs no more than that many decimals."""
    sign, figures, exponent = value.as_tuple()
    whole, power = int("".join(map(str, figures))), exponent + digits
    scaled = whole * 10**power if power >= 0 else whole // 10**-power
    return -scaled if sign else scaled


def _without_excess(units: dict[str, int]) -> dict[str, int]:
    """Proportions that exceed one by no more than the tolerance, cut to one at the largest, of equal ones the first.

    What a rule hands out can then never be more than what there is.
    """
    excess = sum(units.values()) - 10**PROPORTION_DIGITS
    if not 0 < excess <= int(PROPORTION_TOLERANCE * 10**PROPORTION_DIGITS):
        return units
    out = dict(units)
    for target in sorted(out, key=lambda name: (-out[name], name)):
        cut = min(excess, max(out[target], 0))
        out[target] -= cut
        excess -= cut
    return out


def _param_rows(version_id: str, step: str, strategy: str, params: dict) -> list[tuple]:
    """Declared values, exact, with the whole numbers that stand for them.

    Weights only count relative to each other: they are multiplied by the power of ten
    that makes all of a step whole. Proportions are counted in units of 10^-12.
    """
    where = f"{version_id}: {step}"
    values = {str(target): _number(value, where) for target, value in params.items()}
    digits = max([0, *(_decimals(value) for value in values.values())])
    if strategy == MANUAL_OVERRIDE:
        if digits > PROPORTION_DIGITS:
            raise RuleError(f"{where}: a proportion has more than {PROPORTION_DIGITS} decimals.")
        digits = PROPORTION_DIGITS
    if digits > 18 or any(value.adjusted() >= WHOLE_DIGITS for value in values.values() if value):
        raise RuleError(f"{where}: the values span too many digits to be split exactly.")
    raw = {target: _scaled(value, digits) for target, value in values.items()}
    if sum(abs(x) for x in raw.values()) > LARGEST_TOTAL:
        raise RuleError(f"{where}: the values span too many digits to be split exactly.")
    if strategy == MANUAL_OVERRIDE:
        raw = _without_excess(raw)
    return [(version_id, step, target, value, Decimal(raw[target])) for target, value in values.items()]


def raw_rule_set(versions: Iterable[dict]) -> RuleSet:
    """The rule tables of version mappings as they are, for reports on rules that may be broken."""
    rule_rows, param_rows, seen = [], [], set()
    for version in versions:
        missing, unknown = _VERSION_FIELDS - set(version), set(version) - _VERSION_FIELDS
        if missing or unknown:
            raise RuleError(
                f"Rule version {version.get('version_id')}: missing {sorted(missing)}, unknown {sorted(unknown)}."
            )
        if version["version_id"] in seen:
            raise RuleError(f"Two rule files share the version_id '{version['version_id']}'.")
        seen.add(version["version_id"])
        for step in STEPS:
            rule, params = _step_rows(version, step)
            rule_rows.append(rule)
            param_rows.extend(params)
    return RuleSet(tuple(rule_rows), tuple(param_rows))


def broken_rules(rules: RuleSet) -> list[tuple[str, str | None, str]]:
    """(version, step, code) of every check that needs no table."""
    found = []
    for version, description, created, step, basis, strategy, metric in rules.rule_rows:
        values = [row[3] for row in rules.param_rows if row[:2] == (version, step)]
        declared = strategy in (WEIGHTED, MANUAL_OVERRIDE)
        split = step != GL_TO_TOWER
        heads = {
            "version_id_blank": not str(version or "").strip(),
            "description_blank": not str(description or "").strip(),
            "created_not_a_date": not re.fullmatch(r"[0-9]{4}-[0-9]{2}-[0-9]{2}", created or ""),
        }
        steps = {
            "strategy_unknown": strategy not in STRATEGIES if strategy is not None else split,
            "basis_unknown": not split and basis != BASIS,
            "fallback_cannot_be_consumption": not split and strategy == CONSUMPTION,
            "values_empty": declared and not values,
            "values_negative": declared and any(value < 0 for value in values),
            "proportions_do_not_sum_to_one": strategy == MANUAL_OVERRIDE and bool(values) and abs(sum(values) - 1) > PROPORTION_TOLERANCE,
        }
        found += [(version, None, code) for code, broken in heads.items() if broken and step == STEPS[0]]
        found += [(version, step, code) for code, broken in steps.items() if broken]
    return found


def rule_set(versions: Iterable[dict]) -> RuleSet:
    """Build the rule tables from version mappings, as found in the rule files.

    Rules that would lose or create money, or that nobody can apply, are refused here, so
    that no path can use them; only whether metrics exist has to wait for the usage table.
    """
    rules = raw_rule_set(versions)
    if broken := broken_rules(rules):
        raise RuleViolation("Rule versions break governance checks:\n" + "\n".join(f"- {v} {s or ''}: {code}" for v, s, code in broken))
    return rules


def _local_files(folder: Path) -> list[tuple[str, bytes]]:
    if not folder.is_dir():
        raise RuleError(f"No such rules folder: {folder}")
    files = sorted(path for path in folder.iterdir() if path.suffix in (".yaml", ".yml"))
    return [(str(path), path.read_bytes()) for path in files]


def _shared_files(folder: str, spark: SparkSession) -> list[tuple[str, bytes]]:
    """Files under any path that tables can have; a rule folder is a few small files."""
    try:
        found = spark.read.format("binaryFile").option("pathGlobFilter", "*.{yaml,yml}").load(folder).select("path", "content")
    except AnalysisException as error:
        raise RuleError(f"No such rules folder: {folder}") from error
    return sorted((row.path, bytes(row.content)) for row in found.collect())


def load_rules(rules_dir: str | Path, spark: SparkSession | None = None) -> RuleSet:
    """Every ``*.yaml`` / ``*.yml`` file of a folder, one rule version per file.

    With a session the folder may lie wherever Spark reads tables from; without one it
    is a local folder. Files are taken in the order of their names. An empty file is refused
    in a local folder; Spark does not list it.
    """
    files = _shared_files(str(rules_dir), spark) if spark else _local_files(Path(rules_dir))
    if not files:
        raise RuleError(f"No rule files in {rules_dir}")
    versions = []
    for file, text in files:
        try:
            content = yaml.safe_load(text.decode("utf-8")) or {}
        except (yaml.YAMLError, UnicodeDecodeError) as error:
            raise RuleError(f"{file} is not valid YAML: {error}") from error
        if not isinstance(content, dict):
            raise RuleError(f"Rule file {file} must hold one mapping.")
        versions.append(content)
    return rule_set(versions)
