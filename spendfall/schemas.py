"""Table catalogue: column types, field contracts and write order of every stored table.

The column names, enum values, patterns and sort orders below are fixed values:
they define the exchange format of the tables.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
SHARE = T.DecimalType(18, 12)
PCT = T.DecimalType(18, 6)

GL_TO_TOWER = "gl_to_tower"
TOWER_TO_APP = "tower_to_app"
APP_TO_BU = "app_to_bu"
STEPS = (GL_TO_TOWER, TOWER_TO_APP, APP_TO_BU)

EVEN_SPREAD = "even_spread"
WEIGHTED = "weighted"
CONSUMPTION = "consumption"
MANUAL_OVERRIDE = "manual_override"
STRATEGIES = (EVEN_SPREAD, WEIGHTED, CONSUMPTION, MANUAL_OVERRIDE)

UNMAPPED = "unmapped"
DRIVER_ZERO = "driver_zero"
SHARED_UNATTRIBUTABLE = "shared_unattributable"

ALLOCATED = "allocated"
RESIDUAL = "residual"

# Field contracts of the six source tables: column -> kind of check.
CONTRACTS: dict[str, dict[str, str]] = {
    "gl_costs": {
        "gl_line_id": "required",
        "period": "period",
        "gl_account": "account",
        "cost_center_id": "required",
        "amount_eur": "money_positive",
        "description": "required",
    },
    "cost_centers": {
        "cost_center_id": "required",
        "cost_center_name": "required",
        "tower_id": "optional",
    },
    "resource_towers": {
        "tower_id": "required",
        "tower_name": "required",
        "tower_type": "required",
    },
    "applications": {
        "app_id": "required",
        "app_name": "required",
        "business_criticality": "criticality",
    },
    "business_units": {
        "bu_id": "required",
        "bu_name": "required",
    },
    "usage_metrics": {
        "metric_id": "required",
        "period": "period",
        "step": "usage_step",
        "from_id": "required",
        "to_id": "required",
        "metric_name": "required",
        "value": "money_not_negative",
    },
}
MONEY_KINDS = ("money_positive", "money_not_negative")
PATTERNS = {"period": r"^[0-9]{4}-[0-9]{2}$", "account": r"^[0-9]{4}$"}
ENUMS = {"criticality": ("low", "med", "high"), "usage_step": (TOWER_TO_APP, APP_TO_BU)}

SILVER_TABLES = (
    "dim_cost_center",
    "dim_resource_tower",
    "dim_application",
    "dim_business_unit",
    "fact_gl_cost",
    "fact_usage_metric",
)

# Row order inside each written file.
SORT_KEYS: dict[str, list[str]] = {
    **{name: list(columns) for name, columns in CONTRACTS.items()},
    "dim_cost_center": ["cost_center_id"],
    "dim_resource_tower": ["tower_id"],
    "dim_application": ["app_id"],
    "dim_business_unit": ["bu_id"],
    "fact_gl_cost": ["gl_line_id"],
    "fact_usage_metric": ["metric_id"],
    "allocation": ["gl_line_id", "tower_id", "app_id", "bu_id", "allocated_amount_eur"],
    "residual": ["gl_line_id", "failed_step", "reason_code", "amount_eur"],
    "residual_detail": ["rule_version", "failed_step", "reason_code", "gl_line_id"],
    "residual_report": ["rule_version", "failed_step", "reason_code"],
    "reconciliation": ["rule_version"],
    "lineage": ["rule_version", "outcome", "gl_line_id", "tower_id", "app_id", "bu_id", "reason_code"],
    "report_application_tco": ["rule_version", "app_id"],
    "report_bu_showback": ["rule_version", "bu_id"],
    "report_residual": ["rule_version", "failed_step", "reason_code"],
    "report_lineage": ["rule_version", "outcome", "gl_line_id", "tower_id", "app_id", "bu_id", "reason_code"],
    "report_driver_comparison": ["bu_id"],
    "report_driver_comparison_by_app": ["app_id", "bu_id"],
}

# Tables split into one folder per rule version, so a version is replaced alone.
PARTITIONED_BY_VERSION = (
    "allocation",
    "residual",
    "residual_detail",
    "residual_report",
    "reconciliation",
    "lineage",
    "report_application_tco",
    "report_bu_showback",
    "report_residual",
    "report_lineage",
)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


def bronze_schema(table: str) -> T.StructType:
    """Stored type of a source table: money as decimals, the rest text, plus the file name."""
    columns = [
        (name, MONEY if kind in MONEY_KINDS else T.StringType()) for name, kind in CONTRACTS[table].items()
    ]
    return _struct(*columns, ("_source_file", T.StringType()))


def raw_schema(table: str) -> T.StructType:
    """All-text type used to scan a CSV export before its contract is checked."""
    return _struct(*[(name, T.StringType()) for name in CONTRACTS[table]])


ALLOCATION_COLUMNS = [
    "gl_line_id",
    "period",
    "gl_account",
    "cost_center_id",
    "tower_id",
    "app_id",
    "bu_id",
    "allocated_amount_eur",
    "rule_version",
    "gl_to_tower_proportion",
    "tower_to_app_proportion",
    "app_to_bu_proportion",
]
RESIDUAL_COLUMNS = [
    "gl_line_id",
    "period",
    "gl_account",
    "cost_center_id",
    "tower_id",
    "app_id",
    "amount_eur",
    "failed_step",
    "reason_code",
    "rule_version",
]
LINEAGE_COLUMNS = [
    "gl_line_id",
    "period",
    "gl_account",
    "cost_center_id",
    "cost_center_name",
    "tower_id",
    "app_id",
    "bu_id",
    "gl_amount_eur",
    "prop_gl_to_tower",
    "prop_tower_to_app",
    "prop_app_to_bu",
    "allocated_amount_eur",
    "residual_amount_eur",
    "terminal_amount_eur",
    "rule_version",
    "outcome",
    "reason_code",
    "failed_step",
]

RULES_SCHEMA = _struct(
    ("version_id", T.StringType()),
    ("description", T.StringType()),
    ("created", T.StringType()),
    ("step", T.StringType()),
    ("basis", T.StringType()),
    ("strategy", T.StringType()),
    ("metric_name", T.StringType()),
)
RULE_PARAMS_SCHEMA = _struct(
    ("version_id", T.StringType()),
    ("step", T.StringType()),
    ("target_id", T.StringType()),
    ("value", T.DecimalType(38, 18)),
    # The value as a whole number, on one scale for all targets of a version and step.
    ("raw", T.DecimalType(26, 0)),
)
