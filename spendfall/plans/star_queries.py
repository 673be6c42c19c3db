"""Every operator as a query over the star tables: name -> function of (spark, folder)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import cached_property
from pathlib import Path
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendfall.functions.money import from_cents, to_cents
from spendfall.operators import cascade as cas
from spendfall.operators import contracts, lineage, quality, reconcile, reports, rule_checks, strategies, usage
from spendfall.operators.conform import Conformed, conform
from spendfall.operators.quarantine import split_sound
from spendfall.schemas import CONTRACTS, GL_TO_TOWER, MONEY, STEPS
from spendfall.session import scratch_dir
from spendfall.sources import csv_exports, star, tables
from spendfall.sources.rule_files import RuleSet, load_rules, raw_rule_set, rule_set

RULES_DIR = Path(__file__).resolve().parents[2] / "rules"
V1, V2 = "v1_units", "v2_lines"


def _version(version_id: str, tower_to_app: dict, app_to_bu: dict, on_unmapped: dict | None = None) -> dict:
    first = {"basis": "cost_center_mapping"}
    if on_unmapped:
        first["on_unmapped"] = on_unmapped
    return {
        "version_id": version_id,
        "description": version_id,
        "created": "2026-01-15",
        "gl_to_tower": first,
        "tower_to_app": tower_to_app,
        "app_to_bu": app_to_bu,
    }


_EVEN = {"strategy": "even_spread"}
_UNITS = {"strategy": "consumption", "metric_name": "shipped_units"}
_LINES = {"strategy": "consumption", "metric_name": "order_lines"}
_APP_WEIGHTS = {
    "strategy": "weighted",
    "weights": {"APP-ECONOMY": "5", "APP-SMALL": "3", "APP-LARGE": "0", "APP-SHARED": "2.5"},
}
_BU_WEIGHTS = {"strategy": "weighted", "weights": {"BU-BUILDING": "1", "BU-MACHINERY": "2"}}
_APP_SHARES = {
    "strategy": "manual_override",
    "proportions": {"APP-ECONOMY": "0.15", "APP-MEDIUM": "0.35", "APP-STANDARD": "0.50"},
}
_BU_SHARES = {
    "strategy": "manual_override",
    "proportions": {"BU-BUILDING": "0.333333333333", "BU-FURNITURE": "0.333333333333", "BU-HOUSEHOLD": "0.333333333333"},
}

# One version per strategy, each used at both usage-driven steps.
STRATEGY_RULES = [
    _version("even", _EVEN, _EVEN, _EVEN),
    _version("weights", _APP_WEIGHTS, _BU_WEIGHTS),
    _version("units", _UNITS, {"strategy": "consumption", "metric_name": "ordered_units"}),
    _version("declared", _APP_SHARES, _BU_SHARES),
]
# Versions that split unmapped ledger lines, one per strategy allowed there.
FALLBACK_RULES = [
    _version("fall_even", _UNITS, _LINES, _EVEN),
    _version(
        "fall_weights",
        _UNITS,
        _LINES,
        {"strategy": "weighted", "weights": {"TWR-1": "7", "TWR-2": "2", "TWR-3": "4", "TWR-NONE": "100"}},
    ),
    _version(
        "fall_declared",
        _UNITS,
        _LINES,
        {"strategy": "manual_override", "proportions": {"TWR-6": "0.25", "TWR-7": "0.75"}},
    ),
    _version("fall_none", _UNITS, _LINES),
]
# Versions with governance faults, checked against the metrics that really exist.
FAULTY_RULES = [
    _version("wrong_step", {"strategy": "consumption", "metric_name": "order_lines"}, _LINES),
    _version("no_metric", _UNITS, {"strategy": "consumption", "metric_name": "headcount"}),
    _version("bad_sum", _UNITS, {"strategy": "manual_override", "proportions": {"BU-BUILDING": "0.4"}}),
    _version("negative", {"strategy": "weighted", "weights": {"APP-SMALL": "-1"}}, _LINES),
    _version("empty", {"strategy": "weighted", "weights": {}}, _LINES),
    _version("fall_consumption", _UNITS, _LINES, _UNITS),
    _version("unknown", {"strategy": "by_mood"}, _LINES),
]


@dataclass(frozen=True)
class Model:
    """The conformed star tables and what several queries derive from them."""

    spark: SparkSession
    sf_dir: str

    @cached_property
    def star(self) -> star.Star:
        return star.Star(self.spark, self.sf_dir)

    @cached_property
    def bronze(self) -> star.Bronze:
        return star.Bronze(self.star)

    @cached_property
    def conformed(self) -> Conformed:
        return conform(self.bronze)

    @property
    def silver(self) -> dict[str, DataFrame]:
        return self.conformed.tables

    @property
    def gl(self) -> DataFrame:
        return self.silver["fact_gl_cost"]

    @cached_property
    def index(self) -> DataFrame:
        return usage.usage_index(self.silver["fact_usage_metric"])

    @cached_property
    def rules(self) -> RuleSet:
        return load_rules(RULES_DIR).only(V1, V2)

    def splits(self, rules: RuleSet, **limits: int) -> cas.Splits:
        if rules is self.rules and not limits:
            return self._own_splits
        return cas.split_table(self.silver["fact_usage_metric"], self.silver["dim_resource_tower"], rules, **limits)

    @cached_property
    def _own_splits(self) -> cas.Splits:
        return cas.split_table(self.silver["fact_usage_metric"], self.silver["dim_resource_tower"], self.rules)

    @cached_property
    def ends(self) -> DataFrame:
        return cas.run_cascade(self.gl, self.splits(self.rules), self.rules)

    @cached_property
    def allocation(self) -> DataFrame:
        return cas.allocation(self.ends)

    @cached_property
    def sliced_ends(self) -> DataFrame:
        """End points by slices of the ledger, which is cut by the number of orders in their footers."""
        lines = cas.spread_lines(self.gl, self.star.table("orders").count())
        return cas.run_cascade(lines, self.splits(self.rules), self.rules)

    @cached_property
    def sliced_allocation(self) -> DataFrame:
        """The allocation for reports that count lines."""
        return cas.allocation(self.sliced_ends)

    @cached_property
    def residual(self) -> DataFrame:
        return cas.residual(self.ends)

    @cached_property
    def edges(self) -> DataFrame:
        named = lineage.with_names(self.gl, self.silver["dim_cost_center"])
        ends = cas.run_cascade(named, self.splits(self.rules), self.rules)
        return lineage.lineage(ends, self.gl, self.silver["dim_cost_center"])

    @cached_property
    def comparison(self) -> DataFrame:
        return reports.driver_comparison(self.allocation, self.silver["dim_business_unit"], V1, V2)

    @cached_property
    def comparison_by_app(self) -> DataFrame:
        return reports.driver_comparison_by_app(
            self.allocation, self.silver["dim_application"], self.silver["dim_business_unit"], V1, V2
        )

    def scratch(self, name: str) -> str:
        return f"{scratch_dir(self.spark)}/{name}-{uuid4().hex}"

    def exported(self, *names: str) -> str:
        """CSV exports of the named source tables, written by Spark."""
        folder = self.scratch("exports")
        for name in names:
            self.bronze[name].select(*CONTRACTS[name]).write.option("header", True).option("escape", '"').csv(
                f"{folder}/{name}.csv"
            )
        return folder


# --- sources and sinks -------------------------------------------------------------


def scan_csv(m: Model) -> DataFrame:
    folder = m.exported("gl_costs")
    rows = csv_exports.scan_csv(m.spark, f"{folder}/gl_costs.csv", "gl_costs")
    return rows.select(*CONTRACTS["gl_costs"])


def header_check(m: Model) -> DataFrame:
    """Headers of all six exports against their contracts, and the rows behind them."""
    folder = m.exported(*CONTRACTS)
    counts = []
    for name in CONTRACTS:
        header = csv_exports.check_header(m.spark, f"{folder}/{name}.csv", name)
        raw = csv_exports.scan_raw(m.spark, f"{folder}/{name}.csv", name)
        sound = contracts.with_violations(raw, name)
        counts.append(
            sound.agg(
                F.count(F.lit(1)).alias("row_count"),
                F.count_if(F.size("violations") == 0).alias("sound_count"),
            ).select(F.lit(name).alias("table_name"), F.lit(",".join(header)).alias("header"), "row_count", "sound_count")
        )
    result = counts[0]
    for part in counts[1:]:
        result = result.unionByName(part)
    return result


def write_table(m: Model) -> DataFrame:
    """Residual rows written per version, one version replaced, and read back."""
    folder = m.scratch("gold")
    tables.write_table(m.residual, folder, "residual")
    again = tables.read_table(m.spark, folder, "residual").where(F.col("rule_version") == V2)
    copy = m.scratch("gold")
    tables.write_table(again, copy, "residual")
    tables.write_table(tables.read_table(m.spark, copy, "residual"), folder, "residual")
    return tables.read_table(m.spark, folder, "residual").select(*m.residual.columns)


def scan_table(m: Model) -> DataFrame:
    folder = m.scratch("silver")
    tables.write_table(m.silver["fact_usage_metric"], folder, "fact_usage_metric")
    return tables.read_table(m.spark, folder, "fact_usage_metric")


# --- contracts, conformance, quality -----------------------------------------------


def _offered(m: Model) -> DataFrame:
    """Customers offered as ledger lines: debts are not positive amounts, some fields break patterns."""
    return m.star.table("customer").select(
        F.concat(F.lit(" CC-"), F.col("c_custkey"), F.lit(" ")).alias("gl_line_id"),
        F.when(F.col("c_mktsegment") == "BUILDING", "2026-1").otherwise("2026-01").alias("period"),
        F.concat(F.lit("70"), F.col("c_nationkey")).alias("gl_account"),
        F.when(F.col("c_acctbal") < 9000, F.concat(F.lit("CC-"), F.col("c_nationkey"))).alias("cost_center_id"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "oops")
        .when(F.col("c_mktsegment") == "FURNITURE", F.concat(F.col("c_acctbal").cast(MONEY).cast("string"), F.lit("5")))
        .otherwise(F.col("c_acctbal").cast(MONEY).cast("string"))
        .alias("amount_eur"),
        F.when(F.col("c_nationkey") == 3, "  ").otherwise(F.col("c_name")).alias("description"),
    )


def contract_violations(m: Model) -> DataFrame:
    """How often the offered lines break each rule."""
    return contracts.violation_counts(_offered(m), "gl_costs")


def quarantine(m: Model) -> DataFrame:
    """The offered lines that are broken, with all reasons, out of one scan that also writes and counts the sound ones."""
    found = split_sound(_offered(m), "gl_costs", f"{scratch_dir(m.spark)}/quarantine-{uuid4().hex}")
    sound = F.lit(found.row_count - found.broken_count).cast("long")
    return found.broken.select("gl_line_id", F.array_join("violations", ",").alias("reasons"), sound.alias("sound_count"))


def conform_dims(m: Model) -> DataFrame:
    """The four dimensions in one shape."""
    shapes = {
        "dim_cost_center": ("cost_center_id", "tower_id"),
        "dim_resource_tower": ("tower_id", "type"),
        "dim_application": ("app_id", "criticality"),
        "dim_business_unit": ("bu_id", None),
    }
    parts = [
        m.silver[name].select(
            F.lit(name).alias("dimension"),
            F.col(key).alias("key"),
            "name",
            (F.col(extra) if extra else F.lit(None).cast("string")).alias("attribute"),
        )
        for name, (key, extra) in shapes.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def dq_duplicate_keys(m: Model) -> DataFrame:
    """Line items whose order and line number are not unique."""
    return quality.duplicate_keys(m.star.table("lineitem"), ["l_orderkey", "l_linenumber"])


def dq_conflicting_keys(m: Model) -> DataFrame:
    """Customers' nations with more than one market segment, counting segments as attributes."""
    customers = m.star.table("customer").select("c_nationkey", "c_mktsegment")
    return quality.conflicting_keys(customers, "c_nationkey", ["c_mktsegment"])


def dq_fk_anti_join(m: Model) -> DataFrame:
    """Towers of cost centres that report no usage at all, with their cost centres."""
    reporting = m.silver["fact_usage_metric"].where(F.col("step") == "tower_to_app")
    return quality.unresolved_keys(m.silver["dim_cost_center"], "tower_id", reporting, "from_id", skip_null=True)


def dq_report(m: Model) -> DataFrame:
    orders = m.star.table("orders")
    control_total = orders.agg(F.sum(F.col("o_totalprice").cast(MONEY))).scalar()
    return quality.quality_report(m.conformed, control_total)


def faulty(conformed: Conformed) -> Conformed:
    """The tables with faults of every kind put into rows chosen by their content."""
    old = conformed.tables

    def renamed(name: str, where: str, **changes: str) -> DataFrame:
        return old[name].where(where).withColumns({"name": F.concat("name", F.lit("*"))} | {k: F.expr(v) for k, v in changes.items()})

    candidates = {
        "dim_cost_center": old["dim_cost_center"].unionByName(renamed("dim_cost_center", "tower_id = 'TWR-3'", tower_id="'TWR-99'")),
        "dim_resource_tower": old["dim_resource_tower"].where("tower_id <> 'TWR-5'").unionByName(renamed("dim_resource_tower", "tower_id = 'TWR-7'")),
        "dim_application": old["dim_application"].where("app_id <> 'APP-MEDIUM'").unionByName(renamed("dim_application", "app_id = 'APP-SMALL'", criticality="'none'")),
        "dim_business_unit": old["dim_business_unit"].where("bu_id <> 'BU-BUILDING'").unionByName(renamed("dim_business_unit", "bu_id = 'BU-MACHINERY'")),
    }
    booked = old["fact_gl_cost"].where("gl_account = '7003'").withColumns({"cost_center_id": F.lit("CC-NONE"), "amount_eur": (-F.col("amount_eur")).cast(MONEY)})
    returned = old["fact_usage_metric"].where("metric_name = 'order_lines'").withColumn("value", (-F.col("value")).cast(MONEY))
    facts = {"fact_gl_cost": old["fact_gl_cost"].unionByName(booked), "fact_usage_metric": old["fact_usage_metric"].unionByName(returned)}
    return Conformed(candidates, {name: frame.distinct() for name, frame in candidates.items()} | facts)


def dq_report_faulty(m: Model) -> DataFrame:
    """The report on tables with faults of every kind: no check passes."""
    control_total = m.star.table("orders").agg(F.sum(F.col("o_totalprice").cast(MONEY))).scalar()
    return quality.quality_report(faulty(m.conformed), control_total)


# --- strategies and splits ---------------------------------------------------------


def normalize_shares(m: Model) -> DataFrame:
    rules = rule_set(STRATEGY_RULES).only("units")
    shares = strategies.normalize_shares(strategies.usage_candidates(m.index, rules))
    return shares.select("step", "from_id", "to_id", "raw", "units")


def _strategy(version: str, strategy: str) -> Callable[[Model], DataFrame]:
    def query(m: Model) -> DataFrame:
        rules = rule_set(STRATEGY_RULES).only(version)
        return strategies.strategy_shares(strategies.usage_candidates(m.index, rules), strategy).drop("rule_version")

    return query


def _spread(m: Model, **limits: int) -> DataFrame:
    rules = rule_set(STRATEGY_RULES).only("even")
    flows = m.gl.select(
        "gl_line_id",
        F.lit("even").alias("rule_version"),
        F.lit(strategies.ANY_LINE).alias("from_id"),
        to_cents(F.col("amount_eur")).alias("cents"),
    )
    parts = cas.distribute(flows, m.splits(rules, **limits), GL_TO_TOWER, ["gl_line_id"])
    return parts.select("gl_line_id", "to_id", "share", from_cents(F.col("part")).alias("amount_eur"))


def distribute_amount(m: Model) -> DataFrame:
    """Every ledger line spread evenly over all towers, to the cent."""
    return _spread(m)


def distribute_amount_wide(m: Model) -> DataFrame:
    """The same in the form for sources of any number of targets: every distinct amount is split once."""
    return _spread(m, array_targets=0)


# --- cascade -----------------------------------------------------------------------

_FLOW = ["rule_version", "gl_line_id", "tower_id", "app_id", "amount_eur", "failed_step", "reason_code"]


def gl_to_tower(m: Model) -> DataFrame:
    flows = cas.with_amount(cas.gl_to_tower(m.gl, m.splits(m.rules), m.rules))
    return flows.select(*[c for c in _FLOW if c != "app_id"], "gl_to_tower_proportion")


def gl_to_tower_fallback(m: Model) -> DataFrame:
    rules = rule_set(FALLBACK_RULES)
    flows = cas.with_amount(cas.gl_to_tower(m.gl, m.splits(rules), rules))
    return flows.select(*[c for c in _FLOW if c != "app_id"], "gl_to_tower_proportion")


def tower_to_app(m: Model) -> DataFrame:
    splits = m.splits(m.rules)
    flows = cas.tower_to_app(cas.gl_to_tower(m.gl, splits, m.rules), splits)
    return cas.with_amount(flows).select(*_FLOW, "tower_to_app_proportion")


def _all_strategies(m: Model, rules: RuleSet) -> DataFrame:
    ends = cas.run_cascade(m.gl, m.splits(rules), rules, in_cents=True)
    return ends.groupBy("rule_version", "outcome", "failed_step", "reason_code", "tower_id", "app_id", "bu_id").agg(
        F.count(F.lit(1)).alias("row_count"), from_cents(F.sum("cents")).alias("amount_eur")
    )


def cascade_all_strategies(m: Model) -> DataFrame:
    """The cascade under every strategy, summed by where the money ends up."""
    return _all_strategies(m, rule_set(STRATEGY_RULES))


def cascade_with_fallback(m: Model) -> DataFrame:
    return _all_strategies(m, rule_set(FALLBACK_RULES))


def cascade_shuffled(m: Model) -> DataFrame:
    """The same cascade by salted joins and windows, as used when splits are too large to broadcast."""
    splits = replace(m.splits(m.rules), wide_steps=frozenset(STEPS))
    return cas.allocation(cas.run_cascade(m.gl, splits, m.rules))


# --- lineage -----------------------------------------------------------------------


def report_lineage(m: Model) -> DataFrame:
    """Lineage out of allocated and residual end points, which stay where their ledger lines have been sliced to."""
    ends = m.sliced_ends
    return lineage.lineage(cas.ends_of(cas.allocation(ends), cas.residual(ends)), m.gl, m.silver["dim_cost_center"], sliced=True)



def trace_forward(m: Model) -> DataFrame:
    """End points of all urgent ledger lines."""
    urgent = m.gl.where(F.col("gl_account") == "7001")
    return lineage.trace_forward(m.edges, V1, urgent)


def trace_backward(m: Model) -> DataFrame:
    return lineage.trace_backward(m.edges, V2, bu_id="BU-MACHINERY", app_id="APP-STANDARD")


def proportion_drift(m: Model) -> DataFrame:
    drift = lineage.proportion_drift(m.edges, m.rules)
    return drift.groupBy("rule_version", "app_id", "bu_id").agg(
        F.count(F.lit(1)).alias("path_count"),
        F.count_if(~F.col("within_bound")).alias("outside_count"),
        F.max("drift_eur").cast("decimal(18,10)").alias("max_drift_eur"),
    )


def lineage_round_trip(m: Model) -> DataFrame:
    totals = reconcile.reconciliation(m.gl, m.ends, m.rules.versions)
    return lineage.round_trip(m.edges, totals)


def lineage_completeness(m: Model) -> DataFrame:
    return lineage.line_completeness(m.edges)


def worked_example(m: Model) -> DataFrame:
    """Rows of the example; the residual line is the first of the first cost centre in debt."""
    in_debt = m.silver["dim_cost_center"].where(F.col("tower_id").isNull())
    first = m.residual.join(in_debt.select("cost_center_id"), "cost_center_id", "left_semi").agg(F.min("cost_center_id"))
    return lineage.example_rows(m.edges, first.scalar())


# --- registry ----------------------------------------------------------------------

MODEL_QUERIES: dict[str, Callable[[Model], DataFrame]] = {
    "scan_csv": scan_csv,
    "header_check": header_check,
    "scan_table": scan_table,
    "write_table": write_table,
    "rules_table": lambda m: rule_checks.rule_coverage(m.rules.rules(m.spark), m.index),
    "rule_violations": lambda m: rule_checks.rule_violations(
        raw_rule_set(FAULTY_RULES).rules(m.spark), raw_rule_set(FAULTY_RULES).params(m.spark), m.silver["fact_usage_metric"]
    ),
    "contract_violations": contract_violations,
    "quarantine": quarantine,
    "conform_dims": conform_dims,
    "conform_gl_cost": lambda m: m.gl,
    "conform_usage": lambda m: m.silver["fact_usage_metric"],
    "dq_duplicate_keys": dq_duplicate_keys,
    "dq_conflicting_keys": dq_conflicting_keys,
    "dq_fk_anti_join": dq_fk_anti_join,
    "dq_report": dq_report,
    "dq_report_faulty": dq_report_faulty,
    "usage_index": lambda m: m.index,
    "usage_metrics_by_step": lambda m: usage.metrics_by_step(m.index),
    "normalize_shares": normalize_shares,
    "strategy_even_spread": _strategy("even", "even_spread"),
    "strategy_weighted": _strategy("weights", "weighted"),
    "strategy_consumption": _strategy("units", "consumption"),
    "strategy_manual_override": _strategy("declared", "manual_override"),
    "distribute_amount": distribute_amount,
    "distribute_amount_wide": distribute_amount_wide,
    "gl_to_tower": gl_to_tower,
    "gl_to_tower_fallback": gl_to_tower_fallback,
    "tower_to_app": tower_to_app,
    "app_to_bu": lambda m: m.ends.select(*_FLOW, "bu_id", "outcome", "app_to_bu_proportion"),
    "cascade_allocation": lambda m: m.allocation,
    "cascade_residual": lambda m: m.residual,
    "cascade_shuffled": cascade_shuffled,
    "cascade_all_strategies": cascade_all_strategies,
    "cascade_with_fallback": cascade_with_fallback,
    "residual_by_reason": lambda m: reports.residual_by_reason(m.residual),
    "residual_detail": lambda m: reports.residual_detail(m.residual, m.gl, m.silver["dim_cost_center"]),
    "residual_report": lambda m: reports.residual_report(m.residual, m.gl),
    "report_residual": lambda m: reports.residual_report(
        reports.residual_detail(m.residual, m.gl, m.silver["dim_cost_center"]), m.gl
    ),
    "reconciliation": lambda m: reconcile.reconciliation(m.gl, m.ends, m.rules.versions),
    "recon_by_line": lambda m: reconcile.line_reconciliation(m.gl, m.ends, m.rules.versions),
    "lineage": lambda m: m.edges,
    "report_lineage": report_lineage,
    "lineage_completeness": lineage_completeness,
    "lineage_round_trip": lineage_round_trip,
    "trace_forward": trace_forward,
    "trace_backward": trace_backward,
    "proportion_drift": proportion_drift,
    "worked_example": worked_example,
    "application_tco": lambda m: reports.application_tco(m.sliced_allocation, m.silver["dim_application"]),
    "bu_showback": lambda m: reports.bu_showback(m.sliced_allocation, m.silver["dim_business_unit"]),
    "driver_comparison": lambda m: m.comparison,
    "driver_comparison_by_app": lambda m: m.comparison_by_app,
    "top_bu_flip": lambda m: reports.top_bu_flip(m.comparison_by_app, V1, V2),
    "max_share_swing": lambda m: reports.max_share_swing(m.comparison),
}


def star_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The queries with the signature the runners expect; each call builds its own model."""

    def bind(query: Callable[[Model], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: query(Model(spark, sf_dir))

    return {name: bind(query) for name, query in MODEL_QUERIES.items()}
