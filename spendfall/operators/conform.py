"""Source tables to conformed dimensions and facts."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendfall.functions.text import blank_to_null
from spendfall.operators.lookup import BROADCAST_BYTES, lookup_join
from spendfall.schemas import MONEY


@dataclass(frozen=True)
class Conformed:
    """Dimension rows before and after DISTINCT, and the silver tables."""

    candidates: dict[str, DataFrame]
    tables: dict[str, DataFrame]


def _trimmed(name: str, alias: str | None = None) -> Column:
    return F.trim(F.col(name)).alias(alias or name)


def dimension_candidates(bronze: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Trimmed and renamed dimension rows, duplicates still in."""
    return {
        "dim_cost_center": bronze["cost_centers"].select(
            _trimmed("cost_center_id"),
            _trimmed("cost_center_name", "name"),
            blank_to_null(F.trim("tower_id")).alias("tower_id"),
        ),
        "dim_resource_tower": bronze["resource_towers"].select(
            _trimmed("tower_id"), _trimmed("tower_name", "name"), _trimmed("tower_type", "type")
        ),
        "dim_application": bronze["applications"].select(
            _trimmed("app_id"), _trimmed("app_name", "name"), _trimmed("business_criticality", "criticality")
        ),
        "dim_business_unit": bronze["business_units"].select(_trimmed("bu_id"), _trimmed("bu_name", "name")),
    }


def fact_gl_cost(
    gl_costs: DataFrame, dim_cost_center: DataFrame, *, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Ledger lines with the tower of their cost centre, NULL where there is none.

    Cost centres may be as many as customers and one of them may own a third of the
    ledger: the join is broadcast only when the dimension measures small, else salted.
    """
    lines = gl_costs.select(
        _trimmed("gl_line_id"),
        _trimmed("period"),
        _trimmed("gl_account"),
        _trimmed("cost_center_id"),
        F.col("amount_eur").cast(MONEY).alias("amount_eur"),
    )
    towers = dim_cost_center.select("cost_center_id", "tower_id")
    return lookup_join(
        lines, towers, ["cost_center_id"], spread_by=["gl_line_id"], broadcast_bytes=broadcast_bytes
    ).select("gl_line_id", "period", "gl_account", "cost_center_id", "amount_eur", "tower_id")


def fact_usage_metric(usage_metrics: DataFrame) -> DataFrame:
    names = ["metric_id", "period", "step", "from_id", "to_id", "metric_name"]
    return usage_metrics.select(*[_trimmed(name) for name in names], F.col("value").cast(MONEY).alias("value"))


def conform(bronze: Mapping[str, DataFrame]) -> Conformed:
    candidates = dimension_candidates(bronze)
    tables = {name: frame.distinct() for name, frame in candidates.items()}
    tables["fact_gl_cost"] = fact_gl_cost(bronze["gl_costs"], tables["dim_cost_center"])
    tables["fact_usage_metric"] = fact_usage_metric(bronze["usage_metrics"])
    return Conformed(candidates, tables)
