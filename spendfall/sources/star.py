"""Adapter: order/line-item star tables seen as the six source tables of the cost model.

orders are ledger lines, customers cost centres, nations towers, part types
applications and market segments business units. Line items give the driver signals,
per month of shipping:

- ``tower_to_app`` (supplier nation -> part type): ``line_count`` and ``shipped_units``;
- ``app_to_bu`` (part type -> segment): ``order_lines`` and ``ordered_units``.

Gaps that make every residual reason occur: customers in debt have no tower, the
MIDDLE EAST reports no usage, AFRICA reports no shipped units, PROMO reports no usage
and ECONOMY reports zero ordered units.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendfall.operators.lookup import lookup_join
from spendfall.schemas import APP_TO_BU, MONEY, TOWER_TO_APP

SILENT_REGION = "MIDDLE EAST"
UNITLESS_REGION = "AFRICA"
SILENT_APP = "PROMO"
ZERO_APP = "ECONOMY"


class Star:
    """The star tables of one folder; the schema of each is read once."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self._read: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._read[name]


def spread_small(scan: DataFrame, *keys: str) -> DataFrame:
    """Spread a scan of fewer splits than cores, so that a small table uses all of them.

    A large input has more splits than that and is left as it is scanned. ``keys``
    together are close to unique, so no key can fill one partition.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores, *keys) if scan.rdd.getNumPartitions() < cores else scan


def _id(prefix: str, column: str) -> Column:
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


def gl_costs(star: Star) -> DataFrame:
    orders = star.table("orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    return spread_small(orders, "o_orderkey").select(
        _id("GL-", "o_orderkey").alias("gl_line_id"),
        F.date_format("o_orderdate", "yyyy-MM").alias("period"),
        F.concat(F.lit("700"), F.substring("o_orderpriority", 1, 1)).alias("gl_account"),
        _id("CC-", "o_custkey").alias("cost_center_id"),
        F.col("o_totalprice").cast(MONEY).alias("amount_eur"),
        F.col("o_orderpriority").alias("description"),
    )


def cost_centers(star: Star) -> DataFrame:
    return star.table("customer").select(
        _id("CC-", "c_custkey").alias("cost_center_id"),
        F.col("c_name").alias("cost_center_name"),
        F.when(F.col("c_acctbal") >= 0, _id("TWR-", "c_nationkey")).alias("tower_id"),
    )


def resource_towers(star: Star) -> DataFrame:
    nation, region = star.table("nation"), star.table("region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        _id("TWR-", "n_nationkey").alias("tower_id"),
        F.col("n_name").alias("tower_name"),
        F.col("r_name").alias("tower_type"),
    )


def applications(star: Star) -> DataFrame:
    criticality = (
        F.when(F.col("p_type").isin("ECONOMY", "SMALL"), "low")
        .when(F.col("p_type").isin("MEDIUM", "STANDARD"), "med")
        .otherwise("high")
    )
    return star.table("part").select(
        _id("APP-", "p_type").alias("app_id"),
        F.col("p_type").alias("app_name"),
        criticality.alias("business_criticality"),
    ).distinct()


def business_units(star: Star) -> DataFrame:
    return star.table("customer").select(
        _id("BU-", "c_mktsegment").alias("bu_id"), F.col("c_mktsegment").alias("bu_name")
    ).distinct()


def _signal(step: str, source: Column, target: Column, metric: str, value: Column) -> Column:
    return F.struct(
        F.lit(step).alias("step"),
        source.alias("from_id"),
        target.alias("to_id"),
        F.lit(metric).alias("metric_name"),
        value.cast("decimal(26,2)").alias("value"),
    )


def usage_metrics(star: Star) -> DataFrame:
    """Both usage steps from one pass over the line items.

    Line items are first reduced per order, supplier, part type and month: the part
    lookup comes before the shuffle and a hot order collapses on the map side. The cube
    of month, nation, type and segment is small whatever the number of line items.
    """
    items = spread_small(
        star.table("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"),
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
    ).select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        F.col("l_quantity").cast(MONEY).alias("units"),
        F.date_format("l_shipdate", "yyyy-MM").alias("period"),
    )
    parts = star.table("part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    nation, region = star.table("nation"), star.table("region")
    towers = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("s_nationkey"), F.col("r_name")
    )
    suppliers = (
        star.table("supplier")
        .select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
        .join(towers, "s_nationkey")
    )
    segments = star.table("customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    buyers = lookup_join(
        star.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"),
        segments,
        ["o_custkey"],
        "inner",
        spread_by=["l_orderkey"],
    ).select("l_orderkey", "c_mktsegment")

    typed = lookup_join(items, parts, ["l_partkey"], "inner", spread_by=["l_orderkey", "l_suppkey"])
    placed = lookup_join(typed, suppliers, ["l_suppkey"], "inner", spread_by=["l_orderkey", "l_partkey"])
    per_order = placed.groupBy("l_orderkey", "period", "s_nationkey", "r_name", "p_type").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("units").alias("units")
    )
    cube = per_order.join(buyers, "l_orderkey").groupBy("period", "s_nationkey", "r_name", "p_type", "c_mktsegment").agg(
        F.sum("lines").alias("lines"), F.sum("units").alias("units")
    )
    tower, app, unit = _id("TWR-", "s_nationkey"), _id("APP-", "p_type"), _id("BU-", "c_mktsegment")
    lines, units = F.col("lines"), F.col("units")
    region_reports = F.col("r_name") != SILENT_REGION
    app_reports = F.col("p_type") != SILENT_APP
    units_or_zero = F.when(F.col("p_type") == ZERO_APP, F.lit(0)).otherwise(units)
    signals = F.array_compact(
        F.array(
            F.when(region_reports, _signal(TOWER_TO_APP, tower, app, "line_count", lines)),
            F.when(
                region_reports & (F.col("r_name") != UNITLESS_REGION),
                _signal(TOWER_TO_APP, tower, app, "shipped_units", units),
            ),
            F.when(app_reports, _signal(APP_TO_BU, app, unit, "order_lines", lines)),
            F.when(app_reports, _signal(APP_TO_BU, app, unit, "ordered_units", units_or_zero)),
        )
    )
    return (
        cube.select("period", F.inline(signals))
        .groupBy("period", "step", "from_id", "to_id", "metric_name")
        .agg(F.sum("value").cast(MONEY).alias("value"))
        .select(
            F.concat_ws(":", "step", "from_id", "to_id", "metric_name", "period").alias("metric_id"),
            "period",
            "step",
            "from_id",
            "to_id",
            "metric_name",
            "value",
        )
    )


SOURCES = {
    "gl_costs": gl_costs,
    "cost_centers": cost_centers,
    "resource_towers": resource_towers,
    "applications": applications,
    "business_units": business_units,
    "usage_metrics": usage_metrics,
}


class Bronze(Mapping):
    """The six source tables in their bronze types, each built when it is asked for."""

    def __init__(self, star: Star) -> None:
        self._star = star
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self._built:
            self._built[table] = SOURCES[table](self._star)
        return self._built[table]

    def __iter__(self) -> Iterator[str]:
        return iter(SOURCES)

    def __len__(self) -> int:
        return len(SOURCES)
