"""Reports over the end points. Dimension names are joined after the amounts are summed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from spendfall.functions.money import ratio6
from spendfall.operators.lookup import lookup_join
from spendfall.schemas import MONEY, PCT


def _with_version_total(summed: DataFrame, amount: str) -> DataFrame:
    """Add the version's total as ``version_total``.

    A window over what has been summed already, one row per application or unit of a
    version: what the sums come from is read once.
    """
    return summed.withColumn("version_total", F.sum(amount).over(W.partitionBy("rule_version")))


def residual_detail(residual: DataFrame, gl: DataFrame, dim_cost_center: DataFrame) -> DataFrame:
    """Residual rows with the ledger account and the cost centre name.

    The ledger is only asked for the account where the residual table lacks it.
    """
    names = dim_cost_center.select("cost_center_id", F.col("name").alias("cost_center_name"))
    joined = residual if "gl_account" in residual.columns else residual.join(gl.select("gl_line_id", "gl_account"), "gl_line_id")
    return lookup_join(joined, names, ["cost_center_id"], spread_by=["gl_line_id", "app_id"]).select(
        "gl_line_id",
        "amount_eur",
        "gl_account",
        "cost_center_id",
        "cost_center_name",
        "failed_step",
        "reason_code",
        "rule_version",
        "app_id",
    )


def residual_report(detail: DataFrame, gl: DataFrame) -> DataFrame:
    """Residual by version, step and reason: amount, distinct ledger lines, share of the ledger."""
    total = gl.agg(F.sum("amount_eur").cast(MONEY)).scalar()
    return (
        detail.groupBy("rule_version", "failed_step", "reason_code")
        .agg(
            F.sum("amount_eur").cast(MONEY).alias("residual_amount_eur"),
            F.count_distinct("gl_line_id").alias("gl_line_count"),
        )
        .withColumn("total_gl", total)
        .withColumn("pct_of_total_gl", ratio6(F.col("residual_amount_eur"), F.col("total_gl")))
        .drop("total_gl")
    )


def residual_by_reason(residual: DataFrame) -> DataFrame:
    """Residual rows and amounts by version, step and reason."""
    return residual.groupBy("rule_version", "failed_step", "reason_code").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("amount_eur").cast(MONEY).alias("amount_eur")
    )


def _per_line(allocation: DataFrame, key: str) -> DataFrame:
    """Amount and distinct ledger lines per version and ``key``: lines are summed before they are counted."""
    lines = allocation.groupBy("rule_version", key, "gl_line_id").agg(F.sum("allocated_amount_eur").alias("amount"))
    return lines.groupBy("rule_version", key).agg(
        F.sum("amount").cast(MONEY).alias("allocated_amount_eur"),
        F.count("gl_line_id").alias("contributing_gl_line_count"),
    )


def application_tco(allocation: DataFrame, dim_application: DataFrame) -> DataFrame:
    """Cost of ownership per application and version."""
    summed = _with_version_total(_per_line(allocation, "app_id"), "allocated_amount_eur")
    return summed.join(dim_application, "app_id", "left").select(
        "rule_version",
        "app_id",
        F.coalesce("name", "app_id").alias("app_name"),
        F.coalesce("criticality", F.lit("")).alias("business_criticality"),
        "allocated_amount_eur",
        ratio6(F.col("allocated_amount_eur"), F.col("version_total")).alias("pct_of_allocated"),
        "contributing_gl_line_count",
    )


def bu_showback(allocation: DataFrame, dim_business_unit: DataFrame) -> DataFrame:
    """Showback per business unit and version.

    Amounts, applications and ledger lines come out of one pass over the allocation: the
    distinct counts are grouped where the rows are, before anything is shuffled.
    """
    summed = allocation.groupBy("rule_version", "bu_id").agg(
        F.sum("allocated_amount_eur").cast(MONEY).alias("allocated_amount_eur"),
        F.count_distinct("app_id").alias("contributing_app_count"),
        F.count_distinct("gl_line_id").alias("contributing_gl_line_count"),
    )
    summed = _with_version_total(summed, "allocated_amount_eur")
    return summed.join(dim_business_unit, "bu_id", "left").select(
        "rule_version",
        "bu_id",
        F.coalesce("name", "bu_id").alias("bu_name"),
        "allocated_amount_eur",
        ratio6(F.col("allocated_amount_eur"), F.col("version_total")).alias("pct_of_allocated"),
        "contributing_app_count",
        "contributing_gl_line_count",
    )


def _amounts_of_two(allocation: DataFrame, first: str, second: str, keys: list[str]) -> DataFrame:
    """Amounts of two versions side by side: one conditional sum, no join."""

    def amount(version: str) -> Column:
        own = F.when(F.col("rule_version") == version, F.col("allocated_amount_eur"))
        return F.coalesce(F.sum(own), F.lit(0)).cast(MONEY).alias(f"amount_{version}")

    both = allocation.where(F.col("rule_version").isin(first, second))
    return both.groupBy(*keys).agg(amount(first), amount(second))


def driver_comparison(
    allocation: DataFrame, dim_business_unit: DataFrame, first: str, second: str
) -> DataFrame:
    """The same ledger under two versions, per business unit. Any two versions may be compared.

    The totals are a window over one row per business unit.
    """
    amounts = _amounts_of_two(allocation, first, second, ["bu_id"])
    one, two = F.col(f"amount_{first}"), F.col(f"amount_{second}")
    wide = "decimal(38,20)"
    zero = F.lit(0).cast(wide)

    def share(amount: Column, total: str) -> Column:
        return F.when(F.col(total) != 0, (amount / F.col(total)).cast(wide)).otherwise(zero)

    everything = W.partitionBy(F.lit(0))
    shared = (
        amounts.withColumn("first_total", F.sum(one).over(everything).cast(MONEY))
        .withColumn("second_total", F.sum(two).over(everything).cast(MONEY))
        .withColumn("delta_eur", (two - one).cast(MONEY))
    )
    no_share = F.lit(0).cast(PCT)
    return shared.join(dim_business_unit, "bu_id", "left").select(
        "bu_id",
        F.coalesce("name", "bu_id").alias("bu_name"),
        one,
        two,
        "delta_eur",
        ratio6(F.col("delta_eur"), one).alias("delta_pct"),
        F.coalesce(ratio6(one, F.col("first_total")), no_share).alias("share_v1"),
        F.coalesce(ratio6(two, F.col("second_total")), no_share).alias("share_v2"),
        F.round(share(two, "second_total") - share(one, "first_total"), 6).cast(PCT).alias("share_delta_pp"),
    )


def driver_comparison_by_app(
    allocation: DataFrame, dim_application: DataFrame, dim_business_unit: DataFrame, first: str, second: str
) -> DataFrame:
    """Two versions compared per application and business unit."""
    amounts = _amounts_of_two(allocation, first, second, ["app_id", "bu_id"])
    apps = dim_application.select("app_id", F.col("name").alias("known_app"))
    units = dim_business_unit.select("bu_id", F.col("name").alias("known_bu"))
    return amounts.join(apps, "app_id", "left").join(units, "bu_id", "left").select(
        "app_id",
        F.coalesce("known_app", "app_id").alias("app_name"),
        "bu_id",
        F.coalesce("known_bu", "bu_id").alias("bu_name"),
        f"amount_{first}",
        f"amount_{second}",
        (F.col(f"amount_{second}") - F.col(f"amount_{first}")).cast(MONEY).alias("delta_eur"),
    )


def top_bu_flip(by_app: DataFrame, first: str, second: str) -> DataFrame:
    """Largest business unit of each application under two versions, and whether it changes.

    Equal amounts go to the smaller id; a version that allocates nothing has no top.
    """

    def top(version: str) -> Column:
        amount = F.col(f"amount_{version}")
        best = F.max(F.when(amount != 0, amount)).over(W.partitionBy("app_id"))
        return F.when(amount == best, F.col("bu_id"))

    ranked = by_app.select("app_id", top(first).alias("first_top"), top(second).alias("second_top"))
    return ranked.groupBy("app_id").agg(
        F.min("first_top").alias("top_bu_v1"), F.min("second_top").alias("top_bu_v2")
    ).withColumn("flipped", ~F.col("top_bu_v1").eqNullSafe(F.col("top_bu_v2")))


def max_share_swing(comparison: DataFrame) -> DataFrame:
    """Largest absolute change of a business unit's share between two versions."""
    return comparison.agg(F.max(F.abs("share_delta_pp")).cast(PCT).alias("max_share_swing"))
