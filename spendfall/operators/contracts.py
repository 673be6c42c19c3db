"""Field contracts of the source tables as row predicates that collect every violation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendfall.functions.text import strip
from spendfall.schemas import CONTRACTS, ENUMS, MONEY, MONEY_KINDS, PATTERNS

_NUMBER = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_TOO_FINE = r"\.[0-9]{2}[0-9]*[1-9][0-9]*$"


class ContractError(ValueError):
    """Source rows break their contract; nothing has been written."""


def _money_checks(name: str, kind: str) -> list[Column]:
    text = strip(F.col(name).cast("string"))
    number = F.coalesce(text.rlike(_NUMBER), F.lit(False))
    # Text with more than two significant decimals is refused, not rounded.
    exact = F.expr(f"try_cast(trim({name}) as decimal(38,18))")
    vanished = (exact == 0) & text.rlike("^[^eE]*[1-9]")
    fits = F.coalesce(~text.rlike(_TOO_FINE) & (exact == F.round(exact, 2)) & ~vanished, F.lit(False))
    in_range = F.coalesce(F.abs(exact) < F.lit(10**16).cast("decimal(38,18)"), F.lit(False))
    low = exact <= 0 if kind == "money_positive" else exact < 0
    return [
        F.when(~number, F.lit(f"{name}:not_a_number")),
        F.when(number & ~(fits & in_range), F.lit(f"{name}:not_whole_cents")),
        F.when(number & F.coalesce(low, F.lit(False)), F.lit(f"{name}:out_of_range")),
    ]


def _field_checks(name: str, kind: str) -> list[Column]:
    column = F.col(name)
    if kind in MONEY_KINDS:
        return _money_checks(name, kind)
    if kind == "required":
        return [F.when(F.coalesce(F.length(strip(column)), F.lit(0)) == 0, F.lit(f"{name}:required"))]
    if kind == "optional":
        return [F.when(column.isNotNull() & (F.length(strip(column)) == 0), F.lit(f"{name}:blank"))]
    if kind in PATTERNS:
        return [F.when(~F.coalesce(column.rlike(PATTERNS[kind]), F.lit(False)), F.lit(f"{name}:pattern"))]
    allowed = F.coalesce(column.isin(*ENUMS[kind]), F.lit(False))
    return [F.when(~allowed, F.lit(f"{name}:not_allowed"))]


def with_violations(raw: DataFrame, table: str) -> DataFrame:
    """Add ``violations``: one code per broken rule of the row, empty when it is sound."""
    checks = [check for name, kind in CONTRACTS[table].items() for check in _field_checks(name, kind)]
    if "_malformed" in raw.columns:
        checks.append(F.when(F.col("_malformed").isNotNull(), F.lit("row:malformed")))
    return raw.withColumn("violations", F.array_compact(F.array(*checks)))


def violation_rows(raw: DataFrame, table: str) -> DataFrame:
    """The broken rows of one table as (table, file, row as JSON, violations)."""
    names = list(CONTRACTS[table])
    source = F.col("_source_file") if "_source_file" in raw.columns else F.lit(None).cast("string")
    return (
        with_violations(raw, table)
        .where(F.size("violations") > 0)
        .select(
            F.lit(table).alias("table_name"),
            source.alias("source_file"),
            F.to_json(F.struct(*names)).alias("row_json"),
            "violations",
        )
    )


def violations(raws: Mapping[str, DataFrame]) -> DataFrame:
    """Broken rows of all tables in one DataFrame, so that one action decides."""
    parts = [violation_rows(raw, table) for table, raw in raws.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def violation_counts(raw: DataFrame, table: str) -> DataFrame:
    """How often each rule of one table is broken."""
    return (
        with_violations(raw, table)
        .select(F.explode("violations").alias("violation"))
        .groupBy("violation")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(table).alias("table_name"), "violation", "row_count")
    )


# Broken rows that an error shows; their number is always told.
SHOWN = 5


def require_sound(raws: Mapping[str, DataFrame]) -> None:
    """Raise with the first few broken rows, if there are any."""
    broken = violations(raws)
    shown = broken.limit(SHOWN).collect()
    if shown:
        lines = [f"{row.source_file or row.table_name}: {', '.join(row.violations)} in {row.row_json}" for row in shown]
        more = broken.count() - len(shown)
        lines += [f"and {more} more"] * (more > 0)
        raise ContractError("Source contract broken.\n" + "\n".join(lines))


def typed(raw: DataFrame, table: str) -> DataFrame:
    """Text columns stripped, money as decimal(18,2), in contract order plus the file name."""
    columns = []
    for name, kind in CONTRACTS[table].items():
        if kind in MONEY_KINDS:
            columns.append(F.expr(f"try_cast(trim({name}) as decimal(18,2))").cast(MONEY).alias(name))
        elif kind in ("required", "optional"):
            columns.append(strip(F.col(name)).alias(name))
        else:
            columns.append(F.col(name))
    if "_source_file" in raw.columns:
        columns.append(F.col("_source_file"))
    return raw.select(*columns)
