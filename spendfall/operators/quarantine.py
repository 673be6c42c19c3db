"""Sound and broken rows of a source, told apart and written in one scan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendfall.operators.contracts import SHOWN, ContractError, with_violations
from spendfall.schemas import CONTRACTS


@dataclass(frozen=True)
class Checked:
    """The rows of one source, read back from where they were written, and their numbers."""

    table: str
    path: str
    sound: DataFrame
    broken: DataFrame
    row_count: int
    broken_count: int


def split_sound(raw: DataFrame, table: str, folder: str) -> Checked:
    """Write ``raw`` to ``folder``/``table``, broken rows apart with the codes of all rules they break.

    Rows are counted while they are written, so the source is read once and nobody has to
    look twice to know whether it is sound.
    """
    counts = Observation(f"contract of {table}")
    checked = with_violations(raw, table).withColumn("broken", F.size("violations") > 0)
    watched = checked.observe(counts, F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("broken"), 1)).alias("broken"))
    path = f"{folder}/{table}"
    watched.write.mode("overwrite").partitionBy("broken").parquet(path)
    schema = T.StructType([T.StructField(field.name, field.dataType) for field in checked.schema])
    rows = raw.sparkSession.read.schema(schema).parquet(path)
    found = counts.get
    return Checked(table, path, rows.where("NOT broken").drop("broken", "violations"), rows.where("broken").drop("broken"), found["rows"], found["broken"])


def require_none_broken(sources: list[Checked]) -> None:
    """Raise if any source has broken rows: how many, the first few, and where all of them are."""
    lines = []
    for source in sources:
        if source.broken_count:
            lines.append(f"{source.table}: {source.broken_count} of {source.row_count} rows, kept in {source.path}/broken=true")
            shown = source.broken.select("violations", F.to_json(F.struct(*CONTRACTS[source.table])).alias("row_json")).limit(SHOWN).collect()
            lines += [f"  {', '.join(row.violations)} in {row.row_json}" for row in shown]
    if lines:
        raise ContractError("Source contract broken.\n" + "\n".join(lines))
