"""Joins against a table of unknown size on a key that may be heavily skewed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Largest table, in bytes of column data, that is sent whole to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024
# Hashes by which keys are counted, for every part.
HASHES_PER_PART = 16


def row_bytes(frame: DataFrame) -> Column:
    """Size of a row: text by its length, everything else as 16 bytes."""
    parts = [
        F.coalesce(F.octet_length(F.col(name)), F.lit(0)) + F.lit(8) if kind == "string" else F.lit(16)
        for name, kind in frame.dtypes
    ]
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return total.cast("bigint")


def table_bytes(frame: DataFrame) -> int:
    """Bytes of column data, summed where the rows are; one number comes back."""
    return frame.agg(F.coalesce(F.sum(row_bytes(frame)), F.lit(0))).first()[0]


#: What has been measured, by application, plan and files.
_measured: dict[tuple, int] = {}


def known_bytes(frame: DataFrame) -> int:
    """``table_bytes``, measured once for the same query over the same files."""
    key = (frame.sparkSession.sparkContext.applicationId, frame.semanticHash(), tuple(frame.columns), tuple(sorted(frame.inputFiles())))
    if not key[-1]:
        return table_bytes(frame)
    if key not in _measured:
        _measured[key] = table_bytes(frame)
    return _measured[key]


def hot_keys(frame: DataFrame, keys: Sequence[str], parts: int, total: Column | None = None) -> DataFrame:
    """Keys holding more than 1/``parts`` of the rows, and how many slices each needs.

    Fewer than ``parts`` keys can exceed that share, so the result has fewer than
    ``parts`` rows whatever the input, and may always be broadcast. ``total`` is the number
    of rows where ``frame`` holds only some of them.
    """
    counts = frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("key_rows"))
    total = counts.agg(F.sum("key_rows")).scalar() if total is None else total
    return counts.where(F.col("key_rows") * parts > total).select(
        *keys, F.ceil(F.col("key_rows") * parts / total).cast("int").alias("slices")
    )


def hot_among_many(frame: DataFrame, keys: Sequence[str], parts: int) -> DataFrame:
    """:func:`hot_keys` of a stored frame with nearly as many keys as rows, which are not shuffled to be counted.

    Rows are counted by a hash of their key first. A hot key makes its hash hot, so only
    the keys of hot hashes are counted one by one.
    """
    hashed = frame.select(*keys, F.pmod(F.xxhash64(*keys), F.lit(HASHES_PER_PART * parts)).alias("key_hash"))
    hot = F.broadcast(hot_keys(hashed, ["key_hash"], parts).select("key_hash"))
    return hot_keys(hashed.join(hot, "key_hash", "left_semi"), keys, parts, frame.agg(F.count(F.lit(1))).scalar())


def with_slice(left: DataFrame, hot: DataFrame, keys: Sequence[str], spread_by: Sequence[str], parts: int) -> DataFrame:
    """``left`` with the ``slice`` of every row: a hash of ``spread_by`` for keys in ``hot``, 0 for others.

    A repeated task gives the same slice again.
    """
    # A null key matches nothing, so its rows may go anywhere: spread them over all parts.
    without_key = F.lit(False)
    for key in keys:
        without_key = without_key | F.col(key).isNull()
    left_slices = F.when(without_key, F.lit(parts)).otherwise(F.coalesce(F.col("slices"), F.lit(1)))
    return (
        left.join(hot, list(keys), "left")
        .withColumn("slice", F.pmod(F.xxhash64(*spread_by), left_slices.cast("bigint")).cast("int"))
        .drop("slices")
    )


def salted_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, spread_by: Sequence[str]
) -> DataFrame:
    """Shuffle join in which every hot key of ``left`` is cut into even slices.

    The slice of a left row is a hash of ``spread_by``; only the right rows of hot keys
    are repeated, once per slice. ``how`` is ``left``, ``inner``, ``left_semi`` or ``left_anti``.
    """
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(hot_keys(left, keys, parts))
    slices = F.coalesce(F.col("slices"), F.lit(1))
    sliced_left = with_slice(left, hot, keys, spread_by, parts)
    sliced_right = (
        right.join(hot, list(keys), "left")
        .withColumn("slice", F.explode(F.sequence(F.lit(0), slices - 1)))
        .drop("slices")
    )
    return sliced_left.join(sliced_right, [*keys, "slice"], how).drop("slice")


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    *,
    spread_by: Sequence[str],
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join ``left`` to a lookup table: broadcast when it measures small, else by a shuffle.

    The shuffle join reads ``left`` once and leaves hot keys to the adaptive skew join;
    only a session that has it switched off pays for counting keys and salting.
    """
    if known_bytes(right) <= broadcast_bytes:
        return left.join(F.broadcast(right), list(keys), how)
    conf = left.sparkSession.conf
    if all(conf.get(f"spark.sql.adaptive.{name}") == "true" for name in ("enabled", "skewJoin.enabled")):
        return left.join(right, list(keys), how)
    return salted_join(left, right, keys, how, spread_by)
