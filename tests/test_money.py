"""Whole-number arithmetic against Python integers, up to the largest storable amount."""

from __future__ import annotations

import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from spendfall.functions.money import from_cents, from_units, ratio6, split_floor, split_remainder, to_cents

ONE = 10**12


def test_split_is_exact_for_every_storable_amount(spark):
    generator = random.Random(7)
    largest = 10**18 - 1
    pairs = [(largest, ONE), (largest, ONE - 1), (largest, 1), (0, ONE), (1, 1), (5, ONE // 3)]
    pairs += [(generator.randint(0, largest), generator.randint(0, ONE)) for _ in range(300)]
    rows = (
        spark.createDataFrame(pairs, "cents long, units long")
        .selectExpr("*", split_floor("cents", "units") + " AS floor", split_remainder("cents", "units") + " AS rest")
        .collect()
    )
    for row in rows:
        assert (row.floor, row.rest) == divmod(row.cents * row.units, ONE)


def test_money_and_shares_round_trip(spark):
    row = (
        spark.createDataFrame([(Decimal("9999999999999999.99"), ONE // 3)], "amount decimal(18,2), units long")
        .select(to_cents(F.col("amount")).alias("cents"), from_cents(to_cents(F.col("amount"))).alias("amount"), from_units(F.col("units")).alias("share"))
        .first()
    )
    assert row.cents == 10**18 - 1
    assert row.amount == Decimal("9999999999999999.99")
    assert row.share == Decimal("0.333333333333")


def test_ratio_rounds_half_up_and_away_from_zero(spark):
    cases = [("0.01", "0.03"), ("1.00", "8.00"), ("-1.00", "3.00"), ("1.00", "-1600000.00"), ("0.05", "100000.00"), ("-0.05", "100000.00")]
    rows = (
        spark.createDataFrame([(Decimal(a), Decimal(b)) for a, b in cases], "a decimal(18,2), b decimal(18,2)")
        .select("a", "b", ratio6(F.col("a"), F.col("b")).alias("r"))
        .collect()
    )
    for row in rows:
        assert row.r == (row.a / row.b).quantize(Decimal("0.000001"), ROUND_HALF_UP)
    empty = spark.createDataFrame([(Decimal(1), Decimal(0))], "a decimal(18,2), b decimal(18,2)")
    assert empty.select(ratio6(F.col("a"), F.col("b"))).first()[0] is None
