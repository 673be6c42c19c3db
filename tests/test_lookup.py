"""Salted joins give the same rows as plain joins, whatever key is hot."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from spendfall.operators.lookup import hot_among_many, hot_keys, lookup_join, salted_join, table_bytes


@pytest.fixture(scope="module")
def sides(spark):
    # A third of the rows share key 0, some have no key, key 3 has two partners.
    left = spark.range(3000).select(
        "id", F.when(F.col("id") < 1000, 0).when(F.col("id") < 1300, None).otherwise(F.col("id") % 50).alias("k")
    )
    right = spark.createDataFrame([(k, f"name {k}") for k in range(0, 40)] + [(3, "other 3")], "k long, name string")
    return left, right


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(sides, how):
    left, right = sides
    salted = salted_join(left, right, ["k"], how, ["id"])
    plain = left.join(right, ["k"], how)
    assert Counter(salted.select(*plain.columns).collect()) == Counter(plain.collect())


def test_hot_key_is_cut_into_even_slices(sides):
    left, _ = sides
    found = {row.k: row.slices for row in hot_keys(left, ["k"], 8).collect()}
    assert 0 in found and found[0] >= 3
    assert len(found) < 8


def test_small_side_is_broadcast_and_large_side_is_not(spark, sides):
    left, right = sides
    small = lookup_join(left, right, ["k"], spread_by=["id"])
    large = lookup_join(left, right, ["k"], spread_by=["id"], broadcast_bytes=10)
    plan = lambda frame: frame._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan(small) and "broadcast" not in plan(large)
    # the left side is read once, and hot keys are left to the adaptive skew join, where there is one
    assert "slice" not in plan(large)
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        salted = lookup_join(left, right, ["k"], spread_by=["id"], broadcast_bytes=10)
        assert "slice" in plan(salted)
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    assert sorted(map(str, salted.collect())) == sorted(map(str, large.collect()))
    assert Counter(small.collect()) == Counter(large.select(*small.columns).collect())
    assert table_bytes(right) > 40 * 20


def test_hot_keys_among_many_are_the_same(sides):
    left, _ = sides
    known = left.where("k IS NOT NULL").selectExpr("CASE WHEN k < 2 THEN k ELSE id END AS k", "id % 2 AS half")
    found, wanted = (sorted(frame.collect()) for frame in (hot_among_many(known, ["k", "half"], 8), hot_keys(known, ["k", "half"], 8)))
    assert found == wanted and len(found) == 2
