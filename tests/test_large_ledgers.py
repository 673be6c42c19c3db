"""What is worked out for every end point stays small, and end points are not shuffled."""

from __future__ import annotations

import time
from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from spendfall.operators import cascade as cas
from spendfall.operators import lineage as lin
from spendfall.plans.star_queries import Model, star_queries
from spendfall.session import materialize


def _plan(frame) -> str:
    return frame._jdf.queryExecution().toString()


def _same(one, two) -> bool:
    return one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()


def _ends(silver, rules, gl):
    return cas.run_cascade(gl, cas.split_table(silver["fact_usage_metric"], silver["dim_resource_tower"], rules), rules)


def test_the_drift_bound_needs_no_amount_without_declared_proportions(spark):
    shares = [("1", "1", "1", "0"), ("1", "0.5", "1", "0.01"), ("1", "1", "0.25", "0.01"), ("1", "0.5", "0.25", "0.0125"), ("0.5", "0.2", "0.1", "0.0112")]
    rows = spark.createDataFrame([tuple(map(Decimal, row)) for row in shares], ", ".join(f"{c} decimal(18,12)" for c in (*lin.HOP_SHARES.values(), "expected")))
    assert rows.where(lin.drift_bound() != F.col("expected")).isEmpty()


def test_the_rows_of_the_example_are_picked_by_a_broadcast(spark, silver, rules):
    edges = lin.lineage(_ends(silver, rules, silver["fact_gl_cost"]), silver["fact_gl_cost"], silver["dim_cost_center"])
    joins = [line for line in _plan(lin.example_rows(edges, "CC-NONE")).split("== Physical Plan ==")[1].splitlines() if "LeftSemi" in line]
    assert joins and all("BroadcastHashJoin" in line for line in joins)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joins = [line for line in _plan(lin.example_rows(edges, "CC-NONE")).split("== Physical Plan ==")[1].splitlines() if "LeftSemi" in line]
        assert joins and all("BroadcastHashJoin" in line for line in joins)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_names_are_carried_from_the_ledger(spark, silver, rules):
    gl, centers = silver["fact_gl_cost"], silver["dim_cost_center"]
    named = lin.with_names(gl, centers)
    plain, ends = _ends(silver, rules, gl), _ends(silver, rules, named)
    edges = lin.lineage(ends, gl, centers)
    assert _same(edges, lin.lineage(plain, gl, centers))
    stored = cas.ends_of(cas.allocation(ends), cas.residual(ends))
    assert _same(edges, lin.lineage(stored, named, centers))
    assert len(_plan(edges).split("== Analyzed")[1].split("Join")) == len(_plan(ends).split("== Analyzed")[1].split("Join"))


def test_the_ledger_is_cut_into_slices_of_a_bounded_number_of_lines(spark):
    lines = spark.range(1000).select(F.col("id").cast("string").alias("gl_line_id"))
    assert cas.spread_lines(lines, 1000).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert cas.spread_lines(lines, 20 * cas.LINES_PER_TASK + 1).rdd.getNumPartitions() == 21


def _shuffle_files(spark) -> int:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("|")
    return sum("/shuffle_" in name for name in files.split("|"))


def test_a_stored_table_leaves_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    stored = materialize(spark.range(1000).groupBy((F.col("id") % 100).alias("k")).count())
    until = time.time() + 10
    while (left := _shuffle_files(spark)) > before and time.time() < until:
        time.sleep(0.2)
    assert left <= before and stored.count() == 100


def _write_star(spark, folder) -> None:
    """Star tables of a few rows, with two orders of the same key and one without."""
    rows = {
        "region": ("r_regionkey int, r_name string", [(0, "EUROPE"), (1, "ASIA")]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "N0", 0), (1, "N1", 1)]),
        "customer": ("c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string", [(k, f"C{k}", k % 2, 10.0 - 5 * k, ("BUILDING", "MACHINERY")[k % 2]) for k in range(4)]),
        "supplier": ("s_suppkey long, s_name string, s_nationkey int, s_acctbal double", [(k, f"S{k}", k % 2, 1.0) for k in range(3)]),
        "part": ("p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double", [(k, f"P{k}", "B", ("SMALL", "LARGE", "PROMO")[k], 1, 1.0) for k in range(3)]),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string", [(k, j % 4, "O", 10.07 * (j + 1), datetime(2024, 1 + j % 12, 3), "1-URGENT") for j, k in enumerate([*range(20), 7, None])]),
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, l_shipdate timestamp_ntz", [(k % 20, k % 3, k % 2, 1.0 + k % 5, datetime(2024, 2, 1)) for k in range(60)]),
    }
    for name, (schema, values) in rows.items():
        spark.createDataFrame(values, schema).write.parquet(f"{folder}/{name}.parquet")


def test_end_points_of_the_lineage_report_stay_with_their_lines(spark, tmp_path):
    _write_star(spark, tmp_path)
    report = star_queries()["report_lineage"](spark, str(tmp_path))
    lines = _plan(report).split("== Physical Plan ==")[1].splitlines()
    names = [(len(line) - len(line.lstrip(" :+-")), line.lstrip(" :+-").split()[0]) for line in lines if line.strip(" :+-")]
    union = next(i for i, (_, name) in enumerate(names) if name == "Union")
    depth, above = names[union][0], []
    for indent, name in reversed(names[:union]):
        if indent < depth:
            depth = indent
            above.append(name)
    assert any("Join" in name for name in above) and not {"Exchange", "Sort"} & set(above)
    model = Model(spark, str(tmp_path))
    wanted = lin.lineage(cas.ends_of(model.allocation, model.residual), model.gl, model.silver["dim_cost_center"])
    assert report.columns == wanted.columns and _same(report, wanted) and not report.isEmpty()
    twice = "gl_line_id = 'GL-7'"
    assert report.where(twice).count() == 2 * model.ends.where(twice).count() > 0
