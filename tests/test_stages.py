"""Stages from CSV exports to reports, with their gates."""

from __future__ import annotations

import json
import shutil
from pathlib import Path

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import FIXTURES, GL_TOTAL, fixture_rows, write_exports
from spendfall.operators.contracts import ContractError
from spendfall.operators.quality import QualityError
from spendfall.plans import build
from spendfall.schemas import CONTRACTS, SILVER_TABLES
from spendfall.sources.csv_exports import HeaderError, check_header, scan_csv
from spendfall.sources import tables
from spendfall.sources.tables import MissingTable, publish, read_table, write_table

V1, V2 = "v1_transactions", "v2_named_users"


def _folders(root: Path) -> build.Folders:
    return build.Folders(
        source=str(write_exports(root / "source")),
        bronze=str(root / "bronze"),
        silver=str(root / "silver"),
        gold=str(root / "gold"),
        rules=str(FIXTURES / "rules"),
        examples=str(root / "examples"),
    )


def _run(spark, folders, target=None):
    return build.run_stages(
        spark,
        folders,
        control_total=GL_TOTAL,
        default_version=V1,
        compared=(V1, V2),
        target=target,
        example_cost_center="CC-LEGACY",
    )


@pytest.fixture(scope="module")
def finished(spark, tmp_path_factory):
    folders = _folders(tmp_path_factory.mktemp("stages"))
    assert _run(spark, folders) == list(build.STAGES)
    return folders


def test_bronze_keeps_rows_types_and_file_names(spark, finished):
    for table, rows in fixture_rows().items():
        frame = read_table(spark, finished.bronze, table)
        assert frame.count() == len(rows)
        assert frame.columns == [*CONTRACTS[table], "_source_file"]
        assert {r[0] for r in frame.select("_source_file").distinct().collect()} == {f"{table}.csv"}
    ledger = read_table(spark, finished.bronze, "gl_costs")
    assert ledger.agg(F.sum("amount_eur")).first()[0] == GL_TOTAL
    assert read_table(spark, finished.bronze, "cost_centers").where("tower_id IS NULL").count() == 1


def test_gold_holds_only_the_chosen_version(spark, finished):
    allocation = read_table(spark, finished.gold, "allocation")
    assert {r[0] for r in allocation.select("rule_version").distinct().collect()} == {V1}
    assert allocation.count() == 24
    totals = read_table(spark, finished.gold, "reconciliation").first()
    assert totals.balanced and str(totals.total_residual_eur) == "58245.81"


def test_reports_are_written(spark, finished):
    compared = {r.bu_id: r for r in read_table(spark, finished.gold, "report_driver_comparison").collect()}
    assert str(compared["BU-RETAIL"].share_delta_pp) == "-0.499432"
    assert read_table(spark, finished.gold, "report_driver_comparison_by_app").count() == 12
    assert read_table(spark, finished.gold, "report_lineage").count() == read_table(spark, finished.gold, "lineage").count()
    for table in ("report_application_tco", "report_bu_showback", "report_residual"):
        assert read_table(spark, finished.gold, table).count() > 0
    written = [p for p in Path(finished.examples, "lineage_worked_example").glob("*.json")]
    document = json.loads(json.loads(written[0].read_text())["example_json"])
    assert document["allocated_example"]["gl_line_id"] == "GL-000009"


def test_second_version_joins_the_first(spark, finished):
    rules = build.load_rules(finished.rules).only(V2)
    before = sorted(map(str, read_table(spark, finished.gold, "allocation").collect()))
    build.allocate(spark, finished.silver, finished.gold, rules)
    after = read_table(spark, finished.gold, "allocation")
    assert sorted(map(str, after.where(F.col("rule_version") == V1).collect())) == before
    assert after.where(F.col("rule_version") == V2).count() == 96
    build.allocate(spark, finished.silver, finished.gold, rules)
    assert read_table(spark, finished.gold, "allocation").count() == 120


def test_malformed_export_writes_nothing(spark, tmp_path):
    source = write_exports(tmp_path / "source")
    bronze = tmp_path / "bronze"
    with pytest.raises(ContractError, match="cost_center_id:required, amount_eur:not_a_number"):
        build.ingest(spark, str(source), str(bronze), {"gl_costs": str(FIXTURES / "gl_costs_malformed.csv")})
    assert not bronze.exists()


def test_conflicting_dimension_writes_no_silver(spark, tmp_path):
    source = write_exports(tmp_path / "source")
    build.ingest(spark, str(source), str(tmp_path / "bronze"), {"cost_centers": str(FIXTURES / "cost_centers_conflict.csv")})
    with pytest.raises(QualityError, match="dim_cost_center_conflicting_pk"):
        build.build_silver(spark, str(tmp_path / "bronze"), str(tmp_path / "silver"), GL_TOTAL)
    assert not (tmp_path / "silver").exists()


def test_header_must_match_in_names_and_order(spark, tmp_path):
    path = tmp_path / "business_units.csv"
    path.write_text("bu_name,bu_id\nCorp,BU-CORP\n")
    with pytest.raises(HeaderError, match="has the header"):
        check_header(spark, str(path), "business_units")
    path.write_text("")
    with pytest.raises(HeaderError, match="empty"):
        check_header(spark, str(path), "business_units")
    with pytest.raises(FileNotFoundError):
        check_header(spark, str(tmp_path / "none.csv"), "business_units")


def test_second_file_of_a_folder_is_checked_too(spark, tmp_path):
    folder = tmp_path / "business_units.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("bu_id,bu_name\nBU-A,Alpha\n")
    (folder / "b.csv").write_text("bu_name,bu_id\nBeta,BU-B\n")
    with pytest.raises(Exception, match="(?i)header|column"):
        scan_csv(spark, str(folder), "business_units").collect()


def test_broken_rows_stay_in_quarantine(spark, tmp_path):
    source, bronze, kept = write_exports(tmp_path / "source"), tmp_path / "bronze", tmp_path / "kept"
    broken = {"gl_costs": str(FIXTURES / "gl_costs_malformed.csv")}
    with pytest.raises(ContractError, match="(?s)gl_costs: [0-9]+ of [0-9]+ rows, kept in .*cost_center_id:required, amount_eur:not_a_number"):
        build.ingest(spark, str(source), str(bronze), broken, quarantine_dir=str(kept))
    assert not bronze.exists()
    rows = spark.read.parquet(f"{kept}/gl_costs").collect()
    assert rows and all(r.broken and r.violations and r._source_file for r in rows)
    assert sorted(p.name for p in kept.iterdir()) == ["gl_costs"]
    written = build.ingest(spark, str(source), str(bronze), quarantine_dir=str(tmp_path / "none"))
    plain = build.ingest(spark, str(source), str(tmp_path / "plain"))
    for table, path in written.items():
        same = read_table(spark, str(bronze), table)
        assert same.schema == read_table(spark, str(tmp_path / "plain"), table).schema
        assert sorted(map(str, same.collect())) == sorted(map(str, spark.read.parquet(plain[table]).collect()))
    assert not list((tmp_path / "none").iterdir())


def test_line_breaks_in_quoted_cells_are_read_by_the_stage(spark, tmp_path):
    source = write_exports(tmp_path / "source")
    path = tmp_path / "units.csv"
    path.write_text('bu_id,bu_name\nBU-A,"Alpha\nand more"\n')
    build.ingest(spark, str(source), str(tmp_path / "bronze"), {"business_units": str(path)}, multi_line=True)
    assert [r.bu_name for r in read_table(spark, str(tmp_path / "bronze"), "business_units").collect()] == ["Alpha\nand more"]


@pytest.mark.parametrize("step", ["write", "rename"])
def test_a_failure_at_the_fourth_table_leaves_all_six(spark, tmp_path, monkeypatch, step):
    source, bronze = write_exports(tmp_path / "source"), tmp_path / "bronze"
    build.ingest(spark, str(source), str(bronze))
    before = {p.relative_to(bronze): p.read_bytes() for p in bronze.rglob("*") if p.is_file()}
    frames = {table: read_table(spark, str(bronze), table).limit(1) for table in CONTRACTS}
    if step == "write":
        fourth = list(frames)[3]
        frames[fourth] = frames[fourth].withColumn(frames[fourth].columns[0], F.raise_error(F.lit("lost")).cast("string"))
    else:
        real = tables.write_table

        def without_fourth(frame, folder, table):
            path = real(frame, folder, table)
            if table == list(frames)[3]:
                shutil.move(path, f"{path}-gone")
            return path

        monkeypatch.setattr(tables, "write_table", without_fourth)
    with pytest.raises(Exception, match="lost|renamed|FileNotFound|does not exist"):
        publish(frames, str(bronze))
    assert {p.relative_to(bronze): p.read_bytes() for p in bronze.rglob("*") if p.is_file()} == before


def test_quoted_cells_and_extra_cells(spark, tmp_path):
    path = tmp_path / "business_units.csv"
    path.write_text('bu_id,bu_name\nBU-A,"Alpha, ""the"" first"\nBU-B,""\n')
    rows = {r.bu_id: r.bu_name for r in scan_csv(spark, str(path), "business_units").collect()}
    assert rows == {"BU-A": 'Alpha, "the" first', "BU-B": None}
    source = write_exports(tmp_path / "source")
    wide = tmp_path / "wide.csv"
    wide.write_text("bu_id,bu_name\nBU-A,Alpha,surplus\n")
    with pytest.raises(ContractError, match="row:malformed"):
        build.ingest(spark, str(source), str(tmp_path / "bronze"), {"business_units": str(wide)})


def test_missing_table_is_named(spark, tmp_path):
    with pytest.raises(MissingTable, match="fact_gl_cost"):
        build.allocate(spark, str(tmp_path), str(tmp_path / "gold"), build.load_rules(FIXTURES / "rules"))


def test_stage_selection():
    assert build.stages_to_run(None) == list(build.STAGES)
    assert build.stages_to_run("silver") == ["bronze", "silver"]
    assert build.stages_to_run("lineage") == ["lineage"]
    with pytest.raises(ValueError, match="no stage"):
        build.stages_to_run("synth")


def test_written_rows_are_sorted(spark, tmp_path):
    frame = spark.createDataFrame([("B", "b"), ("A", "a")], "bu_id string, name string").coalesce(1)
    write_table(frame, str(tmp_path), "dim_business_unit")
    assert [r.bu_id for r in read_table(spark, str(tmp_path), "dim_business_unit").collect()] == ["A", "B"]
    assert set(SILVER_TABLES) >= {"dim_business_unit"}


def test_replaced_versions_leave_no_old_rows(spark, tmp_path):
    """A version without rows any more is emptied; an empty table can be read; ids stay text."""
    folder, rows = str(tmp_path), "gl_line_id string, failed_step string, reason_code string, amount_eur decimal(18,2), rule_version string"
    empty = spark.createDataFrame([], rows)
    write_table(empty, folder, "residual", versions=["01"])
    assert read_table(spark, folder, "residual").count() == 0
    two = spark.createDataFrame([("G1", "s", "r", Decimal("1.00"), "01"), ("G2", "s", "r", Decimal("2.00"), "1")], rows)
    write_table(two, folder, "residual", versions=["01", "1"])
    stored = read_table(spark, folder, "residual")
    assert stored.schema == two.schema
    assert [r.gl_line_id for r in stored.where("rule_version = '01'").collect()] == ["G1"]
    write_table(two.where("rule_version = '01'"), folder, "residual", versions=["01"])
    assert read_table(spark, folder, "residual").count() == 2
    write_table(empty, folder, "residual", versions=["01"])
    assert [r.rule_version for r in read_table(spark, folder, "residual").collect()] == ["1"]
