"""Shared session and the 48-line ledger fixture."""

from __future__ import annotations

import csv
import sys
from decimal import Decimal
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from spendfall.operators.conform import conform  # noqa: E402
from spendfall.schemas import CONTRACTS, MONEY_KINDS, bronze_schema  # noqa: E402
from spendfall.session import build_session  # noqa: E402
from spendfall.sources.rule_files import load_rules  # noqa: E402

FIXTURES = Path(__file__).parent / "fixtures"
GL_TOTAL = Decimal("61813.95")


def fixture_rows() -> dict[str, list[tuple]]:
    """The fixed values of ``fixtures/exports``: 48 ledger lines, 64 usage rows, dimensions."""
    rows = {}
    for table, kinds in CONTRACTS.items():
        with (FIXTURES / "exports" / f"{table}.csv").open(encoding="utf-8", newline="") as lines:
            rows[table] = [
                tuple(Decimal(row[name]) if kind in MONEY_KINDS else row[name] or None for name, kind in kinds.items())
                for row in csv.DictReader(lines)
            ]
    return rows


def write_exports(folder: Path, rows: dict[str, list[tuple]] | None = None) -> Path:
    """The fixture as CSV exports."""
    folder.mkdir(parents=True, exist_ok=True)
    for table, lines in (rows or fixture_rows()).items():
        text = [",".join(CONTRACTS[table])]
        text += [",".join("" if value is None else str(value) for value in line) for line in lines]
        (folder / f"{table}.csv").write_text("\n".join(text) + "\n", encoding="utf-8")
    return folder


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "spendfall-tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__memory="4g",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def bronze(spark):
    frames = {}
    for table, rows in fixture_rows().items():
        schema = bronze_schema(table)
        frames[table] = spark.createDataFrame([(*row, f"{table}.csv") for row in rows], schema).cache()
    return frames


@pytest.fixture(scope="session")
def conformed(bronze):
    return conform(bronze)


@pytest.fixture(scope="session")
def silver(conformed):
    return {name: frame.cache() for name, frame in conformed.tables.items()}


@pytest.fixture(scope="session")
def rules():
    return load_rules(FIXTURES / "rules")
