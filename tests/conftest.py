from __future__ import annotations

import csv
import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

FIXTURES = ROOT / "tests" / "fixtures"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from martflow.session import local_session

    session = local_session("*", 8)  # otherwise Spark's own settings
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def read_rows(name: str, table: str) -> list[dict]:
    with open(FIXTURES / name / f"{table}.csv", newline="", encoding="utf-8") as f:
        return list(csv.DictReader(f))


def ods_from_rows(spark, users, orders, items):
    """ODS from in-memory text rows, with the CSV source's rules (empty -> NULL)."""
    from martflow.schema import (
        ITEMS_COLUMNS,
        ODS_ITEMS_TYPES,
        ODS_ORDERS_TYPES,
        ORDERS_COLUMNS,
        USERS_COLUMNS,
        conform,
        text_schema,
    )
    from martflow.sources.ods_csv import Ods

    def frame(rows, cols):
        data = [tuple((r.get(c) or None) for c in cols) for r in rows]
        return spark.createDataFrame(data, text_schema(cols))

    return Ods(
        frame(users, USERS_COLUMNS),
        conform(frame(orders, ORDERS_COLUMNS), ODS_ORDERS_TYPES),
        conform(frame(items, ITEMS_COLUMNS), ODS_ITEMS_TYPES),
    )


@pytest.fixture
def good_dir() -> str:
    return str(FIXTURES / "good")


@pytest.fixture
def window_dir() -> str:
    return str(FIXTURES / "window")


def need_testdata():
    if not os.path.exists(f"{SF0001}/orders.parquet"):
        pytest.skip("driver test data not present")
