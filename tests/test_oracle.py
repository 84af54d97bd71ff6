"""Every registered query of the sales marts against its DuckDB oracle at
sf0.001 (the driver's check, run locally)."""
from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.conftest import SF0001, need_testdata
from tests.oracle_compare import compare, duck

NAMES = list(entry._QUERIES)


@pytest.fixture(scope="module")
def con():
    need_testdata()
    return duck(SF0001)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    result = compare(spark, name, SF0001, con)
    assert result["status"] == "MATCH", result


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(entry.oracle_sql())


def test_every_gate_is_failed_somewhere(con):
    rows = con.execute(entry.oracle_sql()["gate_report_dirty"]).fetchall()
    assert len(rows) == 28 and all(bad > 0 for _, _, bad in rows)
