"""Every registered query over the operational tables equals its SQL; the corpus queries have their own tests."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from dockside_checks.compare import database, same
from dockside_checks.oracle import ORACLE
from dockside_checks.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(SF)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= driver.queries().keys() and ORACLE.keys() <= driver.oracle_sql().keys()


def test_entry(spark, con):
    assert driver.entry(spark).count() == con.execute(f"SELECT count(*) FROM ({ORACLE['po_inbound']})").fetchone()[0]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    ok, note = same(spark, con, name, SF)
    assert ok, note
