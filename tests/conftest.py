from __future__ import annotations

import sys
from datetime import date
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from dockside.session import local_session, scratch_path, scratch_tables  # noqa: E402
from dockside.sources.inputs import SourceTables  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", "4", 4)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(autouse=True)
def closed_scratch(request):
    """Scratch tables of a test go with it."""
    if "spark" not in request.fixturenames:
        yield
        return
    with scratch_tables(request.getfixturevalue("spark")):
        yield


@pytest.fixture
def database(spark):
    """Name of a database of its own, with a folder of its own."""
    path = scratch_path(spark, "test")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    return name


SCHEMAS = {
    "pohdr": "po string, po_man string, pocode string, postr bigint, dateexp date, datecanc date, dateship date",
    "potype": "po string, type string",
    "podtl": "po string, sku string, oounit bigint, rcunit bigint",
    "skufile": "sku string, style string, skudesc1 string, ss string, vend bigint",
    "vendmain": "vend bigint, vendname string",
    "purhst": "po string, str bigint, datercv date",
    "invdtl": "po string, sku string, unitinvc bigint",
    "asnhdr": "asn bigint, po string, str bigint, shpnotcdt date",
    "asndtl": "asn bigint, sku string, qty bigint",
    "wim": "genasn bigint, po string",
}


@pytest.fixture
def tables(spark):
    """Builder of source tables from rows; unnamed tables get one plain set."""

    def build(**rows) -> SourceTables:
        given = {
            "pohdr": [("A", "M1", "O", 110, date(2024, 1, 20), date(2024, 2, 20), date(2024, 1, 15))],
            "potype": [("A", "P")],
            "podtl": [("A", "k1", 10, 4)],
            "skufile": [("k1", "st", "desc", "s1", 1), ("k2", "st2", "desc2", "s2", 1)],
            "vendmain": [(1, "ACME")],
            **rows,
        }
        frames = {name: spark.createDataFrame(given.get(name, []), schema) for name, schema in SCHEMAS.items()}
        return SourceTables(**frames)

    return build
