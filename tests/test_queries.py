"""Every registered query against its SQL on the driver's tables."""

import os
import re

import pytest
from compare import normal_rows, run_sql

import __spark_entry__ as entry_module

SF_DIR = os.environ.get("KLAXON_TEST_SF", "/root/testdata/sf0.001")
QUERIES = entry_module.queries()
ORACLES = entry_module.oracle_sql()

# Types of the two engines that hold the same values.
SAME_TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not here")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_gives_what_its_sql_gives(spark, name):
    found = QUERIES[name](spark, SF_DIR)
    names, kinds, expected = run_sql(ORACLES[name], SF_DIR)
    assert sorted(found.columns) == sorted(names)
    assert {column: SAME_TYPES[kind] for column, kind in found.dtypes} == kinds
    rows = normal_rows(found.columns, found.collect())
    assert rows == normal_rows(names, expected)
    assert rows or name == "spikes"


def test_every_query_has_its_sql():
    """But for those of the optional package, which are held against plain forms beside it."""
    assert not [n for n in set(QUERIES) - set(ORACLES) if not re.match(r"op\d+_|pipeline$", n)]


def test_every_sql_has_its_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert not entry_module.entry(spark).isEmpty()
