"""Every registered query beside its SQL on the smallest tables."""

import os

import pytest

from __spark_entry__ import entry
from checks.sql import ORACLE_SQL
from checks.compare import compare, duck
from pressloom.plans.catalog import queries

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are absent")
# The overlap ratio of these two has no SQL equivalent.
ROWS_ONLY = {"event_facts", "fact_overlap"}


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql_unless_listed():
    assert set(queries()) - set(ORACLE_SQL) == ROWS_ONLY
    assert set(ORACLE_SQL) <= set(queries())


@pytest.mark.parametrize("name", list(queries()))
def test_query_matches_sql(spark, con, name):
    ok, note = compare(spark, name, queries()[name], ORACLE_SQL.get(name), SF_DIR, con)
    assert ok is not False, note


def test_entry(spark):
    assert "market" in entry(spark).columns
