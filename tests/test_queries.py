"""Every registered query against DuckDB on the smallest data folder."""

import os
import warnings

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.catalog import QUERIES
from checks.compare import compare, duck

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are missing")


def test_entry(spark):
    assert entry(spark).count() == 1


def test_every_query_has_sql():
    assert set(QUERIES) <= set(queries())
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    result = queries()[name](spark, FOLDER).toArrow()
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        expected = duck(FOLDER).execute(oracle_sql()[name]).to_arrow_table()
    assert compare(result, expected) == []
