"""Every query with a SQL equivalent, checked on the smallest tables."""

import re

import pytest

import __spark_entry__ as entry
from tests.checking import compare, duck

SF_DIR = "/root/testdata/sf0.001"
# the language-model operators have their own tests
QUERIES = {name: query for name, query in entry.queries().items() if name != "pipeline" and not re.match(r"op\d+_", name)}
ORACLES = {name: sql for name, sql in entry.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_oracle(spark, con, name):
    assert compare(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None


def test_flagship_entry(spark):
    assert entry.entry(spark).count() > 0
