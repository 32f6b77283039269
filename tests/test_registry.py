import pytest
from oracle import compare, connect

import __spark_entry__ as entry_module
from shoalmark.registry import MODULES

FOLDER = "/root/testdata/sf0.001"
QUERIES = {k: run for module in MODULES for k, run in module.QUERIES.items()}
ORACLES = {k: text for module in MODULES for k, text in module.ORACLES.items()}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    same, note = compare(QUERIES[name](spark, FOLDER), con, ORACLES[name])
    assert same, note


def test_all_are_registered():
    assert QUERIES.items() <= entry_module.queries().items()
    assert ORACLES.items() <= entry_module.oracle_sql().items()


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
