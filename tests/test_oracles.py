"""Every registered query against its oracle, at the smallest scale."""

import pytest

import __spark_entry__ as entry
from checks.catalog import ORACLES, QUERIES
from checks.compare import differ, oracle


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle(sf_dir)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_oracle(spark, con, sf_dir, name):
    problem, _ = differ(spark, con, name, sf_dir, QUERIES, ORACLES)
    assert problem is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
