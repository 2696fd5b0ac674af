"""Every registered query against its SQL twin, at the smallest scale."""

import pytest

import __spark_entry__
from suite.compare import difference, duck
from suite.registry import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    frame = QUERIES[name](spark, SF)
    assert difference(frame, con, ORACLE[name]) is None


def test_every_query_has_a_twin():
    assert set(ORACLE) == set(QUERIES)


def test_contract_lists_them_all():
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(ORACLE) <= set(__spark_entry__.oracle_sql())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
