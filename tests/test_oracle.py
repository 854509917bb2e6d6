"""Every registered query against its SQL on the whole tables."""

import os

import pytest

import __spark_entry__ as contract
import oracle

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


def test_every_query_has_sql():
    """The corpus queries that SQL cannot express have tests of their own."""
    corpus = set(contract.corpus.queries()) if contract.corpus else set()
    assert set(contract.queries()) - corpus == set(contract.oracle_sql()) - corpus


@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_same_rows(spark, con, name):
    rows, difference = oracle.compare(spark, con, contract.queries()[name], contract.oracle_sql()[name], SF_DIR)
    assert not difference
    assert rows > 0


def test_entry(spark):
    assert contract.entry(spark).columns == ["producer_id", "total_sale"]
    assert contract.entry(spark).count() == 10
