"""Every registered query against its SQL counterpart on the smallest data folder."""

import pytest

import __spark_entry__ as contract
import check


@pytest.fixture(scope="module")
def duck(data):
    return check.connect(data)


def test_every_query_has_sql():
    assert set(contract.QUERIES) == set(contract.ORACLES)


@pytest.mark.parametrize("name", sorted(contract.QUERIES))
def test_query_matches_sql(spark, duck, data, name):
    same, note = check.compare(spark, duck, contract.queries()[name], contract.oracle_sql()[name], data)
    assert same, note


def test_entry_is_the_flagship(spark):
    digests = contract.entry(spark)
    assert digests.count() > 0
    assert {"user_id", "recipient", "subject", "n_matches"} <= set(digests.columns)
