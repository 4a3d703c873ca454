import warnings

import pytest

import __spark_entry__ as contract
from compare import check, connect
from placemill_checks.oracles import ORACLES
from placemill_checks.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    out = contract.entry(spark)
    assert out.columns == ["store_id", "cat", "name", "brand", "src", "prefecture", "lat", "lng"] and out.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        ok, text = check(spark, con, name, SF)
    assert ok, text
