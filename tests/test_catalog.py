"""Registered queries beside their SQL on the smallest tables."""

import pytest

import __spark_entry__ as contract
from oracle_check import compare, duck


def test_contract(spark):
    queries, oracles = contract.queries(), contract.oracle_sql()
    assert set(oracles) <= set(queries) and len(queries) > 90
    df = contract.entry(spark)
    assert df.columns == ["n", "errors", "error_rate", "accuracy", "area_under_roc", "area_under_pr"]
    assert df.first().n > 0


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, sf, name):
    verdict, _ = compare(spark, duck(sf), sf, contract.queries()[name], contract.oracle_sql()[name])
    assert verdict == "ok"
