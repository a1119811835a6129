"""Registered llm queries against their SQL on the shared tables."""

import pytest
from comparing import compare, duck

import __spark_entry__ as contract
from plantpulse.llm import catalog


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_same_rows(spark, sf_dir, con, name):
    assert compare(spark, con, sf_dir, catalog.queries()[name], catalog.oracle_sql()[name]) == ""


def test_all_are_registered():
    found = contract.queries()
    assert set(catalog.queries()) | {"pipeline"} <= set(found)
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in catalog.queries()}
