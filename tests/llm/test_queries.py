"""The operators' registered queries against their reference SQL in DuckDB."""

import pytest

import __spark_entry__ as contract
from tatemono.llm.queries import ORACLES, QUERIES
from tools.check import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query(spark, duck, name):
    same, text = compare(spark, duck, SF_DIR, name)
    assert same, text


def test_the_contract_has_the_operators_and_the_pipeline():
    assert {*QUERIES, "pipeline"} <= set(contract.queries())
    assert [q.split("_")[0] for q in QUERIES] == [f"op{n}" for n in range(1, 14)]
