"""Every registered query against its reference SQL in DuckDB."""

import importlib.util
import sys

import pytest

import __spark_entry__ as contract
from tatemono.queries import QUERIES
from tools.check import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    same, text = compare(spark, duck, SF_DIR, name)
    assert same, text


def test_entry_is_the_mart(spark):
    assert contract.entry(spark).columns == contract.queries()["q_mart"](spark, SF_DIR).columns


def test_every_query_of_the_library_has_a_reference():
    own = {name for name in contract.queries() if name.startswith("q_")}
    assert own == set(QUERIES) and own <= set(contract.oracle_sql())


def test_contract_works_without_the_pipeline_operators(monkeypatch):
    """As in a copy of the library from which they were left out."""
    for name in [n for n in sys.modules if n.startswith("tatemono.llm")] + ["corpus_pipeline", "tatemono.llm"]:
        monkeypatch.setitem(sys.modules, name, None)
    spec = importlib.util.find_spec("__spark_entry__")
    alone = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(alone)
    assert set(alone.queries()) == set(QUERIES) and set(alone.oracle_sql()) == set(alone.queries())
