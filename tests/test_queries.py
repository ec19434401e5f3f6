"""Every query against its SQL, and the contract of the entry file."""

import duckdb
import pytest

import __spark_entry__ as contract
from catalog.queries import QUERIES
from check_oracles import open_tables, same_rows
from conftest import SF_DIR


@pytest.fixture(scope="module")
def duck():
    return open_tables(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.oracle_sql())


def test_entry_is_the_training_data(spark):
    df = contract.entry(spark)
    assert df.columns == ["example_id", "source", "input", "output"]
    assert df.count() == 21


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = contract.queries()[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("EvalPython", "InPandas", "CartesianProduct"):
        assert operator not in plan
    same, detail = same_rows(df, duck.execute(contract.oracle_sql()[name]))
    assert same, detail
