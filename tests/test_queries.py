"""Every registered query against its SQL statement, on the same files."""

import os

import pytest

import __spark_entry__ as contract
import oracle
from millrace.plans import REGISTRY

FOLDER = os.environ.get("MILLRACE_TABLES", "/root/testdata/sf0.001")
WITH_SQL = [name for name, q in REGISTRY.items() if q.oracle is not None]
WITHOUT_SQL = [name for name, q in REGISTRY.items() if q.oracle is None]


@pytest.fixture(scope="module")
def duck():
    return oracle.duck(FOLDER)


@pytest.mark.parametrize("name", WITH_SQL)
def test_same_result_as_sql(spark, duck, name):
    assert oracle.differences(spark, duck, REGISTRY[name], FOLDER) is None


@pytest.mark.parametrize("name", WITHOUT_SQL)
def test_gives_rows(spark, name):
    assert REGISTRY[name].run(spark, FOLDER).count() > 0


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    result = contract.entry(spark)
    assert result.columns == ["p_type", "count"] and result.count() > 0
