"""Every registered query of the catalogue against its SQL in DuckDB."""

import os

import pytest

import __spark_entry__ as contract
from compare import DATA, differences, duck
from tidemark.plans.catalogue import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", f"{DATA}/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, connection, name):
    result = contract.queries()[name](spark, SF_DIR).toPandas()
    sql = contract.oracle_sql().get(name)
    assert sql is not None, "every query has SQL"
    assert differences(result, connection.sql(sql).df()) is None


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
