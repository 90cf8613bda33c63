"""Every registered query against its SQL on the small tables."""

import pytest

import __spark_entry__ as entry
from tests.harness import difference, duck

QUERIES, STATEMENTS = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    return duck(folder)


def test_statements_belong_to_queries():
    assert set(STATEMENTS) <= set(QUERIES)


def test_flagship(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["year", "segment", "revenue", "place"]
    assert frame.count() > 0


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_same_as_sql(spark, con, folder, name):
    result = QUERIES[name](spark, folder)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert difference(result.toPandas(), con.execute(STATEMENTS[name]).df()) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(STATEMENTS)))
def test_without_sql_gives_rows(spark, folder, name):
    assert QUERIES[name](spark, folder).count() > 0
