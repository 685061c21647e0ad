"""Every registered query against its SQL oracle, and the shape of its plan."""

import math

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    return repr(float(value)) if isinstance(value, (int, float)) else str(value)


def table(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), sorted([plain(row[i]) for i in order] for row in rows)


@pytest.mark.parametrize("name", sorted(contract._engine_queries()))
def test_query_equals_oracle(spark, oracle, name):
    df = contract._engine_queries()[name](spark, SF_DIR)
    result = oracle.execute(contract._engine_sql()[name])
    names = [column[0] for column in result.description]
    assert table(df.columns, df.collect()) == table(names, result.fetchall())

    plan = df._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "Arrow", "CartesianProduct", "NestedLoop"):
        assert word not in plan


def test_every_query_has_an_oracle():
    assert set(contract._engine_queries()) == set(contract._engine_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
