"""Every registered query against its DuckDB statement, and the shape of its plan."""

import re

import pytest
from compare import connect, difference
from conftest import SF_DIR

import __spark_entry__ as registered

OWN = re.compile(r"op\d+_|pipeline$")  # the llm subpackage has tests of its own
QUERIES = {name: query for name, query in registered.queries().items() if not OWN.match(name)}
STATEMENTS = {name: sql for name, sql in registered.oracle_sql().items() if not OWN.match(name)}


@pytest.fixture(scope="module")
def duck():
    con = connect(SF_DIR)
    yield con
    con.close()


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(STATEMENTS)


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_duckdb_and_joins_by_key(name, spark, duck):
    rows = QUERIES[name](spark, SF_DIR)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert not re.search("NestedLoop|CartesianProduct|Python", plan)
    assert difference(rows, duck, STATEMENTS[name]) is None


def test_entry(spark):
    assert registered.entry(spark).columns == [
        "report_date", "branch_code", "txn_count", "credit_inr", "debit_inr", "net_inr"]


def test_oracle_keeps_one_copy_per_id_before_the_shuffle(spark):
    plan = QUERIES["oracle_valid_transactions"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_filters_and_columns_reach_the_scan(spark):
    plan = QUERIES["dq_customer_negative_balance"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(c_acctbal,0.0)" in plan and "ReadSchema: struct<c_custkey:bigint,c_acctbal:double>" in plan
    plan = QUERIES["rule_unq01"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "props" not in plan
