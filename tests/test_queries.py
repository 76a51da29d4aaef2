"""Every registered query against its SQL oracle, and what the plans must not contain."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from lossgrid.operators.ordered import running_totals
from lossgrid.plans.catalog import all_queries
from lossgrid.sources.loan_book import BOOK_COLUMNS, loan_book
from tools.check_oracles import differences, oracle_connection

QUERIES = all_queries()


@pytest.fixture(scope="module")
def oracle(sf_dir):
    return oracle_connection(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, oracle, name):
    df = QUERIES[name].run(spark, sf_dir)
    rows = df.collect()
    assert rows
    sql = QUERIES[name].oracle()
    if sql is not None:
        answer = oracle.execute(sql)
        types = [(d[0], d[1]) for d in answer.description]
        assert differences(df.dtypes, rows, types, answer.fetchall()) is None


def test_contract(spark):
    assert contract.entry(spark).count() == 4
    assert set(contract.oracle_sql()) <= set(contract.queries())


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_loan_book_plans_only_the_joins_it_needs(spark, sf_dir):
    narrow = plan_of(loan_book(spark, sf_dir, "id", "pd_12m"))
    assert "Join" not in narrow and "ReadSchema: struct<o_orderkey:bigint>" in narrow
    assert loan_book(spark, sf_dir).count() == loan_book(spark, sf_dir, "id").count()
    assert loan_book(spark, sf_dir).columns == list(BOOK_COLUMNS)


def test_status_filter_reaches_the_scan(spark, sf_dir):
    from lossgrid.operators.cleaning import filter_income_dti

    table = spark.read.parquet(f"{sf_dir}/customer.parquet").withColumnRenamed("c_acctbal", "annual_inc")
    assert re.search(r"PushedFilters: \[Or\(IsNull\(c_acctbal\),GreaterThan\(c_acctbal,0", plan_of(filter_income_dti(table)))


@pytest.mark.parametrize("by", [[], ["segment"]])
def test_running_totals_never_gather_rows_in_one_task(spark, sf_dir, by):
    loans = loan_book(spark, sf_dir, "segment", "exposure")
    plan = plan_of(running_totals(loans, "exposure", {"n": F.lit(1)}, by))
    outside_subqueries = re.split(r"Subquery subquery", plan)[0]
    assert "SinglePartition" not in outside_subqueries
    # Windows over loan values run inside a bucket; the others see one row per bucket.
    over_values = [w for w in re.findall(r"Window \[.*", plan) if "exposure" in w]
    assert over_values and all("_bucket" in w for w in over_values)



@pytest.mark.parametrize("name", ["ecl_by_stage", "vasicek_capital_retail", "scenario_loss_distribution", "feature_drift",
                                  "performance_report", "stratified_split", "select_mutual_info", "prepare_loans"])
def test_no_python_and_no_cross_join_on_hot_paths(spark, sf_dir, name):
    plan = plan_of(QUERIES[name].run(spark, sf_dir))
    for node in ("PythonUDF", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan
