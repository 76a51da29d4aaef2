"""The whole chain: identities between its result tables and the written snapshot."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lossgrid.operators.alerts import read_alerts
from lossgrid.plans.portfolio_job import all_rows, run_portfolio_job, training_table
from lossgrid.sources.loan_book import loan_book


def test_chain_adds_up(spark, sf_dir, tmp_path):
    """With an id under two members and exact duplicates, every prepared loan is scored and written once."""
    loans = loan_book(spark, sf_dir)
    some = loans.filter("id % 50 = 1")
    loans = loans.unionByName(some).unionByName(some.withColumn("member_id", F.col("member_id") + 100_000))
    path = str(tmp_path / "job")
    def job():
        return run_portfolio_job(
            loans, key="id", exposure="exposure", lgd="lgd", original_pd="original_pd", term_years="term_years", dpd="dpd",
            income_rate="int_rate", path=path, as_of="2024-01-31", k=4, trees=2, n_sims=100,
        )

    results = job()
    value = {(r["table"], r["group"], r["metric"]): r["value"] for r in all_rows(results).collect()}
    written = spark.read.parquet(f"{path}/ecl")
    n, pairs, el, ecl = written.agg(
        F.count(F.lit(1)), F.count_distinct("loan_key"), F.sum(F.col("pd") * F.col("lgd") * F.col("exposure")), F.sum("ecl")
    ).first()
    known = loans.filter(F.col("loan_status").isin("Fully Paid", "Charged Off")).select("id", "member_id").distinct().count()
    assert 0 < pairs <= n <= known
    assert value["ecl_by_stage", "0", "loans"] == n == sum(value["ecl_by_stage", str(s), "loans"] for s in (1, 2, 3))
    assert value["ecl_by_stage", "0", "ecl"] == pytest.approx(ecl)
    assert value["expected_loss", "", "total_el"] == pytest.approx(el)
    assert value["loss_distribution", "", "credit_var"] >= value["loss_distribution", "", "var_95"]
    assert value["stress", "severe_recession", "portfolio_pd"] >= value["stress", "base_case", "portfolio_pd"]
    assert {t for t, _, _ in value} == set(results)
    history = read_alerts(spark, f"{path}/alerts")
    n_alerts = history.count()
    assert value["report", "portfolio", "total_alerts"] == n_alerts
    assert {(str(r.report_date), r.run) for r in history.collect()} <= {("2024-01-31", "portfolio")}
    job()
    assert read_alerts(spark, f"{path}/alerts").count() == n_alerts and spark.read.parquet(f"{path}/ecl").count() == n


def test_categories_of_any_width(spark, sf_dir):
    """A text column with a level for every second loan goes through the chain; its telling levels can be chosen."""
    loans = loan_book(spark, sf_dir).withColumn("dealer", F.concat(F.lit("d."), (F.col("id") / 2).cast("int").cast("string")))
    loans = loans.withColumn("channel", F.when(F.col("loan_status") == "Charged Off", "late`1").when(F.col("id") % 2 == 0, "shop").otherwise("web"))
    assert loans.select("dealer").distinct().count() > 500
    table, names = training_table(loans, key="id", k=6)
    assert "channel_shop" in names or "channel_web" in names
    assert set(names) <= set(table.columns) and table.count() > 0
