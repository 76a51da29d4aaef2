"""Staging and expected credit loss queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lossgrid.operators import impairment
from lossgrid.plans.oracle import on_loans
from lossgrid.plans.registry import Query
from lossgrid.sources.loan_book import loan_book

# Macro-economic scenarios and their weights.
MACRO_SCENARIOS = {"base": 1.0, "optimistic": 0.8, "downturn": 1.5}
MACRO_WEIGHTS = {"base": 0.6, "optimistic": 0.2, "downturn": 0.2}

STAGE_SQL = (
    "CASE WHEN dpd > 90 OR pd_12m >= 0.99e0 THEN 3 WHEN dpd > 30 OR pd_12m > 0.2e0 "
    "OR pd_12m / (original_pd + 1e-6) > 2e0 THEN 2 ELSE 1 END"
)
LIFE_SQL = "1e0 - pow(1e0 - pd_12m, term_years)"
MACRO_SQL = (
    "0.6e0 * least(greatest(pd_12m, 0e0), 1e0) + 0.2e0 * least(greatest(pd_12m * 0.8e0, 0e0), 1e0) "
    "+ 0.2e0 * least(greatest(pd_12m * 1.5e0, 0e0), 1e0)"
)
STAGED_CTE = (
    f"staged AS (SELECT id, segment, exposure, pd_12m, lgd, {STAGE_SQL} AS stage, {LIFE_SQL} AS life FROM loan), "
    "ecl AS (SELECT *, exposure * (CASE WHEN stage = 1 THEN pd_12m ELSE life END) * lgd AS ecl FROM staged)"
)
ECL_INPUT = ("id", "exposure", "pd_12m", "original_pd", "lgd", "term_years", "dpd")


def loans_with_ecl(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    return impairment.with_ecl(
        loan_book(spark, sf_dir, *ECL_INPUT, *extra),
        exposure="exposure", pd="pd_12m", original_pd="original_pd", lgd="lgd", term_years="term_years", dpd="dpd",
    )


def ecl_by_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: stage every loan, 12-month or lifetime loss, totals per stage."""
    return impairment.ecl_by_stage(loans_with_ecl(spark, sf_dir))


def _stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    loans = loan_book(spark, sf_dir, "id", "pd_12m", "original_pd", "dpd")
    return impairment.with_stage(loans, pd="pd_12m", original_pd="original_pd", dpd="dpd")


def _lifetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    loans = loan_book(spark, sf_dir, "id", "pd_12m", "term_years")
    return loans.withColumn("pd_lifetime", impairment.lifetime_pd(F.col("pd_12m"), F.col("term_years")))


def _macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    weighted = impairment.macro_weighted_pd(F.col("pd_12m"), MACRO_SCENARIOS, MACRO_WEIGHTS)
    return loan_book(spark, sf_dir, "id", "pd_12m").withColumn("pd_macro", weighted)


def _by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impairment.ecl_by_stage(loans_with_ecl(spark, sf_dir, "segment"), by=["segment"])


STAGE_ROWS = "(VALUES (0), (1), (2), (3)) AS s(stage)"

QUERIES = {
    "ecl_by_stage": Query(
        ecl_by_stage,
        "stage:i loans:i ecl:2",
        on_loans(
            f"SELECT s.stage, count(e.id) AS loans, coalesce(sum(e.ecl), 0e0) AS ecl FROM {STAGE_ROWS} "
            "LEFT JOIN ecl e ON s.stage = 0 OR e.stage = s.stage GROUP BY s.stage",
            STAGED_CTE,
        ),
    ),
    "ecl_by_segment_and_stage": Query(
        _by_segment,
        "segment:s stage:i loans:i ecl:2",
        on_loans(
            "SELECT g.segment, s.stage, count(e.id) AS loans, coalesce(sum(e.ecl), 0e0) AS ecl "
            f"FROM (SELECT DISTINCT segment FROM loan) g CROSS JOIN {STAGE_ROWS} LEFT JOIN ecl e "
            "ON e.segment = g.segment AND (s.stage = 0 OR e.stage = s.stage) GROUP BY g.segment, s.stage",
            STAGED_CTE,
        ),
    ),
    "ecl_loan": Query(
        loans_with_ecl,
        "id:i stage:i pd_lifetime:10 ecl:4",
        on_loans("SELECT id, stage, life AS pd_lifetime, ecl FROM ecl", STAGED_CTE),
    ),
    "ifrs9_stage": Query(_stages, "id:i stage:i", on_loans(f"SELECT id, {STAGE_SQL} AS stage FROM loan")),
    "lifetime_pd": Query(_lifetime, "id:i pd_lifetime:10", on_loans(f"SELECT id, {LIFE_SQL} AS pd_lifetime FROM loan")),
    "macro_weighted_pd": Query(_macro, "id:i pd_macro:10", on_loans(f"SELECT id, {MACRO_SQL} AS pd_macro FROM loan")),
}
