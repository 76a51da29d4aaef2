"""Loss components, capital, stress, simulated losses and concentration queries."""

from __future__ import annotations

import statistics

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lossgrid.operators import capital, components, concentration, simulation
from lossgrid.plans.oracle import on_loans, quantile_ctes, with_cdf, with_quantile, with_uniform
from lossgrid.plans.registry import Query
from lossgrid.sources.loan_book import loan_book, read_table

# Stress multipliers.
STRESS_SCENARIOS = {"base_case": 1.0, "mild_recession": 2.0, "severe_recession": 4.0, "financial_crisis": 6.0}
N_SIMS = 1000
N_SIMS_BY_SEGMENT = 1000
SEED = 42
Z999 = statistics.NormalDist().inv_cdf(0.999)
PARTS = {"pd": "pd_12m", "ead": "exposure", "lgd": "lgd"}
# Loans with certain and impossible default among them, as isotonic calibration produces.
EXTREME_PD = "CASE WHEN id % 50 = 0 THEN 0e0 WHEN id % 50 = 1 THEN 1e0 ELSE pd_12m END"


def risk_loans(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    return loan_book(spark, sf_dir, "id", "pd_12m", "exposure", "lgd", *extra)


def with_extreme_pds(df: DataFrame) -> DataFrame:
    turn = F.col("id") % 50
    return df.withColumn("pd_12m", F.when(turn == 0, 0.0).when(turn == 1, 1.0).otherwise(F.col("pd_12m")))


# --- oracles -----------------------------------------------------------------------------------------

CLIPPED = "SELECT *, least(greatest(pd_12m, 1e-6), 1e0 - 1e-6) AS p, 1e0 AS one FROM loan"
RETAIL_SQL = with_cdf(
    f"SELECT *, (z + sqrt(r) * {Z999!r}::DOUBLE) / sqrt(1e0 - r) AS x FROM (SELECT *, 0.03e0 + 0.13e0 * exp(-35e0 * p) AS r "
    f"FROM ({with_quantile(CLIPPED, 'p', 'z')}))",
    "x", "cond",
)
RETAIL_CTE = f"k AS (SELECT segment, exposure * lgd * (cond - p) AS k FROM ({RETAIL_SQL}))"


def fixed_correlation(pd_sql: str, rho: float = 0.15) -> str:
    """Loans with cond = PD in the bad case at one correlation."""
    return with_cdf(
        f"SELECT *, (z + sqrt({rho}e0) * {Z999!r}::DOUBLE) / sqrt(1e0 - {rho}e0) AS x FROM "
        f"({with_quantile(f'SELECT *, {pd_sql} AS p FROM loan', 'p', 'z')})",
        "x", "cond",
    )


ECONOMIC_CTE = f"ec AS (SELECT sum(exposure * lgd * cond) AS worst, sum(exposure * lgd * p) AS el FROM ({fixed_correlation(EXTREME_PD)}))"


def simulated(n_sims: int, keys: str = "", rho: float = 0.1) -> str:
    """CTEs zs, cells, losses(keys, sim, loss)."""
    z = with_quantile(with_uniform(f"SELECT range AS sim, 0 AS zero FROM range({n_sims})", "sim", "zero", SEED + 1, "u0"), "u0", "z")
    head = f"{keys}, " if keys else ""
    loans = with_quantile(f"SELECT {head}id, pd_12m, exposure * lgd AS sev FROM loan", "pd_12m", "thr")
    scale, slope = (1 - rho) ** 0.5, (rho / (1 - rho)) ** 0.5
    cells = (
        f"SELECT l.*, zs.sim, l.thr / {scale!r}::DOUBLE - {slope!r}::DOUBLE * zs.z AS x FROM ({loans}) l CROSS JOIN zs"
    )
    drawn = with_uniform(with_cdf(cells, "x", "lim"), "id", "sim", SEED, "u")
    return (
        f"zs AS (SELECT sim, z FROM ({z})), losses AS (SELECT {head}sim, sum(CASE WHEN u < lim THEN sev ELSE 0e0 END) AS loss "
        f"FROM ({drawn}) GROUP BY {head}sim)"
    )


VAR_ES_SQL = (
    "SELECT count(*) AS n_simulations, avg(loss) AS expected_loss, stddev_pop(loss) AS std_loss, quantile_cont(loss, 0.95e0) AS "
    "var_95, quantile_cont(loss, 0.99e0) AS var_99, quantile_cont(loss, 0.999e0) AS credit_var, quantile_cont(loss, 0.999e0) - "
    "avg(loss) AS unexpected_loss, (SELECT avg(loss) FROM losses WHERE loss >= (SELECT quantile_cont(loss, 0.999e0) FROM losses)) "
    "AS expected_shortfall FROM losses"
)


# --- builders ----------------------------------------------------------------------------------------


def _losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simulation.simulate_losses(risk_loans(spark, sf_dir), key="id", **PARTS, n_sims=N_SIMS, seed=SEED)


def _segment_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    loans = risk_loans(spark, sf_dir, "segment")
    return simulation.simulate_losses(loans, key="id", **PARTS, n_sims=N_SIMS_BY_SEGMENT, seed=SEED, by=["segment"])


def _raroc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interest income against expected loss and economic capital, per segment."""
    loans = risk_loans(spark, sf_dir, "segment", "int_rate")
    income = loans.groupBy("segment").agg(F.sum(F.col("exposure") * F.col("int_rate") / 100.0).alias("income"))
    ec = capital.economic_capital(loans, **PARTS, by=["segment"])
    return components.raroc(
        income.join(ec, "segment"), income="income", capital="economic_capital", loss="expected_loss"
    )


def _risk_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected loss, economic capital, simulated VaR and regulatory capital in one row."""
    loans = risk_loans(spark, sf_dir)
    ec = capital.economic_capital(loans, **PARTS).select("expected_loss", "economic_capital")
    regulatory = capital.regulatory_capital(loans, **PARTS).select("unexpected_loss").scalar()
    losses = simulation.simulate_losses(loans, key="id", **PARTS, n_sims=N_SIMS, seed=SEED)
    var = simulation.loss_var_es(losses).select("credit_var").scalar()
    return ec.withColumns({"credit_var": var, "regulatory_capital": regulatory})


def _stressed(spark: SparkSession, sf_dir: str) -> DataFrame:
    loans = loan_book(spark, sf_dir, "id", "segment", "pd_12m")
    return capital.stress_pd(loans, pd="pd_12m", scenarios=STRESS_SCENARIOS, by=["segment"])


def _portfolio_pd(spark: SparkSession, sf_dir: str) -> DataFrame:
    loans = risk_loans(spark, sf_dir)
    average = capital.portfolio_pd(loans, pd="pd_12m").withColumnRenamed("portfolio_pd", "average")
    weighted = capital.portfolio_pd(loans, pd="pd_12m", method="weighted", weight="exposure").scalar()
    return average.withColumns(
        {"weighted": weighted, "vasicek": capital.portfolio_pd(loans, pd="pd_12m", method="vasicek").scalar()}
    )


def _returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-level margin after discount as a return series per return flag."""
    lines = read_table(spark, sf_dir, "lineitem")
    return lines.select("l_returnflag", (F.col("l_tax") - F.col("l_discount")).alias("ret"))


def _validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    loans = risk_loans(spark, sf_dir, "segment", "y", "recovery").withColumn("realised", F.lit(1.0) - F.col("recovery") * 0.9)
    return components.component_validation(
        loans, pd="pd_12m", defaulted="y", lgd="lgd", realised_lgd="realised", by=["segment"]
    )


_LGD_PROBS = list(components.LGD_PROBS.values())
COMPONENT_QUERIES = {
    "pd_summary": Query(
        lambda s, d: components.pd_summary(loan_book(s, d, "segment", "pd_12m"), pd="pd_12m", by=["segment"]),
        "segment:s n_scores:i mean_pd:10 std_pd:10",
        on_loans("SELECT segment, count(*) AS n_scores, avg(pd_12m) AS mean_pd, stddev_pop(pd_12m) AS std_pd FROM loan GROUP BY segment"),
    ),
    "lgd_summary": Query(
        lambda s, d: components.lgd_summary(loan_book(s, d, "recovery"), recovery="recovery"),
        "n_observations:i mean_lgd:10 std_lgd:10",
        on_loans("SELECT count(*) AS n_observations, 1e0 - avg(recovery) AS mean_lgd, stddev_pop(recovery) AS std_lgd FROM loan"),
    ),
    "lgd_distribution": Query(
        lambda s, d: components.lgd_distribution(loan_book(s, d, "segment", "recovery"), recovery="recovery", by=["segment"]),
        "segment:s n_observations:i mean_lgd:10 std_lgd:10 min_lgd:10 max_lgd:10 p10:10 p25:10 median_lgd:10 p75:10 p90:10",
        on_loans(
            "SELECT m.*, q0 AS p10, q1 AS p25, q2 AS median_lgd, q3 AS p75, q4 AS p90 FROM (SELECT segment, count(*) AS "
            "n_observations, avg(value) AS mean_lgd, stddev_pop(value) AS std_lgd, min(value) AS min_lgd, max(value) AS max_lgd "
            "FROM v GROUP BY segment) m JOIN q USING (segment)",
            "v AS (SELECT segment, 1e0 - recovery AS value FROM loan)",
            quantile_ctes("SELECT segment, value FROM v", _LGD_PROBS, "q", ["segment"]),
        ),
    ),
    "ead_ccf": Query(
        lambda s, d: components.ead_conversion(
            loan_book(s, d, "id", "exposure", "outstanding"), committed="exposure", outstanding="outstanding"
        ),
        "id:i ead:4 ccf:4 utilization:10",
        on_loans(
            "SELECT id, outstanding + 0.5e0 * greatest(exposure - outstanding, 0e0) AS ead, 0.5e0 AS ccf, "
            "outstanding / exposure AS utilization FROM loan"
        ),
    ),
    "ead_summary": Query(
        lambda s, d: components.ead_summary(
            loan_book(s, d, "exposure", "outstanding"), committed="exposure", outstanding="outstanding"
        ),
        "mean_ccf:10 total_ead:2 mean_utilization:10 std_utilization:10 min_utilization:10 max_utilization:10",
        on_loans(
            "SELECT 0.5e0 AS mean_ccf, sum(outstanding + 0.5e0 * greatest(exposure - outstanding, 0e0)) AS total_ead, "
            "avg(outstanding / exposure) AS mean_utilization, stddev_pop(outstanding / exposure) AS std_utilization, "
            "min(outstanding / exposure) AS min_utilization, max(outstanding / exposure) AS max_utilization FROM loan"
        ),
    ),
    "expected_loss": Query(
        lambda s, d: components.expected_loss(risk_loans(s, d, "segment"), **PARTS, by=["segment"]),
        "segment:s level:i total_el:2 total_exposure:2 mean_pd:10 el_rate:10",
        on_loans(
            "SELECT segment, grouping(segment) AS level, sum(pd_12m * lgd * exposure) AS total_el, sum(exposure) AS total_exposure, "
            "avg(pd_12m) AS mean_pd, sum(pd_12m * lgd * exposure) / sum(exposure) AS el_rate FROM loan GROUP BY ROLLUP (segment)"
        ),
    ),
    "expected_loss_loan": Query(
        lambda s, d: components.with_expected_loss(risk_loans(s, d), pd="pd_12m", ead="exposure"),
        "id:i el:5",
        on_loans("SELECT id, pd_12m * 0.45e0 * exposure AS el FROM loan"),
    ),
    "raroc": Query(
        _raroc,
        "segment:s income:2 expected_loss:2 economic_capital:2 raroc:8",
        on_loans(
            "SELECT segment, income, expected_loss, economic_capital, (income - expected_loss) / economic_capital * 100e0 AS raroc "
            "FROM (SELECT segment, sum(exposure * int_rate / 100e0) AS income, sum(exposure * lgd * p) AS expected_loss, "
            f"sum(exposure * lgd * cond) - sum(exposure * lgd * p) AS economic_capital FROM ({fixed_correlation('pd_12m')}) GROUP BY segment)"
        ),
    ),
    "component_validation": Query(
        _validation,
        "segment:s sample_size:i pd_mae:10 pd_rmse:10 lgd_mae:10 lgd_rmse:10",
        on_loans(
            "SELECT segment, count(*) AS sample_size, avg(abs(pd_12m - y)) AS pd_mae, sqrt(avg((pd_12m - y) * (pd_12m - y))) AS "
            "pd_rmse, avg(abs(lgd - r)) AS lgd_mae, sqrt(avg((lgd - r) * (lgd - r))) AS lgd_rmse FROM "
            "(SELECT *, 1e0 - recovery * 0.9e0 AS r FROM loan) GROUP BY segment"
        ),
    ),
}

CAPITAL_QUERIES = {
    "vasicek_capital_retail": Query(
        lambda s, d: capital.vasicek_capital_retail(risk_loans(s, d, "segment"), **PARTS, by=["segment"]),
        "segment:s portfolio_var:2",
        on_loans("SELECT segment, sum(k) AS portfolio_var FROM k GROUP BY segment", RETAIL_CTE),
    ),
    "regulatory_capital": Query(
        lambda s, d: capital.vasicek_capital_retail(risk_loans(s, d), **PARTS).withColumnRenamed(
            "portfolio_var", "total_capital_needed"
        ),
        "total_capital_needed:2",
        on_loans("SELECT sum(k) AS total_capital_needed FROM k", RETAIL_CTE),
    ),
    "rwa_capital": Query(
        lambda s, d: capital.regulatory_capital(risk_loans(s, d, "segment"), **PARTS, by=["segment"]),
        "segment:s unexpected_loss:2 total_rwa:1 capital_requirement:2",
        on_loans(
            "SELECT segment, sum(k) AS unexpected_loss, sum(k) * 12.5e0 AS total_rwa, sum(k) * 12.5e0 * 0.08e0 AS "
            "capital_requirement FROM k GROUP BY segment",
            RETAIL_CTE,
        ),
    ),
    "economic_capital_vasicek": Query(
        lambda s, d: capital.economic_capital(with_extreme_pds(risk_loans(s, d)), **PARTS),
        "economic_capital:2 confidence_level:4",
        on_loans("SELECT worst - el AS economic_capital, 0.999e0 AS confidence_level FROM ec", ECONOMIC_CTE),
    ),
    "ec_detail": Query(
        lambda s, d: capital.economic_capital(with_extreme_pds(risk_loans(s, d)), **PARTS),
        "worst_case_loss:2 expected_loss:2 economic_capital:2",
        on_loans("SELECT worst AS worst_case_loss, el AS expected_loss, worst - el AS economic_capital FROM ec", ECONOMIC_CTE),
    ),
    "ec_detail_simulated": Query(
        lambda s, d: simulation.economic_capital_by_method(
            risk_loans(s, d), method="monte_carlo", key="id", **PARTS, n_sims=N_SIMS, seed=SEED
        ),
        "economic_capital:2 mean_loss:2 std_loss:2 var_95:2 var_99:2 var_999:2",
        on_loans(
            "SELECT unexpected_loss AS economic_capital, expected_loss AS mean_loss, std_loss, var_95, var_99, credit_var AS var_999 "
            f"FROM ({VAR_ES_SQL})",
            simulated(N_SIMS),
        ),
    ),
    "stress_pd": Query(
        _stressed,
        "segment:s scenario:s portfolio_pd:10 pd_increase:10",
        on_loans(
            "SELECT segment, scenario, avg(least(greatest(pd_12m * m, 0e0), 1e0)) AS portfolio_pd, "
            "avg(least(greatest(pd_12m * m, 0e0), 1e0)) - avg(pd_12m) AS pd_increase FROM loan, (VALUES "
            + ", ".join(f"('{s}', {m}e0)" for s, m in STRESS_SCENARIOS.items())
            + ") AS sc(scenario, m) GROUP BY segment, scenario"
        ),
    ),
    "stressed_pd_loan": Query(
        lambda s, d: capital.with_stressed_pd(loan_book(s, d, "id", "pd_12m"), pd="pd_12m", scenarios=STRESS_SCENARIOS),
        "id:i scenario:s stressed_pd:10",
        on_loans(
            "SELECT id, scenario, least(greatest(pd_12m * m, 0e0), 1e0) AS stressed_pd FROM loan, (VALUES "
            + ", ".join(f"('{s}', {m}e0)" for s, m in STRESS_SCENARIOS.items())
            + ") AS sc(scenario, m)"
        ),
    ),
    "portfolio_pd": Query(
        _portfolio_pd,
        "average:10 weighted:10 vasicek:10",
        on_loans(
            "SELECT avg(pd_12m) AS average, sum(pd_12m * exposure) / sum(exposure) AS weighted, avg(cond) AS vasicek FROM "
            f"({fixed_correlation('pd_12m')})"
        ),
    ),
    "diversification_ratio": Query(
        lambda s, d: capital.diversification_ratio(_segment_losses(s, d), unit="segment", run="sim", loss="loss"),
        "portfolio_var:2 sum_of_vars:2 diversification_ratio:9",
        on_loans(
            "SELECT portfolio_var, sum_of_vars, least(greatest(1e0 - portfolio_var / sum_of_vars, 0e0), 1e0) AS diversification_ratio "
            "FROM (SELECT quantile_cont(l, 0.999e0) AS portfolio_var FROM (SELECT sum(loss) AS l FROM losses GROUP BY sim)), "
            "(SELECT sum(v) AS sum_of_vars FROM (SELECT quantile_cont(loss, 0.999e0) AS v FROM losses GROUP BY segment))",
            simulated(N_SIMS_BY_SEGMENT, "segment"),
        ),
    ),
    "return_var_es": Query(
        lambda s, d: capital.return_var_es(_returns(s, d), ret="ret", by=["l_returnflag"]),
        "l_returnflag:s n:i value_at_risk:9 expected_shortfall:9",
        "SELECT l_returnflag, count(*) AS n, max(greatest(-q0, 0e0)) AS value_at_risk, -avg(CASE WHEN value <= least(q0, 0e0) "
        "THEN value END) AS expected_shortfall FROM (WITH v AS (SELECT l_returnflag, l_tax - l_discount AS value FROM lineitem), "
        + quantile_ctes("SELECT l_returnflag, value FROM v", [1.0 - 0.95], "q", ["l_returnflag"])
        + " SELECT * FROM v JOIN q USING (l_returnflag)) GROUP BY l_returnflag",
    ),
    "return_var_parametric": Query(
        lambda s, d: capital.return_var_es(_returns(s, d), ret="ret", method="parametric", by=["l_returnflag"]),
        "l_returnflag:s n:i value_at_risk:9",
        "SELECT l_returnflag, count(*) AS n, greatest(-(avg(l_tax - l_discount) + stddev_pop(l_tax - l_discount) * "
        f"{statistics.NormalDist().inv_cdf(1.0 - 0.95)!r}::DOUBLE), 0e0) AS value_at_risk FROM lineitem GROUP BY l_returnflag",
    ),
    "risk_summary": Query(
        _risk_summary,
        "expected_loss:2 economic_capital:2 credit_var:2 regulatory_capital:2",
        on_loans(
            "SELECT (SELECT sum(exposure * lgd * pd_12m) FROM loan) AS expected_loss, "
            f"(SELECT sum(exposure * lgd * (cond - p)) FROM ({fixed_correlation('pd_12m')})) AS economic_capital, "
            "(SELECT quantile_cont(loss, 0.999e0) FROM losses) AS credit_var, (SELECT sum(k) FROM k) AS regulatory_capital",
            RETAIL_CTE,
            simulated(N_SIMS),
        ),
    ),
}

LOSS_QUERIES = {
    "scenario_loss_distribution": Query(
        _losses, "sim:i loss:0", on_loans("SELECT sim, loss FROM losses", simulated(N_SIMS))
    ),
    "loss_var_es": Query(
        lambda s, d: simulation.loss_var_es(_losses(s, d)),
        "n_simulations:i expected_loss:2 std_loss:2 var_95:2 var_99:2 credit_var:2 unexpected_loss:2 expected_shortfall:2",
        on_loans(VAR_ES_SQL, simulated(N_SIMS)),
    ),
    "loss_histogram": Query(
        lambda s, d: simulation.loss_histogram(_losses(s, d)),
        "bin:i n:i mean_loss:2",
        on_loans(
            "SELECT b.bin, count(x.loss) AS n, (SELECT avg(loss) FROM losses) AS mean_loss FROM range(50) AS b(bin) LEFT JOIN "
            "(SELECT loss, (SELECT min(loss) FROM losses) AS lo, ((SELECT max(loss) FROM losses) - (SELECT min(loss) FROM losses)) "
            "/ 50e0 AS w FROM losses) x ON x.loss >= x.lo + b.bin * x.w AND (x.loss < x.lo + (b.bin + 1) * x.w OR b.bin = 49) "
            "GROUP BY b.bin",
            simulated(N_SIMS),
        ),
    ),
    "concentration_topn": Query(
        lambda s, d: concentration.concentration_topn(loan_book(s, d, "id", "exposure"), exposure="exposure", key="id"),
        "label:s exposure:2",
        on_loans(
            "SELECT label, exposure FROM (SELECT id::VARCHAR AS label, exposure FROM loan ORDER BY exposure DESC, id LIMIT 10) "
            "UNION ALL SELECT 'Others', sum(exposure) - (SELECT sum(exposure) FROM (SELECT exposure FROM loan ORDER BY exposure DESC, "
            "id LIMIT 10)) FROM loan"
        ),
    ),
    "lorenz_curve": Query(
        lambda s, d: concentration.lorenz_curve(loan_book(s, d, "exposure"), exposure="exposure"),
        "exposure:2 share_of_loans:10 share_of_exposure:10",
        on_loans(
            "SELECT exposure, sum(n) OVER (ORDER BY exposure) / sum(n) OVER () AS share_of_loans, sum(a) OVER (ORDER BY exposure) / "
            "sum(a) OVER () AS share_of_exposure FROM (SELECT exposure, count(*) AS n, sum(exposure) AS a FROM loan GROUP BY exposure)"
        ),
    ),
    "concentration_indices": Query(
        lambda s, d: concentration.concentration_indices(loan_book(s, d, "exposure"), exposure="exposure"),
        "hhi:12 effective_number_of_exposures:5 top_1_concentration:10 top_5_concentration:10 top_10_concentration:10",
        on_loans(
            "SELECT sum(s * s) AS hhi, 1e0 / sum(s * s) AS effective_number_of_exposures, sum(CASE WHEN rk <= 1 THEN s END) AS "
            "top_1_concentration, sum(CASE WHEN rk <= 5 THEN s END) AS top_5_concentration, sum(CASE WHEN rk <= 10 THEN s END) AS "
            "top_10_concentration FROM (SELECT exposure / sum(exposure) OVER () AS s, row_number() OVER (ORDER BY exposure DESC) AS rk "
            "FROM loan)"
        ),
    ),
}

QUERIES = {**COMPONENT_QUERIES, **CAPITAL_QUERIES, **LOSS_QUERIES}
