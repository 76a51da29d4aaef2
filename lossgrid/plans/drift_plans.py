"""Stability, drift, alert and report queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lossgrid.operators import alerts, discrimination, drift, profiles
from lossgrid.plans.oracle import edge_bin, edge_list, kolmogorov, on_loans, quantile_ctes, score_ctes
from lossgrid.plans.registry import Query
from lossgrid.session import materialise, scratch_dir
from lossgrid.sources.loan_book import loan_book, read_table

FEATURES = ("dti", "exposure", "annual_inc", "revol_bal")
N_BINS = 10
# Tighter than the defaults, so that a month of event data raises some alerts.
DAILY_THRESHOLDS = {"psi_threshold": 0.08, "ks_threshold": 0.09, "calibration_error": 0.09}
AS_OF, DAYS_BACK, REPORT_DATE = dt.datetime(2024, 1, 31), 14, dt.date(2024, 1, 15)
MODEL = "loan_default_model"


def drifting_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loans before and after the cut-off date; score and revolving balance move between the periods."""
    loans = loan_book(spark, sf_dir, "id", "is_ref", "y", "pd_12m", "issue_ts", *FEATURES)
    moved = F.lit(1) - F.col("is_ref")
    return loans.withColumns(
        {
            "score": F.col("pd_12m") * (F.lit(1.0) + moved * 0.5),
            "revol_bal": F.col("revol_bal") * (F.lit(1.0) + moved * 0.75),
        }
    )


def daily_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as scored observations: mornings are the reference of the afternoons of the same day."""
    return read_table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("day"),
        F.when(F.hour("ts") < 12, 1).otherwise(0).alias("is_ref"),
        F.col("value"),
        (F.col("value") / 500.0).alias("score"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("y"),
    )


def daily_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(day, metric, value): stability, distance and calibration error of every day, one job each."""
    events = daily_events(spark, sf_dir)
    moved = drift.feature_drift(events, features=["value"], is_ref="is_ref", by=["day"])
    calibration = discrimination.calibration_summary(events, score="score", label="y", by=["day"])
    pairs = F.array(
        F.struct(F.lit("psi").alias("metric"), F.col("psi").alias("value")),
        F.struct(F.lit("ks_statistic").alias("metric"), F.col("ks_statistic").alias("value")),
    )
    rows = moved.select("day", F.inline(pairs)).unionByName(
        calibration.select(
            "day", F.lit("expected_calibration_error").alias("metric"), F.col("expected_calibration_error").alias("value")
        )
    )
    return rows.withColumn("ts", F.col("day").cast("timestamp_ntz"))


def daily_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.metric_alerts(daily_metrics(spark, sf_dir), thresholds=DAILY_THRESHOLDS)


def loan_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.drift_verdict(
        drifting_loans(spark, sf_dir), score="score", label="y", is_ref="is_ref", features=list(FEATURES)
    )


def loan_profile(spark: SparkSession, sf_dir: str) -> profiles.Profile:
    """Profile of the loans before the cut-off, from parts by quarter, one of them written twice; saved and loaded."""
    loans = drifting_loans(spark, sf_dir).withColumn("quarter", F.quarter("issue_ts"))
    before = loans.filter(F.col("is_ref") == 1)
    counts, saved = scratch_dir(spark, "profile-counts"), scratch_dir(spark, "profile")
    for quarter in (1, 2, 3, 4, 2):
        part = profiles.value_counts(before.filter(F.col("quarter") == quarter), features=FEATURES, score="score", label="y")
        profiles.write_counts(part, counts, part=f"q{quarter}")
    profiles.build_profile(profiles.read_counts(spark, counts), n_bins=N_BINS).save(saved)
    return profiles.Profile.load(spark, saved)


def profile_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = drifting_loans(spark, sf_dir).filter(F.col("is_ref") == 0)
    return profiles.drift_from_profile(current, loan_profile(spark, sf_dir), features=FEATURES)


def profile_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = drifting_loans(spark, sf_dir).filter(F.col("is_ref") == 0)
    verdict = profiles.verdict_from_profile(current, loan_profile(spark, sf_dir), score="score", label="y", features=FEATURES)
    return verdict.withColumns(
        {"drift_indicators": F.concat_ws(",", "drift_indicators"), "affected_features": F.concat_ws(",", "affected_features")}
    )


def alert_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alert table after a run of two days' reports and a repetition of the second."""
    found, path = materialise(daily_alerts(spark, sf_dir), "daily-alerts"), scratch_dir(spark, "alert-table")
    for day in (REPORT_DATE - dt.timedelta(days=1), REPORT_DATE, REPORT_DATE):
        alerts.write_alerts(found.filter(F.to_date("ts") <= F.lit(day)), path, report_date=day, run="daily")
    return alerts.read_alerts(spark, path).withColumn("day", F.to_date("ts"))


def all_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alerts.drift_alerts(loan_verdict(spark, sf_dir), ts=F.lit(REPORT_DATE))
    return daily_alerts(spark, sf_dir).unionByName(found)


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = alerts.monitoring_report(all_alerts(spark, sf_dir), model_name=MODEL, report_date=REPORT_DATE)
    return report.withColumn("recommendations", F.concat_ws("; ", "recommendations"))


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = alerts.alert_summary(all_alerts(spark, sf_dir), as_of=AS_OF, days_back=DAYS_BACK)
    counts = [
        F.coalesce(F.try_element_at("alert_types", F.lit(t)), F.lit(0)).alias(t.lower())
        for t in ("PSI_ALERT", "KS_ALERT", "CALIBRATION_ALERT", "DRIFT_ALERT")
    ]
    return summary.select(
        "total_alerts", "period_days", "alert_frequency", *counts,
        F.col("most_recent_alert.type").alias("last_type"),
        F.col("most_recent_alert.value").alias("last_value"),
        F.col("most_recent_alert.ts").cast("date").alias("last_day"),
    )


def _verdict_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loan_verdict(spark, sf_dir).withColumns(
        {"drift_indicators": F.concat_ws(",", "drift_indicators"), "affected_features": F.concat_ws(",", "affected_features")}
    )


# --- oracles -----------------------------------------------------------------------------------------

MOVED_CTE = (
    "moved AS (SELECT id, is_ref, y, dti, exposure, annual_inc, revol_bal * (1e0 + (1 - is_ref) * 0.75e0) AS revol_bal, "
    "pd_12m * (1e0 + (1 - is_ref) * 0.5e0) AS score FROM loan)"
)


def _long_sql(cols) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, {c}::DOUBLE AS value, is_ref FROM moved WHERE {c} IS NOT NULL" for c in cols)


def psi_ctes(source: str, key: str = "feature", method: str = "quantile", n: int = N_BINS) -> str:
    """CTEs src, edges, psi_bin, psi(key, psi, out_of_range)."""
    if method == "quantile":
        found = quantile_ctes(f"SELECT {key}, value FROM src WHERE is_ref = 1", [i / n for i in range(n + 1)], "q", [key])
        edges = f"{found}, edges AS (SELECT {key}, {edge_list(n)} AS edges FROM q)"
    else:
        points = ", ".join(f"min(value) + {float(i)}e0 * ((max(value) - min(value)) / {n}e0)" for i in range(n)) + ", max(value)"
        edges = f"edges AS (SELECT {key}, list_sort(list_distinct([{points}])) AS edges FROM src WHERE is_ref = 1 GROUP BY {key})"
    return (
        f"src AS ({source}), {edges}, "
        f"binned AS (SELECT {key}, {edge_bin()} AS bin, sum(is_ref) AS nr, sum(1 - is_ref) AS nc FROM src JOIN edges USING ({key}) "
        "GROUP BY ALL), "
        f"grid AS (SELECT {key}, edges, unnest(range(0, len(edges) - 1)) AS bin FROM edges WHERE len(edges) > 1), "
        f"shares AS (SELECT {key}, g.bin, edges[g.bin + 1] AS bin_lower, edges[g.bin + 2] AS bin_upper, "
        f"(coalesce(nr, 0) + 1e-6) / sum(coalesce(nr, 0) + 1e-6) OVER (PARTITION BY {key}) AS r, "
        f"(coalesce(nc, 0) + 1e-6) / sum(coalesce(nc, 0) + 1e-6) OVER (PARTITION BY {key}) AS c "
        f"FROM grid g LEFT JOIN binned b USING ({key}, bin)), "
        f"psi AS (SELECT {key}, coalesce(sum((c - r) * ln(c / r)), 0e0) AS psi, coalesce(max(o.nc), 0) AS out_of_range "
        f"FROM edges LEFT JOIN shares USING ({key}) LEFT JOIN (SELECT {key}, nc FROM binned WHERE bin IS NULL) o USING ({key}) GROUP BY {key})"
    )


def ks_ctes(key: str = "feature", source: str = "src") -> str:
    """CTE ks(key, ks, n, m)."""
    return (
        f"ks AS (SELECT {key}, max(abs(cr / nr - cc / nc)) AS ks, max(nr) AS n, max(nc) AS m FROM (SELECT {key}, value, "
        f"sum(sum(is_ref)) OVER (PARTITION BY {key} ORDER BY value) AS cr, sum(sum(is_ref)) OVER (PARTITION BY {key}) AS nr, "
        f"sum(sum(1 - is_ref)) OVER (PARTITION BY {key} ORDER BY value) AS cc, sum(sum(1 - is_ref)) OVER (PARTITION BY {key}) AS nc "
        f"FROM {source} GROUP BY {key}, value) GROUP BY {key})"
    )


EXACT_ROWS = 1000
READING = (
    "CASE WHEN psi < 0.1e0 THEN 'No significant change' WHEN psi < 0.25e0 THEN 'Some minor change' "
    "ELSE 'Major shift in population' END"
)
ALL_CTES = (MOVED_CTE, psi_ctes(_long_sql([*FEATURES, "score"])), ks_ctes())
DRIFT_SQL = (
    f"SELECT p.feature, p.psi, k.ks AS ks_statistic, {kolmogorov('k.ks', 'k.n', 'k.m')} AS ks_p_value, "
    "(p.psi > 0.25e0 OR k.ks > 0.1e0) AS affected FROM psi p JOIN ks k USING (feature)"
)
TARGET_SQL = (
    "SELECT *, current_default_rate - reference_default_rate AS absolute_change, abs(current_default_rate - reference_default_rate) / "
    "(reference_default_rate + 1e-8) AS relative_change FROM (SELECT avg(CASE WHEN is_ref = 1 THEN y END) AS reference_default_rate, "
    "avg(CASE WHEN is_ref = 0 THEN y END) AS current_default_rate FROM moved)"
)
VERDICT_CTE = (
    f"d AS ({DRIFT_SQL}), v AS (SELECT (SELECT psi FROM d WHERE feature = 'score') AS score_psi, "
    "(SELECT ks_statistic FROM d WHERE feature = 'score') AS score_ks, "
    f"(SELECT relative_change FROM ({TARGET_SQL})) AS change, "
    "(SELECT coalesce(string_agg(feature, ',' ORDER BY feature), '') FROM d WHERE affected AND feature <> 'score') AS affected), "
    "w AS (SELECT *, concat_ws(',', nullif(affected, ''), CASE WHEN change > 0.5e0 THEN 'target_distribution' END) AS affected_features "
    "FROM v), verdict AS (SELECT *, concat_ws(',', CASE WHEN score_psi > 0.25e0 THEN 'score_psi' END, CASE WHEN score_ks > 0.1e0 "
    "THEN 'score_ks' END, CASE WHEN affected_features <> '' THEN 'feature_drift' END) AS drift_indicators, "
    "(score_psi > 0.25e0)::INT + (score_ks > 0.1e0)::INT + (affected_features <> '')::INT AS k FROM w)"
)
_DAY_BIN = " + ".join(f"(score > {i * 0.1!r}::DOUBLE)::INT" for i in range(1, 10))
# The daily part reuses the CTE makers under other names, with the day as the key.
DAILY_CTES = (
    psi_ctes(
        "SELECT ts::DATE AS day, value, CASE WHEN hour(ts) < 12 THEN 1 ELSE 0 END AS is_ref, value / 500e0 AS score, "
        "CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS y FROM events",
        "day",
    )
    + ", " + ks_ctes("day")
    + f", ece AS (SELECT day, sum(n * gap) / sum(n) AS ece FROM (SELECT day, count(*) AS n, abs(avg(y) - avg(score)) AS gap FROM "
    f"(SELECT *, {_DAY_BIN} AS bin FROM src) GROUP BY day, bin) GROUP BY day), metrics AS (SELECT day, 'psi' AS metric, psi AS value "
    "FROM psi UNION ALL SELECT day, 'ks_statistic', ks FROM ks UNION ALL SELECT day, 'expected_calibration_error', ece FROM ece), "
    "daily AS (SELECT CASE metric WHEN 'psi' THEN 'PSI_ALERT' WHEN 'ks_statistic' THEN 'KS_ALERT' ELSE 'CALIBRATION_ALERT' END AS type, "
    "value, threshold, CASE metric WHEN 'psi' THEN printf('PSI value %.4f exceeds threshold', value) WHEN 'ks_statistic' THEN "
    "printf('KS statistic %.4f indicates distribution shift', value) ELSE printf('Expected Calibration Error %.4f exceeds threshold', "
    "value) END AS message, day FROM metrics JOIN (VALUES ('psi', 0.08e0), ('ks_statistic', 0.09e0), "
    "('expected_calibration_error', 0.09e0)) AS t(metric, threshold) USING (metric) WHERE value > threshold)"
)
DAILY_SQL = f"(WITH {DAILY_CTES} SELECT * FROM daily)"
VERDICT_SQL = f"({on_loans('SELECT * FROM verdict', *ALL_CTES, VERDICT_CTE)})"
ALERTS_SQL = (
    f"SELECT type, value, day FROM {DAILY_SQL} UNION ALL SELECT 'DRIFT_ALERT', NULL, DATE '{REPORT_DATE}' FROM {VERDICT_SQL} WHERE k > 0"
)
RECENT = f"day >= DATE '{(AS_OF - dt.timedelta(days=DAYS_BACK)).date()}' AND day <= DATE '{AS_OF.date()}'"


def _psi_query(method: str) -> Query:
    return Query(
        lambda s, d: drift.psi(drifting_loans(s, d), features=["score", "exposure"], is_ref="is_ref", method=method),
        "feature:s psi:9 interpretation:s out_of_range:i",
        on_loans(
            f"SELECT feature, psi, {READING} AS interpretation, out_of_range FROM psi",
            MOVED_CTE, psi_ctes(_long_sql(["score", "exposure"]), method=method),
        ),
    )


QUERIES = {
    "psi_quantile": _psi_query("quantile"),
    "psi_equal_width": _psi_query("equal_width"),
    "psi_interpretation": Query(
        lambda s, d: drift.psi(
            drifting_loans(s, d), features=["score", "dti", "revol_bal"], is_ref="is_ref"
        ).select("feature", "interpretation"),
        "feature:s interpretation:s",
        on_loans(
            f"SELECT feature, {READING} AS interpretation FROM psi", MOVED_CTE, psi_ctes(_long_sql(["score", "dti", "revol_bal"]))
        ),
    ),
    "psi_bins": Query(
        lambda s, d: drift.psi_bins(drifting_loans(s, d), features=["score", "revol_bal"], is_ref="is_ref"),
        "feature:s bin:i bin_lower:5 bin_upper:5 reference_pct:10 current_pct:10 psi_part:9",
        on_loans(
            "SELECT feature, bin, bin_lower, bin_upper, r AS reference_pct, c AS current_pct, (c - r) * ln(c / r) AS psi_part FROM shares",
            MOVED_CTE, psi_ctes(_long_sql(["score", "revol_bal"])),
        ),
    ),
    "sample_stats": Query(
        lambda s, d: drift.sample_stats(drifting_loans(s, d), features=list(FEATURES), is_ref="is_ref"),
        "feature:s reference_count:i reference_mean:5 reference_std:5 current_count:i current_mean:5 current_std:5",
        on_loans(
            "SELECT feature, count(CASE WHEN is_ref = 1 THEN value END) AS reference_count, avg(CASE WHEN is_ref = 1 THEN value END) AS "
            "reference_mean, stddev_pop(CASE WHEN is_ref = 1 THEN value END) AS reference_std, count(CASE WHEN is_ref = 0 THEN value END) "
            "AS current_count, avg(CASE WHEN is_ref = 0 THEN value END) AS current_mean, stddev_pop(CASE WHEN is_ref = 0 THEN value END) "
            f"AS current_std FROM ({_long_sql(FEATURES)}) GROUP BY feature",
            MOVED_CTE,
        ),
    ),
    "ks_two_sample": Query(
        lambda s, d: drift.ks_two_sample(drifting_loans(s, d), features=["score", "dti", "exposure"], is_ref="is_ref"),
        "feature:s ks_statistic:10 p_value:9 significant_change:b",
        on_loans(
            f"SELECT feature, ks AS ks_statistic, p AS p_value, p < 0.05e0 AS significant_change FROM (SELECT *, {kolmogorov('ks', 'n', 'm')} "
            "AS p FROM ks)",
            MOVED_CTE, f"src AS ({_long_sql(['score', 'dti', 'exposure'])})", ks_ctes(),
        ),
    ),
    "ks_exact_daily": Query(
        lambda s, d: drift.ks_two_sample(daily_events(s, d), features=["value"], is_ref="is_ref", by=["day"], exact_rows=EXACT_ROWS),
        "day:d ks_statistic:10 p_value:9 significant_change:b",
        "WITH RECURSIVE src AS (SELECT ts::DATE AS day, value, CASE WHEN hour(ts) < 12 THEN 1 ELSE 0 END AS is_ref FROM events WHERE "
        f"value IS NOT NULL), {ks_ctes('day')}, walk AS (SELECT day, n::BIGINT AS n, m::BIGINT AS m, round(ks * n * m)::BIGINT AS h, "
        "0::BIGINT AS x, 0::BIGINT AS y, 1e0 AS mass, ks = 0 AS gone FROM ks "
        f"WHERE greatest(n, m) <= {EXACT_ROWS} UNION ALL SELECT day, n, m, h, x + dx, y + dy, sum(mass * CASE WHEN dx = 1 THEN n - x ELSE m - y "
        "END / (n + m - x - y)), abs((x + dx) * m - (y + dy) * n) >= h FROM walk, (VALUES (1, 0), (0, 1)) AS move(dx, dy) WHERE NOT gone "
        "AND x + dx <= n AND y + dy <= m GROUP BY day, n, m, h, x + dx, y + dy), exact AS (SELECT day, sum(mass) AS p FROM walk WHERE "
        "gone GROUP BY day) SELECT *, p_value < 0.05e0 AS significant_change FROM (SELECT ks.day, ks AS ks_statistic, CASE WHEN "
        f"greatest(n, m) <= {EXACT_ROWS} THEN coalesce(p, 0e0) ELSE {kolmogorov('ks', 'n', 'm')} END AS p_value FROM ks LEFT JOIN exact "
        "ON ks.day = exact.day)",
    ),
    "ks_power_change": Query(
        lambda s, d: drift.ks_power_change(drifting_loans(s, d), score="score", label="y", is_ref="is_ref"),
        "reference_ks_power:10 current_ks_power:10 ks_power_change:10 discriminatory_power_maintained:b",
        on_loans(
            "SELECT *, current_ks_power - reference_ks_power AS ks_power_change, abs(current_ks_power - reference_ks_power) < 0.1e0 AS "
            "discriminatory_power_maintained FROM (SELECT max(CASE WHEN is_ref = 1 THEN g END) AS reference_ks_power, max(CASE WHEN "
            "is_ref = 0 THEN g END) AS current_ks_power FROM (SELECT is_ref, abs(c0_upto / c0_total - c1_upto / c1_total) AS g FROM st))",
            MOVED_CTE, score_ctes("SELECT is_ref, y, score, 1e0 AS w FROM moved", ["is_ref"]),
        ),
    ),
    "feature_drift": Query(
        lambda s, d: drift.feature_drift(drifting_loans(s, d), features=list(FEATURES), is_ref="is_ref"),
        "feature:s psi:9 ks_statistic:10 ks_p_value:9 affected:b",
        on_loans(f"SELECT * FROM ({DRIFT_SQL}) WHERE feature <> 'score'", *ALL_CTES),
    ),
    "profile_drift": Query(
        profile_drift,
        "feature:s psi:9 ks_statistic:10 ks_p_value:9 affected:b",
        on_loans(f"SELECT * FROM ({DRIFT_SQL}) WHERE feature <> 'score'", *ALL_CTES),
    ),
    "score_drift": Query(
        lambda s, d: drift.score_drift(drifting_loans(s, d), score="score", is_ref="is_ref"),
        "psi:9 ks_statistic:10 ks_p_value:9",
        on_loans(f"SELECT psi, ks_statistic, ks_p_value FROM ({DRIFT_SQL}) WHERE feature = 'score'", *ALL_CTES),
    ),
    "target_drift": Query(
        lambda s, d: drift.target_drift(drifting_loans(s, d), label="y", is_ref="is_ref"),
        "reference_default_rate:10 current_default_rate:10 absolute_change:10 relative_change:10",
        on_loans(TARGET_SQL, MOVED_CTE),
    ),
    "drift_verdict": Query(
        _verdict_flat,
        "drift_detected:b drift_strength:s drift_indicators:s affected_features:s score_psi:9 score_ks:10 target_relative_change:9",
        on_loans(
            "SELECT k > 0 AS drift_detected, CASE WHEN k = 0 THEN 'None' WHEN k <= 2 THEN 'Mild' ELSE 'Severe' END AS drift_strength, "
            "drift_indicators, affected_features, score_psi, score_ks, change AS target_relative_change FROM verdict",
            *ALL_CTES, VERDICT_CTE,
        ),
    ),
    "profile_verdict": Query(
        profile_verdict,
        "drift_detected:b drift_strength:s drift_indicators:s affected_features:s score_psi:9 score_ks:10 target_relative_change:9",
        on_loans(
            "SELECT k > 0 AS drift_detected, CASE WHEN k = 0 THEN 'None' WHEN k <= 2 THEN 'Mild' ELSE 'Severe' END AS drift_strength, "
            "drift_indicators, affected_features, score_psi, score_ks, change AS target_relative_change FROM verdict",
            *ALL_CTES, VERDICT_CTE,
        ),
    ),
    "alerts": Query(
        lambda s, d: daily_alerts(s, d).withColumn("day", F.to_date("ts")),
        "type:s value:12 threshold:6 message:s day:d",
        f"SELECT * FROM {DAILY_SQL}",
    ),
    "alert_history": Query(
        alert_history,
        "report_date:d run:s type:s value:12 threshold:6 message:s day:d",
        " UNION ALL ".join(
            f"SELECT DATE '{REPORT_DATE}' - {back} AS report_date, 'daily' AS run, type, value, threshold, message, day FROM {DAILY_SQL} "
            f"WHERE day <= DATE '{REPORT_DATE}' - {back}" for back in (0, 1)
        ),
    ),
    "alert_summary": Query(
        _summary,
        "total_alerts:i period_days:i alert_frequency:9 psi_alert:i ks_alert:i calibration_alert:i drift_alert:i last_type:s last_value:12 "
        "last_day:d",
        f"WITH a AS (SELECT * FROM ({ALERTS_SQL}) WHERE {RECENT}) SELECT count(*) AS total_alerts, {DAYS_BACK} AS period_days, count(*) / "
        f"{DAYS_BACK}e0 AS alert_frequency, count_if(type = 'PSI_ALERT') AS psi_alert, count_if(type = 'KS_ALERT') AS ks_alert, "
        "count_if(type = 'CALIBRATION_ALERT') AS calibration_alert, count_if(type = 'DRIFT_ALERT') AS drift_alert, "
        "(SELECT type FROM a ORDER BY day DESC, type DESC, value DESC LIMIT 1) AS last_type, "
        "(SELECT value FROM a ORDER BY day DESC, type DESC, value DESC LIMIT 1) AS last_value, max(day) AS last_day FROM a",
    ),
    "monitoring_report": Query(
        _report,
        "model_name:s report_date:d total_alerts:i drift_detected:b performance_degradation:b calibration_issues:b recommendations:s",
        f"WITH a AS (SELECT * FROM ({ALERTS_SQL}) WHERE day = DATE '{REPORT_DATE}'), f AS (SELECT count(*) AS total_alerts, "
        "count_if(type = 'DRIFT_ALERT') > 0 AS drift_detected, count_if(type IN ('PSI_ALERT', 'KS_ALERT')) > 0 AS performance_degradation, "
        "count_if(type = 'CALIBRATION_ALERT') > 0 AS calibration_issues FROM a) "
        f"SELECT '{MODEL}' AS model_name, DATE '{REPORT_DATE}' AS report_date, *, CASE WHEN total_alerts = 0 THEN "
        f"'{alerts.ADVICE_STABLE}' ELSE concat_ws('; ', CASE WHEN drift_detected THEN '{alerts.ADVICE['drift_detected']}' END, "
        f"CASE WHEN performance_degradation THEN '{alerts.ADVICE['performance_degradation']}' END, CASE WHEN calibration_issues THEN "
        f"'{alerts.ADVICE['calibration_issues']}' END) END AS recommendations FROM f",
    ),
}
