"""Model performance queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lossgrid.operators import discrimination as dm
from lossgrid.plans.oracle import AUC, KS, on_loans, score_ctes
from lossgrid.plans.registry import Query
from lossgrid.sources.loan_book import loan_book

SCORE = {"score": "score", "label": "y"}


def scored_loans(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """Loans with a score on [0, 1] that rises a little with default and has many ties."""
    loans = loan_book(spark, sf_dir, "id", "pd_12m", "y", *extra)
    return loans.withColumn("score", F.col("pd_12m") * 2.0 + F.col("y") * 0.1)


def model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long (model, id, y, score) table of three scoring columns."""
    loans = loan_book(spark, sf_dir, "id", "y", "pd_12m", "original_pd", "dpd")
    rows = F.array(
        F.struct(F.lit("current").alias("model"), F.col("pd_12m").alias("score")),
        F.struct(F.lit("original").alias("model"), F.col("original_pd").alias("score")),
        F.struct(F.lit("arrears").alias("model"), (F.col("dpd") / 120.0).alias("score")),
    )
    return loans.select("id", "y", F.inline(rows))


SCORED_SQL = "SELECT id, segment, y, pd_12m * 2e0 + y * 0.1e0 AS score, 1e0 AS w, exposure, is_ref FROM loan"
WEIGHTED_SQL = "SELECT id, y, pd_12m * 2e0 + y * 0.1e0 AS score, exposure AS w FROM loan"
MODELS_SQL = (
    "SELECT 'current' AS model, y, pd_12m AS score, 1e0 AS w FROM loan UNION ALL SELECT 'original', y, original_pd, 1e0 "
    "FROM loan UNION ALL SELECT 'arrears', y, dpd / 120e0, 1e0 FROM loan"
)


def confusion_sql(source: str, keys: str = "") -> str:
    cells = (
        "sum(CASE WHEN score >= 0.5e0 AND y = 1 THEN w ELSE 0e0 END) AS tp, "
        "sum(CASE WHEN score >= 0.5e0 AND y = 0 THEN w ELSE 0e0 END) AS fp, "
        "sum(CASE WHEN score < 0.5e0 AND y = 1 THEN w ELSE 0e0 END) AS fn, "
        "sum(CASE WHEN score < 0.5e0 AND y = 0 THEN w ELSE 0e0 END) AS tn"
    )
    group = f"GROUP BY {keys}" if keys else ""
    head = f"{keys}, " if keys else ""
    return (
        "SELECT *, coalesce(tp / nullif(tp + fp, 0e0), 0e0) AS precision, coalesce(tp / nullif(tp + fn, 0e0), 0e0) AS recall, "
        "coalesce(2e0 * tp / nullif(2e0 * tp + fp + fn, 0e0), 0e0) AS f1_score, "
        f"(tp + tn) / (tp + tn + fp + fn) AS accuracy FROM (SELECT {head}{cells} FROM ({source}) {group})"
    )


_BIN = " + ".join(f"(score > {i * 0.1!r}::DOUBLE)::INT" for i in range(1, 10))
_CENTRES = "[" + ", ".join(f"({i * 0.1!r}::DOUBLE + {((i + 1) * 0.1 if i < 9 else 1.0)!r}::DOUBLE) / 2e0" for i in range(10)) + "]"
BINS_SQL = (
    f"SELECT bin, {_CENTRES}[bin + 1] AS bin_center, count(*) AS n, avg(y) AS observed_rate, avg(score) AS predicted_rate, "
    f"abs(avg(y) - avg(score)) AS calibration_error FROM (SELECT *, {_BIN} AS bin FROM ({SCORED_SQL})) GROUP BY bin"
)
F11_LO, F11_HI, F11_N = "(SELECT min(exposure) FROM loan)", "(SELECT max(exposure) FROM loan)", 20

QUERIES = {
    "confusion_metrics": Query(
        lambda s, d: dm.confusion_metrics(scored_loans(s, d), **SCORE),
        "tp:i fp:i fn:i tn:i precision:10 recall:10 f1_score:10 accuracy:10",
        on_loans(confusion_sql(SCORED_SQL)),
    ),
    "confusion_metrics_weighted": Query(
        lambda s, d: dm.confusion_metrics(scored_loans(s, d, "exposure"), weight="exposure", **SCORE),
        "tp:2 fp:2 fn:2 tn:2 precision:9 recall:9 f1_score:9 accuracy:9",
        on_loans(confusion_sql(WEIGHTED_SQL)),
    ),
    "default_rates": Query(
        lambda s, d: dm.default_rates(scored_loans(s, d, "segment"), by=["segment"], **SCORE),
        "segment:s default_rate:10 predicted_default_rate:10",
        on_loans(
            f"SELECT segment, avg(y) AS default_rate, avg(score) AS predicted_default_rate FROM ({SCORED_SQL}) GROUP BY segment"
        ),
    ),
    "auc_roc": Query(
        lambda s, d: dm.auc_ks(scored_loans(s, d), **SCORE).select("auc_roc"),
        "auc_roc:10",
        on_loans(f"SELECT {AUC} AS auc_roc FROM st", score_ctes(SCORED_SQL)),
    ),
    "auc_roc_weighted": Query(
        lambda s, d: dm.auc_ks(scored_loans(s, d, "exposure"), weight="exposure", **SCORE),
        "auc_roc:9 gini:9 ks_statistic:9",
        on_loans(
            f"SELECT auc_roc, 2e0 * auc_roc - 1e0 AS gini, ks_statistic FROM (SELECT {AUC} AS auc_roc, {KS} AS ks_statistic FROM st)",
            score_ctes(WEIGHTED_SQL),
        ),
    ),
    "gini": Query(
        lambda s, d: dm.auc_ks(scored_loans(s, d, "segment"), by=["segment"], **SCORE).select("segment", "gini"),
        "segment:s gini:10",
        on_loans(f"SELECT segment, 2e0 * ({AUC}) - 1e0 AS gini FROM st GROUP BY segment", score_ctes(SCORED_SQL, ["segment"])),
    ),
    "ks_good_bad": Query(
        lambda s, d: dm.auc_ks(scored_loans(s, d, "segment"), by=["segment"], **SCORE).select("segment", "ks_statistic"),
        "segment:s ks_statistic:10",
        on_loans(f"SELECT segment, {KS} AS ks_statistic FROM st GROUP BY segment", score_ctes(SCORED_SQL, ["segment"])),
    ),
    "performance_report": Query(
        lambda s, d: dm.performance_report(scored_loans(s, d, "segment"), by=["segment"], **SCORE),
        "segment:s auc_roc:10 gini:10 ks_statistic:10 precision:10 recall:10 f1_score:10 accuracy:10 default_rate:10 "
        "predicted_default_rate:10",
        on_loans(
            "SELECT a.segment, a.auc_roc, 2e0 * a.auc_roc - 1e0 AS gini, a.ks_statistic, c.precision, c.recall, c.f1_score, "
            "c.accuracy, r.default_rate, r.predicted_default_rate FROM "
            f"(SELECT segment, {AUC} AS auc_roc, {KS} AS ks_statistic FROM st GROUP BY segment) a "
            f"JOIN ({confusion_sql(SCORED_SQL, 'segment')}) c ON a.segment = c.segment "
            "JOIN (SELECT segment, avg(y) AS default_rate, avg(score) AS predicted_default_rate "
            f"FROM ({SCORED_SQL}) GROUP BY segment) r ON a.segment = r.segment",
            score_ctes(SCORED_SQL, ["segment"]),
        ),
    ),
    "roc_curve": Query(
        lambda s, d: dm.roc_curve(scored_loans(s, d), **SCORE),
        "threshold:10 fpr:10 tpr:10",
        on_loans(
            "SELECT score AS threshold, (neg_total - neg_upto + neg) / neg_total AS fpr, (pos_total - pos_upto + pos) / pos_total "
            "AS tpr FROM st UNION ALL SELECT NULL, 0e0, 0e0",
            score_ctes(SCORED_SQL),
        ),
    ),
    "pr_curve": Query(
        lambda s, d: dm.pr_curve(scored_loans(s, d), **SCORE),
        "threshold:10 precision:10 recall:10",
        on_loans(
            "SELECT score AS threshold, tp / (tp + fp) AS precision, tp / pos_total AS recall FROM (SELECT *, "
            "pos_total - pos_upto + pos AS tp, neg_total - neg_upto + neg AS fp FROM st)",
            score_ctes(SCORED_SQL),
        ),
    ),
    "average_precision": Query(
        lambda s, d: dm.average_precision(scored_loans(s, d), **SCORE),
        "average_precision:10",
        on_loans(
            "SELECT sum(tp / (tp + fp) * pos / pos_total) AS average_precision FROM (SELECT *, pos_total - pos_upto + pos AS tp, "
            "neg_total - neg_upto + neg AS fp FROM st)",
            score_ctes(SCORED_SQL),
        ),
    ),
    "evaluate_auc_ap": Query(
        lambda s, d: dm.evaluate(scored_loans(s, d, "segment"), by=["segment"], **SCORE),
        "segment:s roc_auc:10 pr_auc:10",
        on_loans(
            f"SELECT segment, {AUC} AS roc_auc, sum(tp / (tp + fp) * pos / pos_total) AS pr_auc FROM (SELECT *, "
            "pos_total - pos_upto + pos AS tp, neg_total - neg_upto + neg AS fp FROM st) GROUP BY segment",
            score_ctes(SCORED_SQL, ["segment"]),
        ),
    ),
    "compare_models": Query(
        lambda s, d: dm.compare_models(model_scores(s, d), **SCORE),
        "model:s roc_auc:10 pr_auc:10",
        on_loans(
            f"SELECT model, {AUC} AS roc_auc, sum(tp / (tp + fp) * pos / pos_total) AS pr_auc FROM (SELECT *, "
            "pos_total - pos_upto + pos AS tp, neg_total - neg_upto + neg AS fp FROM st) GROUP BY model",
            score_ctes(MODELS_SQL, ["model"]),
        ),
    ),
    "calibration_bins": Query(
        lambda s, d: dm.calibration_bins(scored_loans(s, d), **SCORE),
        "bin:i bin_center:10 n:i observed_rate:10 predicted_rate:10 calibration_error:10",
        on_loans(BINS_SQL),
    ),
    "calibration_summary": Query(
        lambda s, d: dm.calibration_summary(scored_loans(s, d), **SCORE),
        "expected_calibration_error:10 maximum_calibration_error:10 brier_score:10 reliability:10 resolution:10 uncertainty:10",
        on_loans(
            "SELECT sum(n / t * calibration_error) AS expected_calibration_error, max(calibration_error) AS "
            "maximum_calibration_error, max(brier) AS brier_score, sum(n / t * calibration_error * calibration_error) AS "
            "reliability, sum(n / t * (observed_rate - base) * (observed_rate - base)) AS resolution, "
            "max(base * (1e0 - base)) AS uncertainty FROM "
            f"({BINS_SQL}), (SELECT count(*)::DOUBLE AS t, avg(y) AS base, avg((score - y) * (score - y)) AS brier FROM ({SCORED_SQL}))"
        ),
    ),
    "calibration_curve": Query(
        lambda s, d: dm.calibration_curve(scored_loans(s, d), **SCORE),
        "mean_predicted:10 fraction_positive:10",
        on_loans(f"SELECT predicted_rate AS mean_predicted, observed_rate AS fraction_positive FROM ({BINS_SQL})"),
    ),
    "default_rate_by_bin": Query(
        lambda s, d: dm.default_rate_by_bin(loan_book(s, d, "exposure", "y"), feature="exposure", label="y"),
        "bin:i n:i defaults:i default_rate:3",
        on_loans(
            "SELECT b.bin, count(x.y) AS n, coalesce(sum(x.y), 0) AS defaults, avg(x.y) AS default_rate FROM "
            f"range({F11_N}) AS b(bin) LEFT JOIN (SELECT y, exposure, {F11_LO} AS lo, ({F11_HI} - {F11_LO}) / {F11_N}e0 AS w "
            "FROM loan) x ON (x.exposure > x.lo + b.bin * x.w AND (x.exposure <= x.lo + (b.bin + 1) * x.w "
            f"OR b.bin = {F11_N - 1})) OR (b.bin = 0 AND x.exposure = x.lo) GROUP BY b.bin"
        ),
    ),
}
