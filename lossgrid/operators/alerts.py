"""Alert records, their summary, and the monitoring report. Alerts are rows of a table that grows by batches."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lossgrid.operators.drift import merged_thresholds

ALERT_SCHEMA = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("strength", T.StringType()),
        T.StructField("indicators", T.ArrayType(T.StringType())),
        T.StructField("affected_features", T.ArrayType(T.StringType())),
        T.StructField("message", T.StringType()),
        T.StructField("ts", T.TimestampNTZType()),
    ]
)
# Metric name -> alert type, threshold name, message.
METRIC_ALERTS = {
    "psi": ("PSI_ALERT", "psi_threshold", "PSI value %.4f exceeds threshold"),
    "ks_statistic": ("KS_ALERT", "ks_threshold", "KS statistic %.4f indicates distribution shift"),
    "expected_calibration_error": (
        "CALIBRATION_ALERT", "calibration_error", "Expected Calibration Error %.4f exceeds threshold",
    ),
}
# Report flag -> advice, and the advice when no flag is set.
ADVICE = {
    "drift_detected": "Consider model retraining due to detected concept drift",
    "performance_degradation": "Investigate population stability and model discriminatory power",
    "calibration_issues": "Review model calibration and consider recalibration",
}
ADVICE_STABLE = "Model performance is stable - continue monitoring"


def metric_alerts(metrics: DataFrame, *, thresholds: dict[str, float] | None = None) -> DataFrame:
    """Alert rows for (metric, value, ts) rows whose value is strictly above its threshold."""
    limits = merged_thresholds(thresholds)
    kind = limit = message = None
    for metric, (alert_type, name, text) in METRIC_ALERTS.items():
        is_metric = F.col("metric") == metric
        kind = F.when(is_metric, alert_type) if kind is None else kind.when(is_metric, alert_type)
        limit = F.when(is_metric, float(limits[name])) if limit is None else limit.when(is_metric, float(limits[name]))
        line = F.format_string(text, "value")
        message = F.when(is_metric, line) if message is None else message.when(is_metric, line)
    no_text, no_list = F.lit(None).cast("string"), F.lit(None).cast("array<string>")
    return (
        metrics.withColumn("threshold", limit)
        .filter(F.col("value") > F.col("threshold"))
        .select(
            kind.alias("type"),
            "value",
            "threshold",
            no_text.alias("strength"),
            no_list.alias("indicators"),
            no_list.alias("affected_features"),
            message.alias("message"),
            F.col("ts").cast("timestamp_ntz").alias("ts"),
        )
    )


def drift_alerts(verdicts: DataFrame, *, ts: Column) -> DataFrame:
    """Alert rows for drift verdicts that detected something."""
    return verdicts.filter("drift_detected").select(
        F.lit("DRIFT_ALERT").alias("type"),
        F.lit(None).cast("double").alias("value"),
        F.lit(None).cast("double").alias("threshold"),
        F.col("drift_strength").alias("strength"),
        F.col("drift_indicators").alias("indicators"),
        "affected_features",
        F.concat(F.lit("Concept drift detected ("), "drift_strength", F.lit(")")).alias("message"),
        ts.cast("timestamp_ntz").alias("ts"),
    )


def append_alerts(alerts: DataFrame, path: str) -> None:
    """Append to the alert table, partitioned by day so that date filters prune. A repeated run appends again."""
    alerts.withColumn("alert_date", F.to_date("ts")).write.mode("append").partitionBy("alert_date").parquet(path)


def write_alerts(alerts: DataFrame, path: str, *, report_date: dt.date, run: str) -> None:
    """Write the batch of a (report date, run) as a whole: a repeated run replaces what it wrote before.

    A batch is one folder, ``report_date=<date>/run=<name>``, with one file: the alerts of a run are few. The file appears
    when the job commits, so readers see the old batch, the new one or for a moment none, never a part. Batches of
    other dates and runs stay; a batch without alerts replaces an earlier one too.
    """
    if not re.fullmatch(r"[\w.-]+", run):
        raise ValueError(f"run names are letters, digits, '_', '.' and '-': {run!r}")
    typed = alerts.select(*[F.col(f.name).cast(f.dataType) for f in ALERT_SCHEMA.fields])
    typed.coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/report_date={report_date.isoformat()}/run={run}")


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """All batches: the alert columns, ``report_date`` and ``run``. Dates and runs prune to folders."""
    schema = T.StructType([*ALERT_SCHEMA.fields, T.StructField("report_date", T.DateType()), T.StructField("run", T.StringType())])
    return spark.read.schema(schema).parquet(path)


def alert_summary(alerts: DataFrame, *, as_of: dt.datetime, days_back: int = 30) -> DataFrame:
    """One row over the last ``days_back`` days: total, count per type, daily frequency, newest alert."""
    since = as_of - dt.timedelta(days=days_back)
    recent = alerts.filter((F.col("ts") >= F.lit(since).cast("timestamp_ntz")) & (F.col("ts") <= F.lit(as_of).cast("timestamp_ntz")))
    # Alerts of the same instant: the greatest (type, value) counts as the newest.
    per_type = recent.groupBy("type").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.struct("ts", "type", "value", "message")).alias("newest")
    )
    total = F.coalesce(F.sum("n"), F.lit(0))
    entries = F.map_from_entries(F.sort_array(F.collect_list(F.struct("type", "n"))))
    return per_type.agg(
        total.alias("total_alerts"),
        entries.alias("alert_types"),
        F.lit(days_back).alias("period_days"),
        (total / F.lit(float(days_back))).alias("alert_frequency"),
        F.max("newest").alias("most_recent_alert"),
    )


def monitoring_report(alerts: DataFrame, *, model_name: str, report_date: dt.date) -> DataFrame:
    """One row per (model, date): alert count, issue flags, recommendations."""
    of_day = alerts.filter(F.to_date("ts") == F.lit(report_date))

    def seen(*types: str) -> Column:
        return F.coalesce(F.bool_or(F.col("type").isin(*types)), F.lit(False))

    flags = of_day.agg(
        F.count(F.lit(1)).alias("total_alerts"),
        seen("DRIFT_ALERT").alias("drift_detected"),
        seen("PSI_ALERT", "KS_ALERT").alias("performance_degradation"),
        seen("CALIBRATION_ALERT").alias("calibration_issues"),
    )
    advice = F.array_compact(F.array(*[F.when(F.col(flag), F.lit(text)) for flag, text in ADVICE.items()]))
    return flags.select(
        F.lit(model_name).alias("model_name"),
        F.lit(report_date).alias("report_date"),
        "total_alerts",
        *ADVICE,
        F.when(F.size(advice) > 0, advice).otherwise(F.array(F.lit(ADVICE_STABLE))).alias("recommendations"),
    )
