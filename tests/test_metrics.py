"""Performance, drift and alert operators: edge cases, identities, brute force."""

from __future__ import annotations

import datetime as dt
import itertools
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lossgrid.operators import alerts, discrimination as dm, drift

S = {"score": "s", "label": "y"}


def scores(spark, rows):
    return spark.createDataFrame(rows, "s double, y int, w double")


def brute_auc(rows, weighted=False):
    num = den = 0.0
    for s1, y1, w1 in rows:
        for s0, y0, w0 in rows:
            if y1 == 1 and y0 == 0:
                w = w1 * w0 if weighted else 1.0
                num += w * (1.0 if s1 > s0 else 0.5 if s1 == s0 else 0.0)
                den += w
    return num / den


def test_auc_ks_and_ap_against_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(round(float(rng.normal(0.4 + 0.2 * y, 0.2)), 1), y, float(rng.uniform(0.5, 2))) for y in rng.integers(0, 2, 120).tolist()]
    df = scores(spark, rows)
    assert dm.auc_ks(df, **S).first()["auc_roc"] == pytest.approx(brute_auc(rows))
    assert dm.auc_ks(df, weight="w", **S).first()["auc_roc"] == pytest.approx(brute_auc(rows, True))
    good, bad = [s for s, y, _ in rows if y == 0], [s for s, y, _ in rows if y == 1]
    gap = max(abs(np.mean([g <= x for g in good]) - np.mean([b <= x for b in bad])) for x, _, _ in rows)
    report = dm.performance_report(df, **S).first()
    assert report["ks_statistic"] == pytest.approx(gap)
    assert report["gini"] == pytest.approx(2 * report["auc_roc"] - 1)
    assert report["predicted_default_rate"] == pytest.approx(np.mean([s for s, _, _ in rows]))
    assert dm.average_precision(df, **S).first()[0] == pytest.approx(dm.evaluate(df, **S).first()["pr_auc"])
    curve = dm.roc_curve(df, **S).orderBy("fpr", "tpr").collect()
    area = sum((b["fpr"] - a["fpr"]) * (a["tpr"] + b["tpr"]) / 2 for a, b in zip(curve, curve[1:]))
    assert area == pytest.approx(report["auc_roc"])


def test_one_class_and_tied_scores(spark):
    one = dm.auc_ks(scores(spark, [(0.1, 0, 1.0), (0.9, 0, 1.0)]), **S).first()
    assert (one["auc_roc"], one["ks_statistic"]) == (0.5, 0.0)
    tied = dm.auc_ks(scores(spark, [(0.3, 0, 1.0), (0.3, 1, 1.0), (0.3, 1, 1.0)]), **S).first()
    assert (tied["auc_roc"], tied["ks_statistic"]) == (0.5, 0.0)
    empty = dm.confusion_metrics(scores(spark, [(0.1, 1, 1.0)]), **S).first()
    assert (empty["precision"], empty["recall"], empty["f1_score"]) == (0.0, 0.0, 0.0)


def test_calibration_bins_are_right_closed_and_cover_everything(spark):
    rows = [(s, 1, 1.0) for s in (-0.2, 0.0, 0.1, 0.1000001, 0.9, 0.95, 1.0, 1.7)]
    found = {r["bin"]: r["n"] for r in dm.calibration_bins(scores(spark, rows), **S).collect()}
    assert found == {0: 3, 1: 1, 8: 1, 9: 3}


def test_brier_decomposition(spark):
    rng = np.random.default_rng(4)
    p = rng.uniform(0, 1, 400)
    y = rng.binomial(1, p)
    row = dm.calibration_summary(scores(spark, [(float(a), int(b), 1.0) for a, b in zip(p, y)]), **S).first()
    assert row["brier_score"] == pytest.approx(np.mean((p - y) ** 2))
    assert row["uncertainty"] == pytest.approx(y.mean() * (1 - y.mean()))
    assert 0 <= row["expected_calibration_error"] <= row["maximum_calibration_error"]
    assert all(v >= 0 for v in row)


def test_default_rates_keep_empty_bins(spark):
    df = spark.createDataFrame([(0.0, 1), (0.1, 0), (10.0, 1)], "x double, y int")
    rows = dm.default_rate_by_bin(df, feature="x", label="y", bins=5).orderBy("bin").collect()
    assert [r["n"] for r in rows] == [2, 0, 0, 0, 1]
    assert rows[0]["default_rate"] == 0.5 and rows[1]["default_rate"] is None


def numpy_psi(ref, cur, edges):
    edges = np.unique(edges)
    r = np.histogram(ref, bins=edges)[0] + 1e-6
    c = np.histogram(cur, bins=edges)[0] + 1e-6
    r, c = r / r.sum(), c / c.sum()
    return float(np.sum((c - r) * np.log(c / r)))


@pytest.fixture(scope="module")
def samples(spark):
    rng = np.random.default_rng(42)
    ref, cur = np.round(rng.normal(0.30, 0.15, 700), 3), np.round(rng.normal(0.35, 0.18, 900), 3)
    ties_ref, ties_cur = rng.integers(0, 4, 700).astype(float), rng.integers(1, 6, 900).astype(float)
    rows = [(1, float(a), float(b)) for a, b in zip(ref, ties_ref)] + [(0, float(a), float(b)) for a, b in zip(cur, ties_cur)]
    return spark.createDataFrame(rows, "is_ref int, x double, ties double"), {"x": (ref, cur), "ties": (ties_ref, ties_cur)}


@pytest.mark.parametrize("method", ["quantile", "equal_width"])
def test_psi_equals_numpy_with_ties_and_values_outside(samples, method):
    df, arrays = samples
    for row in drift.psi(df, features=["x", "ties"], is_ref="is_ref", method=method).collect():
        ref, cur = arrays[row["feature"]]
        edges = np.percentile(ref, np.linspace(0, 100, 11)) if method == "quantile" else np.linspace(ref.min(), ref.max(), 11)
        assert row["psi"] == pytest.approx(numpy_psi(ref, cur, edges), abs=1e-9)
        assert row["out_of_range"] == int(((cur < ref.min()) | (cur > ref.max())).sum())
    shares = drift.psi_bins(df, features=["x"], is_ref="is_ref", method=method)
    sums = shares.agg(F.sum("reference_pct"), F.sum("current_pct")).first()
    assert sums[0] == pytest.approx(1.0) and sums[1] == pytest.approx(1.0)


def test_exact_ks_counts_all_orderings(spark):
    """Against the share of all orderings of small samples, and against the limit for larger ones."""
    rows, known = [], {}
    for g, (n, m) in enumerate([(1, 1), (1, 6), (4, 3), (5, 5), (2, 9)]):
        distances = Counter()
        for places in itertools.combinations(range(n + m), n):
            x = np.isin(np.arange(n + m), places)
            distances[int(np.abs(np.cumsum(x) * m - np.cumsum(~x) * n).max())] += 1
        total = sum(distances.values())
        for d in distances:
            rows.append((g * 1000 + d, d / (n * m), n, m))
            known[g * 1000 + d] = sum(c for e, c in distances.items() if e >= d) / total
    rows += [(-1, 0.0, 3, 4), (-2, None, 3, 4), (-3, 0.5, 0, 4), (-4, 1.0, 40, 30), (-5, 0.08, 600, 900)]
    df = spark.createDataFrame(rows, "id long, d double, n long, m long")
    p = drift.exact_kolmogorov_p_value(F.col("d"), F.col("n"), F.col("m"))
    limit = drift.kolmogorov_p_value(F.col("d"), F.col("n"), F.col("m"))
    found = {r["id"]: r for r in df.select("id", p.alias("p"), limit.alias("limit")).collect()}
    for key, value in known.items():
        assert found[key]["p"] == pytest.approx(value, rel=1e-12)
    assert found[-1]["p"] == 1.0 and found[-2]["p"] is None and found[-3]["p"] is None
    assert found[-4]["p"] == pytest.approx(2 / math.comb(70, 30), rel=1e-9)  # far below what 1 - x could hold
    assert found[-5]["p"] == pytest.approx(found[-5]["limit"], rel=0.1)


def test_ks_is_exact_for_small_groups_only(spark):
    rows = [("small", float(i), int(i % 3 > 0)) for i in range(9)] + [("large", float(i % 50), int(i % 2)) for i in range(60)]
    rows += [("one side", 1.0, 1), (None, 1.0, 0), (None, 2.0, 1)]
    df = spark.createDataFrame(rows, "g string, x double, is_ref int")
    exact = {r["g"]: r for r in drift.ks_two_sample(df, features=["x"], is_ref="is_ref", by=["g"], exact_rows=20).collect()}
    limit = {r["g"]: r for r in drift.ks_two_sample(df, features=["x"], is_ref="is_ref", by=["g"]).collect()}
    assert set(exact) == {"small", "large", "one side", None}
    assert exact["large"] == limit["large"] and exact["small"]["p_value"] != limit["small"]["p_value"]
    assert exact[None]["p_value"] == pytest.approx(1.0) and exact["one side"]["p_value"] is None


def test_feature_drift_agrees_with_its_parts(samples):
    df, arrays = samples
    psi = {r["feature"]: r["psi"] for r in drift.psi(df, features=["x", "ties"], is_ref="is_ref").collect()}
    ks = {r["feature"]: r for r in drift.ks_two_sample(df, features=["x", "ties"], is_ref="is_ref").collect()}
    for row in drift.feature_drift(df, features=["x", "ties"], is_ref="is_ref").collect():
        f = row["feature"]
        assert row["psi"] == pytest.approx(psi[f]) and row["ks_statistic"] == pytest.approx(ks[f]["ks_statistic"])
        ref, cur = map(np.sort, arrays[f])
        grid = np.concatenate([ref, cur])
        gap = np.abs(np.searchsorted(ref, grid, side="right") / len(ref) - np.searchsorted(cur, grid, side="right") / len(cur))
        assert row["ks_statistic"] == pytest.approx(gap.max())
        z = gap.max() * math.sqrt(len(ref) * len(cur) / (len(ref) + len(cur)))
        p = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * z * z) for k in range(1, 101))
        assert row["ks_p_value"] == pytest.approx(min(max(p, 0), 1), abs=1e-9)


def test_groups_of_drift_may_be_null(samples):
    df, _ = samples
    both = df.withColumn("g", F.lit(None).cast("string")).unionByName(df.withColumn("g", F.lit("a")))
    rows = drift.feature_drift(both, features=["x"], is_ref="is_ref", by=["g"]).collect()
    assert {r["g"] for r in rows} == {None, "a"} and rows[0]["psi"] == pytest.approx(rows[1]["psi"])


def test_identical_constant_and_unknown(spark):
    rows = [(flag, float(v % 50), 0.5) for v in range(200) for flag in (0, 1)]
    df = spark.createDataFrame(rows, "is_ref int, x double, c double")
    same = drift.feature_drift(df, features=["x"], is_ref="is_ref").first()
    assert same["psi"] < 0.01 and same["ks_statistic"] < 0.01 and same["ks_p_value"] == 1.0 and not same["affected"]
    constant = drift.psi(df, features=["c"], is_ref="is_ref").first()
    assert constant["psi"] == 0.0 and constant["warning"] == drift.PSI_WARNING and constant["interpretation"] is None
    with pytest.raises(ValueError):
        drift.psi(df, features=["x"], is_ref="is_ref", method="other")


def test_verdict_counts_indicators(spark):
    rows = [(1, i / 100, 0, float(i)) for i in range(100)] + [(0, 0.5 + i / 100, int(i < 80), float(i)) for i in range(100)]
    df = spark.createDataFrame(rows, "is_ref int, s double, y int, f double")
    severe = drift.drift_verdict(df, score="s", label="y", is_ref="is_ref", features=["f"]).first()
    assert severe["drift_strength"] == "Severe" and severe["affected_features"] == ["target_distribution"]
    assert severe["drift_indicators"] == ["score_psi", "score_ks", "feature_drift"]
    calm = df.withColumns({"s": F.col("f"), "y": F.lit(1)})
    none = drift.drift_verdict(calm, score="s", label="y", is_ref="is_ref", features=["f"]).first()
    assert (none["drift_detected"], none["drift_strength"], none["affected_features"]) == (False, "None", [])


def test_ks_power_is_null_for_a_missing_class(spark):
    df = spark.createDataFrame([(1, 0.1, 0), (1, 0.2, 0), (0, 0.3, 0), (0, 0.4, 1)], "is_ref int, s double, y int")
    row = drift.ks_power_change(df, score="s", label="y", is_ref="is_ref").first()
    assert (row["reference_ks_power"], row["current_ks_power"], row["ks_power_change"]) == (None, 1.0, None)


def test_alerts_are_strict_and_custom_thresholds_merge(spark):
    now = dt.datetime(2024, 1, 10, 12)
    metrics = spark.createDataFrame(
        [("psi", 0.25, now), ("psi", 0.26, now), ("ks_statistic", 0.15, now), ("other", 9.0, now)],
        "metric string, value double, ts timestamp_ntz",
    )
    found = alerts.metric_alerts(metrics)
    assert found.schema.simpleString() == alerts.ALERT_SCHEMA.simpleString()
    assert sorted(r["type"] for r in found.collect()) == ["KS_ALERT", "PSI_ALERT"]
    assert alerts.metric_alerts(metrics, thresholds={"ks_threshold": 0.2}).count() == 1


def test_alert_table_summary_and_report(spark, tmp_path):
    metrics = spark.createDataFrame(
        [("psi", 0.5, dt.datetime(2024, 1, 10)), ("psi", 0.4, dt.datetime(2023, 1, 1)),
         ("expected_calibration_error", 0.3, dt.datetime(2024, 1, 11))],
        "metric string, value double, ts timestamp_ntz",
    )
    path = str(tmp_path / "alerts")
    alerts.append_alerts(alerts.metric_alerts(metrics), path)
    alerts.append_alerts(alerts.metric_alerts(metrics.limit(0)), path)
    table = spark.read.parquet(path)
    row = alerts.alert_summary(table, as_of=dt.datetime(2024, 1, 12), days_back=30).first()
    assert (row["total_alerts"], row["alert_types"], row["alert_frequency"]) == (2, {"CALIBRATION_ALERT": 1, "PSI_ALERT": 1}, 2 / 30)
    assert row["most_recent_alert"]["type"] == "CALIBRATION_ALERT"
    none = alerts.alert_summary(table, as_of=dt.datetime(2020, 1, 1)).first()
    assert (none["total_alerts"], none["most_recent_alert"]) == (0, None)
    report = alerts.monitoring_report(table, model_name="m", report_date=dt.date(2024, 1, 10)).first()
    assert report["performance_degradation"] and not report["drift_detected"] and len(report["recommendations"]) == 1
    stable = alerts.monitoring_report(table, model_name="m", report_date=dt.date(2024, 2, 1)).first()
    assert stable["recommendations"] == [alerts.ADVICE_STABLE]


def test_alert_batches_are_replaced_as_a_whole(spark, tmp_path):
    day, path = dt.date(2024, 1, 10), str(tmp_path / "history")
    metrics = spark.createDataFrame([("psi", 0.5, dt.datetime(2024, 1, 10)), ("psi", 0.4, dt.datetime(2024, 1, 9))], "metric string, value double, ts timestamp_ntz")
    found = alerts.metric_alerts(metrics)
    alerts.write_alerts(found, path, report_date=day, run="a")
    alerts.write_alerts(found, path, report_date=day, run="a")
    alerts.write_alerts(found.filter("value > 0.45"), path, report_date=day, run="b")
    alerts.write_alerts(found, path, report_date=dt.date(2024, 1, 11), run="a")
    per_batch = {(r.report_date, r.run): r["count"] for r in alerts.read_alerts(spark, path).groupBy("report_date", "run").count().collect()}
    assert per_batch == {(day, "a"): 2, (day, "b"): 1, (dt.date(2024, 1, 11), "a"): 2}
    alerts.write_alerts(found.limit(0), path, report_date=day, run="a")
    assert alerts.read_alerts(spark, path).filter(F.col("run") == "a").count() == 2
    with pytest.raises(ValueError):
        alerts.write_alerts(found, path, report_date=day, run="a/b")
