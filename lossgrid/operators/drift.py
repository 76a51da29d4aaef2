"""Population stability, two-sample KS and drift verdicts between a reference and a current sample.

The samples are rows of one table told apart by a 0/1 column. All features of a job go through together
as (feature, value) rows: one shuffle serves every feature, and extra ``by`` columns add groups.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lossgrid.functions.bins import edge_array_bin
from lossgrid.functions.numeric import melt
from lossgrid.operators.discrimination import score_totals
from lossgrid.operators.ordered import exact_quantiles, quantiles_of_totals, running_totals

# Default alert thresholds, share floor of a bin, limits of the stability reading.
THRESHOLDS = {
    "psi_threshold": 0.25,
    "ks_threshold": 0.1,
    "auc_degradation": 0.05,
    "calibration_error": 0.1,
    "default_rate_shift": 0.5,
}
SHARE_FLOOR = 1e-6
PSI_MINOR, PSI_MAJOR = 0.1, 0.25
PSI_READINGS = ("No significant change", "Some minor change", "Major shift in population")
PSI_WARNING = "Insufficient unique values for PSI calculation"
SIGNIFICANCE = 0.05


def merged_thresholds(custom: dict[str, float] | None) -> dict[str, float]:
    """Custom thresholds over the defaults."""
    return {**THRESHOLDS, **(custom or {})}


def psi_reading(psi: Column) -> Column:
    minor, middle, major = PSI_READINGS
    return F.when(psi < PSI_MINOR, minor).when(psi < PSI_MAJOR, middle).when(psi.isNotNull(), major)


def kolmogorov_p_value(distance: Column, n: Column, m: Column) -> Column:
    """Limiting two-sided p-value; small and large arguments use the series that converges fast there."""
    z = distance * F.sqrt(n.cast("double") * m / (n.cast("double") + m))
    large = sum((F.exp(F.lit(-2.0 * k * k) * z * z) * F.lit(2.0 * (-1) ** (k - 1)) for k in range(1, 6)), F.lit(0.0))
    small = F.lit(1.0) - F.lit(2.5066282746310002) / z * sum(
        (F.exp(F.lit(-((2 * k - 1) ** 2) * 1.2337005501361697) / (z * z)) for k in range(1, 4)), F.lit(0.0)
    )
    p = F.when(z < 0.05, F.lit(1.0)).when(z < 1.0, small).otherwise(large)
    return F.when(z.isNotNull(), F.greatest(F.least(p, F.lit(1.0)), F.lit(0.0)))


def _share_of_orderings(distance: float, n: int, m: int) -> float:
    """Share of the orderings of n and m values with at least this distance.

    An ordering is a lattice path. ``at`` has, along one diagonal, the probability of each point without having left the
    band of smaller distances; what stands outside is added up, so small shares are sums of small numbers.
    """
    a, b = min(n, m), max(n, m)
    limit = round(distance * a * b)
    x = np.arange(a + 1)
    at = np.zeros(a + 1)
    at[0] = 1.0
    gone = 0.0
    for step in range(a + b):
        outside = np.abs(x * (a + b) - step * a) >= limit
        gone += at[outside].sum()
        at[outside] = 0.0
        at /= a + b - step
        along = at * (a - x)
        at *= b - step + x
        at[1:] += along[:-1]
    return min(gone, 1.0)


@F.pandas_udf(T.DoubleType())
def _orderings(distance: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
    rows = zip(distance, n, m)
    return pd.Series([None if pd.isna(d) else _share_of_orderings(d, int(i), int(j)) for d, i, j in rows], dtype="float64")


def exact_kolmogorov_p_value(distance: Column, n: Column, m: Column) -> Column:
    """Exact two-sided p-value; NULL without a distance or for an empty sample. Takes (n + m) * min(n, m) small steps."""
    known = distance.isNotNull() & (F.least(n, m) > 0)
    return _orderings(F.when(known, distance), F.coalesce(n, F.lit(0)), F.coalesce(m, F.lit(0)))


KEY = "_key"  # struct of the group columns and the feature: NULL groups match in plain joins


def _unpack(df: DataFrame) -> DataFrame:
    return df.select(f"{KEY}.*", *[c for c in df.columns if c != KEY])


def _long(df: DataFrame, features: Sequence[str], is_ref: str, by: Sequence[str]) -> DataFrame:
    """Rows (key, value, n_ref, n_cur) with exactly one of the counts 1; no shuffle."""
    reference = F.col(is_ref) == 1
    return (
        melt(df, list(features), keep=[*by, is_ref])
        .filter(F.col("value").isNotNull() & F.col(is_ref).isNotNull())
        .select(
            F.struct(*by, "feature").alias(KEY),
            "value",
            F.when(reference, 1).otherwise(0).cast("bigint").alias("n_ref"),
            F.when(reference, 0).otherwise(1).cast("bigint").alias("n_cur"),
        )
    )


def _psi_edges(long: DataFrame, n_bins: int, method: str, by: Sequence[str]) -> DataFrame:
    """key + sorted, de-duplicated bin edges taken from the reference sample."""
    reference = long.filter(F.col("n_ref") == 1)
    if method == "quantile":
        probs = [i / n_bins for i in range(n_bins + 1)]
        found = exact_quantiles(reference, "value", probs, [KEY], few_groups=not by).withColumnRenamed("quantiles", "edges")
    elif method == "equal_width":
        lo, hi = F.col("lo"), F.col("hi")
        step = (hi - lo) / F.lit(float(n_bins))
        points = [lo + F.lit(float(i)) * step for i in range(n_bins)] + [hi]
        found = reference.groupBy(KEY).agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
        found = found.select(KEY, F.array(*points).alias("edges"))
    else:
        raise ValueError(f"unknown binning method: {method}")
    return found.select(KEY, F.array_distinct("edges").alias("edges"))


def _psi_row(
    counted: DataFrame, edges: DataFrame, n_bins: int, by: Sequence[str], carry: Sequence[str] = ()
) -> DataFrame:
    """One row per key from rows (key, value, n_ref, n_cur), raw or already aggregated.

    Columns: edges, carried columns of the edge table, ``out_of_range`` (current rows outside the edges,
    which belong to no bin and no denominator), and ``bins``, an array with one struct per bin, empty bins
    included. Bin counts are few per key, so shares and contributions are array arithmetic in the row.
    """
    # Without groups there is one edge row per feature column; otherwise its size decides at run time.
    lookup = edges if by else F.broadcast(edges)
    passed = ["edges", *carry]
    # Only two counts are summed over the rows, which keeps the aggregate hashed; the edges join the few results.
    per_bin = (
        counted.join(lookup.select(KEY, "edges"), KEY)
        .withColumn("bin", edge_array_bin(F.col("value"), F.col("edges"), n_bins + 1))
        .groupBy(KEY, "bin")
        .agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))
    )
    inside = F.col("bin").isNotNull()
    per_key = per_bin.groupBy(KEY).agg(
        F.coalesce(F.sum(F.when(~inside, F.col("n_cur"))), F.lit(0)).alias("out_of_range"),
        F.map_from_entries(F.collect_list(F.when(inside, F.struct("bin", F.struct("n_ref", "n_cur"))))).alias("_counts"),
    ).join(lookup.select(KEY, *passed), KEY)
    usable = F.size("edges") > 1
    numbers = F.when(usable, F.sequence(F.lit(0), F.greatest(F.size("edges") - 2, F.lit(0)))).otherwise(
        F.array().cast("array<int>")
    )

    def floored(count: str) -> Column:
        return F.transform(
            numbers,
            lambda i: F.coalesce(F.try_element_at(F.col("_counts"), i)[count], F.lit(0)) + F.lit(SHARE_FLOOR),
        )

    def shares(column: str) -> Column:
        total = F.aggregate(column, F.lit(0.0), lambda acc, x: acc + x)
        return F.transform(column, lambda x: x / total)

    def bin_struct(i: Column) -> Column:
        ref, cur = F.get("_ref", i), F.get("_cur", i)
        return F.struct(
            i.alias("bin"),
            F.get("edges", i).alias("bin_lower"),
            F.get("edges", i + 1).alias("bin_upper"),
            ref.alias("reference_pct"),
            cur.alias("current_pct"),
            ((cur - ref) * F.log(cur / ref)).alias("psi_part"),
        )

    return (
        per_key.withColumns({"_ref": floored("n_ref"), "_cur": floored("n_cur")})
        .withColumns({"_ref": shares("_ref"), "_cur": shares("_cur")})
        .select(KEY, *passed, "out_of_range", F.transform(numbers, bin_struct).alias("bins"))
    )


def psi_bins(
    df: DataFrame,
    *,
    features: Sequence[str],
    is_ref: str,
    n_bins: int = 10,
    method: str = "quantile",
    by: Sequence[str] = (),
) -> DataFrame:
    """Bin edges, shares of both samples and contribution per bin.

    For quantile edges only the reference values around the edges are shuffled; both samples are binned where
    they lie.
    """
    long = _long(df, features, is_ref, by)
    rows = _psi_row(long, _psi_edges(long, n_bins, method, by), n_bins, by)
    return _unpack(rows.select(KEY, F.inline("bins"), "out_of_range"))


def _psi_value() -> Column:
    return F.aggregate("bins", F.lit(0.0), lambda acc, b: acc + b["psi_part"])


def psi(
    df: DataFrame,
    *,
    features: Sequence[str],
    is_ref: str,
    n_bins: int = 10,
    method: str = "quantile",
    by: Sequence[str] = (),
) -> DataFrame:
    """Population stability index per feature with its reading; 0 and a warning if there is one edge only."""
    long = _long(df, features, is_ref, by)
    rows = _psi_row(long, _psi_edges(long, n_bins, method, by), n_bins, by).withColumn("psi", _psi_value())
    usable = F.size("edges") > 1
    return _unpack(
        rows.select(
            KEY,
            "psi",
            F.when(usable, psi_reading(F.col("psi"))).alias("interpretation"),
            "out_of_range",
            F.when(~usable, F.lit(PSI_WARNING)).alias("warning"),
        )
    )


def sample_stats(df: DataFrame, *, features: Sequence[str], is_ref: str, by: Sequence[str] = ()) -> DataFrame:
    """Count, mean and population deviation of both samples per feature."""
    long = _long(df, features, is_ref, by)
    aggregates = []
    for name, flag in (("reference", "n_ref"), ("current", "n_cur")):
        value = F.when(F.col(flag) == 1, F.col("value"))
        aggregates += [
            F.count(value).alias(f"{name}_count"),
            F.avg(value).alias(f"{name}_mean"),
            F.stddev_pop(value).alias(f"{name}_std"),
        ]
    return _unpack(long.groupBy(KEY).agg(*aggregates))


def _two_sample_totals(long: DataFrame) -> DataFrame:
    return running_totals(long, "value", {"n_ref": F.col("n_ref"), "n_cur": F.col("n_cur")}, [KEY])


def ks_aggregates() -> list[Column]:
    gap = F.abs(F.try_divide("n_ref_upto", "n_ref_total") - F.try_divide("n_cur_upto", "n_cur_total"))
    return [
        F.max(gap).alias("ks_statistic"),
        F.max("n_ref_total").alias("n_reference"),
        F.max("n_cur_total").alias("n_current"),
    ]


def ks_two_sample(
    df: DataFrame, *, features: Sequence[str], is_ref: str, by: Sequence[str] = (), exact_rows: int = 0
) -> DataFrame:
    """Two-sample KS distance, p-value and its significance per feature.

    The p-value is exact where neither sample has more than ``exact_rows`` values (0: nowhere), else the limiting one.
    The exact one walks over a lattice of n by m points, one row per pair of samples, in Python.
    """
    totals = _two_sample_totals(_long(df, features, is_ref, by))
    sample = F.col("ks_statistic"), F.col("n_reference"), F.col("n_current")
    p = kolmogorov_p_value(*sample)
    if exact_rows:
        small = F.greatest("n_reference", "n_current") <= exact_rows
        p = F.when(small, exact_kolmogorov_p_value(F.when(small, sample[0]), *sample[1:])).otherwise(p)
    found = totals.groupBy(KEY).agg(*ks_aggregates()).withColumn("p_value", p)
    return _unpack(found.select(KEY, "ks_statistic", "p_value", (F.col("p_value") < SIGNIFICANCE).alias("significant_change")))


def ks_power_change(
    df: DataFrame, *, score: str, label: str, is_ref: str, thresholds: dict[str, float] | None = None
) -> DataFrame:
    """KS distance of goods and bads in both samples and whether the power held; NULL if a class is absent."""
    limit = merged_thresholds(thresholds)["ks_threshold"]
    totals = score_totals(df, score, label, [is_ref])
    gap = F.abs(F.try_divide("neg_upto", "neg_total") - F.try_divide("pos_upto", "pos_total"))
    one = totals.agg(
        F.max(F.when(F.col(is_ref) == 1, gap)).alias("reference_ks_power"),
        F.max(F.when(F.col(is_ref) == 0, gap)).alias("current_ks_power"),
    )
    change = F.col("current_ks_power") - F.col("reference_ks_power")
    return one.withColumn("ks_power_change", change).withColumn(
        "discriminatory_power_maintained", F.abs("ks_power_change") < limit
    )


def drift_rows(counted: DataFrame, edges: DataFrame, n_bins: int, by: Sequence[str], limits: dict[str, float]) -> DataFrame:
    """Drift per key from rows (key, value, n_ref, n_cur) and one row of edges, KS distance and sizes per key."""
    rows = _psi_row(counted, edges, n_bins, by, ["ks_statistic", "n_reference", "n_current"]).withColumn("psi", _psi_value())
    affected = (F.col("psi") > limits["psi_threshold"]) | (F.col("ks_statistic") > limits["ks_threshold"])
    return rows.select(
        f"{KEY}.*",
        "psi",
        "ks_statistic",
        kolmogorov_p_value(F.col("ks_statistic"), F.col("n_reference"), F.col("n_current")).alias("ks_p_value"),
        F.coalesce(affected, F.lit(False)).alias("affected"),
    )


def feature_drift(
    df: DataFrame,
    *,
    features: Sequence[str],
    is_ref: str,
    n_bins: int = 10,
    thresholds: dict[str, float] | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """PSI, KS distance and p-value per feature, and whether either is past its threshold.

    Ranks, quantile edges, bin counts and the KS distance all come from one table of distinct values.
    """
    limits = merged_thresholds(thresholds)
    totals = _two_sample_totals(_long(df, features, is_ref, by))
    probs = [i / n_bins for i in range(n_bins + 1)]
    profile = quantiles_of_totals(totals, "value", "n_ref", probs, [KEY], also=ks_aggregates()).filter(F.col("n") > 0)
    edges = profile.select(
        KEY, F.array_distinct("quantiles").alias("edges"), "ks_statistic", "n_reference", "n_current"
    )
    return drift_rows(totals.select(KEY, "value", "n_ref", "n_cur"), edges, n_bins, by, limits)


def score_drift(df: DataFrame, *, score: str, is_ref: str, n_bins: int = 10) -> DataFrame:
    """PSI and KS of the scores."""
    return feature_drift(df, features=[score], is_ref=is_ref, n_bins=n_bins).select("psi", "ks_statistic", "ks_p_value")


def target_drift(df: DataFrame, *, label: str, is_ref: str) -> DataFrame:
    """Default rate of both samples, absolute and relative change."""
    rates = df.agg(
        F.avg(F.when(F.col(is_ref) == 1, F.col(label))).alias("reference_default_rate"),
        F.avg(F.when(F.col(is_ref) == 0, F.col(label))).alias("current_default_rate"),
    )
    change = F.col("current_default_rate") - F.col("reference_default_rate")
    return rates.withColumn("absolute_change", change).withColumn(
        "relative_change", F.abs("absolute_change") / (F.col("reference_default_rate") + 1e-8)
    )


def drift_verdict(
    df: DataFrame,
    *,
    score: str,
    label: str,
    is_ref: str,
    features: Sequence[str] = (),
    n_bins: int = 10,
    thresholds: dict[str, float] | None = None,
) -> DataFrame:
    """One row: indicators, affected features, strength None / Mild / Severe, detected or not.

    The score runs through the same job as the features, under a name no feature can have.
    """
    limits = merged_thresholds(thresholds)
    score_name = "score:" + score
    tagged = df.withColumn(score_name, F.col(score))
    drift = feature_drift(tagged, features=[*features, score_name], is_ref=is_ref, n_bins=n_bins, thresholds=limits)
    target = target_drift(df, label=label, is_ref=is_ref).agg(F.max("relative_change")).scalar()
    return verdict_row(drift, score_name, target, limits)


def verdict_row(drift: DataFrame, score_name: str, target_change: Column, limits: dict[str, float]) -> DataFrame:
    """The verdict from drift rows of the features and the score, and the relative change of the default rate."""
    is_score = F.col("feature") == score_name
    one = drift.agg(
        F.max(F.when(is_score, F.col("psi"))).alias("score_psi"),
        F.max(F.when(is_score, F.col("ks_statistic"))).alias("score_ks"),
        F.sort_array(F.collect_list(F.when(~is_score & F.col("affected"), F.col("feature")))).alias("drifted"),
    )
    one = one.withColumn("target_change", target_change)
    shifted = F.when(F.col("target_change") > limits["default_rate_shift"], F.array(F.lit("target_distribution")))
    one = one.withColumn("affected_features", F.concat("drifted", F.coalesce(shifted, F.array().cast("array<string>"))))
    marks = F.array(
        F.when(F.col("score_psi") > limits["psi_threshold"], F.lit("score_psi")),
        F.when(F.col("score_ks") > limits["ks_threshold"], F.lit("score_ks")),
        F.when(F.size("affected_features") > 0, F.lit("feature_drift")),
    )
    one = one.withColumn("drift_indicators", F.array_compact(marks))
    count = F.size("drift_indicators")
    return one.select(
        (count > 0).alias("drift_detected"),
        F.when(count == 0, "None").when(count <= 2, "Mild").otherwise("Severe").alias("drift_strength"),
        "drift_indicators",
        "affected_features",
        "score_psi",
        "score_ks",
        F.col("target_change").alias("target_relative_change"),
    )
