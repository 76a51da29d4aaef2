"""Model performance: confusion counts, AUC, Gini, KS, ROC and PR curves, calibration.

Everything that depends on the order of the scores works on one row per distinct score, so equal scores
count as ties (half a pair each in the AUC) and the result does not depend on row order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossgrid.functions.bins import equal_width_bin, right_closed_bin, unit_edges
from lossgrid.functions.numeric import ratio_or
from lossgrid.operators.ordered import running_totals


def _where(condition: Column, amount: Column | str) -> Column:
    amount = F.col(amount) if isinstance(amount, str) else amount
    return F.when(condition, amount).otherwise(F.lit(0.0))


def score_totals(
    df: DataFrame, score: str, label: str, by: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """Running sums per distinct score, ascending: weighted (pos, neg) and plain (c1, c0) counts."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    positive, negative = F.col(label) == 1, F.col(label) == 0
    sums = {"pos": _where(positive, w), "neg": _where(negative, w)}
    if weight:
        sums |= {"c1": _where(positive, F.lit(1.0)), "c0": _where(negative, F.lit(1.0))}
    return running_totals(df.filter(F.col(label).isNotNull()), score, sums, by)


def _discrimination(weight: str | None) -> list[Column]:
    neg_below = F.col("neg_upto") - F.col("neg")
    pairs = F.sum(F.col("pos") * (neg_below + F.col("neg") / 2.0))
    p, n = F.max("pos_total"), F.max("neg_total")
    c1, c0 = ("c1", "c0") if weight else ("pos", "neg")
    gap = F.max(F.abs(F.try_divide(f"{c0}_upto", f"{c0}_total") - F.try_divide(f"{c1}_upto", f"{c1}_total")))
    return [
        F.when((p > 0) & (n > 0), pairs / (p * n)).otherwise(F.lit(0.5)).alias("auc_roc"),
        F.coalesce(gap, F.lit(0.0)).alias("ks_statistic"),
    ]


def auc_ks(
    df: DataFrame, *, score: str, label: str, by: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """AUC, Gini and the KS distance of goods and bads per group; 0.5 and 0 if a class is empty.

    The KS distance stays unweighted when weights are given.
    """
    found = score_totals(df, score, label, by, weight).groupBy(*by).agg(*_discrimination(weight))
    return found.select(*by, "auc_roc", (F.col("auc_roc") * 2 - 1).alias("gini"), "ks_statistic")


def roc_curve(df: DataFrame, *, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score, taking all scores >= threshold as positive, plus the origin."""
    totals = score_totals(df, score, label, by)

    def share(c: str) -> Column:
        return F.try_divide(F.col(f"{c}_total") - F.col(f"{c}_upto") + F.col(c), F.col(f"{c}_total"))

    points = totals.select(*by, F.col(score).alias("threshold"), share("neg").alias("fpr"), share("pos").alias("tpr"))
    origin = totals.groupBy(*by).agg(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(origin)


def pr_curve(df: DataFrame, *, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """(threshold, precision, recall) per distinct score."""
    totals = score_totals(df, score, label, by)
    tp = F.col("pos_total") - F.col("pos_upto") + F.col("pos")
    fp = F.col("neg_total") - F.col("neg_upto") + F.col("neg")
    return totals.select(
        *by,
        F.col(score).alias("threshold"),
        (tp / (tp + fp)).alias("precision"),
        F.try_divide(tp, F.col("pos_total")).alias("recall"),
        F.try_divide(F.col("pos"), F.col("pos_total")).alias("recall_step"),
    )


def average_precision(df: DataFrame, *, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Sum of precision times recall step, per group."""
    steps = pr_curve(df, score=score, label=label, by=by)
    return steps.groupBy(*by).agg(F.sum(F.col("precision") * F.col("recall_step")).alias("average_precision"))


def evaluate(df: DataFrame, *, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """ROC AUC and average precision from one pass over the distinct scores."""
    totals = score_totals(df, score, label, by)
    tp = F.col("pos_total") - F.col("pos_upto") + F.col("pos")
    fp = F.col("neg_total") - F.col("neg_upto") + F.col("neg")
    step = tp / (tp + fp) * F.try_divide(F.col("pos"), F.col("pos_total"))
    return totals.groupBy(*by).agg(_discrimination(None)[0].alias("roc_auc"), F.sum(step).alias("pr_auc"))


def compare_models(scores: DataFrame, *, score: str, label: str, model: str = "model") -> DataFrame:
    """One row per model of a long (model, loan, score, label) table, best AUC first; one job for all."""
    return evaluate(scores, score=score, label=label, by=[model]).orderBy(F.desc("roc_auc"), model)


def predicted_label(df: DataFrame, *, score: str, out: str = "prediction", threshold: float = 0.5) -> DataFrame:
    return df.withColumn(out, (F.col(score) >= threshold).cast("int"))


def _from_confusion(tp: Column, fp: Column, fn: Column, tn: Column) -> list[Column]:
    precision, recall = ratio_or(tp, tp + fp, 0.0), ratio_or(tp, tp + fn, 0.0)
    return [
        precision.alias("precision"),
        recall.alias("recall"),
        ratio_or(tp * 2, tp * 2 + fp + fn, 0.0).alias("f1_score"),
        ratio_or(tp + tn, tp + tn + fp + fn, 0.0).alias("accuracy"),
    ]


def confusion_metrics(
    df: DataFrame,
    *,
    score: str,
    label: str,
    by: Sequence[str] = (),
    weight: str | None = None,
    threshold: float = 0.5,
) -> DataFrame:
    """Counts (or weights) of the four outcomes and precision, recall, F1, accuracy; 0 where undefined."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    hit = F.col(score) >= threshold
    cells = {
        "tp": hit & (F.col(label) == 1),
        "fp": hit & (F.col(label) == 0),
        "fn": ~hit & (F.col(label) == 1),
        "tn": ~hit & (F.col(label) == 0),
    }
    counted = df.groupBy(*by).agg(*[F.coalesce(F.sum(_where(c, w)), F.lit(0.0)).alias(k) for k, c in cells.items()])
    return counted.select(*by, *cells, *_from_confusion(*[F.col(c) for c in cells]))


def default_rates(df: DataFrame, *, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Observed and predicted default rate, unweighted."""
    return df.groupBy(*by).agg(
        F.coalesce(F.avg(label), F.lit(0.0)).alias("default_rate"),
        F.coalesce(F.avg(score), F.lit(0.0)).alias("predicted_default_rate"),
    )


def performance_report(
    df: DataFrame,
    *,
    score: str,
    label: str,
    by: Sequence[str] = (),
    weight: str | None = None,
    threshold: float = 0.5,
) -> DataFrame:
    """All performance metrics per group from one table of distinct scores."""
    totals = score_totals(df, score, label, by, weight)
    c1, c0 = (F.col("c1"), F.col("c0")) if weight else (F.col("pos"), F.col("neg"))
    hit, s = F.col(score) >= threshold, F.col(score)
    sums = totals.groupBy(*by).agg(
        *_discrimination(weight),
        F.sum(_where(hit, "pos")).alias("tp"),
        F.sum(_where(hit, "neg")).alias("fp"),
        F.sum(_where(~hit, "pos")).alias("fn"),
        F.sum(_where(~hit, "neg")).alias("tn"),
        F.coalesce(F.sum(c1) / F.sum(c1 + c0), F.lit(0.0)).alias("default_rate"),
        F.coalesce(F.sum(s * (c1 + c0)) / F.sum(c1 + c0), F.lit(0.0)).alias("predicted_default_rate"),
    )
    return sums.select(
        *by,
        "auc_roc",
        (F.col("auc_roc") * 2 - 1).alias("gini"),
        "ks_statistic",
        *_from_confusion(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")),
        "default_rate",
        "predicted_default_rate",
    )


def calibration_bins(
    df: DataFrame, *, score: str, label: str, n_bins: int = 10, by: Sequence[str] = ()
) -> DataFrame:
    """Observed and predicted rate per right-closed score bin on [0, 1]; empty bins do not appear."""
    edges = unit_edges(n_bins)
    centres = F.lit([(edges[i] + edges[i + 1]) / 2 for i in range(n_bins)])
    p, y = F.col(score), F.col(label)
    binned = df.filter(p.isNotNull() & y.isNotNull()).withColumn("bin", right_closed_bin(p, edges))
    return binned.groupBy(*by, "bin").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(y).alias("observed_rate"),
        F.avg(p).alias("predicted_rate"),
        F.avg((p - y) * (p - y)).alias("squared_error"),
    ).select(
        *by,
        "bin",
        F.get(centres, F.col("bin")).alias("bin_center"),
        "n",
        "observed_rate",
        "predicted_rate",
        F.abs(F.col("observed_rate") - F.col("predicted_rate")).alias("calibration_error"),
        "squared_error",
    )


def calibration_summary(
    df: DataFrame, *, score: str, label: str, n_bins: int = 10, by: Sequence[str] = ()
) -> DataFrame:
    """ECE, MCE, Brier score and its decomposition, from the (at most n_bins per group) bin rows."""
    bins = calibration_bins(df, score=score, label=label, n_bins=n_bins, by=by)
    n, gap, observed = F.col("n"), F.col("calibration_error"), F.col("observed_rate")
    total = F.sum(n)
    rate = F.sum(n * observed) / total
    zero = F.lit(0.0)
    return bins.groupBy(*by).agg(
        F.coalesce(F.sum(n * gap) / total, zero).alias("expected_calibration_error"),
        F.coalesce(F.max(gap), zero).alias("maximum_calibration_error"),
        F.coalesce(F.sum(n * F.col("squared_error")) / total, zero).alias("brier_score"),
        F.coalesce(F.sum(n * gap * gap) / total, zero).alias("reliability"),
        # Variance of the bin rates around the overall rate.
        F.greatest(F.coalesce(F.sum(n * observed * observed) / total - rate * rate, zero), zero).alias("resolution"),
        F.coalesce(rate * (1 - rate), zero).alias("uncertainty"),
    )


def calibration_curve(
    df: DataFrame, *, score: str, label: str, n_bins: int = 10, by: Sequence[str] = ()
) -> DataFrame:
    """Mean predicted value against the share of positives per bin."""
    bins = calibration_bins(df, score=score, label=label, n_bins=n_bins, by=by)
    return bins.select(*by, F.col("predicted_rate").alias("mean_predicted"), F.col("observed_rate").alias("fraction_positive"))


def default_rate_by_bin(df: DataFrame, *, feature: str, label: str, bins: int = 20) -> DataFrame:
    """Loans, defaults and default rate over equal-width, right-closed bins of a feature; empty bins stay.

    The range is two numbers from a scalar subquery, so the table is scanned twice and never shuffled.
    """
    x = F.col(feature).cast("double")
    low, high = F.min(x), F.max(x)
    # A constant feature gets a range of 0.1 % around its value.
    pad = F.when(low != high, 0.0).otherwise(F.when(low == 0, 0.001).otherwise(F.abs(low) * 0.001))
    limits = df.agg(F.struct((low - pad).alias("lo"), (high + pad).alias("hi")).alias("r"))
    counted = (
        df.withColumn("_r", limits.scalar())
        .withColumn("bin", equal_width_bin(x, F.col("_r.lo"), F.col("_r.hi"), bins, "right"))
        .filter(F.col("bin").isNotNull())
        .groupBy("bin")
        .agg(F.count(label).alias("n"), F.sum(label).alias("defaults"), F.avg(label).alias("rate"))
    )
    grid = limits.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "r.lo", "r.hi")
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    # The printed left edge is lowered by 0.1 % of the range so that the minimum lies inside.
    lower = F.when(F.col("bin") == 0, F.col("lo") - (F.col("hi") - F.col("lo")) * 0.001).otherwise(
        F.col("lo") + F.col("bin") * width
    )
    return grid.join(F.broadcast(counted), "bin", "left").select(  # at most `bins` rows
        "bin",
        lower.alias("bin_lower"),
        F.when(F.col("bin") == bins - 1, F.col("hi")).otherwise(F.col("lo") + (F.col("bin") + 1) * width).alias("bin_upper"),
        F.coalesce("n", F.lit(0)).alias("n"),
        F.coalesce("defaults", F.lit(0)).alias("defaults"),
        F.round("rate", 3).alias("default_rate"),
    )
