"""Saved profiles of a reference sample, so that monitoring reads the current rows only.

A profile is built from counts of distinct values, written a part (a day, a load) at a time, each part replaced as a
whole. Parts merge by addition. The profile holds per feature the bin edges, the counts of the bins, size and mean, and
the steps of the distribution function; the current rows are binned by the edges and run against the steps.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lossgrid.functions.bins import edge_array_bin
from lossgrid.functions.numeric import melt
from lossgrid.operators import drift
from lossgrid.operators.drift import KEY
from lossgrid.operators.ordered import quantiles_of_totals, running_totals
from lossgrid.session import materialise


def score_feature(score: str) -> str:
    """Name under which a score is profiled; no feature has it."""
    return "score:" + score


def target_feature(label: str) -> str:
    """Name under which a label is profiled."""
    return "target:" + label


def _named(df: DataFrame, features: Sequence[str], score: str | None, label: str | None) -> tuple[DataFrame, list[str]]:
    extra = {score_feature(score): F.col(score)} if score else {}
    if label:
        extra[target_feature(label)] = F.col(label)
    return (df.withColumns(extra) if extra else df), [*features, *extra]


def value_counts(df: DataFrame, *, features: Sequence[str], score: str | None = None, label: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Rows (by, feature, value, rows) of distinct values, the score and the label among the features; NULLs are left out."""
    named, names = _named(df, features, score, label)
    return melt(named, names, keep=list(by)).filter(F.col("value").isNotNull()).groupBy(*by, "feature", "value").agg(F.count(F.lit(1)).alias("rows"))


def write_counts(counts: DataFrame, path: str, *, part: str) -> None:
    """Write one part; a part of that name is replaced as a whole, so a repeated run adds nothing twice."""
    if not re.fullmatch(r"[\w.-]+", part):
        raise ValueError(f"part names are letters, digits, '_', '.' and '-': {part!r}")
    counts.write.mode("overwrite").parquet(f"{path.rstrip('/')}/part={part}")


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """All parts; ``part``, the name as written, prunes to folders."""
    fields = [f for f in spark.read.parquet(path).schema.fields if f.name != "part"]
    return spark.read.schema(T.StructType([*fields, T.StructField("part", T.StringType())])).parquet(path)


@dataclass(frozen=True)
class Profile:
    """``bins``: by, feature, n, mean, edges, counts. ``steps``: by, feature, value, rows."""

    bins: DataFrame
    steps: DataFrame
    n_bins: int
    by: tuple[str, ...] = ()

    def save(self, path: str) -> None:
        base = path.rstrip("/")
        self.steps.write.mode("overwrite").parquet(f"{base}/steps")
        self.bins.withColumn("n_bins", F.lit(self.n_bins)).write.mode("overwrite").parquet(f"{base}/bins")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Profile:
        base = path.rstrip("/")
        bins, steps = spark.read.parquet(f"{base}/bins"), spark.read.parquet(f"{base}/steps")
        by = tuple(c for c in steps.columns if c not in ("feature", "value", "rows"))
        found = bins.agg(F.max("n_bins")).first()[0]
        return Profile(bins.drop("n_bins"), steps, found or 1, by)


def _thinned(totals: DataFrame, max_error: float) -> DataFrame:
    """Steps left of a distribution function when values within ``max_error`` of its height are joined.

    The height is cut into equal layers. The first value of a layer keeps its rows, as its step may be higher than a layer;
    the rows of the others go to the last, which moves less than a layer.
    """
    layer = F.ceil(F.col("rows_upto") / F.col("rows_total") / F.lit(max_error))
    layers = totals.withColumn("_layer", layer).groupBy(KEY, "_layer").agg(
        F.min("value").alias("_first"), F.max("value").alias("_last"), F.sum("rows").alias("_all"), F.min_by("rows", "value").alias("_rows"),
    )
    both = F.array(F.struct(F.col("_first").alias("value"), F.col("_rows").alias("rows")),
                   F.struct(F.col("_last").alias("value"), (F.col("_all") - F.col("_rows")).alias("rows")))
    return layers.select(KEY, F.inline(both)).filter(F.col("rows") > 0)


def build_profile(counts: DataFrame, *, n_bins: int = 10, by: Sequence[str] = (), max_error: float | None = None) -> Profile:
    """Profile of the merged parts: quantile edges and bin counts, exact, and the steps.

    Without ``max_error`` there is a step per distinct value and KS distances are exact. With it there are at most
    2 / ``max_error`` steps a feature, and a KS distance is off by less than ``max_error``. An empty table gives an empty profile.
    """
    by = list(by)
    keyed = counts.select(F.struct(*by, "feature").alias(KEY), "value", "rows")
    totals = materialise(running_totals(keyed, "value", {"rows": F.col("rows")}, [KEY]), "profile-totals")
    mean = (F.sum(F.col("value") * F.col("rows")) / F.sum("rows")).alias("mean")
    probs = [i / n_bins for i in range(n_bins + 1)]
    edges = quantiles_of_totals(totals, "value", "rows", probs, [KEY], also=[mean])
    edges = materialise(edges.select(KEY, "n", "mean", F.array_distinct("quantiles").alias("edges")), "profile-edges")
    binned = totals.join(edges.select(KEY, "edges"), KEY).withColumn("bin", F.coalesce(edge_array_bin(F.col("value"), F.col("edges"), n_bins + 1), F.lit(0)))
    per_bin = binned.groupBy(KEY, "bin").agg(F.sum("rows").alias("rows"))
    per_key = per_bin.groupBy(KEY).agg(F.map_from_entries(F.collect_list(F.struct("bin", "rows"))).alias("_rows"))  # n_bins entries
    numbers = F.sequence(F.lit(0), F.greatest(F.size("edges") - 2, F.lit(0)))
    filled = F.transform(numbers, lambda i: F.coalesce(F.try_element_at(F.col("_rows"), i), F.lit(0).cast("bigint")))
    bins = edges.join(per_key, KEY).select(f"{KEY}.*", "n", "mean", "edges", filled.alias("counts"))
    steps = totals.select(KEY, "value", "rows") if max_error is None else _thinned(totals, max_error)
    return Profile(bins, steps.select(f"{KEY}.*", "value", "rows"), n_bins, tuple(by))


def _keyed(df: DataFrame, by: Sequence[str]) -> DataFrame:
    keys = [*by, "feature"]
    return df.select(F.struct(*keys).alias(KEY), *[c for c in df.columns if c not in keys])


def drift_from_profile(
    current: DataFrame, profile: Profile, *, features: Sequence[str], score: str | None = None, thresholds: dict[str, float] | None = None
) -> DataFrame:
    """``feature_drift`` of current rows against a profile: same columns and, with all steps, same values.

    Neither the reference nor its parts are read. Features without a profile are left out; features without current rows
    have no KS distance.
    """
    by, limits = list(profile.by), drift.merged_thresholds(thresholds)
    named, names = _named(current, features, score, None)
    asked = F.col("feature").isin(names)
    nothing = F.lit(0).cast("bigint")
    bins, steps = _keyed(profile.bins.filter(asked), by), _keyed(profile.steps.filter(asked), by)
    now = _keyed(value_counts(current, features=features, score=score, by=by), by)
    sides = steps.select(KEY, "value", F.col("rows").alias("n_ref"), nothing.alias("n_cur")).unionAll(
        now.select(KEY, "value", nothing.alias("n_ref"), F.col("rows").alias("n_cur"))
    )
    totals = running_totals(sides, "value", {"n_ref": F.col("n_ref"), "n_cur": F.col("n_cur")}, [KEY])
    distances = totals.groupBy(KEY).agg(*drift.ks_aggregates())
    edges = bins.join(distances, KEY).select(KEY, "edges", "ks_statistic", "n_reference", "n_current")
    # A bin's reference rows are counted at its lower edge, which belongs to it.
    held = bins.select(KEY, "edges", F.posexplode("counts").alias("_bin", "n_ref"))
    held = held.select(KEY, F.get("edges", F.col("_bin")).alias("value"), "n_ref", nothing.alias("n_cur"))
    counted = held.unionAll(now.select(KEY, "value", nothing.alias("n_ref"), F.col("rows").alias("n_cur")))
    return drift.drift_rows(counted, edges, profile.n_bins, by, limits)


def verdict_from_profile(
    current: DataFrame, profile: Profile, *, score: str, label: str, features: Sequence[str] = (), thresholds: dict[str, float] | None = None
) -> DataFrame:
    """``drift_verdict`` of current rows against a profile that holds the score and the label."""
    if profile.by:
        raise ValueError("a verdict is on one sample; build the profile without groups")
    limits = drift.merged_thresholds(thresholds)
    rows = drift_from_profile(current, profile, features=features, score=score, thresholds=limits)
    before = profile.bins.filter(F.col("feature") == target_feature(label)).agg(F.max("mean")).scalar()
    rate: Column = F.avg(F.col(label).cast("double"))
    change = current.agg(rate.alias("_now")).select(F.abs(F.col("_now") - before) / (before + 1e-8)).scalar()
    return drift.verdict_row(rows, score_feature(score), change, limits)
