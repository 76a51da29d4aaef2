"""Exposure concentration: largest names, concentration indices, Lorenz curve."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossgrid.operators.ordered import running_totals


def concentration_topn(df: DataFrame, *, exposure: str, key: str, n: int = 10) -> DataFrame:
    """The n largest exposures and the remainder as 'Others' (if positive). Each task keeps n rows."""
    top = (
        df.select(F.col(key).cast("string").alias("label"), F.col(exposure).alias("exposure"), F.col(key).alias("_key"))
        .filter(F.col("exposure").isNotNull())
        .orderBy(F.desc("exposure"), "_key")
        .limit(n)
        .drop("_key")
    )
    top_sum = top.agg(F.coalesce(F.sum("exposure"), F.lit(0.0))).scalar()
    rest = df.agg(F.sum(exposure).alias("exposure")).select(
        F.lit("Others").alias("label"), (F.col("exposure") - top_sum).alias("exposure")
    )
    return top.unionByName(rest.filter(F.col("exposure") > 0))


def concentration_indices(df: DataFrame, *, exposure: str, tops: Sequence[int] = (1, 5, 10)) -> DataFrame:
    """Herfindahl index, effective number of exposures, share of the largest 1, 5, 10."""
    e = F.col(exposure)
    sums = df.agg(F.sum(e).alias("_sum"), F.sum(e * e).alias("_squares"))
    largest = df.filter(e.isNotNull()).orderBy(F.desc(exposure)).limit(max(tops)).agg(
        F.sort_array(F.collect_list(exposure), asc=False).alias("a")
    )
    shares = [
        F.try_divide(F.aggregate(F.slice("_top", 1, k), F.lit(0.0), lambda acc, x: acc + x), F.col("_sum")).alias(
            f"top_{k}_concentration"
        )
        for k in tops
    ]
    hhi = F.try_divide(F.col("_squares"), F.col("_sum") * F.col("_sum"))
    return sums.withColumn("_top", largest.scalar()).select(
        hhi.alias("hhi"), F.try_divide(F.lit(1.0), hhi).alias("effective_number_of_exposures"), *shares
    )


def lorenz_curve(df: DataFrame, *, exposure: str, by: Sequence[str] = ()) -> DataFrame:
    """Cumulative share of loans and of exposure in ascending order; equal exposures share one point."""
    totals = running_totals(
        df.select(*by, F.col(exposure).cast("double").alias("exposure")),
        "exposure",
        {"n": F.lit(1), "amount": F.col("exposure")},
        by,
    )
    return totals.select(
        *by,
        "exposure",
        (F.col("n_upto") / F.col("n_total")).alias("share_of_loans"),
        F.try_divide("amount_upto", "amount_total").alias("share_of_exposure"),
    )
