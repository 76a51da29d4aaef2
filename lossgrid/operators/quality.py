"""Profiles of a loan table: quality report, missing values, target distribution, cardinality, cleaning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossgrid.functions.numeric import numeric_columns, other_columns


def _nulls_in_row(df: DataFrame) -> Column:
    return reduce(lambda a, b: a + b, [F.col(c).isNull().cast("bigint") for c in df.columns])


def quality_report(df: DataFrame, *, target: str | None = None) -> DataFrame:
    """One row: rows, columns, missing cells, rows beyond the first of each duplicate set, target rate.

    Duplicates are counted through one row per distinct tuple, aggregated map-side first, so a tuple that
    is repeated very often costs no more than any other.
    """
    per_tuple = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    n = F.col("_n")
    aggregates = [
        F.sum(n).alias("n_rows"),
        F.sum(n * _nulls_in_row(df)).alias("missing_values"),
        F.sum(n - 1).alias("duplicate_rows"),
    ]
    if target:
        aggregates += [
            F.sum(F.when(F.col(target) == 0, n).otherwise(0)).alias("_zeros"),
            F.sum(F.when(F.col(target) == 1, n).otherwise(0)).alias("_ones"),
        ]
    report = per_tuple.agg(*aggregates)
    rate = F.try_divide("_ones", F.col("_zeros") + F.col("_ones")) if target else F.lit(None).cast("double")
    return report.select(
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
        F.lit(len(df.columns)).alias("n_cols"),
        F.coalesce("missing_values", F.lit(0)).alias("missing_values"),
        F.coalesce("duplicate_rows", F.lit(0)).alias("duplicate_rows"),
        rate.alias("target_rate"),
    )


def missing_profile(df: DataFrame, *, top: int | None = 10) -> DataFrame:
    """Missing count and percentage per column, most incomplete first; one scan, one aggregate."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"_m{i}") for i, c in enumerate(df.columns)],
    )
    rows = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(f"_m{i}").alias("missing")) for i, c in enumerate(df.columns)]
    )
    profile = counts.select("_rows", F.inline(rows)).select(
        "column_name", "missing", F.try_divide(F.col("missing") * 100.0, F.col("_rows")).alias("missing_pct")
    )
    ordered = profile.orderBy(F.desc("missing"), "column_name")
    return ordered.limit(top) if top else ordered


def target_distribution(df: DataFrame, *, target: str) -> DataFrame:
    """Rows per target value; a missing target is its own group."""
    return df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))


def feature_summary(df: DataFrame) -> DataFrame:
    """One row: size, numeric and other column counts (from the schema), missing cells."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(_nulls_in_row(df)), F.lit(0)).alias("missing_values")
    ).select(
        "n_rows",
        F.lit(len(df.columns)).alias("n_cols"),
        F.lit(len(numeric_columns(df))).alias("n_numeric"),
        F.lit(len(other_columns(df))).alias("n_categorical"),
        "missing_values",
    )


def high_cardinality(df: DataFrame, *, threshold: int = 50, exact: bool = True) -> DataFrame:
    """Non-numeric columns with more than ``threshold`` distinct values, and how many they have.

    The exact form counts one row per (column, value) after map-side aggregation, so no task holds a
    column's value set.
    """
    cols = other_columns(df)
    if not exact:
        counts = df.agg(*[F.approx_count_distinct(c).alias(c) for c in cols])
        long = counts.select(
            F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_distinct")) for c in cols]))
        )
    else:
        pairs = F.array(
            *[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("level")) for c in cols]
        )
        long = (
            df.select(F.inline(pairs))
            .filter(F.col("level").isNotNull())
            .groupBy("column_name", "level")
            .agg(F.count(F.lit(1)).alias("_n"))
            .groupBy("column_name")
            .agg(F.count(F.lit(1)).alias("n_distinct"))
        )
    return long.filter(F.col("n_distinct") > threshold)


def clean_table(
    df: DataFrame, *, target: str, missing_threshold: float = 0.5, remove_duplicates: bool = True
) -> DataFrame:
    """Drop columns missing in more than the given share of rows, rows without target, repeated rows.

    Which columns stay decides the output schema, so the null shares are read first (one number per column).
    """
    shares = df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in df.columns]).first()
    sparse = [c for c in df.columns if c != target and (shares[c] or 0.0) > missing_threshold]
    kept = df.drop(*sparse).filter(F.col(target).isNotNull())
    return kept.distinct() if remove_duplicates else kept
