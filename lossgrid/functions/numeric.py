"""Null-safe arithmetic that follows the one-missing-marker rules of the loan data model."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN compares as the largest value in Spark; as NULL it falls through comparisons as intended."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def least_or_null(a: Column, b: Column) -> Column:
    """Smaller value; NULL if either is NULL (``least`` alone skips NULLs)."""
    return F.when(a.isNotNull() & b.isNotNull(), F.least(a, b))


def clip(x: Column, lo: Column | float, hi: Column | float) -> Column:
    """Bound x to [lo, hi]; a NULL x stays NULL, a NULL bound does not bind."""
    lo = lo if isinstance(lo, Column) else F.lit(float(lo))
    hi = hi if isinstance(hi, Column) else F.lit(float(hi))
    return F.when(x.isNotNull(), F.least(F.greatest(x, lo), hi))


def ratio_or(num: Column, den: Column, default: float) -> Column:
    """num/den, or the default where the denominator is zero or NULL."""
    return F.when(den != 0, num / den).otherwise(F.lit(float(default)))


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def other_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, T.NumericType) and f.name not in skip]


def melt(df: DataFrame, cols: list[str], keep: list[str] = (), name: str = "feature", value: str = "value") -> DataFrame:
    """Numeric columns to rows (name, value); runs as a map-side generate, no shuffle."""
    pairs = F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast("double").alias(value)) for c in cols])
    return df.select(*keep, F.inline(pairs))
